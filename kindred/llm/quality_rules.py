"""Quality rules with thresholds that each language and source sets for itself.

Measures are column functions over whole texts. A mergeable KLL sketch per (lang,
source) holds the distribution of every measure; small groups borrow the sketch of
their language, or of everything, which are merges of the group sketches and not
another pass. A document is rejected when a measure lies outside the fence of its
group: the quartiles widened by ``FENCE`` times the quartile distance, which never
counts as less than the measure's own least spread. A group whose documents are all
alike therefore does not reject ordinary ones.

Sketches are partial aggregates, so a group with a third of all rows is a few small
buffers per task. Everything is DataFrame functions; no Python runs on executors.

Defined results: a null text has no words and fails the base rule; a null lang or
source is a group of its own; repeated rows are judged alike and all returned; an
empty table gives no rows; further columns of the input are kept whatever their names,
but ``measure`` and ``judge`` replace those named as a count, a share or ``kept``;
``keep_good`` gives back all columns as they were.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.session import materialise

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
MARKS = r"[!?]+"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30

MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")

#: Measure → least quartile distance that counts. Where nothing repeats, the fences of
#: repeated lines and words are 0.30 and 0.12, well below the base cutoff.
SPREADS = {
    "symbol_share": 0.005, "mark_share": 0.008, "upper_share": 0.05,
    "mean_word": 0.6, "dup_line_share": 0.05, "repeat_share": 0.02,
}
#: Measures that can also be too low.
TWO_SIDED = ("mean_word",)
FENCE = 6.0
#: Sketch size: rank error about 0.2 %, exact for up to as many values.
SKETCH_K = 1024
#: Groups with fewer documents use the sketch of their language or of everything.
MIN_GROUP = 50


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def _covered(starts: Column) -> Column:
    """Words covered by windows at the ascending ``starts``."""
    steps = F.transform(starts, lambda p, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def repeated_words(words: Column) -> Column:
    """Words in windows of eight that the text holds more than once.

    Most texts repeat none, which a hash set of the window hashes settles; only the
    others sort their windows.
    """
    def from_hashes(hashes: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
                              lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))
        return _let(windows, from_windows)

    def from_windows(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda k, i: F.struct(k.alias("k"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            _let(placed, from_sorted))

    def from_sorted(placed: Column) -> Column:
        again = F.filter(placed, lambda x, i: F.coalesce(
            (F.get(placed, i - 1)["k"] == x["k"]) | (F.get(placed, i + 1)["k"] == x["k"]),
            F.get(placed, i + 1)["k"] == x["k"], F.get(placed, i - 1)["k"] == x["k"], F.lit(False)))
        return _let(F.sort_array(F.transform(again, lambda x: x["p"])), _covered)

    return F.when(F.size(words) <= WINDOW, 0).otherwise(
        _let(F.transform(words, lambda w: F.xxhash64(w)), from_hashes))


def _removed(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` (text) with the counts of ``MEASURED`` and the shares of ``SPREADS``."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def by_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_words(words).cast("long").alias("n_repeat_words"))

    def by_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # The input's columns stand in a struct meanwhile, so none of them meets one of ours.
    own = [c for c in docs.columns if c not in (*MEASURED, *SPREADS)]
    counted = docs.select(
        F.struct(*(F.col(_quoted(c)) for c in own)).alias("row"), _let(words_of(text), by_words).alias("w"),
        _let(lines, by_lines).alias("l"), _removed(text, SYMBOLS).cast("long").alias("n_symbols"),
        _removed(text, MARKS).cast("long").alias("marks"), _removed(text, r"\p{Lu}+").cast("long").alias("upper"))
    n, chars = F.greatest(F.col("w.n_words"), F.lit(1)), F.greatest(F.col("w.word_chars"), F.lit(1))
    return counted.select(
        "row.*", F.col("w.n_words").alias("n_words"), F.col("w.word_chars").alias("word_chars"), "n_symbols",
        F.col("l.n_dup_lines").alias("n_dup_lines"), F.col("w.n_repeat_words").alias("n_repeat_words"),
        ((F.col("w.n_words") < MIN_WORDS)
         | (100 * F.col("w.n_repeat_words") > REPEAT_PERCENT * F.col("w.n_words"))).alias("base_failed"),
        (F.col("n_symbols") / chars).alias("symbol_share"), (F.col("marks") / chars).alias("mark_share"),
        (F.col("upper") / chars).alias("upper_share"), (F.col("w.word_chars") / n).alias("mean_word"),
        (F.col("l.n_dup_lines") / F.greatest(F.col("l.n_lines"), F.lit(1))).alias("dup_line_share"),
        (F.col("w.n_repeat_words") / n).alias("repeat_share"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _fences(sketch: Callable[[str], Column], spreads: Mapping[str, float]) -> list[Column]:
    """Lower and upper fence of each measure from its sketch."""
    found = []
    for name, spread in spreads.items():
        low, high = (F.kll_sketch_get_quantile_double(sketch(name), F.lit(q)) for q in (0.25, 0.75))
        reach = FENCE * F.greatest(high - low, F.lit(spread))
        found.append((high + reach).alias(f"{name}_max"))
        if name in TWO_SIDED:
            found.append((low - reach).alias(f"{name}_min"))
    return found


def thresholds(measured: DataFrame, min_group: int = MIN_GROUP, k: int = SKETCH_K,
               spreads: Mapping[str, float] = SPREADS) -> DataFrame:
    """lang, source, <measure>_max (and _min), from documents that pass the base rule."""
    groups = measured.filter(~F.col("base_failed")).groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.kll_sketch_agg_double(F.col(name).cast("double"), F.lit(k)).alias(name) for name in SPREADS])
    groups = materialise(groups.withColumn("every", F.lit(1)), "sketches")

    def merged(key: str, prefix: str) -> DataFrame:
        return groups.groupBy(F.col(key).alias(f"{prefix}_key")).agg(
            F.sum("n").alias(f"{prefix}_n"),
            *[F.kll_merge_agg_double(name, F.lit(k)).alias(f"{prefix}_{name}") for name in SPREADS])

    joined = (
        groups.join(merged("lang", "lang"), F.col("lang").eqNullSafe(F.col("lang_key")))
        .join(merged("every", "every"), F.col("every") == F.col("every_key"))
    )
    pick = lambda name: (
        F.when(F.col("n") >= min_group, F.col(name))
        .when(F.col("lang_n") >= min_group, F.col(f"lang_{name}")).otherwise(F.col(f"every_{name}")))
    return joined.select("lang", "source", *_fences(pick, spreads))


def apply_rules(docs: DataFrame, min_group: int = MIN_GROUP, k: int = SKETCH_K,
                spreads: Mapping[str, float] = SPREADS) -> DataFrame:
    """``docs`` (text, lang, source, further columns) with the counts and ``kept``.

    Measured rows are written once, since the sketches and the filter both read them;
    drop the columns that the result does not need beforehand.
    """
    return judge(materialise(measure(docs), "measured"), min_group, k, spreads)


def judge(measured: DataFrame, min_group: int = MIN_GROUP, k: int = SKETCH_K,
          spreads: Mapping[str, float] = SPREADS) -> DataFrame:
    limits = thresholds(measured, min_group, k, spreads).select(F.struct("*").alias("limits"))
    own = [c for c in measured.columns if c != "kept"]
    rows = measured.select(F.struct(*(F.col(_quoted(c)) for c in own)).alias("row"))
    inside = F.lit(True)
    for name in SPREADS:
        inside = inside & (F.col(f"row.{name}") <= F.col(f"limits.{name}_max"))
        if name in TWO_SIDED:
            inside = inside & (F.col(f"row.{name}") >= F.col(f"limits.{name}_min"))
    # A group without limits has no document that passes the base rule.
    return rows.join(
        limits, F.col("row.lang").eqNullSafe(F.col("limits.lang"))
        & F.col("row.source").eqNullSafe(F.col("limits.source")), "left").select(
        "row.*", (~F.col("row.base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))


#: What the rules read.
READ = ("text", "lang", "source")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns as they were."""
    own = [c for c in docs.columns if c not in READ]
    packed = docs.select(*READ, F.struct(F.lit(0).alias("_"), *(F.col(_quoted(c)) for c in own)).alias("own"))
    return apply_rules(packed).filter("kept").select(
        *(F.col(c) if c in READ else F.col("own").getField(c).alias(c) for c in docs.columns))
