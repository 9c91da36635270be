"""Nearest products of the other source by cosine, without comparing all pairs.

The plan is an exact, threshold-driven similarity join (the norm bounds follow
Bayardo et al., WWW 2007, and Anastasiu & Karypis, ICDE 2014):

1. Products of one source with the same weighted list share one *profile*, so a
   large group of copies costs one vector. A profile stands for its members
   through a few representatives that provably contain every possible answer.
2. Each query profile looks at the strongest few postings of its heaviest
   ingredients. The exact score of its n-th best such candidate is a floor that
   the final answer cannot fall below.
3. Ingredients are ordered rare to common. The few postings of a rare one are
   always met. At a common one, whatever score is still to come is at most the
   product of the two remaining norms, so a pair is formed there only if that
   product reaches the query's floor, and so does the product of the two weights with
   that of the norms after them. Common ingredients carry little of most
   vectors' norm, hence their long posting lists are hardly ever opened.
   A pair that shares no other ingredient scores just the one product; bits of the
   other ingredients tell most such pairs, which go before any shuffle if too low.
   A query with short lists alone needs no floor from elsewhere: the n best of a list
   rule out the others that share nothing else.
4. Profiles that are nearly equal stand in clusters (``clusters``). Two clusters whose
   members are all beyond the ceiling, or below the floors, form no pairs.
5. The best pairs met so far are scored exactly, which raises the floors; what
   still can reach them gets its exact score, and the top n are ranked per product.

No candidate is sampled or capped: a pair is left out only when its bound proves
that it cannot be part of the result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kindred.operators import clusters as tight
from kindred.operators.places import add_places, free_places
from kindred.session import materialise

#: Fixed values of the ranking rule and of the norm.
TOP_N = 3
SAME_PRODUCT = 0.9999
NORM_EPSILON = 1e-10

#: Slack that keeps rounding in the bounds from dropping a pair exactly at them.
SLACK = 1e-9
#: Share of the squared norm that makes an ingredient one of the (at most five)
#: looked up for the floor.
LEAD_SHARE = 0.2
#: Posting lists up to this length are opened by every query; longer ones only by
#: the queries whose bound asks for it.
SHORT_LIST = 32
#: Posting lists longer than this are cut into bands of the remaining norm.
BANDED_LENGTH = 256
BANDS = 32
#: Bands in which the norm halves: it is small wherever most of a vector is shared with no one.
HALVED_IN = 2
#: Copies in groups up to this size stay profiles of their own where they are less than
#: one in ``RARE_COPIES`` products: they form few pairs, and nothing is written again for them.
FEW_COPIES = 8
RARE_COPIES = 16
#: So many copies are looked up where the rows are read; more are joined, which shuffles all rows once more.
LOOKED_UP = 500_000


def brand_key(brand: Column | str) -> Column:
    """Case-insensitive brand; a missing brand equals every other missing brand."""
    brand = F.col(brand) if isinstance(brand, str) else brand
    return F.coalesce(F.upper(brand), F.lit("NAN"))


def tie_key(similarity: Column | str) -> Column:
    """Ranking value: twelve places, so that sums of the same terms in another
    order tie and the id decides."""
    return F.round(similarity, 12)


@dataclass(frozen=True)
class Vectors:
    """``features``: side, profile, lead_brand, only_brand, ingredient, postings, u, tail, lead, others, wide, cluster.
    ``members``: side, profile, product_id, brand.

    ``u`` is the unit-normalised weight, ``postings`` the number of match profiles
    with the ingredient (of match products, which are no fewer, where these are at most ``SHORT_LIST``). With a profile's ingredients ordered rare to common, ``tail``
    is the norm after this ingredient, counting long lists only (``head`` of ``_sides`` is the
    same with this ingredient). ``lead`` marks the ingredients looked up for the floor: the
    heaviest of those that count and the most common one, so that a floor is found wherever any list holds
    enough answers. ``only_brand`` is the brand of a profile whose members have no other:
    two profiles of one such brand never answer each other. ``others`` has a bit for each
    other ingredient of the profile; two profiles that share this ingredient and one more
    have a bit in common there. ``wide`` marks profiles that have a long list: the others
    meet at most ``SHORT_LIST`` profiles per ingredient. ``cluster`` is null outside of
    ``clusters``, which are None where nothing is nearly equal. ``single``: every profile is one product.
    """

    features: DataFrame
    members: DataFrame
    clusters: tight.Clusters | None = None
    single: bool = False


def list_lengths(cells: DataFrame, products: DataFrame, *counts: Column) -> DataFrame:
    """Per ingredient of ``cells`` (product_id, ingredient, each pair once): ``postings``, its match products if any
    query has it, too, else 0; ``match_line`` and ``query_line``, a hash of the one brand that all its products of
    the side have; and ``counts``.

    A profile stands for one product at least, so no list of profiles is longer. Cells that lie by
    product meet the products there, and only sums are shuffled.
    """
    brand = F.xxhash64(brand_key("brand"))
    asks = F.col("side") == "query"
    of_product = products.repartition("product_id").groupBy("product_id").agg(
        F.min(F.when(~asks, brand)).alias("m_low"), F.max(F.when(~asks, brand)).alias("m_high"),
        F.min(F.when(asks, brand)).alias("q_low"), F.max(F.when(asks, brand)).alias("q_high"))
    summed = cells.join(of_product, "product_id", "left").groupBy("ingredient").agg(
        F.count("m_low").alias("held"), F.count("q_low").alias("asked"),
        *[low(f"{x}_{name}").alias(f"{x}_{name}") for x in "mq" for name, low in (("low", F.min), ("high", F.max))], *counts)
    kept = [c for c in summed.columns if c not in ("held", "asked", "m_low", "m_high", "q_low", "q_high")]
    return summed.select(
        *kept, F.when(F.col("asked") > 0, F.col("held")).otherwise(0).cast("int").alias("postings"),
        F.when(F.col("m_low") == F.col("m_high"), F.col("m_low")).alias("match_line"),
        F.when(F.col("q_low") == F.col("q_high"), F.col("q_low")).alias("query_line"))


def brand_lines(products: DataFrame) -> DataFrame:
    """product_id, ``held_by``, ``asked_by``: a hash of its brand as a match and as a query product. A product of
    several brands on a side has a hash of its own there, which is no brand's."""
    brand, asks = F.xxhash64(brand_key("brand")), F.col("side") == "query"

    def line(here: Column) -> Column:
        low, high = F.min(F.when(here, brand)), F.max(F.when(here, brand))
        return F.when(low != high, F.xxhash64(F.lit("several"), "product_id")).otherwise(low)

    return products.repartition("product_id").groupBy("product_id").agg(
        line(~asks).alias("held_by"), line(asks).alias("asked_by"))


def with_list_lengths(cells: DataFrame, products: DataFrame) -> DataFrame:
    """``cells`` (product_id, ingredient, position, each pair once) with ``doc_freq`` and what ``list_lengths`` tells.

    Where hardly any two rows of a task share an ingredient, sums by task are as many rows as the cells. So each
    cell takes its product's brands along, and the lists are counted where the cells meet their ingredient.
    """
    return counted_lists(cells.join(brand_lines(products), "product_id", "left"))


def counted_lists(cells: DataFrame, second: str | None = None) -> DataFrame:
    """``with_list_lengths`` for cells that have their ``brand_lines``.

    With ``second``, two hashes stand for the ingredient, and the cells come back with the first of them alone; where
    another ingredient has the same, both get a hash of the two. Lines of lists that form no pairs are not told then.
    """
    here = W.partitionBy("ingredient") if second is None else W.partitionBy("ingredient", second)

    def one(name: str) -> Column:
        told = F.lit(True) if second is None else F.col("postings") > 0
        return F.when(told & (F.col(f"{name}_low") == F.col(f"{name}_high")), F.col(f"{name}_low"))

    counted = cells.repartition("ingredient").withColumns({
        "doc_freq": F.count(F.lit(1)).over(here), "held": F.count("held_by").over(here), "asked": F.count("asked_by").over(here),
        **{f"{name}_{end}": low(name).over(here) for name in ("held_by", "asked_by") for end, low in (("low", F.min), ("high", F.max))},
    }).withColumn("postings", F.when(F.col("asked") > 0, F.col("held")).otherwise(0).cast("int"))
    ingredient = F.col("ingredient")
    if second is not None:
        same = W.partitionBy("ingredient")
        counted = counted.withColumn("alone", F.min(second).over(same) == F.max(second).over(same))
        ingredient = F.when(F.col("alone"), ingredient).otherwise(F.xxhash64("ingredient", second)).alias("ingredient")
    return counted.select("product_id", ingredient, "position", "doc_freq", "postings",
                          one("held_by").alias("match_line"), one("asked_by").alias("query_line"))


def _arranged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (keys, ingredient, postings, counts, w) of vectors, each ordered common to rare: ``place``, the square of
    the weight ``after`` it in long lists, and the parts of ``others``. Rows that don't count come last."""
    common_first = W.partitionBy(*keys).orderBy(F.desc("counts"), F.desc("postings"), F.desc("ingredient"))
    before, whole = common_first.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(*keys)
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(ingredient), 64) AS int))")
    guarded = F.when(F.col("counts") & (F.col("postings") > SHORT_LIST), F.col("w") * F.col("w")).otherwise(0.0)
    return rows.withColumn("bit", F.when(F.col("counts"), bit).otherwise(0)).withColumns({
        "after": F.coalesce(F.sum(guarded).over(before), F.lit(0.0)),
        "place": F.row_number().over(common_first),
        "passed": F.coalesce(F.bit_or("bit").over(before), F.lit(0)),
    }).withColumns({
        "bits": F.bit_or("bit").over(whole),
        "twice": F.bit_or(F.col("bit").bitwiseAND(F.col("passed"))).over(whole),
    })


def _others() -> Column:
    return F.col("bits").bitwiseAND(F.bitwise_not("bit")).bitwiseOR(F.col("twice").bitwiseAND(F.col("bit"))).alias("others")


def _lead(norm: Column) -> Column:
    return ((F.col("w") * F.col("w") >= LEAD_SHARE * norm * norm) | (F.col("place") == 1)).alias("lead")


def keyed_rows(weighted: DataFrame, products: DataFrame, same_brand: bool) -> DataFrame:
    """Rows of ``weighted`` that an answer can have (``shared``), by product, with what their product's list tells, and
    the order-free fingerprint of the list at one row of each (``head``). No list is ever collected.

    ``counts``: not in a line of the product's own brand; ``lined``: some row of the product is.
    ``wide``: some list may be long. A product listed more than once has its list once (``twin``).
    """
    mine = ["product_id", "listing"]
    listings = W.partitionBy("product_id").orderBy("side", "brand")
    listed = products.repartition("product_id").select("product_id", "side", brand_key("brand").alias("brand")).withColumns({
        "listing": F.row_number().over(listings), "twin": F.coalesce(F.lag("side").over(listings) != F.col("side"), F.lit(True))})
    line = F.when(F.col("side") == "query", F.col("match_line")).otherwise(F.col("query_line"))
    own = F.lit(False) if same_brand else F.coalesce(line == F.xxhash64("brand"), F.lit(False))
    whole, square = W.partitionBy(*mine), F.col("w") * F.col("w")
    rows = weighted.repartition("product_id").join(listed, "product_id").withColumn("shared", F.col("postings") > 0).withColumn(
        "counts", F.col("shared") & ~own)
    keyed = _arranged(rows, mine).withColumns({
        "norm": F.sqrt(F.sum(square).over(whole)) + F.lit(NORM_EPSILON),
        "size": F.count(F.lit(1)).over(whole),
        "print_1": F.bit_xor(F.xxhash64("ingredient", "w")).over(whole),
        "print_2": F.bit_xor(F.xxhash64(F.lit("second"), "w", "ingredient")).over(whole),
        "wide": F.max("postings").over(whole) > SHORT_LIST,
        "lined": F.bool_or(F.col("shared") & ~F.col("counts")).over(whole),
    })
    head = F.col("place") == 1
    return keyed.filter(head | F.col("shared")).select(
        "side", "product_id", "brand", "twin", head.alias("head"),
        *[F.when(head, F.col(c)).alias(c) for c in FINGERPRINT if c != "side"],
        "ingredient", "postings", "shared", "counts", "lined", "wide", (F.col("w") / F.col("norm")).alias("u"),
        _lead(F.col("norm")), _others())


#: Columns in which copies agree.
FINGERPRINT = ["side", "size", "print_1", "print_2"]


def build_vectors(weighted: DataFrame, products: DataFrame, same_brand: bool = True,
                  ceiling: float | None = None) -> Vectors:
    """``products``: product_id, side ('query' or 'match'), brand. ``weighted`` may have ``list_lengths``.

    Rows of weight zero (an ingredient of every product) add nothing and go first.
    Without ``same_brand``, an ingredient that the other side has in one brand only goes
    from the profiles of that brand: it counts in their norm but in no answer. So the
    lines of a brand neither open lists nor loosen bounds. With a ``ceiling``, at which
    pairs are of no use, nearly equal profiles are put in clusters.

    Where products count few, so do profiles: the rows of such lists are ready as they are. Only
    profiles with a list that may be long have theirs counted and ordered by profile.
    """
    weighted = weighted.filter(F.col("tfidf") > 0)
    if "postings" not in weighted.columns:
        weighted = weighted.join(list_lengths(weighted, products), "ingredient")
    live = weighted.select("product_id", "ingredient", F.col("tfidf").alias("w"), "postings", "match_line", "query_line")
    keyed = materialise(keyed_rows(live, products, same_brand), "keyed", by="side", codec="zstd")
    copies, members = _copies(keyed.filter("head").select("product_id", "brand", "twin", *FINGERPRINT))
    rows = keyed.filter("shared AND twin")
    if copies is None:
        rows = rows.withColumns({"lead_brand": F.col("brand"), "sole": F.lit(True)})
    else:
        copies = F.broadcast(copies) if copies.count() <= LOOKED_UP else copies
        rows = materialise(
            rows.join(copies, ["side", "product_id"], "left").filter("first IS NULL OR first = product_id").withColumns({
                "lead_brand": F.when(F.col("low") != F.col("high"), F.col("first_brand")).otherwise(F.col("brand")),
                "sole": F.coalesce(F.col("low") == F.col("high"), F.lit(True)),
            }).drop("brand", "twin", "head", "size", "print_1", "print_2", "first", "first_brand", "low", "high"),
            "profiles", by="side", codec="zstd")
    rows = rows.withColumnRenamed("product_id", "profile")
    only_brand = F.when(F.col("sole"), F.col("lead_brand")).alias("only_brand")
    anew = F.col("wide") | (F.col("lined") & ~F.col("sole"))
    ready = rows.filter(~anew & F.col("counts")).select(
        "side", "profile", "lead_brand", only_brand, "ingredient", "postings", "u", F.lit(0.0).alias("tail"), "lead",
        "others", F.lit(False).alias("wide"))

    # These rows are shuffled: one brand each, and flags instead of names.
    again = rows.filter(anew).select(
        (F.col("side") == "query").alias("asks"), "profile", "lead_brand", "sole", "ingredient", "postings", "counts",
        F.col("u").alias("w"))
    asks, is_long = F.col("asks"), F.col("postings") > SHORT_LIST
    # All profiles of a list that may be long are here.
    exact = again.filter(is_long).groupBy("ingredient").agg(
        F.count_if(~asks).cast("int").alias("held"), F.count_if(asks).alias("asked"))
    arranged = _arranged(
        again.join(exact, "ingredient", "left")
        .withColumn("postings", F.when(is_long, F.when(F.col("asked") > 0, F.col("held")).otherwise(0)).otherwise(F.col("postings")))
        .filter((F.col("postings") > 0) & (F.col("counts") | ~F.col("sole"))).drop("held", "asked")
        .withColumn("counts", F.lit(True)), ["profile", "asks"])
    features = materialise(arranged.select(
        F.when(asks, "query").otherwise("match").alias("side"), "profile", "lead_brand", only_brand,
        "ingredient", "postings", F.col("w").alias("u"), F.sqrt("after").alias("tail"),
        _lead(F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("profile", "asks")))), _others(),
        (F.max("postings").over(W.partitionBy("profile", "asks")) > SHORT_LIST).alias("wide")),
        "features", by="side", codec="zstd")
    clusters = None if ceiling is None else tight.find_clusters(
        features.filter("wide").select("side", "profile", "ingredient", "u"), ceiling)
    none = F.lit(None).cast("long").alias("cluster")
    if clusters is None:
        features = features.select("*", none)
    else:
        features = materialise(features.join(clusters.members, ["side", "profile"], "left"), "features", by="side", codec="zstd")
    return Vectors(features.unionByName(ready.select("*", none)), materialise(members, "members", by="side"), clusters,
                   single=copies is None)


def _copies(heads: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """``heads`` has a row per product and listing. The products that have copies, with the ``first`` of them, its
    brand, and the lowest and highest brand of all; None if there are none, or a few that may stay apart. And the
    members of all profiles.

    Hashes of fingerprints tell what may repeat; only that is grouped and looked up. A product
    that is listed more than once on a side repeats, too, and never stays apart.
    """
    hashed = F.xxhash64(*FINGERPRINT).alias("hashed")
    repeated = materialise(heads.groupBy(hashed).agg(F.count(F.lit(1)).alias("n"), F.bool_and("twin").alias("apart"))
                           .filter("n > 1"), "repeated")
    seen = repeated.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.bool_and("apart").alias("apart")).first()
    repeated = repeated.select("hashed")
    if seen["n"] is None or (
            seen["apart"] and seen["most"] <= FEW_COPIES and seen["n"] * RARE_COPIES <= heads.count()):
        return None, heads.select("side", F.col("product_id").alias("profile"), "product_id", "brand")
    similar = heads.withColumn("hashed", hashed).join(repeated, "hashed", "left_semi").drop("hashed")
    copied = similar.groupBy(*FINGERPRINT).agg(
        F.min("product_id").alias("first"),
        F.min_by("brand", "product_id").alias("first_brand"),
        F.min("brand").alias("low"), F.max("brand").alias("high"),
        F.count(F.lit(1)).alias("n"),
    ).filter("n > 1").drop("n")
    copies = materialise(similar.filter("twin").join(copied, FINGERPRINT).select(
        "side", "product_id", "first", "first_brand", "low", "high"), "copied")
    return copies, heads.join(copies.select("side", "product_id", "first"), ["side", "product_id"], "left").select(
        "side", F.coalesce("first", "product_id").alias("profile"), "product_id", "brand")


def representatives(members: DataFrame, n: int) -> DataFrame:
    """Members of match profiles that can appear in any top-n: the first n per
    brand, then the first 2n of those. Whatever one brand is excluded, at most n of
    the 2n are lost, so the first n of the others are always among them."""
    by_brand = W.partitionBy("profile", "brand").orderBy("product_id")
    overall = W.partitionBy("profile").orderBy("product_id")
    return (
        members.filter(F.col("side") == "match")
        .withColumn("r", F.row_number().over(by_brand)).filter(F.col("r") <= n)
        .withColumn("r", F.row_number().over(overall)).filter(F.col("r") <= 2 * n)
        .select(F.col("profile").alias("b"), F.col("product_id").alias("match_id"),
                F.col("brand").alias("match_brand"))
    )


def _sides(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    head = F.sqrt(F.col("tail") * F.col("tail") + F.col("u") * F.col("u"))
    fa = features.filter(F.col("side") == "query").select(
        F.col("profile").alias("a"), "ingredient", F.col("u").alias("ua"), head.alias("head_a"),
        F.col("tail").alias("tail_a"), "postings", "lead", F.col("only_brand").alias("brand_a"),
        F.col("others").alias("others_a"), "wide", F.col("cluster").alias("cluster_a"))
    fb = features.filter(F.col("side") == "match").select(
        F.col("profile").alias("b"), "ingredient", F.col("u").alias("ub"), head.alias("head_b"),
        F.col("tail").alias("tail_b"), "postings", "lead_brand", F.col("only_brand").alias("brand_b"),
        F.col("others").alias("others_b"), F.col("cluster").alias("cluster_b"))
    return fa, fb


def _may_answer() -> Column:
    """Not two profiles of one and the same brand."""
    return F.coalesce(F.col("brand_a") != F.col("brand_b"), F.lit(True))


def exact_scores(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """Cosine of given distinct (a, b) pairs; keeps the other columns of ``pairs``. Of each pair, the profile with
    fewer features looks up the other's."""
    fa, fb = (f.select(x, "ingredient", f"u{x}") for x, f in zip("ab", _sides(features), strict=True))
    extra = [c for c in pairs.columns if c not in ("a", "b")]
    # Written first, so that features of other profiles go before any shuffle where the pairs are few.
    pairs = materialise(pairs, "pairs")
    fa = fa.join(pairs.select("a").distinct(), "a", "left_semi")
    fb = fb.join(pairs.select("b").distinct(), "b", "left_semi")

    def sizes(f: DataFrame, x: str) -> DataFrame:
        return f.groupBy(x).agg(F.count(F.lit(1)).cast("int").alias(f"n{x}"))

    sized = materialise(pairs.join(sizes(fa, "a"), "a").join(sizes(fb, "b"), "b").select(
        "a", "b", *extra, (F.col("na") <= F.col("nb")).alias("by_a")), "sized", by="by_a")
    by_a = sized.filter("by_a").join(fa, "a").join(fb, ["b", "ingredient"])
    by_b = sized.filter("NOT by_a").join(fb, "b").join(fa, ["a", "ingredient"])
    return by_a.unionByName(by_b).groupBy("a", "b", *extra).agg(F.sum(F.col("ua") * F.col("ub")).alias("similarity"))


def query_floors(vectors: Vectors, reps: DataFrame, n: int, ceiling: float, wide_only: bool = False) -> DataFrame:
    """a, floor: a score that the n-th answer of every product of profile ``a``
    reaches for certain; 0 where fewer than n answers were met. With ``wide_only``, profiles
    without a long list get none."""
    fa, fb = _sides(vectors.features)
    fa = materialise(fa.filter("lead").filter(F.lit(not wide_only) | F.col("wide")), "leads")
    if fa.isEmpty():
        return fa.select("a", F.lit(0.0).alias("floor"))
    fb = fb.join(fa.select("ingredient").distinct(), "ingredient", "left_semi")
    strongest_first = [F.desc("ub"), "b"]
    by_brand = W.partitionBy("ingredient", "lead_brand").orderBy(*strongest_first)
    overall = W.partitionBy("ingredient").orderBy(*strongest_first)
    strongest = fb.withColumn("r", F.row_number().over(by_brand)).filter(F.col("r") <= n)
    if vectors.clusters is not None:  # then n of one cluster may be beyond the ceiling, too
        one = F.coalesce(F.col("cluster_b").cast("string"), F.concat(F.lit("b"), F.col("b").cast("string")))
        by_cluster = W.partitionBy("ingredient", one).orderBy(*strongest_first)
        strongest = strongest.withColumn("r", F.row_number().over(by_cluster)).filter(F.col("r") <= n)
    most = 2 * n if vectors.clusters is None else 3 * n
    strongest = (
        strongest.withColumn("r", F.row_number().over(overall)).filter(F.col("r") <= most)
        .select("ingredient", "b", "ub", "brand_b", "cluster_b")
    )
    # Of the 2n, n per brand, n at least are of another brand than the query's; of 3n, n
    # per cluster as well, n at least are of another cluster, too.
    seeds = (
        fa.join(strongest, "ingredient").filter(_may_answer())
        .filter(F.coalesce(F.col("cluster_a") != F.col("cluster_b"), F.lit(True)))
        .groupBy("a", "b").agg(F.sum(F.col("ua") * F.col("ub")).alias("met"))
        .withColumn("r", F.row_number().over(W.partitionBy("a").orderBy(F.desc("met"), "b")))
        .filter(F.col("r") <= 2 * n).select("a", "b")
    )
    return exact_floors(seeds, vectors, reps, n, ceiling)


def exact_floors(seeds: DataFrame, vectors: Vectors, reps: DataFrame, n: int, ceiling: float) -> DataFrame:
    """The floor that the exact scores of the given distinct (a, b) pairs, which ``_may_answer``, prove."""
    if vectors.single:  # then each pair is one answer, and no brand is looked up
        place = F.row_number().over(W.partitionBy("a").orderBy(F.desc("similarity")))
        return (
            exact_scores(seeds, vectors.features).filter(F.col("similarity") < ceiling - SLACK)
            .withColumn("r", place).filter(F.col("r") <= n).groupBy("a")
            .agg(F.when(F.count(F.lit(1)) == n, F.min("similarity")).otherwise(0.0).alias("floor"))
        )
    brands = vectors.members.filter(F.col("side") == "query").select(
        F.col("profile").alias("a"), "brand").distinct()
    return (
        exact_scores(seeds, vectors.features)
        .filter(F.col("similarity") < ceiling - SLACK)
        .join(reps, "b")
        .join(brands, "a")
        .withColumn("met", F.col("match_brand") != F.col("brand"))
        .withColumn("r", F.row_number().over(
            W.partitionBy("a", "brand").orderBy(F.desc("met"), F.desc("similarity"))))
        .filter(F.col("r") <= n)
        .groupBy("a", "brand")
        .agg(F.when(F.count_if("met") == n, F.min("similarity")).otherwise(0.0).alias("floor"))
        .groupBy("a").agg(F.min("floor").alias("floor"))
    )


def _band(norm: Column) -> Column:
    return F.greatest(F.lit(0), F.floor(F.log2(norm) * HALVED_IN).cast("int") + BANDS)  # of 0, too


def _probes(fa: DataFrame, floors: DataFrame | None, floor: float | None) -> DataFrame:
    if floors is None:
        return fa.withColumn("floor", F.lit(float(floor)))
    return fa.join(floors, "a", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))


def compared_clusters(vectors: Vectors, floors: DataFrame, ceiling: float) -> DataFrame | None:
    """State of the cluster pairs, see ``clusters.compare``."""
    if vectors.clusters is None:
        return None
    fa, fb = _sides(vectors.features)
    return tight.compare(_probes(fa, floors, None), fb, vectors.clusters, ceiling)


def met_pairs(features: DataFrame, floors: DataFrame | None = None, floor: float | None = None,
              same_brand: bool = True, compared: DataFrame | None = None,
              n: int | None = None, ceiling: float | None = None) -> DataFrame:
    """a, b, floor, similarity so far, and the most that ``rest`` can still add, for
    every profile pair that may reach its floor; with ``n`` also ``rank``, see ``narrow_pairs``, and floors that
    the pairs themselves prove (``_proven``).

    ``floors`` holds a floor per query profile (missing = 0); ``floor`` is one for
    all. Without ``same_brand`` two profiles of one brand form no pair. Long posting
    lists are split into bands of the remaining norm, and a query
    opens only the bands that can reach its floor, so the equality join itself
    skips the rest of the list. Hot (ingredient, band) keys are left to the
    skew-join rule, which splits both sides without replicating writes. Members of two
    clusters meet only if ``compared`` has the clusters as open. With ``n`` and
    ``ceiling``, queries without a long list go by ``narrow_pairs``.
    """
    fa, fb = _sides(features)
    narrow = None if n is None else narrow_pairs(fa.filter("NOT wide"), fb, n, ceiling)
    if narrow is not None:
        fa = fa.filter("wide")
    short = F.col("postings") <= SHORT_LIST
    banded = F.col("postings") > BANDED_LENGTH
    needed = F.greatest(F.lit(0.0), F.col("floor") / F.col("head_a") - SLACK)
    probes = (
        _probes(fa, floors, floor).filter(short | (F.col("head_a") * (1 + SLACK) >= F.col("floor") - SLACK))
        .withColumn("band", F.explode(F.when(
            banded, F.sequence(F.least(_band(needed), F.lit(BANDS)), F.lit(BANDS)),
        ).otherwise(F.array(F.lit(0)))))
        .select("a", "brand_a", "cluster_a", "ingredient", "band", "ua", "head_a", "tail_a", "floor", "others_a",
                short.alias("short"))
    )
    if narrow is not None:  # the others may be few, and then no list need be dealt out for them
        probes = materialise(probes, "probes")
    postings = fb.withColumn(
        "band", F.when(banded, F.least(_band(F.col("head_b") + SLACK), F.lit(BANDS))).otherwise(0)
    ).select("b", "brand_b", "cluster_b", "ingredient", "band", "ub", "head_b", "tail_b", "others_b")
    met = (
        _meeting(probes, postings, compared).filter(F.lit(same_brand) | _may_answer())
        .filter(F.col("short") | (F.col("ua") * F.col("ub") + F.col("tail_a") * F.col("tail_b") >= F.col("floor") - SLACK))
        .filter((F.col("others_a").bitwiseAND(F.col("others_b")) != 0)
                | (F.col("ua") * F.col("ub") >= F.col("floor") - SLACK))
        .select("a", "b", (F.col("ua") * F.col("ub")).alias("part"), (F.col("tail_a") * F.col("tail_b")).alias("rest"), "floor",
                (F.col("brand_a").isNotNull() | F.col("brand_b").isNull()).alias("serves"))
    )
    # Dealt by query, whose pairs then are ranked where they are summed. A list that stays shut, and all that are more
    # common, add less than the floor; without a floor none does.
    floor = F.first("floor")
    met = (
        met.repartition("a").groupBy("a", "b")
        .agg(F.sum("part").alias("similarity"),
             F.when(floor > 0, F.least(F.min("rest"), floor + SLACK)).otherwise(0.0).alias("rest"),
             floor.alias("floor"), F.first("serves").alias("serves"))
        .filter(F.col("similarity") + F.col("rest") >= F.col("floor") - SLACK)
    )
    met = met.drop("serves") if n is None else _proven(met, n, ceiling)
    if narrow is not None:
        met = met.withColumn("rank", F.lit(None).cast("int")).unionByName(narrow)
    return materialise(met, "met")


def _proven(met: DataFrame, n: int, ceiling: float) -> DataFrame:
    """``met``, which lies by ``a``, without what cannot reach the n-th best score so far of pairs that are answers for
    certain: below the ceiling whatever is still to come, and of another brand for every member of the query."""
    certain = F.col("serves") & (F.col("similarity") + F.col("rest") < ceiling - SLACK)
    place = F.row_number().over(W.partitionBy("a").orderBy(F.desc("certain"), F.desc("similarity")))
    nth = F.max(F.when(F.col("certain") & (F.col("r") == n), F.col("similarity"))).over(W.partitionBy("a"))
    return (
        met.withColumn("certain", certain).withColumn("r", place).withColumn("floor", F.greatest("floor", nth))
        .filter(F.col("similarity") + F.col("rest") >= F.col("floor") - SLACK).drop("serves", "certain", "r")
    )


def narrow_pairs(fa: DataFrame, fb: DataFrame, n: int, ceiling: float) -> DataFrame:
    """a, b, similarity, rest (0), floor (0), rank for profiles whose lists are all short.

    What shares one ingredient alone and has n certain answers before it in that very
    list is no answer: those share the ingredient with more weight, are of another brand
    and below the ceiling. So most rows go where the list is opened. A profile that has
    fewer than n answers keeps all its pairs. Rows are dealt by query, each of which has
    at most ``SHORT_LIST`` per ingredient, and their sums and ranks need no other shuffle.
    ``rank`` is the place among the answers of a query profile of one brand, else 0. Brands are hashed
    before they are shuffled, and lists are dealt row by row: few rows of a task share one.
    """
    def hashed(brand: str) -> Column:
        return F.when(F.col(brand).isNotNull(), F.xxhash64(brand)).alias(brand)

    lists = fb.filter(F.col("postings") <= SHORT_LIST).select("ingredient", "ub", "b", "others_b", hashed("brand_b"))
    lists = lists.repartition("ingredient").groupBy("ingredient").agg(F.sort_array(F.collect_list(
        F.struct("ub", "b", "brand_b", "others_b")), asc=False).alias("held"))
    fa = fa.select("ingredient", "ua", "a", "others_a", hashed("brand_a"))
    ua = F.col("ua")

    def alone(x: Column) -> Column:
        return F.col("others_a").bitwiseAND(x["others_b"]) == 0

    def may_answer(x: Column) -> Column:
        return F.coalesce(F.col("brand_a") != x["brand_b"], F.lit(True))

    def below_ceiling(x: Column) -> Column:
        rest = F.sqrt(F.greatest(F.lit(0.0), (1 - ua * ua) * (1 - x["ub"] * x["ub"])))
        return ua * x["ub"] + F.when(alone(x), 0.0).otherwise(rest) < ceiling - SLACK

    answers = F.filter(F.slice("held", 1, 2 * n), below_ceiling)  # in order, so the first are enough
    opened = (
        fa.join(lists, "ingredient").withColumn("held", F.filter("held", may_answer))
        .withColumn("least", F.when(F.col("brand_a").isNotNull(), F.get(answers, F.lit(n - 1))["ub"]))
        .withColumn("least", F.coalesce(F.col("least") - SLACK, F.lit(-1.0)))
        .withColumn("x", F.explode(F.filter("held", lambda x: (x["ub"] >= F.col("least")) | ~alone(x))))
        .select("a", (ua * F.col("x.ub")).alias("part"), F.col("x.b").alias("b"),
                F.col("brand_a").isNotNull().alias("sole"))
    )
    scored = opened.repartition("a").groupBy("a", "b").agg(
        F.sum("part").alias("similarity"), F.first("sole").alias("sole")).withColumn(
        "counts", F.col("sole") & (F.col("similarity") < ceiling))
    place = F.row_number().over(W.partitionBy("a").orderBy(F.desc("counts"), F.desc(tie_key("similarity")), "b"))
    nth = F.max(F.when(F.col("counts") & (F.col("r") == n), F.col("similarity"))).over(W.partitionBy("a"))
    return (
        scored.withColumn("r", place).withColumn("least", F.coalesce(nth - SLACK, F.lit(-1.0)))
        .filter(F.col("similarity") >= F.col("least"))
        .select("a", "b", "similarity", F.lit(0.0).alias("rest"), F.lit(0.0).alias("floor"),
                F.when(F.col("counts"), F.col("r")).otherwise(0).alias("rank"))
    )


def _meeting(probes: DataFrame, postings: DataFrame, compared: DataFrame | None) -> DataFrame:
    """Probes joined with the postings they open. With clusters: the loose profiles with
    everything, the clusters with loose profiles and with the clusters open to them."""
    if compared is None:
        return probes.join(postings, ["ingredient", "band"])
    loose_a, loose_b = F.col("cluster_a").isNull(), F.col("cluster_b").isNull()
    is_open = compared.filter("state = 'open'").select(F.col("ca").alias("cluster_a"), F.col("cb").alias("cluster_b"))
    parts = (
        probes.filter(loose_a).join(postings, ["ingredient", "band"]),
        probes.filter(~loose_a).join(postings.filter(loose_b), ["ingredient", "band"]),
        probes.filter(~loose_a).join(is_open, "cluster_a").join(
            postings.filter(~loose_b), ["ingredient", "band", "cluster_b"]),
    )
    first, *others = (p.drop("cluster_a", "cluster_b") for p in parts)
    for other in others:
        first = first.unionByName(other)
    return first


def raise_floors(met: DataFrame, vectors: Vectors, reps: DataFrame, n: int, ceiling: float) -> DataFrame:
    """Drop pairs that cannot reach the n-th best exact score among the pairs that
    already score most. Worth its small cost only where scores are still open."""
    if met.filter(~_complete()).isEmpty():
        return met
    best = W.partitionBy("a").orderBy(F.desc("similarity"), "b")
    seeds = met.filter("floor > 0").withColumn("r", F.row_number().over(best)).filter(F.col("r") <= 4 * n)
    higher = materialise(exact_floors(seeds.select("a", "b"), vectors, reps, n, ceiling), "floors")
    return (
        met.join(higher.withColumnRenamed("floor", "higher"), "a", "left")
        .withColumn("floor", F.greatest("floor", F.coalesce("higher", F.lit(0.0))))
        .drop("higher")
        .filter(F.col("similarity") + F.col("rest") >= F.col("floor") - SLACK)
    )


def settle(met: DataFrame, features: DataFrame) -> DataFrame:
    """Exact a, b, similarity of the pairs in ``met`` that do reach their floor."""
    done = _complete()
    rescored = exact_scores(met.filter(~done).select("a", "b", "floor"), features)
    return (
        met.filter(done).select("a", "b", "floor", "similarity")
        .unionByName(rescored)
        .filter(F.col("similarity") >= F.col("floor") - SLACK)
        .select("a", "b", "similarity")
    )


def _complete() -> Column:
    """No norm remains unmet, or the floor shut no list."""
    return (F.col("rest") <= 0) | (F.col("floor") <= 0)


def cosine_pairs(weighted: DataFrame, products: DataFrame, floor: float) -> DataFrame:
    """All cross-source product pairs whose cosine is at least ``floor`` (> 0)."""
    if floor <= 0:
        raise ValueError("a positive floor is required: zero would list every pair")
    vectors = build_vectors(weighted, products)
    met = met_pairs(vectors.features, floor=floor)
    pairs = settle(met, vectors.features).filter(F.col("similarity") >= floor)
    query = vectors.members.filter(F.col("side") == "query").select(
        F.col("profile").alias("a"), F.col("product_id").alias("query_id"))
    match = vectors.members.filter(F.col("side") == "match").select(
        F.col("profile").alias("b"), F.col("product_id").alias("match_id"))
    return pairs.join(query, "a").join(match, "b").select("query_id", "match_id", "similarity")


def _ranked(query: list[str], n: int) -> tuple[Column, Column]:
    order = [F.desc(tie_key("similarity")), F.col("match_id")]
    return (F.row_number().over(W.partitionBy(*query, "match_brand").orderBy(*order)),
            F.row_number().over(W.partitionBy(*query).orderBy(*order)))


def rank_matches(weighted: DataFrame | Callable[[DataFrame], DataFrame], products: DataFrame, n: int = TOP_N,
                 ceiling: float = SAME_PRODUCT, pad_zero: bool = True) -> DataFrame:
    """query_id, match_id, similarity, rank (1..n). ``weighted`` may be a function of the
    products, which then can count the lists where it counts frequencies.

    Skips pairs at or above ``ceiling`` and pairs of one brand; neither uses up a
    rank. With ``pad_zero`` a product with fewer than n positive matches is filled
    up with the lowest-id products it has nothing in common with.
    """
    products = materialise(products.select("product_id", "side", "brand"), "products", by="side")
    weighted = weighted if isinstance(weighted, DataFrame) else weighted(products)
    vectors = build_vectors(weighted, products, same_brand=False, ceiling=ceiling)
    reps = own_members(vectors) if vectors.single else materialise(representatives(vectors.members, n), "representatives")
    floors = query_floors(vectors, reps, n, ceiling, wide_only=True)
    compared = compared_clusters(vectors, floors, ceiling)
    met = met_pairs(vectors.features, floors, same_brand=False, compared=compared, n=n, ceiling=ceiling)
    rank = _rank_products if vectors.single else _rank_members
    ranked = rank(met, vectors, reps, n, ceiling)
    if not pad_zero:
        return ranked
    if not vectors.single:
        ranked = materialise(ranked, "ranked")
    return ranked.unionByName(_zero_padding(ranked, met, compared, reps, vectors, products, n))


def own_members(vectors: Vectors) -> DataFrame:
    """``representatives`` where every match profile is one product."""
    return vectors.members.filter(F.col("side") == "match").select(
        F.col("profile").alias("b"), F.col("product_id").alias("match_id"), F.col("brand").alias("match_brand"))


def _rank_products(met: DataFrame, vectors: Vectors, reps: DataFrame, n: int, ceiling: float) -> DataFrame:
    """The first n answers where every profile is one product: no pair is of one brand, and pairs of short lists
    have their ranks already, so nothing is looked up or shuffled again."""
    answer = [F.col("a").alias("query_id"), F.col("b").alias("match_id"), "similarity", "rank"]
    ranked = met.filter(F.col("rank").between(1, n)).select(*answer)
    wide = met.filter(F.col("rank").isNull())
    if wide.isEmpty():
        return ranked
    pairs = settle(raise_floors(wide.drop("rank"), vectors, reps, n, ceiling), vectors.features)
    place = F.row_number().over(W.partitionBy("a").orderBy(F.desc(tie_key("similarity")), "b"))
    return ranked.unionByName(materialise(
        pairs.filter(F.col("similarity") < ceiling).withColumn("rank", place).filter(F.col("rank") <= n).select(*answer), "ranked"))


def _rank_members(met: DataFrame, vectors: Vectors, reps: DataFrame, n: int, ceiling: float) -> DataFrame:
    """The first n answers of every member of the query profiles."""
    pairs = settle(raise_floors(met, vectors, reps, n, ceiling), vectors.features)
    queries = vectors.members.filter(F.col("side") == "query").select(
        F.col("profile").alias("a"), F.col("product_id").alias("query_id"), "brand")
    # Profiles of more members or of more than a few pairs.
    large = materialise(
        queries.filter(F.col("a") != F.col("query_id")).select("a").unionByName(
            vectors.features.filter("wide AND lead AND side = 'query'").select(F.col("profile").alias("a"))).distinct(),
        "large")
    answers = pairs.filter(F.col("similarity") < ceiling).join(reps, "b")
    per_brand, overall = _ranked(["a"], n)
    shortlist = (
        answers.join(large, "a", "left_semi")
        .withColumn("r", per_brand).filter(F.col("r") <= n)
        .withColumn("r", overall).filter(F.col("r") <= 2 * n)
        .select("a", "match_id", "match_brand", "similarity")
    )

    def best(found: DataFrame, query: str) -> DataFrame:
        place = F.row_number().over(W.partitionBy(query).orderBy(F.desc(tie_key("similarity")), "match_id"))
        return (found.filter(F.col("brand") != F.col("match_brand"))
                .withColumn("rank", place).filter(F.col("rank") <= n)
                .select("query_id", "match_id", "similarity", "rank"))

    # The only member of the others is the profile itself: the join deals them for the rank, too.
    return best(queries.join(shortlist, "a"), "query_id").unionByName(
        best(queries.join(large, "a", "left_anti").join(answers, "a"), "a"))


def _zero_padding(ranked: DataFrame, met: DataFrame, compared: DataFrame | None, reps: DataFrame,
                  vectors: Vectors, products: DataFrame, n: int) -> DataFrame:
    """Rows of similarity 0 for products with fewer than n positive matches.

    A short product must skip its own brand and the e profiles it scores with, so it
    needs no more than the first 2(n + 2ne) match products under a limit of
    n + 2ne per brand. Products are put in classes of that need (powers of two) and
    each class reads one small table of exactly that length. What all products of a
    cluster score with is left out of a table of the cluster's own.
    """
    keyed = products.select("product_id", "side", brand_key("brand").alias("brand"))
    # Written first, so that of the others nothing is counted or looked up.
    lacking = materialise(
        keyed.filter(F.col("side") == "query").select(F.col("product_id").alias("query_id"), "brand")
        .join(ranked.filter(F.col("rank") == n).select("query_id"), "query_id", "left_anti"), "lacking")
    asking = lacking.select("query_id")
    ranks = ranked.join(asking, "query_id", "left_semi").groupBy("query_id").agg(
        F.count(F.lit(1)).cast("int").alias("have"))
    profile_of = vectors.members.filter(F.col("side") == "query").select(
        F.col("product_id").alias("query_id"), F.col("profile").alias("a")).join(asking, "query_id", "left_semi")
    short = materialise(
        lacking.join(ranks, "query_id", "left").withColumn("have", F.coalesce("have", F.lit(0)))
        .join(profile_of, "query_id", "left"), "lacking")
    kinds = short.filter(F.col("a").isNotNull()).select("a", "brand").distinct()
    # Pairs of one brand are not in ``met`` and need no exclusion: the brand excludes them.
    excluded = met.filter("floor <= 0").select("a", "b").join(kinds, "a")
    if not vectors.single:
        excluded = excluded.join(reps, "b").filter(F.col("match_brand") != F.col("brand"))
    excluded = materialise(excluded.select("a", "brand", "b").distinct(), "excluded")
    need = excluded.groupBy("a", "brand").agg(F.count(F.lit(1)).alias("e"))
    size_class = F.ceil(F.log2(1 + 2 * F.coalesce("e", F.lit(0)))).cast("int")
    short = short.join(need, ["a", "brand"], "left").withColumn("size_class", size_class)
    if vectors.clusters is None:
        short = short.withColumn("cluster", F.lit(LOOSE).cast("long"))
    else:
        of_query = vectors.clusters.members.filter(F.col("side") == "query").select(F.col("profile").alias("a"), "cluster")
        short = short.join(of_query, "a", "left").withColumn("cluster", F.coalesce("cluster", F.lit(LOOSE)))
    short = materialise(short.select("query_id", "a", "brand", "have", "size_class", "cluster"), "short")

    classes = sorted(r[0] for r in short.select("size_class").distinct().collect())
    if not classes:
        return ranked.limit(0)
    idle = (
        keyed.filter(F.col("side") == "match").select("product_id", "brand")
        .join(vectors.members.filter(F.col("side") == "match").select("product_id"),
              "product_id", "left_anti")
        .select(F.lit(None).cast(products.schema["product_id"].dataType).alias("b"), F.col("product_id").alias("match_id"),
                F.col("brand").alias("match_brand"))
    )
    pool = materialise(add_places(reps.unionByName(idle), ["match_id"], {"in_brand": ["match_brand"]}, "pool"), "placed")
    shunned = None
    if vectors.clusters is not None:
        shunned = materialise(
            compared.filter("state = 'above'").select(F.col("ca").alias("cluster"), F.col("cb").alias("other"))
            .join(vectors.clusters.members.filter(F.col("side") == "match").select(
                F.col("cluster").alias("other"), F.col("profile").alias("b")), "other")
            .join(pool, "b").select("cluster", "match_brand", F.col("in_brand").alias("place")), "shunned")
    lists = None
    for c in classes:  # at most log2(products) rounds, in practice one or two
        here = short.filter(F.col("size_class") == c).select("cluster").distinct()
        first = _first_places(pool, here, shunned, n * 2 ** c).withColumn("size_class", F.lit(c))
        lists = first if lists is None else lists.unionByName(first)
    place = F.row_number().over(W.partitionBy("query_id").orderBy("match_id"))
    return (
        short.join(materialise(lists, "lists"), ["size_class", "cluster"]).filter(F.col("brand") != F.col("match_brand"))
        .join(excluded, ["a", "brand", "b"], "left_anti")
        .withColumn("r", place).filter(F.col("r") <= n)
        .filter(F.col("r") <= n - F.col("have"))
        .select("query_id", "match_id", F.lit(0.0).alias("similarity"),
                (F.col("have") + F.col("r")).cast("int").alias("rank"))
    )


#: Stands for no cluster.
LOOSE = 0


def _first_places(pool: DataFrame, asking: DataFrame, shunned: DataFrame | None, per_brand: int) -> DataFrame:
    """cluster, b, match_id, match_brand: the first 2 * ``per_brand`` products, at most
    ``per_brand`` of a brand, without those that the cluster in ``asking`` shuns.

    A cluster's table differs from that of all only in the brands of what it shuns, so
    the work per cluster is in proportion to that. Numbers of free places come from
    the shunned ones (``free_places``); no brand and no table is counted through.
    """
    columns = ("cluster", "b", "match_id", "match_brand")
    limited = materialise(add_places(pool.filter(F.col("in_brand") <= per_brand), ["match_id"], {"place": []}, "limited"),
                          "first")
    everyone = limited.filter(F.col("place") <= 2 * per_brand).withColumn("cluster", F.lit(LOOSE).cast("long"))
    if shunned is None:
        return everyone.select(*columns)
    asking = asking.filter(F.col("cluster") != LOOSE)
    blocked = shunned.join(asking, "cluster", "left_semi")
    brands = blocked.select("cluster", "match_brand").distinct()

    def numbers(upto: int) -> Column:
        return F.explode(F.sequence(F.lit(1), F.lit(upto))).alias("nth")

    own = free_places(blocked, brands.select("cluster", "match_brand", numbers(per_brand)), ["cluster", "match_brand"])
    own = own.withColumnRenamed("place", "in_brand").join(pool, ["match_brand", "in_brand"])
    common = free_places(
        brands.join(limited.select("match_brand", "place"), "match_brand").select("cluster", "place"),
        asking.select("cluster", numbers(2 * per_brand)), ["cluster"]).join(limited, "place")
    both = own.select(*columns).unionByName(common.select(*columns))
    order = F.row_number().over(W.partitionBy("cluster").orderBy("match_id"))
    return everyone.select(*columns).unionByName(
        both.withColumn("r", order).filter(F.col("r") <= 2 * per_brand).select(*columns))
