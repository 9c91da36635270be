"""Fields from HTML pages as a Spark job over a (url, html) table.

Text of nested elements needs a real parser, so the pages go through
``mapInPandas`` in Arrow batches: Spark partitions the pages, a small standard
library parser reads one at a time. Everything after the raw text (ratings,
prices, names, links) is done by column functions, and fields anchored on one
attribute (``attribute_values``, ``link_targets``) never leave the JVM.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.text import strip
from kindred.sources.tables import require_columns

# Fixed values of HTML: elements without content, and those whose text is not shown.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset(("script", "style", "template"))
#: Rows handed back at once.
ROWS_OUT = 1000


@dataclass(frozen=True)
class Find:
    """First element by tag and one attribute; ``how``: equals, contains or word."""

    tag: str | None = None
    attr: str | None = None
    value: str | None = None
    how: str = "equals"

    def fits(self, tag: str, attrs: dict[str, str]) -> bool:
        if self.tag and tag != self.tag:
            return False
        if not self.attr:
            return True
        have = attrs.get(self.attr)
        if have is None:
            return False
        if self.value is None or self.how == "equals":
            return self.value is None or have == self.value
        return self.value in (have.split() if self.how == "word" else have)


@dataclass(frozen=True)
class Field:
    """How to read one field: follow ``path``, prefer ``inner`` inside it.

    Text nodes are stripped and joined by nothing if ``inner`` was found, else by
    ``joiner``. ``attribute`` is preferred to the text (``only_attribute``: without
    the text as substitute). ``every`` lists all matches of the last step.
    """

    name: str
    path: tuple[Find, ...]
    inner: Find | None = None
    joiner: str = ""
    strip: bool = True
    attribute: str | None = None
    only_attribute: bool = False
    every: bool = False
    missing: str | None = ""
    otherwise: tuple[Find, ...] | None = None
    otherwise_first: Find | None = None


class _Page(HTMLParser):
    """A page as two flat lists: text nodes, and elements with the range of text
    nodes and elements they span."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.elements: list[list] = [["", {}, 0, None, None]]
        self._open = [0]
        self._open_tags: Counter[str] = Counter()
        self._joined = False
        self.feed(html)
        self.close()
        while self._open:
            self._shut()

    def _shut(self) -> None:
        element = self.elements[self._open.pop()]
        element[3], element[4] = len(self.texts), len(self.elements)
        self._open_tags[element[0]] -= 1

    def handle_starttag(self, tag, attrs):
        self._joined = False
        named = {name: value or "" for name, value in attrs}
        self.elements.append([tag, named, len(self.texts), None, None])
        self._open.append(len(self.elements) - 1)
        self._open_tags[tag] += 1
        if tag in VOID:
            self._shut()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._shut()

    def handle_endtag(self, tag):
        self._joined = False
        if self._open_tags[tag] > 0:
            while self.elements[self._open[-1]][0] != tag:
                self._shut()
            self._shut()

    def handle_comment(self, data):
        self._joined = False

    def handle_data(self, data):
        if self.elements[self._open[-1]][0] in UNSEEN:
            return
        if self._joined:
            self.texts[-1] += data
        else:
            self.texts.append(data)
        self._joined = True

    def all(self, find: Find, inside: int = 0) -> list[int]:
        return [i for i in range(inside + 1, self.elements[inside][4])
                if find.fits(self.elements[i][0], self.elements[i][1])]

    def first(self, find: Find, inside: int = 0) -> int | None:
        for i in range(inside + 1, self.elements[inside][4]):
            if find.fits(self.elements[i][0], self.elements[i][1]):
                return i
        return None

    def text(self, element: int, joiner: str, stripped: bool) -> str:
        parts = self.texts[self.elements[element][2]:self.elements[element][3]]
        if stripped:
            parts = [p for p in (t.strip() for t in parts) if p]
        return joiner.join(parts)

    def follow(self, path: Sequence[Find], inside: int, otherwise_first: Find | None = None):
        at: int | None = inside
        for step, find in enumerate(path):
            below = self.first(find, at)
            if below is None and step == 0 and otherwise_first is not None:
                below = self.first(otherwise_first, at)
            if below is None:
                return None
            at = below
        return at

    def read(self, field: Field, inside: int = 0):
        if field.every:
            at = self.follow(field.path[:-1], inside)
            found = [] if at is None else self.all(field.path[-1], at)
            return [self.elements[i][1].get(field.attribute, "") for i in found]
        at = self.follow(field.path, inside, field.otherwise_first)
        if at is None and field.otherwise is not None:
            at = self.follow(field.otherwise, inside)
        if at is None:
            return field.missing
        if field.attribute:
            value = self.elements[at][1].get(field.attribute)
            if value or field.only_attribute:
                return value
        inner = self.first(field.inner, at) if field.inner else None
        if inner is not None:
            return self.text(inner, "", field.strip)
        return self.text(at, field.joiner, field.strip)


def _schema(keys: T.StructType, fields: Sequence[Field], extra: Sequence[T.StructField]):
    texts = T.ArrayType(T.StringType())
    return T.StructType([
        *keys.fields,
        *[T.StructField(f.name, texts if f.every else T.StringType()) for f in fields],
        *extra,
    ])


def extract(pages: DataFrame, fields: Sequence[Field], html: str = "html",
            each: Find | None = None, within: Find | None = None) -> DataFrame:
    """One row per page, or with ``each`` one per matching element (in ``within`` if
    given), holding the other columns of ``pages`` and the fields.

    A page that cannot be read yields one row of empty fields with a ``page_error``
    (and, with ``each``, no item number), never a failed job.
    """
    keys = T.StructType([f for f in pages.schema if f.name != html])
    names = [f.name for f in keys]
    extra = [T.StructField("item_no", T.IntegerType())] if each else []
    extra.append(T.StructField("page_error", T.StringType()))
    schema = _schema(keys, fields, extra)
    empty = [[] if f.every else f.missing for f in fields]

    def rows_of(source: str | None) -> list[list]:
        try:
            page = _Page(source or "")
            if each is None:
                return [[page.read(f) for f in fields] + [None]]
            root = page.first(within) if within else 0
            if root is None:
                return []
            return [[page.read(f, at) for f in fields] + [no, None]
                    for no, at in enumerate(page.all(each, root), 1)]
        except Exception as error:  # a broken page must not stop the others
            return [[*empty, *([None] if each else []), f"{type(error).__name__}: {error}"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for values in zip(batch[html], *[batch[n] for n in names]):
                out += [[*values[1:], *row] for row in rows_of(values[0])]
                if len(out) >= ROWS_OUT:
                    yield pd.DataFrame(out, columns=schema.fieldNames(), dtype=object)
                    out = []
            yield pd.DataFrame(out, columns=schema.fieldNames(), dtype=object)

    return pages.select(*names, html).mapInPandas(run, schema)


#: Comments, scripts and styles (also unclosed ones), an opening tag, one attribute of it.
UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
OPENING_TAG = r"""<%s(?=[\s/>])(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
ATTRIBUTE = r"""[^\s"'<>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>]++))?"""
#: Named character references that attributes commonly hold; the last one
#: must come last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", "\xa0"), ("&amp;", "&"))


def attribute_values(html: Column, attr: str, tag: str | None = None) -> Column:
    """All non-empty values of one attribute in document order, read inside the JVM.

    Only attributes of opening tags (of ``tag``, if given) count, whatever way they are
    quoted; comments, scripts, other attributes' names and values do not.
    """
    opening = r"(?i)" + OPENING_TAG % (tag or "[a-z][^\\s/<>]*+")
    tags = F.regexp_extract_all(F.regexp_replace(html, UNREAD, ""), F.lit(opening), F.lit(0))
    named = F.flatten(F.transform(tags, lambda t: F.regexp_extract_all(
        F.regexp_replace(t, r"\A<[^\s/>]*+", ""), F.lit(ATTRIBUTE), F.lit(0))))
    own = F.filter(named, lambda a: a.rlike(rf"(?i)\A{attr}\s*="))
    values = F.transform(own, lambda a: _decoded(F.regexp_replace(
        F.regexp_replace(a, r"\A[^=]*+=\s*", ""), r"""\A"|\A'|"\z|'\z""", "")))
    return F.filter(values, lambda v: v != "")


def _decoded(value: Column) -> Column:
    for entity, character in ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(character))
    return value


def attribute_inventory(pages: DataFrame, attr: str) -> DataFrame:
    """Distinct values of an attribute over all pages with their counts, sorted."""
    return (pages.select(F.explode(attribute_values(F.col("html"), attr)).alias("value"))
            .groupBy("value").agg(F.count(F.lit(1)).alias("uses")).orderBy("value"))


def work_list(df: DataFrame, column: str) -> DataFrame:
    """The links to visit: present, stripped, not empty."""
    require_columns(df, [column])
    return df.select(strip(F.col(column)).alias(column)).filter(F.col(column) != "")


def outcome(extracted: DataFrame) -> DataFrame:
    """``ok``: whether any of brand, name and ingredients was found; ``failed``: whether
    the page could not be read at all."""
    found = F.lit(False)
    for name in ("brand", "product_name", "ingredients"):
        found = found | (F.coalesce(F.col(name), F.lit("")) != "")
    failed = F.col("page_error").isNotNull() if "page_error" in extracted.columns else F.lit(False)
    return extracted.withColumns({"ok": found & ~failed, "failed": failed})
