"""Scans and sinks of the stages: bronze CSV, silver, gold and serving tables."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred import schemas, session

#: Published versions that stay, for readers that began with the one before.
KEPT_VERSIONS = 2


def publish(df: DataFrame, path: str, check: Callable[[DataFrame], object] | None = None,
            by: str | None = None) -> None:
    """Store ``df`` as the new version of the table at ``path``.

    The files of a version stay where they are written, in a folder of their own. The
    version exists from the moment its manifest does: a small file with the names of
    the data files, the row count and the version's number, written last, after the
    check. No file is renamed, so object stores keep the promise as well. Numbers
    follow the manifests present at that moment, not a clock; of two writers that take
    the same number, the folder's name decides. Whatever has no whole manifest (a
    writer at work, or one that broke off) is no version.
    """
    spark, folder = df.sparkSession, f"{path}/v-{uuid.uuid4().hex}"
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(folder)
        stored = spark.read.schema(df.schema).parquet(folder)
        if check is not None:
            check(stored)
        rows = stored.count()
        files = [f for f in session.files_below(spark, folder) if f.endswith(".parquet")]
        number = max((v.number for v in versions(spark, path)), default=0) + 1
        session.write_new(spark, f"{folder}/{MANIFEST}", _manifest(number, rows, files))
    except BaseException:
        session.remove(spark, folder)
        raise
    for old in versions(spark, path)[:-KEPT_VERSIONS]:
        session.remove(spark, old.folder)


#: Name of the file that makes a folder a version. Spark's readers pass over it.
MANIFEST = "_manifest.json"


@dataclass(frozen=True, order=True)
class Version:
    number: int
    folder: str
    rows: int = field(compare=False)
    files: tuple[str, ...] = field(compare=False)


def _manifest(number: int, rows: int, files: list[str]) -> str:
    body = {"version": number, "rows": rows, "files": files}
    return json.dumps({**body, "check": zlib.crc32(json.dumps(body).encode())})


def versions(spark: SparkSession, path: str) -> list[Version]:
    """Versions of a published table, the last one last. A manifest that was cut off fails
    its own checksum and does not count; one that goes while it is read neither."""
    found = []
    for place in session.matching(spark, f"{path}/v-*/{MANIFEST}"):
        try:
            held = json.loads(session.read_small(spark, place))
            check = held.pop("check")
        except (ValueError, KeyError, AttributeError, Py4JJavaError):
            continue
        if check == zlib.crc32(json.dumps(held).encode()):
            found.append(Version(held["version"], place[:-len(MANIFEST) - 1], held["rows"], tuple(held["files"])))
    return sorted(found)


def remove_unfinished(spark: SparkSession, path: str) -> int:
    """Delete folders without a manifest: what broken writers left. Not to be called while one is at work."""
    whole = {v.folder for v in versions(spark, path)}
    left = [f for f in session.matching(spark, f"{path}/v-*") if f not in whole]
    for folder in left:
        session.remove(spark, folder)
    return len(left)


def last_version(spark: SparkSession, path: str) -> Version:
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no table was published at {path}")
    return found[-1]


def current(spark: SparkSession, path: str) -> str:
    """Folder of the version that was published last."""
    return last_version(spark, path).folder


def read_published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The files that the last manifest names, and no others."""
    last = last_version(spark, path)
    if not last.files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", last.folder).parquet(*(f"{last.folder}/{f}" for f in last.files))


def read_bronze(spark: SparkSession, path: str, sep: str = ",", columns: Iterable[str] = (),
                multiline: bool = False) -> DataFrame:
    """CSV with a header; every column is a string, addressed by its header name.

    Doubled quotes are read as one. ``multiline`` is off because it makes a file
    unsplittable; ask for it only where cells do hold line breaks.
    """
    df = (spark.read.option("header", True).option("sep", sep).option("escape", '"')
          .option("encoding", "UTF-8").option("multiLine", multiline).csv(path))
    return require_columns(df, columns)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found, available: {df.columns}")
    return df


def write_bronze(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", True).option("sep", sep).option("escape", '"')
     .csv(path))


def write_silver(silver: DataFrame, path: str) -> None:
    """Parquet per source. Types survive, files stay as parallel as the job."""
    publish(silver, path, by="source")


def export_csv(df: DataFrame, path: str) -> None:
    """The CSV form of a stage, in as many part files as the plan has partitions."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """All parts of the silver table; a missing table is an error of the reader."""
    names = schemas.SILVER.fieldNames()
    return read_published(spark, path, schemas.SILVER).select(*names)


def read_silver_csv(spark: SparkSession, path: str) -> DataFrame:
    """Silver from its CSV export. ``NA``-like cells count as missing, numbers are
    cast tolerantly."""
    df = read_bronze(spark, path, columns=schemas.SILVER.fieldNames())
    return df.select(*[
        _typed(missing_text(F.col(f.name)), f.dataType).alias(f.name) for f in schemas.SILVER
    ])


#: Cells that a data-frame CSV reader takes for missing.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def missing_text(col: Column) -> Column:
    return F.when(~col.isin(*MISSING_CELLS), col)


def _typed(col: Column, to: T.DataType) -> Column:
    return col if isinstance(to, T.StringType) else col.try_cast(to)


def write_gold(gold: DataFrame, path: str, fmt: str = "parquet",
               check: Callable[[DataFrame], object] | None = None) -> None:
    if fmt == "csv":
        export_csv(gold, path)
    else:
        publish(gold, path, check)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return read_published(spark, path, schemas.GOLD)


def read_gold_csv(spark: SparkSession, path: str) -> DataFrame:
    return coerce_gold(read_bronze(spark, path, columns=schemas.GOLD.fieldNames()))


def coerce_gold(df: DataFrame) -> DataFrame:
    """Numeric gold columns from text; a bad value gives null, not a failed job."""
    return df.select(*[_typed(missing_text(F.col(f.name)), f.dataType).alias(f.name)
                       if isinstance(df.schema[f.name].dataType, T.StringType)
                       else F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in schemas.GOLD])


def write_serving(items: DataFrame, path: str) -> None:
    """Full refresh: the new items replace all old ones at once, or none of them."""
    publish(items, path)


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    return read_published(spark, path, schemas.SERVING)
