"""Session defaults and the shared folder for tables written between steps."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Removes a job's shuffle files when it ends; else they stay until the driver collects its garbage.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "kindred", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on.

    Cluster sizing (executors, memory, shuffle partitions) is left to
    spark-submit; only settings that change how plans adapt are made here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A local session without the setting (tests) gets a temporary folder; a
    cluster without it is an error, because a driver-local path would lose data.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="kindred-")
        spark.conf.set(CHECKPOINT_KEY, base)
    return f"{base.rstrip('/')}/kindred/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, by: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches of one plan read the same rows: it stops the
    recomputation, cuts the lineage durably (a lost executor costs nothing
    already written) and gives the planner true sizes for its join choices. ``by``
    keeps the rows apart by a column of few values, so readers skip the other files;
    ``codec`` compresses them otherwise than the session does. What was shuffled for it goes at once.
    """
    path = fresh_path(df.sparkSession, label)
    for held in _scratch:
        held.append(path)
    writer = df.write.mode("overwrite")
    writer = writer.option("compression", codec) if codec else writer
    with _setting(df.sparkSession, CLEANUP_KEY, "true"):
        (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    held = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if held is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, held)


def materialise_alone(make: Callable[[], DataFrame], label: str, codec: str | None = None) -> DataFrame:
    """``materialise`` for what ``make`` returns; the tables it wrote on the way are removed then."""
    with recorded() as paths:
        made = materialise(make(), label, codec=codec)
    for path in paths[:-1]:
        remove(made.sparkSession, path)
    return made


_scratch: list[list[str]] = []


@contextlib.contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths that ``materialise`` writes within."""
    paths: list[str] = []
    _scratch.append(paths)
    try:
        yield paths
    finally:
        _scratch[:] = [p for p in _scratch if p is not paths]


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what ``materialise`` writes within: for jobs that store their
    result before they leave. Results read later must not be built in it."""
    with recorded() as paths:
        try:
            yield
        finally:
            for path in paths:
                remove(spark, path)


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop has them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one piece; an existing one is an error."""
    system, where = _at(spark, path)
    out = system.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Names of all files in a folder and its folders, relative to it, sorted."""
    system, where = _at(spark, path)
    base = system.makeQualified(where).toUri().getPath().rstrip("/") + "/"
    found, listed = [], system.listFiles(where, True)
    while listed.hasNext():
        found.append(listed.next().getPath().toUri().getPath()[len(base):])
    return sorted(found)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern, sorted."""
    system, where = _at(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in system.globStatus(where) or ())
