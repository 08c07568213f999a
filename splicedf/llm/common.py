"""Pieces that several operators share: scratch tables, word patterns, size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a narrow table (a few longs each) that may be broadcast.
BROADCAST_ROWS = 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"

#: Folders of our own by application, for local sessions that name none.
_own: dict[str, str] = {}
#: Scratch tables by owner, while one is set.
_owner: list[str] = []
_owned: dict[str, list[str]] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where a session in one JVM (tests) has none, one
    of our own; a cluster must name it."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        app, master = spark.sparkContext.applicationId, spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = _own.setdefault(app, "") or tempfile.mkdtemp(prefix="spark-splicedf-", dir="/tmp")
        _own[app] = found
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _owner:
        _owned.setdefault(_owner[-1], []).append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: its lineage ends there and lost executors cost no rerun."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def owned(owner: str) -> Iterator[None]:
    """Scratch tables made inside belong to owner, for drop_owned."""
    _owner.append(owner)
    try:
        yield
    finally:
        _owner.pop()


def drop_owned(spark: SparkSession, owner: str) -> None:
    """Delete owner's scratch tables; what was made of them must be written by then."""
    for path in _owned.pop(owner, []):
        delete(spark, path)


class Scratch:
    """Scratch tables of one job, which deletes each as soon as nothing that is still to come reads it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch(self.spark, name)
        self.paths.setdefault(name, []).append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str, keep: int = 0) -> None:
        """Delete the tables of these names, but for the last `keep` of each."""
        for name in names:
            paths = self.paths.get(name, [])
            while len(paths) > keep:
                delete(self.spark, paths.pop(0))


def renamed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with columns c0, c1 and so on, and their own names: no name that an operator makes can clash with them."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), docs.columns


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df holds at most `rows` rows; looks at one row more than that and no further."""
    return df.limit(rows + 1).count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its checked size allows, else df for Spark's own choice of join."""
    return F.broadcast(df) if small(df, rows) else df


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def pieces(c: Column) -> Column:
    """Text cut at every white-space character, empty pieces included; null counts as empty."""
    return F.split(F.coalesce(c, F.lit("")), SPACE_CLASS, -1)


def filled(a: Column) -> Column:
    return F.filter(a, lambda w: w != "")
