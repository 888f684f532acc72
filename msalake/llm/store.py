"""Tables shared between Spark jobs, and connected components over a table of links."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
LAST_ID = (1 << 63) - 1
_noted: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; one of our own only on a ``local[...]`` master that has none, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
    mine = tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", mine)
    return mine


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: evaluated once, and safe against lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for paths in _noted:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of the tables that :func:`settled` writes inside the block."""
    paths: list[str] = []
    _noted.append(paths)
    try:
        yield paths
    finally:
        _noted.remove(paths)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing will read again, in whatever file system they are."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for links ``(a, b)``: root is the smallest node reachable. Only nodes with a link come out.

    Alternating large-star and small-star steps: each node's larger neighbours, then its smaller ones, are hung onto
    its least neighbour, until every edge points at a root. Rows never exceed the links given; the rounds grow with
    the logarithm of the longest chain. Empty links give an empty table.
    """
    edges = settled(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    for _ in range(rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(small_least, "a").select(F.explode(F.array(
                F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
            )).alias("e")).select("e.*").where("a <> b").distinct()
        )
        after = settled(small)
        chained = after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        edges = after
        if chained.isEmpty() and edges.groupBy("a").count().where("count > 1").isEmpty():
            roots = edges.select("b").distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
            )
    raise RuntimeError("components did not settle")
