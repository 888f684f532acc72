"""Ordered work that never puts one hot key into one task.

Alignments and species groups are uneven: one key may hold a third of all rows. A plain running window puts
that key into a single task. The helpers here cut each key into spans, work inside the spans, and carry only
one row per span across them.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPAN = 1 << 16


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key. Spark keeps one row per key and map task before the shuffle (group limit)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where("_rn = 1").drop("_rn")


def with_span(df: DataFrame, ord_col: str, span: int = SPAN) -> DataFrame:
    return df.withColumn("_span", F.floor(F.col(ord_col) / F.lit(span)))


def running_sum(df: DataFrame, keys: list[str], ord_col: str, value: Column, out: str, span: int = SPAN) -> DataFrame:
    """Running sum of ``value`` in ``ord_col`` order, including the current row.

    Spans of ``span`` ordinals are summed on their own; only span totals are accumulated per key.
    """
    parts = with_span(df, ord_col, span).withColumn("_v", value.cast("long"))
    return _carry(parts, keys, "_span", [F.col(ord_col)], out).drop("_span", "_v")


def ranked(df: DataFrame, keys: list[str], bucket: Column, order: list[Column], out: str) -> DataFrame:
    """Exact 1-based rank per key. ``bucket`` must rise with ``order``; each bucket is ranked on its own."""
    parts = df.withColumn("_bucket", bucket).withColumn("_v", F.lit(1).cast("long"))
    return _carry(parts, keys, "_bucket", order, out).drop("_bucket", "_v")


def _carry(parts: DataFrame, keys: list[str], span: str, order: list[Column], out: str) -> DataFrame:
    inside = Window.partitionBy(*keys, span).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*keys).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(*keys, span).agg(F.sum("_v").alias("_total"))
    offsets = totals.select(*keys, span, F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_offset"))
    local = parts.withColumn(out, F.sum("_v").over(inside))
    return local.join(offsets, [*keys, span]).withColumn(out, F.col(out) + F.col("_offset")).drop("_offset")


def with_previous(df: DataFrame, keys: list[str], ord_col: str, value: str, out: str, span: int = SPAN) -> DataFrame:
    """``value`` of the previous row of the key; NULL on its first row."""
    parts = with_span(df, ord_col, span)
    inside = Window.partitionBy(*keys, "_span").orderBy(ord_col)
    lasts = parts.groupBy(*keys, "_span").agg(F.max_by(value, ord_col).alias("_last"))
    before = lasts.select(*keys, "_span", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_span")).alias("_before"))
    local = parts.withColumn("_lag", F.lag(value).over(inside)).withColumn("_at", F.row_number().over(inside))
    joined = local.join(before, [*keys, "_span"])
    return joined.withColumn(out, F.when(F.col("_at") == 1, F.col("_before")).otherwise(F.col("_lag"))).drop(
        "_span", "_lag", "_at", "_before"
    )


def with_last_known(df: DataFrame, keys: list[str], ord_col: str, value: str, out: str, span: int = SPAN) -> DataFrame:
    """The latest non-NULL ``value`` of the key up to and including each row."""
    parts = with_span(df, ord_col, span)
    inside = Window.partitionBy(*keys, "_span").orderBy(ord_col).rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(F.col(value).isNotNull(), F.col(ord_col))
    lasts = parts.groupBy(*keys, "_span").agg(F.max_by(value, known).alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = lasts.select(*keys, "_span", F.last("_last", ignorenulls=True).over(across).alias("_before"))
    local = parts.withColumn("_here", F.last(value, ignorenulls=True).over(inside))
    return local.join(before, [*keys, "_span"]).withColumn(out, F.coalesce("_here", "_before")).drop("_span", "_here", "_before")


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], rows_per_salt: int = 1_000_000) -> DataFrame:
    """Inner join in which a key may be hot on either side, or on both.

    A key with more than ``rows_per_salt`` rows on a side is dealt over a grid: its left rows over ``a`` salts, its right rows over
    ``b``, each row repeated along the other side of the grid, so that every pair meets once and no task gets more than about
    ``rows_per_salt`` rows of either. Only keys that hot have a grid; there are at most rows / ``rows_per_salt`` of them.
    """
    salts = lambda n: F.ceil(F.coalesce(n, F.lit(0)) / F.lit(rows_per_salt)).cast("int")
    counted = left.groupBy(*keys).agg(F.count("*").alias("_l")).join(right.groupBy(*keys).agg(F.count("*").alias("_r")), keys)
    hot = counted.where(F.greatest("_l", "_r") > rows_per_salt).select(*keys, salts(F.col("_l")).alias("_a"), salts(F.col("_r")).alias("_b"))

    def spread(df: DataFrame, own: str, other: str, salt: str, repeat: str) -> DataFrame:
        sized = df.join(F.broadcast(hot), keys, "left")
        dealt = F.pmod(F.xxhash64(*[c for c in df.columns], F.monotonically_increasing_id()), F.coalesce(own, F.lit(1))).cast("int")
        copies = F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)
        return sized.withColumn(salt, dealt).withColumn(repeat, F.explode(copies)).drop("_a", "_b")

    return spread(left, "_a", "_b", "_i", "_j").join(spread(right, "_b", "_a", "_j", "_i"), [*keys, "_i", "_j"]).drop("_i", "_j")


def spread_evenly(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt by ``keys`` over every shuffle partition: rows that are small but dear to work on are not merged into few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def merged(df: DataFrame) -> DataFrame:
    """``df``, whose joins shuffle both sides. Spark takes an exploded table for as large as the one it came from, and a checkpoint
    for as large as its plan looked, so its size check would let tables of any size go to the driver to be broadcast."""
    return df.hint("merge")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder of the session, :func:`merged`; a temporary folder is made in local mode only."""
    _ensure_checkpoint_dir(df.sparkSession)
    return merged(df.checkpoint())


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach.")
    return tempfile.mkdtemp(prefix="spark-")


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
