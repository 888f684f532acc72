"""Packed exports: many keys per file, and an index that tells where each key's text lies.

``data/shard=<n>/`` holds one text file per shard; ``index`` is a Parquet table ``(key, part, shard, offset, length)`` in bytes. The number of
files follows from the bytes written, never from the number of keys. A key larger than a shard has several index rows, ``part`` 0, 1, ...
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ordered import shared_folder

SHARD_BYTES = 128 << 20


def write_shards(records: DataFrame, path: str, key: str, order: list[Column | str], text: Column, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write ``text`` of all records, by ``key`` and ``order``, and return the index that was written.

    Range partitioning deals records to shards in (key, order); it is settled once, so that file and index agree. Inside a shard the
    bytes of a key are summed first and only the keys' totals are accumulated. A NULL text counts as an empty line.
    """
    value, place = F.coalesce(text, F.lit("")), [F.col(key), F.struct(*order)]
    total = records.agg(F.sum(F.octet_length(value) + 1)).first()[0] or 0
    shards = max(1, math.ceil(total / shard_bytes))
    # Text is made behind the shuffle: Spark reads the records once more to find the ranges.
    dealt = records.repartitionByRange(shards, *place).sortWithinPartitions(*place)
    spark, staged = records.sparkSession, f"{shared_folder(records.sparkSession)}/staged-{uuid.uuid4().hex}"
    dealt.select(F.col(key).alias("key"), value.alias("value"), F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("_at")).write.parquet(staged)
    dealt = spark.read.parquet(staged)
    out = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "_at").select("shard", "value")
    out.write.mode("overwrite").partitionBy("shard").text(f"{path}/data")
    runs = dealt.groupBy("shard", "key").agg(F.min("_at").alias("_at"), F.sum(F.octet_length("value") + 1).alias("length"))
    before = Window.partitionBy("shard").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    part = F.row_number().over(Window.partitionBy("key").orderBy("shard")) - 1
    index = runs.select("key", part.alias("part"), "shard", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length")
    index.write.mode("overwrite").parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def read_shards(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """``(key, part, at, line)`` of an export, of the wanted ``keys(key)`` only if given.

    ``at`` is the line's byte offset in its shard: bytes are summed inside each split of a file and carried over splits. A line takes
    the key of the last index entry at or before it. With ``keys`` only their shards are used.
    """
    index = spark.read.parquet(f"{path}/index")
    raw = spark.read.text(f"{path}/data").select("shard", F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("_block"),
                                                F.monotonically_increasing_id().alias("_pos"))
    if keys is not None:
        wanted = index.join(keys.select("key").distinct(), "key", "left_semi")
        raw = raw.join(wanted.select("shard").distinct(), "shard", "left_semi")
    size = F.octet_length("line") + 1
    inside = Window.partitionBy("shard", "_block").orderBy("_pos")
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = raw.groupBy("shard", "_block").agg(F.sum(size).alias("_n")).select("shard", "_block", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # Index entries join the split that they begin in, and a split starts with the last entry before it: lines stay where their bytes were summed.
    heads = index.join(splits, "shard").where("offset >= _base and offset < _base + _n").select(
        "shard", "_block", (F.col("offset") * 2).alias("_o"), F.struct("key", "part").alias("entry"))
    lasts = heads.groupBy("shard", "_block").agg(F.max_by("entry", "_o").alias("_last"))
    carried = splits.join(lasts, ["shard", "_block"], "left").select("shard", "_block", "_base", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    placed = raw.withColumn("_end", F.sum(size).over(inside)).join(carried.hint("merge"), ["shard", "_block"])
    body = placed.select("shard", "_block", ((F.col("_base") + F.col("_end") - size) * 2 + 1).alias("_o"), "_before", "line")
    known = F.last("entry", ignorenulls=True).over(Window.partitionBy("shard", "_block").orderBy("_o").rowsBetween(Window.unboundedPreceding, 0))
    told = body.unionByName(heads.repartition("shard", "_block"), allowMissingColumns=True).withColumn("owner", F.coalesce(known, "_before"))
    out = told.where("line is not null").select("owner.key", "owner.part", F.shiftright("_o", 1).alias("at"), "line")
    return out if keys is None else out.join(keys.select("key").distinct(), "key", "left_semi")
