"""Labelled documents that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import settled


def there(marks: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """``marks(_key, name)`` of the documents in ``docs``, written. A label whose document is gone says nothing about those left."""
    return settled(marks.join(docs.select(F.col(key).alias("_there")), F.col("_key") == F.col("_there"), "left_semi"))


def sample(marks: DataFrame, names: list[str], most: int, order: Column) -> DataFrame:
    """``(_key, domain, learn, check)``: of each name, whose place in ``names`` is ``domain``, the first ``most`` marks, a third of them to check.

    At most ``most`` rows for each name: small whatever the input. A name that would have nothing to learn from, or nothing to check
    with, has all of its marks on both sides.
    """
    chosen = None
    for i, name in enumerate(names):
        some = marks.where(F.col("name") == name).orderBy(order, "_key").limit(most).select("_key", F.lit(i).alias("domain"))
        chosen = some if chosen is None else chosen.unionAll(some)
    each = Window.partitionBy("domain")
    dealt = chosen.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), F.col("_key")), F.lit(3)) == 0)
    return dealt.select("_key", "domain", (~F.col("part") | F.bool_and("part").over(each)).alias("learn"), (F.col("part") | ~F.bool_or("part").over(each)).alias("check"))
