"""What the vector operators share: rows that take part, and blocks of rows met by blocks of queries.

Every row goes to one shard by a hash of its id, every query to one group; a task sees one shard and one group. Shards and groups
have a bounded number of rows at any table size, so copies, hot labels and long lists never meet in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a shard at most, and as many at least before a table is dealt over more shards than it needs.
SHARD, SMALL = 16_384, 512
GROUP = 4_096


def finite(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def shards(df: DataFrame, rows: int) -> int:
    """Enough shards for ``SHARD``, and for every shuffle partition where rows allow it."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, math.ceil(rows / SHARD), min(wanted, math.ceil(rows / SMALL)))


def dealt(key: Column, parts: Column | int) -> Column:
    return F.pmod(F.xxhash64(key), parts if isinstance(parts, Column) else F.lit(parts)).cast("int")


def numbers(upto: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0), (upto if isinstance(upto, Column) else F.lit(upto)) - 1))


def together(left: DataFrame, right: DataFrame, keys: list[str], kernel: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``kernel`` for each value of ``keys``; both sides may come from one table."""
    renamed = left.select(*[F.col(c).alias(c) for c in left.columns])
    return renamed.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(kernel, schema)


def met(queries: DataFrame, rows: DataFrame, kernel: Callable[[pa.Table, pa.Table], pa.Table], schema: str, *, n_rows: int, n_queries: int, spread: str, by: str) -> DataFrame:
    """``kernel(queries, rows)`` for every group of queries and every shard of rows."""
    n_shards, n_groups = shards(rows, n_rows), max(1, math.ceil(n_queries / GROUP))
    left = queries.withColumn("_group", dealt(F.col(by), n_groups)).withColumn("_shard", numbers(n_shards))
    right = rows.withColumn("_shard", dealt(F.col(spread), n_shards)).withColumn("_group", numbers(n_groups))
    return together(left, right, ["_shard", "_group"], kernel, schema)


def matrices(table: pa.Table, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, matrix)`` for each length of the vectors in ``column``."""
    lists = table[column].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(ends)
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield rows, flat[ends[rows][:, None] + np.arange(dim)]
