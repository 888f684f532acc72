"""Completeness and fingerprints of input bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The files an input bundle must hold.
REQUIRED_FILES = ("sequences.fasta", "exonstable.tsv", "tree.nh", "ensembl_version.csv", "tsl.csv")


def read_bundle_files(spark: SparkSession, root: str) -> DataFrame:
    """``(bundle, name, size, sha256)``; contents never leave the scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("bundle"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
        F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def bundle_state(files: DataFrame) -> DataFrame:
    """``(bundle, complete, fingerprint, missing)``. An incomplete bundle has no fingerprint."""
    required = F.array(*[F.lit(n) for n in REQUIRED_FILES])
    usable = F.col("name").isin(*REQUIRED_FILES) & (F.col("size") > 0)
    # At most one entry per required name, whatever the bundle holds.
    state = files.groupBy("bundle").agg(
        F.array_sort(F.collect_set(F.when(usable, F.struct("name", "size", "sha256")))).alias("have"))
    missing = F.array_except(required, F.transform("have", lambda f: f["name"]))
    text = F.array_join(F.transform("have", lambda f: F.concat_ws("\n", f["name"], f["size"].cast("string"), f["sha256"])), "\n")
    complete = F.size(missing) == 0
    return state.select("bundle", complete.alias("complete"), F.when(complete, F.sha2(text, 256)).alias("fingerprint"),
                        F.array_join(missing, ", ").alias("missing"))
