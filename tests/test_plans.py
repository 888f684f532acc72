"""Plan shapes that keep the operators scalable."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from msalake.functions.ordered import cut_lineage
from msalake.operators import hits
from msalake.plans import jobs, run
from msalake.queries.common import Tables
from msalake.queries.selection import hit_table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    text = plan(entry.queries()["identity_counts"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all(set(c.split(":")[0] for c in s.split(",")) <= {"l_orderkey", "l_partkey", "l_returnflag"} for s in schemas)


def test_no_query_multiplies_tables(spark):
    for name in ("name_resolution", "segment_concat", "species_effective", "common_universe", "subsample", "code_project", "neff", "hits_new",
                 "centroid_members", "best_seed", "stage_audit"):
        text = plan(entry.queries()[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_aggregates_combine_before_the_shuffle(spark):
    every = hits.all_hits(hits.clean_hits(hit_table(Tables(spark, FOLDER))))
    assert plan(every).count("partial_min") >= 1


def test_top_one_is_limited_before_the_shuffle(spark):
    text = plan(entry.queries()["best_seed"](spark, FOLDER))
    assert "WindowGroupLimit" in text


def test_results_do_not_depend_on_partitions(spark):
    names = ("best_seed", "subsample", "column_blocks", "segment_concat", "neff")
    got = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append([sorted(map(tuple, entry.queries()[q](spark, FOLDER).collect())) for q in names])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]


def test_blocks_tile_the_coded_columns(spark):
    from msalake.queries.alignment import event_columns

    t = Tables(spark, FOLDER)
    coded = event_columns(t).where(F.col("code") != ".").groupBy("user_id").agg(F.count("*").alias("n"))
    blocks = entry.queries()["column_blocks"](spark, FOLDER).groupBy("user_id").agg(F.sum("n_columns").alias("m"))
    assert coded.join(blocks, "user_id").where("n <> m").count() == 0


def test_checkpoints_are_not_broadcast(spark):
    small = cut_lineage(spark.range(10).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(50)))))
    for joined in (spark.range(1000).join(small, "id"), spark.range(1000).join(small.groupBy("id").count(), "id", "left"),
                   small.join(spark.range(1000), "id", "left_semi")):
        assert "Broadcast" not in plan(joined)


def test_tables_of_a_run_are_not_broadcast(spark, monkeypatch):
    """Not those that grow while Spark takes them for as large as the targets: the rows of exons, the candidates, the lookup."""
    plans = []

    def told(df):
        plans.append(plan(df))
        return cut_lineage(df)

    monkeypatch.setattr(jobs, "cut_lineage", told)
    monkeypatch.setattr(run, "cut_lineage", told)
    entry.queries()["full_run_assembled"](spark, FOLDER)
    joins = [line for text in plans for line in text.splitlines() if "Join " in line]
    for keys in ("target_id, s_exon_id", "target_id, pid_order", "_core"):
        both = ", ".join(r"\[" + "".join(f"{k}#\\d+L?, " for k in keys.split(", "))[:-2] + r"\]" for _ in range(2))
        found = [line for line in joins if re.search(both, line)]
        assert found and all("SortMergeJoin" in line for line in found), (keys, found)
