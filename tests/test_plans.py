"""What the physical plans look like: pushdown, join kinds, no single-task step over rows."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import queries as Q
from tidemark import session, sources
from tidemark.functions import trailing_windows
from tidemark.operators import audience, features, ranking


def plan(df, mode: str = "simple") -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_scan_reads_needed_columns_and_pushes_filters(spark, sf):
    text = plan(Q.scan_parquet(spark, sf))
    assert "GreaterThan(l_quantity,45.0)" in text
    assert "l_comment" not in text and "l_shipdate" not in text


def test_trailing_windows_scan_once_and_push_the_range(spark, sf):
    orders = I.table(spark, sf, "orders")
    df = features.trailing_features(
        orders, "o_custkey", "o_orderdate", trailing_windows("199808"), {"top": features.highest(F.col("o_totalprice"))}
    )
    text = plan(df)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    text = plan(df, "formatted")
    assert "GreaterThanOrEqual(o_orderdate,1998-05-01" in text and "LessThan(o_orderdate,1998-08-01" in text


def test_exclusion_is_an_anti_join(spark, sf):
    assert "LeftAnti" in plan(Q.exclude_members(spark, sf))
    assert "LeftSemi" in plan(Q.require_activity(spark, sf))


def test_latest_row_is_cut_before_the_shuffle(spark, sf):
    text = plan(Q.latest_per_key(spark, sf))
    assert "WindowGroupLimit" in text
    below = text[text.index("Exchange") :]
    assert re.search(r"WindowGroupLimit.*Partial", below)


def test_best_model_is_a_top_one(spark, sf):
    assert "TakeOrderedAndProject" in plan(Q.best_model(spark, sf))


def test_bins_samples_and_splits_move_no_rows(spark, sf):
    for name in ("decile", "decile_ties", "sample_n", "train_test_split", "undersample", "rank_edge_bins"):
        assert "Exchange" not in plan(Q.queries()[name](spark, sf)), name


def test_single_task_steps_run_on_aggregates_only(spark, sf):
    """Below every single-partition exchange there is an aggregate."""
    for name in ("global_rank", "percentile_bins", "roc_points", "roc_auc", "spearman", "lift_table", "best_f1", "sorted_series"):
        lines = plan(Q.queries()[name](spark, sf)).splitlines()
        for i, line in enumerate(lines):
            if "SinglePartition" in line:
                child = lines[i + 1]
                assert "Aggregate" in child or "Project" in child and "Aggregate" in lines[i + 2], (name, child)


def test_snapshot_month_is_pruned(spark, sf):
    path = session.work_path(spark, "snap")
    sources.write_snapshot(I.table(spark, sf, "customer").select("c_custkey"), path, "202401")
    text = plan(sources.read_dataset(spark, path, "202401"))
    assert re.search(r"PartitionFilters: \[[^\]]*run_month", text)


def test_materialize_policies(spark, sf):
    path = session.work_path(spark, "mat")
    calls = []

    def build():
        calls.append(1)
        return I.table(spark, sf, "customer").select("c_custkey")

    for _ in range(2):
        assert sources.materialize(build, spark, path, "202401").count() == I.table(spark, sf, "customer").count()
    assert len(calls) == 1
    kept = sources.materialize(build, spark, path, "202401", "while_execution")
    assert len(calls) == 2 and kept.is_cached
    kept.unpersist()
    sources.materialize(build, spark, path, "202401", "never")
    assert len(calls) == 3


def test_checkpoint_folder_comes_from_the_session(spark):
    assert session.work_path(spark, "x").startswith(session.checkpoint_dir(spark))


def test_no_plan_joins_without_a_key(spark, sf):
    for name in Q.queries():
        text = plan(Q.queries()[name](spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_hot_customer_does_not_change_features(spark):
    """One customer with a third of all rows."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("1998-07-15").cast("date").alias("d"))
    got = features.trailing_features(rows, "k", "d", trailing_windows("199808"), {"n": features.event_count(F.lit(True))})
    assert got.where("k = 0").first()["n30"] == 1000
    assert ranking.quantile_bin(got, "n30", "k", 4).groupBy("bin").count().count() == 4


def test_uniqueness_check_of_numbers_is_a_hash_aggregate(spark):
    rows = spark.range(100).select("id", (F.col("id") / 3).alias("x"), F.current_date().alias("d"))
    assert "SortAggregate" not in plan(audience.star_join(spark.range(100), [rows], "id"))
