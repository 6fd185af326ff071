"""Places, ranks and top rows by prefix sums over ranges."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import enrich
from tagloom.operators.places import running_sums

SCHEMA = "selection_id string, library_id string, bb_ids string, z_n double, n bigint"


@pytest.fixture
def many_ranges(spark):
    """Enough partitions that groups reach over several of them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def table(seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice([None, "s"]), rng.choice(["L", None, "hot", "hot"]), f"{i:05d}", rng.choice([None, *range(40)]), rng.randrange(4)) for i in range(900)]
    return [(a, b, c, None if z is None else z / 4, n) for a, b, c, z, n in rows] + [("s", "one", "x", 1.0, 3), ("s", "none", "y", None, 0)]


@pytest.mark.parametrize("weight", [None, "n"])
def test_running_sums(spark, many_ranges, weight):
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = running_sums(df, ["selection_id", "library_id"], [F.col("bb_ids").asc()], weight).collect()
    assert len(got) == len(rows)
    for r in got:
        group = [x for x in rows if x[:2] == (r.selection_id, r.library_id)]
        value = lambda x: 1 if weight is None else x[4]
        assert r.total__ == sum(map(value, group)) and r.before__ == sum(value(x) for x in group if x[2] < r.bb_ids)


def test_ranks_with_ties_and_nulls(spark, many_ranges):
    rows = table(2)
    got = enrich.rank_enrichment(spark.createDataFrame(rows, SCHEMA)).collect()
    worth = lambda z: float("-inf") if z is None else z
    assert len(got) == len(rows)
    for r in got:
        group = [x for x in rows if x[:2] == (r.selection_id, r.library_id)]
        rank = 1 + sum(worth(x[3]) > worth(r.z_n) for x in group)
        assert r["rank"] == rank and r.percent_rank == pytest.approx((rank - 1) / (len(group) - 1) if len(group) > 1 else 0)


@pytest.mark.parametrize("k", [1, 7, 60, 5000])
def test_top_rows_by_a_cut_score_equal_those_of_a_window(spark, many_ranges, monkeypatch, k):
    df = spark.createDataFrame(table(3), SCHEMA).withColumns({"total": F.lit(1), "before": F.lit(2)})
    want = sorted(map(repr, enrich.top_enriched(df, k).collect())) if k < enrich.WINDOW_LIMIT else None
    monkeypatch.setattr(enrich, "WINDOW_LIMIT", 0)
    got = enrich.top_enriched(df, k)
    assert "row_number" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert want is None and got.count() == df.count() or sorted(map(repr, got.collect())) == want


def test_a_library_of_a_million_scores_is_in_no_single_task(spark, many_ranges):
    scores = spark.range(0, 1_000_000, 1, 8).select(
        F.lit("s").alias("selection_id"), F.lit("L").alias("library_id"), F.col("id").cast("string").alias("bb_ids"), (F.col("id") * 7919 % 1_000_003).cast("double").alias("z_n")
    )
    by = [F.col("z_n").desc_nulls_last()]
    parts = scores.repartitionByRange(F.col("selection_id"), F.col("library_id"), *by).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) <= 50_000 * 1.3  # 24 ranges from a sample
    found = enrich.score_ranks(scores, "z_n")
    assert found.agg(F.max("before"), F.countDistinct("before"), F.min("total")).first() == (999_999, 1_000_000, 1_000_000)
