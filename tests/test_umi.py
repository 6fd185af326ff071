import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tagloom.operators import components
from tagloom.operators.components import labels_of_large_groups, labels_of_small_groups
from tagloom.operators.counts import count_compounds, dedup_counts, raw_counts
from tagloom.operators.umi import (
    cluster_umis,
    collect_umis,
    explode_collected,
    merge_tallies,
    near_umis,
    rank_umis,
    tally_umis,
)

SCHEMA = "selection_id string, library_id string, bb_ids string, umi string, c bigint"


def roots(group):
    """The rule as written: lowest-ranked UMI that reaches each UMI."""
    ranked = sorted(group, key=lambda x: (-x[1], x[0]))
    near = lambda a, b: len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1
    nxt = {
        i: [j for j, b in enumerate(ranked) if near(a[0], b[0]) and a[1] >= 2 * b[1] - 1]
        for i, a in enumerate(ranked)
    }
    reached, n = set(), 0
    for i in range(len(ranked)):
        if i in reached:
            continue
        n += 1
        todo = [i]
        while todo:
            for j in nxt[todo.pop()]:
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        reached.add(i)
    return n


def random_tally(seed, groups, alphabet, length, size, heavy):
    rng = random.Random(seed)
    out = {}
    for g in range(groups):
        for _ in range(rng.randint(1, size)):
            umi = "".join(rng.choice(alphabet) for _ in range(length))
            out[(str(g), umi)] = rng.choice([1, 1, 1, 2, 3, 4, 7, heavy])
    return [("s", "L", g, u, c) for (g, u), c in out.items()]


@pytest.mark.parametrize("seed,alphabet,length,size", [(1, "ACGT", 4, 60), (2, "AC", 7, 60), (3, "ACGT", 5, 200), (4, "AC", 1, 3), (5, "AC", 14, 120)])
@pytest.mark.parametrize("max_group", [0, 3, 10_000])
def test_clusters_against_brute_force(spark, seed, alphabet, length, size, max_group):
    data = random_tally(seed, 6, alphabet, length, size, 20)
    tally = spark.createDataFrame(data, SCHEMA)
    got = {r.bb_ids: r["count"] for r in cluster_umis(tally, max_group).collect()}
    groups = {}
    for _, _, g, u, c in data:
        groups.setdefault(g, []).append((u, c))
    assert got == {g: roots(v) for g, v in groups.items()}


def test_hot_compound_stays_in_small_blocks(spark):
    """One compound with a third of all UMIs: no block or mask group grows with it."""
    hot = [("s", "L", "hot", "".join("ACGT"[(i >> (2 * k)) & 3] for k in range(6)), 1) for i in range(4096)]
    cold = [("s", "L", str(i), "ACGTAC", 1) for i in range(8000)]
    tally = spark.createDataFrame(hot + cold, SCHEMA).repartition(8)
    near = near_umis(tally)
    assert near.groupBy("bb_ids", "umi").count().agg(F.max("count")).first()[0] <= 6
    counts = {r.bb_ids: r["count"] for r in cluster_umis(tally, max_group=100).filter("bb_ids in ('hot', '7')").collect()}
    assert counts == {"hot": 1, "7": 1}


def test_components(spark):
    rng = random.Random(7)
    links = [("g", f"n{i}", f"n{i + 1}") for i in range(40)] + [("h", f"m{rng.randint(0, 30)}", f"m{rng.randint(0, 30)}") for _ in range(25)]
    links = [x for x in links if x[1] != x[2]]
    df = spark.createDataFrame(links, "bb_ids string, a string, b string")
    assert rows(labels_of_large_groups(df, ["bb_ids"])) == rows(labels_of_small_groups(df, ["bb_ids"]))


def test_counts(spark):
    tally = spark.createDataFrame(
        [("s", "L", "1,2", "AAAA", 10), ("s", "L", "1,2", "AAAT", 2), ("s", "L", "1,2", "GGGG", 1), ("s", "L", "3,4", "AAAA", 1)], SCHEMA
    )
    assert rows(count_compounds(tally)) == [("s", "L", "1,2", 2, 13, 3), ("s", "L", "3,4", 1, 1, 1)]
    assert rows(count_compounds(tally, cluster=False, keep_raw=False)) == [("s", "L", "1,2", 3, 3), ("s", "L", "3,4", 1, 1)]
    assert rows(raw_counts(tally)) == [("s", "L", "1,2", 13), ("s", "L", "3,4", 1)]
    assert rows(dedup_counts(tally)) == rows(dedup_counts(tally, approx=True)) == [("s", "L", "1,2", 3), ("s", "L", "3,4", 1)]
    assert rank_umis(tally).orderBy("umi_rank").first().umi == "AAAA"
    with pytest.raises(ValueError):
        cluster_umis(tally, method="other")


def test_no_neighbours_and_empty(spark):
    tally = spark.createDataFrame([("s", "L", "1", "AAAA", 5)], SCHEMA)
    assert rows(count_compounds(tally)) == [("s", "L", "1", 1, 5, 1)]
    assert rows(count_compounds(tally.filter("c > 99"))) == []


def test_tally_and_collect(spark):
    decoded = spark.createDataFrame(
        [("s", "L", "1", "AA", "ok"), ("s", "L", "1", "AA", "ok"), ("s", "L", "1", "CC", "ok"), ("s", None, None, None, "no_library")],
        "selection_id string, library_id string, bb_ids string, umi string, outcome string",
    )
    tally = tally_umis(decoded)
    assert rows(tally) == [("s", "L", "1", "AA", 2), ("s", "L", "1", "CC", 1)]
    collected = collect_umis(tally)
    assert [tuple(x) for x in collected.first().umi_counts] == [("AA", 2), ("CC", 1)]
    assert rows(explode_collected(collected)) == rows(tally)
    many = spark.createDataFrame([("s", "L", "1", f"{i:04d}", 1) for i in range(500)] + [("s", "L", "2", "A", 1)], SCHEMA)
    spread = collect_umis(many, max_umis=100)
    assert spread.filter("bb_ids = '1'").count() == 5 and rows(explode_collected(spread)) == rows(many)
    assert rows(merge_tallies(tally.unionByName(tally)), "umi", "c") == [("AA", 4), ("CC", 2)]


def true_labels(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for g, a, b in links:
        low, high = sorted((find((g, a)), find((g, b))), key=lambda x: x[1])
        root[high] = low
    return {x: find(x)[1] for g, a, b in links if a != b for x in ((g, a), (g, b))}


def test_forests_and_rounds_give_the_same_components(spark, monkeypatch):
    """A path, a hub, random links and null groups; settled by one forest, and in rounds with the hub's rows left in place."""
    rng = random.Random(5)
    links = [(None, i, i + 1) for i in range(300)] + [("h", 1000, 1001 + i) for i in range(600)]
    links += [(rng.choice([None, "r", "h"]), rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    df = spark.createDataFrame(links, "s string, a bigint, b bigint").repartition(6)
    want = true_labels(links)
    found = lambda size: {(r.s, r.umi): r.label for r in components.labels_of_large_groups(df, ["s"], size).collect()}
    assert found(None) == want
    shuffled = []
    true_join = components.with_least

    def watched(around, least, group, hub):
        shuffled.append(least.filter(F.col("n") <= hub).agg(F.max("n")).first()[0])
        return true_join(around, least, group, hub)

    monkeypatch.setattr(components, "HUB_DEGREE", 40)
    monkeypatch.setattr(components, "HUB_SHARE", 10**9)
    monkeypatch.setattr(components, "with_least", watched)
    assert found(150) == want and max(shuffled) <= 40


def test_a_giant_component_is_thinned_in_its_tasks(spark):
    """100,000 members: no task passes on more than one link for each of its nodes, and none reads over a twentieth of the rows."""
    n, parts = 100_000, 40
    links = spark.range(0, n, 1, parts).select((F.col("id") + 1).alias("a"), F.floor(F.col("id") / 2).cast("bigint").alias("b"))
    links = links.unionByName(spark.range(0, n, 1, parts).select((F.col("id") + 1).alias("a"), F.floor(F.col("id") / 3).cast("bigint").alias("b")))
    links = links.filter("a <> b")
    thin = components.forests(links, [], 10**6).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("a").alias("k"))
    found = thin.collect()
    assert all(r.n == r.k for r in found) and max(r.n for r in found) <= 0.05 * sum(r.n for r in found)
    assert components.labels_of_large_groups(links, [], 10**6).select("label").distinct().count() == 1
