"""What stays on disk: shuffle files and tables on the way to others go, mates travel packed, large lanes are compressed."""

import gzip
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tagloom import derived as d
from tagloom.operators import pair_blocks
from tagloom.operators import preprocess as P
from tagloom.plans import query_inputs as Q
from tagloom.session import FREE_SHUFFLES, materialize, stored_alone, work_dir
from tagloom.sources.sinks import write_fastq
from tests.conftest import rows

SCHEMA = "selection_id string, lane int, ordinal bigint, read_id string, seq string, qual string"


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def left_over(spark, before: set[str]) -> set[str]:
    for _ in range(50):
        if not (found := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return found


@pytest.mark.parametrize("write", ["table", "fastq"])
def test_shuffle_files_go_with_the_write(spark, tmp_path, write):
    spark._jvm.System.gc()
    time.sleep(1)
    reads = spark.range(20_000).select(F.col("id").cast("string").alias("read_id"), F.lit("ACGT").alias("seq"), F.lit("IIII").alias("qual")).repartition(3, "read_id")
    before = shuffle_files(spark)
    if write == "table":
        materialize(reads, "shuffled")
    else:
        write_fastq(reads, str(tmp_path / "reads"))
    assert not left_over(spark, before)
    assert spark.conf.get(FREE_SHUFFLES) == "false"


def test_tables_on_the_way_go(spark):
    folder = work_dir(spark).removeprefix("file:").replace("///", "/")
    stored = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before = stored()

    def inner():
        return materialize(spark.range(5), "one").union(materialize(spark.range(7), "two"))

    out = stored_alone(spark, lambda: stored_alone(spark, inner, "both").union(materialize(spark.range(2), "three")), "all")
    assert out.count() == 14
    assert [n.rsplit("-", 1)[0] for n in stored() - before] == ["all"]
    with pytest.raises(ZeroDivisionError):
        stored_alone(spark, lambda: materialize(spark.range(5), "one") and 1 / 0, "none")
    assert len(stored() - before) == 1


def odd_reads(spark, seed: int, n: int = 3000):
    rng = random.Random(seed)
    made = [
        (rng.choice(["a", "b", None, "é"]), rng.choice([0, 1, None]), rng.choice([None, rng.randrange(50), *[rng.randrange(-20_000, 40_000)] * 5]),
         rng.choice([None, f"id{i}", "", "ü"]), rng.choice([None, "ACGT" * rng.randrange(5)]), "I" * rng.randrange(9))
        for i in range(n)
    ]
    return spark.createDataFrame(made, SCHEMA).repartition(3)


@pytest.mark.parametrize("held", [1000, 16 << 20])
def test_packed_mates_pair_as_a_join(spark, monkeypatch, held):
    """Null and repeated places, null texts, rows in any order, with lanes and without."""
    monkeypatch.setattr(pair_blocks, "HELD_BYTES", held)
    one, two = odd_reads(spark, 1), odd_reads(spark, 2)
    for drop in ([], ["lane"]):
        keys = ["selection_id", *["lane"][len(drop) :], "ordinal"]
        a, b = one.drop(*drop), two.drop(*drop)
        got = P.pair_reads(a, b)
        right = b.withColumnsRenamed({"read_id": "read_id_r2", "seq": "seq_r2", "qual": "qual_r2"})
        want = a.withColumnsRenamed({"seq": "seq_r1", "qual": "qual_r1"}).join(right, keys)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert rows(got) == rows(want) and got.count() > 20
    assert P.pair_reads(one.limit(0), two).count() == 0


def test_mates_are_shuffled_in_blocks(spark):
    """Neighbours with equal qualities: rows went through the shuffle one by one with all their letters."""
    made = spark.range(20_000).select(
        F.lit("s").alias("selection_id"), F.lit(0).alias("lane"), F.col("id").alias("ordinal"), F.concat(F.lit("r"), "id").alias("read_id"),
        F.lit("ACGT" * 16).alias("seq"), F.lit("I" * 64).alias("qual"),
    )
    sent = pair_blocks.packed(made.coalesce(1), ["selection_id", "lane", "ordinal"])
    size = sum(sum(len(v) for v in r if isinstance(v, (bytes, bytearray))) for r in sent.collect())
    assert 3 <= sent.count() <= 12 and size < 20_000 * 148 / 10
    pairs = P.pair_reads(made, made)
    assert "SortMergeJoin" not in pairs._jdf.queryExecution().toString()
    got = pairs.agg(F.count(F.lit(1)), F.count_if((F.col("read_id") == F.col("read_id_r2")) & (F.col("read_id") == F.concat(F.lit("r"), "ordinal")))).first()
    assert tuple(got) == (20_000, 20_000)


def test_large_lanes_of_mates_are_compressed(spark, sf):
    lines = d.read_lines(spark, sf).filter("l_orderkey < 600")
    reads = lambda rows: d.pairs_of(rows)[0]

    def lanes(*plain):
        found = []
        for path in Q.write_lanes(lines, reads, "mates", *plain):
            files = [f"{path}/{n}".removeprefix("file:") for n in sorted(os.listdir(path.removeprefix("file:"))) if n.startswith("part")]
            text = "".join((gzip.open if n.endswith(".gz") else open)(n, "rt").read() for n in files)
            found.append(({n.endswith(".gz") for n in files}, text))
        return found

    usual, small, large = lanes(), lanes(10**6), lanes(10)
    assert [k for k, _ in usual] == [k for k, _ in small] == [{False}, {True}, {False}]
    assert [k for k, _ in large] == [{True}] * 3
    assert [t for _, t in usual] == [t for _, t in large] and all(t for _, t in large)
