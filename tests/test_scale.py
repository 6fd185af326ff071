"""Work in proportion to the input: ranges, lanes, long files, open sections, derived reads."""

import random

from pyspark.sql import functions as F

from tagloom import derived as d
from tagloom.operators import section_indels as SI
from tagloom.plans import query_inputs as Q
from tagloom.session import materialize
from tagloom.sources import fastq_format as FF
from tagloom.sources import named_files
from tagloom.sources.fastq import count_ranges, read_fastq, with_ordinal


def test_a_range_reads_little_beyond_its_end_and_ranges_stay_few(tmp_path):
    path = tmp_path / "a.fastq"
    path.write_text("".join(f"@r{i}\nACGTACGT\n+\nIIIIIIII\n" for i in range(20_000)))
    size = path.stat().st_size
    read = sum(len(b) for b in FF._blocks(FF.FastqRange(0, str(path), 1000, 2000)))
    assert read == size - 999  # a stream may go on to the file's end,
    first = next(FF._blocks(FF.FastqRange(0, str(path), 1000, 2000)))
    assert len(first) <= 1001 + FF.BEYOND < size  # but its first block holds the range
    options = {"lanes": f'["{path}"]', "range_bytes": "64"}
    assert len(FF.FastqReader(options).partitions()) <= FF.MOST_RANGES
    assert len(FF.FastqReader({**options, "exact": "true"}).partitions()) == -(-size // 64)


def test_counted_ranges_place_reads_as_counted_reads_do(spark, tmp_path):
    paths = []
    for lane, end in (("a", "\n"), ("b", "\r\n")):
        paths.append(str(tmp_path / f"{lane}.fastq"))
        with open(paths[-1], "w", newline="") as f:
            f.write("".join(f"@{lane}{i} x{end}ACGT{end}+{end}IIII{end}" for i in range(500)))
    reads = read_fastq(spark, paths, with_position=True, range_bytes=900)
    columns = ["lane", "ordinal", "read_id"]
    one = with_ordinal(reads, count_ranges(spark, paths, range_bytes=900)).select(*columns)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, with_ordinal(reads).select(*columns).collect()))
    assert one.filter("read_id = concat(if(lane = 0, 'a', 'b'), ordinal)").count() == 1000


def test_lanes_have_more_files_for_more_reads(spark, tmp_path, monkeypatch):
    lines = spark.range(600).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(2).cast("long").alias("l_partkey"), F.lit(3).cast("long").alias("l_suppkey"), F.lit("R").alias("l_returnflag")
    )
    monkeypatch.setattr(Q, "READS_PER_FILE", 20)
    lanes = Q.write_lanes(lines, d.reads_of, "lanes")
    assert all(len(FF.list_files(path)) > 4 for path in lanes)
    got = with_ordinal(read_fastq(spark, lanes, with_position=True)).filter("lane = 1").orderBy("ordinal").collect()
    assert [r.read_id for r in got] == [f"r{k}.1.2.3" for k in range(1, 600, 3)]


def test_a_long_file_is_written_in_pieces(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(named_files, "materialize", lambda df, label: seen.append(materialize(df, label)) or seen[-1])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = spark.range(5000).select(F.when(F.col("id") < 4990, "long.txt").otherwise(F.concat(F.lit("s/"), "id")).alias("f"), (-F.col("id")).alias("k"), F.concat(F.lit("é"), "id").alias("t"))
        assert named_files.write_named_lines(lines.repartition(7), str(tmp_path), "f", "t", ["k"]) == 11
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert seen[0].filter("file = 'long.txt'").count() > 1
    assert (tmp_path / "long.txt").read_text() == "".join(f"é{k}\n" for k in range(4989, -1, -1))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["long.txt", "s"] and len(list((tmp_path / "s").iterdir())) == 10


def test_windows_are_looked_up_once():
    rng = random.Random(5)
    text = lambda: "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 9)))
    for a, b in [(text(), text()) for _ in range(500)]:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, start=1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, start=1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        assert SI.edit_distance(a, b) == row[-1]
    index = SI.SectionIndex([(1, 7, "ACGTACGT", 1), (1, 8, "ACGTACGA", 1), (2, 9, "ACGTACGT", 0)])
    assert sorted(index.near(1, "ACGTACG")) == [(1, 7), (1, 8)] and index.near(2, "ACGTACG") == []
    assert index.near(1, "ACGTACG") is index.near(1, "ACGTACG") and index.near(2, "ACGTACGT") == [(0, 9)]


def test_derived_tags_are_those_written_letter_by_letter(spark):
    x = F.col("id")
    numbers = spark.range(-600, 600)
    assert numbers.filter(~d.tag(x).eqNullSafe(F.repeat(d.dna(x, 4), F.lit(3)))).count() == 0
    none = numbers.select(F.nullif("id", F.col("id")).alias("id"))
    assert none.select(F.concat(F.lit("A"), d.tag(x), d.umi(x)).alias("t")).filter("t IS NOT NULL").count() == 0
    near = numbers.filter("abs(id) < 40")
    assert near.filter(~d.umi(x).eqNullSafe(F.repeat(d.dna(x * 5 + 3, 6), F.lit(2)))).count() == 0


def test_code_of_derived_reads_is_compiled(spark, sf):
    reads = d.truth_reads(d.table(spark, sf, "lineitem"))._jdf.queryExecution().executedPlan()
    spans = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(reads)
    assert max(spans.apply(i)._3().maxMethodCodeSize() for i in range(spans.size())) < 8000  # beyond, the JVM interprets it
