"""Cases in which rows used to get lost: null selections, other numbers of cycles, unlisted selections, odd names and blocks."""

import os
import subprocess
import sys

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tagloom.operators import counts as C
from tagloom.operators import enrich as E
from tagloom.operators import jobs as J
from tagloom.operators import stats as S
from tagloom.operators import vendor as V
from tagloom.operators.decode import DecodeSettings, decode
from tagloom.operators.layout import build_library_sections
from tagloom.plans.selection_run import prepare_reads, run
from tagloom.session import materialize
from tagloom.sources import sinks, tables
from tagloom.sources.selections import selection_files, selections_df, validate_settings
from test_decode import BLOCKS, CONFIG, LIBRARIES, read


def test_counts_without_a_selection_are_scored(spark):
    counts = spark.createDataFrame([(None, "L1", "1,2", 4), (None, "L1", "2,2", 6), ("s", "L1", "1,2", 5)], "selection_id string, library_id string, bb_ids string, count bigint")
    blocks = spark.createDataFrame([("L1", c, i) for c in (1, 2) for i in (1, 2)], "library_id string, cycle int, id int")
    result = run(counts=counts, building_blocks=blocks)
    assert rows(result.enrichment.filter("selection_id IS NULL"), "bb_ids", "count", "total") == [("1,2", 4, 10), ("2,2", 6, 10)]
    assert rows(E.rank_enrichment(result.enrichment), "selection_id", "bb_ids", "rank") == [("s", "1,2", 1), (None, "1,2", 2), (None, "2,2", 1)]
    assert E.synthon_enrichment(result.synthons, result.counts, blocks).count() == result.synthons.count() == 8


def test_synthons_of_any_number_of_cycles(spark):
    counts = spark.createDataFrame([("s", "A", "7", 1), ("s", "B", "1,2", 2), ("s", "C", "1,2,3,4", 3), ("s", "D", None, 4)], "selection_id string, library_id string, bb_ids string, count bigint")
    made = C.synthon_counts(counts)
    assert {r.library_id: r["count"] for r in made.groupBy("library_id").count().collect()} == {"A": 1, "B": 3, "C": 15}
    assert rows(made.filter("library_id = 'C' AND cycles = '1,3,4'"), "synthon", "count") == [("1,3,4", 3)]
    assert C.synthon_counts(counts, max_size=1).filter("library_id = 'C'").count() == 4


def test_outcomes_of_further_cycles_are_counted(spark):
    stats = spark.createDataFrame([("s", "L", "ok", 10), ("s", "L", "bb4_unmatched", 90)], "selection_id string, library_id string, outcome string, n bigint")
    counts = spark.createDataFrame([("s", "L", "1,2,3,4", 3, 10, 5)], "selection_id string, library_id string, bb_ids string, count bigint, raw_count bigint, dedup_count bigint")
    assert {r.reads for r in S.decode_summary(counts, stats, None).collect()} == {100}
    assert S.report_tables(stats, counts, None)["outcomes"].first().bb4_unmatched == 90


@pytest.fixture(scope="module")
def sections(spark):
    tags = spark.createDataFrame(list(LIBRARIES.items()), "library_id string, library_tag string")
    return materialize(build_library_sections(tags, CONFIG), "sections")


@pytest.fixture(scope="module")
def blocks(spark):
    listed = [(lib, c, "x", i, t) for lib in LIBRARIES for c, b in BLOCKS.items() for i, t in b.items()]
    return spark.createDataFrame(listed, "library_id string, cycle int, bb_set_name string, id int, tag string")


def test_each_library_has_its_own_distance(spark, sections, blocks):
    strict = sections.withColumn("error_correction", F.when(F.col("library_id") == "L1", F.lit("levenshtein_dist:0")).otherwise(F.col("error_correction")))
    reads = spark.createDataFrame([("s", lib, read(bb1="TCGATT", lib=lib)) for lib in LIBRARIES], "selection_id string, read_id string, seq string")
    got = decode(reads, strict, blocks, DecodeSettings.of(revcomp="NO", demultiplexer_mode="library"))
    assert rows(got, "read_id", "outcome") == [("L1", "bb1_unmatched"), ("L2", "ok")]
    only_one = sections.withColumn(
        "error_correction", F.when((F.col("library_id") == "L1") & (F.col("section") == "bb1"), F.lit("levenshtein_dist:0")).otherwise(F.col("error_correction"))
    )
    reads = spark.createDataFrame([("s", "a", read(bb2="GTCATT")), ("s", "b", read(bb1="TCGATT"))], "selection_id string, read_id string, seq string")
    got = decode(reads, only_one, blocks, DecodeSettings.of(revcomp="NO"))
    assert rows(got, "read_id", "outcome") == [("a", "ok"), ("b", "bb1_unmatched")]


def test_unlisted_selections_and_all_libraries(spark, sections, blocks):
    reads = spark.createDataFrame([("s", "1", read()), ("s", "2", read(lib="L2")), ("t", "3", read()), (None, "4", read())], "selection_id string, read_id string, seq string")
    chosen = selections_df(spark, [{"selection_id": "s", "revcomp": "NO"}])
    result = run(chosen, reads=reads, library_sections=sections, building_blocks=blocks)
    assert rows(result.stats, "selection_id", "outcome", "n") == [("s", "ok", 1), ("s", "ok", 1), ("t", "unknown_selection", 1), (None, "unknown_selection", 1)]
    assert result.summary.filter("level = 'total'").agg(F.sum("reads")).first()[0] == 4


def test_settings_are_checked_though_nothing_reads_them(spark):
    table = selections_df(spark, [{"selection_id": "s", "sequence_files": "a"}])
    for name, value in (("revcomp", "MAYBE"), ("library_error_tolerance", -1), ("min_library_overlap", 0)):
        bad = table.withColumn("decode_settings", F.col("decode_settings").withField(name, F.lit(value)))
        with pytest.raises(Exception, match=name):
            selection_files(validate_settings(bad)).collect()


LINE = "x [SLURM] submitted process P > jobId: {}; a\n"


def test_logs_by_path(spark, tmp_path):
    for folder, name, job in (("a", "run.log", 1), ("b", "run.log", 1), ("a", ".run.log", 2)):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(LINE.format(job))
    paths = [str(tmp_path / p) for p in ("a/run.log", "b/run.log", "a/.run.log")]
    jobs = J.job_records(tables.read_run_log(spark, paths)).collect()
    assert sorted((r.run_id.rsplit("/", 2)[-2:], r.job_id) for r in jobs) == [(["a", ".run.log"], "2"), (["a", "run.log"], "1"), (["b", "run.log"], "1")]


def test_the_last_accounting_block_counts(spark, tmp_path):
    (tmp_path / "usage.txt").write_text("Job ID: 1\nJob Wall-clock time: 00:01:00\nJob ID: 2\nJob Wall-clock time: 00:09:00\nJob ID: 1\nJob Wall-clock time: 00:03:00\n")
    assert rows(tables.read_usage_text(spark, str(tmp_path / "usage.txt")), "job_id", "wall_clock") == [("1", "00:03:00"), ("2", "00:09:00")]


def test_vendor_names_and_indices(spark, tmp_path):
    (tmp_path / "in").mkdir()
    head = "R_coordinate\thits_index\t0\tx\tACGT\n"
    (tmp_path / "in" / "my lib+_L 1.tsv").write_text(head + "a\tX,7\t1\t\tAAAA\na\t2\t2\t\tCCCC\na\t3\t3\t\tGGGG\n")
    vendor = tables.read_vendor_tsv(spark, str(tmp_path / "in"))
    assert rows(vendor.select("file", "library_id").distinct()) == [("my lib+_L 1.tsv", "L 1")]
    found = V.to_building_blocks(vendor)
    assert rows(found, "id", "id_text") == [(2, "2"), (3, "3"), (None, "X,7")]
    sections = spark.createDataFrame([], "library_id string, ord int, section string, tag string, overhang string, error_correction string")
    sets = spark.createDataFrame([], "library_id string, cycle int, bb_set_name string, dna_barcode_on string")
    sinks.write_library_defs(sections, sets, found, str(tmp_path / "out"))
    files = {p.name: p.read_text() for p in (tmp_path / "out" / "building_blocks").iterdir()}
    assert sorted(files) == ["L 1_BBA.csv", "L 1_BBB.csv", "L 1_BBC.csv"] and files["L 1_BBA.csv"] == 'id,tag\n"X,7",AAAA\n'


def test_prepared_pairs(spark, tmp_path):
    text = lambda n, q="I", tail="": "".join(f"@r{i}{tail}\n{'ACGT' * 10}\n+\n{q * 40}\n" for i in range(n))
    for name, content in (("a", text(3, tail="/1")), ("b", text(3, tail="/2")), ("short", text(2)), ("poor", text(3, "#")), ("other", text(3).replace("@r1", "@x1"))):
        (tmp_path / f"{name}.fastq").write_text(content)
    path = lambda name: [str(tmp_path / f"{name}.fastq")]
    assert prepare_reads(spark, path("a"), path("b"), "s", quality={}, spread=3).count() == 3
    with pytest.raises(ValueError, match="no partner"):
        prepare_reads(spark, path("a"), path("short"), "s")
    assert prepare_reads(spark, path("a"), path("short"), "s", unpaired="drop").count() == 2
    with pytest.raises(Exception, match="not in the same order"):
        prepare_reads(spark, path("a"), path("other"), "s").collect()
    assert prepare_reads(spark, path("poor"), None, "s", quality={}).count() == 0
    assert prepare_reads(spark, path("poor"), None, "s").count() == 3


def test_counts_alone_are_enough_for_enrichment(spark):
    counts = spark.createDataFrame([("s", "L", "1,1", 4), ("s", "L", "2,2", 6)], "selection_id string, library_id string, bb_ids string, count bigint")
    assert rows(run(counts=counts).enrichment, "bb_ids", "diversity", "total") == [("1,1", 4.0, 10), ("2,2", 4.0, 10)]


BARE = """
import os
from pyspark.sql import SparkSession
from tagloom.session import clear_work, materialize, work_dir
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
assert materialize(spark.range(5), "t").count() == 5
folder = work_dir(spark)
assert folder == work_dir(spark) and len(os.listdir(folder)) == 1
clear_work(spark)
assert not os.path.exists(folder)
print("done")
"""


def test_a_session_without_a_work_folder():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", BARE], cwd=root, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]
