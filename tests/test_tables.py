import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tagloom import derived as d
from tagloom.__main__ import main
from tagloom.operators import counts as C
from tagloom.operators import enrich as E
from tagloom.operators import jobs as J
from tagloom.operators import stats as S
from tagloom.operators import vendor as V
from tagloom.operators.layout import build_library_sections
from tagloom.plans.libraries import convert_folder
from tagloom.plans.selection_run import prepare_reads, run, write_run
from tagloom.session import materialize
from tagloom.sources import sinks, tables
from tagloom.sources.selections import selection_files, selections_df, validate_settings
from tagloom.streaming.incremental import incremental_counts, run_incremental

COUNTS = "selection_id string, library_id string, bb_ids string, count bigint, raw_count bigint, dedup_count bigint"


@pytest.fixture
def counts_parquet(spark, tmp_path):
    path = str(tmp_path / "counts.parquet")
    spark.createDataFrame(
        [("L01", "1,2,3", 10), ("L01", "1,2,4", 5), ("L02", "1,2,3", 8)], "library_id string, bb_ids string, count bigint"
    ).write.parquet(path)
    blocks = tmp_path / "data" / "building_blocks"
    blocks.mkdir(parents=True)
    for lib in ("L01", "L02"):
        for letter in "ABC":
            (blocks / f"{lib}_BB{letter}.csv").write_text("id,tag\n" + "".join(f"{i},ACGT\n" for i in range(1, 5)))
    return path


@pytest.mark.parametrize("command", ["deduplicate", "enrich"])
class TestCountCommands:
    def arguments(self, command, tmp_path, source):
        more = ["--data-dir", str(tmp_path / "data")] if command == "enrich" else []
        return [command, "--input", source, "--output", str(tmp_path / "out.parquet"), *more]

    def test_runs_and_writes_output(self, spark, counts_parquet, tmp_path, command):
        assert main(self.arguments(command, tmp_path, counts_parquet), spark) == 0
        assert (tmp_path / "out.parquet").exists()

    def test_output_holds_the_same_rows(self, spark, counts_parquet, tmp_path, command):
        main(self.arguments(command, tmp_path, counts_parquet), spark)
        out = spark.read.parquet(str(tmp_path / "out.parquet"))
        assert rows(out, "library_id", "bb_ids", "count") == [("L01", "1,2,3", 10), ("L01", "1,2,4", 5), ("L02", "1,2,3", 8)]

    def test_missing_input_fails(self, spark, tmp_path, command):
        (tmp_path / "data" / "building_blocks").mkdir(parents=True)
        with pytest.raises(Exception):
            main(self.arguments(command, tmp_path, str(tmp_path / "nonexistent.parquet")), spark)

    def test_missing_required_args_fails(self, spark, command):
        with pytest.raises(SystemExit):
            main([command], spark)


def test_counts_union_dedup_synthons(spark):
    a = spark.createDataFrame([("s", "L", "1,2", 2, 5, 3), ("s", "L", "1,3", 1, 1, 1)], COUNTS)
    b = spark.createDataFrame([("s", "L", "1,2", 2)], "selection_id string, library_id string, bb_ids string, count bigint")
    assert C.union_counts(a, b).count() == 3
    assert rows(C.deduplicate(C.union_counts(a, a))) == [("s", "L", "1,2", 4, 10, 6), ("s", "L", "1,3", 2, 2, 2)]
    assert rows(C.deduplicate(C.union_counts(a, a), drop_exact=True)) == rows(a)
    got = rows(C.synthon_counts(a), "cycles", "synthon", "n_compounds", "count")
    assert got == [("1", "1", 2, 3), ("1,2", "1,2", 1, 2), ("1,2", "1,3", 1, 1), ("2", "2", 1, 2), ("2", "3", 1, 1)]


def test_enrichment_numbers(spark):
    counts = spark.createDataFrame([("t", "L", "1,1", 30, 0, 0), ("t", "L", "1,2", 70, 0, 0), ("c", "L", "1,1", 10, 0, 0)], COUNTS)
    blocks = spark.createDataFrame([("L", 1, "x", 1, "A"), ("L", 2, "x", 1, "A"), ("L", 2, "x", 2, "C"), ("L", 1, "x", 2, "G")], "library_id string, cycle int, bb_set_name string, id int, tag string")
    got = {(r.selection_id, r.bb_ids): r for r in E.enrichment(counts, blocks).collect()}
    r = got["t", "1,1"]
    assert (r.total, r.diversity, round(r.fold, 6)) == (100, 4.0, 1.2)
    assert round(r.z_n, 6) == round(0.05 / (0.25 * 0.75) ** 0.5, 6)
    assert r.z_low < r.z_n < r.z_high
    ranked = E.rank_enrichment(E.enrichment(counts, blocks))
    assert rows(ranked.filter("selection_id = 't'"), "bb_ids", "rank", "percent_rank") == [("1,1", 2, 1.0), ("1,2", 1, 0.0)]
    assert rows(E.top_enriched(E.enrichment(counts, blocks), 1), "selection_id", "bb_ids") == [("c", "1,1"), ("t", "1,2")]
    ratio = {r.bb_ids: r.ratio for r in E.contrast(counts, "t", "c").collect()}
    assert ratio == {"1,1": (31 / 101) / (11 / 11), "1,2": (71 / 101) / (1 / 11)}
    assert rows(E.unused_building_blocks(counts, blocks)) == [("L", 1, 2)]
    odd = counts.withColumn("bb_ids", F.lit("9,1"))
    assert rows(E.unknown_building_blocks(odd, blocks)) == [("L", 1, 9)]
    assert rows(E.attach_building_blocks(odd.limit(1), blocks, 2), "tag1", "tag2") == [(None, "A")]
    assert rows(E.library_diversity(blocks, [2])) == [("L", 2.0)]


def test_statistics(spark):
    stats = spark.createDataFrame([("s", "L", "ok", 3), ("s", "L", "ok", 2), ("s", None, "no_library", 4), ("s", "M", "umi_invalid", 1)], "selection_id string, library_id string, outcome string, n bigint")
    merged = S.merge_stats(stats)
    assert rows(merged.filter("level = 'total'"), "outcome", "n") == [("no_library", 4), ("ok", 5), ("umi_invalid", 1)]
    assert merged.filter("level = 'library'").agg(F.sum("n")).first()[0] == 10
    counts = spark.createDataFrame([("s", "L", "1,2", 2, 5, 4)], COUNTS)
    summary = {(r.level, r.library_id): r for r in S.decode_summary(counts, stats, 2).collect()}
    total = summary["total", None]
    assert (total.reads, total.ok, total.compounds, total.duplication_rate) == (10, 5, 1, 1.25)
    assert summary["library", "M"].duplication_rate is None and summary["library", None].no_library == 4
    report = S.report_tables(stats, counts, 2)
    assert rows(report["count_histogram"]) == [("s", "L", 1, 1, 2)]
    assert json.loads(sinks.stats_json(stats.limit(1)).first().value) == {"L": {"ok": 3}}


VENDOR = {
    "x_OK.tsv": [(1, 1, 1, "A"), (2, 2, 1, ""), (1, 1, 2, "C"), (1, 1, 3, "G")],
    "x_FIRST.tsv": [(1, 1, 2, "A"), (1, 1, 3, "G")],
    "x_NULLFIRST.tsv": [(1, 1, "", "A"), (1, 1, 1, "A"), (1, 1, 2, "A"), (1, 1, 3, "G")],
    "x_STEP.tsv": [(1, 1, 1, "A"), (1, 1, 3, "G")],
    "x_BACK.tsv": [(1, 1, 1, "A"), (1, 1, 2, "A"), (1, 1, 1, "A"), (1, 1, 2, "G"), (1, 1, 3, "G")],
    "x_TWO.tsv": [(1, 1, 1, "A"), (1, 1, 2, "G")],
    "x_INDEX.tsv": [(1, 2, 1, "A"), (1, 1, 2, "C"), (1, 1, 3, "G")],
    "x_NULLINDEX.tsv": [("", "", 1, "A"), (1, 1, 2, "C"), (1, 1, 3, "G")],
    "x_GAP.tsv": [(1, 1, 1, "A"), (1, 1, "", "C"), (1, 1, 2, "C"), (1, 1, 3, "G")],
}


@pytest.fixture
def vendor_dir(tmp_path):
    folder = tmp_path / "vendor"
    folder.mkdir()
    for name, body in VENDOR.items():
        head = "R_coordinate\thits_index\t0\tlib_id\tACGTACGT\tL00\n"
        text = "".join(f"{r}\t{h}\t{c}\t[H]\t{t}\t000\n" for r, h, c, t in body)
        (folder / name).write_text(head + text)
    (folder / "x_MALFORMED.tsv").write_text("R_coordinate\tother\n1\t2\n")
    return str(folder)


def test_vendor_verdicts(spark, vendor_dir):
    found = tables.read_vendor_tsv(spark, vendor_dir)
    verdicts = {r.library_id: (r.verdict, r.null_tags) for r in V.validate_libraries(found).collect()}
    assert verdicts == {
        "OK": ("ok", 1), "FIRST": ("first_cycle", 0), "NULLFIRST": ("first_cycle", 0), "STEP": ("cycle_step", 0),
        "BACK": ("cycle_step", 0), "TWO": ("max_cycle", 0), "INDEX": ("index_mismatch", 0),
        "NULLINDEX": ("index_mismatch", 0), "GAP": ("ok", 0), "MALFORMED": ("malformed", 1),
    }
    assert rows(V.null_tag_rows(found.filter("library_id = 'OK'")), "line_no", "hits_index") == [(2, "2")]
    assert rows(V.max_index_per_cycle(found.filter("library_id = 'GAP'")), "cycle", "max_index") == [(1, 1.0), (2, 1.0), (3, 1.0)]
    assert rows(V.check_index_equal(found).filter("index_equal"), "library_id")[0] is not None
    assert rows(V.first_cycle(found.filter("library_id = 'FIRST'")), "first_cycle") == [(2.0,)]


def test_vendor_conversion(spark, vendor_dir, tmp_path):
    out = tmp_path / "out"
    verdicts, totals = convert_folder(spark, vendor_dir, str(out), d.CONFIG)
    assert tuple(totals.first()) == (2, 8)
    assert sorted(p.name for p in (out / "libraries").iterdir()) == ["GAP.json", "OK.json"]
    body = json.loads((out / "libraries" / "OK.json").read_text())
    assert list(body["barcode_schema"]) == ["primer1", "bb1", "bb2", "bb3", "library", "umi", "primer2"]
    assert body["barcode_schema"]["library"] == {"tag": "ACGTACGT"}
    assert body["barcode_schema"]["bb2"] == {"tag": "N" * 12, "overhang": "CC", "error_correction": d.ERROR_CORRECTION}
    assert body["barcode_schema"]["primer1"] == {"tag": d.PRIMER1, "overhang": ""}
    assert body["bb_sets"][2] == {"cycle": 3, "bb_set_name": "OK_BBC"} and body["dna_barcode_on"] == "OK_BBA"
    assert (out / "building_blocks" / "OK_BBA.csv").read_text() == "id,tag\n1,A\n2,\n"
    blocks = tables.read_building_blocks(spark, str(out / "building_blocks"))
    assert rows(blocks.filter("library_id = 'OK' and cycle = 1"), "bb_set_name", "id", "tag") == [("OK_BBA", 1, "A"), ("OK_BBA", 2, None)]
    again = tables.read_libraries(spark, str(out / "libraries")).filter("library_id = 'OK'")
    made = build_library_sections(spark.createDataFrame([("OK", "ACGTACGT")], "library_id string, library_tag string"), d.CONFIG)
    assert rows(again) == rows(made)


LOG = """\
x [SLURM] submitted process PRE:CONCAT (1) > jobId: 1; a
x [SLURM] submitted process DecodeChunk (a) > jobId: 2; a
x Task completed > TaskHandler[jobId: 9; status: COMPLETED; exit: 0; started: 1000; exited: 1970-01-01T00:01:00Z; ]
x Task completed > TaskHandler[jobId: 1; status: FAILED; exit: 1; workDir: /w started: 1000; exited: 1970-01-01T00:01:00Z; ]
x [SLURM] submitted process PRE:CONCAT (again) > jobId: 1; a
x [SLURM] submitted process Never > jobId: 3; a
x Task completed > TaskHandler[jobId: 2; status: COMPLETED; exit: 0; started: 0; exited: 1970-01-01T00:01:30Z; ] jobId: 7]
x Task completed > TaskHandler[jobId: 2; status: FAILED; exit: 2; started: -; exited: -; ]
x Task completed > TaskHandler[jobId: 1; status: COMPLETED; exit: 0; workDir: /w started: 90000; exited: 1970-01-01T00:01:00Z; ]
"""


def test_job_records(spark, tmp_path):
    (tmp_path / "run.log").write_text(LOG)
    jobs = J.job_records(tables.read_run_log(spark, str(tmp_path / "run.log")))
    got = [(r.job_id, r.process, r.status, r.exit_code, r.duration_min) for r in J.order_by_submission(jobs).collect()]
    assert got == [
        ("1", "PRE:CONCAT (again)", "COMPLETED", "0", None),  # reset by the second submission; ends before it starts
        ("2", "DecodeChunk (a)", "FAILED", "2", 1.5),  # a dash leaves the earlier times standing
        ("3", "Never", None, None, None),
    ]
    assert tuple(J.job_status_counts(jobs).first()) == (3, 1, 1, 1)
    usage = tmp_path / "usage.txt"
    usage.write_text(
        "Job ID: 2\nArray Job ID: 2_1\nCores per node: 2\nCPU Efficiency: 85.71% of 00:02:03 core-walltime\nJob Wall-clock time: 00:02:03\n"
        "Memory Utilized: 4.23 GB\nMemory Efficiency: 84.60% of 5.00 GB\nJob ID: 1\nJob Wall-clock time: 1-02:03:04\n"
    )
    used = tables.read_usage_text(spark, str(usage))
    assert rows(used.filter("job_id = 2"))[0] == ("2", "00:02:03", "85.71%", "4.23 GB", "84.60%", "5.00 GB", "2")
    requested = spark.createDataFrame([("__default__", "1", "8 GB", "30m"), ("CONCAT|Other", None, "5 GB", None)], "process string, cpus string, memory string, time string")
    summary = {r.process: r for r in J.job_summary(jobs, used, requested).collect()}
    assert summary["CONCAT"].req_memory == "5 GB" and summary["CONCAT"].req_cpus == "1" and summary["Never"].req_time == "30m"
    assert summary["CONCAT"].n == 1 and summary["CONCAT"].avg_wall_min is None
    assert summary["DecodeChunk"].avg_wall_min == 2.05 and summary["DecodeChunk"].sem_wall_min is None
    assert main(["report-jobs", "--log", str(tmp_path / "run.log"), "--usage", str(usage), "--output", str(tmp_path / "jobs.csv")], spark) == 0
    table = spark.read.csv(str(tmp_path / "jobs.csv"), header=True).collect()
    assert [r.status for r in table] == ["COMPLETED", "FAILED", "SUBMITTED"]
    assert table[1].started == "1970-01-01 00:00:00" and table[1].mem_used == "4.23 GB" and table[2].mem_used == "-"
    assert (tmp_path / "jobs_summary.csv").exists()
    assert sinks.summary_path("a/b") == "a/b_summary.csv"


def test_selections(spark):
    table = selections_df(spark, [{"selection_id": "s1", "sequence_files": "a.fastq", "libraries": ["L1"], "date_ran": "2024-01-01"},
                                  {"sequence_files": ["b", " ", "c "], "decode_settings": {"revcomp": "NO"}, "prefix": "p"}])
    assert rows(selection_files(validate_settings(table))) == [("s1", 0, "a.fastq"), ("selection", 0, "b"), ("selection", 2, "c")]
    assert [r.decode_settings.revcomp for r in table.collect()] == ["YES", "NO"]
    with pytest.raises(ValueError):
        selections_df(spark, [{"revcomp": "x"}])
    bad = table.withColumn("decode_settings", F.col("decode_settings").withField("wiggle", F.lit("PERHAPS")))
    with pytest.raises(Exception, match="wiggle must be one of"):
        validate_settings(bad).collect()


@pytest.fixture(scope="module")
def small_run(spark, sf):
    reads = materialize(d.derived_reads(spark, sf).filter("l_orderkey % 8 = 1"), "reads")
    sections = materialize(build_library_sections(d.derived_library_tags(spark, sf), d.CONFIG), "sections")
    blocks = materialize(d.derived_building_blocks(spark, sf), "blocks")
    return reads, sections, blocks


def test_run_end_to_end(spark, small_run, tmp_path):
    reads, sections, blocks = small_run
    libs = ["L00", "L01", "L02"]
    chosen = selections_df(spark, [{"selection_id": "ctrl", "libraries": libs, "revcomp": "BOTH"},
                                   {"selection_id": "tgt", "libraries": libs[:1], "revcomp": "BOTH", "prefix": "mine"}])
    with pytest.raises(ValueError):
        run(chosen, library_sections=sections, building_blocks=blocks)
    with pytest.raises(ValueError):
        run(chosen, reads=reads, counts=reads, building_blocks=blocks)
    result = run(chosen, reads=reads, library_sections=sections, building_blocks=blocks)
    assert {r[0] for r in rows(result.counts.filter("selection_id = 'tgt'").select("library_id").distinct())} == {"L00"}
    ok = result.stats.filter("outcome = 'ok'").agg(F.sum("n")).first()[0]
    assert result.counts.agg(F.sum("raw_count")).first()[0] == ok
    assert result.stats.agg(F.sum("n")).first()[0] == reads.count()
    assert result.counts.filter("count > dedup_count or dedup_count > raw_count or count < 1").count() == 0
    whole = result.synthons.filter("cycles = '1,2,3'").select("selection_id", "library_id", F.col("synthon").alias("bb_ids"), "count")
    assert rows(whole) == rows(result.counts, "selection_id", "library_id", "bb_ids", "count")
    out = str(tmp_path / "out")
    write_run(result, out, chosen)
    assert (tmp_path / "out" / "mine_decode_stats.json").exists() and (tmp_path / "out" / "ctrl_decode_summary.json").exists()
    again = run(counts=tables.read_counts(spark, f"{out}/deduplicated.parquet"), building_blocks=blocks)
    assert rows(again.enrichment) == rows(result.enrichment)


def test_arriving_files_give_the_batch_result(spark, small_run, tmp_path):
    from tagloom.operators.counts import count_compounds
    from tagloom.operators.decode import DecodeSettings, decode, prepare_tables
    from tagloom.operators.umi import tally_umis

    reads, sections, blocks = small_run
    settings = DecodeSettings.of(revcomp="BOTH")
    lookups = prepare_tables(sections, blocks, settings)
    batch = count_compounds(materialize(tally_umis(decode(reads, settings=settings, tables=lookups)), "t"))
    in_dir, mark, out = [str(tmp_path / n) for n in ("in", "mark", "out")]
    for turn in range(2):
        for name in ("ctrl", "tgt"):
            part = reads.filter((F.col("selection_id") == name) & (F.crc32("read_id") % 2 == turn))
            sinks.fastq_text(part).write.mode("append").text(f"{in_dir}/{name}")
        run_incremental(spark, in_dir, mark, out, sections, blocks, settings, tables=lookups, max_files_per_batch=3)
    counts, stats = incremental_counts(spark, out)
    assert rows(counts) == rows(batch)
    assert stats.agg(F.sum("n")).first()[0] == reads.count()


def test_prepare_reads(spark, tmp_path):
    one = "".join(f"@r{i}\n{'ACGT' * 10}\n+\n{'I' * 40}\n" for i in range(6))
    for name in ("a1", "a2", "b1", "b2"):
        (tmp_path / f"{name}.fastq").write_text(one)
    lanes = lambda m: [str(tmp_path / f"{x}{m}.fastq") for x in "ab"]
    assert prepare_reads(spark, lanes(1)).count() == 12
    merged = prepare_reads(spark, lanes(1), lanes(2), "s")
    assert merged.count() == 12 and set(merged.columns) >= {"selection_id", "read_id", "seq", "qual"}
