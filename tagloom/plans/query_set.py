"""The registered queries: one per operator group, each over whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import derived as d
from tagloom.functions import dna, ids, text
from tagloom.operators import counts as C
from tagloom.operators import enrich as E
from tagloom.operators import jobs as J
from tagloom.operators import layout as L
from tagloom.operators import preprocess as P
from tagloom.operators import stats as S
from tagloom.operators import umi as U
from tagloom.operators import vendor as V
from tagloom.operators.decode import DecodeSettings, decode, prepare_tables
from tagloom.operators.indel_search import search_indels as search_with_indels
from tagloom.plans import query_inputs as Q
from tagloom.plans.selection_run import UNLISTED, decode_selections, run
from tagloom.schemas import SELECTIONS
from tagloom.session import materialize, new_path
from tagloom.sources import sinks, tables
from tagloom.sources.fastq import count_ranges, order_by_file, read_fastq, read_fastq_pairs, with_ordinal
from tagloom.sources.selections import selection_files, selections_df, validate_settings
from tagloom.streaming.incremental import incremental_counts, run_incremental

BOTH = DecodeSettings.of(revcomp="BOTH")
COMPOUND = ["selection_id", "library_id", "bb_ids"]


def r6(*names: str) -> dict:
    return {n: F.round(F.col(n), 6) for n in names}


def library_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sections = materialize(L.build_library_sections(d.derived_library_tags(spark, sf_dir), d.CONFIG), "sections")
    blocks = materialize(d.derived_building_blocks(spark, sf_dir), "building-blocks")
    return sections, blocks


def decode_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    # Keys and qualities would only be written: decoding takes no more than these.
    return Q.staged_reads(spark, sf_dir, "selection_id", "read_id", "seq"), *library_tables(spark, sf_dir)


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(*decode_inputs(spark, sf_dir), BOTH)


def stored_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(U.tally_umis(decoded(spark, sf_dir)), "tally")


def decode_outcomes(spark, sf_dir):
    return decoded(spark, sf_dir).groupBy("selection_id", "outcome").agg(F.count(F.lit(1)).alias("n"))


def shifted_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads whose insert starts 0 to 12 bases later than the layout says."""
    truth = d.truth_reads(d.spread(d.table(spark, sf_dir, "lineitem")))
    lead = F.substr(F.lit("TACTACTACTACT"), F.lit(1), (F.col("l_partkey") % 13).cast("int"))
    moved = F.concat(lead, "fwd")
    seq = F.when(F.col("rc") == 1, F.translate(F.reverse(moved), "ACGT", "TGCA")).otherwise(moved)
    return truth.select("selection_id", "read_id", seq.alias("seq"))


def decode_fallback(spark, sf_dir):
    settings = DecodeSettings.of(revcomp="BOTH", demultiplexer_algorithm="cutadapt")
    reads = materialize(shifted_reads(spark, sf_dir), "reads")
    return decode(reads, *library_tables(spark, sf_dir), settings)


def indel_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads as in `shifted_reads`; a third lost a base of the library tag, a third has one more."""
    truth = d.truth_reads(d.spread(d.table(spark, sf_dir, "lineitem")))
    which = F.col("b3") % 3
    cut = lambda a, base, b: F.concat(F.substring("fwd", 1, a), F.lit(base), F.substr("fwd", F.lit(b)))
    moved = F.when(which == 1, cut(57, "", 59)).when(which == 2, cut(58, "A", 59)).otherwise(F.col("fwd"))
    moved = F.concat(F.substr(F.lit("TACTACTACTACT"), F.lit(1), (F.col("l_partkey") % 13).cast("int")), moved)
    seq = F.when(F.col("rc") == 1, F.translate(F.reverse(moved), "ACGT", "TGCA")).otherwise(moved)
    return truth.select("selection_id", "read_id", seq.alias("seq"))


def search_indels(spark, sf_dir):
    sections, _ = library_tables(spark, sf_dir)
    none = F.lit(None)
    places = {"library_id": none.cast("string"), "lib_pos": none.cast("int"), "lib_mismatches": none.cast("int")}
    reads = materialize(indel_reads(spark, sf_dir), "reads").withColumns({"strand": F.lit("+"), **places})
    tags = sections.filter(F.col("kind") == "library").select("library_id", "tag")
    return search_with_indels(reads, tags, ["+", "-"]).drop("seq")


def indel_sections(spark, sf_dir):
    """Reads whose sections lost or gained a base, one or two of them, decoded with windows of changing length."""
    lines = d.spread(d.table(spark, sf_dir, "lineitem"))
    which = F.col("l_orderkey") % 7
    whole = d.truth_reads(lines, error=F.lit(0))
    drop = lambda text, a: F.concat(F.substr(text, F.lit(1), F.lit(a)), F.substr(text, F.lit(a + 2)))
    add = lambda text, a: F.concat(F.substr(text, F.lit(1), F.lit(a)), F.lit("A"), F.substr(text, F.lit(a + 1)))
    fwd = F.col("fwd")
    moved = (
        F.when(which == 1, drop(fwd, 30)).when(which == 2, add(fwd, 45)).when(which == 3, drop(add(fwd, 45), 16))
        .when(which == 4, drop(drop(fwd, 45), 30)).when(which == 5, drop(drop(drop(fwd, 45), 30), 16)).otherwise(fwd)
    )
    seq = F.when(F.col("rc") == 1, F.translate(F.reverse(moved), "ACGT", "TGCA")).otherwise(moved)
    reads = materialize(whole.select("selection_id", "read_id", seq.alias("seq")), "reads")
    settings = DecodeSettings.of(revcomp="BOTH", library_error_tolerance=0, library_indels="YES", section_indels="YES")
    return decode(reads, *library_tables(spark, sf_dir), settings)


def fastq_roundtrip(spark, sf_dir):
    path = new_path(spark, "fastq")
    sinks.write_fastq(d.derived_reads(spark, sf_dir), path)
    return read_fastq(spark, path, range_bytes=1 << 18).select("read_id", "seq", "qual")


def fastq_lanes_gz(spark, sf_dir):
    lanes = Q.write_lanes(d.read_lines(spark, sf_dir), d.reads_of, "lanes")
    reads = read_fastq(spark, lanes, with_position=True, range_bytes=1 << 17)
    return with_ordinal(reads, count_ranges(spark, lanes, range_bytes=1 << 17)).select("lane", "ordinal", "read_id", "seq")


def pair_merge(spark, sf_dir):
    r1, r2 = d.derived_pairs(spark, sf_dir)
    pairs = P.pair_reads(r1, r2, by="read_id")
    return P.merge_pairs(pairs).select("selection_id", "read_id", "seq", "qual", "len_r1", "len_r2", "n_corrected")


def _lane_mates(spark, sf_dir) -> DataFrame:
    sides = []
    for mate in (1, 2):
        lanes = Q.write_lanes(d.read_lines(spark, sf_dir), lambda lines: d.pairs_of(lines)[mate - 1], f"mate{mate}", Q.PLAIN_READS)
        reads = read_fastq(spark, lanes, mate, "run", with_position=True)
        sides.append(with_ordinal(reads, count_ranges(spark, lanes, mate, "run")))
    return sides[0].unionByName(sides[1])


def paired_lanes(spark, sf_dir):
    both = _lane_mates(spark, sf_dir)
    merged = P.merge_pairs(P.pair_reads(P.mates(both, "R1"), P.mates(both, "R2")))
    return merged.select("lane", "ordinal", "read_id", "read_id_r2", "seq", "n_corrected")


def paired_scan(spark, sf_dir):
    """Pairs read side by side; mate 2 lies in other lanes than mate 1 but in the same order."""
    lines = d.read_lines(spark, sf_dir)
    one = Q.write_lanes(lines, lambda rows: d.pairs_of(rows)[0], "mate1")
    two = [Q.write_lanes(lines, lambda rows: d.pairs_of(rows)[1], "mate2")]
    pairs = read_fastq_pairs(spark, one, two, "run", range_bytes=1 << 18)
    merged = P.merge_pairs(pairs)
    return merged.select("ordinal", "read_id", "read_id_r2", "seq", "n_corrected")


def pairing_qc(spark, sf_dir):
    both = _lane_mates(spark, sf_dir)
    return P.pairing_qc(P.mates(both, 1), P.mates(both, 2).filter(F.col("ordinal") % 10 != 3))


def correction_qc(spark, sf_dir):
    r1, r2 = d.derived_pairs(spark, sf_dir)
    return P.correction_qc(P.merge_pairs(P.pair_reads(r1, r2, by="read_id")))


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(d.noisy_reads(spark, sf_dir), "reads")


def read_filter(spark, sf_dir):
    return P.filter_reads(noisy(spark, sf_dir)).select("selection_id", "read_id", "seq")


def read_qc(spark, sf_dir):
    reads = noisy(spark, sf_dir)
    return P.read_qc(reads, P.filter_reads(reads))


def cycle_qc(spark, sf_dir):
    return P.cycle_qc(noisy(spark, sf_dir)).withColumns(r6("mean_quality"))


def length_histogram(spark, sf_dir):
    return P.length_histogram(noisy(spark, sf_dir))


def selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One selection per customer; some ids, file names and prefixes left blank."""
    key = F.col("c_custkey")
    yes_no = lambda n: F.when(key % n == 0, "NO").otherwise("YES")
    settings = F.struct(
        F.lit(2).alias("library_error_tolerance"),
        F.lit(8).alias("min_library_overlap"),
        yes_no(2).alias("revcomp"),
        F.when(key % 3 == 0, "cutadapt").otherwise("regex").alias("demultiplexer_algorithm"),
        F.lit("single").alias("demultiplexer_mode"),
        F.lit("NO").alias("realign"),
        yes_no(5).alias("wiggle"),
    )
    name = lambda lane: F.concat(F.lit(f" lane{lane}_"), key, F.lit(".fastq.gz "))
    files = F.array(name(1), F.when(key % 3 == 0, " ").otherwise(name(2)), F.when(key % 4 == 0, "").otherwise(name(3)))
    return d.table(spark, sf_dir, "customer").select(
        F.when(key % 7 != 0, F.concat(F.lit("s"), key)).alias("selection_id"),
        F.col("c_mktsegment").alias("target_id"),
        F.lit("-").alias("selection_condition"),
        F.lit(None).cast("date").alias("date_ran"),
        F.col("c_name").alias("additional_info"),
        files.alias("sequence_files"),
        F.array(F.lit("L00")).alias("libraries"),
        settings.alias("decode_settings"),
        F.when(key % 5 == 0, F.concat(F.lit("p"), key)).otherwise("").alias("prefix"),
    ).select(*SELECTIONS.names)


def selection_files_query(spark, sf_dir):
    return selection_files(validate_settings(selections(spark, sf_dir)))


def output_prefixes(spark, sf_dir):
    return selections(spark, sf_dir).select(
        "additional_info", ids.output_prefix("prefix", F.coalesce("selection_id", F.lit("unknown"))).alias("file_prefix")
    )


def library_layout(spark, sf_dir):
    tags = d.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("L"), "s_suppkey").alias("library_id"),
        F.substr(d.dna(F.col("s_suppkey") * 7 + 3, 14), F.lit(1), (F.col("s_suppkey") % 4 + 10).cast("int")).alias("library_tag"),
    )
    return L.build_library_sections(tags, d.CONFIG)


def collect_umis(spark, sf_dir):
    path = new_path(spark, "collected")
    sinks.write_collected(U.collect_umis(stored_tally(spark, sf_dir)), path)
    return U.explode_collected(tables.read_collected(spark, path))


def count_compounds(spark, sf_dir):
    return C.count_compounds(stored_tally(spark, sf_dir))


def tally_counts(spark, sf_dir):
    return C.count_compounds(stored_tally(spark, sf_dir), cluster=False).withColumnRenamed("count", "n_umis")


def decode_stats(spark, sf_dir):
    return S.merge_stats(S.decode_stats(U.tally_outcomes(decoded(spark, sf_dir))))


def _outcomes_and_counts(spark, sf_dir):
    outcomes = materialize(U.tally_outcomes(decoded(spark, sf_dir)), "outcomes")
    tally = outcomes.filter(F.col("outcome") == "ok").drop("outcome")
    return S.decode_stats(outcomes), C.count_compounds(tally)


def decode_summary(spark, sf_dir):
    stats, counts = _outcomes_and_counts(spark, sf_dir)
    return S.decode_summary(counts, stats).withColumns(r6("duplication_rate"))


def report_outcomes(spark, sf_dir):
    return S.outcome_columns(S.decode_stats(decoded(spark, sf_dir)), 3)


def report_histogram(spark, sf_dir):
    return S.count_histogram(Q.derived_counts(spark, sf_dir))


def union_counts(spark, sf_dir):
    base = Q.derived_counts(spark, sf_dir)
    paths = [new_path(spark, "counts") for _ in range(2)]
    base.write.parquet(paths[0])
    base.filter(F.col("library_id") == "L01").select("library_id", "bb_ids", "count").write.parquet(paths[1])
    parts = [tables.read_counts(spark, paths[0]), tables.read_counts(spark, paths[1], "again")]
    return C.union_counts(*parts)


def dedup_counts(spark, sf_dir):
    base = Q.derived_counts(spark, sf_dir)
    twice = C.union_counts(base, base.filter(F.col("count") % 2 == 0))
    return C.deduplicate(twice, drop_exact=True).unionByName(
        C.deduplicate(twice).withColumn("selection_id", F.concat("selection_id", F.lit("+")))
    )


def synthon_counts(spark, sf_dir):
    return C.synthon_counts(Q.derived_counts(spark, sf_dir))


def mixed_cycles(spark, sf_dir):
    """Synthons of libraries of two, three and four cycles in one table."""
    bb = F.split("bb_ids", ",")
    own = F.when(F.col("library_id") == "L00", F.array_join(F.slice(bb, 1, 2), ",")).when(F.col("library_id") == "L01", F.col("bb_ids"))
    return C.synthon_counts(Q.derived_counts(spark, sf_dir).withColumn("bb_ids", F.coalesce(own, F.concat_ws(",", "bb_ids", bb[0]))))


def run_counts(spark, sf_dir):
    """A run from count files that name no selection."""
    path = new_path(spark, "counts")
    Q.derived_counts(spark, sf_dir).select("library_id", "bb_ids", "count").write.parquet(path)
    result = run(counts=tables.read_counts(spark, [path]), building_blocks=d.derived_building_blocks(spark, sf_dir))
    ranked = E.rank_enrichment(result.enrichment)
    return ranked.select(*COMPOUND, "count", "total", *[c.alias(n) for n, c in r6("fold", "z_n").items()], "rank")


def unlisted_selections(spark, sf_dir):
    """Outcomes of a run that lists one of two selections, with all libraries."""
    listed = selections_df(spark, [{"selection_id": "tgt", "decode_settings": {"revcomp": "BOTH"}}])
    inputs = decode_inputs(spark, sf_dir)  # stored once for both calls
    stats = materialize(S.decode_stats(decode_selections(inputs[0], listed, *inputs[1:])), "stats")
    tally = materialize(U.tally_umis(decode(*inputs, BOTH)), "tally")
    reads = S.decode_summary(tally.limit(0).selectExpr("*", "c AS count", "c AS raw_count", "c AS dedup_count"), stats, None)
    return reads.filter("level = 'total'").select("selection_id", "ok", UNLISTED, "reads")


def many_selections(spark, sf_dir):
    """72 selections, 70 of them listed, each with libraries and settings of its own."""
    lines = d.table(spark, sf_dir, "lineitem")
    reads = d.truth_reads(d.spread(lines)).select(F.concat(F.lit("s"), F.col("l_partkey") % 72).alias("selection_id"), "read_id", "seq")
    listed = []
    for k in range(70):
        settings = {"revcomp": ["BOTH", "YES", "NO"][k // 4 % 3], "wiggle": ["YES", "NO"][k // 12 % 2], "library_error_tolerance": 2 if k % 4 == 2 else k // 36}
        listed.append({"selection_id": f"s{k}", "libraries": [["L00"], ["L02", "L01"], [], ["L02"]][k % 4], "decode_settings": settings})
    return decode_selections(materialize(reads, "reads"), selections_df(spark, listed), *library_tables(spark, sf_dir))


def enrichment(spark, sf_dir):
    scores = E.enrichment(Q.derived_counts(spark, sf_dir), d.derived_building_blocks(spark, sf_dir))
    return scores.select(
        *COMPOUND, "count", "total", "diversity", *[c.alias(n) for n, c in r6("fold", "z_n", "z_low", "z_high").items()]
    )


def synthon_enrichment(spark, sf_dir):
    counts = Q.derived_counts(spark, sf_dir)
    scores = E.synthon_enrichment(
        C.synthon_counts(counts), counts, d.derived_building_blocks(spark, sf_dir)
    )
    return scores.select(
        "selection_id", "library_id", "cycles", "synthon", "count", "diversity",
        *[c.alias(n) for n, c in r6("fold", "z_n").items()],
    )


def enrichment_contrast(spark, sf_dir):
    return E.contrast(Q.derived_counts(spark, sf_dir), "tgt", "ctrl").withColumns(r6("ratio"))


def decoded_tsv(spark, sf_dir):
    path = new_path(spark, "decoded-tsv")
    sinks.write_decoded(decoded(spark, sf_dir), path)
    return tables.read_decoded(spark, path)


def counts_parquet(spark, sf_dir):
    path = new_path(spark, "counts-parquet")
    sinks.write_counts(C.count_compounds(stored_tally(spark, sf_dir)), path)
    return spark.read.parquet(path).select(*COMPOUND, "count", "raw_count", "dedup_count")


def stats_files(spark, sf_dir):
    """Statistics as JSON files named by selection, read back into rows."""
    path = new_path(spark, "stats-json")
    sinks.write_stats_json(sinks.stats_json(S.decode_stats(U.tally_outcomes(decoded(spark, sf_dir)))), path, "decode_stats")
    found = spark.read.text(path).select(ids.file_name(F.input_file_name()).alias("file"), F.from_json("value", "map<string,map<string,bigint>>").alias("m"))
    libraries = found.select("file", F.explode("m").alias("library_id", "outcomes"))
    return libraries.select("file", F.nullif("library_id", F.lit("")).alias("library_id"), F.explode("outcomes").alias("outcome", "n"))


def written_tables(spark, sf_dir):
    """The deduplicated counts and their scores, from the files that a run leaves."""
    path = new_path(spark, "tables")
    sinks.write_table(C.deduplicate(Q.derived_counts(spark, sf_dir)), f"{path}/deduplicated.parquet")
    counts = tables.read_counts(spark, f"{path}/deduplicated.parquet")
    sinks.write_table(E.enrichment(counts, d.derived_building_blocks(spark, sf_dir)), f"{path}/enrichment.parquet")
    scores = spark.read.parquet(f"{path}/enrichment.parquet")
    return scores.select(*COMPOUND, "count", "total", "diversity", *[c.alias(n) for n, c in r6("fold", "z_n", "z_low", "z_high").items()])


def collected_json(spark, sf_dir):
    texts = sinks.collected_to_json(U.collect_umis(stored_tally(spark, sf_dir)).filter("selection_id = 'tgt'"))
    return U.explode_collected(sinks.collected_from_json(texts))


def run_jobs(spark, sf_dir) -> DataFrame:
    return materialize(J.job_records(tables.read_run_log(spark, Q.log_folder(spark, sf_dir))), "jobs")


def job_tables(spark, sf_dir):
    """The job table as the CSV file of a report, read back as text but for the duration."""
    jobs = run_jobs(spark, sf_dir)
    usage = tables.read_usage_text(spark, Q.usage_folder(spark, sf_dir))
    path = new_path(spark, "report")
    sinks.write_job_tables(jobs, J.job_summary(jobs, usage), f"{path}/jobs.csv")
    rows = spark.read.csv(f"{path}/jobs.csv", header=True)
    return rows.select("job_id", "process", "status", "exit", "started", "exited", F.expr("round(try_cast(`dur(min)` AS double), 6)").alias("duration_min"))


def job_summary_table(spark, sf_dir):
    """The summary CSV with its own heads and number formats."""
    jobs = run_jobs(spark, sf_dir)
    path = new_path(spark, "report")
    sinks.write_job_tables(jobs, J.job_summary(jobs, tables.read_usage_text(spark, Q.usage_folder(spark, sf_dir))), f"{path}/jobs.csv")
    return spark.read.csv(f"{path}/jobs_summary.csv", header=True).select("process", "n", "avg_wall_min", "avg_cpu_eff_%", "avg_mem_used_gb", "avg_mem_eff_%")


def ordered_reports(spark, sf_dir):
    """Files by name, processes by name, jobs of a run by submission, and the first job of all: what, name, place."""
    jobs = run_jobs(spark, sf_dir).withColumn("run_id", ids.file_name("run_id"))
    files = order_by_file(selection_files(selections(spark, sf_dir)).select("path").distinct(), "place")
    name = F.concat_ws(":", "run_id", "job_id")
    parts = [
        files.select(F.lit("file").alias("what"), F.col("path").alias("name"), "place"),
        J.order_by_process(J.job_summary(jobs), "place").select(F.lit("process"), "process", "place"),
        J.order_by_submission(jobs, "place").select(F.lit("job"), name, "place"),
        J.first_by(jobs, "run_id", "first_line").select(F.lit("first"), name, F.lit(0).cast("bigint")),
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def enrichment_rank(spark, sf_dir):
    scores = E.enrichment(Q.derived_counts(spark, sf_dir), d.derived_building_blocks(spark, sf_dir))
    ranked = E.rank_enrichment(scores).withColumns(r6("percent_rank"))
    return ranked.select(*COMPOUND, "rank", "percent_rank")


def top_enriched(spark, sf_dir):
    scores = E.enrichment(Q.derived_counts(spark, sf_dir), d.derived_building_blocks(spark, sf_dir))
    return E.top_enriched(scores, 10).select(*COMPOUND, "count", "place")


def top_enriched_many(spark, sf_dir):
    """More rows a library than a window takes: single reads stand for compounds, so that a library has enough rows."""
    reads = d.truth_reads(d.spread(d.table(spark, sf_dir, "lineitem")))
    rows = reads.select(
        "selection_id", F.concat(F.lit("L0"), "lib").alias("library_id"), F.col("read_id").alias("bb_ids"),
        F.when(F.col("l_orderkey") % 11 != 0, (F.col("l_partkey") * 7 + F.col("l_orderkey")) % 500 / 4).alias("z_n"),
    )
    return E.top_enriched(rows, 5000)


def top_enriched_overall(spark, sf_dir):
    scores = E.enrichment(Q.derived_counts(spark, sf_dir), d.derived_building_blocks(spark, sf_dir))
    return E.top_enriched(scores, 25, per_library=False).select(*COMPOUND, "count")


def attach_building_blocks(spark, sf_dir):
    return E.attach_building_blocks(
        Q.derived_counts(spark, sf_dir), d.derived_building_blocks(spark, sf_dir), 3
    ).select(*COMPOUND, "tag1", "tag2", "tag3")


def unused_building_blocks(spark, sf_dir):
    """Blocks of a definition built from parts: those no compound holds, and held ids it lacks."""
    part = d.table(spark, sf_dir, "part")
    defined = part.select(
        F.concat(F.lit("L0"), F.col("p_partkey") % 3).alias("library_id"),
        (F.col("p_partkey") % 2 + 1).cast("int").alias("cycle"),
        (F.floor(F.col("p_partkey") / 6) + 2).cast("int").alias("id"),
    )
    counts = Q.derived_counts(spark, sf_dir)
    return (
        E.unused_building_blocks(counts, defined)
        .withColumn("what", F.lit("unused"))
        .unionByName(E.unknown_building_blocks(counts, defined).withColumn("what", F.lit("unknown")))
    )


def library_diversity(spark, sf_dir):
    blocks = d.derived_building_blocks(spark, sf_dir)
    return E.library_diversity(blocks).withColumn("cycles", F.lit("all")).unionByName(
        E.library_diversity(blocks, [1, 3]).withColumn("cycles", F.lit("1,3"))
    )


def vendor_rows(spark, sf_dir) -> DataFrame:
    return materialize(tables.read_vendor_tsv(spark, Q.vendor_folder(spark, sf_dir)), "vendor-rows")


def vendor_validate(spark, sf_dir):
    return V.validate_libraries(vendor_rows(spark, sf_dir))


def vendor_totals(spark, sf_dir):
    return V.conversion_totals(V.validate_libraries(vendor_rows(spark, sf_dir)))


def vendor_max_index(spark, sf_dir):
    return V.max_index_per_cycle(vendor_rows(spark, sf_dir)).select("library_id", "cycle", "max_index")


def vendor_null_tags(spark, sf_dir):
    rows = vendor_rows(spark, sf_dir)
    return V.null_tag_rows(rows).select("library_id", "hits_index", "cycle")


def _converted(spark, sf_dir) -> str:
    out = new_path(spark, "definitions")
    verdicts, sections, sets, blocks = V.convert_libraries(vendor_rows(spark, sf_dir), d.CONFIG)
    sinks.write_library_defs(sections, sets, blocks, out)
    return out


def vendor_convert(spark, sf_dir):
    return tables.read_building_blocks(spark, f"{_converted(spark, sf_dir)}/building_blocks")


def vendor_libraries(spark, sf_dir):
    return tables.read_libraries(spark, f"{_converted(spark, sf_dir)}/libraries")


def vendor_sets(spark, sf_dir):
    return tables.read_library_sets(spark, f"{_converted(spark, sf_dir)}/libraries")


def job_records(spark, sf_dir) -> DataFrame:
    jobs = J.job_records(tables.read_run_log(spark, Q.log_folder(spark, sf_dir)))
    return jobs.select(
        ids.file_name("run_id").alias("run_id"), "job_id", "process", "status", "exit_code",
        F.unix_millis("started").alias("started_ms"), F.unix_millis("exited").alias("exited_ms"), "duration_min",
    )


def job_summary(spark, sf_dir):
    key = F.col("n_nationkey")
    known = F.when(key == 0, "__default__").when(key == 1, "DecodeChunk|Report").when(key == 2, "CONCAT")
    requested = d.table(spark, sf_dir, "nation").select(
        F.coalesce(known, "n_name").alias("process"),
        F.when(key == 0, "1").when(key != 1, "4").alias("cpus"),
        F.when(key != 2, F.concat(key * 4 + 4, F.lit(" GB"))).alias("memory"),
        F.when(key != 1, F.concat(key + 1, F.lit("h"))).alias("time"),
    )
    jobs = J.job_records(tables.read_run_log(spark, Q.log_folder(spark, sf_dir)))
    return J.job_summary(jobs, requested=requested).withColumns(r6("avg_dur_min", "sem_dur_min"))


def job_usage_summary(spark, sf_dir):
    jobs = J.job_records(tables.read_run_log(spark, Q.log_folder(spark, sf_dir)))
    usage = tables.read_usage_text(spark, Q.usage_folder(spark, sf_dir))
    summary = J.job_summary(jobs, usage)
    return summary.withColumns(r6(*[c for c in summary.columns if c[:4] in ("avg_", "sem_")]))


def job_status(spark, sf_dir):
    return J.job_status_counts(J.job_records(tables.read_run_log(spark, Q.log_folder(spark, sf_dir))))


def usage_records(spark, sf_dir):
    return tables.read_usage_text(spark, Q.usage_folder(spark, sf_dir))


def incremental(spark, sf_dir):
    """Two rounds of arriving files; the second resumes from the checkpoint of the first."""
    sections, blocks = library_tables(spark, sf_dir)
    lookups = prepare_tables(sections, blocks, BOTH)
    in_dir, out, mark = [new_path(spark, n) for n in ("arriving", "partial", "stream")]
    reads = Q.staged_reads(spark, sf_dir)
    for turn in range(2):
        for name in ("ctrl", "tgt"):
            part = reads.filter((F.col("selection_id") == name) & (F.col("l_orderkey") % 2 == turn))
            sinks.fastq_text(part).write.mode("append").text(f"{in_dir}/{name}")
        run_incremental(spark, in_dir, mark, out, sections, blocks, BOTH, tables=lookups)
    return incremental_counts(spark, out)[0]


def sequence_functions(spark, sf_dir):
    truth = d.truth_reads(d.table(spark, sf_dir, "lineitem"))
    a, b = F.substring("fwd", 1, 24), F.substring("fwd", 2, 24)
    return truth.select(
        "read_id",
        dna.revcomp("seq").alias("rc"),
        dna.hamming(a, b).alias("mismatches"),
        dna.levenshtein_within(a, b, 2).alias("near"),
        dna.extract_section("seq", 11, 12, -1).alias("section"),
        dna.phred(F.substring("seq", 3, 1)).alias("q"),
        dna.n_mask(F.col("b1")).alias("mask"),
        ids.bb_set_name(F.concat(F.lit("L0"), "lib"), F.col("b2")).alias("set_name"),
        ids.bb_string(ids.bb_array(F.concat_ws(",", "b3", "b1"))).alias("bb_ids"),
        ids.parse_error_correction(F.concat(F.lit("levenshtein_dist:"), "b2", F.lit(",asymmetrical")))["distance"].alias("distance"),
    )


def text_functions(spark, sf_dir):
    events = d.table(spark, sf_dir, "events")
    n = F.col("event_id")
    block = F.concat(F.lit("jobId: "), n, F.lit("; status: A; status: B"), n % 7, F.lit(" ; exit: 0"))
    return events.select(
        "event_id",
        text.wall_to_min(F.concat(n % 5, F.lit(":10:"), n % 60)).alias("wall"),
        text.pct_to_double(F.concat(n % 100, F.lit(".5%"))).alias("pct"),
        text.mem_to_gb(F.concat(n % 2048, F.when(n % 2 == 0, " mb").otherwise("KB"))).alias("gb"),
        text.base_process_name(F.concat(F.col("event_type"), F.lit(" (x)"))).alias("name"),
        text.kv_value(block, "status").alias("status"),
        text.parse_kv_block(block)["jobId"].alias("job_id"),
        ids.library_id_from_path(F.concat(F.lit("/a/b.c/vendor_x_L"), n, F.lit(".tsv"))).alias("lib"),
        text.fmt_float("value", 3).alias("shown"),
    )


QUERIES = {
    "decode_reads": decoded,
    "decode_outcomes": decode_outcomes,
    "decode_fallback": decode_fallback,
    "search_indels": search_indels,
    "indel_sections": indel_sections,
    "fastq_roundtrip": fastq_roundtrip,
    "fastq_lanes_gz": fastq_lanes_gz,
    "pair_merge": pair_merge,
    "paired_lanes": paired_lanes,
    "paired_scan": paired_scan,
    "pairing_qc": pairing_qc,
    "correction_qc": correction_qc,
    "read_filter": read_filter,
    "read_qc": read_qc,
    "cycle_qc": cycle_qc,
    "length_histogram": length_histogram,
    "selection_files": selection_files_query,
    "output_prefixes": output_prefixes,
    "library_layout": library_layout,
    "collect_umis": collect_umis,
    "count_compounds": count_compounds,
    "tally_counts": tally_counts,
    "decode_stats": decode_stats,
    "decode_summary": decode_summary,
    "report_outcomes": report_outcomes,
    "report_histogram": report_histogram,
    "union_counts": union_counts,
    "dedup_counts": dedup_counts,
    "synthon_counts": synthon_counts,
    "mixed_cycles": mixed_cycles,
    "run_counts": run_counts,
    "unlisted_selections": unlisted_selections,
    "decode_selections": many_selections,
    "enrichment": enrichment,
    "synthon_enrichment": synthon_enrichment,
    "enrichment_contrast": enrichment_contrast,
    "decoded_tsv": decoded_tsv,
    "counts_parquet": counts_parquet,
    "stats_files": stats_files,
    "written_tables": written_tables,
    "collected_json": collected_json,
    "job_tables": job_tables,
    "job_summary_table": job_summary_table,
    "ordered_reports": ordered_reports,
    "enrichment_rank": enrichment_rank,
    "top_enriched": top_enriched,
    "top_enriched_many": top_enriched_many,
    "top_enriched_overall": top_enriched_overall,
    "attach_building_blocks": attach_building_blocks,
    "unused_building_blocks": unused_building_blocks,
    "library_diversity": library_diversity,
    "vendor_validate": vendor_validate,
    "vendor_totals": vendor_totals,
    "vendor_max_index": vendor_max_index,
    "vendor_null_tags": vendor_null_tags,
    "vendor_convert": vendor_convert,
    "vendor_libraries": vendor_libraries,
    "vendor_sets": vendor_sets,
    "job_records": job_records,
    "job_summary": job_summary,
    "job_usage_summary": job_usage_summary,
    "job_status": job_status,
    "usage_records": usage_records,
    "incremental_counts": incremental,
    "sequence_functions": sequence_functions,
    "text_functions": text_functions,
}
