"""Headline timings. Prints one JSON line.

Inputs (reads, lanes) are stored before the clock starts; results go to a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import random
import time

from pyspark.sql import functions as F

from tagloom import derived as d
from tagloom.operators import counts as C
from tagloom.operators import enrich as E
from tagloom.operators import jobs as J
from tagloom.operators import preprocess as P
from tagloom.operators import stats as S
from tagloom.operators import umi as U
from tagloom.operators import vendor as V
from tagloom.operators.decode import DecodeSettings, decode, prepare_tables
from tagloom.operators.decode_groups import decode_groups, prepare_groups
from tagloom.operators.indel_search import search_indels
from tagloom.operators.layout import build_library_sections
from tagloom.plans import query_inputs as Q
from tagloom.plans.selection_run import UNLISTED
from tagloom.session import local_session, materialize
from tagloom.sources import tables
from tagloom.sources.fastq import read_fastq, with_ordinal
from tagloom.sources.selections import selections_df

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def discard(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS)
    times: dict[str, float] = {}

    def clock(name, work):
        start = time.perf_counter()
        out = work()
        times[name] = round(time.perf_counter() - start, 3)
        return out

    reads = Q.staged_reads(spark, SF_DIR)
    n_reads, length = reads.count(), reads.selectExpr("avg(length(seq))").first()[0]
    noisy = materialize(d.noisy_reads(spark, SF_DIR), "noisy")
    r1, r2 = [materialize(side, "mate") for side in d.derived_pairs(spark, SF_DIR)]
    lanes = Q.write_lanes(d.read_lines(spark, SF_DIR), d.reads_of, "lanes")
    sections = materialize(build_library_sections(d.derived_library_tags(spark, SF_DIR), d.CONFIG), "sections")
    blocks = materialize(d.derived_building_blocks(spark, SF_DIR), "blocks")
    vendor, log, usage = Q.vendor_folder(spark, SF_DIR), Q.log_folder(spark, SF_DIR), Q.usage_folder(spark, SF_DIR)
    settings = DecodeSettings.of(revcomp="BOTH")

    lookups = clock("prepare_lookups", lambda: prepare_tables(sections, blocks, settings))
    clock("decode_reads_first", lambda: discard(decode(reads, settings=settings, tables=lookups)))
    clock("decode_reads", lambda: discard(decode(reads, settings=settings, tables=lookups)))
    outcomes = clock(
        "decode_and_tally",
        lambda: materialize(U.tally_outcomes(decode(reads, settings=settings, tables=lookups)), "outcomes"),
    )
    tally = outcomes.filter("outcome = 'ok'").drop("outcome")
    counts = clock("count_compounds", lambda: materialize(C.count_compounds(tally), "counts"))
    stats = S.decode_stats(outcomes)
    clock("decode_summary", lambda: discard(S.decode_summary(counts, stats)))
    clock("collect_umis", lambda: discard(U.collect_umis(tally)))
    clock("synthon_counts", lambda: discard(C.synthon_counts(counts)))
    clock("enrichment", lambda: discard(E.enrichment(counts, blocks)))
    clock("enrichment_rank", lambda: discard(E.rank_enrichment(E.enrichment(counts, blocks))))
    clock("enrichment_contrast", lambda: discard(E.contrast(counts, "tgt", "ctrl")))
    search = DecodeSettings.of(revcomp="BOTH", demultiplexer_algorithm="cutadapt")
    search_tables = prepare_tables(sections, blocks, search)
    clock("decode_search", lambda: discard(decode(reads, settings=search, tables=search_tables)))
    # Three tags of 20 bases and a thousand, none of which the reads hold: every read stays open and is searched to its end.
    none = F.lit(None)
    open_reads = reads.withColumns({"strand": F.lit("+"), "library_id": none.cast("string"), "lib_pos": none.cast("int"), "lib_mismatches": none.cast("int")})
    rng = random.Random(1)
    tags = [(f"T{i}", "".join(rng.choice("ACGT") for _ in range(20))) for i in range(1000)]
    for n in (3, 1000):
        some = spark.createDataFrame(tags[:n], "library_id string, tag string")
        clock(f"search_indels_{n}", lambda: discard(search_indels(open_reads, some, ["+", "-"])))  # noqa: B023
    indels = DecodeSettings.of(revcomp="BOTH", library_indels="YES", section_indels="YES")
    clock("decode_indels", lambda: discard(decode(reads, settings=indels, tables=lookups)))
    listed = [{"selection_id": f"s{k}", "decode_settings": {"revcomp": ["BOTH", "YES", "NO"][k % 3], "wiggle": ["YES", "NO"][k // 3 % 2], "library_error_tolerance": k // 6 % 3, "min_library_overlap": 8 + k // 18}} for k in range(54)]
    groups = clock("prepare_groups", lambda: prepare_groups(selections_df(spark, listed), sections, blocks))
    spread = materialize(reads.withColumn("selection_id", F.concat(F.lit("s"), F.pmod(F.xxhash64("read_id"), F.lit(54)))), "spread")
    clock("decode_selections", lambda: discard(decode_groups(spread, groups, UNLISTED)))
    clock("top_enriched_many", lambda: discard(E.top_enriched(E.enrichment(counts, blocks), 5000)))
    clock("fastq_scan", lambda: discard(read_fastq(spark, lanes, range_bytes=8 << 20)))
    clock("fastq_ordinal", lambda: discard(with_ordinal(read_fastq(spark, lanes, with_position=True, range_bytes=8 << 20))))
    clock("pair_merge", lambda: discard(P.merge_pairs(P.pair_reads(r1, r2, by="read_id"))))
    clock("read_filter", lambda: discard(P.filter_reads(noisy)))
    clock("read_qc", lambda: discard(P.read_qc(noisy, P.filter_reads(noisy))))
    clock("cycle_qc", lambda: discard(P.cycle_qc(noisy)))
    clock("vendor_validate", lambda: discard(V.validate_libraries(tables.read_vendor_tsv(spark, vendor))))
    clock(
        "job_summary",
        lambda: discard(J.job_summary(J.job_records(tables.read_run_log(spark, log)), tables.read_usage_text(spark, usage))),
    )
    per_core = n_reads / times["decode_reads"] / float(CPUS)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "reads": n_reads,
                "mean_read_length": round(length, 1),
                "cpus": int(CPUS),
                "decode_reads_per_sec_per_core": round(per_core),
            }
        )
    )


if __name__ == "__main__":
    main()
