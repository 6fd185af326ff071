"""Registered queries against their SQL, and the plans the design relies on."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

from tagloom import derived as d  # noqa: E402
from tagloom.operators.decode import DecodeSettings, decode  # noqa: E402
from tagloom.operators.layout import build_library_sections  # noqa: E402
from tagloom.operators.umi import near_umis, tally_outcomes  # noqa: E402
from tagloom.plans.oracle import ORACLE_SQL  # noqa: E402
from tagloom.plans.query_set import QUERIES  # noqa: E402
from tagloom.session import materialize  # noqa: E402

TABLES = ["supplier", "part", "customer", "lineitem", "events", "nation"]
QUICK = [
    "decode_reads", "count_compounds", "decode_summary", "read_filter", "selection_files", "library_layout",
    "dedup_counts", "synthon_counts", "enrichment", "enrichment_rank", "top_enriched", "vendor_validate",
    "job_records", "job_summary",
]
# pair_merge and correction_qc join on read ids, which are not unique in the smallest tables.
NAMES = [n for n in QUERIES if n not in ("pair_merge", "correction_qc")] if os.environ.get("ALL_QUERIES") else QUICK


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 6)
    return str(value)


def test_each_own_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    want = con.execute(oracle_sql()[name])
    columns = [c[0] for c in want.description]
    expected = sorted(repr(tuple(map(canonical, r))) for r in want.fetchall())
    df = queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr(tuple(map(canonical, r))) for r in df.select(*columns).collect()) == expected


def test_entry(spark):
    assert entry(spark).columns == ["selection_id", "library_id", "bb_ids", "count", "raw_count", "dedup_count"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_decode_is_one_narrow_stage(spark, sf):
    reads = materialize(d.derived_reads(spark, sf), "reads")
    sections = build_library_sections(d.derived_library_tags(spark, sf), d.CONFIG)
    decoded = decode(reads, sections, d.derived_building_blocks(spark, sf), DecodeSettings.of(revcomp="BOTH"))
    text = plan(decoded)
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    assert "ReadSchema: struct<selection_id:string,read_id:string,seq:string>" in text
    # From reads to tally there is one shuffle, after a partial aggregation.
    text = plan(tally_outcomes(decoded))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_generated_code_stays_compilable(spark, sf):
    reads = materialize(d.derived_reads(spark, sf), "reads")
    sections = build_library_sections(d.derived_library_tags(spark, sf), d.CONFIG)
    blocks = d.derived_building_blocks(spark, sf)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        decoded = decode(reads, sections, blocks, DecodeSettings.of(revcomp="BOTH"))
        spans = decoded._jdf.queryExecution().debug().codegenToSeq()
        sizes = [spans.apply(i)._3().maxMethodCodeSize() for i in range(spans.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Past 8000 bytes the JVM does not compile a method.
    assert max(sizes) < 8000


def test_neighbour_search_shuffles_once(spark):
    tally = spark.createDataFrame([("s", "L", "1", "ACGT", 1)], "selection_id string, library_id string, bb_ids string, umi string, c bigint")
    text = plan(near_umis(tally))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
