from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions import dna, ids, text


def one(spark, column, **values):
    names = list(values) or ["x"]
    kinds = {str: "string", int: "bigint", float: "double"}
    schema = ", ".join(f"{n} {kinds[type(values.get(n, 'x'))]}" for n in names)
    return spark.createDataFrame([tuple(values.values()) or ("x",)], schema).select(column.alias("v")).first().v


def test_revcomp(spark):
    assert one(spark, dna.revcomp("s"), s="AACGTN") == "NACGTT"


def test_revcomp_is_its_own_inverse(spark):
    texts = [("ACGTNACG",), ("",), ("TTTT",), (None,)]
    df = spark.createDataFrame(texts, "s string").withColumn("back", dna.revcomp(dna.revcomp("s")))
    assert all(r.s == r.back for r in df.collect())


def test_hamming(spark):
    data = [("ACGT", "ACGA", 1), ("", "", 0), ("A", "AC", None), ("AAAA", "TTTT", 4)]
    df = spark.createDataFrame(data, "a string, b string, want int")
    assert all(r.got == r.want for r in df.withColumn("got", dna.hamming("a", "b")).collect())


def test_levenshtein_within(spark):
    assert one(spark, dna.levenshtein_within("a", "b", 1), a="ACGT", b="AGT") is True
    assert one(spark, dna.levenshtein_within("a", "b", 1), a="ACGT", b="TGCA") is False


def test_extract_section(spark):
    assert one(spark, dna.extract_section("s", 2, 3, 1), s="ABCDEFG") == "DEF"
    assert one(spark, dna.extract_section("s", 0, 3, -1), s="ABCDEFG") is None
    assert one(spark, dna.extract_section("s", F.lit(5), 4), s="ABCDEFG") == "FG"


def test_strand_section_equals_reversing_first(spark):
    seq = "AACCGGTTACGTN"
    for base in range(0, 10):
        for rel in (-3, 0, 4):
            at = base + rel
            col = dna.strand_section("s", f"length(s) - {base}", "-1", str(at), rel, 5)
            got = one(spark, dna.revcomp(col), s=seq)
            back = seq[::-1].translate(str.maketrans("ACGTN", "TGCAN"))
            want = back[at : at + 5] if at >= 0 else None
            assert (got or None) == (want or None)


def test_phred_and_mask(spark):
    assert one(spark, dna.phred("s"), s="I") == 40
    assert one(spark, dna.n_mask(3)) == "NNN"


def test_names(spark):
    assert one(spark, ids.bb_set_name("s", F.lit(2)), s="L01") == "L01_BBC"
    assert one(spark, ids.library_id_from_path("s"), s="/x/some_thing_L01.tsv") == "L01"
    assert one(spark, ids.library_id_from_path("s"), s="/x/L07") == "L07"
    assert one(spark, ids.file_stem("s"), s="/x/a.b.tsv") == "a.b"
    assert one(spark, ids.file_stem("s"), s="/x/.hidden") == ".hidden"


def test_packed_key(spark):
    assert one(spark, ids.bb_array("s"), s="1,20,3") == [1, 20, 3]
    assert one(spark, ids.bb_string(ids.bb_array("s")), s="1,20,3") == "1,20,3"


def test_error_correction(spark):
    got = one(spark, ids.parse_error_correction("s"), s="levenshtein_dist:1,asymmetrical")
    assert tuple(got) == ("levenshtein_dist", 1, "asymmetrical")
    assert tuple(one(spark, ids.parse_error_correction("s"), s="levenshtein_dist:2")) == ("levenshtein_dist", 2, None)


def test_output_prefix(spark):
    df = spark.createDataFrame([("p", "s"), ("", "s"), (None, "s")], "p string, s string")
    assert [r[0] for r in df.select(ids.output_prefix("p", "s")).collect()] == ["p", "s", "s"]


def test_wall_clock(spark):
    cases = {"01:23:45": 83.75, "1-02:03:04": None, "00:30": None, "a:b:c": None, "": None}
    for given_text, want in cases.items():
        assert one(spark, text.wall_to_min("s"), s=given_text) == want


def test_percent_and_memory(spark):
    assert one(spark, text.pct_to_double("s"), s="85.71%") == 85.71
    assert one(spark, text.pct_to_double("s"), s="n/a") is None
    for given_text, want in {"512 MB": 0.5, "2gb": 2.0, "1 TB": 1024.0, "1048576 KB": 1.0, "5 B": None}.items():
        assert one(spark, text.mem_to_gb("s"), s=given_text) == want


def test_process_name(spark):
    cases = {
        "DECODE:DecodeChunk (merged)": "DecodeChunk",
        "A:B:C (1)": "B:C",
        "Plain": "Plain",
        "lower:x": "lower:x",
        "X (1) (2)": "X (1)",
    }
    for given_text, want in cases.items():
        assert one(spark, text.base_process_name("s"), s=given_text) == want


def test_key_values(spark):
    block = "jobId: 12; status: A ; status: B; exit: 0"
    assert one(spark, text.kv_value("s", "status"), s=block) == "B"
    assert one(spark, text.kv_value("s", "none"), s=block) is None
    assert one(spark, text.parse_kv_block("s"), s=block) == {"jobId": "12", "status": "B", "exit": "0"}


def test_times(spark):
    assert one(spark, F.unix_millis(text.iso_to_ts("s")), s="2024-01-01T00:00:01.500Z") == 1704067201500
    assert one(spark, text.iso_to_ts("s"), s="soon") is None
    assert one(spark, F.unix_millis(text.epoch_ms_to_ts("s")), s="1704067201500") == 1704067201500


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 1e6, allow_nan=False), min_size=40, max_size=40))
def test_rounding_is_that_of_the_binary_value(spark, values):
    values = values + [2.675, 0.125, 0.375, 1.005, 1.115, 0.145, 1.015, 0.0, 3.0] + [round(v, 3) for v in values]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.withColumn("r", text.round_binary("x")).collect():
        assert r.r == round(r.x, 2), r.x


def test_number_text(spark):
    df = spark.createDataFrame([(2.675,), (None,)], "x double")
    assert rows(df.select(text.fmt_float("x"))) == [("-",), ("2.67",)]


def test_standard_error(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 1.0), ("b", None)], "k string, x double")
    assert rows(df.groupBy("k").agg(text.sem("x"))) == [("a", 1.0), ("b", None)]
