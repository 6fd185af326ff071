import itertools
import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tagloom import derived as d
from tagloom.operators.counts import count_compounds
from tagloom.operators.decode import DecodeSettings, decode, outcome_names, restrict_libraries
from tagloom.operators.layout import build_library_sections, read_layouts
from tagloom.operators.search import search_batch
from tagloom.operators.umi import tally_umis
from tagloom.operators.variants import building_block_variants, edit_variants, library_variants
from tagloom.session import materialize

CONFIG = {
    "primer1_tag": "GATTACA",
    "primer1_overhang": "G",
    "primer2_tag": "TTTT",
    "bb_overhangs": ["AC", "GT"],
    "bb_length": 6,
    "umi_length": 4,
    "error_correction": "levenshtein_dist:1,asymmetrical",
}
LIBRARIES = {"L1": "ACGTTGCAAC", "L2": "TTGACCGTGA"}
BLOCKS = {1: {1: "AAAAAA", 2: "CCCCCC", 3: "AAAACC", 4: "TCGATC"}, 2: {1: "GGGGGG", 2: "TTTTTT", 3: "GTCATC"}}


def read(bb1="AAAAAA", bb2="GGGGGG", lib="L1", umi="ACGT", lead=""):
    return lead + "GATTACA" + "G" + bb1 + "AC" + bb2 + "GT" + LIBRARIES.get(lib, lib) + umi + "TTTT"


@pytest.fixture(scope="module")
def defs(spark):
    tags = spark.createDataFrame(list(LIBRARIES.items()), "library_id string, library_tag string")
    sections = materialize(build_library_sections(tags, CONFIG), "s")
    blocks = [(lib, c, "x", i, t) for lib in LIBRARIES for c, b in BLOCKS.items() for i, t in b.items()]
    return sections, spark.createDataFrame(
        blocks, "library_id string, cycle int, bb_set_name string, id int, tag string"
    )


def call(spark, defs, seqs, **settings):
    settings = {"revcomp": "NO", **settings}
    reads = spark.createDataFrame([("s", str(i), s) for i, s in enumerate(seqs)], "selection_id string, read_id string, seq string")
    got = decode(reads, *defs, DecodeSettings.of(settings)).collect()
    return [tuple(r[2:]) for r in sorted(got, key=lambda r: int(r.read_id))]


def revcomp(s):
    return s[::-1].translate(str.maketrans("ACGTN", "TGCAN"))


def test_layout(defs):
    (layout, libraries), = read_layouts(defs[0]).items()
    assert libraries == ["L1", "L2"]
    assert (layout.library_start, layout.tag_length, layout.umi_offset, layout.umi_length) == (24, 10, 10, 4)
    assert layout.bbs == ((1, -16, 6), (2, -8, 6))


def test_outcomes(spark, defs):
    got = call(
        spark, defs,
        [
            read(),
            read(bb1="AAAAAT"),  # one mismatch, unique
            read(bb1="AAAAAC"),  # one mismatch from two tags
            read(bb1="GTGTGT"),
            read(bb2="CACACA"),
            read(umi="ACNT"),
            read()[:36],
            read(lib="GGGGGGGGGG"),
            read()[:20],
            read(lib="ACGTTGCATT"),  # two mismatches
            read(lib="ACGTTGCTTT"),  # three
        ],
        wiggle="NO",
    )
    assert [g[-1] for g in got] == [
        "ok", "ok", "bb1_ambiguous", "bb1_unmatched", "bb2_unmatched", "umi_invalid", "umi_invalid",
        "no_library", "too_short", "ok", "no_library",
    ]
    assert got[0] == ("+", "L1", "1,1", "ACGT", 0, "ok")
    assert got[9][4] == 2
    assert got[2][2] is None and got[2][3] is None


def test_wiggle(spark, defs):
    seqs = [read(lead="T"), read()[1:], read(lead="TT")]
    assert [g[-1] for g in call(spark, defs, seqs)] == ["ok", "ok", "no_library"]
    assert [g[-1] for g in call(spark, defs, seqs, wiggle="NO")] == ["no_library"] * 3


def test_a_later_shift_can_settle_an_ambiguous_block(spark, defs):
    # In place the block is one mismatch from two tags; one base to the left it is near one only.
    assert call(spark, defs, [read(bb1="AAAAAC")])[0][2] == "1,1"


def test_section_shift_is_relative_to_library_tag(spark, defs):
    # A base lost between the second block and the tag: both blocks sit one further left.
    seq = "GATTACA" + "G" + "CCCCCC" + "AC" + "TTTTTT" + "G" + LIBRARIES["L2"] + "ACGT"
    assert call(spark, defs, [seq])[0][:4] == ("+", "L2", "2,2", "ACGT")


def test_orientation(spark, defs):
    seqs = [read(), revcomp(read())]
    assert [g[-1] for g in call(spark, defs, seqs, revcomp="YES")] == ["no_library", "ok"]
    both = call(spark, defs, seqs, revcomp="BOTH")
    assert [(g[0], g[2], g[3]) for g in both] == [("+", "1,1", "ACGT"), ("-", "1,1", "ACGT")]


def test_library_tag_cut_off_by_the_read_end(spark, defs):
    whole = read()
    assert [g[-1] for g in call(spark, defs, [whole[:32], whole[:31], whole[:30]])] == [
        "umi_invalid", "no_library", "too_short",
    ]
    assert call(spark, defs, [whole[:31]], min_library_overlap=7)[0][1] == "L1"


def test_unread_bases_are_mismatches(spark, defs):
    assert [g[-1] for g in call(spark, defs, [read(lib="NCGTTGCAAN"), read(lib="NCGTTGCNAN")])] == ["ok", "no_library"]
    assert call(spark, defs, [read(bb1="CCNCCC")])[0][2] == "2,1"


def test_two_libraries_tied(spark):
    tags = spark.createDataFrame([("A", "AAAAAAAAAA"), ("B", "AAAAAAAACC")], "library_id string, library_tag string")
    blocks = spark.createDataFrame([("A", 1, "x", 1, "AAAAAA")], "library_id string, cycle int, bb_set_name string, id int, tag string")
    sections = build_library_sections(tags, {**CONFIG, "bb_overhangs": ["AC"]})
    seq = "GATTACAG" + "AAAAAA" + "AC" + "AAAAAAAAAC" + "ACGT"
    assert call(spark, (sections, blocks), [seq], wiggle="NO")[0][-1] == "ambiguous_library"


def test_search_mode_finds_moved_inserts(spark, defs):
    seqs = [read(lead="TGTGTGTGTGT"), revcomp(read(lead="TGTGT")), "TG" * 20, None]
    got = call(spark, defs, seqs, demultiplexer_algorithm="cutadapt", revcomp="BOTH")
    assert [(g[0], g[-1]) for g in got] == [("+", "ok"), ("-", "ok"), ("+", "no_library"), ("+", "too_short")]


def test_search_kernel_against_brute_force():
    rng = random.Random(5)
    draw = lambda n: "".join(rng.choice("ACGT") for _ in range(n)).encode()
    tags = [(f"L{i}", draw(rng.choice([8, 10]))) for i in range(5)]
    seqs = [draw(rng.randint(0, 40)) for _ in range(300)]
    mm, lib, pos = search_batch(seqs, tags, 2, 6)
    for i, s in enumerate(seqs):
        best = []
        for name, t in tags:
            fits = []
            for p in range(-len(t), len(s) + 1):
                a, b = max(p, 0), min(p + len(t), len(s))
                if b - a >= 6:
                    m = sum(s[k] != t[k - p] for k in range(a, b))
                    if m <= 2:
                        fits.append((m, -(b - a), p))
            if fits:
                best.append((min(fits), name))
        if not best:
            assert mm[i] == -1
            continue
        key = min(best)[0]
        names = {n for k, n in best if k[:2] == key[:2]}
        assert (mm[i], pos[i]) == (key[0], key[2])
        assert lib[i] == (names.pop() if len(names) == 1 else "*")


def test_library_mode_uses_own_layouts(spark, defs):
    other = spark.createDataFrame([("L9", "CCGGATATCC")], "library_id string, library_tag string")
    sections = defs[0].unionByName(build_library_sections(other, {**CONFIG, "bb_overhangs": ["ACAC"], "umi_length": 6}))
    more = spark.createDataFrame([("L9", 1, "x", 7, "CTCTCT")], defs[1].schema)
    blocks = defs[1].unionByName(more)
    seq9 = "GATTACAG" + "CTCTCT" + "ACAC" + "CCGGATATCC" + "ACGTAC" + "TTTT"
    got = call(spark, (sections, blocks), [read(), seq9], demultiplexer_mode="library")
    assert got == [("+", "L1", "1,1", "ACGT", 0, "ok"), ("+", "L9", "7", "ACGTAC", 0, "ok")]
    with pytest.raises(ValueError, match="layouts"):
        call(spark, (sections, blocks), [read()])


def test_realign_adds_up_shifts(spark, defs):
    # One base lost before the tag and one more between the blocks: the first block is off by two.
    seq = "CC" + "GATTACA" + "G" + "TCGATC" + "A" + "GTCATC" + "G" + LIBRARIES["L1"] + "ACGT"
    plain = call(spark, defs, [seq, read()])
    assert plain[0][-1] == "bb1_unmatched"
    again = call(spark, defs, [seq, read()], realign="YES")
    assert again[0][:4] == ("+", "L1", "4,3", "ACGT") and again[1] == plain[1]


def test_settings_are_checked():
    for bad in ({"revcomp": "MAYBE"}, {"demultiplexer_algorithm": "x"}, {"demultiplexer_mode": "x"}, {"realign": "x"},
                {"wiggle": "x"}, {"library_error_tolerance": -1}):
        with pytest.raises(ValueError):
            DecodeSettings.of(bad)


def test_restrict_libraries(spark, defs):
    assert {r[0] for r in rows(restrict_libraries(defs[0], ["L2"]), "library_id")} == {"L2"}
    chosen = spark.createDataFrame([(["L1"],)], "libraries array<string>")
    assert {r[0] for r in rows(restrict_libraries(defs[0], chosen), "library_id")} == {"L1"}


def test_variant_tables_against_brute_force(spark):
    tags = spark.createDataFrame([(1, "ACGTA"), (2, "ACGTT"), (3, "CACGT")], "id int, tag string")
    words = ["".join(w) for w in itertools.product("ACGTN", repeat=5)]

    def edit(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    for distance in (0, 1, 2):
        got = {(r.id, r.obs) for r in edit_variants(tags, distance).select("id", "obs").distinct().collect()}
        want = {(i, w) for i, t in ((1, "ACGTA"), (2, "ACGTT"), (3, "CACGT")) for w in words if edit(t, w) <= distance}
        assert got == want

    blocks = tags.select(F.lit("L").alias("library_id"), F.lit(1).alias("cycle"), "id", "tag")
    table = {r.obs: (r.id, r.ambiguous) for r in building_block_variants(blocks, 1).collect()}
    assert table["ACGTA"] == (1, False) and table["ACGTC"] == (None, True) and table["AAGTA"] == (1, False)


def test_library_variant_table_is_unique(spark):
    libs = spark.createDataFrame([(0, "A", "ACGTACGTACGT"), (0, "B", "ACGTACGTACCC")], "class_id int, library_id string, tag string")
    table = library_variants(libs, 2, 8)
    assert table.groupBy("class_id", "obs").count().filter("count > 1").count() == 0
    found = {r.obs: r.library_id for r in table.collect()}
    assert found["ACGTACGTACGT"] == "A" and found["ACGTACGT"] == "*"


def test_shuffled_lookup_equals_broadcast(spark, sf):
    reads = d.derived_reads(spark, sf).filter("l_orderkey % 10 = 0")
    sections = build_library_sections(d.derived_library_tags(spark, sf), d.CONFIG)
    blocks = d.derived_building_blocks(spark, sf)
    settings = DecodeSettings.of(revcomp="BOTH")
    one = decode(reads, sections, blocks, settings)
    two = decode(reads.repartition(3), sections, blocks, settings, broadcast_rows=10)
    plan = two._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan and "strategy=merge" in plan
    assert rows(one) == rows(two)


def test_golden_counts(spark, sf):
    """Figures computed independently for this fixture."""
    lines = d.table(spark, sf, "lineitem").withColumn("n", F.row_number().over(Window.orderBy(*d.READ_KEY)))
    reads = materialize(d.truth_reads(lines, F.concat(F.lit("r"), "n"), (F.col("n") * 7919) % 20), "golden")
    sections = build_library_sections(d.derived_library_tags(spark, sf), d.CONFIG)
    decoded = materialize(decode(reads, sections, d.derived_building_blocks(spark, sf), DecodeSettings.of(revcomp="BOTH")), "g")
    by_outcome = {r.outcome: r["count"] for r in decoded.groupBy("outcome").count().collect()}
    assert by_outcome == {"ok": 4800, "no_library": 600, "bb3_unmatched": 300, "umi_invalid": 300}
    assert set(by_outcome) <= set(outcome_names(3))
    tally = materialize(tally_umis(decoded), "t")
    total = count_compounds(tally).agg(F.count("*"), F.sum("raw_count"), F.sum("dedup_count"), F.sum("count")).first()
    assert tuple(total) == (1091, 4800, 4559, 4517)
    large = count_compounds(tally, max_group=0).agg(F.sum("count")).first()[0]
    assert large == 4517
