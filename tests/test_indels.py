"""Library tags and sections with insertions and deletions, and selections of many settings in one scan."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom import derived as d
from tagloom.operators import section_indels as SI
from tagloom.operators.decode import DecodeSettings, decode
from tagloom.operators.decode_groups import decode_groups, prepare_groups
from tagloom.operators.indel_search import TagIndex, find_tags, search_indels
from tagloom.operators.layout import build_library_sections
from tagloom.plans.selection_run import UNLISTED, decode_selections
from tagloom.session import materialize
from tagloom.sources.selections import selections_df


def table_of(tag, read):
    """Distances of the tag to the stretches that end at each place and begin anywhere."""
    column = list(range(len(tag) + 1))
    ends = [column[-1]]
    for c in read:
        new = [0]
        for i, t in enumerate(tag, start=1):
            new.append(min(column[i - 1] + (t != c), column[i] + 1, new[i - 1] + 1))
        column = new
        ends.append(column[-1])
    return ends


def mutated(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        p, kind = rng.randrange(len(text)), rng.random()
        if kind < 0.34:
            text[p] = rng.choice("ACGTN")
        elif kind < 0.67 and len(text) > 1:
            del text[p]
        else:
            text.insert(p, rng.choice("ACGT"))
    return "".join(text)


def bases(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


@pytest.mark.parametrize("seed", range(12))
def test_search_against_brute_force(seed):
    """Tags of 8 to 200 bases, reads that hold them with edits, at their ends, or not at all."""
    rng = random.Random(seed)
    t = rng.choice([0, 1, 2, 3])
    tags = [(f"L{i}", bases(rng, rng.choice([8, 12, 12, 20, 40, 70, 200]))) for i in range(rng.choice([1, 3, 20]))] + [("L0", bases(rng, 12))]
    reads = ["", "A", "N" * 50]
    for _ in range(30):
        tag = rng.choice(tags)[1]
        reads.append(bases(rng, rng.randrange(30)) + mutated(rng, tag, rng.choice([0, 1, 2, 3, 4])) + bases(rng, rng.randrange(30)))
    found = list(zip(*(x.tolist() for x in find_tags(TagIndex(tags, t), [r.encode() for r in reads]))))
    for read, (distance, tag, start, end, surplus) in zip(reads, found):
        ends = [table_of(x, read) for _, x in tags]
        least = min(map(min, ends))
        if least > t:
            assert distance == -1
            continue
        near = [i for i, e in enumerate(ends) if min(e) == least]
        first = min(ends[i].index(least) for i in near)
        own = next(i for i in near if ends[i].index(least) == first)
        text = tags[own][1]
        sizes = [n for n in range(first + 1) if SI.edit_distance(text, read[first - n : first]) == least]
        size = min(sizes, key=lambda n: (abs(n - len(text)), n))
        assert (distance, start, end, surplus) == (least, first - size, first, size - len(text))
        assert tag == (own if len({tags[i][0] for i in near}) == 1 else -1)


def test_short_tags_are_refused():
    with pytest.raises(ValueError):
        TagIndex([("L", "AC")], 2)


def test_only_open_reads_are_searched_and_blocks_agree(spark):
    rng = random.Random(3)
    tags = [(f"L{i:02d}", bases(rng, 16)) for i in range(40)]
    seqs = [bases(rng, 20) + mutated(rng, rng.choice(tags)[1], rng.choice([0, 1, 2])) + bases(rng, 20) for _ in range(60)] + ["", None]
    rows = [(str(i), s, "+", "X" if i % 7 == 0 else None, 5 if i % 7 == 0 else None, 0 if i % 7 == 0 else None) for i, s in enumerate(seqs)]
    called = spark.createDataFrame(rows, "read_id string, seq string, strand string, library_id string, lib_pos int, lib_mismatches int")
    libraries = spark.createDataFrame(tags, "library_id string, tag string")
    whole = {r.read_id: tuple(r) for r in search_indels(called, libraries, ["+", "-"]).collect()}
    assert all(whole[str(i)][3:5] == ("X", 5) for i in range(0, len(seqs), 7)) and sum(r[3] is not None for r in whole.values()) > 50
    blocks = {r.read_id: tuple(r) for r in search_indels(called, libraries, ["+", "-"], tag_bytes=200).collect()}
    assert blocks == whole


@pytest.mark.parametrize("most", [1, 2])
def test_deleted_forms_find_every_near_tag(most):
    rng = random.Random(most)
    tags = [(1, i, bases(rng, 6), most) for i in range(60)]
    index = SI.SectionIndex(tags)
    for _ in range(200):
        window = mutated(rng, rng.choice(tags)[2], rng.choice([0, 1, 2, 3]))
        want = sorted((x, i) for _, i, t, _ in tags if (x := SI.edit_distance(t, window)) <= most)
        assert sorted(index.near(1, window)) == want


@pytest.fixture(scope="module")
def defs(spark, sf):
    sections = materialize(build_library_sections(d.derived_library_tags(spark, sf), d.CONFIG), "s")
    return sections, materialize(d.derived_building_blocks(spark, sf), "b")


def read_of(lib=0, b1=3, b2=2, b3=3, umi="ACGTAACCGGTT"):
    dna = lambda x: "".join("ACGT"[x // 4**k % 4] for k in range(4)) * 3
    return [d.PRIMER1, dna(b1 + 16), "AA", dna(b2 + 64), "CC", dna(b3 + 128), "GG", dna(lib * 41 + 27), umi, d.PRIMER2]


def edited(parts, **edits):
    """Sections by name: a number drops that base, a text is put before the fifth base."""
    place = {"b1": 1, "b2": 3, "b3": 5, "lib": 7}
    parts = list(parts)
    for name, what in edits.items():
        p = parts[place[name]]
        parts[place[name]] = p[:4] + what + p[4:] if isinstance(what, str) else p[:what] + p[what + 1 :]
    return "".join(parts)


def test_sections_follow_the_changes_before_them(spark, defs):
    seqs = [
        edited(read_of()), edited(read_of(), b2=5), edited(read_of(), b3="T", b1=4), edited(read_of(), b3=5, b2=6), edited(read_of(), b3=5, b2=6, b1=7),
        edited(read_of(lib=2), lib=5, b3=3), edited(read_of(lib=2), lib="A"), "TTT" + edited(read_of(lib=2), lib="A"),
    ]
    reads = spark.createDataFrame([("s", str(i), s) for i, s in enumerate(seqs)], "selection_id string, read_id string, seq string")
    settings = DecodeSettings.of(revcomp="NO", library_indels="YES", section_indels="YES", library_error_tolerance=1)
    got = sorted(decode(reads, *defs, settings).collect(), key=lambda r: int(r.read_id))
    assert [(r.bb_ids, r.umi, r.outcome) for r in got] == [("3,2,3", "ACGTAACCGGTT", "ok")] * len(seqs)
    assert [r.library_id for r in got] == ["L00"] * 5 + ["L02"] * 3
    plain = decode(reads, *defs, DecodeSettings.of(revcomp="NO")).filter("outcome = 'ok'").count()
    assert plain == 1


def test_tags_shipped_or_shuffled_give_the_same_calls(spark, sf, defs, monkeypatch):
    lines = d.table(spark, sf, "lineitem")
    seq = F.concat(F.substring("fwd", 1, 30), F.substr("fwd", F.lit(32)))
    reads = materialize(d.truth_reads(lines).select("selection_id", "read_id", seq.alias("seq")), "r")
    settings = DecodeSettings.of(revcomp="NO", section_indels="YES")
    shipped = sorted(map(tuple, decode(reads, *defs, settings).collect()))
    monkeypatch.setattr(SI, "INDEX_ENTRIES", 0)
    monkeypatch.setattr(SI, "READS_PER_TASK", 300)
    assert sorted(map(tuple, decode(reads, *defs, settings).collect())) == shipped


def selections_of(spark, n):
    listed = []
    for k in range(n):
        settings = {"revcomp": ["BOTH", "YES", "NO"][k % 3], "wiggle": ["YES", "NO"][k // 3 % 2], "library_error_tolerance": k // 6 % 3, "realign": ["NO", "YES"][k // 18 % 2],
                    "demultiplexer_algorithm": ["regex", "cutadapt"][k // 36 % 2], "section_indels": ["NO", "YES"][k % 5 == 4], "library_indels": ["NO", "YES"][k % 7 == 6]}
        listed.append({"selection_id": f"s{k}", "libraries": [["L00"], ["L02", "L01"], []][k % 4 % 3], "decode_settings": settings})
    return selections_df(spark, listed)


def test_selections_decode_as_each_would_alone(spark, sf, defs):
    """72 combinations of libraries and settings against one decode for each of some of them."""
    lines = d.table(spark, sf, "lineitem")
    reads = d.truth_reads(lines).select(F.concat(F.lit("s"), F.pmod(F.xxhash64("read_id"), F.lit(73))).alias("selection_id"), "read_id", "seq")
    reads = materialize(reads, "r")
    selections = selections_of(spark, 72)
    found = materialize(decode_selections(reads, selections, *defs), "found")
    assert found.count() == reads.count() and found.filter(F.col("outcome") == UNLISTED).select("selection_id").distinct().collect()[0][0] == "s72"
    for row in selections.filter("selection_id in ('s0', 's6', 's19', 's41', 's64')").collect():
        keep = lambda df: df.filter(F.col("library_id").isin(row.libraries)) if row.libraries else df  # noqa: B023, E731
        alone = decode(reads.filter(F.col("selection_id") == row.selection_id), *map(keep, defs), DecodeSettings.of(row.decode_settings.asDict()))
        assert sorted(map(repr, found.filter(F.col("selection_id") == row.selection_id).collect())) == sorted(map(repr, alone.collect()))


def test_reads_are_scanned_once_whatever_the_number_of_groups(spark, sf, defs):
    reads = materialize(d.derived_reads(spark, sf).select("selection_id", "read_id", "seq"), "only-reads")
    texts = []
    for n in (36, 72):
        tables = prepare_groups(selections_of(spark, n), *defs)
        assert len(tables.groups) == n
        texts.append(decode_groups(reads, tables, UNLISTED)._jdf.queryExecution().optimizedPlan().toString())
    scans = [sum("seq#" in line and "Relation" in line for line in t.split("\n")) for t in texts]
    joins = [t.count("Join ") for t in texts]
    assert scans == [1, 1] and joins[0] == joins[1]
