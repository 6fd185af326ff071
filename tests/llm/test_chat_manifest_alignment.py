"""Chat formatting, the Merkle manifest and tokeniser alignment against plain versions, with awkward rows."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import alignment, chat, manifest
from tagloom.llm.pieces import default_path
from tests.llm import cases

CONTROLS = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<<TEXT>>", "<</ROLE>>", "<|endoftext|>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- chat formatting


def wild(rng):
    parts = [*CONTROLS, "\\", "<", "[", "]", ">", "/", "s>", "INST]", " ", "\n", "é", "日本", "💩", "ok", "<\\s>", "[\\\\INST]"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(12)))


def test_escapes_are_undone_and_turns_told_apart():
    rng = random.Random(1)
    renderer = chat.Encoder(default_path("byte_bpe_50k.json"), chat.Template()).renderer
    for _ in range(3000):
        text = wild(rng)
        escaped = renderer.escape(text)
        assert renderer.unescape(escaped) == text and not any(c in escaped for c in CONTROLS)
    for _ in range(500):
        turns = [(rng.choice(["system", "user", "assistant", "tool", "", wild(rng)]), wild(rng)) for _ in range(rng.randrange(6))]
        formatted, spans = renderer.render(turns)
        assert list(renderer.parse(formatted)) == turns
        assert [renderer.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_templates_whose_marks_run_into_each_other_are_refused():
    for marks in (("[A]", "]B"), ("x", "[/A]"), ("[A", "A]"), ("\\a", "[/A]")):
        with pytest.raises(ValueError):
            chat.Template(roles=(("user", *marks),)).controls()


def test_masks_cover_the_texts_and_nothing_else():
    rng = random.Random(2)
    encoder = chat.Encoder(default_path("byte_bpe_50k.json"), chat.Template())
    for _ in range(200):
        turns = [(rng.choice(["user", "assistant"]), wild(rng) + cases.prose(rng, rng.randrange(5))) for _ in range(rng.randrange(1, 6))]
        formatted, spans = encoder.renderer.render(turns)
        ((ids, starts, ends),) = encoder.encode([formatted])
        mask = chat.loss_mask(starts, ends, spans)
        inside = [any(a <= s and e <= b for a, b in spans) for s, e in zip(starts, ends)]
        assert mask.tolist() == inside
        assert encoder.decode(ids[mask].tolist()) == "".join(formatted[a:b] for a, b in spans)


def test_parts_encode_as_the_whole(monkeypatch):
    encoder = chat.Encoder(default_path("byte_bpe_50k.json"), chat.Template())
    rng = random.Random(3)
    text = encoder.renderer.render([("user", cases.prose(rng, 400) + "  \n x\t y"), ("assistant", wild(rng) + cases.prose(rng, 300))])[0]
    whole = encoder.encode([text])[0]
    monkeypatch.setattr(chat, "ENCODE_CHARS", 50)
    for a, b in zip(whole, encoder.encode([text])[0]):
        assert np.array_equal(a, b)


SCHEMA = "conv_id long, turn long, role string, text string, part int, number int, whole string, formatted string, n_turns int"


def conversations(seed=4):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["system", "user", "assistant"]), wild(rng)) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(50, t, "assistant" if t % 2 else "user", cases.prose(rng, 30)) for t in range(300)]  # one long conversation
    rows += [(60, 0, "user", "b"), (60, 0, "user", "a"), (60, 0, "user", "a"), (60, None, "assistant", "first")]  # ties, repeated rows, no turn
    rows += [(None, 1, "assistant", "no key"), (None, 0, None, "no role"), (70, 0, "assistant", None), (71, 0, "user", ""), (72, 0, "odd\nrole", "x")]
    return rows


def plain_digest(rows):
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    out = []
    for c, turns in by.items():
        turns = [(r.decode(), x.decode()) for _, _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss)))
    return out


@pytest.mark.parametrize("piece", [1 << 20, 100])
def test_conversations_read_back(spark, monkeypatch, piece):
    """Nulls, ties, repeated rows, clashing columns, and a conversation that reaches over tasks and pieces."""
    rows = conversations()
    full = [(*r, 1, 2, "w", "f", 3) for r in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(5)
    monkeypatch.setattr(chat, "PIECE_CHARS", piece)
    formatted = chat.format_conversations(df)
    got = chat.read_back(formatted).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()
    cases.same_rows(map(tuple, got), plain_digest(rows))
    if piece == 100:
        assert formatted.filter("key = 50").count() > 20
    assert all(len(r.input_ids) == len(r.loss_mask) for r in formatted.collect())


def test_no_conversations(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


# ---- Merkle manifest


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes, fanout=3):
    out = [nodes]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([sha("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return out


def plain_manifest(rows, fanout=3):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0] is not None, r[0] or 0, sha("".join(map(field, r))), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    placed = {s: sorted(by[s], key=lambda x: x[:3]) for s in sources}
    trees = {s: levels([x[2] for x in placed[s]], fanout) for s in sources}
    top = levels([trees[s][-1][0] for s in sources], fanout)
    out = []
    for number, s in enumerate(sources):
        for place, (_, _, leaf, r) in enumerate(placed[s]):
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded, proof = sha("".join(map(field, (*r[:4], text)))), []
            for tree, at in ((trees[s], place), (top, number)):
                for level in tree[:-1]:
                    first = at // fanout * fanout
                    run = level[first : first + fanout]
                    before, after = run[: at - first], run[at - first + 1 :]
                    folded = sha("".join([*before, folded, *after]))
                    proof += before + after
                    at //= fanout
            root = top[-1][0]
            out.append((r[0], leaf, trees[s][-1][0], root, sha("".join(proof)), folded, folded == root))
    return out


DOC = "doc_id long, source string, lang string, n_chars long, text string, tree int, place int, digest string, n int, `key` string, `group` string"


def documents(seed=5):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, "", "a", "a", "a", "é", "z", f"u{i}"]), rng.choice([None, "en"]), i, None if i % 11 == 0 else f"l\n{i % 5}") for i in range(260)]
    rows += [(None, "a", None, None, "q\n"), (None, "a", None, None, "q\n"), (5, "a", "x", 1, "t\n"), (5, "a", "x", 1, "u"), (None, None, None, None, None), (7, "a", "", 0, "")]
    return rows


@pytest.mark.parametrize("fanout,band,nodes,copies", [(3, 6, 100_000, 100_000), (3, 1, 0, 5), (2, 3, 0, 10)])
def test_manifest_against_a_plain_tree(spark, monkeypatch, fanout, band, nodes, copies):
    """Nulls, repeated keys and rows, ties, one-row sources; inner nodes broadcast, and joined in copies."""
    monkeypatch.setattr(manifest, "BROADCAST_NODES", nodes)
    monkeypatch.setattr(manifest, "LEAVES_PER_COPY", copies)
    rows = documents()
    df = spark.createDataFrame([(*r, 1, 2, "d", 3, "k", "g") for r in rows], DOC).repartition(6)
    got = manifest.verify_tampered(df, fanout=fanout, band=band).collect()
    cases.same_rows(map(tuple, got), plain_manifest(rows, fanout))
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_one_row_and_of_none(spark):
    one = [(4, "s", None, 2, "a\nb")]
    df = spark.createDataFrame([(*r, 1, 2, "d", 3, "k", "g") for r in one], DOC)
    cases.same_rows(map(tuple, manifest.verify_tampered(df).collect()), plain_manifest(one))
    assert manifest.verify_tampered(df.limit(0)).collect() == []


def test_settings_of_recursion_are_put_back(spark):
    before = spark.conf.get(manifest.ROW_LIMIT)
    with manifest.deep_recursion(spark, 500):
        assert spark.conf.get(manifest.ROW_LIMIT) == "-1" and int(spark.conf.get(manifest.LEVEL_LIMIT)) > 500
    assert spark.conf.get(manifest.ROW_LIMIT) == before


# ---- tokeniser alignment


@pytest.fixture(scope="module")
def tools():
    return alignment.Tokenizers(default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model"))


def plain_alignment(tools, text):
    """n_a, n_b, n_groups, digest and links of a whole text, from the decoded bytes of its tokens alone."""
    none = (0, 0, 0, "", {})
    if not text:
        return none
    a, b = tools.a.encode(" " + text, add_special_tokens=False).ids, tools.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(tools.bytes_a[i] for i in a) != raw or b"".join(tools.bytes_b[i] for i in b) != raw:
        return none
    ends = []
    for ids, table in ((a, tools.bytes_a), (b, tools.bytes_b)):
        at, side = 0, {}
        for i, x in enumerate(ids):
            at += len(table[x])
            side[at] = i + 1
        ends.append(side)
    groups, links, i, j = [], collections.Counter(), 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        x, y = ends[0][cut], ends[1][cut]
        groups.append(f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}")
        links[a[x - 1], b[y - 1]] += 1
        i, j = x, y
    return len(a), len(b), len(groups), sha(";".join(groups)), dict(links)


TEXTS = [
    "héllo 日本💩 ꙮx\n\x00z", " lead", "  two  blanks ", "a▁b c", "x ▁y z", "tab\t end \n\n next", "é é 👨‍👩‍👧 ok", "<|endoftext|> </s> <s> x", "日本語のテキスト。 ꙮꙮꙮ 💩💩",
    "  nb   sp 　 em", " ", "\n", "it's we'll don 't 1234 5678", "\x1c \x1d a b", "é ​ z", "", None, "ꙮ" * 50, "x" * 3000, "a " * 2000,
]


def test_units_align_as_whole_texts_do(tools):
    aligner = alignment.Aligner(default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model"))
    texts = [t or "" for t in TEXTS] + [t or "" for _, t in cases.documents()]
    for text, got in zip(texts, aligner.texts(texts)):
        found = {divmod(int(p), alignment.PAIR): int(n) for p, n in zip(*got[4:])}
        assert (*got[:4], found) == plain_alignment(tools, text)


def test_forgotten_units_change_nothing(monkeypatch):
    texts = [t or "" for _, t in cases.documents()]
    paths = default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model")
    whole = alignment.Aligner(*paths).texts(texts)
    monkeypatch.setattr(alignment, "REMEMBERED_UNITS", 5)
    monkeypatch.setattr(alignment, "ENCODE_CHARS", 40)
    small = alignment.Aligner(*paths)
    assert [g[:4] for t in texts for g in small.texts([t])] == [g[:4] for g in whole]


@pytest.mark.parametrize("limit", [None, 0])
def test_corpus_counts(spark, tools, limit):
    """Counts over all documents, best pairs with ties; nulls, repeated rows and clashing columns; both ways of the join."""
    rows = cases.documents() + [(200 + i, t) for i, t in enumerate(TEXTS)]
    plain = [(k, plain_alignment(tools, t)) for k, t in rows]
    count = collections.Counter()
    for _, p in plain:
        count.update(p[4])
    most = collections.Counter()
    for (a, b), n in count.items():
        most[b] = max(most[b], n)
    want = []
    for k, (n_a, n_b, n_groups, digest, links) in plain:
        best = sum(n for (a, b), n in links.items() if count[a, b] == most[b])
        want.append((k, n_a, n_b, n_groups, sum(links.values()), best, sum(n * count[p] for p, n in links.items()), digest))
    df = cases.frame(spark, rows).withColumnRenamed("score", "pairs").withColumnRenamed("label", "id")
    got = alignment.align_tokenizers(df, **({} if limit is None else {"limit": limit}))
    cases.same_rows(map(tuple, got.collect()), want)
    assert alignment.align_tokenizers(df.limit(0)).collect() == []


def test_all_rows_keep_their_columns(spark):
    df = cases.frame(spark, [(1, "a b"), (None, None)]).withColumn("pairs", F.lit(1))
    assert alignment.aligned_texts(df).select("row.*").columns == [c for c in df.columns if c != "text"]
