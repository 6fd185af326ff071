"""Operators on documents against plain versions, on awkward rows and on the smallest tables."""

import collections
import random
import string
from zlib import crc32

import numpy as np
import pytest

from tagloom.llm import fertility, language_id, lm_score, secrets, segmentations, set_join, token_counts
from tagloom.llm import decontaminate as dc
from tagloom.llm.pieces import default_path, merge_one, piece_table, units_of
from tagloom.llm.texts import mix64, words_of
from tests.llm import cases

PIECES = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def rows():
    return cases.documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return cases.frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], cases.SCHEMA)


def test_words_are_told_apart_at_any_length():
    one, two = b"Ab " * 3 + b"y" * (3 << 20) + b" ab\n", b"ab \x0b" + b"Y" * (3 << 20)
    data = np.frombuffer(one + two, np.uint8)
    words, row = words_of(data, np.array([0, len(one), len(one) + len(two)]))
    assert row.tolist() == [0] * 5 + [1] * 2
    assert len(set(words.tolist())) == 2 and words[3] == words[6] and words[0] == words[4] == words[5]


def test_language(spark, sf, docs, rows, empty):
    known = spark.read.parquet(f"{sf}/documents.parquet")
    got = language_id.predict_languages(known).join(known.select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.9
    net = language_id.fit_language_id(known.selectExpr("doc_id AS key", "text", "lang AS label"))
    out = language_id.identify(docs.drop("score"), net).collect()
    assert len(out) == len(rows)
    for r in out:
        bare = not any(c.isalpha() for c in r.text or "")
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == bare
    kept = language_id.keep_identified(docs, net, least=0.3)
    assert kept.columns == docs.columns
    assert language_id.predict_languages(empty).collect() == [] and language_id.fit_language_id(empty.selectExpr("doc_id AS key", "text", "lang AS label")) is None
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    net = language_id.ByteNetwork.fresh(["a", "b", "c"], rng)
    for p in net.parameters():
        p += rng.normal(0, 0.05, p.shape).astype(p.dtype)
    x, y = rng.integers(0, 256, (6, 40)).astype(np.uint8), rng.integers(0, 3, 6)
    loss = lambda: -np.mean(np.log(net.probabilities(x, net.tables())[np.arange(6), y]))
    for p, g in zip(net.parameters(), net.gradients(x, y)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at], 2e-3
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 0.1 * abs(g[at]) + 2e-3


def test_lm_scores(spark, sf, docs, rows, empty):
    got = lm_score.score_texts(docs).collect()
    cases.same_rows([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got], cases.base_scores(rows))
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_score.score_texts(empty).collect() == []
    known = lm_score.score_texts(spark.read.parquet(f"{sf}/documents.parquet")).groupBy("held_out").sum("base_score", "score").collect()
    assert all(r["sum(score)"] > r["sum(base_score)"] for r in known)


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    model = lm_score.ClassModel(rng.normal(0, 1, (lm_score.FEATURES * lm_score.BUCKETS, lm_score.CLASSES)).astype(np.float32), np.zeros(lm_score.CLASSES, np.float32), None, None)
    features = np.stack([rng.integers(0, lm_score.BUCKETS, 50) + j * lm_score.BUCKETS for j in range(lm_score.FEATURES)])
    assert np.allclose(np.exp(model.log_classes(features)).sum(1), 1, atol=1e-5)


def test_histories_rank_words_within_a_class(spark):
    """Words of one ending are of one class; north and south come equally often, after other words."""
    texts = [t for k in range(300) for t in (f"we go north and n{k}", f"they come south but s{k}")]
    held = [i for i in range(9000, 9100) if crc32(str(i).encode()) % 7 == 2][:5]
    learned = [i for i in range(9000) if crc32(str(i).encode()) % 7 != 2][: len(texts)]
    asked = ["we go north", "we go south", "they come north", "they come south", "unseen go north"]
    docs = spark.createDataFrame([*zip(learned, texts), *zip(held, asked)], "doc_id long, text string")
    score = {r.doc_id: r.score for r in lm_score.score_texts(docs).collect()}
    north, south, far, near, unseen = (score[i] for i in held)
    assert north > south + 0.1 and near > far + 0.1 and unseen < north


def test_word_probabilities_of_a_class_sum_to_one():
    rng = np.random.default_rng(5)
    words = np.unique(rng.integers(1, 1 << 63, 300).astype(np.uint64))
    target, count = rng.integers(1, lm_score.CLASSES, len(words)), rng.integers(1, 50, len(words))
    leaf = lm_score.leaves_of(words, 5)
    mass = np.zeros((lm_score.CLASSES, 32))
    np.add.at(mass, (target, leaf), count + 1.0)
    tree = lm_score.WordTree.of(mass, 14)
    tree.weights[:] = rng.normal(0, 1, len(tree.weights))
    histories = [np.full(len(words), h, np.uint64) for h in rng.integers(1, 1 << 63, lm_score.FEATURES)]
    gain = np.exp(tree.log_gain(histories, target, leaf))
    share = (count + 1) / mass.sum(axis=1)[target]
    assert np.ptp(gain) > 0.1
    assert np.allclose(np.bincount(target, weights=share * gain, minlength=lm_score.CLASSES)[np.unique(target)], 1, atol=1e-4)


def test_set_join(spark, docs, rows, empty):
    cases.same_rows([tuple(r) for r in set_join.near_duplicates(docs).collect()], cases.components(rows))
    assert set_join.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("limits", [(1 << 14, 192), (10, 3)])
def test_set_join_of_chains_and_large_groups(spark, monkeypatch, limits):
    """Both ways through a list: whole, and by blocks with frequent lists set aside."""
    monkeypatch.setattr(set_join, "LIST_PAIRS", limits[0])
    monkeypatch.setattr(set_join, "SMALL_LIST", limits[1])
    rng = random.Random(limits[0])
    vocabulary = [f"w{i}" for i in range(200)]

    def changed(base, n):
        out = list(base)
        for _ in range(n):
            out[rng.randrange(len(out))] = rng.choice(vocabulary)
        return out

    texts, passage = [], [rng.choice(vocabulary) for _ in range(40)]
    for group in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 10, 30, 90]))] + passage * (group % 4 == 0)
        current = base
        for _ in range(rng.choice([1, 3, 12])):
            texts.append(current)
            current = changed(current if rng.random() < 0.5 else base, rng.randrange(3))
    large = [rng.choice(vocabulary) for _ in range(100)]
    texts += [changed(large, rng.randrange(6)) for _ in range(120)]
    texts += [["this", "work", "is", "under", "the", "public", "license", rng.choice(vocabulary)] for _ in range(40)]
    rows = [(i, " ".join(t)) for i, t in enumerate(rng.sample(texts, len(texts)))]
    cases.same_rows([tuple(r) for r in set_join.near_duplicates(cases.frame(spark, rows)).collect()], cases.components(rows))


def test_shared_entries_bound():
    """No linked sets have fewer entries in common than the rule says."""
    rule, rng = set_join.Rule(), np.random.default_rng(5)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 1 << 40, n))
        b = np.unique(np.r_[a[rng.random(len(a)) < rng.uniform(0.75, 1)], rng.integers(0, 1 << 40, int(rng.integers(0, 1 + n // 4)))])
        common = len(np.intersect1d(a, b))
        if common and rule.links(common, len(a), len(b)):
            listed = len(np.intersect1d(a[: int(rule.listed(len(a)))], b[: int(rule.listed(len(b)))]))
            assert listed >= max(rule.shared(len(a)), rule.shared(len(b)))


def test_secrets(spark, docs, rows, empty):
    got = secrets.scan_secrets(docs).collect()
    cases.same_rows([(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got], [(k, *cases.base_secrets(t)) for k, t in rows])
    assert secrets.scan_secrets(empty).collect() == []
    masked = secrets.redact_secrets(docs)
    assert masked.columns == docs.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[77] == '[SECRET]" [SECRET] [SECRET]' and texts[70] is None and texts[0] == dict(rows)[0]


def test_random_tokens(spark):
    rng = random.Random(3)
    alphabets = [string.ascii_letters + string.digits, "0123456789ABCDEF", string.ascii_lowercase + string.digits, string.ascii_letters + string.digits + "+/"]
    rows = [(i, "key " + "".join(rng.choice(alphabets[i % 4]) for _ in range(40)) + " end") for i in range(200)]
    parts = ["section", "alpha", "reading", "value", "house", "list", "item", "overview"]
    rows += [(200 + i, "see " + "-".join(rng.choice(parts) for _ in range(6)) + str(rng.randrange(100))) for i in range(100)]
    rows += [(300, "thingsthatarejustlongwordsinprose"), (301, "4040404040404040404040404040a"), (302, 'secret="' + "q7Zk" * 6 + '"')]
    got = {r.doc_id: r for r in secrets.scan_secrets(cases.frame(spark, rows)).collect()}
    assert sum(got[i].n_random for i in range(200)) >= 195
    assert sum(got[200 + i].n_random for i in range(100)) <= 10
    assert got[300].n_random == got[302].n_random == 0 and got[302].n_assign == 1
    scored = secrets.randomness(spark.createDataFrame([("a1" * 20,), ("0123456789abcdef" * 2,)], "match string")).collect()
    assert scored[0].p < 1e-6 and scored[0].encoding == "hex" and abs(scored[1].z_serial) > 1


def test_random_values_beside_names_and_in_mixed_tokens(spark):
    rng = random.Random(6)
    plain = string.ascii_letters + string.digits
    forms = [
        ("AWS_SECRET_ACCESS_KEY={} end", plain + "+/"), ("client_id={}", plain), ("see https://h.example/p?a=1&sig={}&b=2", plain), ("x=={}", plain), ("a=b={}=c", plain),
        ("k={}==", plain + "+/"), ("/srv/my-app_2/{}", plain + "_-"), ("my-app_2-{}", plain + "+/"),
    ]
    rows = []
    for i in range(320):
        form, letters = forms[i % len(forms)]
        inner = "".join(rng.choice(letters) for _ in range(38))
        rows.append((i, form.format("q7" + inner), "q7" + inner))
    rows += [(1000, "LONG_NAME_WITHOUT_A_DIGIT=word", ""), (1001, "a=1&b=2&c=3&d=4&e=5&f=6&g=7", "")]
    frame = cases.frame(spark, [r[:2] for r in rows])
    got = {r.doc_id: r for r in secrets.scan_secrets(frame).collect()}
    masked = {r.doc_id: r.text for r in secrets.redact_secrets(frame).collect()}
    for f in range(len(forms)):
        of = [r for r in rows[:320] if r[0] % len(forms) == f]
        assert sum(got[i].n_random > 0 for i, _, _ in of) >= len(of) - 3, forms[f]
        assert sum(value not in masked[i] and value[-20:] not in masked[i] for i, _, value in of) >= len(of) - 3, forms[f]
    assert masked[1].startswith("client_id=[SECRET]") and masked[4].endswith("=c")
    assert got[1000].n_random == got[1001].n_random == 0


def test_quality(spark, docs, rows, empty):
    got = fertility.quality_rules(docs).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    cases.same_rows([(r.doc_id, *[r[n] for n in names]) for r in got], [(k, *cases.base_quality(t)) for k, t in rows])
    assert not any(r.kept and r.base_failed for r in got)
    assert fertility.quality_rules(empty).collect() == []


def test_bands_turn_away_odd_texts_alone(spark):
    rng = random.Random(4)
    letters = [a + b for a in "bcdfgklmnprst" for b in "aeiou"]
    text = lambda: " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 4))) for _ in range(300))
    rows = [(i, text()) for i in range(120)] + [(900, " ".join("💩🜁🜂"[i % 3] * 3 + letters[i % 60] for i in range(300))), (901, " ".join(f"{letters[i % 60]}|||###" for i in range(300)))]
    got = {r.doc_id: r for r in fertility.quality_rules(cases.frame(spark, rows)).collect()}
    assert all(got[i].kept for i in range(120)) and not got[900].kept


def test_small_classes_are_held_against_wider_bands(spark):
    rng = random.Random(8)
    letters = [a + b for a in "bcdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    odd = lambda n: " ".join("💩🜁🜂"[i % 3] * 3 + rng.choice(letters) for i in range(n))
    crowd = [(i, text(300), "xx") for i in range(60)]
    alone = [(100, text(170), "xx"), (101, text(3000), "xx"), (102, text(300), "yy"), (103, text(300), None)]
    bad = [(200, odd(80), "xx"), (201, odd(3000), "xx"), (202, odd(300), "yy"), (203, odd(300), None), (204, " ".join(f"{i * 7919 % 1000}💩" for i in range(300)), None)]
    kept = lambda rows: {r.doc_id: r.kept for r in fertility.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    got = kept(crowd + alone + bad)
    assert all(got[k] for k, *_ in crowd + alone) and not any(got[k] for k, *_ in bad)
    # Too few texts for any band: fixed limits.
    got = kept(alone + bad[:4])
    assert all(got[k] for k, *_ in alone) and not any(got[k] for k, *_ in bad[:4])


def test_tokens(docs, rows, empty):
    library = piece_table(default_path(PIECES)).library
    got = token_counts.count_tokens(docs, limit=100).collect()
    want = [(k, len((t or "").encode()), n := len(library.encode(t or "")), n > 100) for k, t in rows]
    cases.same_rows([tuple(r) for r in got], want)
    assert token_counts.count_tokens(empty).collect() == []


def test_merging_is_the_library_s():
    vocabulary = piece_table(default_path(PIECES))
    rng = random.Random(1)
    bits = [" ", "  ", "a", "th", "e", "\n", "é", "日", "💩", "▁", "<s>", "<0x0A>", "!!!!", "====", "aaaa", "0000", " " * 9, "\t", "ing", "x" * 30]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += [c * k for c in " a=" for k in range(1, 90)] + ["ab" * 3000, " " * 5000 + "x"]
    want = [len(i) for i in vocabulary.library.encode(texts)]
    assert token_counts.UnitCounter(default_path(PIECES)).count(texts) == want
    long = units_of("ab" * 3000)[0]
    assert len(merge_one(vocabulary, vocabulary.symbols([long])[0].tolist())) == len(vocabulary.library.encode("ab" * 3000))


def test_segmentations(spark, docs, rows, empty):
    got = segmentations.decode_ids(segmentations.sample_segmentations(docs, k=3)).collect()
    library = piece_table(default_path(PIECES)).library
    texts = collections.defaultdict(list)
    for k, t in rows:
        texts[k].append((t or "").replace("▁", " "))
    for r in got:
        assert r.decoded in texts[r.doc_id] and library.decode(r.ids) == r.decoded
    seen = collections.Counter((r.doc_id, r.content, tuple(r.ids)) for r in got)
    assert {n for (k, *_), n in seen.items() if k is not None and k != 77} == {1}
    assert segmentations.encode_decode(empty).collect() == []
    again = segmentations.sample_segmentations(docs.repartition(7), k=3).collect()
    cases.same_rows([(r.doc_id, r.sample, r.ids) for r in got], [(r.doc_id, r.sample, r.ids) for r in again])


def test_checked_segmentations_hold_their_ids(docs, rows):
    got = segmentations.encode_decode(docs.filter("doc_id < 60")).collect()
    library, texts = piece_table(default_path(PIECES)).library, dict(rows)
    assert len(got) == 90 and all(library.decode(r.ids) == texts[r.doc_id] and len(r.ids) == r.n_pieces for r in got)


def samples(sampler, texts, seeds):
    """Of each text: (ids, log probability, log inclusion) of its segmentations."""
    ids, lengths, log_p, included, owner = sampler.sample(texts, seeds)
    cuts = np.split(ids, np.cumsum(lengths)[:-1])
    out = [[] for _ in texts]
    for i, found in zip(owner.tolist(), zip(cuts, log_p, included)):
        out[i].append(found)
    return out


def test_samples_follow_the_distribution_without_replacement():
    sampler = segmentations.Sampler(default_path(PIECES), 2, 0.4)
    n = 12000
    made = samples(sampler, ["then"] * n, mix64(np.arange(n).astype(np.uint64)))
    p = {tuple(i.tolist()): np.exp(lp) for m in made for i, lp, _ in m}
    first, second = [collections.Counter(tuple(m[j][0].tolist()) for m in made) for j in (0, 1)]
    for a in p:
        assert abs(first[a] / n - p[a]) < 0.025
        assert abs(second[a] / n - sum(p[b] * p[a] / (1 - p[b]) for b in p if b != a)) < 0.025
    assert all(m[0][0].tolist() != m[1][0].tolist() for m in made)
    every = samples(segmentations.Sampler(default_path(PIECES), 50, 1.0), ["the"], np.array([5], np.uint64))[0]
    assert len({tuple(i.tolist()) for i, _, _ in every}) == len(every) < 50
    assert abs(sum(np.exp(lp) for _, lp, _ in every) - 1) < 1e-6 and {q for _, _, q in every} == {0.0}


def test_decontamination(spark, docs, rows, empty):
    text = dict(rows)
    items = [(1, text[80][300:420]), (2, text[50]), (2, text[50]), (3, "A, b!"), (4, ""), (5, None), (None, text[3]), (6, "no such words anywhere")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contamination(docs, bench)
    cases.same_rows([tuple(r) for r in got.drop("hits").collect()], cases.contamination(rows, items))
    assert dc.contamination(empty, bench).collect() == []
    none = bench.filter("item_id = 4")
    assert not any(r.contaminated for r in dc.contamination(docs, none).collect())
    hit = {r.doc_id for r in got.filter("contaminated").collect()}
    left = dc.remove_contaminated(docs, bench)
    assert left.columns == docs.columns
    cases.same_rows([r.doc_id for r in left.collect()], [k for k, _ in rows if k not in hit])
    cut = {r.doc_id: r.text for r in dc.remove_spans(docs, bench).collect()}
    assert cut[50] == "" and cut[70] is None and cut[0] == text[0]
