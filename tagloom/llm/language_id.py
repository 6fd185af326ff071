"""Language identification by a byte convolutional network, trained in numpy, applied to fixed-length windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.texts import LOWER, text_parts

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
DIMENSIONS = 8
# The network is fitted on a sample of at most this many labelled texts, evenly from the languages, and this many
# windows of each. Prediction reads every window of every text.
SAMPLE_TEXTS = 4000
SAMPLE_WINDOWS = 3
STEPS = 500
BATCH = 96
NO_LANGUAGE = "und"
# What a to z are exchanged for in texts of no language: other Latin letters, Cyrillic, Greek, Arabic, kana.
STRANGE_LETTERS = [
    "qwertyuiopasdfghjklzxcvbnm",
    "zyxwvutsrqponmlkjihgfedcba",
    "nopqrstuvwxyzabcdefghijklm",
    "абвгдежзийклмнопрстуфхцчшщ",
    "оеаинтсрвлкмдпуяыьгзбчйхжш",
    "αβγδεζηθικλμνξοπρστυφχψωάέ",
    "ابتثجحخدذرزسشصضطظعغفقكلمنه",
    "あいうえおかきくけこさしすせそたちつてとなにぬねのは",
]
# Windows put through the network at a time.
_RUN = 512

# Byte 0 pads; white space and digits are one code each, A-Z are lower-cased.
_CODE = LOWER.copy()
_CODE[:33] = 32
_CODE[ord("0") : ord("9") + 1] = ord("0")


@dataclass
class ByteNetwork:
    """Embedding of bytes, filters of several widths, their greatest response in a window, and a softmax."""

    labels: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    @classmethod
    def fresh(cls, labels: list[str], rng: np.random.Generator) -> ByteNetwork:
        f32 = np.float32
        filters = {w: rng.normal(0, (2 / (w * DIMENSIONS)) ** 0.5, (w, DIMENSIONS, FILTERS)).astype(f32) for w in WIDTHS}
        n = FILTERS * len(WIDTHS)
        return cls(
            labels, rng.normal(0, 1, (256, DIMENSIONS)).astype(f32), filters, np.zeros(n, f32),
            rng.normal(0, 0.1, (n, len(labels))).astype(f32), np.zeros(len(labels), f32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters.values(), self.bias, self.weights, self.offsets]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean log loss. Only the place of a filter's greatest response passes one on."""
        rows = np.arange(len(x))
        pooled, places = [], []
        for width, kernel in self.filters.items():
            n = x.shape[1] - width + 1
            z = sum(np.take(self.embedding @ kernel[j], x[:, j : j + n], axis=0) for j in range(width))
            at = z.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(z, at[:, None, :], axis=1)[:, 0])
        raw = np.concatenate(pooled, axis=1) + self.bias
        h = np.maximum(raw, 0)
        p = softmax(h @ self.weights + self.offsets)
        p[rows, y] -= 1
        p /= len(x)
        back = (p @ self.weights.T) * (raw > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters = []
        for i, (width, kernel) in enumerate(self.filters.items()):
            g = back[:, i * FILTERS : (i + 1) * FILTERS]
            d = np.zeros_like(kernel)
            for j in range(width):
                seen = x[rows[:, None], places[i] + j]
                vectors = self.embedding[seen]
                d[j] = np.einsum("bfd,bf->df", vectors, g)
                np.add.at(d_embedding, seen, kernel[j].T[None] * g[:, :, None])
            d_filters.append(d)
        return [d_embedding, *d_filters, back.sum(0), h.T @ p, p.sum(0)]

    def tables(self) -> dict[int, list[tuple[np.ndarray, int, bool]]]:
        """Responses per pair of bytes (or single byte) and place: one lookup stands for two steps of a filter."""
        out = {}
        for width, kernel in self.filters.items():
            single = [self.embedding @ kernel[j] for j in range(width)]
            steps = []
            for j in range(0, width - 1, 2):
                steps.append(((single[j][:, None] + single[j + 1][None]).reshape(-1, FILTERS), j, True))
            if width % 2:
                steps.append((single[-1], width - 1, False))
            out[width] = steps
        return out

    def probabilities(self, x: np.ndarray, tables: dict) -> np.ndarray:
        pairs = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        pooled = []
        for width, steps in tables.items():
            n = x.shape[1] - width + 1
            z = None
            for table, j, pair in steps:
                part = np.take(table, (pairs if pair else x)[:, j : j + n], axis=0)
                z = part if z is None else np.add(z, part, out=z)
            while (n := z.shape[1]) > 1:  # the greatest of both halves, until one place is left
                half = (n + 1) // 2
                z = np.maximum(z[:, :half], z[:, n - half :])
            pooled.append(z[:, 0])
        h = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return softmax(h @ self.weights + self.offsets)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: list[str], seed: int = 7, steps: int = STEPS) -> ByteNetwork:
    """Fit by Adam on batches with equally many windows of each language; some are cut short, as short texts are."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    y = np.array([names.index(v) for v in labels])
    groups = [np.flatnonzero(y == k) for k in range(len(names))]
    net = ByteNetwork.fresh(names, rng)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    for step in range(1, steps + 1):
        kinds = rng.integers(0, len(names), BATCH)
        picked = np.array([groups[k][rng.integers(len(groups[k]))] for k in kinds])
        x = windows[picked].copy()
        keep = np.where(rng.random(BATCH) < 0.5, WINDOW, rng.integers(8, WINDOW + 1, BATCH))
        x[np.arange(WINDOW)[None] >= keep[:, None]] = 0
        rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, (m, v) in zip(net.parameters(), net.gradients(x, kinds), moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window and its row: every WINDOW bytes, the last one ending with the text."""
    sizes = np.diff(offsets)
    n = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), n)
    number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = np.minimum(number * WINDOW, np.maximum(sizes[row] - WINDOW, 0)) + offsets[row]
    return start, row


def cut_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    at = starts[:, None] + np.arange(WINDOW)[None]
    inside = at < ends[:, None]
    return np.where(inside, _CODE[data[np.minimum(at, len(data) - 1)]], 0).astype(np.uint8)


def remainder(key: Column, modulus: int) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(modulus))


def sample_windows(labelled: DataFrame, texts: int = SAMPLE_TEXTS) -> tuple[np.ndarray, list[str]]:
    """Windows of a bounded sample of (key, text, label): rows with the smallest hashes, evenly from the labels."""
    per_label = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_label:
        return np.zeros((0, WINDOW), np.uint8), []
    wanted = max(1, texts // len(per_label))
    span = 1 << 30
    cut = {k: min(span, int(span * 1.2 * wanted / n) + 1) for k, n in per_label.items()}
    limit = F.create_map(*[F.lit(x) for pair in cut.items() for x in pair])[F.col("label")]
    hashed = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit("sample")), F.lit(span))
    rows = labelled.filter(hashed < limit)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_parts(batch.column(0)):
                starts, row = windows_of(data, offsets)
                if not len(starts):
                    continue
                n = np.bincount(row, minlength=hi - lo)
                number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                # Spread over the text: the windows nearest to its start, middle and end.
                steps = np.maximum(1, (n[row] - 1) / max(1, SAMPLE_WINDOWS - 1))
                keep = np.floor(number / steps) != np.floor((number - 1) / steps)
                starts, row = starts[keep], row[keep]
                x = cut_windows(data, starts, offsets[1:][row])
                labels = batch.column(1).slice(lo, hi - lo).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array([w.tobytes() for w in x], pa.binary()), labels], names=["window", "label"])

    found = rows.select("text", "label").mapInArrow(work, "window binary, label string")
    got = found.limit(2 * texts * SAMPLE_WINDOWS).collect()
    got.sort(key=lambda r: (r["label"], bytes(r["window"])))
    windows = np.frombuffer(b"".join(bytes(r["window"]) for r in got), dtype=np.uint8).reshape(-1, WINDOW)
    return windows, [r["label"] for r in got]


def no_language(labelled: DataFrame) -> DataFrame:
    """Texts of no language of the table, one from each labelled text: its letters exchanged for others of the same or
    another script (`STRANGE_LETTERS`), or letters drawn from a hash of it. Their label is NO_LANGUAGE."""
    text, which = F.lower("text"), F.pmod(F.xxhash64("text"), F.lit(len(STRANGE_LETTERS) + 2))
    digits = F.concat(*[F.sha2(F.concat(F.lit(str(i)), "text"), 256) for i in range(6)])
    drawn = F.regexp_replace(F.translate(digits, "0123456789abcdef", "kqaeztrnbiupsodl"), "(.{3,8}?[abk])", "$1 ")
    strange = drawn
    for i, letters in enumerate(STRANGE_LETTERS):
        strange = F.when(which == i, F.translate(text, "abcdefghijklmnopqrstuvwxyz", letters)).otherwise(strange)
    return labelled.filter("label IS NOT NULL AND text IS NOT NULL").select("key", strange.alias("text"), F.lit(NO_LANGUAGE).alias("label"))


def fit_language_id(labelled: DataFrame, seed: int = 7, reject: bool = False) -> ByteNetwork | None:
    """A network for the labels of (key, text, label), or None without labelled text.

    With `reject` it also learns NO_LANGUAGE, from texts made of the labelled ones, and can give that for an answer.
    """
    rows = labelled.filter("label IS NOT NULL AND text IS NOT NULL")
    if reject:
        rows = rows.select("key", "text", "label").unionByName(no_language(labelled))
    windows, labels = sample_windows(rows)
    return train(windows, labels, seed) if len(windows) else None


def identify(docs: DataFrame, net: ByteNetwork | None, text: str = "text") -> DataFrame:
    """All rows and columns of `docs`, and lang_pred and score (columns of these names are replaced): the mean probability of a language over all windows.

    Null texts, texts without a letter, and all texts where there is no network, get `und` and a score of 0.
    """
    docs = docs.drop("lang_pred", "score")
    letters = F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False))
    value = F.when(letters, F.col(text).cast("string"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), value.alias("value"))
    kind = rows.schema["row"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables() if net else {}
        for batch in batches:
            for lo, hi, data, offsets in text_parts(batch.column(1)):
                labels, scores = np.full(hi - lo, NO_LANGUAGE, dtype=object), np.zeros(hi - lo)
                if net and len(data):
                    starts, row = windows_of(data, offsets)
                    total = np.zeros((hi - lo, len(net.labels)))
                    for a in range(0, len(starts), _RUN):
                        b = slice(a, a + _RUN)
                        x = cut_windows(data, starts[b], offsets[1:][row[b]])
                        np.add.at(total, row[b], net.probabilities(x, tables))
                    mean = total / np.maximum(np.bincount(row, minlength=hi - lo), 1)[:, None]
                    some = np.diff(offsets) > 0
                    labels[some] = np.array(net.labels, dtype=object)[mean.argmax(axis=1)[some]]
                    scores[some] = np.minimum(mean.max(axis=1)[some], 1.0)
                out = [batch.column(0).slice(lo, hi - lo), pa.array(labels, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(out, names=["row", "lang_pred", "score"])

    made = rows.mapInArrow(work, f"row {kind}, lang_pred string, score double")
    return made.select("row.*", "lang_pred", "score")


def predict_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang", modulus: int = 4, held: int = 2) -> DataFrame:
    """key, held_out, lang_pred, score for every row. The network learns from rows whose remainder isn't `held`.

    Held out: CRC-32 of the key as text, modulo `modulus`, equals `held`; a null key is neither held out nor learned
    from. Rows are kept one for one, repeated rows too. An empty table gives an empty table.
    """
    learned = docs.filter(remainder(F.col(key), modulus) != held)
    net = fit_language_id(learned.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(language).cast("string").alias("label")))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(remainder(F.col(key), modulus) == held, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    out = identify(rows, net).select(F.col("key").alias(key), "held_out", "lang_pred", "score")
    return out


def keep_identified(docs: DataFrame, net: ByteNetwork | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents, with their own columns, whose language is known with a score of `least` or more."""
    names = docs.columns
    marked = identify(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc__"), F.col(text).alias("text__")), net, "text__")
    return marked.filter((F.col("lang_pred") != NO_LANGUAGE) & (F.col("score") >= least)).select(*[F.col(f"doc__.`{c}`").alias(c) for c in names])
