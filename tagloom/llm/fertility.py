"""Quality rules: fertility of public tokenisers, with rejection bands per language or script."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.pieces import MARK, default_path, piece_table, units_of
from tagloom.llm.texts import SPACE, text_parts, words_of
from tagloom.session import materialize, sized_broadcast

# Units whose tokens a task remembers; it forgets all of them beyond that. Bounds memory, changes no result.
REMEMBERED_UNITS = 250_000
# A band is the median, plus or minus `REACH` quartile distances and at least the metric's slack. Values are counted
# on a grid of `step`, so quartiles are exact and the same on every run.
REACH = 6.0
METRICS = {  # metric: (grid step, least half width)
    "chars_per_token": (0.01, 0.5),
    "chars_per_byte_token": (0.01, 0.5),
    "byte_share": (0.001, 0.05),
    "token_entropy": (0.01, 0.75),
}
# Texts that make a band. A class with fewer takes the neighbouring length classes in, then all texts of the script, then,
# where no script is known, all texts; fixed limits hold where these are too few as well.
BAND_DOCUMENTS = 30
# Length classes on either side that a band may take in, for metrics that change with the length of a text.
LENGTH_REACH = {"token_entropy": 2}
# Fixed limits: metric: (low, high) for scripts whose letters the vocabularies hold, and for all others.
SPELT_SCRIPTS = ("latin", "greek", "cyrillic")
LIMITS = {
    "chars_per_token": ((1.2, 8.0), (0.25, 8.0)),
    "chars_per_byte_token": ((0.7, 10.0), (0.2, 10.0)),
    "byte_share": ((0.0, 0.25), (0.0, 1.0)),
    "token_entropy": ((3.0, 15.0), (3.0, 15.0)),
}
SCRIPTS = {  # code point ranges, fixed values of the Unicode block list
    "latin": (0x0041, 0x024F),
    "greek": (0x0370, 0x03FF),
    "cyrillic": (0x0400, 0x052F),
    "hebrew": (0x0590, 0x05FF),
    "arabic": (0x0600, 0x06FF),
    "indic": (0x0900, 0x0DFF),
    "thai": (0x0E00, 0x0E7F),
    "kana": (0x3040, 0x30FF),
    "han": (0x4E00, 0x9FFF),
    "hangul": (0xAC00, 0xD7AF),
}
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_WORD_CHAR = (~SPACE & ~((np.arange(256) >= 0x80) & (np.arange(256) < 0xC0))).astype(np.int64)
_WHITE = " \t\n\v\f\r"


@lru_cache(maxsize=2)
def byte_vocabulary(path: str):
    """Byte-level vocabulary from a file of ranks."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def duplicate_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = Counter(line for line in text.split("\n") if line.strip(_WHITE))
    return sum(lines.values()) - len(lines)


def repeated_words(words: np.ndarray) -> int:
    """Words inside three-word windows that occur twice or more in the text, first occurrence included."""
    if len(words) < 4:
        return 0
    key = words[:-2] * np.uint64(0x9E3779B97F4A7C15) + words[1:-1]
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + words[2:]
    _, at, n = np.unique(key, return_inverse=True, return_counts=True)
    twice = n[at] > 1
    inside = np.zeros(len(words), dtype=bool)
    for j in range(3):
        inside[j : len(twice) + j] |= twice
    return int(inside.sum())


def script_of(text: str) -> str:
    """The script of most letters, by code point ranges; 'none' without a letter of these."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    best, most = "none", 0
    for name, (lo, hi) in SCRIPTS.items():
        n = int(((codes >= lo) & (codes <= hi)).sum())
        if n > most:
            best, most = name, n
    return best


class Fertility:
    """Tokens of units under two vocabularies, remembered, and what texts make of them."""

    def __init__(self, piece_path: str, byte_path: str):
        self.pieces, self.bytes = piece_table(piece_path), byte_vocabulary(byte_path)
        self.is_byte = np.zeros(len(self.pieces.pieces), dtype=bool)
        self.is_byte[self.pieces.byte_ids] = True
        self.is_byte[[self.pieces.byte_ids[ord(c)] for c in _WHITE]] = False
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.tokens: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.chars: list[np.ndarray] = []
        self.byte_tokens: list[np.ndarray] = []
        self.ready: tuple | None = None

    def learn(self, units: list[str]) -> None:
        """Each unit starts with a mark, which the library puts before a text of its own."""
        plain = [u[1:].replace(MARK, " ") for u in units]
        ids = [i if i else [self.pieces.ids[MARK]] for i in self.pieces.library.encode(plain, num_threads=1)]
        self.index.update(zip(units, range(len(self.index), len(self.index) + len(units))))
        self.lengths.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        self.tokens.append(np.fromiter(chain.from_iterable(ids), np.int32, int(self.lengths[-1].sum())))
        self.chars.append(np.fromiter(map(len, units), np.int64, len(units)))
        ordinary = self.bytes.encode_ordinary
        self.byte_tokens.append(np.fromiter((len(ordinary(" " + p)) for p in plain), np.int64, len(plain)))
        self.ready = None

    def arrays(self) -> tuple:
        if self.ready is None:
            for name in ("tokens", "lengths", "chars", "byte_tokens"):
                setattr(self, name, [np.concatenate(getattr(self, name))])
            starts = np.r_[0, np.cumsum(self.lengths[0])]
            self.ready = (self.tokens[0], starts, self.lengths[0], self.chars[0], self.byte_tokens[0])
        return self.ready

    def measure(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Of each text: tokens, characters, byte tokens of both vocabularies, entropy of its tokens in bits."""
        counted = [Counter(units_of(t)) for t in texts]
        if len(self.index) > REMEMBERED_UNITS:
            self.forget()
        new = {u for c in counted for u in c if u not in self.index}
        if new:
            self.learn(list(new))
        if not self.index:
            zero = np.zeros(len(texts))
            return {"n_tokens": zero.astype(np.int64), "chars": zero, "byte_level": zero, "fallback": zero, "entropy": zero}
        tokens, starts, lengths, chars, byte_tokens = self.arrays()
        sizes = np.fromiter(map(len, counted), np.int64, len(counted))
        unit = np.fromiter(map(self.index.__getitem__, chain.from_iterable(counted)), np.int64, int(sizes.sum()))
        times = np.fromiter(chain.from_iterable(c.values() for c in counted), np.int64, len(unit))
        doc = np.repeat(np.arange(len(counted)), sizes)
        k = lengths[unit]
        at = np.repeat(starts[unit] - np.r_[0, np.cumsum(k)[:-1]], k) + np.arange(int(k.sum()))
        token, weight, owner = tokens[at], np.repeat(times, k), np.repeat(doc, k)

        def per_doc(values: np.ndarray, owners: np.ndarray) -> np.ndarray:
            return np.bincount(owners, weights=values, minlength=len(counted))

        n = per_doc(weight, owner)
        key = owner * len(self.pieces.pieces) + token
        order = np.argsort(key, kind="stable")
        key, weight_ = key[order], weight[order]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        cell = np.add.reduceat(weight_, head) if len(head) else np.zeros(0)
        cell_doc = key[head] // len(self.pieces.pieces)
        share = cell / n[cell_doc]
        return {
            "n_tokens": n.astype(np.int64),
            "chars": per_doc(chars[unit] * times, doc),
            "byte_level": per_doc(byte_tokens[unit] * times, doc),
            "fallback": per_doc(weight * self.is_byte[token], owner),
            "entropy": per_doc(-share * np.log2(share), cell_doc),
        }


_STATS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_tokens bigint, "
    "script string, chars_per_token double, chars_per_byte_token double, byte_share double, token_entropy double"
)


def text_stats(docs: DataFrame, text: str, keep: list[str], piece_path: str, byte_path: str) -> DataFrame:
    """Counts and fertility of each whole text, one narrow pass; `keep` columns come along unchanged."""

    def per_text(words: np.ndarray, row: np.ndarray, rows: int) -> Iterator[np.ndarray]:
        edges = np.searchsorted(row, np.arange(rows + 1))
        return (words[edges[i] : edges[i + 1]] for i in range(rows))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = Fertility(piece_path, byte_path)
        for batch in batches:
            for lo, hi, data, offsets in text_parts(batch.column(1)):
                words, row = words_of(data, offsets, lower=False)
                texts = [bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
                sums = [np.r_[0, np.cumsum(table[data])] for table in (_WORD_CHAR, _SYMBOL)]
                word_chars, symbols = [s[offsets[1:]] - s[offsets[:-1]] for s in sums]
                m = fertility.measure(texts)
                n = np.maximum(m["n_tokens"], 1)
                columns = [
                    np.bincount(row, minlength=hi - lo),
                    word_chars,
                    symbols,
                    [duplicate_lines(t) for t in texts],
                    [repeated_words(w) for w in per_text(words, row, hi - lo)],
                    m["n_tokens"],
                    [script_of(t) for t in texts],
                    m["chars"] / n,
                    m["chars"] / np.maximum(m["byte_level"], 1),
                    m["fallback"] / n,
                    m["entropy"],
                ]
                kinds = [pa.int64()] * 6 + [pa.string()] + [pa.float64()] * 4
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                names = [c.split()[0] for c in _STATS.split(", ")]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *arrays], names=["kept", *names])

    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["kept"].dataType.simpleString()
    return rows.mapInArrow(work, f"kept {kind}, {_STATS}").select("kept.*", *[c.split()[0] for c in _STATS.split(", ")])


def length_class() -> Column:
    """Entropy grows with length, so bands are made for each doubling of the number of tokens."""
    return F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int")


def fertility_bands(stats: DataFrame) -> DataFrame:
    """Lowest and highest accepted value of each metric for each band_key, script and length_class in `stats`; none is null.

    `stats` has these columns, the metrics and `base_failed`; bands are made of the texts that pass. Each metric takes the
    first band of BAND_DOCUMENTS texts: the language's, the script's (all texts' for texts without letters of a known
    script), each over as few neighbouring length classes as reach that number; then LIMITS. Values are first counted on the
    grid, with partial sums, so a language with most of the rows shuffles no more than its grid cells.
    """
    place = ["band_key", "script", "length_class"]
    cells = [F.struct(F.lit(m).alias("metric"), F.round(F.col(m) / step).cast("long").alias("cell")) for m, (step, _) in METRICS.items()]
    passing = stats.filter(~F.col("base_failed")).select(*place, F.inline(F.array(*cells)))
    counted = materialize(passing.groupBy(*place, "metric", "cell").agg(F.count(F.lit(1)).alias("n")), "cells")
    targets = materialize(stats.select(*place).distinct(), "band-targets")
    keys = {"own": F.col("band_key"), "script": F.col("script"), "all": F.lit("")}
    group = F.inline(F.array(*[F.struct(F.lit(level).alias("level"), k.alias("of")) for level, k in keys.items()]))
    pooled = counted.select(group, F.col("length_class").alias("near"), "metric", "cell", "n").groupBy("level", "of", "near", "metric", "cell").agg(F.sum("n").alias("n"))
    # All these are at most one row per language or script and pair of length classes.
    sizes = pooled.filter(F.col("metric") == next(iter(METRICS))).groupBy("level", "of", "near").agg(F.sum("n").alias("n"))
    wanted = targets.select(group, "length_class", "script").filter("level != 'all' OR script = 'none'").drop("script").distinct()
    away = F.abs(F.col("near") - F.col("length_class"))
    steps = wanted.join(sizes, ["level", "of"]).groupBy("level", "of", "length_class", away.alias("away")).agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("level", "of", "length_class").orderBy("away"))
    reach = steps.withColumn("upto", upto).filter(F.col("upto") >= BAND_DOCUMENTS).groupBy("level", "of", "length_class").agg(F.min("away").alias("reach"))
    most = F.create_map(*[F.lit(x) for m in METRICS for x in (m, LENGTH_REACH.get(m, 64))])[F.col("metric")]
    taken = pooled.join(sized_broadcast(reach), ["level", "of"]).filter((away <= F.col("reach")) & (F.col("reach") <= most))
    quartiles = taken.groupBy("level", "of", "length_class", "metric").agg(F.expr("percentile(cell, array(0.25, 0.5, 0.75), n)").alias("q"))
    step = F.create_map(*[F.lit(x) for m, (s, _) in METRICS.items() for x in (m, s)])[F.col("metric")]
    slack = F.create_map(*[F.lit(x) for m, (_, w) in METRICS.items() for x in (m, w)])[F.col("metric")]
    half = F.greatest(F.lit(REACH) * (F.col("q")[2] - F.col("q")[0]) * step, slack)
    banded = quartiles.select("level", "of", "length_class", "metric", (F.col("q")[1] * step - half).alias("low"), (F.col("q")[1] * step + half).alias("high"))
    sides = [(m, side) for m in METRICS for side in ("low", "high")]
    made = [F.first(F.when(F.col("metric") == m, F.col(side)), ignorenulls=True).alias(f"{m}_{side}") for m, side in sides]
    bands = materialize(banded.groupBy("level", "of", "length_class").agg(*made), "bands")
    out = targets
    for level, of in keys.items():
        own = bands.filter(F.col("level") == level).select(F.col("of").alias("of__"), F.col("length_class").alias("class__"), *[F.col(f"{m}_{s}").alias(f"{level}_{m}_{s}") for m, s in sides])
        fits = (of == F.col("of__")) & (F.col("length_class") == F.col("class__"))
        out = out.join(own, fits & (F.col("script") == "none") if level == "all" else fits, "left").drop("of__", "class__")

    def limit(m: str, side: int) -> Column:
        return F.when(F.col("script").isin(*SPELT_SCRIPTS), LIMITS[m][0][side]).otherwise(LIMITS[m][1][side])

    chosen = [F.coalesce(*[F.col(f"{level}_{m}_{s}") for level in keys], limit(m, int(s == "high"))).alias(f"{m}_{s}") for m, s in sides]
    return out.select(*place, *chosen)


def quality_rules(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str | None = "lang",
    piece_path: str | None = None,
    byte_path: str | None = None,
) -> DataFrame:
    """Base counts, fertility metrics and verdict of each whole text.

    Metrics: characters per token of a piece and of a byte-level vocabulary, share of byte-fallback tokens (white
    space aside), entropy of the tokens in bits. Each is held against a band of its language, or of its script where
    the language is null or `language` is None, and of its length class; bands come from all texts that pass the base rules.
    Where these are too few for a band, a wider one holds (see `fertility_bands`), so no text goes without.

    `base_failed`: fewer than 50 words, or more than half of the words in repeated three-word windows. `kept` is false
    then, else whether all metrics lie in their bands (`outside` lists those that don't). Null and empty texts count
    as no words and fail. Rows are kept one for one, repeated keys too; an empty table gives an empty table.
    """
    piece_path = piece_path or default_path("piece_bpe_32k.model")
    byte_path = byte_path or default_path("byte_bpe_50k.tiktoken")
    named = docs.select(
        F.col(key).alias("__key"), F.col(text).alias("__text"), (F.col(language) if language else F.lit(None)).cast("string").alias("__language")
    )
    stats = text_stats(named, "__text", ["__key", "__language"], piece_path, byte_path)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = materialize(
        stats.withColumns(
            {"base_failed": failed, "band_key": F.coalesce("__language", F.concat(F.lit("script:"), "script")), "length_class": length_class()}
        ),
        "fertility",
    )
    bands = sized_broadcast(fertility_bands(stats))
    joined = stats.join(bands, ["band_key", "script", "length_class"], "left")
    outside = F.filter(
        F.array(*[F.when((F.col(m) < F.col(f"{m}_low")) | (F.col(m) > F.col(f"{m}_high")), F.lit(m)) for m in METRICS]), lambda m: m.isNotNull()
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return joined.withColumn("outside", outside).select(
        F.col("__key").alias(key), *counts, "base_failed", (~F.col("base_failed") & (F.size("outside") == 0)).alias("kept"), "outside", "band_key", "n_tokens", *METRICS
    )
