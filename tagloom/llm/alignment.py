"""Alignment of two tokenisers by the spans both give, and how often their tokens are linked in the whole corpus.

A is a byte-level vocabulary of the tokenizers library, B a SentencePiece model. Character offsets of A and the byte spans
of B's proto (the library's present name for its immutable proto) are the coarse cuts. Where they can't tell tokens
apart, inside a multibyte character or a run of byte fallbacks, the cuts follow from the tokens' decoded bytes.

Both vocabularies cut every text before a lone blank, and what stands between two such cuts (a unit) is encoded the same
wherever it stands. So a task encodes each distinct unit once and remembers it.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.pieces import MARK, default_path
from tagloom.llm.texts import as_text
from tagloom.session import BROADCAST_ROWS, is_small, lookup, materialize

# A blank between two other characters that are no white space (what Python takes for it covers what both libraries do).
CUT = re.compile(r"(?<=\S) (?=\S)")
# Units a task remembers, and characters of texts taken at a time; both bound memory, neither changes a result.
REMEMBERED_UNITS = 400_000
PART_CHARS = 1 << 20
ENCODE_CHARS = 1 << 18
# A pair of ids is one number: the id of A times this, plus the id of B.
PAIR = 1 << 31


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a character: printable ones as themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both vocabularies with the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        special = {i: t.content for i, t in self.a.get_added_tokens_decoder().items()}
        entries = sorted((i, t) for t, i in self.a.get_vocab(with_added_tokens=True).items())
        self.bytes_a = [b""] * (entries[-1][0] + 1)
        for i, token in entries:
            self.bytes_a[i] = special[i].encode() if i in special else bytes(letters[c] for c in token)
        self.bytes_b = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        # Each id in decimal with the mark that follows it: within one side of a group, after A's side, after the group.
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.written = np.array([[f"{i}{mark}" for i in range(most)] for mark in ",|;"], dtype=object)

    def make_up(self, unit: str) -> bool:
        """Whether the bytes of both sides' tokens are blank + unit."""
        raw = f" {unit}".encode()
        ids = self.a.encode(" " + unit, add_special_tokens=False).ids
        return b"".join([self.bytes_a[i] for i in ids]) == raw == b"".join([self.bytes_b[i] for i in self.b.encode(unit)])

    def _piece_bytes(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        return self.b.id_to_piece(i).replace(MARK, " ").encode()


def refined_ends(starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte end of each token, from coarse byte spans and the lengths of the tokens' bytes.

    A coarse cut holds where a span as long as its token's bytes ends and the next span begins. Tokens up to the next such
    cut share a character, so their ends are counted on from the cut before by decoded bytes.
    """
    sure = ends - starts == lengths
    sure[:-1] &= starts[1:] == ends[:-1]
    total = np.cumsum(lengths)
    last = np.maximum.accumulate(np.where(sure, np.arange(1, len(sure) + 1), 0))
    return np.concatenate([[0], ends])[last] + total - np.concatenate([[0], total])[last]


class Alignments:
    """Of each unit: tokens of A and of B, groups, the groups as text with `;` after each, and where its linked pairs lie."""

    def __init__(self, sizes: np.ndarray, groups: list[str], links: np.ndarray):
        self.sizes, self.groups, self.links = sizes, groups, links


def align(tools: Tokenizers, units: list[str]) -> tuple[list[str], Alignments]:
    """The units that have tokens, in a new order, and their alignments, each as blank + unit. The others' tokens don't make up the unit.

    Units without white space at their ends are encoded as one text, all are laid end to end: each step is an array operation.
    """
    plain = [u for u in units if u and not (u[0].isspace() or u[-1].isspace())]
    odd = [u for u in units if not u or u[0].isspace() or u[-1].isspace()]
    units = plain + odd
    texts = ([" ".join(plain)] if plain else []) + odd
    coded_a = tools.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
    coded_b = [p.pieces for p in tools.b.encode(texts, return_type="proto", num_threads=1)]
    a = np.fromiter(chain.from_iterable(x.ids for x in coded_a), np.int64)
    n_b = np.array([len(x) for x in coded_b], dtype=np.int64)
    three = chain.from_iterable((p.id, p.begin, p.end) for x in coded_b for p in x)
    b, begin, end = np.fromiter(three, np.int64, 3 * int(n_b.sum())).reshape(-1, 3).T
    whole = "".join([" " + u for u in units])
    raw = whole.encode()
    if not all(b"".join(map(t.__getitem__, ids.tolist())) == raw for t, ids in ((tools.bytes_a, a), (tools.bytes_b, b))):
        good = [u for u in units if tools.make_up(u)]
        return align(tools, good) if good else ([], Alignments(np.zeros((0, 3), np.int64), [], np.zeros(0, np.int64)))
    # Places of characters to places of bytes, and where texts and units lie.
    codes = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
    width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    byte_at = np.concatenate([[0], np.cumsum(width)])
    starts = np.cumsum([0, *(1 + len(t) for t in texts[:-1])])
    unit_ends = byte_at[np.cumsum([1 + len(u) for u in units])]
    spans = np.fromiter(chain.from_iterable(chain.from_iterable(x.offsets for x in coded_a)), np.int64, 2 * len(a)).reshape(-1, 2)
    spans = byte_at[spans + np.repeat(starts, [len(x) for x in coded_a])[:, None]]
    ends_a = refined_ends(spans[:, 0], spans[:, 1], tools.length_a[a])
    # B's spans are bytes already; they leave the added blank out, so the piece that holds it begins a byte earlier.
    shift = np.repeat(byte_at[starts], n_b) + 1
    begin = begin + shift
    begin[np.cumsum(n_b) - n_b] -= 1
    ends_b = refined_ends(begin, end + shift, tools.length_b[b])
    cuts, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    # The ids in the order of the text form, a group's A before its B, each with the mark that follows it.
    count_a, count_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
    place_a = np.arange(len(a)) + np.repeat(np.cumsum(count_b) - count_b, count_a)
    place_b = np.arange(len(b)) + np.repeat(np.cumsum(count_a), count_b)
    mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    mark_a[at_a], mark_b[at_b] = 1, 2
    written = np.empty(len(a) + len(b), dtype=object)
    written[place_a], written[place_b] = tools.written[mark_a, a], tools.written[mark_b, b]
    upto = [np.searchsorted(ends, unit_ends, side="right") for ends in (ends_a, ends_b, cuts)]
    written, word_ends = written.tolist(), (upto[0] + upto[1]).tolist()
    groups = ["".join(written[lo:hi]) for lo, hi in zip([0, *word_ends], word_ends)]
    return units, Alignments(np.diff(np.stack(upto, axis=1), axis=0, prepend=0), groups, a[at_a] * PAIR + b[at_b])


class Aligner:
    """Alignments of texts, with those of recent units remembered."""

    def __init__(self, path_a: str, path_b: str):
        self.tools = Tokenizers(path_a, path_b)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 3), dtype=np.int64)
        self.links = np.zeros(0, dtype=np.int64)

    def _learn(self, units: list[str]) -> None:
        lo = chars = 0
        sizes, links = [self.sizes], [self.links]
        for hi, unit in enumerate(units, start=1):
            chars += len(unit)
            if chars < ENCODE_CHARS and hi < len(units):
                continue
            good, found = align(self.tools, units[lo:hi])
            if len(good) < hi - lo:
                self.place.update(dict.fromkeys(units[lo:hi], -1))
            self.place.update(zip(good, range(len(self.groups), len(self.groups) + len(good))))
            self.groups += found.groups
            sizes.append(found.sizes)
            links.append(found.links)
            lo, chars = hi, 0
        self.sizes, self.links = np.concatenate(sizes), np.concatenate(links)
        self.ends = np.cumsum(self.sizes[:, 2])

    def texts(self, texts: list[str]) -> list[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """n_a, n_b, n_groups, groups_sha256, distinct linked pairs and how often each is linked, of each text."""
        if len(self.place) > REMEMBERED_UNITS:
            self._forget()
        cut = [CUT.split(t) if t else [] for t in texts]
        self._learn(list({u for units in cut for u in units if u not in self.place}))
        none = np.zeros(0, dtype=np.int64)
        out = []
        for units in cut:
            at = list(map(self.place.__getitem__, units))
            if not at or min(at) < 0:
                out.append((0, 0, 0, "", none, none))
                continue
            digest = hashlib.sha256()
            for lo in range(0, len(at), 4096):
                some = "".join([self.groups[i] for i in at[lo : lo + 4096]])
                digest.update((some if lo + 4096 < len(at) else some[:-1]).encode())
            sizes = self.sizes[at]
            n = sizes[:, 2]
            where = np.repeat(self.ends[at] - np.cumsum(n), n) + np.arange(int(n.sum()))
            pairs, times = np.unique(self.links[where], return_counts=True)
            out.append((*sizes.sum(axis=0).tolist(), digest.hexdigest(), pairs, times))
        return out


def aligned_texts(docs: DataFrame, text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """All rows, each as a struct `row`, with n_a, n_b, n_groups, groups_sha256, and the distinct linked pairs with their `times`.

    Byte offsets where a token of A and one of B both end cut their tokens into groups. Null and empty texts, and texts
    whose tokens of either side do not decode to blank + text, have no tokens. Repeated rows stay; no shuffle.
    """
    paths = path_a or default_path("byte_bpe_50k.json"), path_b or default_path("piece_bpe_32k.model")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"), F.col(text).cast("string").alias("text"))
    names = ["row", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), longs, longs]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*paths)
        for batch in batches:
            texts = as_text(batch.column(1))
            lo = 0
            while lo < len(texts):
                part, chars = [], 0
                while lo + len(part) < len(texts) and chars < PART_CHARS:
                    part.append(texts[lo + len(part)].as_py())
                    chars += len(part[-1])
                found = list(zip(*aligner.texts(part)))
                columns = [pa.array(list(c), kind) for c, kind in zip(found, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(part)), *columns], names=names)
                lo += len(part)

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(work, f"row {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, its links in all texts (`count`), and whether no pair of the same id of B has more (`best`). Summed map-side."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.*")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    side = F.col("pair").bitwiseAND(F.lit(PAIR - 1))
    counts = materialize(counts.withColumn("b", side), "pair-counts")
    most = counts.groupBy(F.col("b").alias("b__")).agg(F.max("count").alias("most"))
    return counts.join(most, F.col("b") == F.col("b__")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokenizers(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """One row per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a pair of an A and a B token that end together; the count of an id pair is how many links of the whole
    corpus join it. n_best: links whose pair has the highest count of its B id, ties included; count_sum: the sum of
    the counts of all links. Documents without tokens (null, empty, not reproduced by both vocabularies) have zeros
    and ''. Rows are kept one for one, repeated and null keys too; other columns are left out; an empty table gives an
    empty table. The table of pairs is broadcast while its counted rows stay below `limit`, and joined with salted keys beyond.
    """
    kept = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    aligned = materialize(aligned_texts(kept, "text", path_a, path_b).withColumn("id", F.monotonically_increasing_id()), "aligned")
    counts = materialize(pair_counts(aligned), "pair-table")
    links = aligned.filter(F.size("pairs") > 0).select("id", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("id", "p.pairs", "p.times")
    found = lookup(links, counts, {"pair": F.col("pairs")}, {"count": "count", "best": "best"}, is_small(counts, limit), F.col("id"))
    sums = found.groupBy("id").agg(
        F.sum("times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    whole = aligned.select("id", F.col("row.key").alias(key), "n_a", "n_b", "n_groups", "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    columns = [key, "n_a", "n_b", "n_groups", zero("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256"]
    return whole.join(sums, "id", "left").select(*columns)
