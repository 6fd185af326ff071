"""Chat formatting with a loss mask: whole conversations are rendered, encoded once with offsets, and turn spans meet token spans.

A template encloses each turn in two marks. A control string inside a text (a mark, or a special token of the vocabulary) gets
a backslash after its first character; one that holds backslashes there already gets one more, so unescaping is exact.
Marks are tokens of their own, so no token crosses the end of a turn, and spans of turns and tokens, both sorted, meet by
binary search.

Rows are dealt by ranges of (conversation, turn): a conversation of any size is rendered and encoded in many tasks, as
pieces of whole turns. Only conversations in more than one piece are brought together, as a stream, to digest them.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.alignment import CUT, byte_letters
from tagloom.llm.pieces import default_path
from tagloom.llm.texts import as_text

# Characters of a conversation after which a new piece begins (a turn is never cut), and characters encoded at a time.
PIECE_CHARS = 1 << 20
ENCODE_CHARS = 1 << 18
ROW = "part int, number int, whole boolean"


@dataclass(frozen=True)
class Template:
    """Marks before and after the text of each known role; of any other role, before, between and after its name and text."""

    roles: tuple = (("system", "<<SYS>>", "<</SYS>>"), ("user", "[INST]", "[/INST]"), ("assistant", "<s>", "</s>"))
    other: tuple = ("<<ROLE>>", "<<TEXT>>", "<</ROLE>>")
    loss: str = "assistant"
    special: tuple = field(default=())

    def marks(self) -> list[str]:
        return [*(m for r in self.roles for m in r[1:]), *self.other]

    def controls(self) -> list[str]:
        """Marks and special tokens; none may begin inside another one, or where another one ends."""
        found = list(dict.fromkeys([*self.marks(), *self.special]))
        for a in found:
            inside = [a[i:] for i in range(1, len(a))]
            if len(a) < 2 or "\\" in a or any(s.startswith(b) or b.startswith(s) for s in inside for b in found):
                raise ValueError(f"control string {a!r} can't be told apart from others")
        return found


class Renderer:
    """Turns to one string and back."""

    def __init__(self, template: Template):
        self.template = template
        controls = template.controls()
        self.plain = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in controls))
        self.marked = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in controls))
        self.by_role = {r[0]: r[1:] for r in template.roles}
        self.by_mark = {r[1]: (r[0], r[2]) for r in template.roles}
        self.open = re.compile("|".join(map(re.escape, [*self.by_mark, template.other[0]])))

    def escape(self, text: str) -> str:
        return self.plain.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)

    def unescape(self, text: str) -> str:
        return self.marked.sub(lambda m: m[0][0] + m[0][2:], text)

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The formatted piece and the spans of the texts that count for the loss."""
        parts, spans, at = [], [], 0
        for role, text in turns:
            before, after = self.by_role.get(role, (None, None))
            if before is None:
                before, after = self.template.other[0] + self.escape(role) + self.template.other[1], self.template.other[2]
            text = self.escape(text)
            if role == self.template.loss:
                spans.append((at + len(before), at + len(before) + len(text)))
            parts += (before, text, after)
            at += len(before) + len(text) + len(after)
        return "".join(parts), spans

    def parse(self, formatted: str) -> Iterator[tuple[str, str]]:
        at = 0
        while at < len(formatted):
            mark = self.open.match(formatted, at)
            start = mark.end()
            if mark[0] == self.template.other[0]:
                middle = formatted.index(self.template.other[1], start)
                role, after = self.unescape(formatted[start:middle]), self.template.other[2]
                start = middle + len(self.template.other[1])
            else:
                role, after = self.by_mark[mark[0]]
            end = formatted.index(after, start)
            yield role, self.unescape(formatted[start:end])
            at = end + len(after)


class Encoder:
    """A byte-level vocabulary to which the marks are added as special tokens."""

    def __init__(self, path: str, template: Template):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.renderer = Renderer(Template(template.roles, template.other, template.loss, special))
        self.tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in template.marks()])
        letters = byte_letters()
        self.bytes = {i: bytes(letters[c] for c in t) for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if all(c in letters for c in t)}

    def encode(self, formatted: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids and character spans of the tokens of each string. Long strings are encoded in parts, cut before a lone blank."""
        parts, first = [], []
        for text in formatted:
            first.append(len(parts))
            at = 0
            while len(text) - at > ENCODE_CHARS and (cut := CUT.search(text, at + ENCODE_CHARS)):
                parts.append((at, text[at : cut.start()]))
                at = cut.start()
            parts.append((at, text[at:]))
        coded = self.tokenizer.encode_batch([p for _, p in parts], add_special_tokens=False)
        out = []
        for lo, hi in zip(first, [*first[1:], len(parts)]):
            ids = np.fromiter(chain.from_iterable(c.ids for c in coded[lo:hi]), np.int32)
            n = [len(c.ids) for c in coded[lo:hi]]
            spans = np.fromiter(chain.from_iterable(chain.from_iterable(c.offsets for c in coded[lo:hi])), np.int64, 2 * len(ids)).reshape(-1, 2)
            spans = spans + np.repeat([at for at, _ in parts[lo:hi]], n)[:, None]
            out.append((ids, spans[:, 0], spans[:, 1]))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode()


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie inside a span; tokens and spans are sorted."""
    turn = np.array(spans, dtype=np.int64).reshape(-1, 2)
    lo, hi = np.searchsorted(starts, turn[:, 0], side="left"), np.searchsorted(ends, turn[:, 1], side="right")
    edge = np.zeros(len(starts) + 1, dtype=np.int64)
    some = hi > lo
    np.add.at(edge, lo[some], 1)
    np.add.at(edge, hi[some], -1)
    return np.cumsum(edge[:-1]) > 0


def format_conversations(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: Template | None = None, path: str | None = None
) -> DataFrame:
    """Formatted pieces: key, part, number, whole, formatted, input_ids, loss_mask.

    Pieces of a conversation follow (part, number); `whole` says that it is the only one. Turns follow `turn`, nulls first,
    ties by role and text; repeated rows are turns of their own. Null roles and texts count as empty, rows with a null key
    make a conversation. Other columns are left out; an empty table gives an empty table.
    """
    template, path = template or Template(), path or default_path("byte_bpe_50k.json")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(key).alias("key"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"))
    dealt = rows.repartitionByRange("key", "turn").sortWithinPartitions("key", "turn", "role", "text").drop("turn")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(key, whether it may go on in another task or has more pieces, turns)"""
        now, held, chars, first, split = None, [], 0, True, False
        for batch in batches:
            for k, r, t in zip(batch.column(0), as_text(batch.column(1)).to_pylist(), as_text(batch.column(2)).to_pylist()):
                k = k.as_py()
                if held and k != now:
                    yield now, first or split, held
                    held, chars, first, split = [], 0, False, False
                elif chars >= PIECE_CHARS:
                    yield now, True, held
                    held, chars, split = [], 0, True
                now = k
                held.append((r, t))
                chars += len(t)
        if held:
            yield now, True, held

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = Encoder(path, template), TaskContext.get().partitionId(), 0
        schema = None

        def batch_of(some: list[tuple]) -> pa.RecordBatch:
            texts, spans = zip(*[encoder.renderer.render(x[2]) for x in some])
            coded = encoder.encode(list(texts))
            masks = [loss_mask(starts, ends, s) for (_, starts, ends), s in zip(coded, spans)]
            columns = [
                pa.array([x[0] for x in some], schema), pa.array([part] * len(some), pa.int32()), pa.array(range(number, number + len(some)), pa.int32()),
                pa.array([not x[1] for x in some]), pa.array(texts, pa.string()), pa.array([c[0] for c in coded], pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.bool_())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["key", "part", "number", "whole", "formatted", "input_ids", "loss_mask"])

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in batches:
                schema = batch.schema.field(0).type
                yield batch

        some, chars = [], 0
        for piece in pieces(watched()):
            some.append(piece)
            chars += sum(len(t) for _, t in piece[2])
            if chars >= ENCODE_CHARS:
                yield batch_of(some)
                number, some, chars = number + len(some), [], 0
        if some:
            yield batch_of(some)

    kind = rows.schema["key"].dataType.simpleString()
    return dealt.mapInArrow(work, f"key {kind}, {ROW}, formatted string, input_ids array<int>, loss_mask array<boolean>")


def read_back(formatted: DataFrame, key: str = "conv_id", template: Template | None = None, path: str | None = None) -> DataFrame:
    """One row a conversation, from its formatted pieces alone: key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Turns are parsed from the formatted text; the loss text is decoded from the masked ids, run by run, and unescaped. A
    conversation of one piece is digested where it is; the texts of others are streamed in order through one digest.
    """
    template, path = template or Template(), path or default_path("byte_bpe_50k.json")
    kind = formatted.schema["key"].dataType.simpleString()

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, template)
        renderer = encoder.renderer
        names = ["key", "part", "number", "whole", "n_turns", "turns", "loss_chars", "loss", "formatted_chars"]
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for i in range(batch.num_rows):
                whole, text = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
                turns = list(renderer.parse(text))
                ids = batch.column(5)[i].values.to_numpy(zero_copy_only=False)
                mask = batch.column(6)[i].values.to_numpy(zero_copy_only=False)
                edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                loss = "".join([renderer.unescape(encoder.decode(ids[a:b].tolist())) for a, b in edges])
                said = "".join([f"{r}\n{t}\n" for r, t in turns])
                for column, value in zip(out, (len(turns), sha(said) if whole else said, len(loss), sha(loss) if whole else loss, len(text))):
                    column.append(value)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *(pa.array(c, k) for c, k in zip(out, kinds))], names=names)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, sums, hashes, schema = None, None, [], None

        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = (schema, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*found), kinds)], names=names)

        def ended() -> list[tuple]:
            return [(now, sums[0], hashes[0].hexdigest(), sums[1], hashes[1].hexdigest(), sums[2])] if sums else []

        for batch in batches:
            schema = batch.schema.field(0).type
            done: list[tuple] = []
            for k, _, _, whole, n, turns, chars, loss, size in zip(*(c.to_pylist() for c in batch.columns)):
                if sums and (whole or k != now):
                    done += ended()
                    sums = None
                if whole:
                    done.append((k, n, turns, chars, loss, size))
                    continue
                if not sums:
                    now, sums, hashes = k, [0, 0, 0], [hashlib.sha256(), hashlib.sha256()]
                sums = [sums[0] + n, sums[1] + chars, sums[2] + size]
                hashes[0].update(turns.encode())
                hashes[1].update(loss.encode())
            if done:
                yield rows(done)
        if sums:
            yield rows(ended())

    parsed = formatted.mapInArrow(parse, f"key {kind}, {ROW}, n_turns bigint, turns string, loss_chars bigint, loss string, formatted_chars bigint")
    gathered = parsed.repartition("key").sortWithinPartitions("key", "part", "number")
    out = gathered.mapInArrow(fold, f"key {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    return out.withColumnRenamed("key", key)
