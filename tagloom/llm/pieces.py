"""A SentencePiece BPE vocabulary as arrays, and the units of text that its merges never cross."""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np

# A piece never holds a mark after another character, so text splits exactly before such marks.
MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
NO_PAIR = np.iinfo(np.int32).max
# Units longer than this are merged one by one from a heap: many rounds over one unit cost more.
HEAP_LENGTH = 2048
_PAIR_TABLES = frozenset(["keys", "merged", "ranks", "lookup", "leftmost", "_shift", "_slots", "_probes"])


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def units_of(text: str | None) -> list[str]:
    """The text with its dummy prefix and marked blanks, cut into units. Empty or null text has none."""
    return UNIT.findall(MARK + text.replace(" ", MARK)) if text else []


class PieceTable:
    """Pieces, scores and the table of pairs that merge into a piece.

    Checked on loading: the text is taken as it is (identity rule, one dummy prefix), no piece holds a mark after
    another character, each character of a piece is a piece itself, and there are no user symbols.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.normal = np.array(normal)
        self.scores = np.array([sp.get_score(i) for i in range(size)])
        self.ids = {self.pieces[i]: i for i in normal}
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        ok = sp.normalize(" \tÁﬁ ") == f"{MARK}{MARK}\tÁﬁ{MARK}"
        ok &= not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        ok &= all(c in self.ids for p in self.ids for c in p)
        if not ok:
            raise ValueError(f"{path}: units of this vocabulary can't be merged apart from each other")

    def __getattr__(self, name: str):
        """The tables of pairs are made when first asked for: decoding and lattices need none."""
        if name not in _PAIR_TABLES:
            raise AttributeError(name)
        self._pairs()
        return self.__dict__[name]

    def _pairs(self) -> None:
        order = {s: r for r, s in enumerate(sorted({self.scores[i] for i in self.ids.values()}, reverse=True))}
        rank = np.full(len(self.pieces), NO_PAIR, dtype=np.int32)
        for i in self.ids.values():
            rank[i] = order[self.scores[i]]
        left, right, whole = [], [], []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), whole.append(i)
        a, b, c = (np.array(x, dtype=np.int64) for x in (left, right, whole))
        keys = (a << 32) | b
        at = np.argsort(keys)
        self.keys, self.merged = keys[at], c[at].astype(np.int32)
        self.ranks = rank[self.merged]
        self.lookup = {int(k): (int(r), int(m)) for k, r, m in zip(self.keys, self.ranks, self.merged)}
        # After a merge into one of these, a better pair may appear beside it: only the leftmost is merged then.
        self.leftmost = np.zeros(len(self.pieces), dtype=bool)
        for side in (a, b):
            self.leftmost[side[rank[c] <= rank[side]]] = True
        # Open-addressed copy of the pair table: one or two probes instead of a binary search.
        bits = int(np.ceil(np.log2(len(keys) * 4)))
        self._shift = np.uint64(64 - bits)
        slots = np.full(1 << bits, -1, dtype=np.int32)
        todo = np.arange(len(self.keys))
        place = self._slot(self.keys)
        self._probes = 0
        while len(todo):
            self._probes += 1
            free = slots[place] < 0
            slots[place[free]] = todo[free]
            lost = slots[place] != todo
            todo, place = todo[lost], (place[lost] + 1) & (len(slots) - 1)
        self._slots = slots

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each pair; NO_PAIR where it doesn't merge."""
        keys = (a.astype(np.int64) << 32) | b.astype(np.int64)
        rank, merged = np.full(len(keys), NO_PAIR, dtype=np.int32), np.full(len(keys), -1, dtype=np.int32)
        open_ = np.flatnonzero((a >= 0) & (b >= 0))
        place = self._slot(keys[open_])
        while len(open_):
            got = self._slots[place]
            real = got >= 0
            hit = real & (self.keys[got] == keys[open_])
            rank[open_[hit]], merged[open_[hit]] = self.ranks[got[hit]], self.merged[got[hit]]
            go = real & ~hit
            open_, place = open_[go], (place[go] + 1) & (len(self._slots) - 1)
        return rank, merged

    def symbols(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First symbols: a piece id for a character, or minus the number of its UTF-8 bytes if it is no piece."""
        text = "".join(units)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        seen, at = np.unique(codes, return_inverse=True)
        own = [self.ids.get(chr(c), -len(chr(c).encode("utf-8", "surrogatepass"))) for c in seen.tolist()]
        return np.array(own, dtype=np.int32)[at], np.array([len(u) for u in units], dtype=np.int64)


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    return PieceTable(path)


def merge_one(vocabulary: PieceTable, sym: list[int]) -> list[int]:
    """Merge one long unit: best pair first, leftmost among equals, from a heap."""
    n = len(sym)
    nxt, prv = list(range(1, n)) + [-1], list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = nxt[i] if i >= 0 else -1
        if i >= 0 and j >= 0 and sym[i] >= 0 and sym[j] >= 0:
            found = vocabulary.lookup.get((sym[i] << 32) | sym[j])
            if found:
                heapq.heappush(heap, (found[0], i, sym[i], sym[j], found[1]))

    gone = [False] * n
    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b, c = heapq.heappop(heap)
        j = nxt[i]
        if gone[i] or j < 0 or sym[i] != a or sym[j] != b:
            continue
        sym[i], gone[j], nxt[i] = c, True, nxt[j]
        if nxt[j] >= 0:
            prv[nxt[j]] = i
        offer(prv[i])
        offer(i)
    return [s for s, g in zip(sym, gone) if not g]
