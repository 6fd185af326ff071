"""Sampled SentencePiece segmentations without replacement, by Gumbel top-k over the lattice, and decoding.

A BPE vocabulary has ranks, not probabilities, so a piece of rank r gets a Zipf-Mandelbrot weight, 1 / (r + SHIFT). The
lattice of a text is a chain of the lattices of its units, which pieces never cross; equal units of a batch share one.
The first sample of a text is a plain one with a Gumbel score. All other segmentations fall into disjoint sets: those
that follow it up to a place and differ there. Each set's best Gumbel score is drawn, bounded by the score of the
sample that the set was split from, and the set with the best one is opened next (A-star search over perturbed
scores): its sample, then its own parts. So samples come distinct, best first, without listing segmentations.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.pieces import MARK, PieceTable, default_path, piece_table, units_of
from tagloom.llm.texts import HashIndex, as_text, give_back, mix64

SHIFT = 10.0
# Bytes of text whose units share one lattice; bounds memory, not texts.
PART_TEXT = 1 << 19
_WORD = (1 << 64) - 1
# Log weight of a piece per character, about; keeps masses of units in the range of floats.
_PER_CHARACTER = 2.5
_STEP = np.uint64(0x9E3779B97F4A7C15)


class PrefixTable:
    """A trie of the pieces as tables, and log weights of pieces.

    `step` has, for each prefix and each of the COMMON most frequent characters of the pieces, the prefix one character
    longer (0: none); other characters are looked up by (prefix, character) in an index.
    """

    COMMON = 96

    def __init__(self, vocabulary: PieceTable):
        prefixes = {"": 0}
        for piece in vocabulary.ids:
            for k in range(1, len(piece) + 1):
                prefixes.setdefault(piece[:k], len(prefixes))
        self.longest = max(map(len, vocabulary.ids))
        self.piece = np.full(len(prefixes), -1, np.int32)
        for piece, i in vocabulary.ids.items():
            self.piece[prefixes[piece]] = i
        often = [c for c, _ in Counter(c for p in vocabulary.ids for c in p).most_common(self.COMMON - 1)]
        # Class 0: any other character.
        self.classes = np.zeros(max(map(ord, often)) + 1, np.int32)
        self.classes[[ord(c) for c in often]] = np.arange(1, len(often) + 1)
        # Two bytes an entry where they do: the table is read at random, and should stay in the processor's cache.
        self.step = np.zeros((len(prefixes), self.COMMON), np.uint16 if len(prefixes) < 1 << 16 else np.int32)
        rare_keys, rare_values = [], []
        for prefix, node in prefixes.items():
            if prefix:
                before, code = prefixes[prefix[:-1]], ord(prefix[-1])
                kind = self.classes[code] if code < len(self.classes) else 0
                if kind:
                    self.step[before, kind] = node
                else:
                    rare_keys.append((before << 32) | code)
                    rare_values.append(node)
        self.rare, self.rare_values = HashIndex(np.array(rare_keys, np.uint64)), np.array([*rare_values, 0], self.step.dtype)
        rank = np.where(vocabulary.scores < -1e8, len(vocabulary.scores), -vocabulary.scores)
        weight = 1 / (rank + SHIFT)
        self.log_weight = np.log(weight / weight[vocabulary.normal].sum())
        # A byte piece has no rank: it counts as the last.
        self.log_byte = float(self.log_weight[vocabulary.normal].min())

    def kinds(self, codes: np.ndarray) -> np.ndarray:
        inside = codes < len(self.classes)
        return np.where(inside, self.classes[np.where(inside, codes, 0)], 0)

    def longer(self, node: np.ndarray, kind: np.ndarray, code: np.ndarray) -> np.ndarray:
        out = self.step.ravel().take(node.astype(np.int64) * self.COMMON + kind)
        other = np.flatnonzero(kind == 0)
        if len(other):
            found = self.rare.find((node[other].astype(np.uint64) << np.uint64(32)) | code[other].astype(np.uint64))
            out[other] = self.rare_values[found]
        return out


@lru_cache(maxsize=2)
def prefix_table(path: str) -> PrefixTable:
    return PrefixTable(piece_table(path))


class Lattice:
    """All ways through some units. Edges are ordered by their node; `p` is the probability of an edge at its node."""

    def __init__(self, table: PrefixTable, units: list[str], heat: float):
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = table.kinds(codes)
        sizes = np.array([len(u) for u in units], dtype=np.int64)
        unit = np.repeat(np.arange(len(units)), sizes)
        end = np.cumsum(sizes)[unit]
        at, node, found = np.arange(len(codes)), np.zeros(len(codes), table.step.dtype), []
        room = end - at
        count = np.zeros(len(codes), np.int32)
        for k in range(table.longest):
            inside = np.flatnonzero(room > k)
            at, node, room = at.take(inside), node.take(inside), room.take(inside)
            node = table.longer(node, kinds.take(at + k), codes.take(at + k))
            alive = np.flatnonzero(node)
            at, node, room = at.take(alive), node.take(alive), room.take(alive)
            if not len(at):
                break
            piece = table.piece.take(node)
            real = np.flatnonzero(piece >= 0)
            where, piece = at.take(real), piece.take(real)
            found.append((where, k + 1, piece, table.log_weight.take(piece)))
            count[where] += 1
            if k == 0:
                single = count.astype(bool)
        bare = np.flatnonzero(~single) if found else np.arange(len(codes))
        n_bytes = 1 + (codes[bare] >= 0x80).astype(int) + (codes[bare] >= 0x800) + (codes[bare] >= 0x10000)
        found.append((bare, 1, -1 - codes[bare].astype(np.int32), n_bytes * table.log_byte))
        count[bare] += 1
        # Longest pieces first at each place: they are likely, so a draw seldom looks further.
        free = np.cumsum(count)
        total = int(free[-1])
        self.piece, step, weight = np.empty(total, np.int32), np.empty(total, np.int32), np.empty(total)
        for where, size, piece, w in [found[-1], *found[:-1]]:
            free[where] -= 1
            slot = free[where]
            self.piece[slot], step[slot], weight[slot] = piece, size, w * heat
        # A node per character and one for the end of each unit.
        self.first_node = np.cumsum(sizes + 1) - (sizes + 1)
        self.last_node = self.first_node + sizes
        of_char = (np.arange(len(codes)) + unit).astype(np.int32)
        self.start = np.repeat(of_char, count)
        self.end = self.start + step
        per_node = np.zeros(len(codes) + len(units), np.int64)
        per_node[of_char] = count
        self.edges = np.r_[0, np.cumsum(per_node)]
        # Probability mass from each node to the end of its unit, in units of a mean piece per character, nearest to the end first.
        left = (end - np.arange(len(codes))).astype(np.int64)
        order = np.argsort(left.astype(np.int16) if left.max() < 1 << 15 else left, kind="stable")
        shift = self.edges[of_char[order]] - (np.cumsum(count[order]) - count[order])
        by_left = (np.arange(total) + np.repeat(shift, count[order])).astype(np.int32)
        cuts = np.searchsorted(left[order], np.arange(1, int(left.max()) + 2))
        edge_cuts = np.r_[0, np.cumsum(count[order])][cuts]
        with np.errstate(over="ignore", under="ignore", divide="ignore", invalid="ignore"):
            scaled = np.exp(weight + _PER_CHARACTER * heat * step)
            mass = np.ones(len(per_node))
            for lo, hi, a, b in zip(cuts[:-1], cuts[1:], edge_cuts[:-1], edge_cuts[1:]):
                if hi > lo:
                    e = by_left[a:b]
                    first = np.cumsum(count[order[lo:hi]]) - count[order[lo:hi]]
                    mass[of_char[order[lo:hi]]] = np.add.reduceat(scaled[e] * mass[self.end[e]], first)
            self.p = scaled * mass[self.end] / mass[self.start]
        if not (np.isfinite(self.p).all() and mass.min() > 1e-280):
            # Beyond the range of floats (very long units): the same in logarithms.
            mass = np.zeros(len(per_node))
            for lo, hi, a, b in zip(cuts[:-1], cuts[1:], edge_cuts[:-1], edge_cuts[1:]):
                if hi > lo:
                    e = by_left[a:b]
                    first = np.cumsum(count[order[lo:hi]]) - count[order[lo:hi]]
                    mass[of_char[order[lo:hi]]] = np.logaddexp.reduceat(weight[e] + mass[self.end[e]], first)
            self.p = np.exp(weight + mass[self.end] - mass[self.start])
        summed = np.cumsum(self.p)
        self.upto = summed - np.r_[0.0, summed][self.edges[self.start]]
        # The last edge of a node takes what rounding leaves.
        self.upto[self.edges[1:][per_node > 0] - 1] = 1.0

    def draw(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        edge = self.edges[nodes]
        on = np.flatnonzero(u > self.upto[edge])
        while len(on):
            edge[on] += 1
            on = on[u[on] > self.upto[edge[on]]]
        return edge


def uniforms(seed: np.ndarray, *counters) -> np.ndarray:
    """Numbers in (0, 1) from the row's seed and counters: the same on every run and in any partition."""
    h = seed
    for c in counters:
        h = mix64(h + np.asarray(c).astype(np.uint64) * _STEP + np.uint64(1))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def walk(lattice: Lattice, unit: np.ndarray, node: np.ndarray, seed: np.ndarray, place: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """From each node to the end of its unit: edges in order, and whose walk each belongs to."""
    on = np.flatnonzero(node < lattice.last_node[unit])
    edges, owners, step = [], [], 0
    node = node.copy()
    while len(on):
        e = lattice.draw(node[on], uniforms(seed[on], sample, place[on], step))
        edges.append(e)
        owners.append(on)
        node[on] = lattice.end[e]
        on = on[node[on] < lattice.last_node[unit[on]]]
        step += 1
    if not edges:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge, owner = np.concatenate(edges), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return edge[order], owner[order]


def _truncated(mass: float, bound: float, u: float) -> float:
    """Greatest Gumbel score of segmentations with this mass, given that it lies under the bound."""
    if mass <= 0:
        return -np.inf
    return float(-np.logaddexp(-bound, -(np.log(mass) - np.log(-np.log(u)))))


class TextSearch:
    """The search over one text's segmentations, given a plain sample: samples so far, and the sets that leave each of them.

    The sets that leave one sample are a family. The best score in a family depends on its whole mass alone, and the set
    that attains it is any of them in proportion to mass, so sets are drawn when opened and not before.
    """

    def __init__(self, lattice: Lattice, units: np.ndarray, seed: int, path: np.ndarray, place: np.ndarray):
        self.lattice, self.units, self.seed, self.draws = lattice, units, seed, 0
        # Per sample: edges, place of each edge's unit, masses of its sets, where it left its parent, without which edges, best score of its sets.
        self.paths: list[list] = []
        self.add(path, place, 0, -1, [], float(-np.log(-np.log(self.uniform()))), 0.0)

    def uniform(self) -> float:
        self.draws += 1
        h = (self.seed ^ (self.draws * 0x9E3779B97F4A7C15)) & _WORD
        for _ in range(2):
            h = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & _WORD
        return ((h ^ (h >> 32)) >> 11) * 2.0**-53 + 2.0**-54

    def add(self, path: np.ndarray, place: np.ndarray, first: int, left_at: int, barred: list[int], bound: float, taken: float) -> None:
        p = self.lattice.p[path]
        mass = np.cumprod(p)
        mass[1:] = mass[:-1] * (1 - p[1:])
        if len(p):
            mass[0] = 1 - p[0]
            before = mass[first] / (1 - p[first]) if p[first] < 1 else (np.prod(p[:first]))
            mass[first] = before * max(0.0, 1 - p[first] - taken)
        mass[:first] = 0
        mass[mass < 1e-13 * np.r_[1.0, np.cumprod(p)][:-1]] = 0
        self.paths.append([path, place, mass, left_at, barred, _truncated(float(mass.sum()), bound, self.uniform())])

    def threshold(self) -> float:
        """Best score among all segmentations that aren't samples."""
        return max(f[5] for f in self.paths)

    def branch(self) -> tuple[int, np.ndarray] | None:
        """Open the set with the best score and draw where its sample leaves: place of the unit, and nodes to go on from."""
        bound = self.threshold()
        if bound == -np.inf:
            return None
        family = next(f for f in self.paths if f[5] == bound)
        path, place, mass, left_at, without, _ = family
        upto = np.cumsum(mass)
        at = int(np.searchsorted(upto, self.uniform() * upto[-1], side="right"))
        at = min(at, int(np.flatnonzero(mass)[-1]))
        mass[at] = 0
        family[5] = _truncated(float(mass.sum()), bound, self.uniform())
        barred = [*(without if left_at == at else []), int(path[at])]
        node = int(self.lattice.start[path[at]])
        options = np.arange(self.lattice.edges[node], self.lattice.edges[node + 1])
        options = options[~np.isin(options, barred)]
        p = np.cumsum(self.lattice.p[options])
        edge = int(options[min(np.searchsorted(p, self.uniform() * p[-1], side="right"), len(options) - 1)])
        own = int(place[at])
        self.open = (path[:at], place[:at], edge, own, at, barred, bound)
        # The rest of this unit, then all units after it, anew.
        nodes = self.lattice.first_node[self.units[own:]].copy()
        nodes[0] = self.lattice.end[edge]
        return own, nodes

    def finish(self, rest: np.ndarray, rest_place: np.ndarray) -> None:
        head, place, edge, own, at, barred, bound = self.open
        taken = float(self.lattice.p[barred].sum())
        self.add(np.concatenate([head, [edge], rest]), np.concatenate([place, [own], rest_place]), at, at, barred, bound, taken)


def log_inclusion(log_p: float, threshold: float) -> float:
    """Log of the chance that a segmentation's perturbed score exceeds the threshold; 0 if all are included."""
    if threshold == -np.inf:
        return 0.0
    x = log_p - threshold
    return float(np.log(-np.expm1(-np.exp(x)))) if x > -30 else float(x)


class Sampler:
    def __init__(self, path: str, k: int, heat: float):
        self.vocabulary, self.table, self.k, self.heat = piece_table(path), prefix_table(path), k, heat

    def tokens(self, lattice: Lattice, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of edges and how many each has: an edge of a character outside the vocabulary is its bytes."""
        ids = lattice.piece[path]
        bare = ids < 0
        if not bare.any():
            return ids, np.ones(len(ids), np.int64)
        code = np.where(bare, -1 - ids, 0)
        n = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        place = np.cumsum(n) - n
        out = np.zeros(int(n.sum()), np.int32)
        out[place[~bare]] = ids[~bare]
        for c in np.unique(code[bare]).tolist():
            for j, b in enumerate(chr(c).encode("utf-8", "surrogatepass")):
                out[place[bare & (code == c)] + j] = self.vocabulary.byte_ids[b]
        return out, n

    def sample(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Up to k segmentations of each text: ids of all of them, their lengths, log probabilities, log inclusions, and texts."""
        cut = [units_of(t) for t in texts]
        number = dict.fromkeys(chain.from_iterable(cut))
        names = list(number)
        if not names:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts)), np.arange(len(texts))
        number.update(zip(names, range(len(names))))
        lattice = Lattice(self.table, names, self.heat)
        sizes = np.array([len(c) for c in cut])
        units = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        edges = np.r_[0, np.cumsum(sizes)]
        place = np.arange(len(units)) - np.repeat(edges[:-1], sizes)
        plain, owner = walk(lattice, units, lattice.first_node[units], np.repeat(seeds, sizes), place, 0)
        paths = np.searchsorted(owner, edges)
        searches = []
        for i in range(len(texts)):
            own = slice(paths[i], paths[i + 1])
            searches.append(TextSearch(lattice, units[edges[i] : edges[i + 1]], int(seeds[i]), plain[own], place[owner[own]]))
        for sample in range(1, self.k):
            # One step of every text's search, so that the walks of all texts are drawn together.
            going = [(t, found) for t in searches if (found := t.branch()) is not None]
            if not going:
                break
            counts = np.array([len(nodes) for _, (_, nodes) in going])
            units_, places = [np.concatenate(c) for c in zip(*[(t.units[own:], np.arange(own, len(t.units))) for t, (own, _) in going])]
            seeds_ = np.repeat(np.array([t.seed for t, _ in going], np.uint64), counts)
            rest, owner = walk(lattice, units_, np.concatenate([nodes for _, (_, nodes) in going]), seeds_, places, sample)
            cuts = np.searchsorted(owner, np.r_[0, np.cumsum(counts)])
            for (t, _), lo, hi in zip(going, cuts[:-1], cuts[1:]):
                t.finish(rest[lo:hi], places[owner[lo:hi]])
        found = [f[0] for t in searches for f in t.paths]
        owner = np.repeat(np.arange(len(texts)), [len(t.paths) for t in searches])
        sizes = np.array([len(f) for f in found])
        path = np.concatenate(found)
        ends = np.r_[0, np.cumsum(np.log(lattice.p[path]))][np.r_[0, np.cumsum(sizes)]]
        log_p = np.diff(ends)
        included = np.array([log_inclusion(p, searches[i].threshold()) for p, i in zip(log_p.tolist(), owner.tolist())])
        ids, per_edge = self.tokens(lattice, path)
        lengths = np.diff(np.r_[0, np.cumsum(per_edge)][np.r_[0, np.cumsum(sizes)]])
        return ids, lengths, log_p, included, owner


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1])
    lo = size = 0
    for i, n in enumerate(sizes.tolist()):
        size += n
        if size >= PART_TEXT or i == len(sizes) - 1:
            yield lo, i + 1
            lo, size = i + 1, 0


def shown_pieces(vocabulary: PieceTable) -> list[bytes]:
    """The bytes of each id; ids that are no pieces, such as control symbols, have none."""
    shown = [b""] * len(vocabulary.pieces)
    for piece, i in vocabulary.ids.items():
        shown[i] = piece.replace(MARK, " ").encode()
    for b, i in enumerate(vocabulary.byte_ids.tolist()):
        shown[i] = bytes([b])
    return shown


def sample_segmentations(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 2, heat: float = 1.0, path: str | None = None) -> DataFrame:
    """Up to k distinct segmentations of each whole text: key, content (hash of the text), sample, ids, log_prob, log_inclusion.

    `sample` counts from 0 in falling order of the perturbed score. `log_inclusion` is the log of the chance that the
    segmentation scores above the best one left out (0 if none is left out). `heat` raises weights to a power: smaller
    means more even. The numbers depend on the key, the text and the parameters alone, not on partitions or order. A null or
    empty text has one segmentation without pieces; a text with fewer than k gives all of them. Repeated rows give
    the same samples again. Null keys share one seed.
    """
    return _sampled(docs, key, text, k, heat, path).select(F.col("row.key").alias(key), F.col("row.content").alias("content"), "sample", "ids", "log_prob", "log_inclusion")


def _sampled(docs: DataFrame, key: str, text: str, k: int, heat: float, path: str | None) -> DataFrame:
    """Samples with `row` (key and content) and `round_trip`: whether the ids decode to the text, checked where they are drawn."""
    path = path or default_path("piece_bpe_32k.model")
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.struct(F.col(key).alias("key"), F.xxhash64(value).alias("content")).alias("row"), value.alias("text"), F.xxhash64(F.col(key).cast("string")).alias("seed"))
    kind = rows.schema["row"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(path, k, heat)
        shown = shown_pieces(sampler.vocabulary)
        for batch in batches:
            texts, seeds = as_text(batch.column(1)), batch.column(2).to_numpy().view(np.uint64)
            for lo, hi in _parts(texts):
                some = texts.slice(lo, hi - lo).to_pylist()
                ids, lengths, log_p, included, owner = sampler.sample(some, seeds[lo:hi])
                number = np.arange(len(owner)) - np.searchsorted(owner, owner)
                cuts = np.r_[0, np.cumsum(lengths)]
                # With the dummy prefix, if there is a text; marks in a text come back as blanks.
                want = [f" {t}".replace(MARK, " ").encode("utf-8", "surrogatepass") if t else b"" for t in some]
                said = b"".join(map(shown.__getitem__, ids.tolist()))
                if said == b"".join([want[i] for i in owner.tolist()]):
                    equal = np.ones(len(owner), dtype=bool)
                else:
                    equal = np.array([b"".join([shown[i] for i in ids[a:b].tolist()]) == want[o] for a, b, o in zip(cuts, cuts[1:], owner.tolist())])
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))
                columns = [batch.column(0).take(pa.array(owner + lo)), pa.array(number, pa.int32()), lists, pa.array(log_p), pa.array(included), pa.array(equal)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "sample", "ids", "log_prob", "log_inclusion", "round_trip"])
        give_back()

    return rows.mapInArrow(work, f"row {kind}, sample int, ids array<int>, log_prob double, log_inclusion double, round_trip boolean")


def decode_ids(rows: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """All rows and columns and the text of their ids: pieces with marks as blanks, bytes put together, the dummy prefix left out.

    Null ids give null. Ids that are no pieces, such as control symbols, give nothing; bytes that are no UTF-8 are
    shown as replacement characters. A column named as `out` is replaced.
    """
    path = path or default_path("piece_bpe_32k.model")
    rows = rows.drop(out) if out != ids else rows
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.col(ids).alias("ids"))
    kind = packed.schema["row"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = piece_table(path)
        shown = shown_pieces(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                lists = part.column(1)
                flat, cuts = lists.flatten().to_numpy(), np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]
                whole = [b"".join(map(shown.__getitem__, flat[a:b].tolist())).decode("utf-8", "replace").removeprefix(" ") for a, b in zip(cuts[:-1], cuts[1:])]
                texts = [t if ok else None for t, ok in zip(whole, lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["row", out])

    return packed.mapInArrow(work, f"row {kind}, {out} string").select("row.*", out)


def encode_decode(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 2, heat: float = 1.0, path: str | None = None) -> DataFrame:
    """Segmentations with their decoded text's check: key, sample, n_pieces, ids, ids_hash, log_prob, log_inclusion, round_trip.

    `round_trip` tells whether decoding gives back the text, whose marks, if any, come back as blanks. The ids are decoded
    by the task that drew them.
    """
    made = _sampled(docs, key, text, k, heat, path)
    return made.select(
        F.col("row.key").alias(key), "sample", F.size("ids").cast("long").alias("n_pieces"), "ids", F.xxhash64("ids").alias("ids_hash"), "log_prob", "log_inclusion", "round_trip",
    )
