"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). The first factor is a softmax over classes with hashed
n-gram and skip features of the history. The second goes down a tree over the words of the class, by the bits of their
hash: at each node a softmax over two branches, whose prior is the counts below them and whose features are the same
histories, hashed together with the node. In a leaf words go by their counts. Counts are plus one, and words never seen
share one unit of a class, so all sums are known exactly. Words are 64-bit hashes throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.texts import LOWER, HashIndex, located_words, mix64, text_parts
from tagloom.session import materialize

# Spelling groups of words (by their last two bytes), clustered into classes by what they stand beside. Group and
# class 0 are the end of a text alone.
GROUPS = 256
CLASSES = 25
# Buckets of each feature: previous word, word before it, these two as a pair, word three back.
FEATURES = 4
BUCKETS = 2048
# Levels of the tree over the words of a class, at most; fewer while there are few words.
LEVELS = 12
# Hashed weights of its branches grow with the training tokens, one for each two, between these powers of two.
WEIGHT_BITS = (12, 20)
# Tokens that go down the tree at a time, and levels whose weights lie together.
TREE_BLOCK = 1 << 14
NEAR_LEVELS = 4
# Pull of a branch weight to zero, as that many even decisions, and the longest step of an update.
BRANCH_PULL, BRANCH_STEP = 6.0, 2.0
# Each training text takes part in one of so many synchronous updates.
ROUNDS = 4
# Words with at least this share of all tokens are looked up from a broadcast table; there are at most as many.
COMMON = 1 << 20
# Tokens gathered in a task before they are handed on, and words in a bucket of the counts, about.
FLUSH_TOKENS = 1 << 21
BUCKET_WORDS = 1 << 18
# Bytes of training text whose sums one task adds up, about, and tokens between additions to its exact sums.
GRADIENT_BYTES = 128 << 20
EXACT_TOKENS = 1 << 20
# Tokens that go through the softmax over the classes at a time.
CLASS_BLOCK = 1 << 13
# Arrays that are added up in one group; more are added in two steps.
ONE_STEP = 16
END = 0x5851F42D4C957F2D
_CHUNKS = 16


def remainder(key: Column, modulus: int) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(modulus))


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a run of texts, an end after each text: hash, spelling group, row."""
    words, row, _, ends = located_words(data, offsets)
    rows = len(offsets) - 1
    last = LOWER[data[ends - 1]].astype(np.uint64) if len(ends) else np.zeros(0, np.uint64)
    before = np.where(ends >= 2, LOWER[data[ends - 2]], 0).astype(np.uint64) if len(ends) else last
    group = (1 + mix64(last * np.uint64(256) + before) % np.uint64(GROUPS - 1)).astype(np.int64)
    n = np.bincount(row, minlength=rows)
    place = np.arange(len(words)) + row
    total = len(words) + rows
    token, groups, owner = np.full(total, END, np.uint64), np.zeros(total, np.int64), np.repeat(np.arange(rows), n + 1)
    token[place], groups[place] = words, group
    return token, groups, owner


def histories_of(token: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Hashes of the features of each token's history; before the start of a text stands 0."""

    def back(k: int) -> np.ndarray:
        out = np.zeros_like(token)
        same = owner[k:] == owner[:-k]
        out[k:][same] = token[:-k][same]
        return out

    one, two, three = back(1), back(2), back(3)
    keys = (one, two ^ np.uint64(0xA5A5A5A5), one * np.uint64(3) + two, three ^ np.uint64(0x5A5A5A5A5A))
    return [mix64(k + np.uint64(j)) for j, k in enumerate(keys)]


def buckets_of(histories: list[np.ndarray]) -> np.ndarray:
    return np.stack([(h % np.uint64(BUCKETS)).astype(np.int64) + j * BUCKETS for j, h in enumerate(histories)])


def features_of(token: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Buckets of the features of each token's history."""
    return buckets_of(histories_of(token, owner))


def leaves_of(token: np.ndarray, levels: int) -> np.ndarray:
    return (mix64(token ^ np.uint64(0x3C6EF372FE94F82B)) >> np.uint64(64 - levels)).astype(np.int64)


@dataclass
class ClassModel:
    """Weights of the class softmax, the class of each spelling group, and the size of each class's own softmax."""

    weights: np.ndarray
    bias: np.ndarray
    classes: np.ndarray
    log_sizes: np.ndarray

    def sums(self, features: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """By block of tokens: the first one, and by class and token the sums of weights below the largest, their exponentials, and the sum of these."""
        for lo in range(0, features.shape[1], CLASS_BLOCK):
            z = self.weights.take(features[0, lo : lo + CLASS_BLOCK], axis=0, mode="clip")
            for f in features[1:, lo : lo + CLASS_BLOCK]:
                z += self.weights.take(f, axis=0, mode="clip")
            z += self.bias
            z = np.ascontiguousarray(z.T)
            z -= z.max(axis=0)
            e = np.exp(z)
            yield lo, z, e, e.sum(axis=0)

    def log_classes(self, features: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of all classes, by token."""
        return np.concatenate([np.zeros((0, CLASSES), np.float32), *((z - np.log(total)).T for _, z, _, total in self.sums(features))])

    def log_targets(self, features: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The same of each token's own class."""
        out = np.zeros(len(target))
        for lo, z, _, total in self.sums(features):
            n = z.shape[1]
            out[lo : lo + n] = z[target[lo : lo + n], np.arange(n)] - np.log(total)
        return out

    def add_expected(self, features: np.ndarray, sums: np.ndarray) -> None:
        """Add the probabilities of the classes to each token's buckets; `sums` is by class and bucket."""
        for lo, z, e, total in self.sums(features):
            p = (e / total).astype(np.float64)
            for j, f in enumerate(features[:, lo : lo + z.shape[1]]):
                own = f - j * BUCKETS
                for c in range(CLASSES):
                    sums[c, j * BUCKETS : (j + 1) * BUCKETS] += np.bincount(own, p[c], BUCKETS)


@dataclass
class WordTree:
    """Priors of the branches of each class's tree (share of the upper branch, by class and node) and their hashed weights."""

    levels: int
    prior: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, mass: np.ndarray, bits: int) -> WordTree:
        """The tree before training; `mass` is what lies in each leaf, by class."""
        levels = int(mass.shape[1]).bit_length() - 1
        prior = np.zeros(mass.shape)
        below = mass
        for level in reversed(range(levels)):
            pairs = below.reshape(len(mass), -1, 2)
            below = pairs.sum(axis=2)
            prior[:, 1 << level : 2 << level] = pairs[:, :, 1] / np.maximum(below, 1)
        return cls(levels, prior.astype(np.float32).ravel(), np.zeros(1 << bits, np.float32))

    def decisions(self, histories: list[np.ndarray], target: np.ndarray, leaf: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """By block of tokens and level: the block's first token, branches, priors, sums of weights, and cells of these.

        A history's cells for the nodes of NEAR_LEVELS levels below a node lie side by side. Where a branch holds nothing
        (prior 0 or 1), whatever the weights say, gain and gradient are 0.
        """
        shift = np.uint64(64 - int(len(self.weights)).bit_length() + 1 + NEAR_LEVELS)
        for lo in range(0, len(target), TREE_BLOCK):
            own, last = target[lo : lo + TREE_BLOCK] << self.levels, leaf[lo : lo + TREE_BLOCK]
            block = [h[lo : lo + TREE_BLOCK] for h in histories]
            for level in range(self.levels):
                above = last >> (self.levels - level)
                node = own + ((1 << level) + above)
                near = level % NEAR_LEVELS
                if near == 0:
                    key = node.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                    first = [((((h ^ key) * np.uint64(0x9E3779B97F4A7C15)) >> shift) << np.uint64(NEAR_LEVELS)).view(np.int64) for h in block]
                place = (1 << near) + (above & ((1 << near) - 1))
                cells = [f + place for f in first]
                z = self.weights.take(cells[0], mode="clip")
                for cell in cells[1:]:
                    z += self.weights.take(cell, mode="clip")
                yield lo, (last >> (self.levels - 1 - level)) & 1, self.prior.take(node, mode="clip"), z, cells

    def log_gain(self, histories: list[np.ndarray], target: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Natural logarithm of each token's probability within its class over that by counts alone."""
        out = np.zeros(len(target))
        for lo, branch, prior, z, _ in self.decisions(histories, target, leaf):
            out[lo : lo + len(z)] += branch * z - np.log(1 + prior * (np.exp(z) - 1))
        return out

    def add_gradient(self, histories: list[np.ndarray], target: np.ndarray, leaf: np.ndarray, sums: np.ndarray) -> None:
        """Of each cell, as complex numbers: observed less expected upper branches, and the variance of the expected ones."""
        for _, branch, prior, z, cells in self.decisions(histories, target, leaf):
            up = prior * np.exp(z)
            p = up / (up + (1 - prior))
            both = np.empty(len(p), sums.dtype)
            both.real, both.imag = branch - p, p * (1 - p)
            for cell in cells:
                np.add.at(sums, cell, both)


def sum_arrays(parts: DataFrame, tasks: int, number: type = np.float64) -> list[np.ndarray]:
    """Element-wise sums of the arrays of so many tasks, as rows (chunk, salt, values), by chunk. Many are added in two steps, so
    that no group holds one array per task; few would only be written once more."""

    def add(group: pa.Table) -> pa.Table:
        values = group.column("values").to_pylist()
        total = np.frombuffer(values[0], number).astype(np.float64)
        for v in values[1:]:
            total += np.frombuffer(v, number)
        return pa.table({"chunk": group.column("chunk")[:1], "salt": group.column("salt")[:1], "values": pa.array([total.astype(number).tobytes()], pa.binary())})

    kind = "chunk int, salt int, values binary"
    if tasks > ONE_STEP:
        parts = parts.groupBy("chunk", "salt").applyInArrow(add, kind)
    rows = parts.groupBy("chunk").applyInArrow(add, kind).collect()
    return [np.frombuffer(bytes(r["values"]), number) for r in sorted(rows, key=lambda r: r["chunk"])]


def _chunked(values: np.ndarray, salt: int, number: type = np.float64) -> pa.RecordBatch:
    pieces = np.array_split(np.ascontiguousarray(values, dtype=number).ravel(), _CHUNKS)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(_CHUNKS), pa.int32()), pa.array([salt] * _CHUNKS, pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary())], names=["chunk", "salt", "values"]
    )


def _task_salt(tasks: int) -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return (context.partitionId() if context else 0) % max(1, math.isqrt(tasks))


def _pack(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.array([values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return (key[first], first, order) + tuple(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values)


def count_words(texts: DataFrame, buckets: int) -> DataFrame:
    """Counts of all tokens, packed by bucket: bucket, tokens, groups, counts. Tasks add up their own tokens first.

    Rows of bucket -1 - g hold how often each spelling group follows group g.
    """

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        token, group = (np.concatenate(c) for c in zip(*held))
        token, first, order, n = _summed(token, np.ones(len(token), np.int64))
        group = group[order][first]
        bucket = (token & np.uint64(buckets - 1)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        token, group, n, bucket = token[order], group[order], n[order], bucket[order]
        edges = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
        columns = [pa.array(bucket[edges[:-1]]), _pack(token, edges), _pack(group.astype(np.uint16), edges), _pack(n, edges)]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "tokens", "groups", "counts"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        follows = np.zeros(GROUPS * GROUPS, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_parts(batch.column(0)):
                token, group, owner = tokens_of(data, offsets)
                same = owner[1:] == owner[:-1]
                follows += np.bincount(group[:-1][same] * GROUPS + group[1:][same], minlength=GROUPS * GROUPS)
                held.append((token, group))
                size += len(token)
                if size >= FLUSH_TOKENS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)
        follows = follows.reshape(GROUPS, GROUPS)
        some = np.flatnonzero(follows.any(axis=1))
        none = pa.array([b""] * len(some), pa.binary())
        columns = [pa.array(-1 - some, pa.int32()), none, none, pa.array([follows[g].tobytes() for g in some], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "tokens", "groups", "counts"])

    def add(group: pa.Table) -> pa.Table:
        if group.column("bucket")[0].as_py() < 0:
            n = _joined(group.column("counts"), np.int64).reshape(-1, GROUPS).sum(axis=0)
            return pa.table([*(group.column(c)[:1] for c in ("bucket", "tokens", "groups")), pa.array([n.tobytes()], pa.binary())], names=["bucket", "tokens", "groups", "counts"])
        token, first, order, n = _summed(_joined(group.column("tokens"), np.uint64), _joined(group.column("counts"), np.int64))
        groups = _joined(group.column("groups"), np.uint16)[order][first]
        whole = [pa.array([v.tobytes()], pa.binary()) for v in (token, groups, n)]
        return pa.table([group.column("bucket")[:1], *whole], names=["bucket", "tokens", "groups", "counts"])

    kind = "bucket int, tokens binary, groups binary, counts binary"
    return texts.mapInArrow(work, kind).groupBy("bucket").applyInArrow(add, kind)


def neighbour_counts(counted: DataFrame) -> np.ndarray:
    """How often each spelling group follows each other one."""
    follows = np.zeros((GROUPS, GROUPS))
    for row in counted.filter("bucket < 0").select("bucket", "counts").collect():
        follows[-1 - row["bucket"]] = np.frombuffer(bytes(row["counts"]), np.int64)
    return follows


def cluster_groups(follows: np.ndarray, seed: int = 3) -> np.ndarray:
    """Class of each spelling group: k-means over what stands before and after it. The end of a text is class 0."""
    rng = np.random.default_rng(seed)
    total = follows.sum() + 1
    parts = []
    for m in (follows, follows.T):
        expected = (m.sum(1, keepdims=True) + 1) * (m.sum(0, keepdims=True) + 1) / total
        parts.append(np.maximum(np.log((m + 1) / (expected + 1)), 0))
    left, values, _ = np.linalg.svd(np.concatenate(parts, axis=1), full_matrices=False)
    x = left[:, :24] * values[:24]
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    weight = follows.sum(0) + 1
    k = CLASSES - 1
    centres = x[1 + rng.choice(GROUPS - 1, k, replace=False, p=weight[1:] / weight[1:].sum())]
    for _ in range(30):
        own = (x @ centres.T).argmax(axis=1)
        for c in range(k):
            members = own == c
            members[0] = False
            if members.any():
                centres[c] = np.average(x[members], axis=0, weights=weight[members])
                centres[c] /= np.linalg.norm(centres[c]) + 1e-9
    own = (x @ centres.T).argmax(axis=1) + 1
    own[0] = 0
    return own


def leaf_masses(vocabulary: DataFrame, classes: np.ndarray, levels: int) -> np.ndarray:
    """Counts plus one of all words, by class and leaf."""
    tasks = vocabulary.rdd.getNumPartitions()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES << levels)
        for batch in batches:
            for tokens, groups, counts in zip(*batch.columns):
                token, count = np.frombuffer(tokens.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.int64)
                target = classes[np.frombuffer(groups.as_buffer(), np.uint16)]
                total += np.bincount((target << levels) + leaves_of(token, levels), weights=count + 1.0, minlength=len(total))
        yield _chunked(total, _task_salt(tasks))

    sums = sum_arrays(vocabulary.select("tokens", "groups", "counts").mapInArrow(work, "chunk int, salt int, values binary"), tasks)
    return (np.concatenate(sums) if sums else np.zeros(CLASSES << levels)).reshape(CLASSES, 1 << levels)


def gradient_parts(texts: DataFrame, model: ClassModel, tree: WordTree, tasks: int) -> DataFrame:
    """Sums over texts, added up in each task: observed and expected counts of each (feature, class), slope and bend of each branch weight."""
    shared = texts.sparkSession.sparkContext.broadcast((model, tree))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tree = shared.value
        n = FEATURES * BUCKETS
        seen, expected = np.zeros(n * CLASSES), np.zeros((CLASSES, n))
        # Branches go to an array of half the size, which stays nearer to the core, and from there to the exact sums.
        branches, recent, size = np.zeros(len(tree.weights), np.complex128), np.zeros(len(tree.weights), np.complex64), 0
        for batch in batches:
            for _, _, data, offsets in text_parts(batch.column(0), 1 << 19):
                token, group, owner = tokens_of(data, offsets)
                histories, target = histories_of(token, owner), model.classes[group]
                features = buckets_of(histories)
                model.add_expected(features, expected)
                for f in features:
                    seen += np.bincount(f * CLASSES + target, minlength=n * CLASSES)
                tree.add_gradient(histories, target, leaves_of(token, tree.levels), recent)
                size += len(token)
                if size >= EXACT_TOKENS:
                    branches += recent
                    recent[:], size = 0, 0
        branches += recent
        yield _chunked(np.concatenate([seen, expected.T.ravel(), branches.real, branches.imag]), _task_salt(tasks), np.float32)

    return texts.mapInArrow(work, "chunk int, salt int, values binary")


def train(training: DataFrame, size: int, classes: np.ndarray, group_tokens: np.ndarray, group_words: np.ndarray, tree: WordTree) -> tuple[ClassModel, WordTree]:
    """Fit both softmaxes: ROUNDS synchronous updates, each from the texts of its share of the keys.

    The step of a class weight is the logarithm of observed over expected count, divided by the number of features that are
    active together: the gradient scaled for each weight, as in iterative scaling. That of a branch weight is its slope over its bend.
    """
    tokens = np.bincount(classes, weights=group_tokens, minlength=CLASSES)
    words = np.bincount(classes, weights=group_words, minlength=CLASSES)
    prior = (tokens + 1) / (tokens.sum() + CLASSES)
    model = ClassModel(np.zeros((FEATURES * BUCKETS, CLASSES), np.float32), np.log(prior).astype(np.float32), classes, np.log10(tokens + words + 1))
    # A task sends one array of sums, so there are tasks for all cores, and more of them only for more text.
    cores = training.sparkSession.sparkContext.defaultParallelism
    tasks = cores * max(1, -(-size // (GRADIENT_BYTES * cores)))
    training = training.coalesce(tasks)
    share = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit("round")), F.lit(ROUNDS))
    n = FEATURES * BUCKETS * CLASSES
    for r in range(ROUNDS):
        sums = sum_arrays(gradient_parts(training.filter(share == r).select("text"), model, tree, tasks), tasks, np.float32)
        if not sums:
            continue
        sums = np.concatenate(sums)
        seen, expected = sums[: 2 * n].reshape(2, FEATURES * BUCKETS, CLASSES)
        slope, bend = sums[2 * n :].reshape(2, -1)
        pull = 5 * prior[None]
        step = np.log((seen + pull) / (expected + pull)) * (1.5 / FEATURES)
        model = ClassModel(model.weights + step.astype(np.float32), model.bias, model.classes, model.log_sizes)
        step = np.clip(slope / (bend + BRANCH_PULL / 4) * (1.5 / FEATURES), -BRANCH_STEP, BRANCH_STEP)
        tree = WordTree(tree.levels, tree.prior, tree.weights + step.astype(np.float32))
    return model, tree


_SCORED = "kind int, row {row}, content bigint, n_tokens bigint, n_known bigint, counted double, classed double, ranked double, bucket int, texts binary, tokens binary, times binary, gains binary"


def score_parts(rows: DataFrame, model: ClassModel, tree: WordTree, common: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """Of each text: class scores, and counts and gains of common words. Other words are handed on, packed by bucket, once per text:
    a word has a place in the tree only if it is known."""
    shared = rows.sparkSession.sparkContext.broadcast((model, tree, common))
    kind = rows.schema["row"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tree, (keys, counts) = shared.value
        index, logs = HashIndex(keys), np.log10(counts + 1.0)
        row_type = None
        held: list[tuple[np.ndarray, ...]] = []
        size, seen = 0, set()

        def flush() -> pa.RecordBatch:
            text, token, times, gains = (np.concatenate(c) for c in zip(*held))
            bucket = (token & np.uint64(buckets - 1)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            text, token, times, gains, bucket = text[order], token[order], times[order], gains[order], bucket[order]
            edges = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
            n = len(edges) - 1
            nulls = [pa.nulls(n, t) for t in (row_type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())]
            packed = [_pack(text, edges), _pack(token, edges), _pack(times.astype(np.uint32), edges), _pack(gains.astype(np.float32), edges)]
            return pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int32()), *nulls, pa.array(bucket[edges[:-1]]), *packed], names=names)

        names = ["kind", "row", "content", "n_tokens", "n_known", "counted", "classed", "ranked", "bucket", "texts", "tokens", "times", "gains"]
        for batch in batches:
            row_type = batch.schema.field(0).type
            for lo, hi, data, offsets in text_parts(batch.column(1), 1 << 19):
                n = hi - lo
                token, group, owner = tokens_of(data, offsets)
                target = model.classes[group]
                histories = histories_of(token, owner)
                logp = model.log_targets(buckets_of(histories), target) / np.log(10)
                gain = tree.log_gain(histories, target, leaves_of(token, tree.levels)) / np.log(10)
                classed = np.bincount(owner, weights=logp - model.log_sizes[target], minlength=n)
                # A text's result depends on its tokens alone, so equal texts share one number and are counted once.
                place = np.arange(len(token)) - np.r_[0, np.cumsum(np.bincount(owner, minlength=n))[:-1]][owner]
                spread = mix64(token + mix64(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                content = np.add.reduceat(spread, head).view(np.int64)
                at = index.find(token)
                known = at >= 0
                counted = np.bincount(owner[known], weights=logs[at[known]], minlength=n)
                ranked = np.bincount(owner[known], weights=gain[known], minlength=n)
                rare = np.flatnonzero(~known)
                fresh = np.array([c not in seen for c in content.tolist()])
                if len(seen) > FLUSH_TOKENS:
                    seen.clear()
                seen.update(content.tolist())
                rare = rare[fresh[owner[rare]]]
                order = rare[np.lexsort((token[rare], owner[rare]))]
                if len(order):
                    first = np.flatnonzero(np.r_[True, (token[order][1:] != token[order][:-1]) | (owner[order][1:] != owner[order][:-1])])
                    times = np.diff(np.r_[first, len(order)])
                    held.append((content[owner[order[first]]], token[order[first]], times, np.add.reduceat(gain[order], first)))
                    size += len(first)
                arrays = [pa.array([0] * n, pa.int32()), batch.column(0).slice(lo, n), pa.array(content), pa.array(np.bincount(owner, minlength=n)), pa.array(np.bincount(owner[known], minlength=n)),
                          pa.array(counted), pa.array(classed), pa.array(ranked), pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.binary())] * 4]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                if size >= FLUSH_TOKENS:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    return rows.mapInArrow(work, _SCORED.format(row=kind))


def rare_sums(rare: DataFrame, vocabulary: DataFrame, buckets: int) -> DataFrame:
    """content, n_known, counted, ranked: what the counts and gains of rare words add to each text."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        text, token, times = _joined(left.column("texts"), np.int64), _joined(left.column("tokens"), np.uint64), _joined(left.column("times"), np.uint32).astype(np.int64)
        gains = _joined(left.column("gains"), np.float32)
        keys, counts = _joined(right.column("tokens"), np.uint64), _joined(right.column("counts"), np.int64)
        order = np.lexsort((token, text))
        text, token, times, gains = text[order], token[order], times[order], gains[order]
        once = np.r_[True, (text[1:] != text[:-1]) | (token[1:] != token[:-1])][: len(text)]
        text, token, times, gains = text[once], token[once], times[once], gains[once]
        at = np.minimum(np.searchsorted(keys, token), max(0, len(keys) - 1))
        known = keys[at] == token if len(keys) else np.zeros(len(token), bool)
        counted = np.where(known, np.log10((counts[at] if len(keys) else np.zeros(len(at))) + 1.0), 0) * times
        ranked = np.where(known, gains, 0).astype(np.float64)
        own = (text & (buckets - 1)).astype(np.int32)
        first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]][: len(text)])
        if len(first):
            known, counted, ranked = (np.add.reduceat(x, first) for x in (known * times, counted, ranked))
            text, own = text[first], own[first]
        order = np.argsort(own, kind="stable")
        text, own, known, counted, ranked = text[order], own[order], known[order], counted[order], ranked[order]
        edges = np.r_[np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), len(own)] if len(own) else np.zeros(1, np.int64)
        columns = [pa.array(own[edges[:-1]], pa.int32()), _pack(text, edges), _pack(known.astype(np.int64), edges), _pack(counted.astype(np.float64), edges), _pack(ranked, edges)]
        return pa.table(columns, names=["own", "texts", "known", "counted", "ranked"])

    def add(group: pa.Table) -> pa.Table:
        parts = [_joined(group.column(c), kind) for c, kind in (("texts", np.int64), ("known", np.int64), ("counted", np.float64), ("ranked", np.float64))]
        text, _, _, known, counted, ranked = _summed(*parts)
        return pa.table({"content": pa.array(text, pa.int64()), "n_known": pa.array(known, pa.int64()), "counted": pa.array(counted, pa.float64()), "ranked": pa.array(ranked, pa.float64())})

    both = rare.groupBy("bucket").cogroup(vocabulary.groupBy("bucket")).applyInArrow(meet, "own int, texts binary, known binary, counted binary, ranked binary")
    return both.groupBy("own").applyInArrow(add, "content bigint, n_known bigint, counted double, ranked double")


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", modulus: int = 7, held: int = 2) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities) for every row.

    The model learns from the rows whose remainder isn't `held` (CRC-32 of the key as text, modulo `modulus`); a null
    key is neither held out nor learned from. Null and empty texts are one end token. Rows are kept one for one. With no
    training text every token is unknown, N and V are 0, and the class softmax is uniform.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(1 << 16, 1 << max(0, int(np.ceil(np.log2(max(1, size / 40 / BUCKET_WORDS))))))
    training = rows.filter(remainder(F.col("key"), modulus) != held)
    counted = materialize(count_words(training.select("text"), buckets), "vocabulary")
    vocabulary = counted.filter("bucket >= 0")
    tasks = vocabulary.rdd.getNumPartitions()

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, words = np.zeros(GROUPS), np.zeros(GROUPS)
        for batch in batches:
            for groups, counts in zip(batch.column(0), batch.column(1)):
                groups, counts = np.frombuffer(groups.as_buffer(), np.uint16), np.frombuffer(counts.as_buffer(), np.int64)
                tokens += np.bincount(groups, weights=counts, minlength=GROUPS)
                words += np.bincount(groups, minlength=GROUPS)
        yield _chunked(np.concatenate([tokens, words]), _task_salt(tasks))

    sums = sum_arrays(vocabulary.select("groups", "counts").mapInArrow(totals, "chunk int, salt int, values binary"), tasks)
    group_tokens, group_words = (np.concatenate(sums) if sums else np.zeros(2 * GROUPS)).reshape(2, GROUPS)
    n, v = int(group_tokens.sum()), int(group_words.sum())
    least = max(1, -(-n // COMMON))

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens, counts in zip(batch.column(0), batch.column(1)):
                tokens, counts = np.frombuffer(tokens.as_buffer(), np.int64), np.frombuffer(counts.as_buffer(), np.int64)
                often = counts >= least
                yield pa.RecordBatch.from_arrays([pa.array([tokens[often].tobytes()], pa.binary()), pa.array([counts[often].tobytes()], pa.binary())], names=["tokens", "counts"])

    # At most COMMON words can each have a share of 1 / COMMON.
    found = vocabulary.select("tokens", "counts").mapInArrow(common, "tokens binary, counts binary").collect()
    often = tuple(np.frombuffer(b"".join(bytes(r[c]) for r in found), kind) for c, kind in (("tokens", np.uint64), ("counts", np.int64)))
    classes = cluster_groups(neighbour_counts(counted))
    levels = min(LEVELS, max(1, int(np.ceil(np.log2(max(1, v / CLASSES))))))
    bits = min(WEIGHT_BITS[1], max(WEIGHT_BITS[0], int(np.ceil(np.log2(max(1, n / 2))))))
    model, tree = train(training, size, classes, group_tokens, group_words, WordTree.of(leaf_masses(vocabulary, classes, levels), bits))
    out = F.coalesce(remainder(F.col("key"), modulus) == held, F.lit(False)).alias("held_out")
    scored = materialize(score_parts(rows.select(F.struct("key", out).alias("row"), "text"), model, tree, often, buckets), "scored")
    rare = rare_sums(scored.filter("kind = 1").select("bucket", "texts", "tokens", "times", "gains"), vocabulary, buckets)
    rare = materialize(rare, "rare").withColumnsRenamed({"content": "c", "n_known": "rare_known", "counted": "rare_counted", "ranked": "rare_ranked"})
    whole = scored.filter("kind = 0").join(rare, F.col("content") == F.col("c"), "left")
    base = F.col("counted") + F.coalesce("rare_counted", F.lit(0.0))
    return whole.select(
        F.col("row.key").alias(key), F.col("row.held_out").alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (base - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (base + F.col("classed") + F.col("ranked") + F.coalesce("rare_ranked", F.lit(0.0))).alias("score"),
    )
