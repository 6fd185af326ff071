"""Sums of the language model: sent by as many tasks as the text needs, equal to plain ones."""

import numpy as np
from pyspark.sql import functions as F

from tagloom.llm import lm_score


def test_sums_follow_the_text_and_not_its_partitions(spark, monkeypatch):
    seen, steps = [], []
    parts, total = lm_score.gradient_parts, lm_score.sum_arrays
    monkeypatch.setattr(lm_score, "gradient_parts", lambda texts, *more: seen.append(texts.rdd.getNumPartitions()) or parts(texts, *more))
    monkeypatch.setattr(lm_score, "sum_arrays", lambda rows, tasks, *more: steps.append(tasks) or total(rows, tasks, *more))
    docs = spark.range(0, 300, 1, 60).select(F.col("id").alias("doc_id"), F.concat(F.lit("a word and n"), F.col("id") % 7).alias("text"))
    one = {r.doc_id: r.score for r in lm_score.score_texts(docs).collect()}
    cores = spark.sparkContext.defaultParallelism
    assert seen == [cores] * lm_score.ROUNDS and steps[-1] == cores
    seen.clear()
    monkeypatch.setattr(lm_score, "GRADIENT_BYTES", 100)  # much text for one task: more tasks, sums in two steps
    two = {r.doc_id: r.score for r in lm_score.score_texts(docs).collect()}
    assert min(seen) > lm_score.ONE_STEP and one.keys() == two.keys()
    assert all(abs(one[k] - two[k]) < 1e-4 for k in one)


def test_neighbours_are_counted_with_the_words(spark):
    texts = ["bb aa bb", "aa", "", "aa bb aa bb"]
    counted = lm_score.count_words(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), 2)
    token, group, owner = lm_score.tokens_of(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)]))
    plain = np.zeros((lm_score.GROUPS, lm_score.GROUPS))
    for i in range(1, len(token)):
        plain[group[i - 1], group[i]] += owner[i - 1] == owner[i]
    assert (lm_score.neighbour_counts(counted) == plain).all() and plain.sum() == 8
    words = [np.frombuffer(r.counts, np.int64).sum() for r in counted.filter("bucket >= 0").collect()]
    assert sum(words) == len(token)


def test_class_sums_are_those_of_all_probabilities(monkeypatch):
    monkeypatch.setattr(lm_score, "CLASS_BLOCK", 16)
    rng = np.random.default_rng(4)
    n = lm_score.FEATURES * lm_score.BUCKETS
    model = lm_score.ClassModel(rng.normal(0, 1, (n, lm_score.CLASSES)).astype(np.float32), rng.normal(0, 1, lm_score.CLASSES).astype(np.float32), None, None)
    features = np.stack([rng.integers(0, lm_score.BUCKETS, 50) + j * lm_score.BUCKETS for j in range(lm_score.FEATURES)])
    z = model.bias + sum(model.weights[f].astype(float) for f in features)
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    target = rng.integers(0, lm_score.CLASSES, 50)
    assert np.allclose(model.log_targets(features, target), np.log(p[np.arange(50), target]), atol=1e-4)
    got, plain = np.zeros((lm_score.CLASSES, n)), np.zeros((n, lm_score.CLASSES))
    model.add_expected(features, got)
    for f in features:
        np.add.at(plain, f, p)
    assert np.allclose(got.T, plain, atol=1e-5)
