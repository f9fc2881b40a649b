import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import docs
from conftest import DATA
from edgeloom.llm import quality_pu as Q

TEXTS = ["Plain words, in a sentence.", None, "", "*** $$$ &&&", "x" * 3_000_000, "a\n" * 1000, "🙂é中"]


def test_held_out_ranking(spark):
    d = f"{DATA}/sf0.1"
    df, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.classify(df, labels).where("held_out").join(labels, "doc_id").select("score", "quality", "predicted").collect()
    good, bad = (np.array([r.score for r in got if r.quality == q]) for q in (1, 0))
    auc = (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean()
    assert auc > 0.97 and np.mean([r.predicted == r.quality for r in got]) > 0.95


def test_held_out_labels_are_not_seen(spark):
    d = f"{DATA}/sf0.01"
    df, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    held = Q.fold("doc_id", 5) == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in Q.classify(df, x).collect()} for x in (labels, other))
    assert a == b


def test_chunks_change_nothing(monkeypatch):
    whole = [Q.Features().of(t) for t in TEXTS]
    monkeypatch.setattr(Q, "CHUNK", 7)
    for a, t in zip(whole, TEXTS):
        if len(t or "") < 5000:
            assert np.allclose(Q.Features().of(t), a)


def test_risk_falls_below_that_of_the_prior():
    rng = np.random.default_rng(0)
    p, n = rng.normal(1.5, 1, (400, 5)), rng.normal(-1.5, 1, (100, 5))
    model = Q.fit(p[:200], np.concatenate([p, n]), 0.8)
    assert (model.score(p) > 0.5).mean() > 0.95 and (model.score(n) < 0.5).mean() > 0.9


def test_defined_cases(spark):
    df = docs(spark, [*TEXTS, (0, TEXTS[0]), (None, "x")]).withColumn("score", F.lit(1)).withColumn("x", F.lit(2))
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, 1, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    got = Q.classify(df, labels).collect()
    assert len(got) == len(TEXTS) + 2 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert {r.score for r in Q.classify(df, labels.limit(0)).collect()} == {0.5}
    assert Q.classify(df.limit(0), labels).collect() == []


def test_few_labels_all_teach(spark, monkeypatch):
    texts = [f"Sentence {i} has plain words, and it ends." if i % 2 else f"*** $$ {i} &&& ^^ ||" for i in range(4000)]
    df, n = docs(spark, texts), 120
    labels = spark.createDataFrame([(33 * i, i % 2) for i in range(n)], "doc_id long, quality int")  # of all documents alike
    seen, fit = [], Q.fit
    monkeypatch.setattr(Q, "fit", lambda p, u, prior: seen.append((len(p), len(u), prior)) or fit(p, u, prior))
    model = Q.learn(df, labels, train_rows=400)
    (positive, unlabelled, prior), x = seen[0], Q.Features()
    assert positive == n // 2 and 300 < unlabelled < 500 and abs(prior - 0.5) < 0.1
    assert model.score(np.stack([x.of(t) for t in texts[1000:1002]])).round().tolist() == [0, 1]
    many = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int")
    Q.learn(df, many, train_rows=400)
    assert 300 < seen[1][0] < 500 and abs(seen[1][2] - 0.5) < 0.1


@pytest.mark.parametrize("kept", ["all", "positives only", "nine to one", "one to nine"])
def test_labels_of_any_make_up(spark, kept):
    """Which labels there are changes the held-out errors little: the prior comes from the text."""
    d = f"{DATA}/sf0.1"
    df, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    few = F.pmod(F.xxhash64("doc_id"), F.lit(9)) == 0
    keep = {"all": F.lit(True), "positives only": F.col("quality") == 1, "nine to one": (F.col("quality") == 1) | few, "one to nine": (F.col("quality") == 0) | few}[kept]
    got = Q.classify(df, labels.where(keep | (Q.fold("doc_id", 5) == 0))).where("held_out").join(labels, "doc_id").select("score", "quality", "predicted").collect()
    wrong = [np.mean([r.predicted != r.quality for r in got if r.quality == q]) for q in (0, 1)]
    assert max(wrong) < 0.08, wrong  # of 120 negatives; 0.06 with the true share as prior


@pytest.mark.parametrize("prior", [0.1, 0.4, 0.8])
def test_prior_from_positives_and_unlabelled(prior):
    rng = np.random.default_rng(3)
    n = 6000
    p = rng.normal(1.2, 1, (2000, 6))
    u = np.concatenate([rng.normal(1.2, 1, (int(prior * n), 6)), rng.normal(-1.2, 1, (n - int(prior * n), 6))])
    assert abs(Q.estimate_prior(p, rng.permutation(u)) - prior) < 0.06
    assert Q.estimate_prior(p[:1], u) == 0.5


def plain_features(text):
    """The features, character by character."""
    text = text or ""
    kinds = []
    for c in text:
        k = Q.OTHER
        if ord(c) < 1 << 16:
            k = Q.FIRST_MARK + Q.MARKS.index(c) if c in Q.MARKS else Q.UPPER if c.isupper() else Q.LOWER if c.isalpha() else Q.DIGIT if c.isdigit() else Q.NEWLINE if c == "\n" else Q.SPACE if c.isspace() else Q.OTHER
        kinds.append(k)
    shares, shapes = [0.0] * Q.CLASSES, [0.0] * Q.SHAPES
    for k in kinds:
        shares[k] += 1
    for a, b, c in zip(kinds, kinds[1:], kinds[2:]):
        shapes[(((a * Q.CLASSES + b) * Q.CLASSES + c) * 2654435761 >> 7) % Q.SHAPES] += 1
    n, words, lines = max(1, len(text)), text.split(), [x for x in text.split("\n") if x.strip()]
    letters = max(1.0, shares[Q.LOWER] + shares[Q.UPPER])
    lengths = [len(w) for w in words]
    mean = sum(lengths) / len(lengths) if words else 0.0
    extra = [
        math.log1p(len(text)), shares[Q.UPPER] / letters, mean, math.sqrt(sum((x - mean) ** 2 for x in lengths) / len(lengths)) if words else 0.0,
        sum(x <= 2 for x in lengths) / max(1, len(words)), len(set(words)) / max(1, len(words)), len(set(lines)) / max(1, len(lines)),
        math.log1p(max(1, len(words)) / max(1, len(lines))), sum(not w[-1].isalnum() for w in words) / max(1, len(words)),
    ]
    return [math.sqrt(x / n) for x in shares] + [math.sqrt(x / n) for x in shapes] + extra


def test_features_as_counted_plainly():
    for text in [*TEXTS[:4], "A b, c!\n\n é中🙂 x_y-z 12 " * 5, "\t  \n"]:
        assert np.allclose(Q.Features().of(text), plain_features(text))


def test_risk_and_gradient_as_computed_plainly():
    rng = np.random.default_rng(5)
    p, u, w = rng.normal(1, 1, (7, 4)), rng.normal(0, 1, (9, 4)), rng.normal(0, 1, 4)
    loss = lambda z: math.log(1 + math.exp(-z))
    parts = lambda w: (
        sum(loss(x @ w) for x in p) / len(p), sum(loss(-(x @ w)) for x in p) / len(p), sum(loss(-(x @ w)) for x in u) / len(u)
    )
    assert np.allclose(Q.risk_parts(w, p, u), parts(w))
    for part, gradient in enumerate(Q.risk_gradients(w, p, u)):
        for i in range(4):
            step = np.eye(4)[i] * 1e-6
            assert abs((parts(w + step)[part] - parts(w - step)[part]) / 2e-6 - gradient[i]) < 1e-5
    # the model that is fitted has a lower risk than any of its neighbours
    p, n = rng.normal(1, 1, (300, 3)), rng.normal(-1, 1, (300, 3))
    u = np.concatenate([rng.normal(1, 1, (300, 3)), n])
    model = Q.fit(p, u, 0.5, steps=3000)
    mean, scale = model.mean, model.scale
    a, b = (np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))]) for x in (p, u))
    w = np.append(model.weights, model.bias)

    def risk(w):
        plus, minus_p, minus_u = Q.risk_parts(w, a, b)
        return 0.5 * plus + max(0, minus_u - 0.5 * minus_p) + 5e-4 * (w[:-1] ** 2).sum()

    assert all(risk(w) <= risk(w + s * 0.05 * np.eye(4)[i]) + 0.01 for i in range(4) for s in (1, -1))
