"""Text quality learned from positive and unlabelled documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.language_id import fold

SHAPES = 256
CHUNK = 1 << 20
#: The characters with a class of their own.
MARKS = ".,;:!?#$%&*|@/\\()[]{}<>=+-_\"'~^`"
LOWER, UPPER, DIGIT, SPACE, NEWLINE, OTHER, FIRST_MARK = 0, 1, 2, 3, 4, 5, 6
CLASSES = FIRST_MARK + len(MARKS)


def _classes() -> np.ndarray:
    table = np.full(1 << 16, OTHER, dtype=np.int64)
    for c in range(1 << 16):
        x = chr(c)
        table[c] = UPPER if x.isupper() else LOWER if x.isalpha() else DIGIT if x.isdigit() else NEWLINE if x == "\n" else SPACE if x.isspace() else OTHER
    table[[ord(m) for m in MARKS]] = np.arange(FIRST_MARK, CLASSES)
    return table


class Features:
    """Numbers that describe a whole text: shares of character classes, frequencies of
    class trigrams (hashed), and how words and lines repeat. No label, language, source or id is among them."""

    def __init__(self) -> None:
        self.table = _classes()
        self.bucket = (np.arange(CLASSES**3) * 2654435761 >> 7) % SHAPES

    def of(self, text: str | None) -> np.ndarray:
        text = text or ""
        shares, shapes = np.zeros(CLASSES), np.zeros(SHAPES)
        for lo in range(0, len(text), CHUNK):
            codes = np.frombuffer(text[max(lo - 2, 0) : lo + CHUNK].encode("utf-32-le", "surrogatepass"), dtype="<u4")
            kind = np.where(codes < 1 << 16, self.table[codes & 0xFFFF], OTHER)
            shares += np.bincount(kind[min(lo, 2) :], minlength=CLASSES)
            if len(kind) > 2:
                grams = np.bincount((kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:], minlength=CLASSES**3)
                shapes += np.bincount(self.bucket, weights=grams, minlength=SHAPES)
        n = max(1, len(text))
        letters = max(1.0, shares[LOWER] + shares[UPPER])
        words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
        n_words, n_lines = max(1, len(words)), max(1, len(lines))
        length = np.fromiter(map(len, words), dtype=float, count=len(words))
        extra = [
            np.log1p(len(text)),
            shares[UPPER] / letters,
            length.mean() if len(words) else 0.0,
            length.std() if len(words) else 0.0,
            float((length <= 2).sum()) / n_words,
            len(set(words)) / n_words,
            len(set(lines)) / n_lines,
            np.log1p(n_words / n_lines),
            sum(not w[-1].isalnum() for w in words) / n_words,
        ]
        return np.concatenate([np.sqrt(shares / n), np.sqrt(shapes / n), extra])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _standard(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scale of each feature over both samples."""
    n = len(positive) + len(unlabelled)
    mean = (positive.sum(0, dtype=float) + unlabelled.sum(0, dtype=float)) / n
    spread = sum(((x - mean) ** 2).sum(0, dtype=float) for x in (positive, unlabelled)) / n
    return mean, np.sqrt(spread) + 1e-3


def _with_bias(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), x.shape[1] + 1), np.float32)
    out[:, :-1] = np.clip((x - mean) / scale, -8, 8)
    return out


def _descend(gradient, begin: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Steps of Adam down ``gradient``."""
    w, first, second = begin, np.zeros_like(begin), np.zeros_like(begin)
    for step in range(1, steps + 1):
        grad = gradient(w)
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def _linear(w: np.ndarray, p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return p @ w.astype(p.dtype), u @ w.astype(u.dtype)


def _parts(zp: np.ndarray, zu: np.ndarray) -> tuple[float, float, float]:
    return tuple(float(np.logaddexp(0, z).mean(dtype=float)) for z in (-zp, zp, zu))


def _gradients(zp: np.ndarray, zu: np.ndarray, p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple((x.T @ g).astype(float) / len(x) for x, g in ((p, -_sigmoid(-zp)), (p, _sigmoid(zp)), (u, _sigmoid(zu))))


def risk_parts(w: np.ndarray, p: np.ndarray, u: np.ndarray) -> tuple[float, float, float]:
    """R+ and R- of the positives and R- of the unlabelled: mean logistic losses of a linear model."""
    return _parts(*_linear(w, p, u))


def risk_gradients(w: np.ndarray, p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gradients of the three parts."""
    return _gradients(*_linear(w, p, u), p, u)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-3) -> Model:
    """Minimises the non-negative unbiased risk of a logistic model,

        prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)),

    with R+ and R- the mean logistic losses as positive and as negative. While the bracket
    is below zero the model has overfitted the negatives, and a step goes up it instead of down."""
    mean, scale = _standard(positive, unlabelled)
    p, u = (_with_bias(x, mean, scale) for x in (positive, unlabelled))

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = _linear(w, p, u)
        (up, down_p, down_u), (_, on_p, on_u) = _gradients(zp, zu, p, u), _parts(zp, zu)
        grad = prior * up + (down_u - prior * down_p) if on_u - prior * on_p >= 0 else prior * down_p - down_u
        return grad + decay * np.append(w[:-1], 0)

    w = _descend(gradient, np.append(np.zeros(p.shape[1] - 1), np.log(prior / (1 - prior))), steps, rate)
    return Model(mean, scale, w[:-1], float(w[-1]))


def contrast(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 200, rate: float = 0.05, decay: float = 1e-3) -> Model:
    """A plain logistic model that tells positives from unlabelled text, both weighing the same."""
    mean, scale = _standard(positive, unlabelled)
    p, u = (_with_bias(x, mean, scale) for x in (positive, unlabelled))

    def gradient(w: np.ndarray) -> np.ndarray:
        up, _, down_u = risk_gradients(w, p, u)
        return (up + down_u) / 2 + decay * np.append(w[:-1], 0)

    w = _descend(gradient, np.zeros(p.shape[1]), steps, rate)
    return Model(mean, scale, w[:-1], float(w[-1]))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """The share of positives in the unlabelled text, from these two samples alone: no negative label is looked at.

    Above any threshold of a score, at least (prior x share of positives above it) of the unlabelled text lies. Where hardly
    a negative scores as high, the ratio of the two shares is the prior, so the least ratio estimates it. Thresholds with few
    positives above them make chance ratios: a term for the sampling error at ``confidence`` is added when the threshold is chosen. Each half of
    the samples is scored by a model of the other half."""
    scored: tuple[list, list] = ([], [])
    if min(len(positive), len(unlabelled)) < 4:
        return 0.5
    for half in (0, 1):
        model = contrast(positive[half::2], unlabelled[half::2])
        for out, rows in zip(scored, (positive, unlabelled)):
            out.append(model.score(rows[1 - half :: 2]))
    p, u = (np.sort(np.concatenate(x)) for x in scored)
    grid = np.unique(p)
    above_p, above_u = (1 - np.searchsorted(x, grid, side="left") / len(x) for x in (p, u))
    error = sum(np.sqrt(np.log(4 / confidence) / (2 * len(x))) for x in (p, u))
    best = int(np.argmin((above_u + error) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 1 / (len(u) + 2), 1 - 1 / (len(u) + 2)))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = 20_000, seed: int = 11) -> Model | None:
    """A model from two bounded samples, each of about ``train_rows`` documents chosen by hash: the
    trusted positives from all documents labelled 1, and the unlabelled text from all documents, labels unseen.
    The class prior is estimated from these two samples (``estimate_prior``); labels other than 1 teach nothing. None without positives."""
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text")).where("key is not null")

    def drawn(table: DataFrame, n: int, salt: int) -> DataFrame:
        share = min(1.0, train_rows / max(1, n))
        return table if share == 1 else table.where(F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(1 << 40)) < int(share * (1 << 40)))

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "x": [features.of(t).astype("<f4").tobytes() for t in batch["text"]]})

    def collected(sample: DataFrame) -> np.ndarray:
        got = sample.mapInPandas(described, "key string, x binary").orderBy("key", "x").select("x").collect()
        return np.stack([np.frombuffer(r.x, dtype="<f4") for r in got]) if got else np.zeros((0, CLASSES + SHAPES + 9), np.float32)

    marked = labels.select(F.col(f"`{id_col}`").cast("string").alias("key"), F.col(f"`{label_col}`").alias("y")).where("y is not null")
    marked = rows.select("key").join(marked.groupBy("key").agg(F.max("y").alias("y")), "key")
    n_positive = marked.where("y = 1").count()
    if not n_positive:
        return None
    trusted = drawn(marked.where("y = 1").select("key").distinct(), n_positive, seed + 1)
    positive = collected(rows.join(F.broadcast(trusted), "key", "left_semi"))
    unlabelled = collected(drawn(rows, docs.count(), seed))
    if not len(positive) or not len(unlabelled):
        return None
    return fit(positive, unlabelled, estimate_prior(positive, unlabelled))


def scores(text: Column, model: Model | None) -> Column:
    """The score of each text as a column; 0.5 without a model."""

    @F.pandas_udf("double")
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for texts in batches:
            out = []
            for lo in range(0, len(texts), 256):
                some = texts.iloc[lo : lo + 256]
                out.append(np.full(len(some), 0.5) if model is None else model.score(np.stack([features.of(t) for t in some])))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return quality(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3, **options) -> DataFrame:
    """One row per row of ``docs``: the id, ``held_out`` (crc32(id) mod 5 = 0), ``score`` and
    ``predicted``. Only rows that are not held out teach. Null texts count as empty, which
    have a score like any other; a null id teaches nothing; of labels repeated for an id the
    largest counts. Without a positive example every score is 0.5. An empty table gives no rows."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    held = fold("id", 5) == 0
    lab = labels.select(F.col(f"`{id_col}`"), F.col(f"`{label_col}`")).where(fold(id_col, 5) != 0)
    model = learn(rows.where(~held).withColumnRenamed("id", id_col), lab, id_col, "text", label_col, **options)
    out = rows.select(F.col("id").alias(id_col), held.alias("held_out"), scores(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
