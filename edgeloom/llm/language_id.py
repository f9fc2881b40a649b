"""Language identification with hyperdimensional profiles of letter n-grams."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = 0
CHUNK = 1 << 18
GRAMS_AT_ONCE = 8192
DENSE_CODES = 1 << 22
UNKNOWN = "und"
TEXTS_AT_ONCE = 256
#: Texts that teach a language at least, if it has them.
LEAST_ROWS = 64
#: Texts whose n-grams are counted together, which bounds the table of counts.
TEXTS_AT_ONCE = 400


def letter_vector(code: int, dims: int, seed: int) -> np.ndarray:
    """The random vector of +1 and -1 that stands for one letter, the same everywhere."""
    return np.random.default_rng((seed, code)).integers(0, 2, dims, dtype=np.int8) * 2 - 1


class Profiler:
    """Turns texts into bundles. An n-gram's vector binds (multiplies) the vectors of its
    letters, each permuted (rolled) by its place from the end; a text's bundle is the sum over all its
    n-grams. Equal n-grams are counted first, so a bundle is counts times n-gram vectors."""

    def __init__(self, dims: int, gram: int, seed: int):
        self.dims, self.gram, self.seed = dims, gram, seed
        self.letters: dict[int, np.ndarray] = {SPACE: letter_vector(SPACE, dims, seed)}
        self.is_letter: dict[int, bool] = {}

    def symbols(self, texts: list[str]) -> np.ndarray:
        """Code points of the lower-cased texts: letters as they are, one space for each run
        of other characters and around each text, and -1 between texts."""
        texts = [t.lower() for t in texts]
        codes = np.frombuffer((" " + "   ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        seen = np.flatnonzero(np.bincount(codes))
        letters = [c for c in seen.tolist() if self._letter(c)]
        keep = np.full(int(seen[-1]) + 1, SPACE, dtype=np.int64)
        keep[letters] = letters
        codes = keep[codes]
        between = np.cumsum([len(t) + 3 for t in texts])[:-1] - 1
        codes[between] = -1
        return codes[np.concatenate([[True], (codes[1:] != SPACE) | (codes[:-1] != SPACE)])]

    def _letter(self, code: int) -> bool:
        if code not in self.is_letter:
            self.is_letter[code] = chr(code).isalpha()
        return self.is_letter[code]

    def bundles(self, texts: list[str | None]) -> np.ndarray:
        """One row per text; zeros for a text without letters. Long texts go in stretches
        that begin with the last letters of the one before; many texts go some at a time."""
        if len(texts) > TEXTS_AT_ONCE:
            return np.concatenate([self.bundles(texts[lo : lo + TEXTS_AT_ONCE]) for lo in range(0, len(texts), TEXTS_AT_ONCE)])
        rows, parts = [], []
        for number, text in enumerate(texts):
            for lo in range(0, len(text or ""), CHUNK):
                rows.append(number)
                parts.append(text[max(0, lo - self.gram + 1) : lo + CHUNK])
        out = np.zeros((len(texts), self.dims), dtype=np.float32)
        if not parts:
            return out
        flat = self.symbols(parts)
        text_of = np.cumsum(flat == -1)
        alphabet = np.flatnonzero(np.bincount(flat + 1)) - 1
        place = np.zeros(int(alphabet[-1]) + 2, dtype=np.int64)
        place[alphabet + 1] = np.arange(len(alphabet))
        k, n = len(alphabet), len(flat) - self.gram + 1
        if n < 1:
            return out
        code, whole, lettered = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool), np.zeros(n, dtype=bool)
        ranked = place[flat + 1]
        for i in range(self.gram):
            code = code * k + ranked[i : i + n]
            whole &= flat[i : i + n] != -1
            lettered |= flat[i : i + n] > SPACE
        whole &= lettered
        code, text_of = code[whole], text_of[:n][whole]
        if k**self.gram <= DENSE_CODES:
            found = np.flatnonzero(np.bincount(code, minlength=1))
            rank = np.zeros(k**self.gram, dtype=np.int64)
            rank[found] = np.arange(len(found))
            which = rank[code]
        else:
            found, which = np.unique(code, return_inverse=True)
        if not len(found):
            return out
        starts = np.searchsorted(text_of, np.arange(len(parts) + 1))
        counts = np.empty((len(parts), len(found)), dtype=np.float32)
        for lo in range(0, len(parts), 64):
            hi = min(lo + 64, len(parts))
            own = slice(starts[lo], starts[hi])
            some = np.bincount((text_of[own] - lo) * len(found) + which[own], minlength=(hi - lo) * len(found))
            counts[lo:hi] = some.reshape(hi - lo, len(found))
        for lo in range(0, len(found), GRAMS_AT_ONCE):
            some = slice(lo, lo + GRAMS_AT_ONCE)
            np.add.at(out, rows, counts[:, some] @ self._gram_vectors(alphabet, found[some], k))
        return out

    def _gram_vectors(self, alphabet: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
        codes = [max(c, SPACE) for c in alphabet.tolist()]  # no n-gram holds the mark between texts
        for c in codes:
            if c not in self.letters:
                self.letters[c] = letter_vector(c, self.dims, self.seed)
        table = np.stack([self.letters[c] for c in codes])
        bound = np.ones((len(found), self.dims), dtype=np.int8)
        for i in range(self.gram):  # the last letter is in place 0
            bound *= np.roll(table, i, axis=1)[(found // k**i) % k]
        return bound.astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows.astype(np.float64) ** 2).sum(1))
    return rows / np.where(norm > 0, norm, 1)[:, None]


def shares(sizes: dict[str, int], total: int, least: int = LEAST_ROWS) -> dict[str, float]:
    """The part of each language's texts that teaches: small languages whole, the others in equal
    numbers of what is left of ``total``, but of ``least`` texts at least."""
    out, left = {}, total
    for i, (lang, size) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        own = min(size, max(least, left // (len(sizes) - i)))
        out[lang] = own / size
        left -= min(own, left)
    return out


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dims: int = 1024, gram: int = 3, seed: int = 7, train_rows: int = 20_000) -> dict[str, np.ndarray]:
    """A prototype per language: the sum of the unit bundles of its texts, made a unit vector, from a
    bounded sample of about ``train_rows`` labelled texts, chosen by hash. Rare languages give all texts,
    the others equal numbers, at least ``LEAST_ROWS``; equal texts of a language teach once. Tasks send one sum per language,
    and the sums are added by language and dimension, so what reaches the driver is languages x dims numbers."""
    rows = labelled.where(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    rows = rows.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n"))
    share = shares({r.lang: max(1, r.n) for r in counted.collect()}, train_rows)
    cut = [(lang, int(x * (1 << 40))) for lang, x in share.items() if x < 1]
    if cut:
        below = labelled.sparkSession.createDataFrame(cut, "lang string, below long")
        drawn = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 40)) < F.coalesce("below", F.lit(1 << 40))
        rows = rows.join(F.broadcast(below), "lang", "left").where(drawn).select("lang", "text")
    rows = rows.distinct()

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        profiler, total = Profiler(dims, gram, seed), {}
        for batch in batches:
            for lo in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[lo : lo + TEXTS_AT_ONCE]
                bundles = _unit(profiler.bundles(part["text"].tolist()))
                for lang, at in part.reset_index(drop=True).groupby("lang").groups.items():
                    total[lang] = total.get(lang, 0) + bundles[at].sum(0)
        if total:
            yield pd.DataFrame({"lang": list(total), "bundle": [v.astype(float) for v in total.values()]})

    added = rows.mapInPandas(sums, "lang string, bundle array<double>").select("lang", F.posexplode("bundle").alias("d", "x"))
    profile = {}
    for r in added.groupBy("lang", "d").agg(F.sum("x").alias("x")).collect():
        profile.setdefault(r.lang, np.zeros(dims))[r.d] = r.x
    return {lang: v / (np.linalg.norm(v) or 1) for lang, v in sorted(profile.items())}


def guess(text: F.Column, prototypes: dict[str, np.ndarray], dims: int = 1024, gram: int = 3, seed: int = 7, sharpness: float = 24.0) -> F.Column:
    """A struct of ``lang_pred`` and ``score``: the language whose prototype has the largest
    cosine with the text's bundle (ties: first by name) and its share among all, by softmax of
    ``sharpness`` times the cosines. A text that is null or has no letter gets ``und`` and 0."""
    names = list(prototypes)
    table = np.stack([prototypes[n] for n in names]).T if names else np.zeros((dims, 0))

    @F.pandas_udf("lang_pred string, score double")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        profiler = Profiler(dims, gram, seed)
        for texts in batches:
            out = []
            for lo in range(0, len(texts), TEXTS_AT_ONCE):
                some = texts.iloc[lo : lo + TEXTS_AT_ONCE].tolist()
                if not names:
                    out += [(UNKNOWN, 0.0)] * len(some)
                    continue
                cosines = _unit(profiler.bundles(some)) @ table
                best = cosines.argmax(1)
                top = 1 / np.exp(sharpness * (cosines - cosines.max(1, keepdims=True))).sum(1)
                lettered = [any(map(str.isalpha, t or "")) for t in some]
                out += [(names[b], float(p)) if ok else (UNKNOWN, 0.0) for b, p, ok in zip(best, top, lettered)]
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    return language(text.cast("string"))


def fold(id_col: str = "doc_id", parts: int = 4) -> F.Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """One row per row of ``docs``: the id, ``held_out``, ``lang_pred`` and ``score``.
    Rows with crc32(id) mod 4 = 2 are held out; the others teach, those with null text or
    language excepted. Without any of these, all predictions are ``und``. An empty table
    gives no rows; repeated rows repeated results; other columns are not read."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    held = fold("id") == 2
    prototypes = learn(rows.where(~held), "text", "lang", **options)
    own = {k: v for k, v in options.items() if k != "train_rows"}
    answer = rows.select("id", held.alias("held_out"), guess(F.col("text"), prototypes, **own).alias("guess"))
    return answer.select(F.col("id").alias(id_col), "held_out", "guess.lang_pred", "guess.score")


def lettered(text: F.Column) -> F.Column:
    """Whether a text has a letter; null texts have none."""

    @F.pandas_udf("boolean")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([any(map(str.isalpha, t or "")) for t in texts], dtype=bool)

    return found(text.cast("string"))


def drop_unidentified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = 0.0, **options) -> DataFrame:
    """``docs`` without the rows that are rejected: those predicted ``und`` or with a score
    below ``min_score``. Prototypes come from the rows that ``identify`` learns from. Where these
    teach no language, only null texts and texts without a letter are rejected."""
    prototypes = learn(docs.where(fold(id_col) != 2), text_col, lang_col, **options)
    if not prototypes:
        return docs.where(lettered(F.col(f"`{text_col}`")))
    own = {k: v for k, v in options.items() if k != "train_rows"}
    name = f"guess_{uuid.uuid4().hex[:8]}"
    guessed = docs.withColumn(name, guess(F.col(f"`{text_col}`"), prototypes, **own))
    return guessed.where((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= min_score)).drop(name)
