"""Sampled subword segmentations: forward filtering and backward sampling over the piece lattice."""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the piece model: the mark for a space, and how byte pieces are written.
SPACE_MARK, BYTE_PIECE = "▁", "<0x{:02X}>"
#: No piece holds a newline, and none holds a space after another character, so each
#: segmentation of a text is made of segmentations of these words.
WORD = re.compile(r" +[^ \n]*|[^ \n]+|\n")
KEPT_EDGES, KEPT_CHARS = 5_000_000, 64
BATCH_CHARS = 1 << 21


class Pieces:
    """The vocabulary as text, with a log probability for each piece. The model ranks pieces
    by when they were merged; by Zipf's law a piece of rank r has a probability in proportion to 1 / (r + 2)."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        norm = math.log(sum(1 / (r + 2) for r in range(n)))
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        self.bytes_of = [b""] * n
        self.ids: dict[str, int] = {}
        self.logp: dict[str, float] = {}
        for i in range(n):
            if model.is_byte(i) or special[i]:
                continue
            text = model.id_to_piece(i).replace(SPACE_MARK, " ")
            rank = min(max(-model.get_score(i), 0.0), n)
            self.ids[text], self.logp[text] = i, -alpha * (math.log(rank + 2) + norm)
            self.bytes_of[i] = text.encode()
        self.byte_ids = [model.piece_to_id(BYTE_PIECE.format(b)) for b in range(256)]
        for b, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([b])
        self.byte_logp = -alpha * (math.log(n + 2) + norm)
        self.longest = max(map(len, self.ids))
        self._trie()

    def _trie(self) -> None:
        """The vocabulary as sorted (state, character) keys with the state each leads to."""
        states: dict[str, int] = {"": 0}
        for piece in sorted(self.ids):
            for k in range(1, len(piece) + 1):
                states.setdefault(piece[:k], len(states))
        prefixes = sorted(((states[x[:-1]] << 21 | ord(x[-1]), n, x) for x, n in states.items() if x))
        self.keys = np.array([k for k, _, _ in prefixes], dtype=np.int64)
        self.state = np.array([n for _, n, _ in prefixes], dtype=np.int64)
        self.piece = np.array([self.ids.get(x, -1) for _, _, x in prefixes], dtype=np.int32)
        self.piece_logp = np.array([self.logp.get(x, 0.0) for _, _, x in prefixes])

    def matches(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        """(start, length, id, log probability) of all pieces in ``codes``, by length."""
        at, state = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64)
        for k in range(self.longest):
            inside = at + k < len(codes)
            at, state = at[inside], state[inside]
            want = state << 21 | codes[at + k]
            key = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            same = self.keys[key] == want
            at, key = at[same], key[same]
            if not len(at):
                return
            state, ids = self.state[key], self.piece[key]
            whole = ids >= 0
            yield at[whole], k + 1, ids[whole], self.piece_logp[key[whole]]

    def edges_into(self, word: str, end: int) -> Iterator[tuple[int, list[int], float]]:
        """(from, ids, log probability) of the pieces that end at ``end``; a character without a piece goes as bytes."""
        ids, logp = self.ids, self.logp
        for start in range(max(0, end - self.longest), end):
            piece = word[start:end]
            if piece in ids:
                yield start, [ids[piece]], logp[piece]
            elif start == end - 1:
                raw = piece.encode("utf-8", "surrogatepass")
                yield start, [self.byte_ids[b] for b in raw], self.byte_logp * len(raw)

    def edges(self, word: str) -> Iterator[tuple[int, int, list[int], float]]:
        """(from, to, ids, log probability) by end."""
        for end in range(1, len(word) + 1):
            for start, ids, logp in self.edges_into(word, end):
                yield start, end, ids, logp


def forward(word: str, pieces: Pieces) -> list[list[tuple[int, list[int], float]]]:
    """For each end: (from, ids, share) of the edges into it, the share being the
    probability that a segmentation of the prefix ends with this edge."""
    alpha = [0.0] + [-math.inf] * len(word)
    into: list[list] = [[] for _ in range(len(word) + 1)]
    done = 0
    for start, end, ids, logp in pieces.edges(word):
        if end != done:
            _settle(into, alpha, done)
            done = end
        into[end].append((start, ids, alpha[start] + logp))
    _settle(into, alpha, done)
    return into


def _settle(into: list[list], alpha: list[float], end: int) -> None:
    """Closes node ``end``: the sum over its edges, and each edge's share of it."""
    if not end:
        return
    top = max(x[2] for x in into[end])
    total = sum(math.exp(x[2] - top) for x in into[end])
    alpha[end] = top + math.log(total)
    into[end] = [(s, ids, math.exp(w - top) / total) for s, ids, w in into[end]]


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; turns counters into even random numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(seed: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    return (_mix(seed + np.asarray(step, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) * 2.0**-53


class Known(dict):
    """Last nodes of words. A word that is asked for and not known is noted, under a number below -1 until its lattice is there."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        if len(word) > KEPT_CHARS:
            return -1
        self.new.append(word)
        self[word] = number = -1 - len(self.new)
        return number


class Growing:
    """An array with room at its end, so that adding to it does not copy it each time."""

    def __init__(self, dtype: type) -> None:
        self._room, self.size = np.empty(1 << 16, dtype), 0

    def add(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self._room):
            room = np.empty(max(size, 2 * len(self._room)), self._room.dtype)
            room[: self.size] = self._room[: self.size]
            self._room = room
        self._room[self.size : size] = values
        self.size = size

    @property
    def values(self) -> np.ndarray:
        return self._room[: self.size]


class Sampler:
    """Draws a segmentation for each word of each text. Lattices of known words lie in flat
    arrays: a node's edges stand together, with cumulated shares. All words step back together: each looks
    through the few edges of its current node, one more at a time until its draw is reached."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._clear()

    def _clear(self) -> None:
        self.last = Known()
        self.nodes = 0
        self._cum, self._back, self._first_id, self._n_ids, self._starts = (Growing(t) for t in (np.float64, np.int32, np.int32, np.int32, np.int64))
        self.ids_of: list[list[int]] = []

    @property
    def cum(self) -> np.ndarray:
        return self._cum.values

    def _learn(self, words: list[str]) -> None:
        """Adds the lattices of ``words``, all filtered forward together, character by character."""
        if not words:
            return
        lens = np.array([len(w) for w in words])
        codes = np.frombuffer(("\n".join(words) + "\n").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        starts = np.cumsum(lens + 1) - lens - 1
        inside = np.ones(len(codes), dtype=bool)  # newlines between words are in no piece
        inside[starts + lens] = False
        node = np.where(inside, np.cumsum(inside) - 1, -1)
        level = (np.arange(len(codes)) - np.repeat(starts, lens + 1))[inside]
        before = np.concatenate([[-1], node[:-1]])
        target, back, ids, count, logp = [], [], [], [], []
        single = ~inside
        for at, length, found, weight in self.pieces.matches(codes):
            if length == 1:
                single[at] = True
            target.append(node[at + length - 1])
            back.append(before[at])
            ids.append(found)
            count.append(np.ones(len(at), dtype=np.int32))
            logp.append(weight)
        alone = np.flatnonzero(~single)
        for code in np.unique(codes[alone]).tolist():
            raw = [self.pieces.byte_ids[b] for b in chr(code).encode("utf-8", "surrogatepass")]
            own = alone[codes[alone] == code]
            target.append(node[own])
            back.append(before[own])
            ids.append(np.full(len(own), raw[0] if len(raw) == 1 else len(self.ids_of), dtype=np.int32))
            count.append(np.full(len(own), len(raw), dtype=np.int32))
            logp.append(np.full(len(own), self.pieces.byte_logp * len(raw)))
            if len(raw) > 1:
                self.ids_of.append(raw)
        target, back, ids, count, logp = (np.concatenate(x) for x in (target, back, ids, count, logp))
        order = np.lexsort((target, level[target]))
        target, back, ids, count, logp = (x[order] for x in (target, back, ids, count, logp))
        alpha, share = np.zeros(len(level) + 1), np.zeros(len(target))  # the last is a word's start
        cuts = np.searchsorted(level[target], np.arange(int(level.max()) + 2))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            into, weight = target[lo:hi], alpha[back[lo:hi]] + logp[lo:hi]
            first = np.flatnonzero(np.concatenate([[True], into[1:] != into[:-1]]))
            top, size = np.maximum.reduceat(weight, first), np.diff(np.append(first, hi - lo))
            part = np.exp(weight - np.repeat(top, size))
            total = np.add.reduceat(part, first)
            alpha[into[first]] = top + np.log(total)
            share[lo:hi] = part / np.repeat(total, size)
        order = np.argsort(target, kind="stable")
        target, back, ids, count, share = (x[order] for x in (target, back, ids, count, share))
        last = np.concatenate([target[1:] != target[:-1], [True]])
        summed = np.cumsum(share) - target  # the shares of each node add up to 1
        # the last share is above any draw, so no search runs into the next node
        cum = np.where(last, 2.0, np.clip(summed, 0.0, 1.0))
        self._starts.add(np.flatnonzero(np.concatenate([[True], last[:-1]])) + self._cum.size)
        for held, values in ((self._cum, cum), (self._back, np.where(back >= 0, back + self.nodes, -1)), (self._first_id, ids), (self._n_ids, count)):
            held.add(values)
        self.last.update(zip(words, (np.cumsum(lens) - 1 + self.nodes).tolist()))
        self.nodes += int(lens.sum())

    def encode(self, texts: list[str], seeds: list[int]) -> list[np.ndarray]:
        """Ids of each text. Every word's draws depend on its text's seed and its place only."""
        if self._cum.size > KEPT_EDGES:
            self._clear()
        words = [WORD.findall(t) for t in texts]
        n_words = np.array([len(ws) for ws in words])
        known = self.last
        node = np.fromiter(chain.from_iterable(map(known.__getitem__, ws) for ws in words), np.int64, int(n_words.sum()))
        if known.new:
            new, known.new = known.new, []
            self._learn(new)
            unknown = node < -1
            node[unknown] = np.array([known[w] for w in new], np.int64)[-2 - node[unknown]]
        long = [[] for _ in texts]
        text_of = np.repeat(np.arange(len(texts)), n_words)
        place = np.arange(len(text_of)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
        for i in np.flatnonzero(node < 0).tolist():
            long[text_of[i]].append(int(place[i]))
        seed = _mix(np.array(seeds, dtype=np.uint64)[text_of] + place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        word, edge, step = np.flatnonzero(node >= 0), [], 0
        at, of = node[word], []
        cum, back, starts_of = self._cum.values, self._back.values, self._starts.values
        while len(word):
            draw, found = _uniform(seed[word], step), starts_of[at]
            open_ = np.flatnonzero(cum[found] <= draw)
            while len(open_):
                found[open_] += 1
                open_ = open_[cum[found[open_]] <= draw[open_]]
            edge.append(found)
            of.append(word)
            at = back[found]
            go = at >= 0
            word, at, step = word[go], at[go], step + 1
        steps = np.bincount(np.concatenate(of), minlength=len(node)) if of else np.zeros(len(node), dtype=np.int64)
        ends = np.cumsum(steps)
        chosen = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        for k, (w, e) in enumerate(zip(of, edge)):
            chosen[ends[w] - 1 - k] = e
        ids, counts = self._first_id.values[chosen].astype(np.int64), self._n_ids.values[chosen]
        owner = np.repeat(np.arange(len(node)), steps)
        if (counts > 1).any():
            place_of = np.cumsum(counts) - counts
            out = np.repeat(ids, counts)
            for i in np.flatnonzero(counts > 1).tolist():
                out[place_of[i] : place_of[i] + counts[i]] = self.ids_of[ids[i]]
            ids, owner = out, np.repeat(owner, counts)
        bounds = np.searchsorted(text_of[owner], np.arange(len(texts) + 1)) if len(owner) else np.zeros(len(texts) + 1, dtype=int)
        result = [ids[bounds[t] : bounds[t + 1]] for t in range(len(texts))]
        starts = np.cumsum(n_words) - n_words
        for t, far in enumerate(long):
            if far:
                own = owner[bounds[t] : bounds[t + 1]] - starts[t]
                parts, done = [], 0
                for i in far:
                    upto = int(np.searchsorted(own, i))
                    parts += [result[t][done:upto], self._alone(words[t][i], seed[starts[t] + i])]
                    done = upto
                result[t] = np.concatenate([*parts, result[t][done:]])
        return result

    def _alone(self, word: str, seed: np.uint64) -> np.ndarray:
        """One long word: of its lattice the log sums are kept, a number per character, and the edges of a
        node are made again where the way back comes to it."""
        alpha = array("d", [0.0])
        into = self.pieces.edges_into
        for end in range(1, len(word) + 1):
            weights = [alpha[start] + logp for start, _, logp in into(word, end)]
            top = max(weights)
            alpha.append(top + math.log(sum([math.exp(w - top) for w in weights])))
        at, step, out, draws = len(word), 0, array("l"), np.zeros(0)
        while at:
            if step % 4096 == 0:
                draws = _uniform(np.full(4096, seed), np.arange(step, step + 4096))
            edges = list(into(word, at))
            weights = [alpha[start] + logp for start, _, logp in edges]
            top = max(weights)
            total = sum(math.exp(w - top) for w in weights)
            shares = np.cumsum([math.exp(w - top) / total for w in weights]).tolist()
            start, ids, _ = edges[min(bisect_right(shares, draws[step % 4096]), len(shares) - 1)]
            out.extend(reversed(ids))
            at, step = start, step + 1
        return np.array(out, dtype=np.int64)[::-1]


@cache
def sampler_of(model_path: str, alpha: float) -> Sampler:
    """One per worker process: its pieces and words serve the next task too."""
    return Sampler(Pieces(model_path, alpha))


def decode(ids: np.ndarray, pieces: Pieces) -> str:
    return b"".join(map(pieces.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")


def encode_rows(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", alpha: float = 1.0, seed: int = 42, with_ids: bool = True) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_pieces``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit), ``decoded_sha256``, ``lossless`` (whether decoding gives the text back) and, if asked for, ``ids``.

    The segmentation is drawn with probability in proportion to the product of its pieces'
    probabilities to the power ``alpha``: sums over all segmentations of each prefix run forward, and the
    pieces are drawn backward from the end. The draws come from ``seed`` and the row's id, so a
    row gets the same pieces whatever task, batch or attempt it is in. No space is put in front.

    A null text has no pieces and decodes to the empty text. A null id counts as the empty
    key. Repeated rows give repeated results; an empty table gives none; other columns are not read.
    """
    columns = ["id", "n_pieces", "ids_crc32", "decoded_sha256", "lossless"] + ["ids"] * with_ids

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import zlib

        sampler = sampler_of(model_path, alpha)
        pieces = sampler.pieces
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            lo = 0
            while lo < len(texts):
                hi, held = lo, 0
                while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= BATCH_CHARS):
                    held += len(texts[hi])
                    hi += 1
                keys = [xxhash.xxh64_intdigest("" if k is None else k, seed) for k in batch["id"].iloc[lo:hi]]
                rows = []
                for key, text, ids in zip(batch["id"].iloc[lo:hi], texts[lo:hi], sampler.encode(texts[lo:hi], keys)):
                    back = decode(ids, pieces)
                    packed = ids.astype("<u4")
                    rows.append((key, len(ids), zlib.crc32(packed.tobytes()), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == text, *([packed.astype("<i4")] if with_ids else [])))
                yield pd.DataFrame(rows, columns=columns)
                lo = hi

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = "id string, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean" + ", ids array<int>" * with_ids
    return rows.mapInPandas(sampled, schema).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
