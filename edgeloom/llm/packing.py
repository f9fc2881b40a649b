"""Packing of tokenized documents by first-fit decreasing over a tournament tree."""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.storage import staged

CACHE_WORDS, CACHE_TOKENS, CACHE_CHARS = 200_000, 300_000, 48
BIN_BITS = 24
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
#: The vocabulary's word pattern for Latin-1 text, and characters of that
#: range on which notions of white space differ.
LETTERS, NUMBERS = "a-zA-Zªµº\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "0-9²³¹¼½¾"
LATIN_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")
ODD = re.compile("[\x1c-\x1f\x85\xa0]")


class Remembered:
    """What a function gave for short texts. Those not met since ``most`` new ones are forgotten."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most, self.known, self.older = make, most, {}, {}

    def of(self, texts: list[str]) -> list[bytes]:
        found = list(map(self.known.get, texts))
        if None in found:
            for i, text in enumerate(texts):
                if found[i] is None:
                    found[i] = self.known.get(text) or self._new(text)
        return found

    def _new(self, text: str) -> bytes:
        value = self.older.get(text)
        if value is None:
            value = self.make(text)
        if len(text) <= CACHE_CHARS:
            if len(self.known) >= self.most:
                self.known, self.older = {}, self.known
            self.known[text] = value
        return value


class WordTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    The vocabulary drops white space and joins no tokens across the words that its pattern
    cuts a lower-cased text into. So texts are split at white space, what lies between is
    cut into words, words are encoded, and both are remembered. Texts beyond Latin-1, and those with
    special tokens or characters whose class is in doubt, are cut at spaces only and go through
    the whole tokenizer. Either way the ids are the tokenizer's own for the whole text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bytes_as = {c: "".join(_byte_letters()[b] for b in chr(c).encode()) for c in range(256)}
        self.words = Remembered(self._word, CACHE_WORDS)
        self.tokens = Remembered(lambda text: b"".join(self.words.of(LATIN_WORD.findall(text))), CACHE_TOKENS)
        self.others = Remembered(lambda text: _packed(self.tokenizer.encode(text, add_special_tokens=False).ids), CACHE_WORDS)

    def _word(self, word: str) -> bytes:
        return _packed([t.id for t in self.tokenizer.model.tokenize(word.translate(self.bytes_as))])

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        for text in texts:
            text = text or ""
            if _plain(text):
                yield b"".join(self.tokens.of(text.lower().split()))
            else:
                yield b"".join(self.others.of(text.replace("\n", " ").split(" ")))


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if LITTLE else np.array(ids, dtype="<u4").tobytes()


def _plain(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "<|" not in text and not ODD.search(text)


@cache
def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it prints, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letter[b] for b in range(256)]


@cache
def tokenizer_of(path: str) -> WordTokenizer:
    """One per worker process: its words serve the next task too."""
    return WordTokenizer(path)


class Tournament:
    """Free room of bins as leaves of a tree whose nodes hold the most of what is below."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.most = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """The first bin with room for ``length``, and the room it had."""
        most, at = self.most, 1
        while at < self.leaves:
            at = 2 * at if most[2 * at] >= length else 2 * at + 1
        found, room = at - self.leaves, most[at]
        most[at] = room - length
        while at > 1:
            at >>= 1
            most[at] = max(most[2 * at], most[2 * at + 1])
        return found, room


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest piece first, each into the first bin with room."""
    tree, bins = Tournament(len(lengths), capacity), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        found, _ = tree.place(int(lengths[i]))
        if found == len(bins):
            bins.append([])
        bins[found].append(i)
    return bins


def sequences(lengths: np.ndarray, capacity: int, slack: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (piece, from, length). A bin with more than ``slack`` unused tokens, as
    the last ones are, is cut into lengths that are powers of two and need no padding."""
    for members in first_fit_decreasing(lengths, capacity):
        parts = [(i, 0, int(lengths[i])) for i in members]
        fill = sum(n for _, _, n in parts)
        if capacity - fill <= slack:
            yield parts
            continue
        while fill:
            room, own = 1 << (fill.bit_length() - 1), []
            fill -= room
            while room:
                i, start, n = parts.pop(0)
                take = min(n, room)
                own.append((i, start, take))
                room -= take
                if take < n:
                    parts.insert(0, (i, start + take, n - take))
            yield own


def pieces_of(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """Each document's ids, its end id last, cut every ``capacity`` tokens: id, start,
    length, ids, doc_tokens."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer, end = tokenizer_of(tokenizer_path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows, held = [], 0
            for ident, ids in zip(batch["id"], tokenizer.encode(batch["text"].tolist())):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((ident, start, len(part) // 4, part, total))
                    held += len(part)
                    if held > 16 << 20:
                        yield pd.DataFrame(rows, columns=["id", "start", "length", "ids", "doc_tokens"])
                        rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=["id", "start", "length", "ids", "doc_tokens"])

    own = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return own.mapInPandas(cut, "id string, start long, length long, ids binary, doc_tokens long")


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 1,
    group_pieces: int = 4096, slack: int = 128, seed: int = 42,
) -> DataFrame:
    """One row per piece of a document: the id, ``start`` (the document's ids before it),
    ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and
    ``offset`` in that sequence; a sequence has no gaps and at most ``capacity`` tokens.

    Texts are tokenized once, in one pass, and cut every ``capacity`` tokens; these pieces are
    written out with a random number each. Whole ones are sequences already. The remainders,
    one per document, are dealt by that number into groups of some ``group_pieces``,
    whatever their documents or sources, and each group is packed on its own: a task holds
    one group, and its waste is a few of the last bins. Bins that stay emptier than ``slack`` are cut
    to powers of two, which are not padded.

    A null or empty text has the end id alone. Repeated rows and repeated ids are packed like
    others (a null id stays null); an empty table gives no rows; other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = pieces_of(docs, tokenizer_path, id_col, text_col, capacity, end_id)
    rows = staged(rows.withColumns({"draw": F.rand(seed), "number": F.monotonically_increasing_id()}), "pieces")
    whole = rows.where(F.col("length") == capacity)
    rest = rows.where(F.col("length") < capacity)
    groups = max(1, round(rest.count() / group_pieces))
    rest = rest.withColumn("group", F.floor(F.col("draw") * groups))

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("number")
        first, ids, starts, totals = int(group["group"].iloc[0]) << BIN_BITS, group["ids"].tolist(), group["start"].tolist(), group["doc_tokens"].tolist()
        names, out = group["id"].tolist(), []
        for s, parts in enumerate(sequences(group["length"].to_numpy(), capacity, slack)):
            offset = 0
            for i, skip, n in parts:
                out.append((names[i], starts[i] + skip, n, ids[i][4 * skip : 4 * (skip + n)], totals[i], (first + s) * 2, offset))
                offset += n
        return pd.DataFrame(out, columns=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    schema = "id string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    dealt = rest.groupBy("group").applyInPandas(packed, schema)
    alone = whole.select("id", "start", "length", "ids", "doc_tokens", (F.col("number") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return dealt.union(alone).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
