"""Collocations: phrases whose words stand together far more often than apart, counted over the whole corpus.

Phrases that are frequent are found first, by Misra-Gries summaries of their hashes, and
only these are then counted by their words, exactly. Documents are read once per step and never shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgeloom.llm.storage import staged
from edgeloom.operators.skew import join_split_hot

#: A-Z become a-z; these end a piece; space and tab end a word.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + PIECE_ENDS + b"\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(PIECE_ENDS) + b" "
)
_CUT = re.compile(rb"[ \n]")
#: Word occurrences that a task counts together, bytes of a text that it splits at once.
BLOCK, SLICE = 1_000_000, 1 << 19
#: Counters of one summary, about, when the partitions of the hashes are numbered.
COUNTERS = 1_000_000
#: The filters' bits are put together in so many parts.
PARTS = 256
LANG = "_lang"
Emit = Callable[["Block"], Iterator[pd.DataFrame]]


class Block:
    """Words of a stretch of documents as numbers. ``ids`` holds 0 between pieces; the first ``fresh`` places were
    counted with the stretch before and only begin phrases that reach into this one."""

    def __init__(self, carry: list[tuple[str, bytes] | None]) -> None:
        number = count(1)
        self._known: dict[str, dict[bytes, int]] = defaultdict(lambda: defaultdict(number.__next__))
        self._rows = [np.array([0 if w is None else self._known[w[0]][w[1]] for w in carry], np.int32)]
        self.fresh, self.size = len(carry), 0

    def add(self, lang: str, data: bytes) -> None:
        known = self._known[lang]
        known[b"\n"] = 0
        words = data.replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter((known[w] for w in words if w), np.int32)
        self._rows.append(ids)
        self.size += len(ids)

    def close(self) -> None:
        """Numbers of all places, and the language, text and hash of each word."""
        self.ids = np.concatenate(self._rows)
        self._rows.clear()
        n = 1 + max((i for known in self._known.values() for i in known.values()), default=0)
        self.langs, self.words, self.hashes = [""] * n, [b""] * n, np.zeros(n, np.uint64)
        for lang, known in self._known.items():
            prefix = lang.encode() + b"\n"
            for word, i in known.items():
                if i:
                    self.langs[i], self.words[i] = lang, word
                    self.hashes[i] = xxhash.xxh64_intdigest(prefix + word, 42)

    def tail(self, n: int) -> list[tuple[str, bytes] | None]:
        return [(self.langs[i], self.words[i]) if i else None for i in (self.ids[-n:] if n else [])]

    def grams(self, longest: int, known_words: np.ndarray, filters: dict[int, np.ndarray]) -> Iterator[tuple]:
        """For 2 to ``longest`` words: the distinct phrases that may be frequent, as (k, number of the phrase without its
        last word among those of k-1, last word, hash, occurrences). A phrase is asked for only
        where both phrases of one word less at its place are left, so none with a rare part is made."""
        usable = holds(known_words, self.hashes) & (np.arange(len(self.hashes)) > 0)
        alive, number, hashes, width = usable[self.ids], self.ids, self.hashes, len(self.hashes)
        for k in range(2, longest + 1):
            both = np.zeros(len(self.ids), bool)
            both[:-1] = alive[:-1] & alive[1:]
            at = np.flatnonzero(both)
            at = at[at + k <= len(self.ids)]
            key, place = np.unique(number[at].astype(np.int64) * width + self.ids[at + k - 1], return_inverse=True)
            previous, last = key // width, key % width
            hashes = mixed(hashes[previous], self.hashes[last])
            n = np.bincount(place[at + k - 1 >= self.fresh], minlength=len(key))
            keep = holds(filters[k], hashes) if k in filters else np.ones(len(key), bool)
            alive = np.zeros(len(self.ids), bool)
            alive[at] = keep[place]
            number = np.zeros(len(self.ids), np.int32)
            number[at] = place
            del place, key, at, both
            yield k, previous, last, hashes, np.where(keep, n, 0)


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of a phrase from that of its beginning and that of its last word."""
    z = left * np.uint64(0x9E3779B97F4A7C15) + right
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter's bit of each hash is set: its leading digits say which."""
    slot = hashes >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
    return ((bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def over_blocks(texts: DataFrame, longest: int, emit: Emit, schema: str, blocks: int = 1) -> DataFrame:
    """``emit`` over all words of ``texts`` (language, text), in blocks of bounded size. A text that goes on over blocks
    hands its last words on, so each phrase is counted once, in the block that holds its last word. ``blocks`` is how
    many of the usual size make one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Block([])
        for batch in batches:
            for lang, text in zip(batch[LANG], batch["_text"]):
                data = text.encode().translate(_TABLE) + b"\n"
                begin = 0
                while begin < len(data):
                    cut = _CUT.search(data, begin + SLICE)
                    end = cut.end() if cut else len(data)
                    # the delimiter goes with the slice; a space that is lost there ends a word all the same
                    block.add(lang, data[begin:end])
                    begin = end
                    if block.size >= blocks * BLOCK:
                        block.close()
                        yield from filter(len, emit(block))
                        block = Block(block.tail(longest - 1))
        block.close()
        yield from filter(len, emit(block))

    return texts.mapInPandas(run, schema)


def _filter(spark: SparkSession, hashes: DataFrame, bits: int) -> Broadcast:
    """A filter of ``2 ** bits`` bits for the column of hashes, put together by the executors. Its size is fixed,
    whatever the number of hashes: more of them only let more through, none is lost."""
    size = (1 << bits) // 8 // PARTS

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(size, np.uint8))
        for batch in batches:
            slot = batch["hash"].to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            part = (slot // np.uint64(size * 8)).astype(np.int64)
            for p in np.unique(part):
                inside = slot[part == p] % np.uint64(size * 8)
                np.bitwise_or.at(held[int(p)], inside >> np.uint64(3), np.uint8(1) << (inside & np.uint64(7)).astype(np.uint8))
        for p, b in held.items():
            yield pd.DataFrame({"part": [p], "bytes": [b.tobytes()]})

    part = F.shiftrightunsigned(F.col("hash"), 64 - PARTS.bit_length() + 1)
    whole = np.zeros((PARTS, size), np.uint8)
    for row in hashes.repartition(part).mapInPandas(parts, "part long, bytes binary").collect():
        whole[row["part"]] = np.frombuffer(row["bytes"], np.uint8)
    return spark.sparkContext.broadcast(whole.ravel())


# -- step 1: words -------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(language, word, occurrences) of all words."""

    def emit(block: Block) -> Iterator[pd.DataFrame]:
        n = np.bincount(block.ids[block.fresh :], minlength=len(block.words))
        n[0] = 0
        at = np.flatnonzero(n)
        yield pd.DataFrame({LANG: [block.langs[i] for i in at], "phrase": [block.words[i].decode() for i in at], "n": n[at]})

    each = over_blocks(texts, 1, emit, f"{LANG} string, phrase string, n long", blocks=4)
    return each.groupBy(LANG, "phrase").agg(F.sum("n").alias("f"))


# -- step 2: phrases that may be frequent ---------------------------------------------------


def part_of(hashes: np.ndarray, partitions: int) -> np.ndarray:
    """Which of the partitions, equal ranges of hashes in order, each hash is in."""
    return ((hashes >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)).astype(np.int64)


def packed(hashes: np.ndarray) -> bytes:
    """The leading 48 bits of each hash, all first bytes, then all second ones and so on: in order, the first compress well."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(6, -1).T
    return out.reshape(-1).view(">u8").astype(np.uint64)


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of places where no column changes."""
    if not len(columns[0]):
        return []
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(new).tolist()
    return list(zip(starts, [*starts[1:], len(new)]))


SUMMARY = "partition long, mass long, hashes binary, counts binary"


def summaries(texts: DataFrame, lengths: range, partitions: int, words: Broadcast, filters: dict[int, Broadcast]) -> DataFrame:
    """Hashes and counts of each block's phrases, a row per partition of the hashes and block, and as many rows with the mass
    alone. A block's distinct phrases are few enough to be all kept. Of the hashes 48 bits count: where two phrases
    share them, one more may survive."""

    def emit(block: Block) -> Iterator[pd.DataFrame]:
        found = [(h[n > 0], n[n > 0]) for k, _, _, h, n in block.grams(lengths[-1], words.value, {k: f.value for k, f in filters.items()}) if k in lengths]
        hashes, counts = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order].astype(np.uint32)
        partition = part_of(hashes, partitions)
        runs = _runs(partition)
        mass = [int(counts[a:b].sum(dtype=np.int64)) for a, b in runs]
        yield pd.DataFrame({"partition": [partition[a] for a, _ in runs], "mass": mass, "hashes": None, "counts": None})
        yield pd.DataFrame(
            {
                "partition": [partition[a] for a, _ in runs], "mass": 0,
                "hashes": [packed(hashes[a:b]) for a, b in runs], "counts": [counts[a:b].tobytes() for a, b in runs],
            }
        )

    return over_blocks(texts, lengths[-1], emit, SUMMARY)


def merge(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Summaries laid end to end as one of at most ``capacity`` counters, and what was taken from each counter.

    Equal keys add up; where more are left, the largest count that has no room is taken from
    all. Each time at least ``capacity + 1`` times that much mass goes, so over any number of merges no key
    loses more than mass / (capacity + 1), whatever the order in which summaries meet."""
    if not len(keys):
        return keys, counts, 0
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, counts = keys[starts], np.add.reduceat(counts, starts)
    if len(keys) <= capacity:
        return keys, counts, 0
    taken = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    left = counts > taken
    return keys[left], counts[left] - taken, taken


class Survivors:
    """One partition's summary while its rows come in: the mass first, then the summaries to merge."""

    def __init__(self, partition: int, least: int) -> None:
        self.partition, self.least, self.mass, self.taken, self.waiting = partition, least, 0, 0, 0
        self.keys, self.counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

    def add(self, hashes: bytes, counts: bytes) -> None:
        self.keys.append(unpacked(hashes))
        self.counts.append(np.frombuffer(counts, np.uint32).astype(np.int64))
        self.waiting += len(self.keys[-1])
        if self.waiting > max(COUNTERS, 2 * self.capacity):
            self._settle()

    @property
    def capacity(self) -> int:
        return self.mass // self.least + 1

    def _settle(self) -> None:
        keys, counts, off = merge(np.concatenate(self.keys), np.concatenate(self.counts), self.capacity)
        self.keys, self.counts, self.taken, self.waiting = [keys], [counts], self.taken + off, 0

    def rows(self, partitions: int, bits: int) -> pd.DataFrame:
        """The hashes that may occur often enough, and their bits of the filter from byte ``first`` on."""
        self._settle()
        hashes = self.keys[0][self.counts[0] + self.taken >= self.least]
        if not len(hashes):
            return pd.DataFrame()
        slot = hashes >> np.uint64(64 - bits)
        first = int(slot[0]) // 8
        part = np.zeros(int(slot[-1]) // 8 - first + 1, np.uint8)
        np.bitwise_or.at(part, (slot >> np.uint64(3)).astype(np.int64) - first, np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8))
        return pd.DataFrame({"partition": [self.partition], "hashes": [packed(hashes)], "first": [first], "bits": [part.tobytes()]})


def frequent_hashes(rows: DataFrame, partitions: int, least: int, bits: int) -> DataFrame:
    """Hashes that may occur ``least`` times, a row per partition: its summaries merged, with more counters than the
    partition's mass divided by ``least``, so that less than ``least`` is taken from any."""
    # a partition's mass comes before its summaries
    rows = rows.repartition(partitions, "partition").sortWithinPartitions("partition", F.col("hashes").isNotNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = None
        for batch in batches:
            for partition, mass, hashes, counts in zip(batch["partition"], batch["mass"], batch["hashes"], batch["counts"]):
                if one is None or one.partition != partition:
                    if one:
                        yield from filter(len, [one.rows(partitions, bits)])
                    one = Survivors(int(partition), least)
                if hashes is None:
                    one.mass += int(mass)
                else:
                    one.add(hashes, counts)
        if one:
            yield from filter(len, [one.rows(partitions, bits)])

    return rows.mapInPandas(run, "partition long, hashes binary, first long, bits binary")


def _filter_of(spark: SparkSession, survivors: DataFrame, bits: int) -> Broadcast:
    """The filter of all partitions: each has its own range of it, so as many bytes come together as it has, and one more of each."""
    whole = np.zeros((1 << bits) // 8, np.uint8)
    for first, part in survivors.select("first", "bits").collect():
        whole[first : first + len(part)] |= np.frombuffer(part, np.uint8)
    return spark.sparkContext.broadcast(whole)


# -- step 3: exact counts -------------------------------------------------------------------


def phrase_counts(
    texts: DataFrame, longest: int, least: int, partitions: int, survivors: DataFrame, words: Broadcast, filters: dict[int, Broadcast]
) -> DataFrame:
    """(language, phrase, number of words, occurrences) of all phrases of 2 to ``longest`` words that occur ``least`` times.

    Blocks count what the filters let through, by partition of the hashes as before. There it meets the
    hashes that survived, which are as few as the counters, and is added up by its words: equal hashes of
    different phrases do no harm."""

    def emit(block: Block) -> Iterator[pd.DataFrame]:
        steps, rows, hashes, counts = [], [], [], []
        for k, previous, last, h, n in block.grams(longest, words.value, {k: f.value for k, f in filters.items()}):
            steps.append((previous, last))
            place = at = np.flatnonzero(n)
            parts = []
            for before, end in reversed(steps):
                parts.append(end[place])
                place = before[place]
            rows += np.stack([place, *reversed(parts)], axis=1).tolist() if len(at) else []
            hashes.append(h[at])
            counts.append(n[at])
        hashes, counts = np.concatenate(hashes), np.concatenate(counts).astype(np.uint32)
        numbers: dict[str, int] = defaultdict(count().__next__)
        lang = np.array([numbers[block.langs[row[0]]] for row in rows], np.int64)
        names, partition = list(numbers), part_of(hashes, partitions)
        order = np.lexsort((hashes, lang, partition))
        lang, partition, hashes, counts = lang[order], partition[order], hashes[order], counts[order]
        out = []
        for a, b in _runs(partition, lang):
            text = b"\n".join(b" ".join([block.words[i] for i in rows[j]]) for j in order[a:b])
            out.append((partition[a], names[lang[a]], packed(hashes[a:b]), counts[a:b].tobytes(), text))
        if out:
            yield pd.DataFrame(out, columns=["partition", LANG, "hashes", "counts", "phrases"])

    each = over_blocks(texts, longest, emit, f"partition long, {LANG} string, hashes binary, counts binary, phrases binary")
    both = each.unionByName(survivors.select("partition", "hashes"), allowMissingColumns=True)
    both = both.repartition(partitions, "partition").sortWithinPartitions("partition", F.col("phrases").isNotNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, known, totals = None, [], defaultdict(int)

        def found() -> pd.DataFrame:
            rows = [(lang, phrase.decode(), phrase.count(b" ") + 1, n) for (lang, phrase), n in totals.items() if n >= least]
            return pd.DataFrame(rows, columns=[LANG, "phrase", "k", "f"])

        for batch in batches:
            for partition, lang, hashes, counts, phrases in zip(*(batch[c] for c in ("partition", LANG, "hashes", "counts", "phrases"))):
                if partition != last:
                    yield from filter(len, [found()])
                    last, known, totals = partition, [], defaultdict(int)
                if phrases is None:
                    known.append(unpacked(hashes))
                    continue
                kept = np.isin(unpacked(hashes), np.concatenate(known)) if known else np.zeros(len(hashes) // 6, bool)
                numbers = np.frombuffer(counts, np.uint32)
                words_of = phrases.split(b"\n")
                for i in np.flatnonzero(kept).tolist():
                    totals[lang, words_of[i]] += int(numbers[i])
        yield from filter(len, [found()])

    return both.mapInPandas(run, f"{LANG} string, phrase string, k int, f long")


# -- the operator ---------------------------------------------------------------------------


def _words(phrase: str) -> Column:
    return F.split(phrase, " ")


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase with its lowest-scoring cut: floor(1000 * a * n / (l * r)), exact in 38 decimal digits."""
    whole = "decimal(38,0)"
    known = phrases.select(LANG, "phrase", "f").unionByName(words.select(LANG, "phrase", "f"))
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice(_words("phrase"), F.lit(1), F.col("cut")), " "))
    cuts = cuts.withColumn("right", F.array_join(F.slice(_words("phrase"), F.col("cut") + 1, F.col("k")), " "))
    for side, n in (("left", "l"), ("right", "r")):
        cuts = join_split_hot(cuts, known.select(LANG, F.col("phrase").alias(side), F.col("f").alias(n)), [LANG, side], "phrase")
    cuts = cuts.join(totals, LANG)
    above = F.lit(1000).cast("decimal(4,0)") * F.col("f").cast("decimal(16,0)") * F.col("n").cast("decimal(16,0)")
    below = F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")
    cuts = cuts.withColumns({"above": above.cast(whole), "below": below.cast(whole)}).withColumn("score", F.expr("above div below"))
    least = F.min(F.struct("score", "cut", "l", "r", "n")).alias("least")
    best = cuts.groupBy(LANG, "phrase", F.col("f").alias("a")).agg(least)
    return best.select(LANG, "phrase", "a", *(F.col(f"least.{c}").alias(c) for c in ("l", "r", "n", "score")))


def inside_longer(phrases: DataFrame) -> DataFrame:
    """(language, phrase, occurrences of the most frequent longer phrase that holds it)."""
    parts = phrases.where("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    parts = parts.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    part = F.array_join(F.slice(_words("phrase"), F.col("start"), F.col("size")), " ")
    return parts.select(LANG, part.alias("phrase"), "f").groupBy(LANG, "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, longest: int = 5, top: int = 2000,
    percent: int = 100, filter_bits: int = 26,
) -> DataFrame:
    """The first ``top`` phrases of each language by score, then occurrences (both descending), then the phrase (in
    the order of its bytes): ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase has 2 to ``longest`` words of one piece and occurs ``least`` times. It goes
    where a longer one that holds it has at least ``percent`` hundredths of its occurrences.

    Steps: words are counted; pairs of frequent words are summarised per partition of their hashes, then phrases of three words
    and more whose pairs may all be frequent; what may be frequent is counted exactly. No step drops
    a frequent phrase: a phrase's parts are at least as frequent as the phrase, the
    summaries keep each hash that occurs ``least`` times, and filters only err by letting more through. Summaries grow with the
    corpus, and so does the number of partitions that share them; the filters have ``2 ** filter_bits`` bits each at every size
    (at more frequent phrases than bits they let all pass, and the exact count has more to do).

    A null text is empty, a null language ``und``, and so is a missing language column. Repeated rows count each time. No words, or no
    frequent phrases, give no rows. Very long texts are read in slices. Other columns are not read.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")) if lang_col in docs.columns else F.lit("und")
    texts = docs.select(lang.alias(LANG), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))

    all_words = staged(word_counts(texts), "words")
    totals = staged(all_words.groupBy(LANG).agg(F.sum("f").alias("n")), "word-totals")
    words = all_words.where(F.col("f") >= least)
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(longest - 1) * n_words // (least * COUNTERS)))
    word_hash = F.xxhash64(F.concat(LANG, F.lit("\n"), "phrase")).alias("hash")
    word_bits = _filter(spark, words.select(word_hash), filter_bits)

    filters: dict[int, Broadcast] = {}
    survivors = []
    for lengths in (range(2, 3), range(3, longest + 1)):
        if lengths:
            rows = summaries(texts, lengths, partitions, word_bits, dict(filters))
            survivors.append(staged(frequent_hashes(rows, partitions, least, filter_bits), "survivors"))
            bits = _filter_of(spark, survivors[-1], filter_bits)
            filters |= {k: bits for k in lengths}
    phrases = staged(phrase_counts(texts, longest, least, partitions, reduce(DataFrame.unionByName, survivors), word_bits, filters), "phrases")

    rows = scored(phrases, words, totals).join(inside_longer(phrases), [LANG, "phrase"], "left")
    rows = rows.where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(percent) * F.col("a")))
    order = Window.partitionBy(LANG).orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col(LANG).alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
