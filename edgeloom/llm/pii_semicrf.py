"""Personal data found by fixed patterns and by a semi-Markov conditional random field."""

from __future__ import annotations

import hashlib
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans of equal start are listed, and patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

MAX_TOKENS, MAX_CHARS = 6, 64
#: A long island is worked on in stretches of so many characters, with some more to see where runs end.
STRETCH, MARGIN = 4096, 1024
OPENING, CLOSING = "([{<\"'", ")]}>\"'.,;:!?"
ANCHOR = re.compile(r"[0-9@]+|[(\[]at[)\]]")
TOKEN = re.compile(r"[^ \t\r\n]+")
#: Runs inside tokens, and what may lie between runs of one entity.
RUN = re.compile(r"""[^\s:=,;<>/|&?#*`\\"'{}()\[\]]+""")
WITHIN = re.compile(r"[ \t\r\n()\[\]]*")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
SPELT_AT = re.compile(r"[A-Za-z0-9._%+-]+ ?[(\[]at[)\]] ?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
NUMERIC = re.compile(r"\+?[0-9 ().-]*[0-9]")
GROUPED_PHONE = re.compile(r"(?:\+?[0-9]{1,3}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}")
GROUPED_CARD = re.compile(r"[0-9]{4}([ .-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}")
N_FEATURES = 24
#: The least weight of windows with one set of kinds; and how many tasks merge the windows of all.
LEAST, MERGES = 0.1, 16


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def _octets(s: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in s.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of each pattern's matches, leftmost and non-overlapping
    within a kind; matches that fail the kind's test are dropped without another try."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            free = m.end()
        at = text.find("@", max(free, at + 1))
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if _octets(m[0])]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches of tokens around digits, @ and spelt-out @ signs, joined over single spaces."""
    out: list[list[int]] = []
    for m in ANCHOR.finditer(text):
        floor = out[-1][1] if out else 0
        if m.start() < floor:
            continue
        start, end = m.start(), m.end()
        spelt = m[0][0] in "(["
        if spelt and start > floor and text[start - 1] == " ":
            start -= 1
        while start > floor and not text[start - 1].isspace():
            start -= 1
        if spelt and end < len(text) and text[end] == " ":
            end += 1
        while end < len(text) and not text[end].isspace():
            end += 1
        if out and text[floor:start] in ("", " "):
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _beginning(pattern: re.Pattern, text: str, lo: int, hi: int, begin: int, end: int) -> tuple[list[tuple[int, int]], int]:
    """The pattern's runs in [lo, hi) that begin in [begin, end), and how many these are: a few that
    follow come after them. Runs that go on for over ``MARGIN`` characters are cut there; no segment holds as many."""
    if begin > lo and pattern.match(text, begin - 1, begin):
        running = pattern.match(text, begin, end)
        begin = running.end() if running else begin
    spans = [m.span() for m in pattern.finditer(text, begin, min(hi, end + MARGIN))]
    return spans, sum(s < end for s, _ in spans)


def candidates(text: str, lo: int, hi: int, begin: int | None = None, end: int | None = None) -> list[tuple[int, int]]:
    """Segments of up to ``MAX_TOKENS`` tokens, with and without brackets and punctuation at
    either end, and of as many runs between the delimiters inside tokens, that hold enough
    digits or an @ to be an entity; by end, then start. With ``begin`` and ``end``, those of tokens and runs that begin there."""
    begin, end = lo if begin is None else begin, hi if end is None else end
    tokens, n = _beginning(TOKEN, text, lo, hi, begin, end)
    out = set()
    for i, (first, stop) in enumerate(tokens[:n]):
        bare = first
        while bare < min(stop, first + MAX_CHARS) and text[bare] in OPENING:
            bare += 1
        _segments(text, {first, bare}, first, tokens[i : i + MAX_TOKENS], out)
    runs, n = _beginning(RUN, text, lo, hi, begin, end)
    for i, (first, _) in enumerate(runs[:n]):
        joined = runs[i : i + 1]
        for following in runs[i + 1 : i + MAX_TOKENS]:
            if following[0] - first > MAX_CHARS or not WITHIN.fullmatch(text, joined[-1][1], following[0]):
                break
            joined.append(following)
        _segments(text, {first, first - (first > lo and text[first - 1] in "([")}, first, joined, out)
    return sorted(out, key=lambda x: (x[1], x[0]))


def _segments(text: str, starts: set[int], first: int, parts: list[tuple[int, int]], out: set[tuple[int, int]]) -> None:
    for _, last in parts:
        if last - max(starts) > 2 * MAX_CHARS:
            break
        trimmed = last
        while trimmed > first and text[trimmed - 1] in CLOSING:
            trimmed -= 1
        for s in starts:
            for e in {last, trimmed}:
                if s < e <= s + MAX_CHARS and _may_be_entity(text[s:e]):
                    out.add((s, e))


def _may_be_entity(piece: str) -> bool:
    return "@" in piece or "(at)" in piece or "[at]" in piece or len(_digits(piece)) >= 7 or piece.count(".") == 3


def features(text: str, s: int, e: int) -> list[bool]:
    """What holds of one whole span: its shape, its digits, its ends."""
    piece = text[s:e]
    digits = _digits(piece)
    n = len(digits)
    clean = not (s and (text[s - 1].isalnum() or text[s - 1] in "._%+-@")) and not (e < len(text) and (text[e].isalnum() or text[e] in "@%+-_"))
    email, spelt, dotted = bool(EMAIL.fullmatch(piece)), bool(SPELT_AT.fullmatch(piece)), bool(DOTTED.fullmatch(piece))
    numeric, phone, card = bool(NUMERIC.fullmatch(piece)), bool(GROUPED_PHONE.fullmatch(piece)), bool(GROUPED_CARD.fullmatch(piece))
    octets, checked, plus = dotted and _octets(piece), 12 <= n <= 19 and luhn(digits), piece[0] == "+"
    plain = numeric and checked and not plus and not dotted
    dialled = numeric and plus and 9 <= n <= 15
    return [
        True, clean, any(map(str.isalpha, piece)), numeric, email, email and clean, spelt, spelt and clean,
        dotted, octets, octets and clean, numeric and 12 <= n <= 19, plain, plain and clean, card, card and checked,
        plus, dialled, dialled and clean, phone, phone and clean, n < 9, " " in piece, piece[-1] in CLOSING or piece[0] in OPENING[1:],
    ]


@dataclass
class Lattice:
    """Candidate segments by end; ``before[k]`` of them end where the k-th begins or earlier."""

    segments: list[tuple[int, int]]
    before: list[int]
    x: np.ndarray

    @classmethod
    def of(cls, text: str, lo: int, hi: int) -> Lattice:
        segments = candidates(text, lo, hi)
        ends = np.array([e for _, e in segments], dtype=np.int64)
        before = np.searchsorted(ends, np.array([s for s, _ in segments], dtype=np.int64), side="right")
        x = np.array([features(text, s, e) for s, e in segments], dtype=float).reshape(-1, N_FEATURES)
        return cls(segments, before.tolist(), x)


def best_path(lattice: Lattice, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """The non-overlapping typed segments with the largest sum of scores, as (start, kind,
    end). Text outside segments scores 0. ``best[k]`` is over segments before the k-th."""
    score = lattice.x @ weights.T
    kind, best, taken = score.argmax(1) if len(score) else [], [0.0], []
    for k, before in enumerate(lattice.before):
        with_it = best[before] + score[k, kind[k]]
        taken.append(with_it > best[-1])
        best.append(max(best[-1], with_it))
    out, k = [], len(taken)
    while k:
        if taken[k - 1]:
            s, e = lattice.segments[k - 1]
            out.append((s, int(kind[k - 1]), e))
            k = lattice.before[k - 1]
        else:
            k -= 1
    return out[::-1]


class Path:
    """The same dynamic program while segments come in by end. What all paths that can still win have in common is
    decided and let go, so that a text of numbers alone needs no more room than a stretch of it."""

    def __init__(self) -> None:
        self.ends: list[int] = []
        self.best, self.back, self.step = [0.0], [0], [None]  # of node k: its best sum, the node before it, the segment taken

    def add(self, segments: list[tuple[int, int]], score: np.ndarray) -> None:
        kinds, tops = score.argmax(1).tolist(), score.max(1).tolist()
        for (start, end), kind, top in zip(segments, kinds, tops):
            before, here = bisect_right(self.ends, start), len(self.ends)
            with_it = self.best[before] + top
            taken = with_it > self.best[-1]
            self.ends.append(end)
            self.best.append(with_it if taken else self.best[-1])
            self.back.append(before if taken else here)
            self.step.append((start, kind, end) if taken else None)

    def decided(self, start: int | None = None) -> list[tuple[int, int, int]]:
        """The part of the path that no segment from ``start`` on can change; all of it without ``start``."""
        n = len(self.ends)
        open_nodes = {n} if start is None else set(range(bisect_right(self.ends, start), n + 1))
        while len(open_nodes) > 1:
            last = max(open_nodes)
            open_nodes.remove(last)
            open_nodes.add(self.back[last])
        common = k = open_nodes.pop()
        out = []
        while k:
            if self.step[k]:
                out.append(self.step[k])
            k = self.back[k]
        self.ends, self.best = self.ends[common:], self.best[common:]
        self.back, self.step = [0, *(k - common for k in self.back[common + 1 :])], [None, *self.step[common + 1 :]]
        return out[::-1]


def entities(text: str, lo: int, hi: int, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """``best_path`` of an island of any length, stretch by stretch."""
    path, held, out = Path(), [], []
    for begin in range(lo, hi, STRETCH):
        end = min(begin + STRETCH, hi)
        held = sorted({*held, *candidates(text, lo, hi, begin, end)}, key=lambda x: (x[1], x[0]))
        ready = len(held) if end == hi else bisect_right(held, end, key=lambda x: x[1])
        if ready:
            path.add(held[:ready], np.array([features(text, s, e) for s, e in held[:ready]], dtype=float) @ weights.T)
        held = held[ready:]
        # a run that begins next may take the bracket before it
        out += path.decided(None if end == hi else min([end - 1, *(s for s, _ in held)]))
    return out


def train(examples: list[tuple[Lattice, dict[tuple[int, int], int]]], steps: int = 60, rate: float = 0.5, decay: float = 1e-3, shares: list[float] | None = None) -> np.ndarray:
    """Weights (kind x feature) that maximise the likelihood of the true segmentations. The
    sum over all segmentations runs forward over each lattice and its derivative backward;
    the gradient is true features less expected ones. An example counts ``shares`` times, or once."""
    shares = shares or [1.0] * len(examples)
    weights = np.zeros((len(KINDS), N_FEATURES))
    weights[:, 0] = -2.0
    true = np.zeros_like(weights)
    for (lattice, gold), share in zip(examples, shares):
        for k, span in enumerate(lattice.segments):
            if span in gold:
                true[gold[span]] += share * lattice.x[k]
    moment = np.zeros_like(weights)
    for _ in range(steps):
        expected = np.zeros_like(weights)
        for (lattice, _gold), share in zip(examples, shares):
            score = lattice.x @ weights.T
            total = np.logaddexp.reduce(score, axis=1)
            ahead = [0.0]
            for before, t in zip(lattice.before, total.tolist()):
                ahead.append(float(np.logaddexp(ahead[-1], ahead[before] + t)))
            grow = [0.0] * len(total) + [1.0]
            chance = np.zeros(len(total))
            for k in range(len(total) - 1, -1, -1):
                before = lattice.before[k]
                chance[k] = take = grow[k + 1] * np.exp(ahead[before] + total[k] - ahead[k + 1])
                grow[k] += grow[k + 1] - take
                grow[before] += take
            expected += share * (np.exp(score - total[:, None]) * chance[:, None]).T @ lattice.x
        gradient = (true - expected) / sum(shares) - decay * weights
        moment += gradient**2
        weights += rate * gradient / (np.sqrt(moment) + 1e-6)
    return weights


def variants(piece: str, kind: int) -> list[str]:
    """Other ways in which people write a found entity, for training."""
    if KINDS[kind] == "email":
        name, _, host = piece.partition("@")
        return [f"{name} (at) {host}", f"{name}[at]{host}"]
    m = re.search(r"\(?([0-9]{3})\)?[ .-]([0-9]{3})[ .-]([0-9]{4})$", piece)
    if KINDS[kind] == "phone" and m:
        return [f"({m[1]}) {m[2]}-{m[3]}", f"{m[1]}-{m[2]}-{m[3]}"]
    d = _digits(piece)
    if KINDS[kind] == "card" and len(d) == 16:
        return [".".join(d[i : i + 4] for i in range(0, 16, 4))]
    return []


def examples_of(windows: list[str]) -> list[tuple[Lattice, dict[tuple[int, int], int]]]:
    """Lattices with their true segments: the pattern matches of each window, and again with
    the first match written in other ways."""
    out = []
    for window in windows:
        spans = base_spans(window)
        texts = [(window, spans)]
        for start, kind, end in spans[:1]:
            texts += [(f"{window[:start]}{v}{window[end:]}", [(start, kind, start + len(v))]) for v in variants(window[start:end], kind)]
        for text, gold in texts:
            lattice = Lattice.of(text, 0, len(text))
            if lattice.segments:
                out.append((lattice, {(s, e): k for s, k, e in gold}))
    return out


def stratum(window: str) -> int:
    """The set of kinds that the patterns find in a window, as bits."""
    return sum(1 << k for k in {k for _, k, _ in base_spans(window)})


def teaches(window: str) -> bool:
    """Whether a window has a candidate segment; others change no likelihood."""
    enough = "@" in window or "at" in window or window.count(".") > 2 or len(_digits(window)) >= 7
    return enough and bool(candidates(window, 0, len(window)))


def quotas(sizes: dict[int, int], total: int) -> dict[int, int]:
    """Small strata whole, and what is left of ``total`` in equal parts to the others."""
    out, left = {}, total
    for i, (key, size) in enumerate(sorted(sizes.items(), key=lambda x: x[1])):
        out[key] = min(size, left // (len(sizes) - i))
        left -= out[key]
    return out


def raised(sizes: dict[int, float]) -> dict[int, float]:
    """Weights of the strata that sum to 1: their shares of all windows, but at least ``LEAST`` for windows
    with entities of any set of kinds."""
    low: set[int] = set()
    least = min(LEAST, 0.5 / len(sizes))
    while True:
        rest = sum(v for k, v in sizes.items() if k not in low)
        out = {k: least if k in low else (1 - least * len(low)) * v / rest for k, v in sizes.items()}
        more = {k for k, v in out.items() if k and k not in low and v < least}
        if not more:
            return out
        low |= more


def learn(docs: DataFrame, text_col: str = "text", windows: int = 1_500, seed: int = 5) -> np.ndarray | None:
    """Weights from at most ``windows`` distinct windows out of all documents. Windows are parted by the
    set of kinds that the patterns find in them, none included (if they have candidates); of each part those with the smallest
    hashes are taken, so a rare kind teaches however rare it is. Islands of over 256 characters are no windows: they
    teach nothing, and are searched like all others. Parts count by their shares of all
    windows, rare ones by ``LEAST``. None if no window of any document holds an entity."""
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    bound = max(1, windows // 2)

    def rank(window: str) -> int:
        return int.from_bytes(hashlib.blake2b(window.encode("utf-8", "surrogatepass"), digest_size=8, salt=str(seed).encode()).digest()) >> 1

    def fewest(kept: dict[int, dict[str, int]]) -> None:
        for kind, own in kept.items():
            if len(own) > bound:
                kept[kind] = dict(sorted(own.items(), key=lambda x: (x[1], x[0]))[:bound])

    def frame(kept: dict[int, dict[str, int]], seen: dict[int, int]) -> pd.DataFrame:
        fewest(kept)
        found = [(kind, at, window, 0) for kind, own in kept.items() for window, at in own.items()]
        found += [(kind, -1, "", n) for kind, n in seen.items()]
        return pd.DataFrame(found, columns=["stratum", "rank", "window", "n"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, seen = {}, {}
        for batch in batches:
            for text in batch["text"]:
                for lo, hi in islands(text):
                    if hi - lo <= 256:
                        window = text[max(0, lo - 2) : hi + 2]
                        kind = stratum(window)
                        if not kind and not teaches(window):
                            continue
                        seen[kind] = seen.get(kind, 0) + 1
                        own = kept.setdefault(kind, {})
                        if window not in own:
                            own[window] = rank(window)
                            if len(own) >= 4 * bound:
                                fewest(kept)
        yield frame(kept, seen)

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, seen = {}, {}
        for batch in batches:
            for kind, at, window, n in batch.itertuples(index=False):
                if at < 0:
                    seen[kind] = seen.get(kind, 0) + n
                else:
                    kept.setdefault(kind, {})[window] = at
            fewest(kept)
        yield frame(kept, seen)

    schema = "stratum long, rank long, window string, n long"
    best = rows.mapInPandas(cut, schema).repartition(MERGES, "window").mapInPandas(merged, schema)
    parts, sizes = {}, {}
    for r in best.collect():
        if r.rank < 0:
            sizes[r.stratum] = sizes.get(r.stratum, 0) + r.n
        else:
            parts.setdefault(r.stratum, []).append((r.rank, r.window))
    if not any(parts):
        return None
    taken = quotas({kind: min(len(own), bound) for kind, own in parts.items()}, windows)
    examples, shares, weight = [], [], raised(sizes)
    for kind, own in sorted(parts.items()):
        some = examples_of([w for _, w in sorted(own)[: taken[kind]]])
        examples += some
        shares += [weight[kind] / len(some)] * len(some) if some else []
    return train(examples, shares=shares) if any(gold for _, gold in examples) else None


def find_spans(text: str, weights: np.ndarray | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The pattern spans, and all spans: with those that the model finds between them."""
    if not ANCHOR.search(text):
        return [], []
    base = base_spans(text)
    if weights is None:
        return base, base
    added, taken = [], iter(sorted((s, e) for s, _, e in base))
    held = next(taken, None)
    for lo, hi in islands(text):
        at, parts = lo, []
        while held and held[0] < hi:
            if held[0] > at:
                parts.append((at, held[0]))
            at = max(at, held[1])
            held = next(taken, None)
        parts.append((at, hi))
        for a, b in parts:
            if b - a >= 7:
                added += entities(text, a, b, weights)
    return base, sorted(base + added)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by the first one's kind."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k]}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``,
    ``base_sha256`` (of the pattern spans) and ``spans`` (all spans), in code points.

    Pattern spans stand. Between them the model scores every candidate segment of a few
    tokens around digits and @ signs as a whole, and dynamic programming picks boundaries
    and kinds together. Null texts count as empty; empty texts have no spans; repeated rows
    and null ids give a row each; an empty table gives none; other columns are not read.
    """
    weights = learn(docs, text_col, **options)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                base, spans = find_spans(text or "", weights)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
                rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), found(F.col(f"`{text_col}`").cast("string")).alias("found"))
    return rows.select(id_col, "found.*")


def redact(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets. Columns, rows and texts
    without spans are unchanged; a column ``n_chars`` follows the changed texts."""
    weights = learn(docs, text_col, **options)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else masked(t, find_spans(t, weights)[1]) for t in texts], dtype=object)

    name, kinds = f"clean_{uuid.uuid4().hex[:8]}", dict(docs.dtypes)
    out = docs.withColumn(name, clean(F.col(f"`{text_col}`").cast("string")))
    own = {text_col: F.col(name)}
    if "n_chars" in kinds:
        changed = ~F.col(name).eqNullSafe(F.col(f"`{text_col}`"))
        own["n_chars"] = F.when(changed, F.length(name)).otherwise(F.col("n_chars")).cast(kinds["n_chars"])
    return out.select(*(own[c].alias(c) if c in own else F.col(f"`{c}`") for c in docs.columns))
