"""URL rules and globs, all simulated at once over each canonical URL by one bit-parallel automaton."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Host, path, verdict. A rule fits its host and all subdomains, where the path starts with the rule's.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Globs that judge what no rule fits. ``*`` stands for any run without ``/``, ``**`` for any run,
#: ``?`` for one character but ``/``, and a backslash takes the next character as it is.
GLOBS = (
    ("**cheap-pills**", "block"),
    ("**casino**", "block"),
    ("*.xxx/**", "block"),
    ("**/wp-login.php", "block"),
    ("**/cgi-bin/**", "block"),
    ("*/search/??/**", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows in work at once below which the rest of the (long) URLs runs on Python integers.
FEW = 8
ANY, RUN, LONG_RUN = object(), object(), object()


def parse_glob(glob: str) -> list:
    """Characters and wildcards of ``glob`` in order."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            out.append(glob[i + 1])
            i += 1
        elif c == "*":
            long = glob[i + 1 : i + 2] == "*"
            out.append(LONG_RUN if long else RUN)
            i += long
        else:
            out.append(ANY if c == "?" else c)
        i += 1
    return out


class Automaton:
    """All patterns as bits of one state vector, in words of 64.

    A pattern of m characters has bits 0..m: bit i is set while its first i characters
    have been read. Reading c moves every bit one up where the next character accepts c
    (``step``) and keeps it where a run may go on (``stay``):
    ``D = (D << 1) & step[c] | D & stay[c]``. ``step`` is zero at each pattern's bit 0, so nothing
    moves from one pattern into the next. Characters that no pattern names share one class.
    """

    def __init__(self, patterns: list[list]) -> None:
        letters = sorted({c for p in patterns for c in p if isinstance(c, str)} | {"/"})
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        classes = [None, *letters]
        step, stay = [0] * len(classes), [0] * len(classes)
        bit, begin, self.final = 0, 0, []
        for pattern in patterns:
            begin |= 1 << bit
            for token in pattern:
                moves = token not in (RUN, LONG_RUN)
                bit += moves
                masks = step if moves else stay
                for k, c in enumerate(classes):
                    if token is LONG_RUN or token == c or (token in (ANY, RUN) and c != "/"):
                        masks[k] |= 1 << bit
            self.final.append(bit)
            bit += 1
        self.words = -(-bit // 64) or 1
        self.step, self.stay, self.begin = step, stay, begin
        self._step, self._stay = (np.array([self._cut(m) for m in masks], np.uint64) for masks in (step, stay))

    def _cut(self, mask: int) -> list[int]:
        return [(mask >> (64 * w)) & (2**64 - 1) for w in range(self.words)]

    def match(self, urls: list[str]) -> np.ndarray:
        """Rows by patterns: which pattern fits which whole URL. All URLs advance together, a character at a time."""
        lengths = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")
        codes = np.frombuffer("".join(urls[i] for i in order).encode("utf-32-le"), np.uint32)
        place = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        classes = np.where(self.letters[place] == codes, place + 1, 0)
        sizes = lengths[order]
        starts = np.cumsum(sizes) - sizes
        state = np.tile(np.array(self._cut(self.begin), np.uint64), (len(urls), 1))
        alive, at, one, top = len(urls), 0, np.uint64(1), np.uint64(63)
        while True:
            while alive and sizes[alive - 1] <= at:
                alive -= 1
            if alive < FEW:
                break
            c = classes[starts[:alive] + at]
            now = state[:alive]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:alive] = (moved & self._step[c]) | (now & self._stay[c])
            at += 1
        for row in range(alive):
            state[row] = self._cut(self._run(state[row], classes[starts[row] + at : starts[row] + sizes[row]]))
        out = np.zeros((len(urls), len(self.final)), bool)
        for p, bit in enumerate(self.final):
            out[order, p] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one
        return out

    def _run(self, words: np.ndarray, classes: np.ndarray) -> int:
        state, step, stay = sum(int(w) << (64 * i) for i, w in enumerate(words)), self.step, self.stay
        for begin in range(0, len(classes), 1 << 16):
            for c in classes[begin : begin + (1 << 16)].tolist():
                state = (state << 1) & step[c] | state & stay[c]
        return state


@dataclass(frozen=True)
class Policy:
    """Rules and globs in order of precedence, with their automaton.

    A rule becomes two patterns, its host alone and any subdomain of it, each followed by its path
    and any run. Of the rules that fit, the longest (characters of host and path) wins, of equally long
    ones a blocking one, then the least text. Only where no rule fits do the globs judge, by the same order; where
    none fits either, ``default`` stands."""

    rules: tuple[tuple[str, str, str], ...] = RULES
    globs: tuple[tuple[str, str], ...] = GLOBS
    default: str = "allow"

    def ordered(self) -> tuple[list[tuple[str, str, list[list]]], list[tuple[str, str, list[list]]]]:
        rules = [(h + p, v, [[*h, *p, LONG_RUN], [RUN, ".", *h, *p, LONG_RUN]]) for h, p, v in self.rules]
        globs = [(g, v, [parse_glob(g)]) for g, v in self.globs]
        return tuple(sorted(x, key=lambda r: (-len(r[0]), r[1] != "block", r[0])) for x in (rules, globs))

    def judge(self, urls: list[str]) -> pd.DataFrame:
        """rule, pattern, verdict of each canonical URL."""
        automaton = _automaton(self)
        rules, globs = self.ordered()
        fits = automaton.match(urls)
        width = 2 * len(rules)
        by_rule = fits[:, :width].reshape(len(urls), len(rules), 2).any(axis=2)
        rule, ruled = _first(by_rule)
        glob, globbed = _first(fits[:, width:])
        globbed &= ~ruled

        def pick(of: list, at: np.ndarray, where: np.ndarray, part: int) -> np.ndarray:
            return np.where(where, np.array([*(r[part] for r in of), None], object)[at], None)

        verdict = np.where(ruled, pick(rules, rule, ruled, 1), np.where(globbed, pick(globs, glob, globbed, 1), self.default))
        return pd.DataFrame({"rule": pick(rules, rule, ruled, 0), "pattern": pick(globs, glob, globbed, 0), "verdict": verdict})


def _first(fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first column that is true in each row, and whether there is one."""
    if not fits.shape[1]:
        return np.zeros(len(fits), int), np.zeros(len(fits), bool)
    return fits.argmax(axis=1), fits.any(axis=1)


@lru_cache(maxsize=16)
def _automaton(policy: Policy) -> Automaton:
    rules, globs = policy.ordered()
    return Automaton([p for _, _, patterns in (*rules, *globs) for p in patterns])


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path; both empty where the URL is null or holds no ``://``."""
    after = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", policy: Policy = Policy()) -> DataFrame:
    """One row per row of ``pages``: the id, ``host``, ``path``, ``rule``, ``verdict`` and ``pattern``.

    The canonical URL is host and path; all rules and globs run over it in one pass, in
    memory of a state vector per row of a batch, whatever the length. Rows are judged where they are read: no shuffle, and a
    host with a third of all rows is nothing special. ``rule`` is the rule that decides, ``pattern`` the glob that
    decides where no rule fits, both null where the default stands. Null URLs and such without ``://``
    have an empty host and path; repeated rows and null ids give a row each; an empty
    table gives none; other columns are not read.
    """

    @F.pandas_udf("rule string, pattern string, verdict string")
    def judged(canonical: pd.Series) -> pd.DataFrame:
        return policy.judge(canonical.tolist())

    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    rows = pages.select(F.col(f"`{id_col}`").alias(id_col), host.alias("_host"), path.alias("_path"))
    rows = rows.withColumn("_judged", judged(F.concat("_host", "_path")))
    return rows.select(
        F.col(f"`{id_col}`"), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_judged.rule").alias("rule"), F.col("_judged.verdict").alias("verdict"), F.col("_judged.pattern").alias("pattern"),
    )


def keep_allowed(pages: DataFrame, url_col: str = "url", policy: Policy = Policy()) -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with all their columns."""

    @F.pandas_udf("boolean")
    def allowed(canonical: pd.Series) -> pd.Series:
        return policy.judge(canonical.tolist())["verdict"] == "allow"

    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    return pages.where(allowed(F.concat(host, path)))
