import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from edgeloom.llm import collocations, queries
from parity import difference, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=100, longest=5, top=2000, percent=100):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    f[key] = f.get(key, 0) + 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = {}
    for (lang, w), a in candidates.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                key = (lang, w[i : i + size])
                inside[key] = max(inside.get(key, 0), a)
    out = []
    for (lang, w), a in candidates.items():
        if (lang, w) in inside and 100 * inside[lang, w] >= percent * a:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), l, r, n[lang]))
    ranks, rows = Counter(), []
    for lang, score, a, phrase, l, r, total in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= top:
            rows.append((lang, ranks[lang], phrase.decode(), -a, l, r, total, -score))
    return rows


SCHEMA = "text string, lang string, phrase string, rank int, f int"


def check(spark, rows, parts=3, **more):
    df = spark.createDataFrame([(t, x, "p", 1, 1) for t, x in rows], SCHEMA).repartition(parts)
    got = sorted(tuple(r) for r in collocations.collocations(df, filter_bits=16, **more).collect())
    assert got == sorted(brute(rows, **more))
    return got


@pytest.mark.parametrize("block", [50, 2_000_000])
def test_same_as_counting_all(spark, monkeypatch, block):
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations, "SLICE", 40 if block == 50 else 1 << 20)
    monkeypatch.setattr(collocations, "COUNTERS", 20)
    rng = random.Random(3)
    words = ["a", "B", "b", "cé", "É", "New", "york", "x y", "🙂", "kK"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\r\n", "", "?!"]) for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    rows += [(None, "en"), ("", None), ("..", "fr"), ("of the people " * 500, "en"), ("of the people " * 500, "en"), ("w" * 300, "en"), (" a\n", "")]
    got = check(spark, rows, least=12)
    assert len(got) > 10
    check(spark, rows, least=30, longest=3, top=2, percent=80)


def test_nothing_to_find(spark):
    assert check(spark, [("one two", "en"), (None, None)], parts=1) == []
    df = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(df, filter_bits=16).collect() == []


def test_products_over_64_bits(spark):
    phrases = spark.createDataFrame([("en", "a b", 2, 3_000_000_000_001)], "_lang string, phrase string, k int, f long")
    words = spark.createDataFrame([("en", "a", 4_000_000_000_000), ("en", "b", 5_000_000_000_007)], "_lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 9_000_000_000_000_003)], "_lang string, n long")
    row = collocations.scored(phrases, words, totals).first()
    assert row.score == 1000 * 3_000_000_000_001 * 9_000_000_000_000_003 // (4_000_000_000_000 * 5_000_000_000_007)


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(1)
    stream = np.concatenate([rng.integers(0, 100_000, 200_000), np.repeat(np.arange(40), 100), np.full(50_000, 7)]).astype(np.uint64)
    rng.shuffle(stream)
    true, least = Counter(stream.tolist()), 100
    capacity = len(stream) // least + 1
    parts, taken = [], 0
    for piece in np.array_split(stream, 7):  # summaries of pieces, merged in two steps
        keys, counts, off = collocations.merge(piece, np.ones(len(piece), np.int64), capacity)
        parts, taken = [*parts, (keys, counts)], taken + off
    for group in (parts[:3], parts[3:]):
        keys, counts, off = collocations.merge(np.concatenate([p[0] for p in group]), np.concatenate([p[1] for p in group]), capacity)
        taken += off
        parts = [p for p in parts if not any(p is g for g in group)] + [(keys, counts)]
    keys, counts, off = collocations.merge(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), capacity)
    taken += off
    left = dict(zip(keys.tolist(), counts.tolist()))
    assert 0 < taken < least and len(left) <= capacity < len(true)
    assert all(left.get(k, 0) + taken >= n >= left.get(k, 0) for k, n in true.items() if n >= least or k in left)
    assert all(k in left for k, n in true.items() if n >= least)


def test_oracle(spark, small):
    sql = queries.SQL["op13_collocations"]
    df = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    assert difference(collocations.collocations(df, least=20), duck(small), sql.replace("f >= 100", "f >= 20")) is None
    assert difference(queries.op13_collocations(spark, small), duck(small), sql) is None


def test_no_frequent_phrase_is_lost_to_a_full_filter(spark):
    rng = random.Random(5)
    rows = [(" ".join(rng.choice("abcdefgh") for _ in range(40)), "en") for _ in range(60)]
    df = spark.createDataFrame([(t, x, "p", 1, 1) for t, x in rows], SCHEMA).withColumn("extra", F.lit(1))
    assert sorted(tuple(r) for r in collocations.collocations(df, least=8, filter_bits=11).collect()) == sorted(brute(rows, least=8))
