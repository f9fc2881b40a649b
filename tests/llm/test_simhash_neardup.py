import re

import numpy as np
import pytest
import xxhash

from brute import components, docs, rows
from edgeloom.llm import simhash_neardup as S


def brute_print(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    ones = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum((2 * n > len(shingles)) << b for b, n in enumerate(ones))


TEXTS = [
    "The quick brown fox jumps over the lazy dog", "the QUICK brown\tfox jumps over\nthe lazy dog", None, "", " \n ", "one", "One two", "Ünï cödé WORDS here now x",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 30, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 30 + "a b",
]


@pytest.mark.parametrize("shingle", [1, 3])
def test_fingerprints(shingle, monkeypatch):
    for size in (1 << 22, 16):
        monkeypatch.setattr(S, "PIECE_BYTES", size)
        for text in TEXTS:
            assert S.fingerprint(text, shingle) & (1 << 64) - 1 == brute_print(text, shingle)


@pytest.mark.parametrize("max_bits,bucket_rows", [(2, 256), (2, 1), (1, 1), (3, 256), (3, 2), (0, 1)])
def test_links_reach_all_neighbours(spark, max_bits, bucket_rows):
    rng = np.random.default_rng(max_bits)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = set(base.tolist())
    for _ in range(400):
        x = int(rng.choice(base[:4]))
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            x ^= 1 << int(b)
        prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "f long")
    links = [(r.a, r.b) for r in S.hamming_links(df, max_bits, bucket_rows=bucket_rows).collect()]
    place = {s: i for i, s in enumerate(signed)}
    assert all(1 <= bin((a ^ b) & (1 << 64) - 1).count("1") <= max_bits for a, b in links)
    near = [(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= max_bits]
    assert components(len(prints), [(place[a], place[b]) for a, b in links]) == components(len(prints), near)


def test_components_of_documents(spark):
    texts = TEXTS + [(100, TEXTS[0]), (100, TEXTS[0]), (None, TEXTS[0])]
    df = docs(spark, texts).withColumnRenamed("source", "f").withColumnRenamed("lang", "component_id")
    got = S.near_duplicates(df).collect()
    assert len(got) == len(texts)
    by = {r.doc_id: r for r in got}
    assert by[0].component_id == by[1].component_id == by[100].component_id == by[None].component_id == 0
    assert by[2].fingerprint == by[3].fingerprint == by[4].fingerprint == "0" * 16 and by[4].component_id == 2
    assert S.near_duplicates(docs(spark, TEXTS).limit(0)).collect() == []


def test_one_of_each_group_stays(spark):
    df = docs(spark, TEXTS + [(None, TEXTS[0]), (1, TEXTS[1]), (3, "")])
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    expect = {r.component_id for r in S.near_duplicates(df).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expect)
    assert S.drop_near_duplicates(df.limit(0)).collect() == []


def test_chain_of_links(spark):
    from edgeloom.llm.components import connected

    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5)], "a long, b long")
    assert rows(connected(edges), "node").keys() == {*range(61), 100, 101}
    assert {r.root for r in connected(edges).collect()} == {0, 100}
