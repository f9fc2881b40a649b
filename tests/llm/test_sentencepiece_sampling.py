import math
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from brute import docs, rows
from edgeloom.llm import sentencepiece_sampling as M
from edgeloom.llm.queries import QUERIES, tokenizer_file
from edgeloom.llm.sentencepiece_sampling import Pieces, Sampler, decode, encode_rows, forward

PATH = tokenizer_file("piece_bpe_32k.model")
TEXTS = ["Hello  world\n a", "▁x é中文🙂\x00", "", "x" * 700 + " the end", "the " * 500, "<s></s><0x0A><unk>", "\n\n", "   ", "ab" * 200 + "\n" + "é" * 90 + " cd", None]


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PATH, 1.0)


def test_lossless_and_the_same_in_any_batch(pieces):
    texts, one = [t or "" for t in TEXTS], Sampler(pieces)
    whole = one.encode(texts, list(range(len(texts))))
    for i, t in enumerate(texts):
        assert decode(whole[i], pieces) == t
        assert Sampler(pieces).encode([t], [i])[0].tolist() == whole[i].tolist()


def test_draws_follow_the_lattice(pieces):
    word, n = " then", 20_000
    found = []

    def walk(at, ids, logp):
        if at == len(word):
            found.append((ids, logp))
        for start, end, own, weight in pieces.edges(word):
            if start == at:
                walk(end, ids + tuple(own), logp + weight)

    walk(0, (), 0.0)
    total = sum(math.exp(p) for _, p in found)
    drawn = Counter(tuple(x.tolist()) for x in Sampler(pieces).encode([word] * n, list(range(n))))
    assert set(drawn) <= {ids for ids, _ in found}
    assert max(abs(drawn[ids] / n - math.exp(p) / total) for ids, p in found) < 0.015


def test_vectorised_lattice_is_the_plain_one(pieces):
    sampler, words = Sampler(pieces), [" hello", "▁é🙂", "\n", "  a", "xyzzy" * 9]
    sampler._learn(words)
    at = 0
    for word in words:
        for edges in forward(word, pieces)[1:]:
            node = [*sampler.cum[at : at + len(edges) - 1], 1.0]
            shares = [b - a for a, b in zip([0.0, *node[:-1]], node)]
            assert sorted(round(p, 9) for _, _, p in edges) == pytest.approx(sorted(round(p, 9) for p in shares), abs=1e-7)
            at += len(edges)


def test_forgetting_words_changes_nothing(pieces, monkeypatch):
    monkeypatch.setattr(M, "KEPT_EDGES", 10)
    texts, sampler = [t or "" for t in TEXTS], Sampler(pieces)
    again = [sampler.encode([t], [i])[0].tolist() for i, t in enumerate(texts)]
    assert again == [x.tolist() for x in Sampler(pieces).encode(texts, list(range(len(texts))))]


def test_rows(spark):
    df = docs(spark, [*TEXTS, (0, TEXTS[0]), (None, "the end")]).withColumnRenamed("lang", "ids").withColumnRenamed("source", "key")
    got = encode_rows(df, PATH).collect()
    assert len(got) == len(TEXTS) + 2 and all(r.lossless for r in got)
    first = [r for r in got if r.doc_id == 0]
    assert len(first) == 2 and first[0] == first[1]
    assert rows(encode_rows(df, PATH), "doc_id")[9].n_pieces == 0
    assert encode_rows(df.limit(0), PATH).collect() == []


def test_query_returns_the_segmentation(spark, small, pieces):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op4_sentencepiece_sampling"](spark, small).collect():
        assert len(r.ids) == r.n_pieces and decode(np.array(r.ids), pieces) == texts[r.doc_id]


def test_long_words_draw_as_their_whole_lattice_would(pieces):
    word, seed = "base64/" + "aGVsbG8gd29ybGQé" * 60, np.uint64(77)
    into, at, step, want = forward(word, pieces), len(word), 0, []
    while at:
        shares = np.cumsum([p for _, _, p in into[at]])
        draw = M._uniform(np.full(1, seed), np.arange(step, step + 1))[0]
        at, ids = into[at][min(int(np.searchsorted(shares, draw, side="right")), len(shares) - 1)][:2]
        want, step = [ids, *want], step + 1
    assert Sampler(pieces)._alone(word, seed).tolist() == [i for ids in want for i in ids]


def test_very_long_words_in_little_memory_and_linear_time(pieces):
    rng = np.random.default_rng(1)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/漢字"))
    took, peak = [], []
    for n in (50_000, 100_000, 200_000):
        word = "".join(rng.choice(letters, n))
        tracemalloc.start()
        begun = time.process_time()
        ids = Sampler(pieces).encode([word], [3])[0]
        took.append(time.process_time() - begun)
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert decode(ids, pieces) == word
    assert took[2] < 6 * took[0] and peak[2] - peak[1] < 100 * 100_000  # 10 MB more than 500 MB would be 50 bytes a character


def test_one_sampler_per_process_gives_what_new_ones_give(pieces):
    texts = [t or "" for t in TEXTS]
    assert M.sampler_of(PATH, 1.0) is M.sampler_of(PATH, 1.0)
    for _ in range(2):
        again = M.sampler_of(PATH, 1.0).encode(texts, list(range(len(texts))))
        assert [x.tolist() for x in again] == [x.tolist() for x in Sampler(pieces).encode(texts, list(range(len(texts))))]
