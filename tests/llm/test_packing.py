import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from brute import docs
from edgeloom.llm.packing import WordTokenizer, first_fit_decreasing, pack, sequences
from edgeloom.llm.queries import tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")
TEXTS = ["Hello, World's  end\n\tit's", None, "", "x" * 5000, "a b " * 5000, "<|endoftext|> ok", "é É́   中文🙂 12345", "\x1c a b\x85c", (0, "same id"), (0, "same id"), (None, "no id")]


def expected(texts):
    t = Tokenizer.from_file(PATH)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_words_give_the_whole_texts_ids(monkeypatch):
    import edgeloom.llm.packing as M

    rng = random.Random(3)
    latin = [chr(c) for c in range(256)] + list("aAbB'’sStTrevVmldD  \n<|>é²") * 6
    texts = [t[1] if isinstance(t, tuple) else t for t in TEXTS]
    texts += ["".join(rng.choice(latin) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choice(latin + list("́ſΣσẞİ中🙂") * 9) for _ in range(rng.randint(0, 40))) for _ in range(1000)]
    for kept in (300_000, 1):
        monkeypatch.setattr(M, "CACHE_WORDS", kept)
        monkeypatch.setattr(M, "CACHE_TOKENS", kept)
        got = [np.frombuffer(b, "<u4").tolist() for b in WordTokenizer(PATH).encode(texts)]
        assert got == expected(texts)


@pytest.mark.parametrize("seed", range(4))
def test_first_fit_decreasing_is_the_plain_one(seed):
    lengths = np.random.default_rng(seed).integers(1, 101, 300)
    bins, room = [], []
    for i in np.argsort(-lengths, kind="stable").tolist():
        for b in range(len(bins)):
            if room[b] >= lengths[i]:
                break
        else:
            b = len(bins)
            bins.append([])
            room.append(100)
        bins[b].append(i)
        room[b] -= lengths[i]
    assert first_fit_decreasing(lengths, 100) == bins


def test_last_bins_are_cut_to_powers_of_two():
    got = list(sequences(np.array([1000, 900, 500, 77]), 2048, 64))
    assert all(sum(n for *_, n in s) & (sum(n for *_, n in s) - 1) == 0 or sum(n for *_, n in s) >= 2048 - 64 for s in got)
    for i, length in enumerate((1000, 900, 500, 77)):
        own = sorted((start, n) for s in got for j, start, n in s if j == i)
        assert [a for a, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist() and sum(n for _, n in own) == length


@pytest.mark.parametrize("group_pieces,capacity", [(4096, 2048), (3, 64)])
def test_every_id_once_and_no_gaps(spark, group_pieces, capacity):
    df = docs(spark, TEXTS).withColumnRenamed("source", "group").withColumnRenamed("lang", "ids")
    got = pack(df, PATH, capacity=capacity, group_pieces=group_pieces, slack=8).collect()
    texts = defaultdict(list)
    for r, ids in zip(df.collect(), expected([r.text for r in df.collect()])):
        texts[r.doc_id].append(ids + [1])
    for doc, copies in texts.items():
        own = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        assert sum(r.length for r in own) == sum(map(len, copies))
        assert all(any(r.doc_tokens == len(c) and np.frombuffer(r.ids, "<u4").tolist() == c[r.start : r.start + r.length] for c in copies) for r in own)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist() and sum(n for _, n in spans) <= capacity
    assert zlib.crc32(got[0].ids) >= 0
    assert pack(df.limit(0), PATH).collect() == []
