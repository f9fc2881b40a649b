import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from brute import components
from conftest import DATA
from edgeloom.llm import pii_semicrf
from edgeloom.llm.queries import tokenizer_file
from test_simhash_neardup import brute_print


def test_stages_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    extra = docs.limit(6).withColumns({"doc_id": F.col("doc_id") + 10_000, "text": F.concat("text", F.lit(" \n"))})
    odd = spark.createDataFrame([(20_000, None, "en", "s", 0), (20_001, "12 !!", "en", "s", 5), (20_002, "", None, None, None)], docs.schema)
    docs = docs.union(extra).union(odd)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        columns = docs.columns
        stage(spark, docs, f"{DATA}/sf0.001").write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs
        assert name == "packing" or docs.columns == columns
    first = {r.doc_id: r.text for r in seen["language_id"].collect()}
    assert not {20_000, 20_001, 20_002} & first.keys()
    groups = {}
    for i, t in first.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i))
    unique = {min(g)[1] for g in groups.values()}
    assert {r.doc_id for r in seen["exact_dedup"].collect()} == unique
    ids = sorted(unique)
    prints = [brute_print(first[i]) for i in ids]
    pairs = [(a, b) for a in range(len(ids)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 2]
    left = {ids[c] for c in components(len(ids), pairs)}
    assert {r.doc_id for r in seen["simhash_near_dedup"].collect()} == left
    clean = {r.doc_id: r.text for r in seen["pii"].collect()}
    assert clean.keys() == left and not any(pii_semicrf.base_spans(t) for t in clean.values())
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    tokens = Counter()
    for r in seen["packing"].collect():
        ids = tokenizer.encode(clean[r.doc_id], add_special_tokens=False).ids + [1]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]
        tokens[r.doc_id] += r.length
    assert tokens == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in clean.items()}


def test_run_and_empty(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).collect() == []
