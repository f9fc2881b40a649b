import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import docs
from conftest import DATA
from edgeloom.llm import language_id as L


def brute_bundle(text, dims, gram, seed=7):
    symbols = [0]
    for c in text.lower():
        v = ord(c) if c.isalpha() else 0
        if v or symbols[-1]:
            symbols.append(v)
    if symbols[-1]:
        symbols.append(0)
    out = np.zeros(dims)
    for i in range(len(symbols) - gram + 1):
        own = symbols[i : i + gram]
        if any(own):
            v = np.ones(dims)
            for k, code in enumerate(own):
                v = v * np.roll(L.letter_vector(code, dims, seed), gram - 1 - k)
            out += v
    return out


TEXTS = ["Hello world", None, "", "a", "!! 12", "Ünï 中文 x\x01y", "  b  c", "-1 x", "ΑΣ ß" * 40]


@pytest.mark.parametrize("gram", [2, 3, 4])
def test_bundles(gram, monkeypatch):
    for dense in (1 << 22, 1):
        monkeypatch.setattr(L, "DENSE_CODES", dense)
        got = L.Profiler(64, gram, 7).bundles(TEXTS)
        assert np.array_equal(got, np.stack([brute_bundle(t or "", 64, gram) for t in TEXTS]))


def test_long_texts_in_stretches(monkeypatch):
    text = "abcdefghij" * 7
    whole = brute_bundle(text, 32, 3)
    monkeypatch.setattr(L, "CHUNK", 16)
    parts = L.Profiler(32, 3, 7).bundles([text, "zz"])[0]
    assert np.dot(parts, whole) / np.linalg.norm(parts) / np.linalg.norm(whole) > 0.8


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    got = L.identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count(F.lit(1))).first()
    assert n > 200 and right > 0.97


def test_labels_and_ids_are_no_inputs(spark):
    df = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    held = L.fold() == 2
    other = df.withColumn("lang", F.when(held, F.lit("en")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = ({r.doc_id: r for r in L.identify(x).collect()} for x in (df, other))
    assert a == b


def test_defined_cases(spark):
    df = docs(spark, [*TEXTS, (0, "Hello world"), (None, "bonjour tout le monde")]).withColumn("score", F.lit(1)).withColumn("text_of", F.lit(1))
    got = L.identify(df).collect()
    assert len(got) == len(TEXTS) + 2
    by = {r.doc_id: r for r in got}
    assert by[1].lang_pred == by[2].lang_pred == by[4].lang_pred == "und" and by[4].score == 0 and by[0].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got)
    kept = L.drop_unidentified(df)
    assert kept.columns == df.columns and sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, 0, 0, 3, 5, 6, 7, 8]
    nolang = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(nolang).collect()} == {"und"}
    assert L.identify(df.limit(0)).collect() == [] and L.drop_unidentified(df.limit(0)).collect() == []


def test_rows_without_language_take_no_share(spark):
    texts = [f"the cat and the dog number {i}" if i % 2 else f"der hund und die katze nummer {i}" for i in range(40)] + [f"text {i}" for i in range(4000)]
    df = docs(spark, texts).withColumn("lang", F.when(F.col("doc_id") < 40, F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de")))
    assert set(L.learn(df, dims=64, train_rows=40)) == {"de", "en"}


def test_stage_keeps_lettered_texts_without_a_language(spark):
    df = docs(spark, ["Hello world", None, "12 !!", "", "中文"]).withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id for r in L.drop_unidentified(df).collect()) == [0, 4]


def test_rare_languages_and_copies(spark):
    common = [f"the cat and the dog number {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{i}" for i in range(3000)]
    rare = ["der hund und die katze", "le chien et le chat"]
    langs = F.when(F.col("doc_id") == 6000, "de").when(F.col("doc_id") == 6001, "fr").otherwise("en")
    plain = docs(spark, common + [(6000, rare[0]), (6001, rare[1])]).withColumn("lang", langs)
    copies = docs(spark, common + [(6000, rare[0]), (6001, rare[1])] + [(7000 + i, common[0]) for i in range(3000)]).withColumn("lang", langs)
    a, b = (L.learn(x, dims=64, train_rows=300) for x in (plain, copies))
    assert set(a) == {"de", "en", "fr"} and all(np.allclose(a[k], b[k]) for k in a)
    assert np.allclose(a["de"], L._unit(L.Profiler(64, 3, 7).bundles(rare[:1]))[0])


def test_shares():
    got = L.shares({"a": 10, "b": 10**6, "c": 10**9}, 1010)
    assert got["a"] == 1 and got["b"] * 10**6 == pytest.approx(500) and got["c"] * 10**9 == pytest.approx(500)
    assert min(n * 1000 for n in L.shares({str(i): 1000 for i in range(100)}, 100).values()) == L.LEAST_ROWS
