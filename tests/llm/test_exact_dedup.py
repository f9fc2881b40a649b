import hashlib
import re

import pytest

from brute import docs
from edgeloom.llm import exact_dedup as E

TEXTS = ["a b c", "abc", "a  b\tc\n", None, "", " \x0b\x0c\r", "x", "X", "x" * 200_000, " " + "x" * 200_000, (3, "zz"), (3, "zz"), (None, "zz"), (None, "q"), "a b"]


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(data):
    groups = {}
    for i, t in data:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i if i is not None else 0, i))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("digest_chars", [64, 1])
def test_same_as_grouping_whole_texts(spark, digest_chars):
    """One hex digit as digest makes different texts meet: the byte check must part them."""
    df = docs(spark, TEXTS).withColumnRenamed("lang", "digest").withColumnRenamed("source", "stays")
    data = [(r.doc_id, r.text) for r in df.collect()]
    expect = brute(data)
    got = E.deduplicate(df, digest_chars=digest_chars).collect()
    sha = {hashlib.sha256(k.encode()).hexdigest(): k for k in expect}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in data)
    assert all((r.keep_id, r.group_size) == expect[sha[r.text_sha256]] for r in got)
    for k in expect:
        kept = [r for r in got if sha[r.text_sha256] == k and r.kept]
        assert len(kept) == 1 and kept[0].doc_id == expect[k][0]


def test_hot_group_is_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(E, "SALTS", 8)
    df = docs(spark, ["same text"] * 3000 + [f"t{i}" for i in range(500)]).repartition(6)
    got = E.deduplicate(df).collect()
    assert sum(r.kept for r in got) == 501 and max(r.group_size for r in got) == 3000


def test_stage_keeps_one_row_of_each_text(spark):
    df = docs(spark, TEXTS)
    kept = E.drop_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(norm(r.text) for r in kept.collect()) == sorted(brute([(r.doc_id, r.text) for r in df.collect()]))


def test_empty(spark):
    df = docs(spark, TEXTS).limit(0)
    assert E.deduplicate(df).collect() == [] and E.drop_duplicates(df).collect() == []


def test_state_goes_on_from_its_checkpoint(spark, tmp_path):
    schema = "digest string, n long, id long, file string, row long"
    spark.createDataFrame([("d1", 3, 5, "f", 0), ("d2", 1, 6, "f", 1)], schema).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    E.deduplicate_stream(stream(), f"{tmp_path}/state")
    spark.createDataFrame([("d1", 4, 9, "g", 0)], schema).write.mode("append").parquet(f"{tmp_path}/in")
    E.deduplicate_stream(stream(), f"{tmp_path}/state")
    held = {r.digest: (r.group_size, r.stays.id, r.stays.file) for r in E.read_state(spark, f"{tmp_path}/state").collect()}
    assert held == {"d1": (2, 9, "g"), "d2": (1, 6, "f")}
