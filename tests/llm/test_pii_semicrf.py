import hashlib
import random
import re
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import docs
from conftest import DATA
from edgeloom.llm import pii_semicrf as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        total += (2 * v - 9 if v > 4 else 2 * v) if i % 2 else v
    return total % 10 == 0


def brute(t):
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def test_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("ab@.+-% 0123459()é\n") for _ in range(rng.randint(0, 60)))
        assert P.base_spans(t) == brute(t), t


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000, "1.1." * 50_000, "a@" * 50_000, "+1 " * 50_000, "0 " * 100_000, "(at)" * 20_000])
def test_long_runs_take_linear_time(text):
    P.find_spans(text, np.zeros((4, P.N_FEATURES)) - 1)


@pytest.fixture(scope="module")
def weights(spark):
    return P.learn(spark.read.parquet(f"{DATA}/sf0.1/documents.parquet"))


def test_best_path_is_the_best_of_all(weights):
    text = "to (504) 555-2652, bob (at) example.com 4539 1488 0343 6467 10.0.0.1 +1 (504) 555-2652"
    lattice = P.Lattice.of(text, 0, len(text))
    score = (lattice.x @ weights.T).max(1)

    def best(k):
        return 0.0 if not k else max(best(k - 1), best(lattice.before[k - 1]) + score[k - 1])

    own = {s: i for i, s in enumerate(lattice.segments)}
    path = P.best_path(lattice, weights)
    assert sum(score[own[s, e]] for s, _, e in path) == pytest.approx(best(min(len(score), 18))) or len(score) > 18
    assert all(a[2] <= b[0] for a, b in zip(path, path[1:]))


def test_gradient_raises_the_likelihood():
    windows = ["x +1 (504) 555-2652 y", "q 4539148803436467 r", "n 3963522770391943 m", "a.b@c.de f", "1.2.3.4 1.2.3.999"]
    examples = P.examples_of(windows)
    trained = P.train(examples)
    for lattice, gold in examples:
        assert {(s, e) for s, _, e in P.best_path(lattice, trained)} == set(gold) & set(lattice.segments)


def test_finds_other_ways_of_writing(weights):
    found = lambda t: [(P.KINDS[k], t[s:e]) for s, k, e in P.find_spans(t, weights)[1]]
    assert found("call (504) 555-2652 now") == [("phone", "(504) 555-2652")]
    assert found("mail bob (at) example.com, ok") == [("email", "bob (at) example.com")]
    assert found("id 3963522770391943 v 1.2.3.999, 2024-01-02") == []


def test_rows(spark):
    texts = ["é x@y.zz 🙂 10.0.0.1", None, "", "clean words only", "+1 (504) 555-2652", (0, "é x@y.zz 🙂 10.0.0.1"), (None, "z@z.zz")]
    df = docs(spark, texts).withColumn("spans", F.lit(1)).withColumnRenamed("lang", "found")
    got = P.scan(df).collect()
    assert len(got) == len(texts)
    for r in got:
        text = {0: texts[0], None: "z@z.zz"}.get(r.doc_id, texts[r.doc_id or 0]) or ""
        base = brute(text)
        assert r.base_sha256 == hashlib.sha256(P.listed(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(filter(None, P.listed(base).split(","))) <= set(r.spans.split(","))
    assert P.scan(df.limit(0)).collect() == []


def test_redaction(spark):
    df = docs(spark, ["to x@y.zz, 10.0.0.1", None, "clean", "4539148803436467@a.bc"])
    got = {r.doc_id: r for r in P.redact(df).collect()}
    assert P.redact(df).columns == df.columns
    assert (got[0].text, got[0].n_chars) == ("to [email], [ip]", 16) and got[1].text is None and got[2].text == "clean"
    assert got[3].text == "[email]"
    assert P.redact(df.limit(0)).collect() == []


def test_rare_entities_teach(spark):
    rare = ["mail a.b@c.de now", "call +1 (504) 555-2652 now", "on 10.0.0.1 now", "card 4539148803436467 now"]
    texts = [f"in {1500 + i % 500} there were {i} items\nand {20240000 + i} more" for i in range(20_000)] + rare
    learned = P.learn(docs(spark, texts))
    found = lambda t: [(P.KINDS[k], t[s:e]) for s, k, e in P.find_spans(t, learned)[1]]
    assert found("mail bob (at) example.com ok") == [("email", "bob (at) example.com")]
    assert found("call (504) 555-2652 ok") == [("phone", "(504) 555-2652")]
    assert found("in 1999 there were 12345678 items") == []
    assert P.learn(docs(spark, texts[:50])) is None


def test_weights_of_strata():
    assert P.quotas({0: 900, 1: 10, 2: 800}, 1000) == {1: 10, 2: 495, 0: 495}
    got = P.raised({0: 10**9, 1: 1, 2: 10**9})
    assert got[1] == pytest.approx(0.1) and got[0] == got[2] == pytest.approx(0.45)


@pytest.mark.parametrize(
    "text",
    ["tel:{}", "phone=({a}) {b}", "name,{},city", "x|{}|y", "<p>{}</p>", "call;{};", '{{"name":"x","phone":"{}","n":1}}', '<a href="tel:{}">', "id," + "abc," * 30 + "{},1", "[{}]"],
)
def test_entities_inside_tokens(weights, text):
    phone = "(504) 555-2652" if "{a}" in text else "555-123-4567"
    text = text.format(phone, a="504", b="555-2652")
    assert [(P.KINDS[k], text[s:e]) for s, k, e in P.find_spans(text, weights)[1]] == [("phone", phone)]


def test_spelt_email_inside_tokens(weights):
    for text in ("mailto:bob(at)example.com", "a,bob(at)example.com,b", '{"mail":"bob (at) example.com","n":1}'):
        (s, k, e) = P.find_spans(text, weights)[1][0]
        assert (P.KINDS[k], text[s:e].replace(" ", "")) == ("email", "bob(at)example.com")
    assert P.find_spans("2024-01-02T10:20:30,17,1234567,19", weights)[1] == []


def test_stretches_decide_as_the_whole(weights, monkeypatch):
    rng = random.Random(8)
    parts = ["1000000", "555-123-4567", "(504) 555-2652", "4111.1111.1111.1111", "bob[at]example.com", "a@b.co", "x", "name,", "((", "tel:", "1.2.3.4", "9" * 70, "+1", "|", "2024"]
    whole = []
    texts = ["".join(rng.choice(parts) + rng.choice([" ", " ", ",", ";", ""]) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    for text in texts:
        whole.append(P.best_path(P.Lattice.of(text, 0, len(text)), weights))
        assert P.entities(text, 0, len(text), weights) == whole[-1]
    assert sum(map(len, whole)) > 50
    for stretch in (1, 7, 64, 130):
        monkeypatch.setattr(P, "STRETCH", stretch)
        for text, want in zip(texts, whole):
            assert P.entities(text, 0, len(text), weights) == want


def test_very_long_islands_in_linear_time_and_flat_memory(weights):
    took, peak = [], []
    for n in (5_000, 10_000, 20_000):
        text = " ".join(str(1_000_000 + i) for i in range(n)) + "|" + ",".join(str(2_000_000 + i) for i in range(n))
        tracemalloc.start()
        begun = time.process_time()
        P.entities(text, 0, len(text), weights)
        took.append(time.process_time() - begun)
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert took[2] < 6 * took[0] and peak[2] < peak[0] + 3_000_000, (took, peak)
