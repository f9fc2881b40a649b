import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from edgeloom.llm import conversation_repair as cr
from edgeloom.llm import queries

WS = "\x20\x09\x0a\x0b\x0c\x0d"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()[:16]


def plain(rows):
    """The report on rows (turn, role, text), copies written out, by trying all edits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1], r[2])))
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(WS)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def emits(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    @lru_cache(None)
    def best(i, state, inserted=0):
        options = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserted < 3:
            for role in "ua":
                if emits(state, role):
                    cost, audit = best(i, role, inserted + 1)
                    options.append((3 + cost, "I" + audit))
        if i < len(rows):
            cost, audit = best(i + 1, state)
            options.append((4 + cost, "D" + audit))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 * (faults[i] == "truncated")
                for edit, role, price in (("K", rows[i][1][:1], 0), ("R", "u", 3), ("R", "a", 3)):
                    if emits(state, role):
                        cost, audit = best(i + 1, role)
                        options.append((extra + price + cost, edit + audit))
        return min(options, default=(1 << 40, ""))

    cost, audit = best(0, "")
    out, at, state = [], 0, ""
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            out.append(rows[at][1:])
        else:
            role = "assistant" if state == "u" else "user"
            out.append((role, "" if edit == "I" else rows[at][2]))
        at += edit != "I"
        state = out[-1][0][0]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha), out


def damaged(rows):
    """What op11 does to (conv_id, turn, role, text) first."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out.setdefault(conv, []).extend([(turn, "user" if how == 4 else role, text)] * {0: 0, 3: 2}.get(how, 1))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, kinds string, _key string"


def some_rows(seed, conversations=60):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "User", "", "ubot", None, "tool"]
    texts = ["Yes.", "No", "Why?", "", " \t", "ok!\n", "Long text that ends.", None, "é…", "..."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.choice([0, 1, 2, 5, 9, 14])):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), role, f"t{turn}." if rng.random() < 0.5 else rng.choice(texts)))
    return rows + [(None, 2**60 + 1, "user", "Q?"), (None, None, "assistant", "A."), (None, 2**60 + 3, None, "x")]


def report(spark, rows, **more):
    df = spark.createDataFrame([(*r, "k", "x") for r in rows], SCHEMA)
    return {r[0]: tuple(r[1:]) for r in cr.report(cr.damage(df), copies_col="copies", **more).collect()}


@pytest.mark.parametrize("seed, bits", [(1, 13), (2, 1), (3, 0)])
def test_same_as_trying_all_edits(spark, monkeypatch, seed, bits):
    monkeypatch.setattr(cr, "SEGMENT", bits)  # segments of 8192, 2 and 1 rows
    rows = some_rows(seed)
    rows += [rows[5]] * 7
    got, want = report(spark, rows), {c: plain(r)[0] for c, r in damaged(rows).items()}
    assert got == want
    assert all(any(edit in v[6] for v in got.values()) for edit in "KRDI")


def test_repaired_rows(spark, monkeypatch):
    monkeypatch.setattr(cr, "SEGMENT", 2)
    rows = some_rows(4, 20)
    df = spark.createDataFrame([(*r, "k", "x") for r in rows], SCHEMA)
    got = {}
    for r in sorted(cr.repair(df).collect(), key=lambda r: (r.conv_id is None, r.conv_id, r.number)):
        got.setdefault(r.conv_id, []).append(r)
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, group in groups.items():
        want, out = plain(group)
        assert "".join(r.edit * r.copies for r in got[conv]) == want[6]
        assert [(r.role, r.text) for r in got[conv] if r.edit != "D"] == out


def test_long_conversation(spark, monkeypatch):
    """One conversation with most rows, cut into many segments over tasks; and one turn repeated very often."""
    monkeypatch.setattr(cr, "SEGMENT", 4)
    rng = random.Random(9)
    long = [(1, t, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice(["a.", "b", f"c{t}.", f"d{t}", ""])) for t in range(700)]
    rows = long + [(2, 0, "user", "x" * 300_000 + " " * 300_000)] + [(3, 5, "user", "same.")] * 5000 + [(3, 6, "assistant", "y.")]
    sys.setrecursionlimit(100_000)
    df = spark.createDataFrame([(*r, "k", "x") for r in rows], SCHEMA).repartition(5)
    got = {r[0]: tuple(r[1:]) for r in cr.report(df).collect()}
    want = plain([r[1:] for r in long])[0]
    assert got[1] == want
    assert got[3] == (0, 0, 4999, 0, 4999, 4999 * 4, "K" + "D" * 4999 + "K", hashlib.sha256(b"user:same.\nassistant:y.").hexdigest())
    assert got[2][5:7] == (6, "KI") or got[2][5:7] == (4, "D")


def test_checkpoints_choose_like_a_full_table():
    rng = random.Random(7)
    for n in (0, 1, 2, 3, 17, 90):
        kinds = bytes(rng.choice([0, 1, 2, 3, 5, 6, 16]) for _ in range(n))
        table = cr.passage(kinds)
        for state in range(4):
            edits = cr.choose(kinds, cr.FINAL, state)
            assert edits.replace("I", "").__len__() == n
            total, s = 0, state
            for edit, kind in _with_kinds(edits, kinds):
                total += {"I": 3, "D": 4, "K": 0, "R": 3}[edit] + (3 if kind is not None and edit in "KR" and kind & 4 else 0)
                s = s if edit == "D" else cr.KEPT[s][kind & 3] if edit == "K" else cr.NEXT[s]
            assert total + cr.FINAL[s] == min(table[4 * state + goal] + cr.FINAL[goal] for goal in range(4))


def _with_kinds(edits, kinds):
    at = 0
    for edit in edits:
        yield edit, None if edit == "I" else kinds[at]
        at += edit != "I"


def test_empty_table_and_query(spark, small):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.report(empty).collect() == [] and cr.repair(empty).collect() == []
    table = spark.read.parquet(f"{small}/conversations.parquet")
    got = {r[0]: tuple(r[1:]) for r in queries.op11_conversation_repair(spark, small).collect()}
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got == {c: plain(r)[0] for c, r in damaged(rows).items()}
