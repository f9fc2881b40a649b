import random
import re

import pytest
from pyspark.sql import functions as F

from edgeloom.llm import queries, url_filters
from edgeloom.llm.url_filters import Automaton, Policy, parse_glob
from parity import difference, duck


def as_regex(glob):
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + r"[\s\S]*", i + 2
            continue
        if glob[i] == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(glob[i])
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(glob[i], re.escape(glob[i]))
        i += 1
    return re.compile(out)


@pytest.mark.parametrize("seed", range(6))
def test_automaton_equals_regular_expressions(seed):
    rng = random.Random(seed)
    globs = ["".join(rng.choice(["a", "b", "/", "é", "*", "**", "?", "\\*", "."]) for _ in range(rng.randint(0, 9))) for _ in range(rng.choice([1, 7, 60]))]
    urls = ["".join(rng.choice("ab/é*.x🙂") for _ in range(rng.randint(0, 14))) for _ in range(300)]
    got = Automaton([parse_glob(g) for g in globs]).match(urls)
    for p, glob in enumerate(globs):
        regex = as_regex(glob)
        assert [bool(regex.fullmatch(u)) for u in urls] == got[:, p].tolist(), glob


def test_few_and_very_long_urls():
    automaton = Automaton([parse_glob("**b/end"), parse_glob("*"), parse_glob("a" * 200 + "**")])
    assert automaton.words > 1
    long = "a" * 1_000_000
    assert automaton.match([long, long + "b/end", ""]).tolist() == [[False, True, True], [True, False, True], [False, True, False]]
    assert automaton.match([]).shape == (0, 3)


URLS = [
    ("http://WWW.Example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    ("https://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
    ("https://example.com?x=/en/", "example.com", "", None, "allow"),
    ("https://example.com#/en/", "example.com", "", None, "allow"),
    ("x://y.net/es/2?q#f", "y.net", "/es/2", "net/es/", "block"),
    ("x://net/fr/", "net", "/fr/", "net/fr/", "block"),
    ("x://evil.org/x.example.com/en/1", "evil.org", "/x.example.com/en/1", None, "allow"),
    ("x://cheap-pills.org/", "cheap-pills.org", "/", None, "block"),
    ("http://a.org/\u212a://b.com/", "a.org", "/\u212a://b.com/", None, "allow"),
    ("X://É.NET/ES/", "É.net", "/ES/", None, "allow"),
    ("no scheme.com/en/", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("http://h.org/" + "p/" * 300_000, "h.org", "/" + "p/" * 300_000, None, "allow"),
    ("a://b\nc.com/\n?", "b\nc.com", "/\n", "com/", "allow"),
]


def test_rules(spark):
    rows = [(i, u[0], "h", "p", "r") for i, u in enumerate(URLS)] + [(0, URLS[0][0], None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, path string, rule string")
    got = url_filters.filter_urls(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == URLS[-3 if r.page_id is None else r.page_id][1:] or r.page_id is None
    assert url_filters.filter_urls(df.limit(0)).collect() == []
    kept = url_filters.keep_allowed(df).collect()
    assert sum(r.verdict == "allow" for r in got) == len(kept) and kept[0].host == "h"


def test_no_rules_and_ties(spark):
    df = spark.createDataFrame([(1, "a://x.y/z")], "page_id long, url string")
    assert url_filters.filter_urls(df, policy=Policy((), (), "block")).first().verdict == "block"
    tie = Policy((("x.y", "/", "allow"), ("x.y", "/", "block")), ())
    assert url_filters.filter_urls(df, policy=tie).first().verdict == "block"


def test_oracle_and_plan(spark, small):
    df = queries.op12_url_filters(spark, small)
    assert difference(df, duck(small), queries.SQL["op12_url_filters"]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "html" not in plan
