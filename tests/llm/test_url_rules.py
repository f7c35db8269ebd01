import fnmatch
import re

import duckdb
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from riskview.llm.oracle import ORACLES
from riskview.llm.queries import BLOCK_GLOBS, URL_RULES
from riskview.llm.url_rules import Automaton, Rule, judge

URLS = [None, "", "no scheme", "http://", "https://a.org", "https://a.org/", "https://ORG/x", "http://x.Example.org/es/1?q=1",
        "http://example.org/en/12#top", "http://notexample.org/es/1", "http://example.org.evil.net/es/", "ftp://a.com/fr/",
        "http://a.com/fr", "http://a.com:80/fr/", "http://a.com/de/x/fr/", "http://b.net/?u=http://a.com/fr/",
        "http://b.net/.a.com/fr/", "http://spam-farm.net/x", "http://b.net/cheap-pills", "http://É.org/ü", "http://b.net/a.exe",
        "http://b.net/\x1f.org/", "http://a.org?x/", "x://y://z.org/es/", "http://b.net/" + "a" * 5000,
        "http://files.zippy.net/a", "http://b.net/a.exe/readme", "http://or\x1fg/x", "http://b.net/a.zip?x", "http://files.zip",
        "http://files.zip/", "http://a.casino", "http://b.net/x/.exe", "http://spam\x1f-a.net/", "http://b.net/a.ZIP#x", "x://.org/"]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.split("[/?#]", rest)[0])
    path = re.split("[?#]", rest)[0]
    path = path[path.index("/"):] if "/" in path else ""
    best = None
    for r in URL_RULES:
        h, _, p = r.pattern.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and \
                (best is None or len(r.pattern) > len(best.pattern)):
            best = r
    blocked = any(fnmatch.fnmatchcase(host + path, g) for g in BLOCK_GLOBS)
    return host, path, best and best.pattern, best.verdict if best else "block" if blocked else "allow"


def test_against_brute_force(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS + URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = {r["page_id"]: tuple(r)[1:] for r in judge(pages, URL_RULES, BLOCK_GLOBS).collect()}
    assert len(got) == len(rows)
    for i, u, _ in rows:
        assert got[i] == brute(u), u
    assert got[0] == ("", "", None, "allow")


def test_against_the_sql(spark):
    """The query's SQL on these URLs, none of which the given table holds."""
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLES['op10_url_rules']})").fetchall()
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    assert sorted(tuple(r) for r in judge(pages, URL_RULES, BLOCK_GLOBS).collect()) == sorted(want)


def test_globs_are_matched_as_written(spark):
    pages = spark.createDataFrame(list(enumerate(["http://a.net/b", "http://xa.net/b", "http://a.net/bc", "http://c.net/"])),
                                  "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in judge(pages, [], ["a.net/b", "c.net?"]).collect()}
    assert got == {0: "block", 1: "allow", 2: "allow", 3: "block"}


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in judge(pages, []).collect()] == [(1, "a.org", "/", None, "allow")]
    assert judge(pages.limit(0), URL_RULES).collect() == []


@settings(max_examples=200, deadline=None)
@cases(st.lists(st.text("ab*?", max_size=8), min_size=1, max_size=30), st.lists(st.text("abc", max_size=9), min_size=1, max_size=6))
def test_automaton_equals_fnmatch(globs, texts):
    got = Automaton([g.encode() for g in globs]).run([t.encode() for t in texts])
    assert got.tolist() == [[fnmatch.fnmatchcase(t, g) for g in globs] for t in texts]


def test_masks_span_several_words():
    globs = [b"x" * 70 + b"*", b"*" + b"y" * 200]
    got = Automaton(globs).run([b"x" * 70, b"x" * 69, b"zz" + b"y" * 200, b""])
    assert got.tolist() == [[True, False], [False, False], [False, True], [False, False]]


@pytest.mark.parametrize("pattern", ["a*b.org/", "a?b.org/"])
def test_rule_hosts_are_literal(pattern):
    machine = Automaton([Rule(pattern, "block").glob])
    host = pattern[:-1]
    assert machine.run([b".%s\xff/x" % host.encode(), b".axxb.org\xff/x"]).tolist() == [[True], [False]]
