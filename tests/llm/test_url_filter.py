"""The wildcard automaton against regular expressions."""

import re

import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from feedworks.llm.url_filter import GlobAutomaton, filter_urls, match_globs

globs = st.text(alphabet="ab./*?", max_size=8)
urls = st.text(alphabet="ab./é", max_size=40)


def as_pattern(glob: str) -> re.Pattern:
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out += b"(?s:.*)".decode()
            i += 1
        elif glob[i] == "*":
            out += "[^/]*"
        elif glob[i] == "?":
            out += "[^/]"
        else:
            out += re.escape(glob[i])
        i += 1
    return re.compile(out.encode("utf-8"))


@settings(max_examples=500, deadline=None)
@example([""], ["", "a"])
@example(["a*b", "a?"], ["ab", "a", "axxb", "ax", "\x00", ""])
@given(st.lists(globs, min_size=1, max_size=30), st.lists(urls, max_size=20))
def test_matches_as_regular_expressions_do(rules, texts):
    found = GlobAutomaton(rules).match(pa.array(texts, pa.string()))
    for text, number in zip(texts, found):
        fits = [i for i, rule in enumerate(rules) if as_pattern(rule).fullmatch(text.encode())]
        assert number == (fits[-1] if fits else -1)


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "x.org/a"), ("allow", "x.org/b"), ("block", "q.org/*")]


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://A.NET/x", "a.net", "/x", "net/", "block"),
        ("http://net/", "net", "/", "net/", "block"),
        ("http://planet/", "planet", "/", None, "allow"),
        ("https://net?x=/", "net", "", None, "allow"),
        ("//example.net/en/1", "", "", None, "allow"),
        ("a://example.net/en/1?q#f", "example.net", "/en/1", "example.net/en/", "allow"),
        ("a://www.example.net/EN/1", "www.example.net", "/EN/1", "net/", "block"),
        ("a://b://example.net/en/", "b:", "//example.net/en/", None, "allow"),
        ("x://q.org/*y", "q.org", "/*y", "q.org/*", "block"),
        ("x://q.org/y", "q.org", "/y", None, "allow"),
        ("http://ÄB.net/é" + "x" * 100_000, "Äb.net", "/é" + "x" * 100_000, "net/", "block"),
        ("http://evil.com/a.net/b", "evil.com", "/a.net/b", None, "allow"),
        ("://\n.net/a\nb#", "\n.net", "/a\nb", "net/", "block"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ],
)
def test_verdicts(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, "old")], "page_id long, url string, rule string")
    row = filter_urls(df, RULES).first()
    assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule, verdict)


def test_equally_long_rules_and_no_rules(spark):
    df = spark.createDataFrame([("h://x.org/ab",)], "url string")
    rules = [("block", "x.org/a"), ("allow", "x.org/a")]
    assert filter_urls(df, rules).first()["verdict"] == "block"
    assert filter_urls(df, rules[::-1]).first()["verdict"] == "allow"
    assert filter_urls(df, [], default="block").first()["verdict"] == "block"
    assert filter_urls(df.limit(0), rules).count() == 0


def test_many_rules_need_many_words(spark):
    rules = [f"*.host{i}.org/**" for i in range(100)]
    assert GlobAutomaton(rules).words > 10
    df = spark.createDataFrame([(f".a.host{i}.org/x",) for i in range(100)], "url string")
    assert [r["rule_no"] for r in match_globs(df, "url", rules).collect()] == list(range(100))
