import random
import re

import pytest

from millrace.llm import queries, url_automaton as U


def plain(glob):
    out, at = "", 0
    while at < len(glob):
        if glob.startswith("**", at):
            out, at = out + ".*", at + 2
        elif glob[at] == "\\":
            out, at = out + re.escape(glob[at + 1]), at + 2
        else:
            out, at = out + {"*": "[^/]*", "?": "[^/]"}.get(glob[at], re.escape(glob[at])), at + 1
    return re.compile(out, re.DOTALL)


def test_as_plain_globs_with_many_words_of_state():
    pick = random.Random(5)
    globs = ["".join(pick.choice(["a", "b", "/", ".", "*", "**", "?", "\\*", "ab"]) for _ in range(pick.randint(1, 9))) for _ in range(60)]
    machine = U.Automaton([U.Rule("block", None, g) for g in globs])
    assert machine.words > 3
    urls = ["".join(pick.choice("ab/.*") for _ in range(pick.randint(0, 14))) for _ in range(800)] + [""]
    taken = machine.run([u.encode() for u in urls])
    for i, url in enumerate(urls):
        for j, glob in enumerate(globs):
            assert taken[i, j] == bool(plain(glob).fullmatch(url)), (url, glob)


RULES = U.ordered([U.site_rule(v, r) for v, r in queries.SITES], [U.Rule(v, None, g) for v, g in queries.GLOBS])
CASES = [
    ("http://example.net/en/x?q#f", "example.net", "/en/x", "example.net/en/", "allow"),
    ("https://A.B.EXAMPLE.net/en/", "a.b.example.net", "/en/", "example.net/en/", "allow"),
    ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("http://x.net", "x.net", "", None, "allow"), ("http://net/", "net", "/", "net/", "block"),
    ("http://x.org/y.example.net/en/", "x.org", "/y.example.net/en/", None, "allow"),
    ("http://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"), ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
    ("http://a.ads.b/x", "a.ads.b", "/x", None, "block"), ("http://x.org/a.exe#z", "x.org", "/a.exe", None, "block"),
    ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("://", "", "", None, "allow"),
    ("x://h?a://b", "h", "", None, "allow"), ("http://É.net/é", "É.net", "/é", "net/", "block"),
    ("http://x.net/" + "long/" * 50_000 + "a.zip", "x.net", "/" + "long/" * 50_000 + "a.zip", "net/", "block"),
]


def test_judge(spark):
    df = spark.createDataFrame([(i, c[0], "x", "y") for i, c in enumerate(CASES)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df, RULES).collect()}
    assert [got[i] for i in range(len(CASES))] == [c[1:] for c in CASES]


def test_repeated_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.net/")] * 3 + [(None, None)], "page_id long, url string")
    assert U.judge(df, RULES).count() == 4 and U.judge(df.limit(0), RULES).collect() == []


def test_no_rules(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    with pytest.raises(ValueError):
        U.judge(df, [])
