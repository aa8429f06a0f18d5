import numpy as np
import pytest

from millrace.llm import language_fusion as L

PAGES = "page_id long, url string, html string, lang string, score double"
WORDS = {"en": "the and with that this from have which", "de": "der und mit dass nicht eine werden sich", "fr": "le et avec que dans une pour qui"}


def text(lang, n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS[lang].split(), n))


@pytest.fixture
def docs(make, spark):
    from pyspark.sql import functions as F

    rows = [(i, text(lang, 60, i), lang) for i, lang in enumerate(["en", "de", "fr"] * 20)]
    return make(rows).withColumn("lang", F.col("source"))


def identify(spark, docs, rows):
    return {r.page_id: r for r in L.identify(spark.createDataFrame([(*r, None, None) for r in rows], PAGES), docs).collect()}


def page(body, lang=None):
    return f"<html{f' lang={lang}' if lang else ''}><script>der und nicht</script><body>{body}</body></html>"


def test_each_kind_of_evidence(spark, docs):
    rows = [(i, f"http://h{i % 4}.example.de/x", page(text("de", 30, i), "de")) for i in range(40)]
    rows += [(100 + i, f"http://f{i % 4}.example.fr/x", page(text("fr", 30, i), "fr")) for i in range(40)]
    rows += [
        (200, "http://h1.example.de/none", page("")), (201, "http://f1.example.fr/none", page("")),
        (202, None, page("", "fr")), (203, "http://new.test/en/", page("")), (204, None, None), (205, "http://h1.example.de/y", page(text("en", 60, 1))),
    ]
    got = identify(spark, docs, rows)
    assert all(got[i].lang == "de" and got[100 + i].lang == "fr" for i in range(40))
    assert (got[200].lang, got[201].lang, got[202].lang, got[203].lang, got[205].lang) == ("de", "fr", "fr", "en", "en")
    assert got[204].text_lang is None and 0 < got[204].probability < 1
    assert got[200].probability > got[204].probability


def test_posterior_against_plain_arithmetic(spark, docs):
    rows = [(i, f"http://{h}.site.test/{i}", page(text(lang, 3, i))) for i, (h, lang) in enumerate([("a", "en")] * 5 + [("a", "fr")] + [("b", "de")] * 4)]
    got = identify(spark, docs, rows)
    languages, table = L.fit(docs)
    own = {}
    for i, _, html in rows:
        logs = table[:, L.trigrams(L.visible(html))].sum(1) * L.TEXT_WEIGHT
        own[i] = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
    host = {i: url.split("/")[2] for i, url, _ in rows}
    for i in own:
        p = np.ones(3) / 3
        for same in (lambda j: True, lambda j: True, lambda j: host[j] == host[i]):  # all, site, host
            total = sum((own[j] for j in own if j != i and same(j)), np.zeros(3))
            p = (total + L.STRENGTH * p) / (total.sum() + L.STRENGTH)
        want = own[i] * p / (own[i] * p).sum()
        assert got[i].lang == languages[int(want.argmax())] and got[i].probability == pytest.approx(want.max(), rel=1e-6)


def test_no_language_is_left_out(spark, make):
    """More labels than two letters give, the last one in one document only."""
    from pyspark.sql import functions as F

    names = [f"{a}{b}-X{c}" for a in "abcdefg" for b in "hijklm" for c in "pqrstu"]
    rows = [(i, f"{name}word common {name}text", name) for i, name in enumerate(names * 2)] + [(999, "zzword zztext rare", "zz")]
    docs = make(rows).withColumn("lang", F.col("source"))
    languages, table = L.fit(docs)
    assert languages == sorted([*names, "zz"]) and table.shape == (253, L.BUCKETS)
    got = identify(spark, docs, [(1, "http://a.test/x", page("zzword zztext rare " * 5)), (2, "http://b.test/zz/", page(""))])
    assert (got[1].lang, got[1].text_lang, got[2].address, got[2].lang) == ("zz", "zz", "zz", "zz")


def test_repeated_rows_and_empty_tables(spark, docs, make):
    row = (1, "http://a.test/", page(text("en", 9, 1)))
    pages = spark.createDataFrame([(*row, None, None)] * 3, PAGES)
    assert L.identify(pages, docs).count() == 3
    assert L.identify(pages.limit(0), docs).collect() == [] and L.identify(pages, make([])).collect() == []
