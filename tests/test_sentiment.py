import math
import re

import pytest

from millrace.operators import sentiment
from millrace.streaming import reviews as stream

LEXICON = {"good": 1.9, "great": 3.1, "bad": -2.5, "slow": -1.2, "ótimo": 2.0}
NEGATIONS = ("not", "never")
TEXTS = [
    ("1", "Great!", "good product, not bad"),
    ("2", None, "never ever so good. Slow."),
    ("3", None, None),
    ("4", "  ", ""),
    ("5", "nothing known", "here"),
    ("6", "ÓTIMO", "not at all in any way good"),
]


def brute(title, message):
    words = re.findall(r"[^\W\d_']+(?:'[^\W\d_]+)*", f"{title or ''} {message or ''}".strip().lower())
    total = 0.0
    for i, word in enumerate(words):
        weight = LEXICON.get(word, 0.0)
        total += weight * (-0.74 if any(w in NEGATIONS for w in words[max(0, i - 3):i]) else 1)
    return total / math.sqrt(total * total + 15)


def frames(spark):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "token string, weight double")
    rows = spark.createDataFrame([(*t, None) for t in TEXTS], "review_id string, title string, message string, sentiment_score decimal(5,4)")
    return rows, lexicon


def test_scores_equal_brute_force(spark):
    rows, lexicon = frames(spark)
    got = {r[0]: float(r[1]) for r in sentiment.sentiment_score(rows, lexicon, NEGATIONS).collect()}
    assert set(got) == {t[0] for t in TEXTS}
    for key, title, message in TEXTS:
        assert got[key] == pytest.approx(brute(title, message), abs=5e-5)
    assert got["3"] == 0.0 and got["4"] == 0.0


def test_scores_do_not_depend_on_the_join(spark):
    rows, lexicon = frames(spark)
    want = sorted(sentiment.sentiment_score(rows, lexicon, NEGATIONS).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(sentiment.sentiment_score(rows, lexicon, NEGATIONS).collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_backfill_keeps_old_scores(spark):
    rows, lexicon = frames(spark)
    old = spark.createDataFrame([("1", 0.5)], "review_id string, s double").selectExpr("review_id", "CAST(s AS DECIMAL(5,4)) AS sentiment_score")
    merged = sentiment.sentiment_backfill(rows, lexicon, old, NEGATIONS)
    got = {r["review_id"]: float(r["sentiment_score"]) for r in merged.collect()}
    assert got["1"] == 0.5 and len(got) == 6
    assert sentiment.scored_count(merged).first()["scored"] == 6
    spread = sentiment.sentiment_distribution(merged).first()
    assert spread["positive"] + spread["neutral"] + spread["negative"] == 6


def test_stream_scores_each_file_once(spark, tmp_path):
    rows, lexicon = frames(spark)
    source, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for part in (rows.filter("review_id < '4'"), rows.filter("review_id >= '4'")):
        part.write.mode("append").parquet(source)
        stream.score_new_reviews(spark, source, target, check, lexicon, NEGATIONS)
    got = sorted(stream.read_scores(spark, target).collect())
    assert got == sorted(sentiment.sentiment_score(rows, lexicon, NEGATIONS).collect())
