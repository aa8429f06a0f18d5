"""Language identification of web pages by Bayesian evidence fusion.

Four kinds of evidence give a log-probability for each language, and add up:

* the visible text: naive Bayes over hashed character trigrams, learned from
  labelled documents (``fit_rows`` of each language at most, drawn by a hash
  of the id; the documented bound). Trigrams overlap, so their sum counts with
  ``TEXT_WEIGHT``;
* the language the markup declares (``lang`` of the html element);
* the address: a language as a folder of the path or as the last label of the
  host;
* the host: how the languages of its other pages are spread. Counts are sums
  of the pages' own evidence, grouped by host, site (last two labels) and over
  all, and smoothed from the whole to the site to the host, each level adding
  ``STRENGTH`` pages of the level above. A page's own share is taken out of
  all levels, so it never confirms itself.

How far a declaration or an address is to be believed is itself counted: the
share of pages on which it agrees with what the text says, over all pages.

Defined results: null html or url gives no evidence of its kind, and a page
without any gets the overall prior; equal posteriors go to the first language
in order; null hosts count as one host; without labelled documents there are
no languages and the result is empty; repeated rows count each.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import map_texts, whole_text
from millrace.session import materialize

BUCKETS = 1 << 15
TEXT_WEIGHT = 0.2
STRENGTH = 4.0

HIDDEN = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->")
TAG = re.compile(r"(?s)<[^>]*>")
LETTERS = re.compile(r"[^\W\d_]+")


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the text's letters, a blank around each word."""
    codes = np.frombuffer((" " + " ".join(LETTERS.findall(text.lower())) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1] * np.uint64(0x85EBCA77) + codes[2:] * np.uint64(0xC2B2AE3D)
    return ((mixed ^ (mixed >> np.uint64(15))) % np.uint64(BUCKETS)).astype(np.int64)


def visible(page: str) -> str:
    return html.unescape(TAG.sub(" ", HIDDEN.sub(" ", page)))


def declared(page: Column) -> Column:
    """The primary language subtag of the html element, in lower case; null where there is none."""
    found = F.lower(F.regexp_extract(page, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})\b""", 1))
    return F.when(found != "", found)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def addressed(url: Column, languages: list[str]) -> Column:
    """A language named by a folder of the path or the host's last label; null where there is none."""
    path = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1))
    names = "|".join(map(re.escape, languages))
    folder = F.regexp_extract(path, f"/({names})(?:/|$)", 1)
    suffix = F.regexp_extract(host_of(url), f"\\.({names})(?::\\d+)?$", 1)
    return F.when(folder != "", folder).when(suffix != "", suffix)


def fit(docs: DataFrame, language: str = "lang", key: str = "doc_id", text: str = "text", fit_rows: int = 500) -> tuple[list[str], np.ndarray]:
    """All labelled languages, and log P(trigram | language) as an array. Counts
    are summed as a table of at most ``BUCKETS`` rows per language; the array
    takes a quarter of a MB a language on the driver and in each worker."""
    sizes = {r[0]: r[1] for r in docs.where(F.col(language).isNotNull()).groupBy(language).count().collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((0, BUCKETS))
    names, shares = F.lit(languages), F.lit([min(1.0, fit_rows / sizes[name]) for name in languages])
    share = F.try_element_at(F.map_from_arrays(names, shares), F.col(language))
    drawn = docs.where(F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1 << 20)) < share * (1 << 20)).select(F.col(language).alias("lang"), whole_text(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[name] = sums.get(name, 0) + np.bincount(trigrams(body), minlength=BUCKETS)
        for name, counts in sums.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(used), "bucket": used, "n": counts[used]})

    table = drawn.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(languages), BUCKETS))
    at = {name: i for i, name in enumerate(languages)}
    rows = [at[x] for x in table["lang"].to_pylist()]
    counts[rows, table["bucket"].to_numpy()] = table["n"].to_numpy()
    return languages, np.log((counts + 0.1) / (counts.sum(1, keepdims=True) + 0.1 * BUCKETS))


def softmax(logs: Column, count: int) -> Column:
    """Probabilities from an array of log-probabilities."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def named(name: str, agreed: float, count: int, languages: list[str]) -> Column:
    """Log-likelihoods of a named language, believed with probability ``agreed``."""
    other = math.log(max(1e-6, (1 - agreed) / max(1, count - 1)))
    vector = F.transform(F.lit(languages), lambda l: F.when(F.col(name) == l, math.log(agreed)).otherwise(other))
    return F.when(F.col(name).isin(languages), vector).otherwise(F.array_repeat(F.lit(0.0), count))


def identify(pages: DataFrame, docs: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key``, host, declared, address, text_lang, lang and probability of each page."""
    languages, table = fit(docs)
    kind = pages.schema[key].dataType.simpleString()
    if not languages:
        return pages.sparkSession.createDataFrame([], f"`{key}` {kind}, host string, declared string, address string, text_lang string, lang string, probability double")
    count = len(languages)
    sent = pages.sparkSession.sparkContext.broadcast(table)  # BUCKETS x languages numbers

    def rows(texts: list[str]) -> dict[str, list]:
        logs = []
        for body in texts:
            at = trigrams(visible(body))
            logs.append(sent.value[:, at].sum(1) * TEXT_WEIGHT if len(at) else np.zeros(count))
        return {"text_logs": [(x - x.max()).tolist() for x in logs]}

    facts = pages.select(
        F.col(key).alias("_key"), host_of(F.col(url)).alias("host"), declared(F.col(page)).alias("declared"),
        addressed(F.col(url), languages).alias("address"), F.col(page).alias("_page"),
    )
    read = materialize(map_texts(facts, ["_key", "host", "declared", "address"], "_page", rows, "text_logs array<double>"))
    best = F.element_at(F.array(*map(F.lit, languages)), F.array_position("text_logs", F.array_max("text_logs")).cast("int"))
    told = read.withColumn("text_lang", F.when(F.array_min("text_logs") < 0, best))
    rates = told.agg(*[
        ((F.count_if(F.col(c) == F.col("text_lang")) + 1) / (F.count_if(F.col(c).isin(languages) & F.col("text_lang").isNotNull()) + 2)).alias(c)
        for c in ("declared", "address")
    ]).first()
    trusted = {c: min(0.99, max(rates[c], 1 / count)) for c in ("declared", "address")}
    own = told.withColumn("own_logs", sum_arrays(
        F.col("text_logs"), named("declared", trusted["declared"], count, languages), named("address", trusted["address"], count, languages)
    )).withColumn("own", softmax(F.col("own_logs"), count)).withColumn("site", F.regexp_extract("host", r"([^.]+\.[^.]+|[^.]*)$", 1))
    own = materialize(own)
    summed = lambda by, name: own.groupBy(*by).agg(F.array(*[F.sum(F.col("own")[i]) for i in range(count)]).alias(name))
    whole = summed([], "all_sum").first()
    everything = F.array(*[F.lit(float(x or 0.0)) for x in (whole.all_sum or [])])
    joined = own.join(summed(["host"], "host_sum"), "host").join(summed(["site"], "site_sum"), "site")

    def less(total: Column) -> Column:
        return F.zip_with(total, F.col("own"), lambda t, o: F.greatest(t - o, F.lit(0.0)))

    def smoothed(total: Column, above: Column) -> Column:
        return F.zip_with(
            total, above, lambda t, p: (t + STRENGTH * p) / (F.aggregate(total, F.lit(0.0), lambda a, x: a + x) + STRENGTH)
        )

    flat = F.array(*[F.lit(1.0 / count)] * count)
    prior = joined.withColumn("all_p", smoothed(less(everything), flat)).withColumn("site_p", smoothed(less(F.col("site_sum")), F.col("all_p")))
    prior = prior.withColumn("host_p", smoothed(less(F.col("host_sum")), F.col("site_p")))
    fused = prior.withColumn("posterior", softmax(F.zip_with("own_logs", "host_p", lambda l, p: l + F.log(p)), count))
    top = F.array_max("posterior")
    return fused.select(
        F.col("_key").alias(key), "host", "declared", "address", "text_lang",
        F.element_at(F.array(*map(F.lit, languages)), F.array_position("posterior", top).cast("int")).alias("lang"), top.alias("probability"),
    )


def sum_arrays(*arrays: Column) -> Column:
    out = arrays[0]
    for more in arrays[1:]:
        out = F.zip_with(out, more, lambda a, b: a + b)
    return out
