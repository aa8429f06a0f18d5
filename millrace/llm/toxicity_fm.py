"""Toxicity by a factorization machine over hashed terms.

A text is a set of hashed terms: its lower-case words and their first four to
six letters, which stand for the forms of a word. Its logit is a bias, one
weight per term, and the dot product of the factors of each pair of terms, so
a pair (an insult and a group) can weigh more or less than its two words.

Fitting uses at most about ``max_rows`` labelled rows, drawn by a hash of the
id, the documented bound. Their terms are counted as a table; terms whose
share differs clearly between the labels (``min_rows`` rows, ``min_z``
standard errors), ``max_terms`` at most, enter the model, and so do the terms
of pairs, among the ``max_paired`` most frequent, whose rows tell the labels
apart where the sum of both terms' shares does not. All else covers every row:
each whole text is scored where the scan reads it.

Defined results: a null text is the empty text and scores as the bias alone;
labels that are null are not used, and of several labels of one id the
highest counts; without labelled rows every score is 0; an empty table gives
an empty result; repeated rows score alike.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import map_texts, whole_text
from millrace.session import materialize

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
WORDS = re.compile(r"[^\W_]+")


def words(text: str) -> set[str]:
    return set(WORDS.findall(text.lower()))


def buckets(word: str) -> list[int]:
    """Of the word and, where it is longer, of its beginnings."""
    terms = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]
    return [zlib.crc32(t.encode()) % BUCKETS for t in terms]


@dataclass(frozen=True)
class Machine:
    """Bias, and for each kept bucket its weight and factors."""

    bias: float
    place: dict[int, int]
    weights: np.ndarray
    factors: np.ndarray

    def logit(self, rows: list[list[int]]) -> np.ndarray:
        """The logits of rows of places."""
        counts = np.array([len(r) for r in rows])
        row = np.repeat(np.arange(len(rows)), counts)
        at = np.array([i for r in rows for i in r], np.int64)
        summed = np.zeros((len(rows), self.factors.shape[1]))
        np.add.at(summed, row, self.factors[at])
        squares = np.bincount(row, (self.factors[at] ** 2).sum(1), len(rows))
        linear = np.bincount(row, self.weights[at], len(rows))
        return self.bias + linear + 0.5 * ((summed**2).sum(1) - squares)


def train(rows: list[list[int]], labels: np.ndarray, place: dict[int, int], factors: int = 8, epochs: int = 20,
          batch: int = 512, rate: float = 0.3, decay: float = 1e-4, seed: int = 1) -> Machine:
    """A machine fitted by AdaGrad on the logistic loss. ``rows`` hold places of terms."""
    random = np.random.default_rng(seed)
    share = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
    bias, n = float(np.log(share / (1 - share))), len(place)
    w, v = np.zeros(n), random.normal(0, 0.05, (n, factors))
    w_past, v_past, b_past = np.full(n, 1e-2), np.full((n, factors), 1e-2), 1e-2
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for lo in range(0, len(rows), batch):
            some = order[lo : lo + batch]
            machine = Machine(bias, place, w, v)
            picked = [rows[i] for i in some]
            error = 1 / (1 + np.exp(-machine.logit(picked))) - labels[some]
            row = np.repeat(np.arange(len(some)), [len(r) for r in picked])
            at = np.array([i for r in picked for i in r], np.int64)
            summed = np.zeros((len(some), factors))
            np.add.at(summed, row, v[at])
            w_step, v_step = np.bincount(at, error[row], n) / len(some) + decay * w, np.zeros((n, factors))
            np.add.at(v_step, at, error[row][:, None] * (summed[row] - v[at]) / len(some))
            v_step += decay * v
            b_step = error.mean()
            w_past, v_past, b_past = w_past + w_step**2, v_past + v_step**2, b_past + b_step**2
            w, v = w - rate * w_step / np.sqrt(w_past), v - rate * v_step / np.sqrt(v_past)
            bias -= rate * b_step / np.sqrt(b_past)
    return Machine(bias, place, w, v)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
        max_rows: int = 20_000, min_rows: int = 5, min_z: float = 5.0, max_terms: int = 4096,
        max_paired: int = 512) -> Machine | None:
    """A machine from the labelled documents, or None without any. The driver
    gets candidate terms and, of the bounded sample, which of them a row has:
    no text. The same labelled rows give the same machine, however they lie in files."""
    known = labels.where(F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("double").alias("_label"))
    labelled = known.count()
    if not labelled:
        return None
    share = min(1.0, max_rows / labelled)
    drawn = known.where(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # max_rows bounds this side, so the texts need no shuffle
    chosen = docs.select(key, text).join(F.broadcast(drawn), key).select("_label", text)

    def hashed(texts: list[str]) -> dict[str, list]:
        return {"_terms": [sorted({b for w in words(x) for b in buckets(w)}) for x in texts]}

    rows = materialize(map_texts(chosen, ["_label"], text, hashed, "_terms array<long>"))
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("p")).first()
    if not totals.n:
        return None
    share = totals.p / totals.n
    counted = rows.select("_label", F.explode("_terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_label").alias("p")
    )
    z = F.abs(F.col("p") - F.col("n") * share) / F.sqrt(F.col("n") * max(share * (1 - share), 1e-9))
    kept = [
        r.term for r in counted.where(F.col("n") >= min_rows).withColumn("z", z).where(F.col("z") >= min_z)
        .orderBy(F.desc("z"), "term").limit(max_terms).collect()
    ]
    often = [
        r.term for r in counted.where((F.col("n") >= min_rows) & (F.col("n") < totals.n))
        .orderBy(F.desc("n"), "term").limit(max_paired).collect()
    ]
    found = sorted({*kept, *often})
    sample = rows.mapInArrow(_only(set(found)), "_label double, _terms array<long>").toArrow()
    has = [np.searchsorted(found, r).tolist() for r in sample["_terms"].to_pylist()]
    order = sorted(range(len(has)), key=lambda i: (has[i], sample["_label"][i].as_py()))
    has, told = [has[i] for i in order], sample["_label"].to_numpy()[order]
    paired = telling_pairs(has, told, np.searchsorted(found, sorted(often)), min_z)
    chosen_terms = sorted({*kept, *(found[i] for i in paired)})
    place = {term: i for i, term in enumerate(chosen_terms)}
    if not place:
        return Machine(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), {}, np.zeros(0), np.zeros((0, 1)))
    at = {i: place[term] for i, term in enumerate(found) if term in place}
    return train([[at[i] for i in r if i in at] for r in has], told, place)


def telling_pairs(rows: list[list[int]], labels: np.ndarray, often: np.ndarray, min_z: float,
                  min_variance: float = 5.0, block: int = 2048) -> set[int]:
    """Of the terms ``often``, those in a pair whose rows' share of labels is
    ``min_z`` standard errors away from what both terms' own shares add up to.
    Pairs of which one term never comes without the other say nothing new."""
    column = {int(term): i for i, term in enumerate(often)}
    n, p = np.zeros((len(often), len(often))), np.zeros((len(often), len(often)))
    for lo in range(0, len(rows), block):
        some = rows[lo : lo + block]
        is_in = np.zeros((len(some), len(often)), np.float32)
        for i, row in enumerate(some):
            is_in[i, [column[t] for t in row if t in column]] = 1
        n += is_in.T @ is_in
        p += is_in.T @ (is_in * labels[lo : lo + block, None].astype(np.float32))
    share, single = labels.mean(), np.diag(n)
    own = np.diag(p) / np.maximum(single, 1)
    added = np.clip(own[:, None] + own[None, :] - share, 0, 1)
    variance = n * share * (1 - share)
    clear = (np.abs(p - n * added) >= min_z * np.sqrt(variance)) & (variance >= min_variance)
    clear &= n < np.minimum(single[:, None], single[None, :])
    return {int(often[i]) for i in np.flatnonzero(clear.any(1))}


def _only(place: set[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [[t for t in r if t in place] for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"_label": batch.column(0), "_terms": pa.array(kept, pa.list_(pa.int64()))})

    return run


def scorer(machine: Machine | None, remembered: int = 200_000) -> Callable[[list[str]], np.ndarray]:
    """A function from texts to scores. A worker remembers the places of
    ``remembered`` words at most, then begins anew."""
    places: dict[str, tuple[int, ...]] = {}

    def score(texts: list[str]) -> np.ndarray:
        if machine is None:
            return np.zeros(len(texts))
        rows = []
        for text in texts:
            if len(places) > remembered:
                places.clear()
            found: set[int] = set()
            for word in words(text):
                at = places.get(word)
                if at is None:
                    at = places[word] = tuple(machine.place[b] for b in buckets(word) if b in machine.place)
                if at:
                    found.update(at)
            rows.append(sorted(found))
        return 1 / (1 + np.exp(-machine.logit(rows)))

    return score


def score_texts(docs: DataFrame, machine: Machine | None, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``score`` of each whole text."""
    score = scorer(machine)
    return map_texts(docs, keys, text, lambda texts: {"score": score(texts)}, "score double")


def score_column(machine: Machine | None, text: str = "text") -> Column:
    """The score as a column, to filter whole rows by."""
    score = scorer(machine)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(score(texts.to_pylist()), pa.float64())

    return run(whole_text(text))


def remainder(key: str = "doc_id") -> Column:
    """The crc32 of the id as text, modulo 5; 0 marks rows held out of fitting."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5
