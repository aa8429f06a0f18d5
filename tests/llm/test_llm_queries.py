"""The registered queries: against SQL, by brute force, and the pipeline."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import bpe_fst, exact_dedup, queries, simhash_anchor, toxicity_fm
from tools.compare import TABLES, compare


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.oracle()))
def test_values(spark, con, small, name):
    note, _, good = compare(spark, con, small, name, queries.registered()[name], queries.oracle()[name])
    assert good, note


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in queries.registered()] == [f"op{i}" for i in range(1, 1 + len(queries.registered()))]


@pytest.mark.parametrize("name", [n for n in queries.registered() if n not in queries.oracle()])
def test_one_row_per_document_or_page(spark, small, name):
    source = "pages" if name.startswith("op8") else "documents"
    key = "page_id" if name.startswith("op8") else "doc_id"
    want = sorted(r[0] for r in queries.table(spark, small, source).select(key).collect())
    assert sorted(r[0] for r in queries.registered()[name](spark, small).select(key).collect()) == want


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = queries.table(spark, folder, "labels").select("doc_id", "toxic")
    rows = queries.op1_toxicity_fm(spark, folder).where("held_out").join(labels, "doc_id").collect()
    hits = [r.predicted for r in rows if r.toxic]
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.005 * len(rows) and sum(hits) > 0.8 * len(hits)


def test_pipeline_stage_by_stage(spark, small, monkeypatch):
    seen = []

    def kept(name, stage):
        def wrapped(session, docs, folder):
            out = stage(session, docs, folder)
            seen.append((name, docs, out))
            return out

        return name, wrapped

    monkeypatch.setattr(corpus_pipeline, "STAGES", [kept(*s) for s in corpus_pipeline.STAGES])
    last = corpus_pipeline.run(spark, small)
    names, inputs, outputs = zip(*seen)
    documents = queries.table(spark, small, "documents")
    assert all(o.columns == documents.columns for o in outputs[:-1])
    rows = [sorted(d.collect()) for d in (*inputs, last.select("doc_id"))]
    machine = toxicity_fm.fit(documents, queries.table(spark, small, "labels"))
    score = toxicity_fm.scorer(machine)
    assert rows[1] == sorted(r for r in rows[0] if score([r.text])[0] < corpus_pipeline.TOXIC)
    last_of = {r.text: r for r in rows[1]}
    assert rows[2] == sorted(last_of.values())
    component = {r.doc_id: r.component_id for r in simhash_anchor.groups(inputs[2]).collect()}
    assert [r.doc_id for r in rows[3]] == sorted(set(component.values()))
    assert {r.doc_id for r in rows[4]} <= {r.doc_id for r in rows[3]} and len(rows[4]) == len(rows[5])
    text = {r.doc_id: r.text for r in rows[3]}
    tokens = bpe_fst.read_ranks(queries.RANKS)
    decoder = bpe_fst.Transducer(tokens, *bpe_fst.last_merges(tokens), queries.PATTERN)
    assert all("".join(decoder.decode([bytes(r.ids)])) == text[r.doc_id] for r in last.collect())


def test_pipeline_of_an_empty_table(spark, awkward, small):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for some in (docs, docs.limit(0)):
        step = some
        for _, stage in corpus_pipeline.STAGES:
            step = stage(spark, step, small)
        assert (step.count() > 0) == (some.count() > 0)


def test_last_stage_decodes_its_ids(spark, awkward):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    rows = corpus_pipeline.encode(spark, docs, "").collect()
    want = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect())
    assert sorted(r.decoded_sha256 for r in rows) == want


def test_digest_is_of_the_whole_text(spark, make):
    text = "a" * 3_000_000 + "b"
    (r,) = exact_dedup.groups(make([(1, text, "a")])).select(F.lower(F.hex("digest")).alias("d")).collect()
    assert r.d == hashlib.sha256(text.encode()).hexdigest()
