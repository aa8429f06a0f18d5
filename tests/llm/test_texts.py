from datetime import date

import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import source_mix, texts


def batch_sizes(spark):
    """Bytes of the Arrow batches that one task gets of 4,000 texts of 10,000 letters."""
    wide = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("abcdefghij"), 1000).alias("text"))
    run = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches)
    return [r.n for r in wide.mapInArrow(run, "n long").collect()]


def test_batches_are_bounded_in_bytes(spark, make):
    before = spark.conf.get(texts.BATCH)
    try:
        spark.conf.unset(texts.BATCH)
        texts.map_texts(make([(1, "a", "s")]), ["doc_id"], "text", lambda some: {"n": [len(t) for t in some]}, "n int")
        sizes = batch_sizes(spark)
        assert sum(sizes) > 40_000_000 and max(sizes) < 1.1 * texts.SLICE
        for own, kept in (("1m", "1m"), ("4k", "4k"), ("1g", f"{texts.SLICE}b")):
            spark.conf.set(texts.BATCH, own)
            texts.bound_batches(spark)
            assert spark.conf.get(texts.BATCH) == kept
    finally:
        spark.conf.set(texts.BATCH, before)


def test_local_rows(spark):
    schema = "n int, source string, size long, share double, places array<long>, day date"
    rows = [(1, "a", 1 << 40, 0.5, [1, 2], date(2020, 1, 31)), (2, None, None, None, [], None), (3, "", 0, 2.0, None, None)]
    for some in (rows, rows[1:2], []):
        out = texts.local_rows(spark, some, schema)
        assert [tuple(r) for r in out.collect()] == some
        assert out.schema == spark.createDataFrame(some, schema).schema


def test_the_plan_of_a_mix_needs_no_python_workers(make):
    plan, _ = source_mix.mix(make([(i, "one two three", "ab"[i % 2]) for i in range(20)]))
    assert "ExistingRDD" not in plan._jdf.queryExecution().toString()
    assert sorted(r.source for r in plan.collect()) == ["a", "b"]
