import random

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from millrace.operators import global_order
from millrace.operators.global_order import order_globally
from millrace.operators.quantiles import exact_quantiles


def frame(spark, n, values):
    rng = random.Random(7)
    # a third of all rows share one value
    rows = [(i, 5 if i % 3 == 0 else rng.randrange(values), rng.randrange(1000)) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id int, v int, w int").withColumn("w", F.col("w").cast("decimal(20,2)"))


@pytest.mark.parametrize("values,descending,parts", [(4, True, 8), (300, False, 7), (1, True, 5)])
def test_equals_plain_window(spark, values, descending, parts):
    df = frame(spark, 2000, values)
    key = F.col("v").desc() if descending else F.col("v").asc()
    got = order_globally(df, "v", ["id"], descending=descending, running="w", partitions=parts)
    total = W.orderBy(key, "id")
    want = df.select(
        "id",
        F.row_number().over(total).alias("a"),
        F.rank().over(W.orderBy(key)).alias("b"),
        F.dense_rank().over(W.orderBy(key)).alias("c"),
        F.sum("w").over(total.rowsBetween(W.unboundedPreceding, 0)).alias("d"),
    )
    wrong = got.join(want, "id").filter(
        (F.col("row_no") != F.col("a")) | (F.col("rank") != F.col("b"))
        | (F.col("dense_rank") != F.col("c")) | (F.col("running_total") != F.col("d"))
    )
    assert got.count() == 2000
    assert wrong.count() == 0


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "id int, v int")
    assert order_globally(empty, "v", ["id"]).count() == 0
    one = order_globally(spark.createDataFrame([(1, 2)], "id int, v int"), "v", ["id"]).first()
    assert (one["row_no"], one["rank"], one["dense_rank"]) == (1, 1, 1)


def test_quantiles_equal_numpy(spark):
    rng = random.Random(1)
    rows = [(g, i, 0.0 if i % 3 == 0 else rng.gauss(0, 1)) for g in ("a", "b") for i in range(101 if g == "a" else 4)]
    rows.append(("a", 999, None))
    got = exact_quantiles(spark.createDataFrame(rows, "g string, i int, x double"), ["g"], "x", [0.0, 0.025, 0.5, 0.9, 1.0], ["i"])
    for row in got.collect():
        x = [r[2] for r in rows if r[0] == row["g"] and r[2] is not None]
        assert row["n"] == len(x)
        assert row["quantile"] == pytest.approx(np.quantile(x, row["prob"]), abs=1e-12)


def test_numbers_take_one_exchange_and_even_tasks(spark, monkeypatch):
    seen = []
    real = global_order.materialize
    monkeypatch.setattr(global_order, "materialize", lambda df: seen.append(df) or real(df))
    # a third of all rows share one value
    rows = spark.range(0, 200_000, 1, 16).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 1000).alias("v"))
    out = global_order.number_globally(rows, "v", ["id"], partitions=64)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange ") == 1
    sizes = [r[1] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 200_000 / 64
    got = out.agg(F.count("*"), F.min("row_no"), F.max("row_no"), F.countDistinct("row_no")).first()
    assert tuple(got) == (200_000, 1, 200_000, 200_000)
    wrong = out.alias("a").join(out.alias("b"), F.expr("a.row_no + 1 = b.row_no")).where("a.v < b.v or a.v = b.v and a.id > b.id")
    assert wrong.count() == 0
