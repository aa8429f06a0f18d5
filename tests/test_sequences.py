"""Sequences against plain slices, and what the registered queries build of them."""

import datetime as dt
import random

import pytest

from millrace.operators import features
from millrace.plans import registry

DAY0 = dt.date(2017, 1, 2)


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(5)
    made = [
        (c, DAY0 + dt.timedelta(days=i), *[float(pick.randrange(100)) for _ in features.FEATURES])
        for c, n in (("long", 45), ("just", 37), ("short", 36)) for i in range(n)
    ]
    return spark.createDataFrame(made, ["category", "sale_date", *features.FEATURES]).cache()


def test_sums_are_of_every_column_and_day(rows):
    series = {}
    for r in sorted(rows.collect(), key=lambda r: (r.category, r.sale_date)):
        series.setdefault(r.category, []).append(r)
    got = {(r.category, r.idx): r for r in features.sequence_sums(features.sequence_dataset(rows)).collect()}
    assert sorted(got) == [("just", 29), *[("long", i) for i in range(29, 38)]]
    for (category, idx), r in got.items():
        days, after = series[category][idx - 29 : idx + 1], series[category][idx + 1 : idx + 8]
        for c in features.FEATURES:
            assert r[f"sum_{c}"] == sum(d[c] for d in days)
            assert r[f"turn_{c}"] == sum(n * d[c] for n, d in enumerate(days, 1))
        assert r.sum_y == sum(d.units_sold for d in after)
        assert r.turn_y == sum(n * d.units_sold for n, d in enumerate(after, 1))


@pytest.mark.parametrize("name", ["sequence_dataset", "sequence_sums"])
def test_queries_build_all_columns(spark, small, monkeypatch, name):
    built, whole = [], features.sequence_dataset

    def kept(*args, **named):
        built.append(whole(*args, **named))
        return built[-1]

    monkeypatch.setattr(features, "sequence_dataset", kept)
    registry.registered()[name](spark, small)
    plan = built[0]._jdf.queryExecution().analyzed().toString()
    vector = next(line for line in plan.splitlines() if "AS _vector" in line)
    made = vector[vector.index("array(") :]
    assert all(f"{c}#" in made for c in features.FEATURES)
