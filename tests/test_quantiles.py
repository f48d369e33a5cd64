"""Exact order statistics against sorted values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from boardweave.operators import quantiles as K

SHARES = [0.0, 0.25, 0.5, 0.75, 1.0]


def plain(values):
    values = sorted(values)
    return [values[max(1, math.ceil(s * len(values))) - 1] for s in SHARES]


@pytest.mark.parametrize("held", [1, 10, 4096])
def test_groups_of_many_shapes(spark, monkeypatch, held):
    monkeypatch.setattr(K, "HELD", held)
    chance = random.Random(held)
    groups = {
        ("a", None): [chance.lognormvariate(0, 8) for _ in range(700)], ("a", 1): [5.0] * 300, (None, None): [1.0], ("b", 2): [1e308, -1e308, 0.0, 1.0, 2.0] * 30,
        ("c", 3): [1.0] * 500 + [1.0 + 2**-50] * 20 + [1e12], ("d", 4): [float(i) for i in range(300)],
    }
    rows = [(k, n, v, "x") for (k, n), values in groups.items() for v in values] + [("a", 1, None, "x"), ("z", 9, None, "x"), ("a", 1, float("nan"), "x")]
    df = spark.createDataFrame(rows, "k string, n long, v double, low string").repartition(5)
    got = {(r[0], r[1]): (r[2], r[3]) for r in K.exact_quantiles(df.withColumnRenamed("n", "m"), ("k", "m"), "v", SHARES).collect()}
    assert got == {key: (len(values), plain(values)) for key, values in groups.items()}
    assert K.exact_quantiles(df.limit(0), ("k", "n"), "v", SHARES).collect() == []


def test_a_group_of_a_million(spark):
    rows = spark.range(1_000_000).select(F.lit("one").alias("k"), F.pow(F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double"), F.lit(3.0)).alias("v"))
    values = sorted(r["v"] for r in rows.select("v").toLocalIterator())
    found = K.exact_quantiles(rows, ("k",), "v", SHARES).first()
    assert found["n"] == 1_000_000 and found["values"] == plain(values)
