"""Exact order statistics of groups of any size, by refining value ranges.

A sketch is exact up to some rows of a group only, and a sort would put a group
into one task. Here every wanted rank has a range of values that holds it. A
pass counts the rows of each range in ``PARTS`` slices, combined on the map side,
and keeps the slice with the rank; slices shrink to the least and greatest value
in them, so a skewed range needs no more passes. Ranges of ``HELD`` rows or less,
or of one value, are not refined any more: their few rows are sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardweave.plans.session import fresh_dir

HELD = 4096
PARTS = 256


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_quantiles(df: DataFrame, keys: tuple[str, ...], value: str, shares: list[float]) -> DataFrame:
    """(keys, n, values): for each share the least value that at least this share of the group's values do not exceed.

    ``n`` counts the values. NULLs and NaNs are left out, groups of nothing else
    have no row; NULL keys form groups. The result type is double.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).cast("double").alias("_v"))
    rows = rows.filter("_v IS NOT NULL AND NOT isnan(_v)")
    own = [F.col(n).alias(f"{n}_of") for n in names]

    def same(state: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [rows[n].eqNullSafe(state[f"{n}_of"]) for n in names], F.lit(True))

    group = [f"{n}_of" for n in names] + ["place"]
    wanted = F.posexplode(F.array(*[F.lit(float(s)) for s in shares])).alias("place", "share")
    state = rows.groupBy(*names).agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    state = state.select(*own, "n", "low", "high", wanted)
    rank = F.greatest(F.lit(1), F.ceil(F.col("share") * F.col("n"))).cast("long")
    state = _written(state.select(*group, "n", rank.alias("rank"), F.lit(0).cast("long").alias("before"), "low", "high", F.col("n").alias("inside")), "ranges")
    wide = (F.col("inside") > HELD) & (F.col("low") < F.col("high"))
    while not (open_ := state.filter(wide)).isEmpty():
        inside = rows.join(open_, same(open_) & F.col("_v").between(F.col("low"), F.col("high")))
        # Halves keep the width finite for any two doubles.
        part = (F.col("_v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * PARTS
        slices = inside.groupBy(*group, "n", "rank", "before", F.least(F.lit(PARTS - 1), F.floor(part)).alias("part")).agg(
            F.count("*").alias("inside"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        upto = F.sum("inside").over(Window.partitionBy(*group).orderBy("part"))  # PARTS rows at most
        slices = slices.withColumn("upto", F.col("before") + upto)
        found = slices.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("inside") < F.col("rank")))
        found = found.select(*group, "n", "rank", (F.col("upto") - F.col("inside")).alias("before"), "low", "high", "inside")
        state = _written(state.filter(~wide).unionByName(found), "ranges")
    left = state.filter("low < high")
    few = rows.join(left, same(left) & F.col("_v").between(F.col("low"), F.col("high"))).groupBy(*group, "n", "rank", "before").agg(
        F.sort_array(F.collect_list("_v")).alias("held"))  # HELD at most
    few = few.select(*group, "n", F.get("held", (F.col("rank") - F.col("before") - 1).cast("int")).alias("found"))
    each = state.filter("low = high").select(*group, "n", F.col("low").alias("found")).unionByName(few)
    whole = each.groupBy(*group[:-1], "n").agg(F.sort_array(F.collect_list(F.struct("place", "found"))).alias("held"))
    return whole.select(*[F.col(f"{n}_of").alias(k) for k, n in zip(keys, names)], "n", F.col("held.found").alias("values"))
