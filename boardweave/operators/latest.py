"""One row per key: the newest version, or the whole version history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("board", "source_id")
# equal sequence values are settled by the later source update
SEQUENCE = ("exported_at", "updated_at")


def version_order(df: DataFrame, sequence: tuple[str, ...]) -> Column:
    """Total order of versions. A struct compares field by field with NULL
    lowest; the row hash settles versions that tie on every field."""
    hashed = [c for c, kind in df.dtypes if not kind.startswith("map")]
    return F.struct(*sequence, F.xxhash64(*hashed).alias("row_hash"))


def latest_wins(df: DataFrame, keys: tuple[str, ...] = KEYS,
                sequence: tuple[str, ...] = SEQUENCE) -> DataFrame:
    """Newest version per key, whatever order the versions arrived in.

    The rank is limited before the exchange too (Spark's window group limit), so
    a key with any number of versions leaves each task as one row.
    """
    place = unused(df, "place")
    newest_first = Window.partitionBy(*keys).orderBy(version_order(df, sequence).desc())
    return df.withColumn(place, F.row_number().over(newest_first)).filter(F.col(place) == 1).drop(place)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while a column is called so."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def version_history(df: DataFrame, keys: tuple[str, ...] = KEYS,
                    sequence: tuple[str, ...] = SEQUENCE,
                    ignore: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    """Type-2 history: every changed version with the time it was valid.

    The first sequence column dates a version; several versions of one date
    count as the last of them. A version equal to its predecessor in all but
    the key, the sequence and the ``ignore`` columns opens no new interval.
    Keys and date must not be NULL, which the identity rule guarantees.

    A key may have any number of versions, so neighbours are found inside
    (key, hour) slices; a second window sees only one row per slice.
    """
    when = sequence[0]
    content = [c for c in df.columns if c not in {*keys, *sequence, *ignore}]
    dated = (
        df.groupBy(*keys, when)
        .agg(F.max_by(F.struct(*df.columns), version_order(df, sequence)).alias("_row"))
        .select("_row.*")
        .withColumn("_content", F.xxhash64(*content))
        .withColumn("_slice", F.date_trunc("hour", when))
    )
    slice_key = [*keys, "_slice"]
    in_slice = Window.partitionBy(*slice_key).orderBy(when)
    over_slices = Window.partitionBy(*keys).orderBy("_slice")

    # what the previous slice ended with, for the first row of each slice
    ends = dated.groupBy(*slice_key).agg(F.max_by("_content", when).alias("_end"))
    ends = ends.select(*slice_key, F.lag("_end").over(over_slices).alias("_end"))
    before = F.coalesce(F.lag("_content").over(in_slice), F.col("_end"))
    changed = (
        dated.join(ends, slice_key)
        .withColumn("_before", before)
        .filter(~F.col("_before").eqNullSafe(F.col("_content")))
    )

    # when the next slice changes first, for the last row of each slice
    starts = changed.groupBy(*slice_key).agg(F.min(when).alias("_start"))
    starts = starts.select(*slice_key, F.lead("_start").over(over_slices).alias("_next"))
    valid_to = F.coalesce(F.lead(when).over(in_slice), F.col("_next"))
    return (
        changed.join(starts, slice_key)
        .select(*df.columns, F.col(when).alias("valid_from"), valid_to.alias("valid_to"))
        .withColumn("is_current", F.col("valid_to").isNull())
    )
