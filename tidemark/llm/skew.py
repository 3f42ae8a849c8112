"""Joining rows to one row per group when a few groups hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups that take the broadcast way; the rest hold under 1/HOT_GROUPS of the rows each.
HOT_GROUPS = 1024


def join_groups(
    rows: DataFrame, groups: DataFrame, key: str, weight: str, spread: str
) -> DataFrame:
    """Left join of `rows` to `groups` (unique in `key`) that no hot key can overload.

    `key` is a string or a long. The HOT_GROUPS largest groups, a number that never grows, are broadcast. Their rows get a
    join key of their own (should it be some other key, the broadcast values still come first), dealt by `spread`, so that the shuffle for the other groups stays even.
    Every row of `rows` comes back once, with the columns of `groups` (null where none fits).
    """
    values = [c for c in groups.columns if c != key]
    hot = groups.orderBy(F.desc(weight), key).limit(HOT_GROUPS)
    hot = hot.select(F.col(key).alias("_hot_key"), *[F.col(c).alias(f"_hot_{c}") for c in values])
    cold = groups.select(
        F.col(key).alias("_cold_key"), *[F.col(c).alias(f"_cold_{c}") for c in values]
    )
    text = dict(rows.dtypes)[key] == "string"
    own = F.concat_ws("#", key, F.xxhash64(spread).cast("string")) if text else F.xxhash64(spread, key)
    tagged = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_deal",
        F.when(F.col("_hot_key").isNull(), F.col(key)).otherwise(own),
    )
    joined = tagged.join(cold, F.col("_deal") == F.col("_cold_key"), "left")
    return joined.select(
        *rows.columns, *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in values]
    )
