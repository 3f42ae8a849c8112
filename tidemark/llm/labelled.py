"""Bounded samples of labelled rows, to fit classifiers on the driver."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most rows of each class in a sample, and the longest text in it: at most 200 MB in all.
ROWS_PER_CLASS, LONGEST = 2000, 50_000


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text, mod 3, is 1. A null id is never one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(
    docs: DataFrame,
    labels: DataFrame,
    target: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_class: int = ROWS_PER_CLASS,
    longest: int = LONGEST,
) -> tuple[list[str], list[bytes], list[int]]:
    """Ids as text, texts and 0/1 labels of rows that aren't held out: per class the first rows by a hash of the id.

    The chosen ids, at most 2 * rows_per_class, are broadcast; the documents don't shuffle. Null
    labels, and an id that has both labels, are left out; repeated labels count once. The order is fixed.
    """
    known = (
        labels.where(F.col(target).isin(0, 1) & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_label_id"))
        .agg(F.min(target).cast("int").alias("_y"), F.max(target).cast("int").alias("_other"))
        .where("_y = _other")
        .select("_label_id", "_y")
    )
    parts = [
        known.where(F.col("_y") == y).orderBy(F.xxhash64("_label_id"), "_label_id").limit(rows_per_class)
        for y in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1])
    rows = (
        docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
        .where(F.length("_text") <= longest)
        .join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))
        .select("_id", "_text", "_y")
        .toArrow()
        .sort_by([("_id", "ascending"), ("_text", "ascending")])
    )
    texts = [t.encode() for t in rows.column("_text").cast(pa.large_string()).to_pylist()]
    return [str(i) for i in rows.column("_id").to_pylist()], texts, rows.column("_y").to_pylist()
