"""Exact deduplication: a two-pass Bloom filter finds the texts that may repeat; only they shuffle.

Pass 1 counts, for every text hash, two bits of a blocked Bloom filter and keeps the bits that more
than one row sets. Pass 2 tests every row: one whose two bits were not both set by someone else is
alone, and passes straight through. The others shuffle (id and hash) and are grouped by SHA-256, so a
false positive costs a shuffled row and never a wrong result. The filter has about BITS_A_ROW bits a
row, by the table's own count, up to MOST_BLOCKS blocks: it is broadcast, so its size must have an end.
Beyond that it fills up and more rows shuffle; results stay the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.skew import join_groups

#: Bits in a block, fixed by Spark's bitmap functions.
BLOCK_BITS = 32768
#: Bits for a row: with 8, a text that is alone shuffles once in 20 times.
BITS_A_ROW = 8
#: Fewest and most blocks: 256 KiB and 128 MiB broadcast. The most has BITS_A_ROW for 1.3 * 10**8 rows, and at
#: 10**9 rows a quarter of the lone ones still pass straight through.
LEAST_BLOCKS, MOST_BLOCKS = 64, 32768


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(h, F.lit(blocks))


def _bits(h: Column) -> list[Column]:
    return [
        F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(BLOCK_BITS - 1)) for shift in (17, 40)
    ]


def blocks_for(rows: int) -> int:
    """Blocks of the filter for so many rows: a power of two between LEAST_BLOCKS and MOST_BLOCKS."""
    wanted = max(1, -(-rows * BITS_A_ROW // BLOCK_BITS))
    return min(MOST_BLOCKS, max(LEAST_BLOCKS, 1 << (wanted - 1).bit_length()))


def repeated_bits(hashes: DataFrame, blocks: int) -> DataFrame:
    """Pass 1 over column `_h`: per block, the bitmap of the bits that at least two rows set."""
    bits = hashes.select(
        _block(F.col("_h"), blocks).alias("_block"), F.explode(F.array(*_bits(F.col("_h")))).alias("_bit")
    )
    twice = bits.groupBy("_block", "_bit").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return twice.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))


def _is_set(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring("_bitmap", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("long"), F.pmod(bit, F.lit(8)).cast("int")) == 1


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256 and `row` (the carried columns).

    Texts are equal when identical; null counts as empty. Of equal texts the largest id stays; a null
    id stays only if all ids of the group are null. Rows that repeat id and text are one document:
    they count in group_size and share the decision. An empty table gives an empty result. Only the
    named columns are read, so other columns may have any name. Without `blocks` the rows are counted
    first, which a Parquet table answers from its footers.
    """
    blocks = blocks or blocks_for(docs.count())
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(text).alias("_h"),
        F.sha2(text.cast("binary"), 256).alias("_sha"),
        F.struct(*[F.col(c) for c in carry] or [F.lit(None).cast("string").alias("none")]).alias("_row"),
    )
    bitmaps = repeated_bits(docs.select(F.xxhash64(text).alias("_h")), blocks)
    first, second = _bits(F.col("_h"))
    flagged = (
        source.withColumn("_block", _block(F.col("_h"), blocks))
        .join(F.broadcast(bitmaps), "_block", "left")
        .select("_id", "_sha", "_row", F.coalesce(_is_set(first) & _is_set(second), F.lit(False)).alias("_maybe"))
    )
    alone = flagged.where(~F.col("_maybe")).select(
        "_id", "_sha", "_row", F.col("_id").alias("_keep"), F.lit(1).cast("long").alias("_size")
    )
    maybe = flagged.where("_maybe").select("_id", "_sha", "_row")
    groups = maybe.groupBy("_sha").agg(
        F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")
    )
    found = join_groups(maybe, groups, "_sha", "_size", "_id")
    return alone.unionByName(found).select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
        F.col("_row").alias("row"),
    )


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).drop("row")


ORACLE_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
