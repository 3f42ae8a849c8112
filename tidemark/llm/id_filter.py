"""Map-side filter by a Bloom filter of fixed size, before a shuffle join on ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of 32,768 bits: 2**24 bits, 2 MiB broadcast, whatever the number of ids.
BLOCKS, BLOCK_BITS = 512, 32768


def block(h: Column, blocks: int = BLOCKS) -> Column:
    return F.pmod(h, F.lit(blocks))


def bit(h: Column) -> Column:
    return F.shiftrightunsigned(h, 20).bitwiseAND(F.lit(BLOCK_BITS - 1))


def is_set(bitmap: str, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("long"), F.pmod(at, F.lit(8)).cast("int")) == 1


def _bitmaps(ids: DataFrame) -> DataFrame:
    h = F.xxhash64(F.col(ids.columns[0]))
    return (
        ids.select(block(h).alias("_block"), bit(h).alias("_bit"))
        .groupBy("_block")
        .agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    )


def only_ids(rows: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows whose id may be among `ids` (its one column): all that are, and few others."""
    own = F.xxhash64(id_col)
    return (
        rows.join(F.broadcast(_bitmaps(ids)), block(own) == F.col("_block"))
        .where(is_set("_bitmap", bit(own)))
        .select(*rows.columns)
    )


def split_by_ids(rows: DataFrame, id_col: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose id isn't among `ids` (its one column), and rows whose id may be. Nothing shuffles but `ids`."""
    own = F.xxhash64(rows[id_col])
    name = "_maybe_gone"
    while name in rows.columns:
        name += "_"
    marked = rows.join(F.broadcast(_bitmaps(ids)), block(own) == F.col("_block"), "left").select(
        *[rows[c] for c in rows.columns], F.coalesce(is_set("_bitmap", bit(own)), F.lit(False)).alias(name)
    )
    return marked.where(~F.col(name)).drop(name), marked.where(F.col(name)).drop(name)


def without_ids(rows: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows whose id isn't among `ids` (its one column). Rows that the filter rules out don't shuffle."""
    clear, maybe = split_by_ids(rows, id_col, ids)
    gone = ids.select(F.col(ids.columns[0]).alias("_gone")).distinct()
    return clear.unionByName(maybe.join(gone, maybe[id_col] == gone["_gone"], "left_anti"))
