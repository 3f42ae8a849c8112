"""Benchmark decontamination by spaced-seed hashing.

A seed is a window of words of which a fixed mask reads some and ignores the others, so a replaced word
need not hide a match. Seeds of the benchmark and of the documents are joined by hash; around each hit
the document and the benchmark item are laid side by side and equal words counted, and an overlap counts
when some WINDOW words in a row have LEAST_EQUAL equal ones. The masks together catch every such overlap
with exactly LEAST_EQUAL equal words in WINDOW, wherever the others are.

The benchmark is the query set: it is taken in blocks of bounded size, and each block meets all
documents in one pass without a shuffle. The driver holds one block at a time. A benchmark of one block
takes one pass; of a larger one, each pass writes the hits of its block by the hash of the text, and
only documents whose text may be among the hits shuffle to be marked.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, StructField, StructType

from tidemark.llm.caches import claim
from tidemark.llm.id_filter import split_by_ids
from tidemark.llm.pieces import bytes_of, per_text, small_batches
from tidemark.llm.scratch import written
from tidemark.llm.skew import join_groups

#: An overlap: so many equal words in so many in a row.
WINDOW, LEAST_EQUAL = 13, 10
#: Word positions that each mask reads.
MASKS = (
    (0, 2, 4, 5, 8, 9),
    (0, 1, 4, 6, 7, 9),
    (0, 1, 2, 3, 7, 9),
    (0, 3, 4, 5, 7, 9),
    (0, 1, 3, 5, 8, 9),
    (0, 1, 2, 4, 5, 9),
    (0, 4, 6, 7, 8, 9),
    (0, 5, 6, 7, 8, 9),
    (0, 3, 4, 5, 6, 9),
)
#: Items of fewer words than WINDOW may differ in the same share of words; of fewer than TOLERANT, in none.
LEAST_WORDS, TOLERANT = 1, 7
#: Bytes of benchmark text in a block (one longer item is a block by itself): some 3 million seeds, 50 MB in a worker.
BLOCK_BYTES = 2 << 20
#: Least and most bits of a hash that pick a slot of the first test.
SLOT_BITS = 16, 25
#: Words whose hashes a worker remembers.
REMEMBERED = 200_000

_EDGES = " \t\r\n.,;:!?\"'()[]{}<>|*#$%&=+/\\`~^_-…«»“”‘’¿¡"
_FACTORS = np.random.default_rng(7).integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GAP = np.uint64(0x5EAF00D5EAF00D11)


class _Words(dict):
    def __missing__(self, piece: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        word = piece.decode().lower().strip(_EDGES)
        value = self[piece] = xxhash.xxh3_64_intdigest(word) | 1 if word else 0
        return value


@functools.cache
def _words() -> _Words:
    return _Words()


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words in lower case, without the marks around them; pieces of marks alone don't count."""
    pieces = text.split()
    h = np.fromiter(map(_words().__getitem__, pieces), dtype=np.uint64, count=len(pieces))
    return h[h != 0]


def seeds(h: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    """A hash for each window, of the words that the mask reads."""
    n = len(h) - mask[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, np.uint64(salt * int(_GAP) % 2**64))
    for k, at in enumerate(mask):
        out += h[at : at + n] * _FACTORS[k % len(_FACTORS)]
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Block:
    """Seeds of some benchmark items: sorted hashes with the item and the place of each."""

    ids: list
    words: list[np.ndarray]
    masks: list[tuple[int, ...]]
    hashes: np.ndarray
    items: np.ndarray
    places: np.ndarray

    def __post_init__(self):
        bits = min(SLOT_BITS[1], max(SLOT_BITS[0], (8 * len(self.hashes)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, dtype=bool)
        self.slots[(self.hashes >> self.shift).astype(np.int64)] = True

    def matches(self, texts: list[bytes]) -> list[set[int]]:
        """Per text the numbers of the items that it overlaps."""
        found: list[set[int]] = [set() for _ in texts]
        parts, starts, at = [], [], 0
        gap = np.full(max((m[-1] for m in self.masks), default=0) + 1, _GAP)
        for text in texts:
            h = word_hashes(text)
            parts += [h, gap]
            starts.append(at)
            at += len(h) + len(gap)
        if not parts or not len(self.hashes):
            return found
        h, starts_at = np.concatenate(parts), np.array(starts)
        tried: set[tuple[int, int]] = set()
        for number, mask in enumerate(self.masks):
            s = seeds(h, mask, number)
            near = np.flatnonzero(self.slots[(s >> self.shift).astype(np.int64)])
            if not len(near):
                continue
            low = np.searchsorted(self.hashes, s[near], "left")
            high = np.searchsorted(self.hashes, s[near], "right")
            for p, a, b in zip(near[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist(), strict=True):
                doc = int(np.searchsorted(starts_at, p, "right")) - 1
                for item, place in zip(self.items[a:b].tolist(), self.places[a:b].tolist(), strict=True):
                    line = (item, p - place)
                    if item in found[doc] or line in tried:
                        continue
                    tried.add(line)
                    end = starts[doc + 1] - len(gap) if doc + 1 < len(starts) else len(h) - len(gap)
                    if overlaps(h[starts[doc] : end], self.words[item], p - place - starts[doc]):
                        found[doc].add(item)
        return found


def least_equal(n: int) -> int:
    """How many words of an item of n words must be equal, in WINDOW in a row at most."""
    return LEAST_EQUAL if n >= WINDOW else n - n * (WINDOW - LEAST_EQUAL) // WINDOW if n >= TOLERANT else n


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Masks for items of n words, fewer than WINDOW: dealt into one part more than words may differ, one part is whole."""
    parts = n - least_equal(n) + 1
    return sorted({tuple(x - k for x in range(k, n, parts)) for k in range(parts)})


def overlaps(doc: np.ndarray, item: np.ndarray, offset: int) -> bool:
    """Whether the item, laid at `offset` of the document, has a window of enough equal words."""
    window = min(WINDOW, len(item))
    least = least_equal(len(item))
    first, last = max(0, -offset), min(len(item), len(doc) - offset)
    if last - first < least:
        return False
    equal = np.zeros(len(item) + 1, dtype=np.int64)
    np.cumsum(item[first:last] == doc[offset + first : offset + last], out=equal[first + 1 : last + 1])
    equal[last + 1 :] = equal[last]
    return bool((equal[window:] - equal[: len(equal) - window]).max() >= least)


def make_block(rows: list[tuple[object, bytes]]) -> Block:
    words = [word_hashes(t) for _, t in rows]
    short = sorted({len(w) for w in words if LEAST_WORDS <= len(w) < WINDOW})
    short_ones = [(n, mask) for n in short for mask in short_masks(n)]
    masks = [*MASKS, *(mask for _, mask in short_ones)]
    hashes, items, places = [], [], []
    for number, mask in enumerate(masks):
        for i, w in enumerate(words):
            if (len(w) >= WINDOW) if number < len(MASKS) else len(w) == short_ones[number - len(MASKS)][0]:
                s = seeds(w, mask, number)
                hashes.append(s)
                items.append(np.full(len(s), i, dtype=np.int32))
                places.append(np.arange(len(s), dtype=np.int32))
    if not hashes:
        return Block([i for i, _ in rows], words, [], *(np.zeros(0, dtype=k) for k in (np.uint64, np.int32, np.int32)))
    h = np.concatenate(hashes)
    order = np.argsort(h, kind="stable")
    return Block([i for i, _ in rows], words, masks, h[order], np.concatenate(items)[order], np.concatenate(places)[order])


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[bytes]:
    """The benchmark's ids and texts in pickled blocks, one after the other; null texts are empty, and match nothing."""
    rows: list[tuple[object, bytes]] = []
    held = 0
    for row in benchmark.select(id_col, text_col).toLocalIterator():
        text = (row[1] or "").encode()
        if rows and held + len(text) > BLOCK_BYTES:
            yield pickle.dumps(rows)
            rows, held = [], 0
        rows.append((row[0], text))
        held += len(text)
    if rows:
        yield pickle.dumps(rows)


@functools.lru_cache(maxsize=1)
def _block(pickled: bytes) -> Block:
    return make_block(pickle.loads(pickled))


def _forget() -> None:
    _words().clear()
    _block.cache_clear()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    keep_text: bool = True,
    names: tuple[str, str] = ("items", "contaminated"),
) -> DataFrame:
    """`docs` with columns `items` (sorted ids of the overlapped items) and `contaminated`, or other `names`, put last.

    Input columns of these names give way; without keep_text the texts stay behind. Words are compared
    in lower case and without the marks around them. Null and empty texts overlap nothing; an empty
    benchmark marks nothing; items without words, or with a null id, never match.
    Items with equal texts are all named. Repeated rows come back repeated. A benchmark of several blocks
    reads `docs` once a block and twice more, so let it be a written table then.
    """
    clean = docs.select(*[c for c in docs.columns if c.lower() not in {n.lower() for n in names}])
    item_kind = benchmark.schema[item_id_col].dataType
    blocks = blocks_of(benchmark.where(benchmark[item_id_col].isNotNull()), item_id_col, item_text_col)
    first = next(blocks, pickle.dumps([]))
    second = next(blocks, None)
    if second is None:
        return _pass(clean, first, text_col, item_kind, keep_text, names)
    return _in_turns(clean, chain([first, second], blocks), text_col, item_kind, keep_text, names)


def _in_turns(docs: DataFrame, blocks: Iterator[bytes], text_col: str, item_kind: DataType, keep_text: bool, added: tuple[str, str]) -> DataFrame:
    key = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("_key")
    texts = docs.select(key, F.col(text_col).alias("_text"))
    parts = []
    for block in blocks:
        hits = _pass(texts, block, "_text", item_kind, False, ("_items", "_hit")).where("_hit")
        parts.append(written(hits.groupBy("_key").agg(F.any_value("_items").alias("_items"), F.count("*").alias("_n")), "hits"))
    hits = functools.reduce(DataFrame.unionByName, parts)
    found = hits.groupBy("_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items"), F.max("_n").alias("_n")
    )
    found = written(found, "leaks")
    back = [c for c in docs.columns if keep_text or c != text_col]
    spread = [c for c, kind in docs.dtypes if c != text_col and "map<" not in kind and "variant" not in kind]
    rows = docs.select(key, F.xxhash64(*spread or [F.lit(0)]).alias("_spread"), F.struct(*back or [F.lit(0).alias("_none")]).alias("_row"))
    clear, maybe = split_by_ids(rows, "_key", found.select("_key"))
    clear = clear.select("_row", F.lit(None).cast(ArrayType(item_kind)).alias("_items"))
    marked = clear.unionByName(join_groups(maybe, found, "_key", "_n", "_spread").select("_row", "_items"))
    return marked.select(
        *[F.col("_row").getField(c).alias(c) for c in back],
        F.coalesce("_items", F.array().cast(ArrayType(item_kind))).alias(added[0]),
        F.col("_items").isNotNull().alias(added[1]),
    )


def _pass(docs: DataFrame, pickled: bytes, text_col: str, item_kind: DataType, keep_text: bool, added: tuple[str, str]) -> DataFrame:
    back = [c for c in docs.columns if keep_text or c != text_col]
    schema = StructType(
        [*(docs.schema[c] for c in back), StructField(added[0], ArrayType(item_kind)), StructField(added[1], BooleanType())]
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_type

        claim("decontaminate", _forget)
        block = _block(pickled)
        names = batch.schema.names
        items = [sorted({block.ids[i] for i in found}) for found in block.matches(bytes_of(batch, text_col))]
        new = [pa.array(items, pa.list_(to_arrow_type(item_kind))), pa.array([bool(i) for i in items])]
        old = [batch.column(names.index(c)) for c in back]
        return pa.RecordBatch.from_arrays([*old, *new], names=[*back, *added])

    return small_batches(docs).mapInArrow(per_text(text_col, work, 4 << 20), schema)


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, items, contaminated, over the whole benchmark."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep_text=False)
