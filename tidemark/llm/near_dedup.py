"""MinHash near-deduplication with odd sketches, exact at the threshold.

Each shingle set gets 128 MinHash values; bands of four make bucket keys. Its MinHash samples under one
more function, the values below a power-of-two bound that leaves at most 512 (all of a smaller set), are
folded into a parity bitmap, the odd sketch, and those below half the bound into another. The XOR
population count of two sketches with the same bound estimates how much the samples differ, so closely
that few pairs below the threshold pass. Those that pass are confirmed on full sets.

Equal sets are one class from the start. Buckets are not expanded into pairs: each member meets only
the bucket's leaders, and links join classes into components. Only members of a bucket that are then
still in different components meet each other; so no link is lost between components, and a large
group of near copies costs a few pairs a member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, merged
from tidemark.llm.id_filter import only_ids
from tidemark.llm.pieces import bytes_of, per_text, small_batches
from tidemark.llm.scratch import written
from tidemark.llm.shingles import shingle_set
from tidemark.llm.skew import join_groups

#: Members of a block; two blocks meet in one group of work.
BLOCK = 1024
#: Pairs of one text that are confirmed in one run of rows.
RUN = 64

#: MinHash values, as bands of rows: a pair of similarity 0.75 shares no band with probability 5e-6.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
#: Most samples in an odd sketch, its bits, and the standard deviations that an estimate may be off.
SKETCH_SAMPLES, SKETCH_BITS, DEVIATIONS = 512, 1024, 5.0
#: Links are pairs with PER * intersection >= SHARE * union.
SHARE, PER = 75, 100

_RNG = np.random.default_rng(20240501)
_FACTORS = (_RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1))
_SHIFTS = _RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32)
_BAND_FACTORS = _RNG.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BIT_FACTORS = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64) | np.uint64(1)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the set's values under each of SAMPLES hash functions."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, np.uint32(0xFFFFFFFF))
    for start in range(0, len(low), 2048):
        part = low[start : start + 2048]
        values = np.multiply.outer(_FACTORS, part)
        values += _SHIFTS[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One signed 64-bit bucket key a band."""
    v = values.astype(np.uint64).reshape(BANDS, ROWS)
    mixed = (v * _BAND_FACTORS)
    mixed ^= mixed >> np.uint64(29)
    keys = (mixed * np.uint64(0x94D049BB133111EB)).sum(axis=1) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def odd_sketch(shingles: np.ndarray) -> tuple[int, list[int], np.ndarray]:
    """Of a sorted set: the bound (a power of two, as how often 2**64 is halved), how many samples are below
    it and below its half, and the parities of where either fall, as signed 64-bit words."""
    halvings = 0
    n = len(shingles)
    while n > SKETCH_SAMPLES:
        halvings += 1
        n = int(np.searchsorted(shingles, np.uint64(2 ** (64 - halvings))))
    half = int(np.searchsorted(shingles, np.uint64(2 ** (63 - halvings))))
    at = ((shingles[:n] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(54)).astype(np.int64)
    words = []
    for part in (at, at[:half]):
        parity = (np.bincount(part, minlength=SKETCH_BITS) & 1).astype(np.uint8)
        words.append(np.packbits(parity, bitorder="little").view(np.int64))
    return halvings, [n, half], np.concatenate(words)


def most_bits(samples: np.ndarray, halvings: np.ndarray) -> np.ndarray:
    """The most bits in which the sketches of a link differ. samples: of both, together.

    Values that differ set no more bits than they are. Whole sets differ by as much as the threshold allows;
    samples may by chance differ more, by DEVIATIONS.
    """
    share = SHARE / PER
    apart = samples * (1 - share) / (1 + share)
    chance = np.sqrt(share * (1 - share) * (1 + share) / np.maximum(samples, 1)) * samples * 2 / (1 + share) ** 2
    sampled = apart + DEVIATIONS * chance
    even = np.exp(-2 * sampled / SKETCH_BITS)
    expected = SKETCH_BITS / 2 * (1 - even) + DEVIATIONS * (sampled / np.sqrt(SKETCH_BITS) + 1)
    return np.floor(np.where(halvings > 0, np.minimum(sampled, expected), apart) + 1e-9)


class Sketches:
    """Sizes and odd sketches of many sets, as arrays."""

    def __init__(self, sizes: np.ndarray, halvings: np.ndarray, samples: np.ndarray, words: np.ndarray):
        self.sizes, self.halvings, self.samples = sizes, halvings, samples
        self.words = words.view(np.uint64).reshape(len(sizes), 2, SKETCH_BITS // 64)

    def pick(self, which) -> Sketches:
        return Sketches(self.sizes[which], self.halvings[which], self.samples[which], self.words[which])

    def likely(self, others: Sketches) -> np.ndarray:
        """Whether each set may be linked with the other in its place, or a single set with each of the others: by
        the sizes, and at the same bound by the sketches."""
        mine = np.broadcast_to(np.arange(len(self.sizes)), len(others.sizes))
        top = np.maximum(others.halvings, self.halvings)
        ok = (top - self.halvings <= 1) & (top - others.halvings <= 1)
        ok &= PER * np.minimum(others.sizes, self.sizes) >= SHARE * np.maximum(others.sizes, self.sizes)
        at = np.flatnonzero(ok)
        i, top = mine[at], top[at]
        a, b = top - self.halvings[i], top - others.halvings[at]
        bits = np.bitwise_count(self.words[i, a] ^ others.words[at, b]).sum(axis=1)
        samples = self.samples[i, a] + others.samples[at, b]
        ok[at] = bits <= most_bits(samples, top)
        return ok


SKETCH_COLUMNS = ("n_shingles", "halvings", "samples", "sketch")


def arrays(batch: pa.RecordBatch) -> Sketches:
    found = {n: batch.column(batch.schema.names.index(n)) for n in SKETCH_COLUMNS}
    flat = lambda c: c.flatten().to_numpy(zero_copy_only=False)
    rows = len(batch)
    return Sketches(
        found["n_shingles"].to_numpy(zero_copy_only=False), found["halvings"].to_numpy(zero_copy_only=False),
        flat(found["samples"]).reshape(rows, 2), np.ascontiguousarray(flat(found["sketch"])).reshape(rows, -1),
    )


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, text_key (a hash of the text), n_shingles, set_key (equal for equal sets), band keys, odd sketch."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, keys, bands, halvings, samples, words = [], [], [], [], [], []
        for text in bytes_of(batch, "_text"):
            found = shingle_set(text)
            n.append(len(found))
            keys.append(set_key(found))
            bands.append(band_keys(minhash(found)))
            for column, x in zip((halvings, samples, words), odd_sketch(found), strict=True):
                column.append(x)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.string()), pa.array(bands, pa.list_(pa.int64())),
             pa.array(halvings, pa.int32()), pa.array(samples, pa.list_(pa.int32())), pa.array(words, pa.list_(pa.int64()))],
            names=["id", "text_key", "n_shingles", "set_key", "bands", "halvings", "samples", "sketch"],
        )

    text = F.col(text_col)
    source = docs.select(F.col(id_col).alias("id"), text_key(text).alias("text_key"), text.alias("_text"))
    return small_batches(source).mapInArrow(
        per_text("_text", work, 4 << 20),
        f"id {kind}, text_key long, n_shingles long, set_key string, bands array<long>, "
        "halvings int, samples array<int>, sketch array<long>",
    )


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose odd sketches let them be links."""
    side = lambda x: classes.select(F.col("node").alias(x), F.struct(*SKETCH_COLUMNS).alias(f"_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                left, right = (arrays(pa.RecordBatch.from_struct_array(batch.column(i))) for i in (2, 3))
                yield batch.select([0, 1]).filter(pa.array(left.likely(right)))

    return both.select("a", "b", "_a", "_b").mapInArrow(check, "a long, b long")


def set_key(found: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(found.tobytes())


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of classes whose full sets meet the threshold.

    A worker streams rows sorted so that a's text comes before the texts of its partners; it holds a's
    set and one partner's. An a with many partners is dealt to several runs. Where an id has several texts,
    those of other classes are passed over by the key of their sets.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / RUN).alias("runs"))
    dealt = pairs.join(degree, "a").withColumn("run", F.pmod(F.xxhash64("b"), F.col("runs")))
    wanted = dealt.select("a", "run", F.lit(1).alias("place"), F.col("b").alias("node")).unionByName(
        dealt.select("a", "run", F.lit(0).alias("place"), F.col("a").alias("node")).distinct()
    )
    wanted = wanted.join(classes.select("node", F.col("rep").alias("id"), "set_key"), "node")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = (
        wanted.join(only_ids(texts, "id", wanted.select("id")), "id")
        .repartition("a", "run")
        .sortWithinPartitions("a", "run", "place")
        .select("a", "run", "place", "node", "set_key", "text")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, None
        for batch in batches:
            a, b = [], []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for left, run, place, right, key, text in zip(*columns, bytes_of(batch, "text"), strict=True):
                found = shingle_set(text)
                if set_key(found) != key:
                    continue
                if place == 0:
                    current, held = (left, run), found
                    continue
                assert current == (left, run)
                both = len(np.intersect1d(held, found, assume_unique=True))
                if both and PER * both >= SHARE * (len(held) + len(found) - both):
                    a.append(left)
                    b.append(right)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(check, "a long, b long").distinct()


def apart_pairs(members: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of a bucket in different components that the sketches let be links: distinct (a, b), a < b.

    Of each bucket, the members outside the component of its leader meet all members. Both
    sides are cut into blocks; a worker holds two blocks, so no bucket is too large, and only likely
    pairs leave it. A pair that shares several buckets leaves the one with the smallest key.
    """
    labels = labels.select(F.col("node").alias("_node"), "label")
    known = members.join(labels, members["node"] == labels["_node"], "left").select(
        "key", "node", "rep", F.coalesce("label", "node").alias("label")
    )
    parts = known.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("rep", "node")).alias("least"))
    spread = (
        parts.groupBy("key")
        .agg(
            F.sum("c").alias("n"), F.min_by("label", "least").alias("home"),
            F.min_by("c", "least").alias("inside"), F.count(F.lit(1)).alias("labels"),
        )
        .where("labels > 1")
        .select("key", "n", "home", (F.col("n") - F.col("inside")).alias("out"))
    )
    placed = join_groups(known, spread, "key", "n", "node").where("home is not null")
    rows_of = F.ceil(F.col("out") / BLOCK).cast("int")
    cols_of = F.ceil(F.col("n") / BLOCK).cast("int")
    column = F.pmod(F.xxhash64("node"), cols_of).cast("int")
    row = F.pmod(F.xxhash64("node", F.lit(1)), rows_of).cast("int")
    every = placed.select("key", "node", "label", "home", F.lit(1).alias("side"), column.alias("j"), F.explode(F.sequence(F.lit(0), rows_of - 1)).alias("i"))
    apart = placed.where("label <> home").select("key", "node", "label", "home", F.lit(0).alias("side"), row.alias("i"), F.explode(F.sequence(F.lit(0), cols_of - 1)).alias("j"))
    cells = (
        every.unionByName(apart)
        .join(classes.select("node", *SKETCH_COLUMNS, "bands"), "node")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "side", "node")
        .select("key", "i", "j", "side", "node", "label", "home", *SKETCH_COLUMNS, "bands")
    )
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = None

        def out(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            node, label, left = batch.column(4).to_numpy(), batch.column(5).to_numpy(), batch.column(3).to_numpy() == 0
            found = arrays(batch)
            here, others = found.pick(left), found.pick(~left)
            bands = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(len(batch), BANDS)
            key, bands_a, bands_b = batch.column(0)[0].as_py(), bands[left], bands[~left]
            node_b, label_b, home = node[~left], label[~left], batch.column(6).to_numpy()
            for x, (mine, name) in enumerate(zip(node[left], label[left], strict=True)):
                near = here.pick(slice(x, x + 1)).likely(others) & (label_b != name)
                near &= (label_b == home[~left]) | (node_b > mine)  # two that are apart from home meet twice
                at = np.flatnonzero(near)
                if not len(at):
                    continue
                own = bands_a[x]
                first = np.where(bands_b[at] == own, own, np.iinfo(np.int64).max).min(axis=1) == key
                if first.any():
                    other = node_b[at[first]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(other, mine)), pa.array(np.maximum(other, mine))], names=["a", "b"]
                    )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
            starts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                now = tuple(key[s].tolist())
                if now != cell and held:
                    yield from out(_joined(held))
                    held = []
                cell = now
                held.append(batch.slice(s, e - s))
        if held:
            yield from out(_joined(held))

    return cells.mapInArrow(meet, "a long, b long").distinct()


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", text_keys: bool = False) -> DataFrame:
    """Per row: id, n_shingles, component_id, kept; with text_keys also text_key, to tell rows of one id apart.

    Words are runs of characters other than space and 0x09 to 0x0D, A-Z in lower case. A text's set has its
    distinct five-word shingles; with fewer words the whole sequence; null, empty and blank texts have
    an empty set and are linked with nothing. component_id is the smallest id reachable over links. Ids
    are integers. A null id takes part in nothing: component_id is null and kept true. Rows that repeat
    an id and text share their result; rows with one id and different texts are linked each by its own text.
    An empty table gives an empty result. Other columns are not read.
    """
    table = written(sketches(docs, id_col, text_col), "sketches")
    full = table.where("n_shingles > 0 and id is not null")
    classes = full.groupBy("set_key").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"),
        F.first("bands").alias("bands"), *[F.first(c).alias(c) for c in SKETCH_COLUMNS],
    )
    # The written table fixes the classes' numbers; an id may stand for several classes.
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    buckets = classes.select("node", "rep", F.explode("bands").alias("key"))
    # A bucket's leader is its class with the smallest id: of copies the original often comes first.
    leader = F.min_by("node", F.struct("rep", "node")).alias("leader")
    keys = buckets.groupBy("key").agg(leader, F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(join_groups(buckets, keys, "key", "n", "node").where("n is not null"), "buckets")
    stars = shared.where("leader <> node").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = written(confirmed(written(likely(stars, classes), "pairs"), classes, docs, id_col, text_col), "links")
    labels = components(links)
    met = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = apart_pairs(shared.select("key", "node", "rep"), labels, classes).join(met, ["a", "b"], "left_anti")
    more = written(confirmed(written(rest, "pairs"), classes, docs, id_col, text_col), "links")
    joined = written(
        classes.select("node", "rep").join(merged(labels, more), "node").select("node", "rep", "label"), "labels"
    )
    least = joined.groupBy("label").agg(F.min("rep").alias("component"), F.count(F.lit(1)).alias("members"))
    named = join_groups(joined, least, "label", "members", "node").select(F.col("node").alias("_node"), "component")
    resolved = classes.join(named, classes["node"] == named["_node"], "left").select(
        "set_key", "n", F.coalesce("component", "rep").alias("component")
    )
    found = join_groups(table.select("id", "text_key", "n_shingles", "set_key"), resolved, "set_key", "n", "id")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return found.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        *["text_key"] * text_keys,
    )


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
