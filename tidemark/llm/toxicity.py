"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words cut to their first STEM letters, a plain stemming that joins the inflections of a word in most
languages. The vocabulary has every term of the sampled examples; idf counts all documents. A text's vector is
(1 + log tf) * idf over the vocabulary, scaled to length 1; terms that no example has aren't part of the model.

The examples are ordered so that like ones stand together and cut into blocks. The index has, by term, the
largest weight in each block: with a query's weights they bound the cosine of every example of a block. A block
is scored only if its bound reaches the k-th best cosine found so far, so the k nearest are exact. They
vote with their cosines, those of the rarer class weighing more; a logistic curve fitted to the left-out votes of the examples, moved to the labels' own
share of ones, makes the votes a probability. The voters' ids and cosines are the evidence.
"""

from __future__ import annotations

import math
import pickle
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.caches import claim
from tidemark.llm.labelled import held_out, sample
from tidemark.llm.pieces import bytes_of, per_text, small_batches

THRESHOLD = 0.7
#: Nearest examples that vote, and letters of a term.
NEAREST, STEM = 41, 4
#: Examples in a block, and texts searched for in one step.
BLOCK, AT_ONCE = 64, 64
#: Voters whose ids and cosines are written as evidence.
EVIDENCE = 5
#: Pieces that a worker remembers.
REMEMBERED = 300_000
#: What single-precision sums may be off by; such ties are settled in double precision.
SLACK = 1e-4

_EDGES = " \t\r\n.,;:!?\"'()[]{}<>|*#$%&=+/\\`~^_-"


def term_of(piece: bytes) -> str:
    """The term of a piece without white space: lower case, without the marks around it, cut; may be empty."""
    return piece.decode().lower().strip(_EDGES)[:STEM]


class _Pieces(dict):
    """Term numbers by piece; -1 for a piece without a term of the vocabulary."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, piece: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[piece] = self.terms.get(term_of(piece), -1)
        return found


@dataclass
class Vocabulary:
    """Term numbers, and idf by number."""

    terms: dict[str, int]
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __post_init__(self):
        self.seen = _Pieces(self.terms)

    def __getstate__(self):
        return {"terms": self.terms, "idf": self.idf}

    def __setstate__(self, state: dict):
        self.__dict__.update(state)
        self.__post_init__()

    def count(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of a whole text's terms, in order, and how often each occurs."""
        found = np.fromiter(map(self.seen.__getitem__, text.split()), dtype=np.int64)
        found = found[found >= 0]
        found.sort()
        at = np.flatnonzero(np.diff(found, prepend=-1))
        return found[at], np.diff(at, append=len(found))

    def weighed(self, numbers: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights, scaled to length 1; terms of weight 0 stay out."""
        weights = (1 + np.log(tf)) * self.idf[numbers]
        numbers, weights = numbers[weights > 0], weights[weights > 0]
        return numbers, weights / math.sqrt(float(weights @ weights)) if len(weights) else weights

    def vector(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        return self.weighed(*self.count(text))


Vector = tuple[np.ndarray, np.ndarray]


def like_order(vectors: list[Vector], terms: int, rounds: int = 6) -> np.ndarray:
    """An order of the examples in which like ones stand together: groups of a k-means over random projections."""
    rng = np.random.default_rng(17)
    axes = rng.standard_normal((terms, 48))
    points = np.stack([w @ axes[n] for n, w in vectors])
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    groups = max(1, len(vectors) // (2 * BLOCK))
    centres = points[rng.permutation(len(points))[:groups]]
    for _ in range(rounds):
        near = (points @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    sizes = np.array([len(n) for n, _ in vectors])
    first = (centres @ centres[0]).argsort(kind="stable").argsort(kind="stable")
    return np.lexsort((sizes, first[near]))


class BlockMaxIndex:
    """Example vectors in blocks; examples are named by their place in the list given."""

    def __init__(self, vectors: list[Vector], terms: int, order: np.ndarray | None = None):
        self.n, self.terms = len(vectors), terms
        self.order = np.arange(self.n) if order is None else order
        placed = [vectors[i] for i in self.order]
        self.numbers = np.concatenate([np.zeros(0, dtype=np.int64), *(v[0] for v in placed)])
        self.weights = np.concatenate([np.zeros(0), *(v[1] for v in placed)])
        self.start = np.concatenate([[0], np.cumsum([len(v[0]) for v in placed], dtype=np.int64)]).astype(np.int64)
        self.blocks: list[tuple[np.ndarray, np.ndarray]] = []
        starts = range(0, self.n, BLOCK)
        self.largest = np.zeros((terms, len(starts)), dtype=np.float32)
        for b, first in enumerate(starts):
            some = placed[first : first + BLOCK]
            own = np.unique(np.concatenate([v[0] for v in some]))
            dense = np.zeros((len(own), len(some)), dtype=np.float32)
            for column, (numbers, weights) in enumerate(some):
                dense[np.searchsorted(own, numbers), column] = weights
            self.blocks.append((own, dense))
            self.largest[own, b] = dense.max(1, initial=0)
        self.place = np.empty(self.n, dtype=np.int64)
        self.place[self.order] = np.arange(self.n)
        self.scored = 0  # blocks of texts, to see what the bounds spare

    def _score(self, queries: np.ndarray, wanted: np.ndarray, scores: np.ndarray) -> None:
        for b, (own, dense) in enumerate(self.blocks):
            rows = np.flatnonzero(wanted[:, b])
            if len(rows):
                self.scored += len(rows)
                scores[rows, b * BLOCK : b * BLOCK + dense.shape[1]] = queries[rows[:, None], own] @ dense

    def nearest_all(self, vectors: list[Vector], k: int, skip: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """Per vector the k nearest as (cosine, example), ties to the smaller number; cosines of 0 don't count."""
        if not self.n:
            return [[] for _ in vectors]
        out = []
        for first in range(0, len(vectors), AT_ONCE):
            some = vectors[first : first + AT_ONCE]
            queries = np.zeros((len(some), self.terms), dtype=np.float32)
            for query, (numbers, weights) in zip(queries, some, strict=True):
                query[numbers] = weights
            left_out = None if skip is None else [int(self.place[s]) if s >= 0 else -1 for s in skip[first : first + AT_ONCE]]
            out += self._search(some, queries, k, left_out)
        return out

    def _search(self, some: list[Vector], queries: np.ndarray, k: int, left_out: list[int] | None) -> list[list[tuple[float, int]]]:
        bounds = queries @ self.largest
        scores = np.zeros((len(some), self.n), dtype=np.float32)
        wanted = np.zeros(bounds.shape, dtype=bool)
        enough = min(bounds.shape[1], -(-2 * k // BLOCK) + 1)
        best = np.argpartition(-bounds, enough - 1, axis=1)[:, :enough]
        np.put_along_axis(wanted, best, True, axis=1)
        self._score(queries, wanted, scores)

        def kth() -> np.ndarray:
            if left_out is not None:
                rows = [i for i, p in enumerate(left_out) if p >= 0]
                scores[rows, [left_out[i] for i in rows]] = 0
            return np.partition(scores, self.n - k, axis=1)[:, self.n - k] if self.n > k else np.zeros(len(some), dtype=np.float32)

        rest = ~wanted & (bounds >= kth()[:, None] - SLACK) & (bounds > 0)
        self._score(queries, rest, scores)
        least = kth() - SLACK
        found, full = [], np.zeros(self.terms)
        for i, (numbers, weights) in enumerate(some):
            places = np.flatnonzero((scores[i] > 0) & (scores[i] >= least[i]))
            full[numbers] = weights
            found.append(self._exact(full, places, k))
            full[numbers] = 0
        return found

    def _exact(self, full: np.ndarray, places: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k best of some places, by cosines in double precision that no other text or example has a part in."""
        start = self.start[places]
        size = self.start[places + 1] - start
        each = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        cosines = np.bincount(np.repeat(np.arange(len(places)), size), full[self.numbers[each]] * self.weights[each], minlength=len(places))
        examples = self.order[places]
        top = np.lexsort((examples, -np.round(cosines, 12)))[:k]
        return list(zip(cosines[top].tolist(), examples[top].tolist(), strict=True))

    def nearest(self, numbers: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> list[tuple[float, int]]:
        return self.nearest_all([(numbers, weights)], k, [skip])[0]


class Model:
    """The examples' ids, labels and term counts, and what follows from them: each worker builds the index itself."""

    def __init__(self, vocabulary: Vocabulary, counts: list[Vector], ids: list, labels: np.ndarray):
        self.vocabulary, self.ids, self.labels = vocabulary, ids, labels
        self.slope, self.start = 0.0, 0.0
        self.weigh = [len(labels) / max(2 * int((labels == v).sum()), 1) for v in (0, 1)]
        self.sizes = np.array([len(n) for n, _ in counts], dtype=np.int64)
        self.numbers = np.concatenate([np.zeros(0, dtype=np.int32), *(n.astype(np.int32) for n, _ in counts)])
        self.tf = np.concatenate([np.zeros(0, dtype=np.int32), *(tf.astype(np.int32) for _, tf in counts)])
        self.order = like_order(self.vectors(), len(vocabulary.terms)) if counts else np.zeros(0, dtype=np.int64)
        self._build()

    def _build(self) -> None:
        self.index = BlockMaxIndex(self.vectors(), len(self.vocabulary.terms), self.order)

    def vectors(self) -> list[Vector]:
        """Of the examples, in order."""
        ends = np.cumsum(self.sizes)
        return [
            self.vocabulary.weighed(self.numbers[a:b].astype(np.int64), self.tf[a:b])
            for a, b in zip((ends - self.sizes).tolist(), ends.tolist(), strict=True)
        ]

    def __getstate__(self):
        return zlib.compress(pickle.dumps({k: v for k, v in self.__dict__.items() if k != "index"}), 6)

    def __setstate__(self, packed: bytes):
        self.__dict__.update(pickle.loads(zlib.decompress(packed)))
        self._build()

    def margin(self, near: list[tuple[float, int]]) -> float:
        """The voters' cosines, toxic ones less clean ones, as a share of all; both classes weigh the same in all examples."""
        for_, against = (self.weigh[v] * sum(c for c, e in near if self.labels[e] == v) for v in (1, 0))
        return (for_ - against) / (for_ + against) if near else 0.0

    def nearest(self, vectors: list[Vector], skip: list[int] | None = None) -> list[list[tuple[float, int]]]:
        return self.index.nearest_all(vectors, NEAREST, skip)

    def probability(self, margin: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * margin + self.start))))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and start of p(y | x) by Newton's method, with a light ridge."""
    scale = float(np.abs(x).max()) or 1.0
    design = np.stack([x / scale, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        g = design.T @ (y - p) - np.array([1e-2, 1e-6]) * w
        h = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-2, 1e-3])
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]) / scale, float(w[1])


def document_counts(docs: DataFrame, terms: dict[str, int], text_col: str) -> tuple[int, np.ndarray]:
    """How many documents there are, and how many have each term: over all rows and whole texts."""
    vocabulary = pickle.dumps(Vocabulary(terms))

    def count(batches):
        claim("toxicity", _kept.clear)
        words = _worker(vocabulary)
        rows, found = 0, np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            for text in bytes_of(batch, text_col):
                rows += 1
                found[words.count(text)[0]] += 1
        there = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *there.tolist()], pa.int32()), pa.array([rows, *found[there].tolist()], pa.int64())],
            names=["term", "n"],
        )

    sums = docs.select(text_col).mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(len(terms), dtype=np.int64)
    rows = sums.toArrow()  # a row for each term of the examples at most
    numbers, n = rows.column("term").to_numpy(), rows.column("n").to_numpy()
    out[numbers[numbers >= 0]] = n[numbers >= 0]
    return int(n[numbers < 0].sum()), out


_kept: dict[bytes, object] = {}


def _worker(pickled: bytes):
    """A worker process keeps what it was sent last, and what that has learnt, from task to task."""
    if pickled not in _kept:
        _kept.clear()  # before the next one is built
        _kept[pickled] = pickle.loads(pickled)
    return _kept[pickled]


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", target="toxic") -> Model:
    """Fit on a bounded sample of labelled rows (labelled.sample); idf over all documents.

    Without both classes there are no examples, and every score is the share of ones, or 0. Nothing is chosen
    by the labels, so the left-out votes that calibrate the curve are those of unseen rows.
    """
    ids, texts, y = sample(docs, labels, target, id_col, text_col)
    share = (labels.where(F.col(target).isin(0, 1) & ~held_out(id_col)).agg(F.avg(target)).first()[0]) or 0.0
    names = sorted({term_of(p) for t in texts for p in set(t.split())} - {""}) if 0 < sum(y) < len(y) else []
    vocabulary = Vocabulary({t: i for i, t in enumerate(names)})
    if not names:
        model = Model(vocabulary, [], [], np.zeros(0))
        model.start = math.log(share / (1 - share)) if 0 < share < 1 else (50.0 if share else -50.0)
        return model
    total, have = document_counts(docs, vocabulary.terms, text_col)
    vocabulary.idf = np.log((1 + total) / (1 + have))
    model = Model(vocabulary, [vocabulary.count(t) for t in texts], ids, np.array(y))
    vectors = model.vectors()
    margins = np.array([model.margin(near) for near in model.nearest(vectors, list(range(len(vectors))))])
    model.slope, model.start = _logistic(margins, np.array(y, dtype=np.float64))
    # The sample has other shares of the classes than the labels.
    ones = sum(y) / len(y)
    if 0 < share < 1:
        model.start += math.log(share / (1 - share)) - math.log(ones / (1 - ones))
    return model


def toxicity_scores(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    evidence: int = EVIDENCE,
) -> DataFrame:
    """Per row: id, score, predicted (score >= threshold), nearest (the first `evidence` voters: id, cosine, label).

    Whole texts are scored. A text that shares no term with any example, so an empty or null one too, has no voters
    and gets the score of an even vote. Rows don't shuffle; repeated rows score alike; an empty table gives an
    empty result; other columns are not read. Example ids are those of the labels' table, as text.
    """
    pickled = pickle.dumps(model)
    out = [id_col, "score", "predicted", "nearest"]
    near_type = pa.list_(pa.struct([("id", pa.string()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        claim("toxicity", _kept.clear)
        m: Model = _worker(pickled)
        score, shown = [], []
        texts = bytes_of(batch, "_text")
        for first in range(0, len(texts), AT_ONCE):
            for near in m.nearest([m.vocabulary.vector(t) for t in texts[first : first + AT_ONCE]]):
                score.append(m.probability(m.margin(near)))
                shown.append([{"id": m.ids[e], "cosine": c, "label": int(m.labels[e])} for c, e in near[:evidence]])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32()), pa.array(shown, near_type)],
            names=out,
        )

    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(source).mapInArrow(
        per_text("_text", work, 4 << 20),
        f"`{id_col}` {kind}, score double, predicted int, nearest array<struct<id:string,cosine:double,label:int>>",
    )


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and the first voters as evidence."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity_scores(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "nearest")
