"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes round the features in turn. Each step fits a tree with a few leaves to one feature's
bins and adds it, shrunk, to that feature's lookup table; then a few pairs of features, chosen by what
they still explain, get two-dimensional tables in the same way. A text's score is a sum of table
entries, one per feature and pair: vectorised additions over bin numbers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tidemark.llm.caches import claim
from tidemark.llm.labelled import held_out, sample
from tidemark.llm.pieces import bytes_of, per_text, small_batches

THRESHOLD = 0.5
BINS, PAIR_BINS, PAIRS = 32, 8, 4
ROUNDS, PAIR_ROUNDS, RATE, LEAVES = 150, 60, 0.15, 3

FEATURES = (
    "log_words", "mean_word", "short_words", "long_words", "upper", "digits", "symbols", "marks",
    "distinct_words", "distinct_lines", "distinct_bytes", "beyond_ascii",
)


def _class(chars: bytes) -> np.ndarray:
    mask = np.zeros(256, dtype=np.float64)
    mask[list(chars)] = 1
    return mask


_UPPER = _class(bytes(range(65, 91)))
_LETTER = _class(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGIT = _class(b"0123456789")
_MARK = _class(b".,;:?'\"-()")
_SPACE = _class(b" \t\n\x0b\x0c\r")
_HIGH = _class(bytes(range(128, 256)))
_CLASSES = np.stack([_UPPER, _LETTER, _DIGIT, _MARK, _SPACE, _HIGH])


def features(text: bytes) -> list[float]:
    """One number per name in FEATURES, over the whole text; all 0 for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    upper, letters, digits, marks, space, high = _CLASSES @ counts
    n, solid = len(words), len(text) - space
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lines = text.split(b"\n")
    return [
        math.log1p(n),
        solid / n,
        np.count_nonzero(sizes <= 3) / n,
        np.count_nonzero(sizes >= 12) / n,
        upper / max(letters, 1),
        digits / solid,
        (solid - letters - digits - marks) / solid,
        marks / solid,
        len(set(words)) / n,
        len(set(lines)) / len(lines),
        np.count_nonzero(counts) / 256,
        high / solid,
    ]


@dataclass
class AdditiveModel:
    """Cut points and lookup tables: table i over bins of feature i, pair tables over two coarse bins."""

    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for i, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[i], x[:, i])]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            a, b = (np.searchsorted(self.coarse[f], x[:, f]) for f in (i, j))
            total += table[a, b]
        return 1 / (1 + np.exp(-total))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: float, h: float) -> float:
    return g / (h + 1.0)


def _gain(g: np.ndarray | float, h: np.ndarray | float) -> np.ndarray | float:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """A tree over ordered bins, grown best split first, as the value of each bin."""
    spans, out = [(0, len(g))], np.zeros(len(g))
    while len(spans) < leaves:
        best = (1e-6, None, None)
        for s, (a, b) in enumerate(spans):
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            k = int(np.argmax(gains))
            if gains[k] > best[0]:
                best = (gains[k], s, a + k + 1)
        if best[1] is None:
            break
        a, b = spans.pop(best[1])
        spans += [(a, best[2]), (best[2], b)]
    for a, b in spans:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The best cross of one cut on each axis of a grid: four leaves, and what they gain."""
    sums = [np.cumsum(np.cumsum(m, 0), 1) for m in (g, h)]
    best, at = -1.0, (1, 1)
    for a in range(1, g.shape[0]):
        for b in range(1, g.shape[1]):
            gain = 0.0
            corners = []
            for s in sums:
                tl, top, left, all_ = s[a - 1, b - 1], s[a - 1, -1], s[-1, b - 1], s[-1, -1]
                corners.append((tl, top - tl, left - tl, all_ - top - left + tl))
            gain = sum(_gain(x, y) for x, y in zip(*corners, strict=True))
            if gain > best:
                best, at = gain, (a, b)
    out = np.zeros_like(g)
    for rows in (slice(None, at[0]), slice(at[0], None)):
        for cols in (slice(None, at[1]), slice(at[1], None)):
            out[rows, cols] = _leaf(g[rows, cols].sum(), h[rows, cols].sum())
    return out, best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit to rows of features and 0/1 labels; without both classes the score is constant.

    The classes weigh the same in all, whatever their shares; so a score of 0.5 is where a text is as likely
    among the one as among the other, and the bias is 0 unless the score is constant.
    """
    n_features = len(FEATURES)
    empty = [np.zeros(0)] * n_features
    ones, n = int(y.sum()) if len(y) else 0, len(y)
    if ones == 0 or ones == n:
        bias = 0.0 if not n else math.log((ones + 0.5) / (n - ones + 0.5))
        return AdditiveModel(empty, [np.zeros(1)] * n_features, empty, [], [], bias)
    cuts = [_cuts(x[:, i], BINS) for i in range(n_features)]
    coarse = [_cuts(x[:, i], PAIR_BINS) for i in range(n_features)]
    bins = [np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)]
    grid = [np.searchsorted(c, x[:, i]) for i, c in enumerate(coarse)]
    weight = np.where(y == 1, n / (2 * ones), n / (2 * (n - ones)))
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.zeros(n)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(ROUNDS):
        for i, b in enumerate(bins):
            size = len(tables[i])
            if size < 2:
                continue
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, size), np.bincount(b, h, size), LEAVES)
            tables[i] += step
            total += step[b]

    def table_of(i: int, j: int, values: np.ndarray) -> np.ndarray:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return np.bincount(grid[i] * shape[1] + grid[j], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = sorted(
        ((_pair_tree(table_of(i, j, g), table_of(i, j, h))[1], i, j)
         for i in range(n_features) for j in range(i) if len(coarse[i]) and len(coarse[j])),
        reverse=True,
    )
    pairs = [(i, j) for _, i, j in gains[:PAIRS]]
    pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(pairs, pair_tables, strict=True):
            g, h = slopes()
            step = RATE * _pair_tree(table_of(i, j, g), table_of(i, j, h))[0]
            table += step
            total += step[grid[i], grid[j]]
    return AdditiveModel(cuts, tables, coarse, pairs, pair_tables, 0.0)


def fit_from(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", target="quality") -> AdditiveModel:
    _, texts, y = sample(docs, labels, target, id_col, text_col)
    x = np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))
    return fit(x, np.array(y, dtype=np.float64))


def quality_scores(
    docs: DataFrame,
    model: AdditiveModel,
    text_col: str = "text",
    threshold: float = THRESHOLD,
    keep_text: bool = True,
    names: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """`docs` with columns `score` (0 to 1) and `predicted` (score >= threshold), or other `names`, put last.

    Whole texts are scored; null and empty ones too (all features 0). Input columns of these two
    names give way, and without keep_text the texts stay behind. Rows neither shuffle nor change their order; repeated rows score alike.
    """
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    source = docs.select(*kept)
    back = [c for c in kept if keep_text or c != text_col]
    fields = [docs.schema[c] for c in back]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        claim("quality", lambda: None)
        x = np.array([features(t) for t in bytes_of(batch, text_col)]).reshape(-1, len(FEATURES))
        score = model.score(x)
        new = [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
        old = [batch.column(c) for c in back]
        return pa.RecordBatch.from_arrays([*old, *new], names=[*back, *names])

    schema = StructType([*fields, StructField(names[0], DoubleType()), StructField(names[1], IntegerType())])
    return small_batches(source).mapInArrow(per_text(text_col, work), schema)


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_scores(docs, model, keep_text=False)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
