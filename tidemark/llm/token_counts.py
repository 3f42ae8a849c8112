"""Token counts: the tokenizer runs in Arrow batches and only lengths come back.

White space ends a pre-token in this tokenizer, so a text may be cut there without changing its
tokens. Batches are cut by bytes, texts at white space; each different piece of a batch is
encoded once, and a text's count is the sum over its pieces. Long texts so never enter the
tokenizer whole, unless they have no white space at all.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.caches import claim
from tidemark.llm.pieces import bytes_of, per_text, small_batches

#: A context of so many tokens.
LIMIT = 2048
#: Pieces whose counts a worker remembers, and pieces given to the tokenizer at once.
REMEMBERED, AT_ONCE = 1_000_000, 20_000


class PieceCounter(dict):
    """Token counts of pieces without ASCII white space, worked out in batches by the library."""

    def __init__(self, tokenizer_file: str):
        super().__init__()
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def learn(self, pieces: list[bytes]) -> None:
        for start in range(0, len(pieces), AT_ONCE):
            part = pieces[start : start + AT_ONCE]
            encoded = self.tokenizer.encode_batch_fast(
                [p.decode() for p in part], add_special_tokens=False
            )
            self.update(zip(part, map(len, encoded), strict=True))

    def count(self, texts: list[bytes]) -> list[int]:
        split = [t.split() for t in texts]
        wanted = set().union(*split) if split else set()
        new = [p for p in wanted if p not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(wanted)
        self.learn(new)
        look = self.__getitem__
        return [sum(map(look, pieces)) for pieces in split]


@functools.cache
def _counter(tokenizer_file: str) -> PieceCounter:
    """A worker process keeps one, with what it has learnt, from task to task."""
    return PieceCounter(tokenizer_file)


def token_counts(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows come back repeated; other columns
    are not read. The tokenizer must treat white space as a boundary and drop it; special strings in
    a text are special tokens, as is the library's default.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        claim("token_counts", _counter.cache_clear)
        texts = bytes_of(batch, "_text")
        n = np.array(_counter(tokenizer_file).count(texts), dtype=np.int64)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), pa.array(n), pa.array(n > limit)],
            names=[id_col, "n_bytes", "n_tokens", "over_limit"],
        )

    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(source).mapInArrow(
        per_text("_text", work),
        f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean",
    )


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
