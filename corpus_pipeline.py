"""A training corpus in five stages: quality, exact copies, near copies, benchmark passages, tokens.

Each stage works on what the one before it kept, read back from Parquet. All but the last return the
columns of documents, whatever they are.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, exact_dedup, near_dedup, quality
from tidemark.llm.id_filter import without_ids
from tidemark.llm.pieces import limit_batches
from tidemark.llm.scratch import written

#: Not expressible in SQL: the stages learn, sketch and tokenize. tests/llm holds brute-force versions.
ORACLE_SQL = None

#: The stages share executors whose heap the ones before have filled, so less is held outside it than where an operator runs
#: alone: bytes of an Arrow batch, and what the tokenizer remembers (times bpe's own) and cuts at once.
BATCH_BYTES = 2 << 20
TOKENIZER = {"times": 1 / 3, "at_once": 512 << 10}


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _free(docs: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, lengthened until no column has them."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return tuple(out)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    model = quality.fit_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = _free(docs, "_score", "_predicted")
    scored = quality.quality_scores(docs, model, names=names)
    return scored.where(F.col(names[1]) == 1).drop(*names)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.exact_dedup(docs, carry=docs.columns).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    # A row is named by its id and text: an id may stand for several texts, some of them kept.
    (key,) = _free(docs, "_key")
    dropped = near_dedup.near_dedup(docs, text_keys=True).where("not kept").select(F.concat_ws(":", "doc_id", "text_key"))
    keyed = docs.withColumn(key, F.concat_ws(":", "doc_id", near_dedup.text_key(docs["text"])))
    return without_ids(keyed, key, written(dropped, "dropped")).drop(key)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    names = _free(docs, "_items", "_contaminated")
    marked = decontaminate.decontaminate(docs, benchmark, names=names)
    return marked.where(~F.col(names[1])).drop(*names)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids of every document."""
    import public_tokenizers

    return bpe.bpe_codes(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True, **TOKENIZER)


def _lean(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        limit_batches(spark, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", _lean(keep_good)),
    ("exact_dedup", _lean(drop_copies)),
    ("near_dedup", _lean(drop_near_copies)),
    ("decontaminate", _lean(drop_leaks)),
    ("bpe", _lean(tokenize)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
