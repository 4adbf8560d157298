"""Corpus pipeline: five stages in order, each written as Parquet and read as the
next one's documents. Nulls, repeated rows, empty tables and extra columns are
handled as each operator's docstring states; all columns of the input pass
through the filtering stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import scratch
from lodestone.llm.probminhash import keep_one_per_class
from lodestone.llm.sentencepiece_agenda import encode_ids
from lodestone.llm.simhash_windows import drop_contaminated
from lodestone.llm.weak_pii import redact
from lodestone.llm.weak_toxicity import drop_toxic
from lodestone.sources.shared import remove, shared_path, write_shared
from lodestone.sources.tables import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier rejects go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return keep_one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind in brackets; ``n_chars`` follows the new text."""
    out = redact(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType))
    return out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of every document left."""
    return encode_ids(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("tokens", tokens)]
#: The first stage is a learned model, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's own tables go once its result is written, and
    that goes once the next stage has read it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        with scratch(spark):
            docs, _ = write_shared(stage(spark, docs, sf_dir), name, path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
