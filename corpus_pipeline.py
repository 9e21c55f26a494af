"""The corpus pipeline: language ID, SimHash near-dedup, substring dedup,
mixing to target weights, packing.  Every stage works on all the rows its
predecessor kept and, but for the last, returns the columns of documents."""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from farebox.llm import langid, mixing, packing, simhash, substring  # noqa: E402
from farebox.llm.catalog import MIX_SEED, MIX_WEIGHTS, mix_levels  # noqa: E402
from farebox.llm.common import ready  # noqa: E402
from farebox.session import shared_dir  # noqa: E402
from farebox.tables import load  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Share of all tokens that the mixture keeps; no row is used twice.
MIX_SHARE = 0.8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts in no known language (null, or without a letter), and
    notes the predicted language of the others where none is given."""
    pred = langid.identify(docs, docs.where(~langid.held_out("doc_id", 4, 2)), "doc_id", "text", "lang", carry=COLUMNS)
    kept = pred.where(F.col("lang_pred") != langid.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that of the smallest id (rows
    without an id come last)."""
    return simhash.simhash_dedup(docs, "doc_id", "text", shingle=3, max_bits=2, keep_null_ids=False).select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 or more words that an earlier document holds go;
    documents that held nothing else go with them."""
    kept = substring.substring_dedup(docs, "doc_id", "text", window=13, carry=["lang", "source"])
    kept = kept.where("n_words > n_removed or n_words = 0").withColumn("text", F.col("kept").cast("string"))
    return kept.select(F.col("id").alias("doc_id"), "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents to the target weights of domains, languages and sources."""
    chosen = mixing.mix(docs, mix_levels(), MIX_WEIGHTS, MIX_SHARE, 1, MIX_SEED)
    return mixing.mixed_rows(docs, chosen).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 4096-token windows that hold every source's share."""
    out = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), "doc_id", "text", "source", length=4096, end_id=2)
    return out.select(F.col("id").alias("doc_id"), "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("near_copies", near_copies), ("passages", passages), ("mixture", mixture), ("pack", pack)]

#: No SQL: the language model, the fingerprints and the tokenizer have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the
    shared folder and read again."""
    ready(spark)
    docs = load(spark, sf_dir, "documents").select(*COLUMNS)
    base = shared_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
