"""Queries of the training-data problems: name -> callable(spark, sf_dir)."""

from __future__ import annotations

import os
import secrets

from pyspark.sql import DataFrame, SparkSession, functions as F

from talespan.llm import canonical, packing, pii, runs, survivor, tokens, turns
from talespan.runtime import table


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    keywords = table(spark, d, "segments").where("seg_type = 'keyword'")
    return canonical.map_values(keywords, ["transcript_id", "segment_idx"], "text", table(spark, d, "ref_concepts"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Distinct reference uris meant by the values of each keyword segment."""
    return _mapped(spark, d).where(F.col("uri") != canonical.NO_NAME).select("transcript_id", "segment_idx", "uri").distinct()


def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Report of values without an entry ('unmatched') and of those that only hold general words
    or numbers ('no name'): value, kind and number of segments that hold it."""
    lone = _mapped(spark, d).where(F.col("distance") < 0).select("transcript_id", "segment_idx", F.lower("value").alias("value"), F.col("uri").alias("kind")).distinct()
    return lone.groupBy("value", "kind").agg(F.count("*").alias("n_segments"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(spark, d, "matches"), table(spark, d, "source_trust"))


def p2_merged(spark: SparkSession, d: str) -> DataFrame:
    return survivor.merged_records(table(spark, d, "matches"), table(spark, d, "source_trust"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    got = runs.caption_runs(table(spark, d, "captions"), table(spark, d, "speakers"))
    return got.select("transcript_id", "first_idx", "last_idx", "n_captions", "duration_ms")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return turns.speaker_turns(table(spark, d, "captions"), table(spark, d, "speakers"))


def p6_turn_texts(spark: SparkSession, d: str) -> DataFrame:
    """Turns with times and clean text, also split at pauses calibrated on the corpus."""
    return turns.speaker_turns(table(spark, d, "captions"), table(spark, d, "speakers"), with_text=True, pause_ms=turns.CALIBRATED)


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_documents(table(spark, d, "documents"))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    limits = [(r[0], r[1]) for r in table(spark, d, "token_limits").select("limit_name", "capacity_tokens").collect()]
    return packing.pack_items(tokens.count_tokens(documents), limits, n_items=documents.count())


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Containers of each capacity alone (plan = limit_name) and of all jointly (plan 'mixed')."""
    return _packed(spark, d)


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Report per plan: containers, capacity, tokens, share filled."""
    return packing.fill_report(_packed(spark, d))


def _given(spark: SparkSession, d: str) -> DataFrame:
    return pii.given_names((table(spark, d, "speakers"), "full_name"))


def _key(spark: SparkSession) -> str:
    """The secret key of pseudonyms: ``spark.talespan.pii.key`` or TALESPAN_PII_KEY. Without one
    every run draws its own, so placeholders are linked within a run only."""
    return spark.conf.get("spark.talespan.pii.key", None) or os.environ.get("TALESPAN_PII_KEY") or secrets.token_hex(32)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_personal(table(spark, d, "documents"), _given(spark, d), _key(spark)).drop("placeholder")


def p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text with typed placeholders, all other text as it is."""
    return pii.redact(table(spark, d, "documents"), _key(spark), _given(spark, d))


def p9_redacted_dates(spark: SparkSession, d: str) -> DataFrame:
    """The same with numeric dates permuted too."""
    return pii.redact(table(spark, d, "documents"), _key(spark), _given(spark, d), dates=True)


QUERIES = {f.__name__: f for f in (p1_found, p1_unmatched, p2_found, p2_merged, p4_found, p6_found, p6_turn_texts, p7_ids, p8_containers,
                               p8_fill, p9_found, p9_redacted, p9_redacted_dates)}
