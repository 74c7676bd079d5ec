"""The registered queries of the subpackage. Digest columns are derived here from what the operators return."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (bpe, classifier, decontaminate, lexical, licenses, mixing, pii, quality, secrets, simhash, substring,
                           toxicity, vector_codes)
from plumbline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    spans = F.col("spans")
    return pii.find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id", *[F.size(of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(written(of_kind(spans, *pii.BASE)), 256).alias("base_sha256"), written(spans).alias("spans"),
        F.array_max(F.transform(spans, lambda s: s["score"])).alias("highest_score"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in windows of benchmark items, and these items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
                        F.size("near_items").cast("long").alias("n_near"), F.sha2(F.array_join("near_items", ","), 256).alias("near_sha256"))


ORACLES["op2_decontamination"] = decontaminate.CONTAMINATION_SQL


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, compression ratios and the verdict for every document."""
    return quality.measure_quality(table(spark, sf_dir, "documents"))


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and license notices in every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near-duplicates of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, those in repeated windows, and a digest of the others."""
    return substring.mark_repeats(table(spark, sf_dir, "documents"))


ORACLES["op6_substring"] = substring.SUBSTRING_SQL


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, from a network trained on findings labelled in the same documents."""
    docs, spans = table(spark, sf_dir, "documents"), F.col("spans")
    return secrets.find_secrets(docs, secrets.labelled_findings(docs)).select(
        "doc_id", *[F.size(of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(written(of_kind(spans, *secrets.BASE)), 256).alias("base_sha256"), written(spans).alias("spans"),
        F.size(of_kind(spans, "model")).cast("long").alias("n_model"))


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, posterior, score and verdict for every document."""
    return classifier.score_quality(table(spark, sf_dir, "documents"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learnt from four fifths of the labelled ones."""

    def fifth(key: Column) -> Column:
        return F.crc32(key.cast("string").cast("binary")) % 5

    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fifth(F.col("id")) != 0)
    return scored.select("doc_id", F.coalesce(fifth(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "flagged")


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies and words of every document in a mix of all sources."""
    return mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "copies", "taken")


ORACLES["op10_mixing"] = mixing.MIX_SQL


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector, what it loses, and a digest of the codebooks learnt from all vectors."""
    coded, books = vector_codes.compress_vectors(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


ORACLES["op11_vector_codes"] = vector_codes.VECTOR_SQL


#: The tokenizer file of ``op12_bpe``.
TOKENIZER = os.environ.get("PLUMBLINE_TOKENIZER", "byte_bpe_50k.json")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A path as it is; a bare name stands for a file of the installed public tokenizers."""
    if os.path.dirname(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, as a digest, and a digest of the text decoded from them."""
    path = tokenizer_path()

    @F.pandas_udf("string")
    def digest(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: hashlib.sha256(x.astype("<u4").tobytes()).hexdigest())

    encoded = bpe.encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), path, keep_text=False)
    return bpe.decode_ids(encoded, path).select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                                                digest("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    found = lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("query_id").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


ORACLES["op13_lexical"] = lexical.SEARCH_SQL
