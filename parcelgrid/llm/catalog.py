"""Registered queries of the corpus operators: ``opN_<name>(spark, sf_dir)`` over whole tables,
and the oracle SQL where SQL expresses the result."""

from __future__ import annotations

import os
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html, language, licences, line_dedup, lm, negatives, quality, ranked, simhash, substring, training_order
from .common import shared_path, table
from .oracle import ORACLE_SQL

#: where the public tokenizer files lie; the environment may name another folder
TOKENIZERS = os.environ.get("CORPUS_TOKENIZERS", "")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of every document with its slot, read back from the written shards."""
    layout = training_order.Layout()
    import public_tokenizers
    encoding = (tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    path, n = training_order.materialise(table(spark, sf_dir, "documents"), encoding, "epoch-0", layout, shared_path(spark, "shards"))
    recs = training_order.read_shards(spark, path, layout, digest=True) if n else training_order.empty_records(spark, digest=True)
    return recs.select(F.col("id").alias("doc_id"), "seq_no", "n_tokens", "slot", "shard", "byte_offset", "body_sha256")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: four-word shingles, four bits."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumns({c: F.round(c, 6) for c in ("score", "question_overlap", "answer_overlap")})


def op4_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document under bigram counts of all documents."""
    out = lm.score(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without later repeats of three-line windows."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), removed_col="n_removed")
    return out.select("doc_id", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and the decoded text of every document."""
    out = bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document; strata are languages."""
    out = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumn("broken", F.array_join("broken", ","))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document when repeated 35-word windows go."""
    out = substring.remove_repeats(table(spark, sf_dir, "documents"), width=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def licence_path(doc_id, source):
    """A path for a document: its source, a folder per thousand and one per hundred ids; the first
    documents of a thousand lie in the source's folder, the first of a hundred one level up."""
    package = F.concat(F.lit("p"), F.floor(doc_id / F.lit(1000)).cast("string"))
    module = F.concat(F.lit("m"), F.floor(doc_id % 1000 / F.lit(100)).cast("string"))
    name = F.concat(doc_id.cast("string"), F.lit(".txt"))
    return F.when(doc_id % 1000 < 10, F.concat_ws("/", source, name)).when(
        doc_id % 100 < 10, F.concat_ws("/", source, package, name)).otherwise(F.concat_ws("/", source, package, module, name))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document: its own notice, else that of the nearest folder above.
    A document that opens with a notice speaks for its folder."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", licence_path(F.col("doc_id"), F.col("source")).alias("path"))
    out = licences.scan(docs, F.col("line") <= 0, "doc_id", "path", "text")
    return out.withColumn("own_cosine", F.round("own_cosine", 6))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the three quarters of the ids that are not held out."""
    docs = table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    out = language.identify(docs.withColumn("held_out", F.coalesce(part == 2, F.lit(False))), part != 2, carry=("doc_id", "held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector for each of its five positives; every seventh label is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over the documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_training_order, op2_simhash, op3_decontaminate, op4_stupid_backoff, op5_line_dedup, op6_bpe, op7_quality, op8_main_text,
    op9_substring_dedup, op10_licences, op11_language, op12_ranked_search, op13_hard_negatives, pipeline)}
ORACLE = dict(ORACLE_SQL)
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
