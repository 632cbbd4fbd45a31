"""Registered queries of the operators: each applies one to its whole table, with its SQL counterpart where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.llm import alignment, decontaminate, license_scan, line_dedup, lm_score, merkle, near_dedup, pieces, quality_rules, secret_scan, sql, token_store, url_filter, url_labels, warc
from candlewright.llm.base import ascii_lower, saved

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_warc(spark: SparkSession, d: str) -> DataFrame:
    folder = warc.new_folder(spark)
    warc.write_archive(table(spark, d, "pages"), folder)
    return warc.read_archive(spark, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Rules of the url query.
URL_RULES = (
    url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/"),
)


def op2_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.judged(table(spark, d, "pages"), URL_RULES, url_filter.train(url_labels.labelled(spark)))


def op3_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.notices(table(spark, d, "documents"))


def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op5_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op6_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return pieces.encoded(table(spark, d, "documents"))


def op7_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.scanned(table(spark, d, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.STRONG))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def op8_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.grouped(table(spark, d, "documents"), width=3, percent=85)


def op9_lm_score(spark: SparkSession, d: str) -> DataFrame:
    return lm_score.scored(table(spark, d, "documents"))


def op10_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.judged(table(spark, d, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_merkle(spark: SparkSession, d: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_of(text=ascii_lower(F.col("text"))))
    m = merkle.manifest(table(spark, d, "documents"), {"tampered": tampered})
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return merkle.proofs(m).select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(merkle.proof_text(F.col("path"))).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_token_store(spark: SparkSession, d: str) -> DataFrame:
    folder = token_store.new_folder(spark)
    token_store.write_tokens(table(spark, d, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_tokens(spark, folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op13_alignment(spark: SparkSession, d: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    rows = alignment.aligned(table(spark, d, "documents"), *paths, digest=True).withColumnRenamed("groups", "groups_sha256")
    return alignment.linked(saved(rows, "alignment"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_warc, op2_url_filter, op3_license_scan, op4_decontamination, op5_line_dedup, op6_sentencepiece, op7_secret_scan, op8_near_dedup, op9_lm_score, op10_quality_rules, op11_merkle, op12_token_store, op13_alignment)}
ORACLES: dict[str, str] = {"op1_warc": sql.OP1, "op5_line_dedup": sql.OP5, "op10_quality_rules": sql.OP10, "op11_merkle": sql.OP11}
