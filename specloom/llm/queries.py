"""Queries of the text and record problems (1, 2, 7, 8, 9) over the catalog's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.llm import content, entity_match, incremental_dedup, mixing, tokenizer
from specloom.sources.tables import table


def p1_matches(spark: SparkSession, d: str) -> DataFrame:
    return entity_match.match_points(table(spark, d, "coverage_points"), table(spark, d, "crossref_candidates"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_matches(spark, d).select("point_id", "candidate_id")


def _matched(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return entity_match.match(entity_match.point_attributes(table(spark, d, "coverage_points")), entity_match.candidate_attributes(table(spark, d, "crossref_candidates")))


def p1_class_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Matches between classes of equal attributes, which stand for all pairs of their members."""
    return _matched(spark, d)[0]


def p1_members(spark: SparkSession, d: str) -> DataFrame:
    """(side, id, class_id) of every row with a class."""
    _, left, right = _matched(spark, d)
    side = lambda df, name, c: df.select(F.lit(name).alias("side"), "id", F.col(c).alias("class_id"))
    return side(left, "point", "a_class_id").unionByName(side(right, "candidate", "b_class_id"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rows = incremental_dedup.link_batches(table(spark, d, "ingest_candidates"))
    return rows.where("first_id < ingest_id").select(F.col("first_id").alias("ingest_id_a"), F.col("ingest_id").alias("ingest_id_b"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode_corpus(table(spark, d, "documents"))


def p7_source_tokens(spark: SparkSession, d: str) -> DataFrame:
    counted = tokenizer.encode_corpus(table(spark, d, "documents"), counts=True, keep=("source",))
    return counted.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))


def p7_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose decoded bytes are not their text: none."""
    docs = table(spark, d, "documents")
    decoded = tokenizer.decode_corpus(tokenizer.encode_corpus(docs))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(decoded, "doc_id").where(F.encode("text", "utf-8") != F.col("data")).select("doc_id")


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    return content.score_corpus(table(spark, d, "documents"), table(spark, d, "content_labels"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_scores(spark, d).where("harmful").select("doc_id")


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return content.rates(p9_scores(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_matches, p1_class_pairs, p1_members, p2_found, p7_ids, p7_source_tokens, p7_round_trip, p8_mix, p8_shares, p9_found, p9_scores, p9_rates)}

ORACLE: dict[str, str] = {}
