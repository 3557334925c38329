"""The corpus queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff, byte_bpe, decontamination, jaccard, pii, quality, token_counts, token_file, url_rules, warc
from .common import materialize, original, own_columns, table
from .lookup import bitmap_filter

#: Host and path prefixes with their verdicts. Fixed values.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: The session's setting that holds the key of the pseudonyms, and the key of sessions without one (tests).
KEY_SETTING, TEST_KEY = "spark.turnweave.pseudonym.key", "turnweave"


def pseudonym_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, TEST_KEY)


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled page is one whose number has a label; low quality or toxic means block."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    labelled = pages.join(labels, pages.page_id == labels.doc_id).select("url", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    return url_rules.judge_urls(pages, URL_RULES, url_rules.mine_rules(labelled))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.token_archive(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    references = quality.fit_references(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return quality.quality_rules(docs, references)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return _quality(spark, docs, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept")


def op7_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores to six decimals."""
    out = backoff.stupid_backoff(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", *(F.round(c, 6).alias(c) for c in ("log10_score", "log10_mean")))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join: the components and each document's exact number of links."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def url_listed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rule list alone says; null where no rule of it fits."""
    out = op1_url_rules(spark, sf_dir)
    return out.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("listed_verdict"))


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the quality rules count, and the base rule."""
    return op6_quality(spark, sf_dir).drop("class_distance", "word_distance", "kept")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents", "doc_id", "text"), pseudonym_key(spark)).withColumn("n_values", F.size("pii"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return out.drop("text")


# Stages of the pipeline: (spark, docs, sf_dir) to what is left of docs.


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject.

    Null and empty texts have no words and go; a null ``doc_id`` or ``lang`` changes nothing but that a row without a
    language is not compared. Repeated rows are judged each. All columns keep their values, whatever their names.
    """
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    held = own_columns(docs, "doc_id", "text", "lang")
    references = quality.fit_references(held, labels)
    return original(quality.quality_rules(held, references).where("kept"), docs.columns, "doc_id", "text", "lang")


def stage_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: of the group's smallest id, one row.

    Where rows of that id differ, the one whose text and then whole content has the smallest digest stays; the others
    are near duplicates of it or share its id, and what shares an id is one document. Rows without an id and empty
    texts link with nothing: the former all stay, of the latter one row an id. No column changes.
    """
    found = jaccard.jaccard_components(docs.select("doc_id", "text"), count_links=False)
    # Documents whose group has a smaller one go; they and repeated ids are few, so only narrow rows are shuffled.
    gone = materialize(found.where("doc_id <> component_id").select("doc_id").distinct(), "duplicates")
    again = materialize(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    # A bitmap of fixed size lets most rows pass without a shuffle of their texts.
    kept = bitmap_filter(docs, "doc_id", gone, outside=True)
    left = kept.union(bitmap_filter(docs, "doc_id", gone).join(gone, "doc_id", "left_anti").select(*docs.columns))
    if again.isEmpty():
        return left
    digest = F.struct(F.sha1(F.coalesce(F.col("text").cast("binary"), F.lit(b""))), F.sha1(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns)))))
    several = left.join(again, "doc_id", "left_semi").select("doc_id", digest.alias("__order"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    first = several.groupBy("doc_id").agg(F.min_by("__row", "__order").alias("__row")).select("__row.*")
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).union(first)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop contaminated documents.

    Null and empty texts have no words and stay, and so does everything where the benchmark is empty. Repeated rows
    are judged each. All columns keep their values, whatever their names.
    """
    held = own_columns(docs, "text")
    out = decontamination.contamination(held, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return original(out.where("not contaminated"), docs.columns, "text")


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms; ``n_chars`` follows the text where the table has it.

    Null and empty texts stay as they are, repeated rows are treated each; no other column changes.
    """
    out = original(pii.pseudonymise(own_columns(docs, "text"), pseudonym_key(spark)), docs.columns, "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out


def stage_byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left: ids and digests of every row; null and empty texts have no token."""
    return byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (op1_url_rules, op2_token_counts, op3_byte_bpe, op4_warc, op5_token_file, op6_quality, op7_backoff, op8_jaccard, op9_pii, op10_decontamination, url_listed_rules, quality_base)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    from . import oracle

    return oracle.SQL
