"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flankspark.llm import chat, decontaminate, html, importance, jaccard, language_model, mixing, quality, secrets, sharding, simhash, urls, whitening
from flankspark.llm.oracles import ORACLES
from flankspark.tables import table

Query = Callable[[SparkSession, str], DataFrame]
#: Parts of the mixture; a source that isn't named has mixing.DEFAULT_WEIGHT.
WEIGHTS = {"src0": 6, "src1": 3}


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 8)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS, keep=["doc_id", "source"])


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.find_components(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality.FIGURES, "base_failed", "kept")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.render_turns(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_sharding, op2_url_filter, op3_mixing, op4_jaccard_join, op5_html_extraction, op6_quality_rules, op7_secret_scans, op8_lm_scoring, op9_decontamination, op10_chat_formatting, op11_simhash, op12_whitening,
            op13_importance_resampling,
        )
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
