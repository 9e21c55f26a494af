"""Question / tag models (M9–M12) over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farebox.operators import tags
from farebox.plans import domain
from farebox.tables import load

# Tags present in the benchmark names, for the trend mart (the operator's
# default list is the modelled workload's own).
BENCH_TREND_TAGS = ("red", "blue", "small", "large", "ring")


def question_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.explode_tags(domain.tagged_parts(load(spark, sf_dir, "part")))


def tag_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = domain.questions(load(spark, sf_dir, "lineitem"))
    return tags.tag_month(q, question_tags(spark, sf_dir), id_col="part_id")


def top_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.top_tags(tag_month(spark, sf_dir), n=50, digits=4)


def tag_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.tag_trends(tag_month(spark, sf_dir), BENCH_TREND_TAGS)
