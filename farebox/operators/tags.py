"""Tag marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.columns import month_start
from farebox.operators.revenue import rounded

# Fixed value: the tag list of the trend mart.
TREND_TAGS = ("python", "java", "javascript", "sql", "pandas")


def explode_tags(df: DataFrame, id_col: str = "id", tags_col: str = "tags", sep: str = "|") -> DataFrame:
    """M9: one row per (question, tag).  ``split`` takes a regex, so the
    separator is matched literally through a character class.  A null list
    yields no row; an empty string yields one empty tag; ``a||b`` yields an
    empty tag between; only null tags are filtered."""
    pattern = "[" + sep.replace("\\", "\\\\").replace("]", "\\]") + "]"
    return (
        df.select(F.col(id_col).alias("question_id"), F.explode(F.split(F.col(tags_col), pattern)).alias("tag"))
        .filter(F.col("tag").isNotNull())
    )


def tag_month(
    questions: DataFrame,
    question_tags: DataFrame,
    id_col: str = "id",
    time_col: str = "creation_date",
    score_col: str = "score",
    views_col: str = "view_count",
) -> DataFrame:
    """Per (month, tag): questions, average score, average views.

    Questions are first reduced to one row per (question id, month) holding
    count and sums, and only then joined with their tags; averages are sums
    over counts of the reduced rows.  The join input no longer grows with the
    rows of a hot question (it is bounded by ids × months), and the result
    equals the plain join-then-aggregate."""
    values = {"score": F.col(score_col).cast("double"), "views": F.col(views_col).cast("double")}
    pre = questions.groupBy(F.col(id_col).alias("question_id"), month_start(time_col).alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(v).alias(f"s_{name}") for name, v in values.items()],
        *[F.count(v).alias(f"n_{name}") for name, v in values.items()],
    )
    joined = pre.join(question_tags, "question_id")
    averages = {name: F.try_divide(F.sum(f"s_{name}"), F.sum(f"n_{name}").cast("double")) for name in values}
    return joined.groupBy("month", "tag").agg(
        F.sum("n").alias("question_count"),
        *[avg.alias(f"avg_{name}") for name, avg in averages.items()],
    )


def top_tags(fact: DataFrame, n: int = 50, digits: int | None = None) -> DataFrame:
    """Per tag the summed count and the *unweighted* average of monthly
    averages; top ``n`` by total (tag breaks ties) – a TakeOrderedAndProject."""
    avg = rounded(F.avg("avg_score"), digits)
    per_tag = fact.groupBy("tag").agg(F.sum("question_count").alias("total_questions"), avg.alias("avg_score"))
    return per_tag.orderBy(F.col("total_questions").desc(), F.col("tag").asc()).limit(n)


def tag_trends(fact: DataFrame, tags: Sequence[str] = TREND_TAGS) -> DataFrame:
    """Monthly counts of selected tags, ordered by month (then tag)."""
    return fact.filter(F.col("tag").isin(*tags)).select("month", "tag", "question_count").orderBy("month", "tag")
