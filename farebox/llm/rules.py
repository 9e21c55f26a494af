"""Quality rules and robust multivariate outliers, in DataFrame functions only.

Each text gets counts (words, symbols, repeated lines, words in repeated
three-word windows).  Four transformed statistics of it are compared
with the other texts of its language and source: the minimum covariance
determinant estimate (the mean and covariance of the ``coverage`` share of rows
with the least Mahalanobis distance, found by concentration steps from the
medians) gives a distance that outliers cannot pull towards themselves.

Statistics are rounded to integers, so that sums are exact, medians and
quantiles have a bounded state whatever the group, and the verdict
does not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import is_small, join_groups, ready

SPACE = " \t\n\x0b\x0c\r"
STATS = ("s_len", "s_sym", "s_dup", "s_rep")
#: Distances are binned on a log scale of this many bins per doubling.
BINS = 16


def word_array(text: Column) -> Column:
    core = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(core) == 0, F.array().cast("array<string>")).otherwise(F.split(core, r"[\x20\x09-\x0D]+"))


def text_counts(df: DataFrame, text_col: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    df = df.withColumn("_t", text).withColumn("_w", word_array(F.col("_t")))
    df = df.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0))
    df = df.withColumn(
        "_h",
        F.when(
            F.size("_w") >= 3,
            F.transform(F.sequence(F.lit(1), F.size("_w") - 2), lambda i: F.xxhash64(F.get("_w", i - 1), F.get("_w", i), F.get("_w", i + 1))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    df = df.select(
        *[c for c in df.columns if c not in ("_t", "_w", "_lines")],
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    # Windows in hash order, only where some hash occurs twice.
    df = df.withColumn(
        "_s",
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    df = df.withColumn(
        "_p",
        F.sort_array(
            F.transform(
                F.filter(
                    "_s",
                    lambda e, k: (F.get("_s", k + 1)["h"] == e["h"]) | F.coalesce(F.get("_s", k - 1)["h"] == e["h"], F.lit(False)),
                ),
                lambda e: e["i"],
            )
        ),
    )
    cover = F.transform("_p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_p", k + 1) - p, F.lit(3))))
    repeat = F.coalesce(F.aggregate(cover, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    return df.withColumn("n_repeat_words", repeat).drop("_h", "_s", "_p")


def _transformed() -> list[Column]:
    """ln-scaled statistics in thousandths (long)."""
    words = F.greatest(F.col("n_words"), F.lit(1))

    def mil(x):
        return F.round(F.lit(1000.0) * F.log(x)).cast("long")

    return [
        mil(F.greatest(F.col("word_chars"), F.lit(1)) / words).alias("s_len"),
        mil(1 + 20.0 * F.col("n_symbols") / words).alias("s_sym"),
        mil(1 + 20.0 * F.col("n_dup_lines") / words).alias("s_dup"),
        mil(1 + 5.0 * F.col("n_repeat_words") / words).alias("s_rep"),
    ]


def _cholesky(mean: list[Column], cov) -> list[Column]:
    """Columns m0.. and the lower factor l00, l10, l11, .. of a covariance."""
    p = len(mean)
    return [mean[i].alias(f"m{i}") for i in range(p)] + [cov(i, j).alias(f"c{i}{j}") for i in range(p) for j in range(i + 1)]


def _factor(est: DataFrame, p: int) -> DataFrame:
    for i in range(p):
        for j in range(i + 1):
            inner = F.col(f"c{i}{j}")
            for k in range(j):
                inner = inner - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            est = est.withColumn(f"l{i}{j}", F.sqrt(F.greatest(inner, F.lit(1.0))) if i == j else inner / F.col(f"l{j}{j}"))
    return est.drop(*[f"c{i}{j}" for i in range(p) for j in range(i + 1)])


def _distance(df: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution."""
    p, total = len(STATS), F.lit(0.0)
    for i, s in enumerate(STATS):
        y = F.col(s) - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}{k}") * F.col(f"y{k}")
        df = df.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
        total = total + F.col(f"y{i}") * F.col(f"y{i}")
    drop = [f"y{i}" for i in range(p)] + [f"m{i}" for i in range(p)] + [f"l{i}{j}" for i in range(p) for j in range(i + 1)]
    df = df.withColumn("d2", total).drop(*drop)
    return df.withColumn("bin", F.floor(BINS * F.log2(1 + F.least(F.col("d2"), F.lit(1e12)))).cast("int"))


def _moments(df: DataFrame, keys: list[str], floor: float) -> DataFrame:
    p = len(STATS)
    sums = [F.sum(s).alias(f"s{i}") for i, s in enumerate(STATS)]
    cross = [F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"q{i}{j}") for i in range(p) for j in range(i + 1)]
    agg = df.groupBy(*keys).agg(F.count("*").alias("n"), *sums, *cross)
    mean = [F.col(f"s{i}") / F.col("n") for i in range(p)]

    def cov(i, j):
        return F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j] + F.lit(floor if i == j else 0.0)

    return _factor(agg.select(*keys, *_cholesky(mean, cov)), p)


def robust_distance(stats: DataFrame, keys: list[str], coverage: float = 0.75, steps: int = 3, floor: float = 150.0**2) -> DataFrame:
    """``stats`` with ``d2``: squared robust distance of each row inside its
    group, scaled so that the median is at most that of a clean sample."""
    p = len(STATS)
    med = stats.groupBy(*keys).agg(*[F.percentile(s, 0.5).alias(f"m{i}") for i, s in enumerate(STATS)]).checkpoint()
    small = is_small(med, keys)
    mad = join_groups(stats, med, keys, small).groupBy(*keys).agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(p)],
        *[F.percentile(F.round(F.abs(F.col(s) - F.col(f"m{i}"))), 0.5).alias(f"a{i}") for i, s in enumerate(STATS)],
    )
    start = _cholesky([F.col(f"m{i}") for i in range(p)], lambda i, j: F.pow(F.col(f"a{i}") * 1.4826, 2) + floor if i == j else F.lit(0.0))
    est = _factor(mad.select(*keys, *start), p).checkpoint()
    for _ in range(steps):
        near = _distance(join_groups(stats, est, keys, small))
        cut = near.groupBy(*keys).agg(F.ceil(F.percentile("bin", coverage)).alias("cut"))
        est = _moments(join_groups(near, cut, keys, small).where("bin <= cut"), keys, floor).checkpoint()
    far = _distance(join_groups(stats, est, keys, small))
    # The core's covariance is too small: the median distance of four normal
    # statistics is 3.357 (a fixed value); scale where the group's is above.
    scale = far.groupBy(*keys).agg(F.greatest(F.lit(1.0), (F.pow(2.0, F.percentile("bin", 0.5) / BINS) - 1) / 3.357).alias("scale"))
    return join_groups(far, scale, keys, small).withColumn("d2", F.col("d2") / F.col("scale")).drop("scale", "bin")


def quality_rules(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    coverage: float = 0.75, cutoff: float = 100.0, min_words: int = 50,
) -> DataFrame:
    """One row per input row: ``id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, d2, kept``.

    base_failed: fewer than ``min_words`` words, or over half of the words in
    repeated three-word windows.  kept: not base_failed and d2 at most
    ``cutoff``.  Estimates cover all rows that pass the base rules; others have
    no d2.  Null text is empty; null language and source are groups of their
    own; a group of one row is its own centre (d2 0); repeated rows count each.
    An empty table gives no rows; other columns are ignored."""
    ready(df.sparkSession)
    src = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("g_lang"), F.col(f"`{lang_col}`").isNull().alias("g_nolang"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("g_source"), F.col(f"`{source_col}`").isNull().alias("g_nosource"),
        F.col(f"`{text_col}`").alias("_text"),
    )
    stats = text_counts(src, "_text").drop("_text")
    stats = stats.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    stats = stats.select("*", *_transformed()).checkpoint()
    keys = ["g_lang", "g_nolang", "g_source", "g_nosource"]
    judged = robust_distance(stats.where("not base_failed"), keys, coverage)
    out = judged.unionByName(stats.where("base_failed"), allowMissingColumns=True)
    return out.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "d2",
        F.coalesce(~F.col("base_failed") & (F.col("d2") <= cutoff), F.lit(False)).alias("kept"),
    )
