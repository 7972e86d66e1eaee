"""Robust multivariate outliers by minimum-covariance-determinant estimates.

Each document is a vector of transformed statistics. Per language and source,
the estimate is the mean and covariance of the share ``KEEP`` of the documents
whose covariance has the smallest determinant. It is found by concentration
steps: from a start that is robust by itself (medians, and spreads from the
median deviation), every step takes the documents nearest by Mahalanobis
distance and estimates anew, which never raises the determinant. Documents
beyond ``CUT`` in the final distance, corrected for consistency, are rejected.

Nearest documents are found by counts over narrow distance classes, so a step is
one grouped sum with a row for each group and class; no group is gathered. The
class in which the share is reached is taken whole, which keeps ties together.
Groups with fewer than ``LEAST`` usable documents are judged by their language's
estimate, and where that has too few, by the one of all documents. These are
fitted on all usable documents of the language, or of the table; an estimate
that no document is judged by is not fitted.

Everything is DataFrame expressions; the loop has a fixed number of steps.

Defined results: a NULL or empty text has all counts 0 and fails the base rule;
NULL languages and sources are groups of their own; repeated rows count each;
a spread of 0 is floored at ``FLOOR``, so identical documents stay; with no
usable document at all nothing but the base rule rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.llm.common import pieces_of, saved
from slicewright.llm.text_stats import with_counts

KEEP = 0.75
STEPS = 4
#: The nearest three quarters of so many documents are five for each of the five dimensions.
LEAST = 34
FLOOR = 0.05
#: Groups whose estimates are written to one file.
GROUPS = 10_000
#: Distance classes for each doubling of the squared distance.
FINE = 16
#: For five normal features: the 1 - 1e-6 quantile of chi square, and what the
#: covariance of the nearest three quarters has to be multiplied by.
CUT, CONSISTENCY = 37.3, 1.40
STATS = ["x1", "x2", "x3", "x4", "x5"]
PAIRS = [(i, j) for i in range(len(STATS)) for j in range(i + 1)]


def transformed() -> dict[str, Column]:
    """The vector: logs of length and word length; symbols, repeated lines and repeated words for each word."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "x1": F.log(n) / 2,
        "x2": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n) * 2,
        "x3": F.col("n_symbols") / n,
        "x4": 10 * F.col("n_dup_lines") / n,
        "x5": F.col("n_repeat_words") / n,
    }


def _factor(est: DataFrame) -> DataFrame:
    """Cholesky factor ``l_i_j`` of the covariance ``c_i_j``, pivots floored."""
    for i, j in PAIRS:
        rest = F.col(f"c_{i}_{j}")
        for k in range(j):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        value = F.sqrt(F.greatest(rest, F.lit(FLOOR**2))) if i == j else rest / F.col(f"l_{j}_{j}")
        est = est.withColumn(f"l_{i}_{j}", value)
    return est


def _with_distance(rows: DataFrame, est: DataFrame) -> DataFrame:
    """``rows`` and their squared Mahalanobis distance ``d2`` to the group's estimate."""
    near = rows.join(est, "g", "left")
    for i, x in enumerate(STATS):
        rest = F.col(x) - F.col(f"m_{i}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        near = near.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
    d2 = sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(1, len(STATS))), F.col("y_0") * F.col("y_0"))
    return near.withColumn("d2", d2).select(*rows.columns, "d2")


def _concentrated(rows: DataFrame) -> DataFrame:
    """Mean and covariance of each group's nearest documents."""
    step = F.floor(F.log2(F.col("d2") + 0.01) * FINE)
    sums = {"n": F.count("*")} | {f"s_{i}": F.sum(x) for i, x in enumerate(STATS)}
    sums |= {f"p_{i}_{j}": F.sum(F.col(STATS[i]) * F.col(STATS[j])) for i, j in PAIRS}
    by_class = rows.groupBy("g", step.alias("step")).agg(*(v.alias(k) for k, v in sums.items()))
    # a group has a row for each distance class, whatever its size
    gathered = by_class.groupBy("g").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("step", "n"))).alias("h"))
    running = F.aggregate(
        "h",
        F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("edge")),
        lambda a, x: F.struct(
            (a["seen"] + x["n"]).alias("seen"),
            F.coalesce(a["edge"], F.when(a["seen"] + x["n"] >= F.ceil(F.col("total") * KEEP), x["step"])).alias("edge"),
        ),
    )
    edges = gathered.select("g", running["edge"].alias("edge"))
    inner = by_class.join(edges, "g").where("step <= edge").groupBy("g").agg(*(F.sum(k).alias(k) for k in sums))
    est = inner.select(
        "g",
        *((F.col(f"s_{i}") / F.col("n")).alias(f"m_{i}") for i in range(len(STATS))),
        *(
            (F.col(f"p_{i}_{j}") / F.col("n") - F.col(f"s_{i}") * F.col(f"s_{j}") / (F.col("n") * F.col("n")) + (FLOOR**2 if i == j else 0.0)).alias(f"c_{i}_{j}")
            for i, j in PAIRS
        ),
    )
    return _factor(est)


def _start(rows: DataFrame) -> DataFrame:
    """Medians and median deviations of each group, without correlation.

    The medians are written first: a join with a table of known size sends it to the rows, not a group's rows to one task.
    """
    mids = saved(rows.groupBy("g").agg(*(F.percentile_approx(x, 0.5, 2_000).alias(f"m_{i}") for i, x in enumerate(STATS))), "outlier-medians")
    off = rows.join(mids, "g").groupBy("g").agg(
        *(F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{i}")), 0.5, 2_000).alias(f"d_{i}") for i, x in enumerate(STATS))
    )
    spread = {f"l_{i}_{i}": F.greatest(1.4826 * F.col(f"d_{i}"), F.lit(2 * FLOOR)) for i in range(len(STATS))}
    flat = {f"l_{i}_{j}": F.lit(0.0) for i, j in PAIRS if i != j}
    return _kept(mids.join(off, "g").withColumns(spread | flat).drop(*(f"d_{i}" for i in range(len(STATS)))), mids.count())


def _kept(est: DataFrame, groups: int) -> DataFrame:
    """The estimates of ``groups`` groups, written to a file for every ``GROUPS`` of them."""
    return saved(est.repartition(pieces_of(groups, GROUPS)), "outlier-estimates")


def judge(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """``id_col``, the base counts, ``base_failed``, ``distance2`` (NULL if the base rule failed) and ``kept``."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source")
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = saved(
        with_counts(rows, "text").select("id", "lang", "source", *counts).withColumn("base_failed", failed).withColumns(transformed()),
        "text-statistics",
    )
    n_own = stats.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("n_own"))
    small = F.col("n_own") < LEAST
    by_lang = n_own.groupBy(F.col("lang").alias("l")).agg(F.sum("n_own").alias("n_lang"), F.max(small).alias("some_small"))
    lang_judges, few = (F.col("n_lang") >= LEAST) & F.col("some_small"), F.col("n_lang") < LEAST
    whole = by_lang.agg(F.max(few).alias("all_judges"))
    # to_json leaves NULLs out, so the level is part of the name
    own, of_lang = (F.concat(F.lit(k), F.to_json(F.struct(*c))) for k, c in (("source ", ["lang", "source"]), ("language ", ["lang"])))
    of_all = F.lit("all")
    level = n_own.join(by_lang, F.col("lang").eqNullSafe(F.col("l"))).crossJoin(F.broadcast(whole)).select(
        F.col("lang").alias("l"),
        F.col("source").alias("s"),
        F.when(~small, own).when(~few, of_lang).otherwise(of_all).alias("g"),
        F.array_compact(F.array(F.when(~small, own), F.when(lang_judges, of_lang), F.when(F.col("all_judges"), of_all))).alias("fits"),
    )
    same = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    dealt = saved(stats.join(level, same, "left").drop("l", "s"), "outlier-groups")
    fit = dealt.where(~F.col("base_failed")).select(F.explode("fits").alias("g"), *STATS)
    est = _start(fit)
    groups = est.count()
    for _ in range(STEPS):
        est = _kept(_concentrated(_with_distance(fit, est)), groups)
    near = F.when(~F.col("base_failed"), F.col("d2") / CONSISTENCY)
    out = _with_distance(dealt.drop("fits"), est).withColumn("distance2", near)
    kept = ~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= CUT)
    return out.select(F.col("id").alias(id_col), *counts, "base_failed", kept.alias("kept"), "distance2")
