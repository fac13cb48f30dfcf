"""Hypothesis tests on daily sales: Welch's t-test on promotions, one-way ANOVA over a factor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.money import mean
from shelfcast.functions.tails import f_p_value, t_p_value

ALPHA = 0.05


def welch_statistics(df: DataFrame, sales: str = "sales", promo: str = "promo") -> DataFrame:
    """One row: group sizes, means, t, Satterthwaite degrees of freedom and lift; one pass."""
    on, off = F.when(F.col(promo) == 1, F.col(sales)), F.when(F.col(promo) == 0, F.col(sales))
    groups = df.agg(
        F.count(on).alias("n1"),
        F.count(off).alias("n0"),
        F.avg(on).alias("promo_mean"),
        F.avg(off).alias("non_promo_mean"),
        F.var_samp(on).alias("v1"),
        F.var_samp(off).alias("v0"),
    )
    e1, e0 = F.try_divide("v1", "n1"), F.try_divide("v0", "n0")
    spread = F.try_divide(e1 * e1, F.col("n1") - 1) + F.try_divide(e0 * e0, F.col("n0") - 1)
    lift = F.when(
        F.col("non_promo_mean") != 0, (F.col("promo_mean") - F.col("non_promo_mean")) / F.col("non_promo_mean") * 100
    ).otherwise(0.0)
    return groups.select(
        "n1",
        "n0",
        "promo_mean",
        "non_promo_mean",
        F.try_divide(F.col("promo_mean") - F.col("non_promo_mean"), F.sqrt(e1 + e0)).alias("statistic"),
        F.try_divide((e1 + e0) * (e1 + e0), spread).alias("df"),
        lift.alias("lift_pct"),
    )


def welch_ttest(df: DataFrame, sales: str = "sales", promo: str = "promo") -> DataFrame:
    """Promotion days against the others, unequal variances; an empty group gives (0, 1, false)."""
    stats = welch_statistics(df, sales, promo).withColumn("p", t_p_value(F.col("statistic"), F.col("df")))
    empty = (F.col("n1") == 0) | (F.col("n0") == 0)
    significant = F.coalesce(F.col("p") < ALPHA, F.lit(False))
    yes = F.format_string(
        "Promotion days sell %.1f%% differently (promo mean %.0f, other mean %.0f, p=%.2e): significant, H0 rejected.",
        "lift_pct",
        "promo_mean",
        "non_promo_mean",
        "p",
    )
    no = F.format_string(
        "Promotion mean %.0f and other mean %.0f do not differ significantly (p=%.4f): H0 kept.",
        "promo_mean",
        "non_promo_mean",
        "p",
    )
    return stats.select(
        F.lit("welch_ttest_promo_vs_non_promo").alias("test_name"),
        F.when(empty, 0.0).otherwise(F.col("statistic")).alias("statistic"),
        F.when(empty, 1.0).otherwise(F.col("p")).alias("p_value"),
        F.when(empty, False).otherwise(significant).alias("significant"),
        F.when(empty, "Too few rows in one of the groups for Welch's t-test.")
        .when(significant, yes)
        .otherwise(no)
        .alias("interpretation"),
    )


def group_means(df: DataFrame, group: str, sales: str = "sales") -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.round(mean(F.col(sales)), 0).alias("mean_sales"))


def anova_statistics(df: DataFrame, group: str, sales: str = "sales") -> DataFrame:
    """One row: F and its degrees of freedom; map-side aggregation per group, then over the groups.

    The between-group sum is centred on the grand mean of the group rows (a scalar subquery over the
    aggregated groups), so the data itself is read in one pass and large means do not cancel.
    """
    per_group = (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(sales).alias("n"), F.avg(sales).alias("m"), F.var_samp(sales).alias("v"))
    )
    n = F.col("n").cast("double")
    grand = per_group.agg((F.try_divide(F.sum(n * F.col("m")), F.sum(n))).alias("grand")).scalar()
    sums = per_group.agg(
        F.count("*").alias("groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.sum(n * (F.col("m") - grand) * (F.col("m") - grand)).alias("ssb"),
        F.sum(F.coalesce(F.col("v"), F.lit(0.0)) * (n - 1)).alias("ssw"),
    )
    df1, df2 = F.col("groups") - 1, F.col("rows") - F.col("groups")
    ratio = F.try_divide(F.try_divide("ssb", df1), F.try_divide("ssw", df2))
    return sums.select(
        "groups",
        "rows",
        F.when(F.col("groups") >= 2, ratio).alias("statistic"),
        df1.alias("df1"),
        df2.alias("df2"),
    )


def anova(df: DataFrame, group: str, sales: str = "sales") -> DataFrame:
    """One-way ANOVA; a missing factor or fewer than two groups gives (0, 1, false)."""
    name = F.lit(f"anova_{group.lower()}").alias("test_name")
    if group not in df.columns:
        return df.sparkSession.range(1).select(
            name,
            F.lit(0.0).alias("statistic"),
            F.lit(1.0).alias("p_value"),
            F.lit(False).alias("significant"),
            F.lit(f"There is no column {group}.").alias("interpretation"),
        )
    stats = anova_statistics(df, group, sales).withColumn(
        "p", f_p_value(F.col("statistic"), F.col("df1"), F.col("df2"))
    )
    few = F.col("groups") < 2
    significant = F.coalesce(F.col("p") < ALPHA, F.lit(False))
    # the text names every group with its rounded mean
    named = group_means(df, group, sales).select(
        F.format_string("%s: %.0f", F.col(group).cast("string"), F.col("mean_sales")).alias("named")
    )
    means = named.agg(F.concat_ws(", ", F.array_sort(F.collect_list("named"))).alias("means")).scalar()
    yes = F.format_string(
        f"Sales differ between the {group} groups (F=%.4f, p=%.2e; means %s): significant, H0 rejected.",
        F.col("statistic"),
        F.col("p"),
        means,
    )
    no = F.format_string(
        f"Sales do not differ significantly between the {group} groups (F=%.4f, p=%.4f; means %s): H0 kept.",
        F.col("statistic"),
        F.col("p"),
        means,
    )
    return stats.select(
        name,
        F.when(few, 0.0).otherwise(F.col("statistic")).alias("statistic"),
        F.when(few, 1.0).otherwise(F.col("p")).alias("p_value"),
        F.when(few, False).otherwise(significant).alias("significant"),
        F.when(few, f"Fewer than two groups in {group}.").when(significant, yes).otherwise(no).alias("interpretation"),
    )


def test_suite(df: DataFrame) -> DataFrame:
    """All tests as rows, figures rounded for the report."""
    tests = welch_ttest(df).unionByName(anova(df, "store_type"))
    if "assortment" in df.columns:
        tests = tests.unionByName(anova(df, "assortment"))
    rows = df.agg(F.count("*").alias("n")).scalar()
    return tests.select(
        F.lit(ALPHA).alias("alpha"),
        rows.alias("n_rows_tested"),
        "test_name",
        F.round("statistic", 4).alias("statistic"),
        F.round("p_value", 6).alias("p_value"),
        "significant",
        "interpretation",
    )
