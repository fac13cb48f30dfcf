import numpy as np
import pytest
from conftest import make_days

from shelfcast.functions import tails
from shelfcast.operators import profiles, stats


def test_tail_probabilities_against_tables():
    # textbook critical values
    assert tails.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert tails.t_two_sided(12.7062, 1) == pytest.approx(0.05, abs=1e-6)
    assert tails.t_two_sided(0.0, 5) == pytest.approx(1.0)
    assert tails.t_two_sided(1.959964, 1e9) == pytest.approx(0.05, abs=1e-6)
    assert tails.f_upper(4.102821, 2, 10) == pytest.approx(0.05, abs=1e-6)
    assert tails.f_upper(161.4476, 1, 1) == pytest.approx(0.05, abs=1e-6)
    assert tails.f_upper(3.841459, 1, 1e8) == pytest.approx(0.05, abs=1e-6)
    assert tails.f_upper(5712.9, 3, 804106) == 0.0
    # F with one numerator degree is the square of t
    assert tails.f_upper(2.5**2, 1, 17) == pytest.approx(tails.t_two_sided(2.5, 17), rel=1e-12)


def test_welch_against_closed_form(spark):
    pdf = make_days(spark, 3, 50).toPandas()
    a, b = pdf.sales[pdf.promo == 1], pdf.sales[pdf.promo == 0]
    va, vb = a.var() / len(a), b.var() / len(b)
    row = stats.welch_statistics(spark.createDataFrame(pdf)).first()
    assert row["statistic"] == pytest.approx((a.mean() - b.mean()) / np.sqrt(va + vb))
    assert row["df"] == pytest.approx((va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1)))
    test = stats.welch_ttest(spark.createDataFrame(pdf)).first()
    assert test["significant"] and test["statistic"] > 0 and "significant" in test["interpretation"]


def test_anova_against_closed_form(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(0, 1, 40), "b": rng.normal(0.5, 2, 30), "c": rng.normal(1, 1, 20)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [(None, 99.0), ("a", None)]
    df = spark.createDataFrame(rows, "kind string, sales double")
    every = np.concatenate(list(groups.values()))
    ssb = sum(len(v) * (v.mean() - every.mean()) ** 2 for v in groups.values())
    ssw = sum(((v - v.mean()) ** 2).sum() for v in groups.values())
    row = stats.anova_statistics(df, "kind").first()
    assert (row["df1"], row["df2"]) == (2, 87)
    assert row["statistic"] == pytest.approx((ssb / 2) / (ssw / 87))
    assert stats.anova(df, "kind").first()["p_value"] == pytest.approx(tails.f_upper(row["statistic"], 2, 87))


def test_edge_cases(spark):
    one = spark.createDataFrame([(1.0, 1, "a"), (2.0, 1, "a")], "sales double, promo int, store_type string")
    welch = stats.welch_ttest(one).first()
    assert (welch["statistic"], welch["p_value"], welch["significant"]) == (0.0, 1.0, False)
    few = stats.anova(one, "store_type").first()
    assert (few["statistic"], few["p_value"], few["significant"]) == (0.0, 1.0, False)
    missing = stats.anova(one, "assortment").first()
    assert missing["test_name"] == "anova_assortment" and not missing["significant"]
    assert stats.test_suite(one).count() == 2


def test_profiles_follow_the_rules(spark):
    rows = [
        (1, 100.0, 10, 0), (1, 150.0, 20, 1), (1, 200.0, 30, 1),
        (2, 50.0, 5, 1), (2, 70.0, 5, 1),      # no day without promotion: lift 0
        (3, 80.0, 5, 0), (3, 90.0, 5, 0),      # no promotion day: dropped
        (4, 0.0, 0, 0), (4, 0.0, 0, 1),        # no sales: cv and lift 0
        (5, 10.0, 1, 1),                       # one day: cv 0
    ]
    df = spark.createDataFrame(rows, "store_id int, sales double, customers int, promo int")
    got = {r["store_id"]: r for r in profiles.store_profiles(df).collect()}
    assert sorted(got) == [1, 2, 4, 5]
    assert got[1]["promo_lift_pct"] == pytest.approx(75.0)
    assert got[1]["sales_cv"] == pytest.approx(np.std([100, 150, 200], ddof=1) / 150)
    assert got[1]["promo_day_share"] == pytest.approx(2 / 3) and got[1]["avg_daily_customers"] == 20
    assert got[2]["promo_lift_pct"] == 0.0
    assert (got[4]["sales_cv"], got[4]["promo_lift_pct"]) == (0.0, 0.0)
    assert got[5]["sales_cv"] == 0.0
    low = profiles.low_data_stores(df, 0.5).first()
    assert (low["threshold_days"], low["n_flagged"]) == (2.0, 1)
