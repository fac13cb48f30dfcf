"""Named queries over the tables under test: each wires library functions, and rounds for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import bi, clean, cluster, evaluate, features, fraud, models, preprocess, profiles, split, stats
from shelfcast.plans import pipelines
from shelfcast.schema import LAGS, OPTIONAL_SALES, PROFILE_FEATURES, SALES_SCHEMA, SOURCE_HEADERS, WINDOWS
from shelfcast.session import stage
from shelfcast.sources import registry, tables, tpch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# History features that serve as forecasts where a deterministic model is wanted.
NAIVE = ("sales_lag_7", "sales_rolling_mean_7", "sales_rolling_mean_30")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- shared inputs -------------------------------------------------------------------------------


def _open(spark, d):
    return clean.open_days(tpch.panel(spark, d))


def _history(spark, d):
    days = clean.open_days(tpch.sales(spark, d)).select("store_id", "date", "sales", "is_zero_sales_anomaly")
    return features.history_features(days)


def _panel(spark, d):
    return features.engineer(clean.clean(tpch.panel(spark, d)))


def _profiles(spark, d):
    return profiles.store_profiles(clean.open_days(tpch.sales(spark, d)))


def _holdout_naive(spark, d):
    _, val = split.holdout_split(_history(spark, d))
    return evaluate.naive_predictions(val, NAIVE)


def _rounded(df, columns, digits):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- panel ---------------------------------------------------------------------------------------


@query
def panel_base(spark, d):
    return tpch.panel(spark, d)


def _as_source(spark, d):
    """The sales as a source file has them: its headers, all text, and some values that cannot be read."""
    days = tpch.sales(spark, d)
    broken = F.pmod(F.datediff("date", F.lit("1992-01-01").cast("date")) * 7 + F.col("store_id"), F.lit(211))
    text = {c: F.col(c).cast("string") for c in days.columns}
    text["customers"] = F.when(broken == 3, "n/a").when(broken == 4, "4.5").when(broken == 5, " ").otherwise(text["customers"])
    text["sales"] = F.when(broken == 6, "12,50").when(broken == 7, "NaN").otherwise(text["sales"])
    text["promo"] = F.when(broken == 3, "yes").otherwise(F.concat("promo", F.lit(".0")))
    return days.select(*[text[c].alias(SOURCE_HEADERS[c]) for c in days.columns])


@query
def ingest_sales(spark, d):
    return tables.canonical(_as_source(spark, d), SALES_SCHEMA, tables.column_mapping(), OPTIONAL_SALES)


@query
def ingest_rejects(spark, d):
    source = _as_source(spark, d)
    rejects = tables.quarantined(source, SALES_SCHEMA, tables.column_mapping(), OPTIONAL_SALES)
    return tables.failure_counts(rejects)


@query
def clean_open(spark, d):
    days = clean.open_days(tpch.sales(spark, d))
    return days.select("store_id", "date", "sales", "is_zero_sales_anomaly")


@query
def impute_median(spark, d):
    return clean.impute(_open(spark, d)).select("store_id", "date", "competition_distance")


@query
def impute_flags(spark, d):
    return clean.impute(_open(spark, d)).select(
        "store_id",
        "date",
        "has_competition_open_date",
        "competition_open_month",
        "competition_open_year",
        "promo2_since_week",
        "promo2_since_year",
        "promo_interval",
        "state_holiday",
    )


@query
def calendar_features(spark, d):
    return features.calendar_features(clean.open_days(tpch.sales(spark, d))).select(
        "store_id", "date", "year", "month", "day", "quarter", "week_of_year", "is_weekend", "is_promo"
    )


@query
def competition_months(spark, d):
    return features.elapsed_features(_open(spark, d)).select("store_id", "date", "months_since_competition")


@query
def promo2_weeks(spark, d):
    return features.elapsed_features(_open(spark, d)).select("store_id", "date", "weeks_since_promo2")


@query
def sales_lags(spark, d):
    return _history(spark, d).select("store_id", "date", *[f"sales_lag_{n}" for n in LAGS])


@query
def sales_rolling(spark, d):
    means = [f"sales_rolling_mean_{n}" for n in WINDOWS]
    stds = [f"sales_rolling_std_{n}" for n in WINDOWS]
    return _rounded(_history(spark, d).select("store_id", "date", *means, *stds), stds, 3)


@query
def sales_history_segmented(spark, d):
    days = stage(clean.open_days(tpch.sales(spark, d)).select("store_id", "date", "sales"), "days")
    out = features.segmented_history_features(days, segment_rows=256)
    return _rounded(out.drop("sales"), [f"sales_rolling_std_{n}" for n in WINDOWS], 3)


@query
def chrono_split(spark, d):
    rows = _open(spark, d).select("store_id", "date")
    return split.with_part(rows)


@query
def prepare_features(spark, d):
    prepared, _, _ = preprocess.prepare_features(_panel(spark, d))
    return _rounded(prepared, [f"sales_rolling_std_{n}" for n in WINDOWS], 3)


@query
def sample_frac(spark, d):
    return pipelines.sampled(_open(spark, d).select("store_id", "date", "sales"), 0.1)


# --- tests ---------------------------------------------------------------------------------------


@query
def welch_ttest(spark, d):
    return stats.welch_statistics(clean.open_days(tpch.sales(spark, d))).select(
        "n1",
        "n0",
        F.round("statistic", 6).alias("statistic"),
        F.round("df", 3).alias("df"),
        F.round("lift_pct", 6).alias("lift_pct"),
    )


def _anova(spark, d, group):
    return stats.anova_statistics(_open(spark, d), group).select(
        F.round("statistic", 6).alias("statistic"), "df1", "df2"
    )


@query
def anova_storetype(spark, d):
    return _anova(spark, d, "store_type")


@query
def anova_assortment(spark, d):
    return _anova(spark, d, "assortment")


@query
def group_means(spark, d):
    return stats.group_means(_open(spark, d), "store_type")


@query
def test_report(spark, d):
    return stats.test_suite(_open(spark, d))


# --- segmentation --------------------------------------------------------------------------------


@query
def store_profiles(spark, d):
    return _rounded(_profiles(spark, d), PROFILE_FEATURES, 6)


@query
def low_data_stores(spark, d):
    return _rounded(profiles.low_data_stores(clean.open_days(tpch.sales(spark, d))), ["threshold_days"], 6)


@query
def profile_scaled(spark, d):
    return _rounded(cluster.scale_profiles(stage(_profiles(spark, d), "profiles")), PROFILE_FEATURES, 6)


@query
def silhouette(spark, d):
    vectors = cluster.with_vector(cluster.scale_profiles(stage(_profiles(spark, d), "profiles")))
    labelled = vectors.withColumn("label", (F.col("store_id") % 4).cast("int"))
    score = cluster.silhouette(labelled, ["label"])["label"]
    return labelled.agg(F.count("*").alias("stores"), F.round(F.lit(score), 6).alias("silhouette"))


@query
def optimal_k(spark, d):
    vectors = cluster.with_vector(cluster.scale_profiles(stage(_profiles(spark, d), "profiles")))
    rows, fitted = [], {}
    for metric in cluster.METRICS:
        best, inertia, scores = cluster.optimal_k(vectors, metric=metric, fitted=fitted)
        rows += [(metric, k, inertia[k], scores[k], k == best) for k in scores]
    return spark.createDataFrame(rows, "metric string, k int, inertia double, silhouette double, is_best boolean")


@query
def store_clusters(spark, d):
    return cluster.segment_stores(stage(_profiles(spark, d), "profiles"))[0]


@query
def cluster_profile(spark, d):
    return cluster.cluster_profile(cluster.segment_stores(stage(_profiles(spark, d), "profiles"))[0])


@query
def profile_by_label(spark, d):
    """The segment report for a labelling that needs no fit, so it has an SQL twin."""
    labelled = _profiles(spark, d).withColumn("cluster", (F.col("store_id") % 4).cast("int"))
    return cluster.cluster_profile(stage(labelled, "labelled"))


@query
def store_pca(spark, d):
    vectors = cluster.with_vector(cluster.scale_profiles(stage(_profiles(spark, d), "profiles")))
    projected, explained = cluster.pca_projection(vectors)
    shares = {f"explained_{i + 1}": F.lit(v) for i, v in enumerate(explained)}
    out = projected.select("store_id", "pca_x", "pca_y", *[v.alias(c) for c, v in shares.items()])
    return _rounded(out, ["pca_x", "pca_y", *shares], 6)


# --- business views ------------------------------------------------------------------------------


@query
def kpi_overview(spark, d):
    return bi.kpi_overview(clean.open_days(tpch.sales(spark, d)))


@query
def kpi_growth(spark, d):
    return bi.kpi_growth(clean.open_days(tpch.sales(spark, d)))


def _resample(frequency):
    def run(spark, d):
        return bi.resample_sum(clean.open_days(tpch.sales(spark, d)), frequency)

    return run


for _frequency in ("daily", "weekly", "monthly", "quarterly"):
    QUERIES[f"resample_{_frequency}"] = _resample(_frequency)


@query
def driver_correlation(spark, d):
    days = features.calendar_features(clean.impute(_open(spark, d)))
    return _rounded(bi.driver_correlation(days), ["correlation"], 6)


@query
def store_leaderboard_top(spark, d):
    return _rounded(bi.leaderboard(_profiles(spark, d), tpch.stores(spark, d)), PROFILE_FEATURES[:2] + ("promo_lift_pct",), 6)


@query
def store_leaderboard_bottom(spark, d):
    rows = bi.leaderboard(_profiles(spark, d), tpch.stores(spark, d), top=False)
    return _rounded(rows, PROFILE_FEATURES[:2] + ("promo_lift_pct",), 6)


@query
def risk_quadrant(spark, d):
    rows = bi.risk_quadrant(stage(_profiles(spark, d), "profiles"))
    return _rounded(rows, ["avg_daily_sales", "sales_cv", "median_sales", "median_cv"], 6)


@query
def store_list(spark, d):
    return bi.store_list(_holdout_naive(spark, d))


@query
def forecast_series(spark, d):
    return bi.forecast_series(_holdout_naive(spark, d), 1, "sales_rolling_mean_7")


@query
def forecast_rollup(spark, d):
    scopes = {"store": 1, "cohort": [1, 2, 3, 4, 5], "chain": None}
    return bi.forecast_rollups(_holdout_naive(spark, d), "sales_rolling_mean_7", ("weekly", "monthly"), scopes)


@query
def forecast_variance(spark, d):
    return _rounded(bi.forecast_variance(_holdout_naive(spark, d), "sales_rolling_mean_7"), ["variance_pct"], 6)


# --- forecasts -----------------------------------------------------------------------------------


@query
def temporal_folds(spark, d):
    rows = clean.open_days(tpch.sales(spark, d)).where("is_zero_sales_anomaly = 0").select("store_id", "date")
    return split.temporal_folds(stage(rows, "days"))


@query
def eval_metrics(spark, d):
    metrics = evaluate.evaluate_models(_holdout_naive(spark, d), {c: c for c in NAIVE})
    return _rounded(metrics, ["rmspe", "mae", "rmse", "r2"], 6)


@query
def model_ranking(spark, d):
    return evaluate.leaderboard_report(evaluate.evaluate_models(_holdout_naive(spark, d), {c: c for c in NAIVE}))


@query
def numeric_preproc(spark, d):
    prepared, numeric, _ = preprocess.prepare_features(_panel(spark, d))
    fitted = preprocess.fit_numeric(stage(prepared, "features"), numeric)
    rows = [(c, *fitted[c]) for c in numeric]
    out = spark.createDataFrame(rows, "feature string, median double, mean double, spread double")
    return _rounded(out, ["median", "mean", "spread"], 4)


@query
def categorical_preproc(spark, d):
    prepared, _, categorical = preprocess.prepare_features(_panel(spark, d))
    rows = prepared.select("store_id", "date", *categorical)
    fitted = preprocess.fit_preprocessor(rows, [], categorical)
    slots = vector_to_array("features")
    names = preprocess.feature_names(fitted, [], categorical)
    return fitted.transform(rows).select(
        "store_id", "date", *[slots[i].cast("int").alias(n) for i, n in enumerate(names)]
    )


def _training(spark, d):
    """Train and holdout parts of the staged panel, with the feature names.

    The median of the distance is read from the staged rows, so the days are derived once.
    """
    panel = clean.impute_distance(stage(features.engineer(clean.impute_known(_open(spark, d))), "panel"))
    train, val = split.holdout_split(panel)
    prepared, numeric, categorical = preprocess.prepare_features(train)
    return prepared, val, numeric, categorical


def _forecast(name, **settings):
    def run(spark, d):
        train, val, numeric, categorical = _training(spark, d)
        fitted, _ = models.fit_pipeline(name, train, numeric, categorical, **settings)
        return pipelines.score_holdout(val, {name: fitted})

    return run


@query
def ridge_forecast(spark, d):
    return _rounded(_forecast("ridge")(spark, d), ["predicted_ridge"], 1)


QUERIES["mlp_forecast"] = _forecast("mlp")
QUERIES["gbt_forecast"] = _forecast("gbt")


@query
def val_predictions(spark, d):
    train, val, numeric, categorical = _training(spark, d)
    shared = preprocess.fit_numeric(train, numeric)
    fitted = {n: models.fit_pipeline(n, train, numeric, categorical, shared)[0] for n in models.MODELS}
    return pipelines.score_holdout(val, fitted)


@query
def cv_metrics(spark, d):
    train, _, numeric, categorical = _training(spark, d)
    folded = stage(split.temporal_folds(train), "folds")
    rows = models.validate_models(list(models.MODELS), folded, numeric, categorical)
    return spark.createDataFrame(
        [(r["model_name"], r["fold"], r["rmspe"], r["mae"], r["rmse"], r["r2"]) for r in rows],
        "model_name string, fold int, rmspe double, mae double, rmse double, r2 double",
    )


@query
def cv_ridge(spark, d):
    """The folds of ``cv_metrics`` for the model that has a closed form."""
    train, _, numeric, categorical = _training(spark, d)
    folded = stage(split.temporal_folds(train), "folds")
    rows = models.validate_models(["ridge"], folded, numeric, categorical)
    out = spark.createDataFrame(
        [(r["model_name"], r["fold"], r["rmspe"], r["mae"], r["rmse"], r["r2"]) for r in rows],
        "model_name string, fold int, rmspe double, mae double, rmse double, r2 double",
    )
    return _rounded(_rounded(out, ["rmspe", "r2"], 4), ["mae", "rmse"], 2)


@query
def ridge_ranking(spark, d):
    """The fitted ridge against the naive forecasts on the holdout, scored and ranked as the job does."""
    train, val, numeric, categorical = _training(spark, d)
    fitted, _ = models.fit_pipeline("ridge", train, numeric, categorical)
    wide = models.predict(fitted, val.withColumn("actual", F.col("sales")), "predicted_ridge")
    return evaluate.leaderboard_report(evaluate.evaluate_models(wide, {"ridge": "predicted_ridge", **{c: c for c in NAIVE}}))


@query
def ridge_importance(spark, d):
    train, _, numeric, categorical = _training(spark, d)
    fitted, _ = models.fit_pipeline("ridge", train, numeric, categorical)
    rows = models.importances(fitted, numeric, categorical)
    return _rounded(spark.createDataFrame(rows, "feature string, importance double"), ["importance"], 4)


@query
def feature_importance(spark, d):
    train, _, numeric, categorical = _training(spark, d)
    shared = preprocess.fit_numeric(train, numeric)
    rows = [
        (name, feature, share)
        for name in ("ridge", "gbt")
        for feature, share in models.importances(
            models.fit_pipeline(name, train, numeric, categorical, shared)[0], numeric, categorical
        )
    ]
    return spark.createDataFrame(rows, "model_name string, feature string, importance double")


@query
def model_latest(spark, d):
    """Manifest with one version per (naive model, year of the panel); the newest version of each."""
    history = _history(spark, d)
    long = evaluate.stack_predictions(
        history.withColumn("stamp", F.year("date").cast("string")).select("stamp", F.col("sales").alias("actual"), *NAIVE),
        {c: c for c in NAIVE},
        keep=("stamp",),
    ).where("predicted is not null")
    manifest = long.groupBy("model_name", "stamp").agg(*evaluate.regression_metrics(F.col("actual"), F.col("predicted")))
    latest = registry.latest_models(manifest.select("model_name", "stamp", "rmspe", "mae"))
    return _rounded(latest, ["rmspe", "mae"], 6)


# --- returns -------------------------------------------------------------------------------------


@query
def derive_returns(spark, d):
    return tpch.returns(spark, d)


@query
def union_returns(spark, d):
    """All purchases and returns as one log with a formatted key."""
    log = tpch.activity(spark, d)
    kinds = [
        log.where(flag).select("transaction_id", "customer_id", "ts", F.lit(kind).alias("kind"), F.col("return_amount").alias("amount"))
        for kind, flag in (("purchase", "is_purchase"), ("return", "is_return"))
    ]
    both = kinds[0].unionByName(kinds[1])
    return both.withColumn("transaction_key", F.format_string("TXN-%07d", "transaction_id"))


@query
def return_features(spark, d):
    return _rounded(fraud.return_features(tpch.returns(spark, d)), ["return_amount_log"], 6)


@query
def train_monitor_split(spark, d):
    log = tpch.returns(spark, d).select("transaction_id", "ts")
    return split.train_monitor(stage(log, "returns")).select("transaction_id", "is_train")


def _amount_thresholds(log):
    return fraud.thresholds(log.where("is_train"), score="return_amount")


@query
def flag_thresholds(spark, d):
    log = split.train_monitor(stage(tpch.returns(spark, d), "returns"))
    p95, p99 = _amount_thresholds(log)
    flagged = fraud.flag(log.where("not is_train"), p95, p99, score="return_amount")
    return flagged.select(
        "transaction_id",
        F.round(F.lit(p95), 6).alias("p95"),
        F.round(F.lit(p99), 6).alias("p99"),
        "flagged_p95",
        "flagged_p99",
        "severity",
    )


@query
def flag_quality(spark, d):
    log = split.train_monitor(stage(tpch.returns(spark, d), "returns"))
    flagged = fraud.flag(log.where("not is_train"), *_amount_thresholds(log), score="return_amount")
    return fraud.flag_quality(flagged, "flagged_p95").unionByName(fraud.flag_quality(flagged, "flagged_p99"))


def _baseline_result(spark, d):
    """The log scored against the training means: deterministic, so it has an SQL twin."""
    log = split.train_monitor(stage(tpch.returns(spark, d), "returns"))
    scored = fraud.mean_score(fraud.fit_scaler(log.where("is_train")), log)
    p95, p99 = fraud.thresholds(scored.where("is_train"))
    return {"scored": scored, "flagged": fraud.flag(scored.where("not is_train"), p95, p99), "p95": p95, "p99": p99}


def _baseline(spark, d):
    result = _baseline_result(spark, d)
    return result["flagged"], result["p95"], result["p99"]


@query
def baseline_summary(spark, d):
    """The summary of the return job, with the scores of the baseline."""
    quality = ("precision", "recall", "f1", "n_flagged", "n_actual")
    return pipelines.fraud_summary(_baseline_result(spark, d)).select(
        "n_train",
        "n_monitor",
        "threshold_p95",
        "threshold_p99",
        *[F.col(f"eval_{p}.{c}").alias(f"{c}_{p}") for p in ("p95", "p99") for c in quality],
    )


@query
def fraud_alerts(spark, d):
    return _rounded(fraud.alerts(_baseline(spark, d)[0]), ["score"], 6)


@query
def alert_feed(spark, d):
    flagged, _, _ = _baseline(spark, d)
    parts = [
        bi.alert_feed(flagged, s).select(F.lit(s).alias("severities"), "transaction_id", "store_id", "return_amount", "severity")
        for s in ("all", "high", "medium_high")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def fraud_kpis(spark, d):
    return bi.alert_kpis(_baseline(spark, d)[0])


@query
def risk_tiers(spark, d):
    flagged, p95, p99 = _baseline(spark, d)
    return _rounded(bi.risk_tiers(flagged, p95, p99), ["share_pct"], 6)


@query
def score_histogram(spark, d):
    flagged, p95, p99 = _baseline(spark, d)
    return _rounded(bi.score_histogram(flagged, p95, p99), ["bin_start"], 6)


@query
def pca_scores(spark, d):
    log = split.train_monitor(stage(tpch.returns(spark, d), "returns"))
    scaler = fraud.fit_scaler(log.where("is_train"))
    components = fraud.fit_pca(log.where("is_train"), scaler)
    scored = fraud.pca_score(components, scaler, log).select("transaction_id", "is_train", "score")
    return _rounded(scored, ["score"], 6)


@query
def autoencoder_scores(spark, d):
    result = pipelines.fraud_detection(tpch.returns(spark, d))
    return result["flagged"].select("transaction_id", "score", "flagged_p95", "flagged_p99", "severity")


@query
def fraud_summary(spark, d):
    return pipelines.fraud_summary(pipelines.fraud_detection(tpch.returns(spark, d))).select(
        "n_train", "n_monitor", "threshold_p95", "threshold_p99", "eval_p95.*"
    )


