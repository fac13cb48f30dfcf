"""The jobs end to end: preparation, tests, segmentation, training, evaluation, fraud."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import cluster, evaluate, fraud, models, stats
from shelfcast.operators.clean import clean
from shelfcast.operators.features import (
    calendar_features,
    elapsed_features,
    history_features,
    segmented_history_features,
)
from shelfcast.operators.preprocess import feature_names, fit_numeric, prepare_features
from shelfcast.operators.profiles import store_profiles
from shelfcast.operators.split import holdout_split, temporal_folds, train_monitor
from shelfcast.schema import LAGS, OPTIONAL_SALES, SALES_SCHEMA, STORE_SCHEMA, VALIDATION_WEEKS, WINDOWS
from shelfcast.session import stage
from shelfcast.sources import registry, reports, tables


@dataclass
class PreparationConfig:
    lags: tuple[int, ...] = LAGS
    windows: tuple[int, ...] = WINDOWS
    validation_weeks: int = VALIDATION_WEEKS
    mapping: dict[str, str] = field(default_factory=tables.column_mapping)


def build_panel(days: DataFrame, config: PreparationConfig, segmented: bool = False) -> DataFrame:
    """Features of cleaned days.

    ``segmented`` is the caller's choice for sources in which one store may own a large part of the rows;
    both variants give the same rows.
    """
    with_dates = elapsed_features(calendar_features(days))
    history = segmented_history_features if segmented else history_features
    return history(with_dates, config.lags, config.windows)


def prepare_from_csv(spark: SparkSession, raw_dir: str, out_dir: str, config: PreparationConfig | None = None):
    """``train.csv`` and ``store.csv`` to the processed train and validation tables.

    Rows with values that do not parse go to ``rejected`` beside them, with counts by column.
    """
    config = config or PreparationConfig()
    for name in ("train.csv", "store.csv"):
        if not tables.exists(spark, f"{raw_dir}/{name}"):
            raise FileNotFoundError(f"{raw_dir}/{name}")
    sales = tables.read_sales(spark, f"{raw_dir}/train.csv", config.mapping)
    stores = tables.read_stores(spark, f"{raw_dir}/store.csv", config.mapping)
    raw = {
        "sales": (f"{raw_dir}/train.csv", SALES_SCHEMA, OPTIONAL_SALES),
        "stores": (f"{raw_dir}/store.csv", STORE_SCHEMA, ()),
    }
    parts = [
        tables.quarantined(tables.read_raw(spark, path), schema, config.mapping, optional).select(F.lit(name).alias("table"), "*")
        for name, (path, schema, optional) in raw.items()
    ]
    folder = f"{out_dir.rstrip('/')}/rejected"
    parts[0].unionByName(parts[1]).write.mode("overwrite").parquet(folder)
    counts = spark.read.parquet(folder).groupBy("table", "column", "reason").agg(F.count("*").alias("n"))
    reports.write_report(counts, f"{folder}_counts")
    return prepare(tables.with_stores(sales, stores), out_dir, config)


def prepare(panel: DataFrame, out_dir: str, config: PreparationConfig | None = None, segmented: bool = False):
    """Clean, engineer, split and write. Features are computed once: the staged table feeds both parts."""
    config = config or PreparationConfig()
    features = stage(build_panel(clean(panel), config, segmented), "panel")
    train, val = holdout_split(features, config.validation_weeks)
    reports.write_panel(train, val, out_dir)
    spark = panel.sparkSession
    return (
        spark.read.parquet(f"{out_dir.rstrip('/')}/train_processed.parquet"),
        spark.read.parquet(f"{out_dir.rstrip('/')}/val_processed.parquet"),
    )


def run_tests(train: DataFrame, out: str) -> DataFrame:
    report = stats.test_suite(train)
    reports.write_report(report, out)
    return report


def run_segmentation(
    train: DataFrame, out_dir: str, k: int | None = None, metric: str = "euclidean"
) -> tuple[DataFrame, dict]:
    """Segment the stores; CSV of assignments and JSON of the facts. ``metric``: of the silhouette."""
    profiles = stage(store_profiles(train), "profiles")
    segmented, facts = cluster.segment_stores(profiles, k=k, metric=metric)
    per_cluster = cluster.cluster_profile(segmented).orderBy("cluster").collect()  # k rows
    facts["cluster_sizes"] = {str(r["cluster"]): r["stores"] for r in per_cluster}
    facts["cluster_profile_means"] = {
        str(r["cluster"]): {c: r[c] for c in facts["feature_cols"]} for r in per_cluster
    }
    facts["segments"] = {str(r["cluster"]): r["segment"] for r in per_cluster}
    for name in ("inertias", "silhouette_scores"):
        facts[name] = {str(key): value for key, value in facts[name].items()}
    reports.write_csv(segmented, f"{out_dir}/store_clusters.csv")
    reports.write_facts(train.sparkSession, facts, f"{out_dir}/store_clusters.json")
    return segmented, facts


def sampled(panel: DataFrame, fraction: float) -> DataFrame:
    """About ``fraction`` of the rows, by a hash of store and date: the same rows on every cluster."""
    key = F.concat_ws("|", F.col("store_id").cast("string"), F.col("date").cast("string"))
    drawn = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return panel.where(drawn < int(fraction * (1 << 32)))


def train_models(
    train: DataFrame,
    models_dir: str,
    splits: int = 3,
    sample: float | None = None,
    exclude_anomalies: bool = True,
    settings: dict[str, dict] | None = None,
    run: str | None = None,
) -> dict:
    """Cross-validate and fit each model, save it with its manifest row.

    With a ``run`` name the metrics of finished folds are kept under ``models_dir``: the same call takes up
    there after it was ended.
    """
    spark = train.sparkSession
    rows = sampled(train, sample) if sample and 0 < sample < 1 else train
    prepared, numeric, categorical = prepare_features(rows, exclude_anomalies)
    folded = stage(temporal_folds(stage(prepared, "prepared"), splits), "training")
    n_train = folded.count()
    manifest = {
        "n_train_rows": n_train,
        "raw_numeric_features": numeric,
        "raw_categorical_features": categorical,
        "models": {},
    }
    statistics: dict = {}  # imputation and scaling per training part, shared by the models
    facts = {"rows": n_train, "numeric": numeric, "categorical": categorical, "splits": splits}
    ledger = models.FoldLedger(spark, f"{models_dir.rstrip('/')}/cv-{run}", facts) if run else None
    validated = models.validate_models(
        list(models.MODELS), folded, numeric, categorical, splits, statistics, settings, ledger
    )
    statistics["all"] = fit_numeric(folded, numeric)
    for name in models.MODELS:
        overrides = (settings or {}).get(name, {})
        folds = [row for row in validated if row["model_name"] == name]
        fitted, seconds = models.fit_pipeline(name, folded.drop("fold"), numeric, categorical, statistics["all"], **overrides)
        names = feature_names(PipelineModel(stages=fitted.stages[:-1]), numeric, categorical)
        facts = {
            "n_train_rows": n_train,
            "raw_numeric_features": numeric,
            "raw_categorical_features": categorical,
            "transformed_feature_names": names,
            "cv_splits": splits,
            "cv_rmspe_folds": [f["rmspe"] for f in folds],
            "cv_rmspe_mean": sum(f["rmspe"] for f in folds) / splits,
            "cv_mae_mean": sum(f["mae"] for f in folds) / splits,
            "train_time_sec": round(seconds, 2),
            "top_feature_importance": dict(models.importances(fitted, numeric, categorical)),
        }
        facts["artifact_path"] = registry.save_model(spark, models_dir, name, fitted, seconds, facts)
        manifest["models"][name] = facts
        manifest["transformed_feature_names"] = names
    return manifest


def score_holdout(val: DataFrame, fitted: dict[str, PipelineModel]) -> DataFrame:
    """Wide predictions: store, date, actual and one column per model; the models share one scan."""
    scored = val.withColumn("actual", F.col("sales"))
    for name, pipeline in fitted.items():
        scored = models.predict(pipeline, scored, f"predicted_{name}")
    return scored.select("store_id", "date", "actual", *[f"predicted_{n}" for n in fitted])


def run_evaluation(val: DataFrame, models_dir: str, out: str | None = None) -> DataFrame:
    """Metrics and rank of every saved model on the holdout, with its timings."""
    spark = val.sparkSession
    found = registry.find_models(spark, models_dir)
    if not found:
        raise FileNotFoundError(f"no trained model in {models_dir}")
    fitted = {name: PipelineModel.load(path) for name, (path, _) in found.items()}
    timings = spark.createDataFrame(
        [(n, float(found[n][1]), evaluate.timed(models.predict(p, val))) for n, p in fitted.items()],
        "model_name string, train_time_sec double, inference_time_sec double",
    )
    wide = score_holdout(val, fitted)
    metrics = evaluate.evaluate_models(wide, {n: f"predicted_{n}" for n in fitted})
    report = (
        evaluate.leaderboard_report(metrics)
        .join(timings, "model_name")
        .withColumn("validation_rows", F.lit(val.count()))
        .withColumn("generated_at", F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")))
        .orderBy("rank")
    )
    if out:
        reports.write_report(report, out)
    return report


def fraud_detection(returns: DataFrame, fraction: float = 0.7, seed: int = 42, **net) -> dict:
    """Fit on the earlier window, threshold on its scores, score the later window."""
    log = train_monitor(stage(returns, "returns"), fraction)
    train, monitor = log.where("is_train"), log.where("not is_train")
    scaler = fraud.fit_scaler(train)
    model = fraud.fit_autoencoder(train, scaler, seed, **net)
    scored = stage(fraud.autoencoder_score(model, scaler, log), "scores")
    p95, p99 = fraud.thresholds(scored.where("is_train"))
    flagged = fraud.flag(scored.where("not is_train"), p95, p99)
    return {"scaler": scaler, "model": model, "p95": p95, "p99": p99, "flagged": flagged, "scored": scored}


def fraud_summary(result: dict) -> DataFrame:
    """One row: window sizes, thresholds, quality of both flags."""
    scored, flagged = result["scored"], result["flagged"]
    sizes = scored.agg(
        F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_monitor")
    )
    out = sizes.select(
        "*",
        F.round(F.lit(result["p95"]), 5).alias("threshold_p95"),
        F.round(F.lit(result["p99"]), 5).alias("threshold_p99"),
    )
    for rule in ("p95", "p99"):
        quality = fraud.flag_quality(flagged, f"flagged_{rule}").drop("rule")
        out = out.withColumn(f"eval_{rule}", quality.select(F.struct(*quality.columns).alias("q")).scalar())
    return out


def run_fraud(returns: DataFrame, models_dir: str, reports_dir: str, **settings) -> DataFrame:
    result = fraud_detection(returns, **settings)
    spark = returns.sparkSession
    detector = PipelineModel(stages=[*result["scaler"].stages, result["model"]])
    registry.save_model(spark, models_dir, "fraud_autoencoder", detector, facts={"p95": result["p95"], "p99": result["p99"]})
    reports.write_alert_feed(fraud.alerts(result["flagged"]), f"{reports_dir}/fraud_alerts.json")
    summary = fraud_summary(result)
    reports.write_report(summary, f"{reports_dir}/fraud_detection_metrics.json")
    return summary
