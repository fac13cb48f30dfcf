"""Return-fraud scoring: features, reconstruction error, thresholds, alerts, quality."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.order_stats import exact_quantiles
from shelfcast.operators.cluster import scaling
from shelfcast.operators.neural import DenseNet, DenseNetModel
from shelfcast.schema import RETURN_FEATURES

# Detector settings.
HIDDEN = (16, 8, 16)
EPOCHS = 400
PATIENCE = 15
PERCENTILES = (0.95, 0.99)


def feature_expressions() -> dict[str, Column]:
    """The model inputs; the label is never one of them."""
    out = {"return_amount_log": F.log1p("return_amount")}
    out.update({c: F.col(c).cast("double") for c in RETURN_FEATURES[1:]})
    return out


def return_features(returns: DataFrame) -> DataFrame:
    keep = [c for c in ("transaction_id",) if c in returns.columns]
    return returns.select(*keep, *[e.alias(c) for c, e in feature_expressions().items()])


def complete(returns: DataFrame) -> DataFrame:
    """The rows whose features are all there. A model learns from these only; others get no score."""
    known = F.lit(True)
    for expression in feature_expressions().values():
        known = known & expression.isNotNull() & ~F.isnan(expression)
    return returns.where(F.coalesce(known, F.lit(False)))


def _known(score: Column) -> Column:
    """A score, or NULL where a missing feature left nothing to score."""
    return F.when(~F.isnan(score), score)


def fit_scaler(train: DataFrame) -> PipelineModel:
    """Standardised features as vector ``z``, fitted on the training window only; JVM stages."""
    fitted = scaling(complete(train).select(*[e.alias(c) for c, e in feature_expressions().items()]), RETURN_FEATURES)
    source = {c: (f"log1p(return_amount)" if c == "return_amount_log" else f"cast({c} as double)") for c in RETURN_FEATURES}
    parts = [
        f"({source[c]} - ({mean!r}D)) / {(spread or 1.0)!r}D as z_{i}" for i, (c, (mean, spread)) in enumerate(fitted.items())
    ]
    columns = [f"z_{i}" for i in range(len(RETURN_FEATURES))]
    return PipelineModel(
        stages=[
            SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"),
            VectorAssembler(inputCols=columns, outputCol="z", handleInvalid="keep"),
        ]
    )


def _without_helpers(df: DataFrame) -> DataFrame:
    return df.drop("z", *[f"z_{i}" for i in range(len(RETURN_FEATURES))])


def fit_autoencoder(train: DataFrame, scaler: PipelineModel, seed: int = 42, held_out: str | None = None, **overrides) -> DenseNetModel:
    """Net that reproduces its scaled input; early stopping on the latest tenth of the training window."""
    if held_out is None:
        at = complete(train).select(F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("at"))
        cut = exact_quantiles(at, {"at": [0.9]})["at"][0]
        held_out = f"cast(unix_micros(cast(ts as timestamp)) as double) > {cut!r}D"
    settings = {"hidden": HIDDEN, "epochs": EPOCHS, "batch": 200, "patience": PATIENCE, "rate": 1e-3, **overrides}
    net = DenseNet(
        target=None,
        keys=["transaction_id"],
        held_out=held_out,
        inputCol="z",
        seed=seed,
        **settings,
    )
    return net.fit(scaler.transform(complete(train)))


def _squared_error(original: Column, rebuilt: Column) -> Column:
    gaps = F.zip_with(original, rebuilt, lambda a, b: (a - b) * (a - b))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g) / F.size(original)


def autoencoder_score(model: DenseNetModel, scaler: PipelineModel, returns: DataFrame, column: str = "score") -> DataFrame:
    """Mean squared reconstruction error per row; NULL for a row with a missing feature."""
    rebuilt = model.output_array(scaler.transform(returns), "_rebuilt")
    scored = rebuilt.withColumn(column, _known(_squared_error(vector_to_array("z"), F.col("_rebuilt"))))
    return _without_helpers(scored.drop("_rebuilt"))


def fit_pca(train: DataFrame, scaler: PipelineModel, k: int = 3) -> np.ndarray:
    return PCA(k=k, inputCol="z", outputCol="components").fit(scaler.transform(complete(train))).pc.toArray()


def pca_score(components: np.ndarray, scaler: PipelineModel, returns: DataFrame, column: str = "score") -> DataFrame:
    """Error of the rank-k reconstruction ``z P P^T``: deterministic, and all JVM-side."""
    projector = components @ components.T
    z = vector_to_array("z")
    rebuilt = F.array(
        *[sum((z[j] * F.lit(float(projector[i, j])) for j in range(len(projector))), F.lit(0.0)) for i in range(len(projector))]
    )
    return _without_helpers(scaler.transform(returns).withColumn(column, _known(_squared_error(z, rebuilt))))


def mean_score(scaler: PipelineModel, returns: DataFrame, column: str = "score") -> DataFrame:
    """Error of reconstructing every feature by its training mean: the rank-0 baseline."""
    z = [F.col(f"z_{i}") for i in range(len(RETURN_FEATURES))]
    score = sum((v * v for v in z), F.lit(0.0)) / F.lit(float(len(z)))
    return _without_helpers(scaler.transform(returns).withColumn(column, score))


def thresholds(train_scored: DataFrame, percentiles: Sequence[float] = PERCENTILES, score: str = "score") -> list[float]:
    """Interpolated percentiles of the *training* scores."""
    return exact_quantiles(train_scored, {score: list(percentiles)})[score]


def flag(scored: DataFrame, p95: float, p99: float, score: str = "score") -> DataFrame:
    """Flags strictly above the thresholds, and the severity; a row without a score is not flagged but ``unscored``."""
    none = F.lit(False)
    above95, above99 = F.coalesce(F.col(score) > F.lit(p95), none), F.coalesce(F.col(score) > F.lit(p99), none)
    return scored.withColumns(
        {
            "flagged_p95": above95,
            "flagged_p99": above99,
            "severity": F.when(F.col(score).isNull(), "unscored").when(above99, "high").when(above95, "medium").otherwise("low"),
        }
    )


def flag_quality(flagged: DataFrame, flag_column: str, label: str = "label") -> DataFrame:
    """Precision, recall and F1 against the truth, 0 where undefined; one aggregate."""
    truth, hit = F.col(label) == 1, F.col(flag_column)
    counts = flagged.agg(
        F.count_if(truth & hit).alias("tp"),
        F.count_if(hit).alias("n_flagged"),
        F.count_if(truth).alias("n_actual"),
    )
    zero = F.lit(0.0)
    return counts.select(
        F.lit(flag_column).alias("rule"),
        F.round(F.coalesce(F.try_divide("tp", "n_flagged"), zero), 4).alias("precision"),
        F.round(F.coalesce(F.try_divide("tp", "n_actual"), zero), 4).alias("recall"),
        F.round(F.coalesce(F.try_divide(F.col("tp") * 2, F.col("n_flagged") + F.col("n_actual")), zero), 4).alias("f1"),
        "n_flagged",
        "n_actual",
    )


def alerts(flagged: DataFrame, score: str = "score") -> DataFrame:
    """The alert report: highest score first, without the ground truth."""
    return flagged.drop("label", "is_train").orderBy(F.desc(score), "transaction_id")
