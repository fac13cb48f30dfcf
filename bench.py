"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Relational queries are timed to a full result (noop sink, all columns). Model entries are the seconds
of preprocessing plus fit on the staged training panel, and of scoring the holdout. One untimed query
and one untimed fit on the small holdout come first, so that class loading and compilation of a fresh
JVM are not counted; each timed entry itself runs once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from shelfcast.operators import evaluate, models, preprocess
from shelfcast.plans import catalog
from shelfcast.session import build_session

RELATIONAL = (
    "panel_base",
    "prepare_features",
    "sales_rolling",
    "chrono_split",
    "store_profiles",
    "welch_ttest",
    "anova_storetype",
    "anova_assortment",
    "kpi_growth",
    "resample_weekly",
    "driver_correlation",
    "risk_quadrant",
    "forecast_rollup",
    "eval_metrics",
    "temporal_folds",
    "derive_returns",
    "train_monitor_split",
    "fraud_alerts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = set(sys.argv[1:])
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's compilers and the file caches before the clock runs
    evaluate.timed(catalog.QUERIES["sales_rolling"](spark, sf_dir))

    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in RELATIONAL:
        if wanted and name not in wanted:
            continue
        started = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)

    if not wanted or wanted & {"models"}:
        train, val, numeric, categorical = catalog._training(spark, sf_dir)
        rows["train"], rows["holdout"] = train.count(), val.count()
        models.fit_pipeline("ridge", val, numeric, categorical)
        # imputation and scaling are fitted once and shared by the models, as in the training job
        started = time.time()
        statistics = preprocess.fit_numeric(train, numeric)
        seconds["numeric_statistics_fit"] = round(time.time() - started, 3)
        for name, label, settings in (
            ("ridge", "ridge", {}),
            ("mlp", "mlp", {}),
            ("gbt", "gbt", {}),
        ):
            fitted, took = models.fit_pipeline(name, train, numeric, categorical, statistics, **settings)
            seconds[f"{label}_fit"] = round(took, 3)
            seconds[f"{label}_score"] = round(evaluate.timed(models.predict(fitted, val)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
