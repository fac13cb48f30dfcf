import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    if not os.path.isdir(DATA):
        pytest.skip("test tables not present")
    return DATA


def make_days(spark, stores=2, days=60, seed=0):
    """A small processed-like panel of open days."""
    import datetime as dt

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(seed)
    start = dt.date(2020, 1, 1)
    rows = []
    for s in range(1, stores + 1):
        for i in range(days):
            promo = int(i % 3 == 0)
            rows.append(
                {
                    "store_id": s,
                    "date": start + dt.timedelta(days=i),
                    "sales": float(rng.integers(100, 900) + 200 * promo),
                    "customers": int(rng.integers(10, 99)),
                    "open_flag": 1,
                    "promo": promo,
                    "day_of_week": (start + dt.timedelta(days=i)).isoweekday(),
                    "state_holiday": "0",
                    "school_holiday": int(i % 7 == 0),
                    "store_type": "ab"[s % 2],
                    "assortment": "ac"[s % 2],
                    "competition_distance": 100.0 * s,
                    "competition_open_month": 3,
                    "competition_open_year": 2015,
                    "promo2": s % 2,
                    "promo2_since_week": 10,
                    "promo2_since_year": 2018,
                    "promo_interval": "Jan,Apr,Jul,Oct",
                    "is_zero_sales_anomaly": 0,
                }
            )
    return spark.createDataFrame(pd.DataFrame(rows))
