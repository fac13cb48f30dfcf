"""SQL twins of the named queries, for a single-node engine on the same tables.

Only used for checking. The shared table expressions below restate FIXTURES.md independently of the
Spark code.
"""

from __future__ import annotations

from shelfcast.schema import LAGS, PROFILE_FEATURES, WINDOWS

_SALES = """
lines AS (
  SELECT l_suppkey AS store_id, CAST(l_shipdate AS DATE) AS date, l_orderkey,
         CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round((1 - l_discount) * 100) AS BIGINT) AS e4,
         CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END AS p
  FROM lineitem),
daily AS (
  SELECT store_id, date, CAST(sum(e4) AS BIGINT) AS day_e4, count(DISTINCT l_orderkey) AS customers,
         CAST(max(p) AS INTEGER) AS promo, CAST(isodow(date) AS INTEGER) AS day_of_week
  FROM lines GROUP BY store_id, date),
sales AS (
  SELECT store_id, date,
         CASE WHEN (store_id + date_diff('day', DATE '1995-01-01', date)) % 97 = 0 THEN 0 ELSE day_e4 END AS e4,
         CASE WHEN (store_id + date_diff('day', DATE '1995-01-01', date)) % 97 = 0 THEN 0.0::DOUBLE
              ELSE CAST(day_e4 AS DOUBLE) / 10000.0::DOUBLE END AS sales,
         customers,
         CAST(CASE WHEN day_of_week = 7 AND store_id % 5 = 0 THEN 0 ELSE 1 END AS INTEGER) AS open_flag,
         promo, day_of_week,
         CASE WHEN month(date) = 1 AND day(date) = 1 THEN 'a'
              WHEN month(date) = 12 AND day(date) IN (25, 26) THEN 'c'
              WHEN store_id % 7 = 0 THEN '0.0' ELSE '0' END AS state_holiday,
         CAST(CASE WHEN month(date) IN (7, 8) THEN 1 ELSE 0 END AS INTEGER) AS school_holiday
  FROM daily)"""

_STORES = """
stores AS (
  SELECT s_suppkey AS store_id,
         substr('abcd', CAST(s_suppkey % 4 + 1 AS BIGINT), 1) AS store_type,
         substr('abc', CAST(s_nationkey % 3 + 1 AS BIGINT), 1) AS assortment,
         CASE WHEN s_suppkey % 10 <> 0 THEN s_acctbal END AS competition_distance,
         CAST(CASE WHEN s_suppkey % 6 <> 0 THEN 1 + s_suppkey % 12 END AS INTEGER) AS competition_open_month,
         CAST(CASE WHEN s_suppkey % 6 <> 0 THEN 1990 + s_suppkey % 12 END AS INTEGER) AS competition_open_year,
         CAST(s_suppkey % 2 AS INTEGER) AS promo2,
         CAST(CASE WHEN s_suppkey % 2 = 1 THEN 1 + (7 * s_suppkey) % 53 END AS INTEGER) AS promo2_since_week,
         CAST(CASE WHEN s_suppkey % 2 = 1 THEN 1994 + s_suppkey % 6 END AS INTEGER) AS promo2_since_year,
         CASE WHEN s_suppkey % 2 = 1 THEN 'Jan,Apr,Jul,Oct' END AS promo_interval
  FROM supplier)"""

_OPEN = """
open_days AS (
  SELECT *, CAST(CASE WHEN sales = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_zero_sales_anomaly
  FROM sales WHERE open_flag = 1)"""

_JOINED = """
joined AS (SELECT o.*, s.* EXCLUDE (store_id) FROM open_days o LEFT JOIN stores s USING (store_id))"""

_CLEAN = """
cleaned AS (
  SELECT * REPLACE (
           coalesce(competition_distance, (SELECT median(competition_distance) FROM joined)) AS competition_distance,
           coalesce(competition_open_month, 0) AS competition_open_month,
           coalesce(competition_open_year, 0) AS competition_open_year,
           coalesce(promo2_since_week, 0) AS promo2_since_week,
           coalesce(promo2_since_year, 0) AS promo2_since_year,
           coalesce(promo_interval, '') AS promo_interval,
           CASE WHEN state_holiday = '0.0' THEN '0' ELSE state_holiday END AS state_holiday),
         CAST(CASE WHEN competition_open_month IS NOT NULL AND competition_open_year IS NOT NULL THEN 1 ELSE 0 END
              AS INTEGER) AS has_competition_open_date
  FROM joined)"""

_MONTHS = """CAST(CASE WHEN competition_open_month BETWEEN 1 AND 12 AND competition_open_year > 0
       THEN greatest((year(date) - competition_open_year) * 12 + month(date) - competition_open_month, 0)
       ELSE 0 END AS DOUBLE)"""

_WEEKS = """CASE WHEN promo2_since_week BETWEEN 1 AND 53 AND promo2_since_year > 0
       THEN greatest(date_diff('day',
              CAST(date_trunc('week', make_date(CAST(CASE WHEN promo2_since_year > 0 THEN promo2_since_year ELSE 2000 END
                   AS BIGINT), 1, 4)) AS DATE) + CAST((promo2_since_week - 1) * 7 AS INTEGER), date), 0) / 7.0::DOUBLE
       ELSE 0.0::DOUBLE END"""

_CALENDAR = """
CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
CAST(quarter(date) AS INTEGER) AS quarter, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
CAST(CASE WHEN day_of_week IN (6, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend, promo AS is_promo"""


def _rolling(n: int, digits: int | None = 3) -> str:
    frame = f"OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    std = f"stddev_samp(sales) {frame}"
    if digits is not None:
        std = f"round({std}, {digits})"
    return (
        f"CASE WHEN count(e4) {frame} > 0 THEN CAST(sum(e4) {frame} AS DOUBLE)"
        f" / CAST(10000 * count(e4) {frame} AS DOUBLE) END AS sales_rolling_mean_{n},"
        f" {std} AS sales_rolling_std_{n}"
    )


_LAG_COLUMNS = ", ".join(
    f"lag(sales, {n}) OVER (PARTITION BY store_id ORDER BY date) AS sales_lag_{n}" for n in LAGS
)
_ROLLING_COLUMNS = ", ".join(_rolling(n) for n in WINDOWS)
_RAW_ROLLING_COLUMNS = ", ".join(_rolling(n, None) for n in WINDOWS)

_HISTORY = f"""
history AS (SELECT *, {_LAG_COLUMNS}, {_ROLLING_COLUMNS} FROM open_days)"""

_HOLDOUT = """
holdout AS (
  SELECT store_id, date, e4, sales AS actual, sales_lag_7, sales_rolling_mean_7, sales_rolling_mean_30
  FROM history WHERE date > (SELECT max(date) - 42 FROM history))"""

_PANEL = f"""
features AS (
  SELECT *, {_CALENDAR}, {_MONTHS} AS months_since_competition, {_WEEKS} AS weeks_since_promo2,
         {_LAG_COLUMNS}, {_RAW_ROLLING_COLUMNS}
  FROM cleaned)"""

_PROFILES = """
raw_profiles AS (
  SELECT store_id,
         CAST(sum(e4) AS DOUBLE) / CAST(10000 * count(e4) AS DOUBLE) AS avg_daily_sales,
         CASE WHEN count(*) > 1 THEN stddev_samp(sales) ELSE 0.0 END AS spread,
         avg(customers) AS avg_daily_customers,
         CAST(sum(e4) FILTER (promo = 1) AS DOUBLE) / CAST(10000 * count(e4) FILTER (promo = 1) AS DOUBLE) AS on_mean,
         CAST(sum(e4) FILTER (promo = 0) AS DOUBLE) / CAST(10000 * count(e4) FILTER (promo = 0) AS DOUBLE) AS off_mean,
         avg(promo) AS promo_day_share,
         count(*) AS n_open_days
  FROM open_days GROUP BY store_id),
profiles AS (
  SELECT store_id, avg_daily_sales,
         CASE WHEN avg_daily_sales > 0 THEN spread / avg_daily_sales ELSE 0.0 END AS sales_cv,
         avg_daily_customers,
         CASE WHEN off_mean > 0 THEN (on_mean - off_mean) / off_mean * 100 ELSE 0.0 END AS promo_lift_pct,
         promo_day_share, n_open_days
  FROM raw_profiles
  WHERE avg_daily_sales IS NOT NULL AND (NOT avg_daily_sales > 0 OR spread IS NOT NULL)
    AND (off_mean IS NULL OR NOT off_mean > 0 OR on_mean IS NOT NULL))"""

_SCALED = (
    "\nscaled AS (SELECT store_id, "
    + ", ".join(
        f"CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () ELSE 0.0 END AS {c}"
        for c in PROFILE_FEATURES
    )
    + " FROM profiles)"
)

_RETURNS = """
log AS (
  SELECT event_id, user_id, ts, event_type, value, epoch_us(ts) AS us,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events),
derived AS (
  SELECT *,
    count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id ORDER BY us
      RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING) AS freq,
    max(us) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY us
      RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bought,
    min(us) OVER (PARTITION BY user_id) AS joined_at
  FROM log),
returns AS (
  SELECT event_id AS transaction_id, user_id % 50 AS store_id, user_id AS customer_id, ts, value AS return_amount,
         freq AS return_frequency_24h, (us - bought) // 86400000000 AS days_since_purchase,
         CAST(CASE WHEN k >= 6 THEN 1 ELSE 0 END AS INTEGER) AS receipt_verified,
         (us - joined_at) // 86400000000 AS customer_tenure_days,
         CAST(CASE WHEN freq >= 2 OR (k < 6 AND value >= 100) THEN 1 ELSE 0 END AS INTEGER) AS label, us
  FROM derived WHERE event_type = 'error' AND bought IS NOT NULL)"""

_SPLIT = """
windowed AS (
  SELECT *, row_number() OVER (ORDER BY us, transaction_id) <= floor(count(*) OVER () * 0.7::DOUBLE) AS is_train FROM returns)"""

_Z = {
    "return_amount_log": "ln(1 + return_amount)",
    "return_frequency_24h": "CAST(return_frequency_24h AS DOUBLE)",
    "days_since_purchase": "CAST(days_since_purchase AS DOUBLE)",
    "receipt_verified": "CAST(receipt_verified AS DOUBLE)",
    "customer_tenure_days": "CAST(customer_tenure_days AS DOUBLE)",
}
_SCORED = (
    "\nstats AS (SELECT "
    + ", ".join(f"avg({e}) AS m{i}, stddev_pop({e}) AS s{i}" for i, e in enumerate(_Z.values()))
    + " FROM windowed WHERE is_train),\nscored AS (SELECT w.*, ("
    + " + ".join(f"pow(({e} - m{i}) / s{i}, 2)" for i, e in enumerate(_Z.values()))
    + """) / 5.0 AS score FROM windowed w, stats),
limits AS (SELECT quantile_cont(score, 0.95) AS p95, quantile_cont(score, 0.99) AS p99 FROM scored WHERE is_train),
flagged AS (
  SELECT s.* EXCLUDE (us, is_train), score > p95 AS flagged_p95, score > p99 AS flagged_p99,
         CASE WHEN score > p99 THEN 'high' WHEN score > p95 THEN 'medium' ELSE 'low' END AS severity,
         CASE WHEN score < p95 THEN 'normal' WHEN score < p99 THEN 'elevated' ELSE 'critical' END AS tier
  FROM scored s, limits WHERE NOT is_train)"""
)
_BY_AMOUNT = """
limits AS (
  SELECT quantile_cont(return_amount, 0.95) AS p95, quantile_cont(return_amount, 0.99) AS p99
  FROM windowed WHERE is_train),
flagged AS (
  SELECT w.*, p95, p99, return_amount > p95 AS flagged_p95, return_amount > p99 AS flagged_p99
  FROM windowed w, limits WHERE NOT is_train)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_DAYS = (_SALES, _OPEN)
_FULL = (_SALES, _STORES, _OPEN, _JOINED)
_FEATURES = (*_FULL, _CLEAN, _PANEL)
_STORE_PROFILES = (*_DAYS, _PROFILES)
_VAL = (*_DAYS, _HISTORY, _HOLDOUT)
_FRAUD = (_RETURNS, _SPLIT, _SCORED)

NUMERIC = [
    "store_id", "promo", "day_of_week", "school_holiday", "competition_distance", "competition_open_month",
    "competition_open_year", "promo2", "promo2_since_week", "promo2_since_year", "has_competition_open_date",
    "year", "month", "day", "quarter", "week_of_year", "is_weekend", "is_promo", "months_since_competition",
    "weeks_since_promo2",
    *[f"sales_lag_{n}" for n in LAGS],
    *[f"sales_rolling_{kind}_{n}" for n in WINDOWS for kind in ("mean", "std")],
]


def _anova(group: str) -> str:
    return (
        _with(*_FULL, f"\ng AS (SELECT {group}, count(sales) AS n, avg(sales) AS m, var_samp(sales) AS v FROM joined"
              f" WHERE {group} IS NOT NULL GROUP BY {group})",
              "\nt AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * m) / sum(n) AS grand FROM g)")
        + "SELECT round((sum(g.n * pow(m - grand, 2)) / (k - 1)) / (sum(v * (g.n - 1)) / (t.n - k)), 6) AS statistic,"
        " k - 1 AS df1, t.n - k AS df2 FROM g, t GROUP BY k, t.n"
    )


def _resample(frequency: str) -> str:
    end = {
        "daily": "date",
        "weekly": "CAST(date_trunc('week', date) AS DATE) + 6",
        "monthly": "last_day(date)",
        "quarterly": "last_day(CAST(date_trunc('quarter', date) + INTERVAL 2 MONTH AS DATE))",
    }[frequency]
    # every calendar day between the first and the last one names its period
    return (
        _with(*_DAYS, "\ndays AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE)"
              " AS date FROM open_days)",
              f"\nspine AS (SELECT DISTINCT {end} AS period_end FROM days)",
              f"\nsums AS (SELECT {end} AS period_end, CAST(sum(e4) AS DOUBLE) / 10000.0::DOUBLE AS sales"
              " FROM open_days GROUP BY 1)")
        + "SELECT period_end, coalesce(sales, 0.0) AS sales FROM spine LEFT JOIN sums USING (period_end)"
    )


def _rollup() -> str:
    ends = {"weekly": "CAST(date_trunc('week', date) AS DATE) + 6", "monthly": "last_day(date)"}
    scopes = {"store": "store_id = 1", "cohort": "store_id IN (1, 2, 3, 4, 5)", "chain": "true"}
    parts = []
    for frequency, end in ends.items():
        for scope, condition in scopes.items():
            rows = f"(SELECT * FROM holdout WHERE {condition})"
            parts.append(
                f"SELECT '{frequency}' AS frequency, '{scope}' AS scope, period_end,"
                f" coalesce(actual, 0.0) AS actual, coalesce(predicted, 0.0) AS predicted"
                f" FROM (SELECT DISTINCT {end} AS period_end FROM (SELECT CAST(unnest(generate_series(min(date),"
                f" max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM {rows}))"
                f" LEFT JOIN (SELECT {end} AS period_end, CAST(sum(e4) AS DOUBLE) / 10000.0::DOUBLE AS actual,"
                f" CAST(sum(CAST(floor(sales_rolling_mean_7 * 10000 + 0.5) AS BIGINT)) AS DOUBLE) / 10000.0::DOUBLE"
                f" AS predicted FROM {rows} GROUP BY 1) USING (period_end)"
            )
    return _with(*_VAL) + "\nUNION ALL ".join(parts)


def _metrics(alias: str = "") -> str:
    return """coalesce(sqrt(avg(CASE WHEN actual > 0 THEN pow((actual - p) / actual, 2) END)), 0.0) AS rmspe,
  avg(abs(actual - p)) AS mae, sqrt(avg(pow(actual - p, 2))) AS rmse,
  1 - sum(pow(actual - p, 2)) / (var_pop(actual) * count(actual)) AS r2,
  count(*) FILTER (NOT actual > 0) AS rows_excluded_zero_sales"""


_LONG = "\nlong AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS model_name, actual, greatest({c}, 0.0) AS p FROM holdout WHERE {c} IS NOT NULL"
    for c in ("sales_lag_7", "sales_rolling_mean_7", "sales_rolling_mean_30")
) + ")"

# Labels of the drivers.
_DRIVER_LABELS = {
    "customers": "Store Footfall (Customers)",
    "promo": "Promotional Campaign Active",
    "school_holiday": "School Holiday Period",
    "is_weekend": "Weekend Trading",
    "competition_distance": "Competition Distance (m)",
}


def _leaderboard(direction: str) -> str:
    return (
        _with(*_STORE_PROFILES, _STORES)
        + "SELECT p.store_id, store_type, round(avg_daily_sales, 6) AS avg_daily_sales, round(sales_cv, 6) AS sales_cv,"
        " round(promo_lift_pct, 6) AS promo_lift_pct"
        f" FROM (SELECT * FROM profiles ORDER BY avg_daily_sales {direction}, store_id LIMIT 10) p"
        " LEFT JOIN stores USING (store_id)"
    )


# --- tests with their p-values ------------------------------------------------------------------------

#: Terms of the continued fraction; it has converged long before.
_TERMS = 1500

# Regularised incomplete beta function of each row of ``beta`` (test_name, x, a, b) by Lentz's method.
_P_VALUES = f"""
turned AS (
  SELECT test_name, x > (a + 1) / (a + b + 2) AS other,
         CASE WHEN x > (a + 1) / (a + b + 2) THEN 1 - x ELSE x END AS x,
         CASE WHEN x > (a + 1) / (a + b + 2) THEN b ELSE a END AS a,
         CASE WHEN x > (a + 1) / (a + b + 2) THEN a ELSE b END AS b
  FROM beta),
lentz AS (
  SELECT test_name, 0 AS step, x, a, b, 1.0::DOUBLE AS c, 0.0::DOUBLE AS d, 1.0::DOUBLE AS v FROM turned
  UNION ALL
  SELECT test_name, step + 1, x, a, b, 1 + term / c, 1 / (1 + term * d), v * (1 + term / c) / (1 + term * d)
  FROM (
    SELECT *, CASE WHEN step = 0 THEN 1.0::DOUBLE
                   WHEN step % 2 = 0 THEN (step // 2) * (b - step // 2) * x / ((a + step - 1) * (a + step))
                   ELSE -(a + step // 2) * (a + b + step // 2) * x / ((a + step - 1) * (a + step)) END AS term
    FROM lentz WHERE step < {_TERMS})),
tails AS (
  SELECT t.test_name, CASE WHEN other THEN 1 - i ELSE i END AS p
  FROM turned t JOIN (
    SELECT test_name,
           exp(a * ln(x) + b * ln(1 - x) + lgamma(a + b) - lgamma(a) - lgamma(b) - ln(a)) * (v - 1) AS i
    FROM lentz WHERE step = {_TERMS}) l USING (test_name))"""


def _report() -> str:
    """The test suite: statistics, p-values and texts."""
    welch = """
g AS (SELECT count(sales) FILTER (promo = 1) AS n1, count(sales) FILTER (promo = 0) AS n0,
       avg(sales) FILTER (promo = 1) AS m1, avg(sales) FILTER (promo = 0) AS m0,
       var_samp(sales) FILTER (promo = 1) AS v1, var_samp(sales) FILTER (promo = 0) AS v0 FROM open_days),
w AS (SELECT *, (m1 - m0) / sqrt(v1 / n1 + v0 / n0) AS t, (m1 - m0) / m0 * 100 AS lift,
       pow(v1 / n1 + v0 / n0, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v0 / n0, 2) / (n0 - 1)) AS df FROM g)"""
    parts, beta = [welch], ["SELECT 'welch' AS test_name, df / (df + t * t) AS x, df / 2 AS a, 0.5::DOUBLE AS b FROM w"]
    for group in ("store_type", "assortment"):
        parts.append(f"""
g_{group} AS (SELECT {group} AS k, count(sales) AS n, avg(sales) AS m, var_samp(sales) AS v,
       round(CAST(sum(e4) AS DOUBLE) / CAST(10000 * count(e4) AS DOUBLE), 0) AS shown
       FROM joined WHERE {group} IS NOT NULL GROUP BY {group}),
t_{group} AS (SELECT count(*) - 1 AS df1, CAST(sum(n) AS BIGINT) - count(*) AS df2, sum(n * m) / sum(n) AS grand,
       array_to_string(list_sort(list(printf('%s: %.0f', k, shown))), ', ') AS means FROM g_{group}),
a_{group} AS (SELECT df1, df2, any_value(means) AS means,
       (sum(n * pow(m - grand, 2)) / df1) / (sum(v * (n - 1)) / df2) AS f FROM g_{group}, t_{group} GROUP BY df1, df2)""")
        beta.append(
            f"SELECT '{group}', df2 / (df2 + df1 * f), CAST(df2 AS DOUBLE) / 2, CAST(df1 AS DOUBLE) / 2 FROM a_{group}"
        )
    parts += ["\nbeta AS (" + "\nUNION ALL ".join(beta) + ")", _P_VALUES]
    row = "SELECT 0.05::DOUBLE AS alpha, (SELECT count(*) FROM open_days) AS n_rows_tested"
    rows = [
        f"""{row}, 'welch_ttest_promo_vs_non_promo' AS test_name, round(t, 4) AS statistic, round(p, 6) AS p_value,
p < 0.05 AS significant, CASE WHEN p < 0.05 THEN printf('Promotion days sell %.1f%% differently (promo mean %.0f, other mean %.0f, p=%.2e): significant, H0 rejected.', lift, m1, m0, p)
ELSE printf('Promotion mean %.0f and other mean %.0f do not differ significantly (p=%.4f): H0 kept.', m1, m0, p) END AS interpretation
FROM w, tails WHERE test_name = 'welch'"""
    ]
    for group in ("store_type", "assortment"):
        rows.append(
            f"""{row}, 'anova_{group}', round(f, 4), round(p, 6), p < 0.05,
CASE WHEN p < 0.05 THEN printf('Sales differ between the {group} groups (F=%.4f, p=%.2e; means %s): significant, H0 rejected.', f, p, means)
ELSE printf('Sales do not differ significantly between the {group} groups (F=%.4f, p=%.4f; means %s): H0 kept.', f, p, means) END
FROM a_{group}, tails WHERE test_name = '{group}'"""
        )
    return _with(*_FULL, *parts).replace("WITH", "WITH RECURSIVE", 1) + "\nUNION ALL ".join(rows)


# --- principal components -------------------------------------------------------------------------------


def _eigen(matrix: str, size: int, wanted: int, steps: int = 3000) -> list[str]:
    """Tables e0, e1, ...: eigenvalue ``l`` and vector ``v0..`` of the symmetric matrix ``m{i}{j}`` in ``matrix``.

    Power iteration; each next one on the matrix without the components found.
    """
    span, parts = range(size), []
    for k in range(wanted):
        cells = {
            (i, j): f"m.m{min(i, j)}{max(i, j)}" + "".join(f" - e{q}.l * e{q}.v{i} * e{q}.v{j}" for q in range(k))
            for i in span
            for j in span
            if i <= j
        }
        from_ = ", ".join([f"{matrix} m", *[f"e{q}" for q in range(k)]])
        named = ", ".join(f"{x} AS c{i}{j}" for (i, j), x in cells.items())
        times = [" + ".join(f"c{min(i, j)}{max(i, j)} * v{j}" for j in span) for i in span]
        norm = "sqrt(" + " + ".join(f"u{i} * u{i}" for i in span) + ")"
        columns = ", ".join(f"c{i}{j}" for i, j in cells)
        parts += [
            f"\nd{k} AS (SELECT {named} FROM {from_})",
            f"\np{k} AS (SELECT 0 AS step, {', '.join(f'{1 + i * 0.37}::DOUBLE AS v{i}' for i in span)}, {columns} FROM d{k}"
            f"\nUNION ALL SELECT step + 1, {', '.join(f'u{i} / {norm}' for i in span)}, {columns}"
            f" FROM (SELECT *, {', '.join(f'{t} AS u{i}' for i, t in enumerate(times))} FROM p{k} WHERE step < {steps}))",
            f"\ne{k} AS (SELECT {', '.join(f'v{i}' for i in span)},"
            f" {' + '.join(f'v{i} * ({t})' for i, t in enumerate(times))} AS l FROM p{k} WHERE step = {steps})",
        ]
    return parts


def _covariance(table: str, columns: list[str], condition: str = "true") -> str:
    cells = [
        f"covar_samp({a}, {b}) AS m{i}{j}" for i, a in enumerate(columns) for j, b in enumerate(columns) if i <= j
    ]
    return f"\ncov AS (SELECT {', '.join(cells)} FROM {table} WHERE {condition})"


def _store_pca() -> str:
    columns = list(PROFILE_FEATURES)
    span = range(len(columns))
    # the largest loading of a component is positive
    sign = [
        f"CASE list_max([{', '.join(f'abs(e{k}.v{i})' for i in span)}]) "
        + " ".join(f"WHEN abs(e{k}.v{i}) THEN sign(e{k}.v{i})" for i in span)
        + " END"
        for k in range(2)
    ]
    score = [f"round(({' + '.join(f's.{c} * e{k}.v{i}' for i, c in enumerate(columns))}) * ({sign[k]}), 6)" for k in range(2)]
    total = " + ".join(f"cov.m{i}{i}" for i in span)
    return _with(*_STORE_PROFILES, _SCALED, _covariance("scaled", columns), *_eigen("cov", len(columns), 2)).replace(
        "WITH", "WITH RECURSIVE", 1
    ) + (
        f"SELECT store_id, {score[0]} AS pca_x, {score[1]} AS pca_y, round(e0.l / ({total}), 6) AS explained_1,"
        f" round(e1.l / ({total}), 6) AS explained_2 FROM scaled s, cov, e0, e1"
    )


def _pca_scores() -> str:
    size = len(_Z)
    z = (
        "\nstats AS (SELECT "
        + ", ".join(f"avg({e}) AS a{i}, stddev_pop({e}) AS s{i}" for i, e in enumerate(_Z.values()))
        + " FROM windowed WHERE is_train),\nz AS (SELECT transaction_id, is_train, "
        + ", ".join(f"({e} - a{i}) / s{i} AS z{i}" for i, e in enumerate(_Z.values()))
        + " FROM windowed, stats)"
    )
    parts = [_RETURNS, _SPLIT, z, _covariance("z", [f"z{i}" for i in range(size)], "is_train"), *_eigen("cov", size, 3)]
    shares = [" + ".join(f"z{i} * e{k}.v{i}" for i in range(size)) for k in range(3)]
    rest = [f"pow(z{i} - ({' + '.join(f'({shares[k]}) * e{k}.v{i}' for k in range(3))}), 2)" for i in range(size)]
    return _with(*parts).replace("WITH", "WITH RECURSIVE", 1) + (
        f"SELECT transaction_id, is_train, round(({' + '.join(rest)}) / {size}.0, 6) AS score FROM z, e0, e1, e2"
    )


# --- ridge ----------------------------------------------------------------------------------------------

_LABELS = {"state_holiday": "0abc", "store_type": "abcd", "assortment": "abc"}


def _ridge_parts(name: str, train: str, val: str, alpha: float = 100.0) -> list[str]:
    """Tables up to ``{name}_scored`` (store, day, actual, p): ridge fitted on ``train`` and applied to ``val``.

    Normal equations of the centred columns, solved by Gauss-Jordan elimination.
    """
    numeric = [f"(coalesce(CAST({c} AS DOUBLE), d{i}) - a{i}) / s{i}" for i, c in enumerate(NUMERIC)]
    hot = [f"CASE WHEN {c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for c, labels in _LABELS.items() for v in labels]
    size = len(numeric) + len(hot)
    span = range(size)
    filled = [f"coalesce(CAST({c} AS DOUBLE), d{i})" for i, c in enumerate(NUMERIC)]
    gram = [
        "["
        + ", ".join(
            f"covar_pop(x{min(i, j)}, x{max(i, j)}) * count(*)" + (f" + {alpha}" if i == j else "") for j in span
        )
        + f", covar_pop(x{i}, sales) * count(*)]"
        for i in span
    ]
    # one step clears one column: the pivot's row is scaled, and taken from all others
    cleared = (
        "list_transform(m, lambda r, i: CASE WHEN i = step + 1"
        " THEN list_transform(m[step + 1], lambda x: x / m[step + 1][step + 1])"
        " ELSE list_transform(r, lambda x, j: x - r[step + 1] * m[step + 1][j] / m[step + 1][step + 1]) END)"
    )
    medians = ", ".join(f"CAST(median({c}) AS DOUBLE) AS d{i}" for i, c in enumerate(NUMERIC))
    moments = ", ".join(
        f"any_value(d{i}) AS d{i}, avg({x}) AS a{i}, CASE WHEN stddev_pop({x}) > 0 THEN stddev_pop({x}) ELSE 1 END AS s{i}"
        for i, x in enumerate(filled)
    )
    columns = ", ".join(f"{x} AS x{i}" for i, x in enumerate([*numeric, *hot]))
    centre = " + ".join(f"any_value(w[{i + 1}]) * avg(x{i})" for i in span)
    value = " + ".join(f"w[{i + 1}] * x{i}" for i in span)
    return [
        f"\n{name}_train AS ({train})",
        f"\n{name}_val AS ({val})",
        f"\n{name}_mid AS (SELECT {medians} FROM {name}_train)",
        f"\n{name}_fit AS (SELECT {moments} FROM {name}_train, {name}_mid)",
        *[
            f"\n{name}_{part}_x AS MATERIALIZED (SELECT store_id AS store, date AS day, sales, {columns}"
            f" FROM {name}_{part}, {name}_fit)"
            for part in ("train", "val")
        ],
        f"\n{name}_system AS (SELECT [{', '.join(gram)}] AS m FROM {name}_train_x)",
        f"\n{name}_solved AS (SELECT 0 AS step, m FROM {name}_system"
        f" UNION ALL SELECT step + 1, {cleared} FROM {name}_solved WHERE step < {size})",
        f"\n{name}_weights AS (SELECT list_transform(m, lambda r: r[{size + 1}]) AS w FROM {name}_solved WHERE step = {size})",
        f"\n{name}_centre AS (SELECT avg(sales) - ({centre}) AS b FROM {name}_train_x, {name}_weights)",
        f"\n{name}_scored AS (SELECT store, day, sales AS actual, greatest(b + {value}, 0.0) AS p"
        f" FROM {name}_val_x, {name}_weights, {name}_centre)",
    ]


_LEARNED = "SELECT * FROM features WHERE is_zero_sales_anomaly = 0 AND date <= (SELECT max(date) - 42 FROM features)"
_HELD = "SELECT * FROM features WHERE date > (SELECT max(date) - 42 FROM features)"


def _recursive(*parts: str) -> str:
    return _with(*parts).replace("WITH", "WITH RECURSIVE", 1)


def _ridge() -> str:
    return _recursive(*_FEATURES, *_ridge_parts("r", _LEARNED, _HELD)) + (
        "SELECT store AS store_id, day AS date, actual, round(p, 1) AS predicted_ridge FROM r_scored"
    )


def _ridge_report() -> str:
    """Rank 1 of the ridge and the naive forecasts on the holdout, with the figures of all of them."""
    long = "\nlong AS (SELECT 'ridge' AS model_name, actual, p FROM r_scored UNION ALL " + " UNION ALL ".join(
        f"SELECT '{c}', sales, greatest({c}, 0.0) FROM features WHERE {c} IS NOT NULL"
        " AND date > (SELECT max(date) - 42 FROM features)"
        for c in ("sales_lag_7", "sales_rolling_mean_7", "sales_rolling_mean_30")
    ) + ")"
    metrics = f"\nm AS (SELECT model_name, {_metrics()} FROM long GROUP BY model_name)"
    return _recursive(*_FEATURES, *_ridge_parts("r", _LEARNED, _HELD), long, metrics) + (
        "SELECT CAST(row_number() OVER (ORDER BY rmspe, model_name) AS INTEGER) AS rank, model_name, round(rmspe, 4) AS rmspe,"
        " round(mae, 2) AS mae, round(rmse, 2) AS rmse, round(r2, 4) AS r2, rows_excluded_zero_sales,"
        " row_number() OVER (ORDER BY rmspe, model_name) = 1 AS is_best FROM m"
    )


def _cv_ridge() -> str:
    """Temporal cross-validation: folds by row number in (date, store), each fitted on all rows before it."""
    ranked = f"""
ranked AS MATERIALIZED (
  SELECT *, CASE WHEN i < n - 3 * (n // 4) THEN 0 WHEN i < n - 2 * (n // 4) THEN 1 WHEN i < n - (n // 4) THEN 2 ELSE 3 END AS fold
  FROM (SELECT *, row_number() OVER (ORDER BY date, store_id) - 1 AS i, count(*) OVER () AS n FROM ({_LEARNED})))"""
    parts, rows = [], []
    for k in (1, 2, 3):
        parts += _ridge_parts(f"f{k}", f"SELECT * FROM ranked WHERE fold < {k}", f"SELECT * FROM ranked WHERE fold = {k}")
        rows.append(
            f"SELECT 'ridge' AS model_name, CAST({k} AS INTEGER) AS fold, round(rmspe, 4) AS rmspe, round(mae, 2) AS mae,"
            f" round(rmse, 2) AS rmse, round(r2, 4) AS r2 FROM (SELECT {_metrics()} FROM f{k}_scored)"
        )
    return _recursive(*_FEATURES, ranked, *parts) + "\nUNION ALL ".join(rows)


def _ridge_importance() -> str:
    names = ", ".join(f"'{c}'" for c in [*NUMERIC, *[f"{c}_{v}" for c, labels in _LABELS.items() for v in labels]])
    return _recursive(*_FEATURES, *_ridge_parts("r", _LEARNED, _HELD)) + (
        f"SELECT feature, round(abs(v), 4) AS importance FROM (SELECT unnest([{names}]) AS feature, unnest(w) AS v FROM r_weights)"
        " ORDER BY abs(v) DESC, feature LIMIT 25"
    )


def _profile_by_label() -> str:
    means = ", ".join(f"round(avg({c}), 2) AS {c}" for c in PROFILE_FEATURES)
    # the names follow from the rounded means of a segment and the means of all stores
    return _with(
        *_STORE_PROFILES,
        f"\ns AS (SELECT CAST(store_id % 4 AS INTEGER) AS cluster, count(*) AS stores, {means} FROM profiles GROUP BY 1)",
        "\no AS (SELECT avg(avg_daily_sales) AS sales, avg(sales_cv) AS cv, avg(promo_lift_pct) AS lift FROM profiles)",
    ) + (
        "SELECT s.*, CASE WHEN avg_daily_sales >= sales * 1.25 THEN 'High-volume leaders'"
        " WHEN promo_lift_pct >= lift * 1.25 THEN 'Promotion-driven stores' WHEN sales_cv >= cv * 1.1 THEN 'Volatile stores'"
        " ELSE 'Steady core stores' END AS segment FROM s, o"
    )


def _baseline_summary() -> str:
    cells = []
    for p in ("p95", "p99"):
        flag, counts = f"flagged_{p}", {"tp": f"count(*) FILTER (label = 1 AND flagged_{p})"}
        counts |= {"flagged": f"count(*) FILTER ({flag})", "actual": "count(*) FILTER (label = 1)"}
        cells += [
            f"round(coalesce({counts['tp']} / nullif({counts['flagged']}, 0), 0.0::DOUBLE), 4) AS precision_{p}",
            f"round(coalesce({counts['tp']} / nullif({counts['actual']}, 0), 0.0::DOUBLE), 4) AS recall_{p}",
            f"round(coalesce(2 * {counts['tp']} / nullif({counts['flagged']} + {counts['actual']}, 0), 0.0::DOUBLE), 4) AS f1_{p}",
            f"{counts['flagged']} AS n_flagged_{p}",
            f"{counts['actual']} AS n_actual_{p}",
        ]
    return _with(*_FRAUD) + (
        "SELECT (SELECT count(*) FROM scored WHERE is_train) AS n_train, count(*) AS n_monitor,"
        " (SELECT round(p95, 5) FROM limits) AS threshold_p95, (SELECT round(p99, 5) FROM limits) AS threshold_p99, "
        + ", ".join(cells)
        + " FROM flagged"
    )


# Rows with values that cannot be read, by the rule of the query.
_BROKEN = """
marked AS (SELECT *, (date_diff('day', DATE '1992-01-01', date) * 7 + store_id) % 211 AS broken FROM sales)"""

ORACLES: dict[str, str] = {
    "ingest_sales": _with(_SALES, _BROKEN)
    + """SELECT store_id, date, CASE WHEN broken <> 7 THEN sales END AS sales, CASE WHEN broken <> 5 THEN customers END AS customers,
open_flag, promo, day_of_week, state_holiday, school_holiday FROM marked WHERE broken NOT IN (3, 4, 6)""",
    "ingest_rejects": _with(_SALES, _BROKEN)
    + """SELECT 'customers' AS "column", 'not a bigint' AS reason, count(*) AS n FROM marked WHERE broken IN (3, 4)
UNION ALL SELECT 'promo', 'not a int', count(*) FROM marked WHERE broken = 3
UNION ALL SELECT 'sales', 'not a double', count(*) FROM marked WHERE broken = 6""",
    "panel_base": _with(_SALES, _STORES)
    + "SELECT sales.* EXCLUDE (e4), stores.* EXCLUDE (store_id) FROM sales LEFT JOIN stores USING (store_id)",
    "clean_open": _with(*_DAYS) + "SELECT store_id, date, sales, is_zero_sales_anomaly FROM open_days",
    "impute_median": _with(*_FULL, _CLEAN) + "SELECT store_id, date, competition_distance FROM cleaned",
    "impute_flags": _with(*_FULL, _CLEAN)
    + """SELECT store_id, date, has_competition_open_date, competition_open_month, competition_open_year,
promo2_since_week, promo2_since_year, promo_interval, state_holiday FROM cleaned""",
    "calendar_features": _with(*_DAYS) + f"SELECT store_id, date, {_CALENDAR} FROM open_days",
    "competition_months": _with(*_FULL) + f"SELECT store_id, date, {_MONTHS} AS months_since_competition FROM joined",
    "promo2_weeks": _with(*_FULL) + f"SELECT store_id, date, {_WEEKS} AS weeks_since_promo2 FROM joined",
    "sales_lags": _with(*_DAYS) + f"SELECT store_id, date, {_LAG_COLUMNS} FROM open_days",
    "sales_rolling": _with(*_DAYS) + f"SELECT store_id, date, {_ROLLING_COLUMNS} FROM open_days",
    "sales_history_segmented": _with(*_DAYS)
    + f"SELECT store_id, date, {_LAG_COLUMNS}, {_ROLLING_COLUMNS} FROM open_days",
    "chrono_split": _with(*_DAYS)
    + """SELECT store_id, date, CASE WHEN date <= (SELECT max(date) - 42 FROM open_days) THEN 'train' ELSE 'val' END AS part
FROM open_days""",
    "sample_frac": _with(*_DAYS)
    + """SELECT store_id, date, sales FROM open_days
WHERE CAST('0x' || substr(md5(store_id || '|' || date), 1, 8) AS BIGINT) < 429496729""",
    "prepare_features": _with(*_FEATURES)
    + "SELECT date, "
    + ", ".join(f"round({c}, 3) AS {c}" if "_std_" in c else c for c in NUMERIC)
    + ", state_holiday, store_type, assortment, sales FROM features WHERE is_zero_sales_anomaly = 0",
    "welch_ttest": _with(
        *_DAYS,
        """
g AS (SELECT count(sales) FILTER (promo = 1) AS n1, count(sales) FILTER (promo = 0) AS n0,
       avg(sales) FILTER (promo = 1) AS m1, avg(sales) FILTER (promo = 0) AS m0,
       var_samp(sales) FILTER (promo = 1) AS v1, var_samp(sales) FILTER (promo = 0) AS v0 FROM open_days)""",
    )
    + """SELECT n1, n0, round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 6) AS statistic,
round(pow(v1 / n1 + v0 / n0, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v0 / n0, 2) / (n0 - 1)), 3) AS df,
round((m1 - m0) / m0 * 100, 6) AS lift_pct FROM g""",
    "anova_storetype": _anova("store_type"),
    "anova_assortment": _anova("assortment"),
    "test_report": _report(),
    "store_pca": _store_pca(),
    "pca_scores": _pca_scores(),
    "ridge_forecast": _ridge(),
    "ridge_ranking": _ridge_report(),
    "ridge_importance": _ridge_importance(),
    "profile_by_label": _profile_by_label(),
    "baseline_summary": _baseline_summary(),
    "cv_ridge": _cv_ridge(),
    "group_means": _with(*_FULL)
    + """SELECT store_type, round(CAST(sum(e4) AS DOUBLE) / CAST(10000 * count(e4) AS DOUBLE), 0) AS mean_sales
FROM joined GROUP BY store_type""",
    "store_profiles": _with(*_STORE_PROFILES)
    + "SELECT store_id, n_open_days, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in PROFILE_FEATURES)
    + " FROM profiles",
    "low_data_stores": _with(*_DAYS, "\nc AS (SELECT store_id, count(*) AS n FROM open_days GROUP BY store_id)",
                             "\nt AS (SELECT quantile_cont(n, 0.01) AS limit_days FROM c)")
    + "SELECT round(max(limit_days), 6) AS threshold_days, count(*) FILTER (n < limit_days) AS n_flagged FROM c, t",
    "profile_scaled": _with(*_STORE_PROFILES, _SCALED)
    + "SELECT store_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in PROFILE_FEATURES) + " FROM scaled",
    "silhouette": _with(
        *_STORE_PROFILES,
        _SCALED,
        "\npairs AS (SELECT a.store_id AS i, a.store_id % 4 AS own, b.store_id % 4 AS other, avg(sqrt("
        + " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in PROFILE_FEATURES)
        + ")) AS d FROM scaled a JOIN scaled b ON a.store_id <> b.store_id GROUP BY 1, 2, 3)",
        "\ns AS (SELECT i, max(d) FILTER (own = other) AS a, min(d) FILTER (own <> other) AS b FROM pairs GROUP BY i)",
    )
    + """SELECT (SELECT count(*) FROM scaled) AS stores,
round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""",
    "kpi_overview": _with(*_DAYS)
    + """SELECT CAST(sum(e4) AS DOUBLE) / 10000.0::DOUBLE AS total_revenue, avg(customers) AS avg_customers,
min(date) AS min_date, max(date) AS max_date FROM open_days""",
    "kpi_growth": _with(
        *_DAYS,
        """
m AS (SELECT min(date) AS lo, max(date) AS hi FROM open_days),
h AS (SELECT 2 * date_diff('day', lo, date) < date_diff('day', lo, hi) AS early, e4 FROM open_days, m),
a AS (SELECT coalesce(CAST(sum(e4) FILTER (early) AS DOUBLE) / 10000.0::DOUBLE / count(e4) FILTER (early), 1.0) AS mean_early,
       coalesce(CAST(sum(e4) FILTER (NOT early) AS DOUBLE) / 10000.0::DOUBLE / count(e4) FILTER (NOT early), 1.0) AS mean_late
      FROM h)""",
    )
    + """SELECT mean_early, mean_late,
CASE WHEN mean_early <> 0 THEN (mean_late - mean_early) * 100 / mean_early ELSE 0.0 END AS growth_pct FROM a""",
    **{f"resample_{f}": _resample(f) for f in ("daily", "weekly", "monthly", "quarterly")},
    "driver_correlation": _with(*_FULL, _CLEAN, f"\nx AS (SELECT *, {_CALENDAR} FROM cleaned)",
                                "\nr AS (" + " UNION ALL ".join(
                                    f"SELECT '{label}' AS feature, corr({c}, sales) AS r FROM x"
                                    for c, label in _DRIVER_LABELS.items()) + ")")
    + """SELECT feature, round(r, 6) AS correlation, CASE WHEN r >= 0 THEN 'positive' ELSE 'negative' END AS direction,
printf('%+.3f', r) AS formatted FROM r""",
    "store_leaderboard_top": _leaderboard("DESC"),
    "store_leaderboard_bottom": _leaderboard("ASC"),
    "risk_quadrant": _with(*_STORE_PROFILES,
                           "\nm AS (SELECT median(avg_daily_sales) AS ms, median(sales_cv) AS mc FROM profiles)")
    + """SELECT store_id, round(avg_daily_sales, 6) AS avg_daily_sales, round(sales_cv, 6) AS sales_cv,
round(ms, 6) AS median_sales, round(mc, 6) AS median_cv,
CASE WHEN avg_daily_sales >= ms AND sales_cv >= mc THEN 'high inventory risk' WHEN avg_daily_sales >= ms THEN 'core revenue'
     WHEN sales_cv >= mc THEN 'low volume, volatile' ELSE 'low volume, stable' END AS quadrant FROM profiles, m""",
    "store_list": _with(*_VAL) + "SELECT DISTINCT store_id FROM holdout",
    "forecast_series": _with(*_VAL)
    + "SELECT store_id, date, actual, sales_rolling_mean_7 AS predicted FROM holdout WHERE store_id = 1",
    "forecast_rollup": _rollup(),
    "forecast_variance": _with(
        *_VAL,
        """
t AS (SELECT CAST(sum(e4) AS DOUBLE) / 10000.0::DOUBLE AS a,
       CAST(sum(CAST(floor(sales_rolling_mean_7 * 10000 + 0.5) AS BIGINT)) AS DOUBLE) / 10000.0::DOUBLE AS p FROM holdout)""",
    )
    + """SELECT a AS total_actual, p AS total_predicted,
round(CASE WHEN a <> 0 THEN (p - a) * 100 / a ELSE 0.0 END, 6) AS variance_pct FROM t""",
    "temporal_folds": _with(
        *_DAYS,
        """
r AS (SELECT store_id, date, row_number() OVER (ORDER BY date, store_id) - 1 AS i, count(*) OVER () AS n
      FROM open_days WHERE is_zero_sales_anomaly = 0)""",
    )
    + """SELECT store_id, date, CAST(CASE WHEN i < n - 3 * (n // 4) THEN 0 WHEN i < n - 2 * (n // 4) THEN 1
WHEN i < n - (n // 4) THEN 2 ELSE 3 END AS INTEGER) AS fold FROM r""",
    "eval_metrics": _with(*_VAL, _LONG, f"\nm AS (SELECT model_name, {_metrics()} FROM long GROUP BY model_name)")
    + """SELECT model_name, round(rmspe, 6) AS rmspe, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2,
rows_excluded_zero_sales FROM m""",
    "model_ranking": _with(*_VAL, _LONG, f"\nm AS (SELECT model_name, {_metrics()} FROM long GROUP BY model_name)")
    + """SELECT CAST(row_number() OVER (ORDER BY rmspe, model_name) AS INTEGER) AS rank, model_name,
round(rmspe, 4) AS rmspe, round(mae, 2) AS mae, round(rmse, 2) AS rmse, round(r2, 4) AS r2, rows_excluded_zero_sales,
row_number() OVER (ORDER BY rmspe, model_name) = 1 AS is_best FROM m""",
    "model_latest": _with(
        *_DAYS,
        _HISTORY,
        "\nlong AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS model_name, CAST(year(date) AS VARCHAR) AS stamp, sales AS actual, greatest({c}, 0.0) AS p"
            f" FROM history WHERE {c} IS NOT NULL"
            for c in ("sales_lag_7", "sales_rolling_mean_7", "sales_rolling_mean_30")) + ")",
        f"\nm AS (SELECT model_name, stamp, {_metrics()} FROM long GROUP BY model_name, stamp)",
    )
    + """SELECT model_name, stamp, round(rmspe, 6) AS rmspe, round(mae, 6) AS mae FROM m
QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY stamp DESC) = 1""",
    "numeric_preproc": _with(*_FEATURES, "\nx AS (SELECT * FROM features WHERE is_zero_sales_anomaly = 0)",
                             "\nf AS (" + " UNION ALL ".join(
                                 f"SELECT '{c}' AS feature, (SELECT median({c}) FROM x) AS med, avg(v) AS m, stddev_pop(v) AS s FROM"
                                 f" (SELECT CAST(coalesce({c}, (SELECT median({c}) FROM x)) AS DOUBLE) AS v FROM x)"
                                 for c in NUMERIC) + ")")
    + """SELECT feature, round(CAST(med AS DOUBLE), 4) AS median, round(m, 4) AS mean,
round(CASE WHEN s = 0 THEN 1 ELSE s END, 4) AS spread FROM f""",
    "categorical_preproc": _with(*_FULL, _CLEAN)
    + "SELECT store_id, date, "
    + ", ".join(
        f"CAST(CASE WHEN {c} = '{label}' THEN 1 ELSE 0 END AS INTEGER) AS {c}_{label}"
        for c, labels in (("state_holiday", "0ac"), ("store_type", "abcd"), ("assortment", "abc"))
        for label in labels
    )
    + " FROM cleaned WHERE is_zero_sales_anomaly = 0",
    "derive_returns": _with(_RETURNS) + "SELECT * EXCLUDE (us) FROM returns",
    "union_returns": """SELECT event_id AS transaction_id, user_id AS customer_id, ts,
CASE WHEN event_type = 'purchase' THEN 'purchase' ELSE 'return' END AS kind, value AS amount,
printf('TXN-%07d', event_id) AS transaction_key FROM events WHERE event_type IN ('purchase', 'error')""",
    "return_features": _with(_RETURNS)
    + "SELECT transaction_id, "
    + ", ".join(f"round({e}, 6) AS {c}" if c == "return_amount_log" else f"{e} AS {c}" for c, e in _Z.items())
    + " FROM returns",
    "train_monitor_split": _with(_RETURNS, _SPLIT) + "SELECT transaction_id, is_train FROM windowed",
    "flag_thresholds": _with(_RETURNS, _SPLIT, _BY_AMOUNT)
    + """SELECT transaction_id, round(p95, 6) AS p95, round(p99, 6) AS p99, flagged_p95, flagged_p99,
CASE WHEN flagged_p99 THEN 'high' WHEN flagged_p95 THEN 'medium' ELSE 'low' END AS severity FROM flagged""",
    "flag_quality": _with(_RETURNS, _SPLIT, _BY_AMOUNT,
                          "\nc AS (" + " UNION ALL ".join(
                              f"SELECT '{f}' AS rule, count(*) FILTER (label = 1 AND {f}) AS tp,"
                              f" count(*) FILTER ({f}) AS n_flagged, count(*) FILTER (label = 1) AS n_actual FROM flagged"
                              for f in ("flagged_p95", "flagged_p99")) + ")")
    + """SELECT rule, round(coalesce(tp / nullif(n_flagged, 0), 0), 4) AS precision,
round(coalesce(tp / nullif(n_actual, 0), 0), 4) AS recall,
round(coalesce(2 * tp / nullif(n_flagged + n_actual, 0), 0), 4) AS f1, n_flagged, n_actual FROM c""",
    "fraud_alerts": _with(*_FRAUD) + "SELECT * EXCLUDE (label, tier) REPLACE (round(score, 6) AS score) FROM flagged",
    "alert_feed": _with(*_FRAUD)
    + "\nUNION ALL ".join(
        f"(SELECT '{name}' AS severities, transaction_id, store_id, return_amount, severity FROM flagged"
        f" WHERE severity IN ({kept}) ORDER BY score DESC, transaction_id LIMIT 250)"
        for name, kept in (("all", "'low', 'medium', 'high'"), ("high", "'high'"), ("medium_high", "'medium', 'high'"))
    ),
    "fraud_kpis": _with(*_FRAUD)
    + """SELECT count(*) AS reviewed, count(*) FILTER (flagged_p95) AS flagged_p95,
coalesce(CAST(sum(CAST(round(return_amount * 10000) AS BIGINT)) FILTER (severity = 'high') AS DOUBLE) / 10000.0::DOUBLE, 0.0)
AS high_exposure FROM flagged""",
    "risk_tiers": _with(*_FRAUD)
    + """SELECT t.tier, count(f.tier) AS n, round(count(f.tier) * 100.0::DOUBLE / (SELECT count(*) FROM flagged), 6) AS share_pct
FROM (VALUES ('normal'), ('elevated'), ('critical')) t(tier) LEFT JOIN flagged f USING (tier) GROUP BY t.tier""",
    "score_histogram": _with(
        *_FRAUD,
        """
b AS (SELECT tier, min(score) AS lo, max(score) AS hi,
       CASE tier WHEN 'normal' THEN 45 WHEN 'elevated' THEN 15 ELSE 10 END AS bins FROM flagged GROUP BY tier),
x AS (SELECT tier, lo, (hi - lo) / bins AS w,
       CAST(CASE WHEN hi > lo THEN least(floor((score - lo) / ((hi - lo) / bins)) + 1, bins) ELSE 1 END AS INTEGER) AS bin
      FROM flagged JOIN b USING (tier))""",
    )
    + "SELECT tier, bin, round(max(lo + (bin - 1) * w), 6) AS bin_start, count(*) AS n FROM x GROUP BY tier, bin",
}
