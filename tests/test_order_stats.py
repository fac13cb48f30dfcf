import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from shelfcast.functions import order_stats as o


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    n = 5000
    cols = {
        "normal": rng.normal(size=n),
        "skewed": np.exp(rng.normal(size=n) * 5),
        "ties": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 20, n).astype(float)),
        "constant": np.full(n, 3.0),
    }
    rows = [tuple(float(cols[c][i]) for c in cols) + (int(rng.integers(-50, 50)),) for i in range(n)]
    ints = np.array([r[-1] for r in rows])
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", whole bigint")
    ps = [0.0, 0.01, 0.5, 0.95, 0.99, 1.0]
    got = o.exact_quantiles(df, {c: ps for c in [*cols, "whole"]})
    for c in cols:
        assert np.allclose(got[c], np.percentile(cols[c], np.array(ps) * 100), rtol=1e-12, atol=0)
    assert np.allclose(got["whole"], np.percentile(ints, np.array(ps) * 100))


def test_nulls_are_left_out_and_empty_columns_give_none(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    assert o.exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [2.0], "b": [None]}


def test_ranks_beyond_the_values_are_an_error(spark):
    df = spark.createDataFrame([(i if i < 10 else None,) for i in range(20)], "a bigint")
    assert o.rows_at_ranks(df, ["a"], [5]) == [(5,)]
    with pytest.raises(ValueError):
        o.rows_at_ranks(df, ["a"], [14])


def test_rows_at_ranks_cut_inside_ties(spark):
    rng = np.random.default_rng(2)
    # one value of the leading key owns a third of the rows
    keys = [(5 if rng.random() < 0.33 else int(rng.integers(0, 10**12)), i) for i in range(3000)]
    rng.shuffle(keys)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in keys], "a bigint, b bigint")
    ordered = sorted((int(a), int(b)) for a, b in keys)
    ranks = [0, 10, 500, 1500, 2999]
    found = o.rows_at_ranks(df, ["a", "b"], ranks)
    assert found == [ordered[r] for r in ranks]
    for rank, cut in zip(ranks, found):
        assert df.where(o.precedes(["a", "b"], cut)).count() == rank


def test_spreads_have_moments_and_need_two_scans(spark, tmp_path):
    rng = np.random.default_rng(5)
    n = 30_000
    rows = {"a": rng.normal(size=n) * 1e6, "b": np.where(rng.random(n) < 0.6, 0.0, rng.random(n)), "c": rng.integers(0, 3, n) * 1.0}
    path = str(tmp_path / "t")
    spark.createDataFrame([tuple(float(rows[c][i]) for c in rows) for i in range(n)], "a double, b double, c double").write.parquet(path)
    df = spark.read.parquet(path)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    got = o.spreads(df.mapInArrow(counted, df.schema), {c: [0.25, 0.5, 0.9] for c in rows})
    assert read.value == 2 * n
    for c, x in rows.items():
        assert got[c].n == n
        np.testing.assert_allclose(got[c].quantiles, np.percentile(x, [25, 50, 90]), rtol=1e-12)
        np.testing.assert_allclose([got[c].mean, got[c].variance], [x.mean(), x.var()], rtol=1e-9)


def test_cells_are_summed_in_the_task(spark, monkeypatch):
    rng = np.random.default_rng(11)
    values = [np.exp(rng.normal(size=500)), np.append(-rng.random(499), np.nan), np.full(500, 7.0)]
    monkeypatch.setattr(o, "_SORTED", 120)  # many buffers
    monkeypatch.setattr(o, "_BUFFERS", 3)
    batches = [pa.record_batch([pa.array(v[at : at + 20]) for v in values], names=list("abc")) for at in range(0, 500, 20)]
    got = pa.Table.from_batches(o._count_cells(iter(batches))).to_pandas()
    # a task returns a cell once, whatever the number of its rows
    assert not got.duplicated(["place", "cell"]).any() and len(got[got["place"] == 2]) == 1
    for i, x in enumerate(values):
        own, known = got[got["place"] == i].sort_values("cell"), np.sort(x[~np.isnan(x)])
        assert own["n"].sum() == len(known) and (own["high"].to_numpy()[:-1] < own["low"].to_numpy()[1:]).all()
        mean = (own["n"] * own["mean"]).sum() / len(known)
        squares = (own["squares"] + own["n"] * (own["mean"] - mean) ** 2).sum()
        np.testing.assert_allclose([mean, squares], [known.mean(), ((known - known.mean()) ** 2).sum()], rtol=1e-9, atol=1e-20)


def test_a_missed_bracket_is_searched_in_full(spark, monkeypatch):
    monkeypatch.setattr(o, "ACCURACY", 4)  # brackets that mean little
    x = np.random.default_rng(3).normal(size=4000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    ps = [0.0, 0.2, 0.5, 0.77, 1.0]
    assert np.allclose(o.exact_quantiles(df, {"x": ps})["x"], np.percentile(x, np.array(ps) * 100), rtol=1e-12)


def test_values_close_together_far_from_zero(spark):
    rng = np.random.default_rng(8)
    n = 12_000
    cols = {"near": 1e9 + rng.random(n), "below": -1e9 - rng.random(n), "tiny": rng.integers(0, 9, n) * 5e-324}
    df = spark.createDataFrame([tuple(float(x[i]) for x in cols.values()) for i in range(n)], ", ".join(f"{c} double" for c in cols))
    ps = [0.0, 0.3, 0.5, 0.99, 1.0]
    got = o.spreads(df, {c: ps for c in cols})
    for c, x in cols.items():
        ordered = np.sort(x)
        lowest, highest = (ordered[f([(n - 1) * p for p in ps]).astype(int)] for f in (np.floor, np.ceil))
        assert all(a <= q <= b for a, q, b in zip(lowest, got[c].quantiles, highest)), c
        np.testing.assert_allclose([got[c].mean, got[c].variance], [x.mean(), x.var()], rtol=1e-6)


def test_nan_counts_as_missing_and_infinite_values_have_ranks(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(v,) for v in (nan, None, -inf, -2.0, 0.0, 5.0, 1e308, inf, inf)], "x double")
    assert o.exact_quantiles(df, {"x": [0.0, 1 / 6, 2 / 6, 3 / 6, 4 / 6, 5 / 6, 1.0]})["x"] == [-inf, -2.0, 0.0, 5.0, 1e308, inf, inf]
    assert o.spreads(df, {"x": []})["x"].n == 7


def test_weighted_quantile_is_the_quantile_of_repeated_rows(spark):
    rng = np.random.default_rng(4)
    values, weights = rng.normal(size=500) * 10, rng.integers(0, 60, 500)
    df = spark.createDataFrame([(float(v), int(w)) for v, w in zip(values, weights)] + [(None, 9)], "v double, w int")
    whole = np.repeat(values, weights)
    for p in (0.0, 0.31, 0.5, 1.0):
        assert o.weighted_quantile(df, "v", "w", p) == pytest.approx(np.percentile(whole, 100 * p), rel=1e-12)
    assert o.weighted_quantile(df.where("v is null"), "v", "w", 0.5) is None


def test_rank_index_cuts_rows_with_ties_and_nulls(spark):
    rng = np.random.default_rng(6)
    rows = [(None if rng.random() < 0.1 else int(rng.integers(0, 9)) * 10 if rng.random() < 0.7 else 40,
             None if rng.random() < 0.1 else int(rng.integers(-50, 50))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    key = lambda r: tuple(x for v in r for x in ((1, 0) if v is None else (0, v)))
    ordered = sorted(map(key, rows))
    ranks = [0, 1, 700, 1400, 1790, 1850, 1999]
    for cell in (lambda k: k, lambda k: F.floor(k / 25), lambda k: F.floor(k / 1000)):
        index = o.RankIndex(df, ["a", "b"], cell)
        assert index.n == len(rows)
        assert index.cuts(ranks) == [ordered[r] for r in ranks]
    with pytest.raises(ValueError):
        index.cuts([2000])
    assert o.RankIndex(df.limit(0), ["a", "b"]).n == 0
