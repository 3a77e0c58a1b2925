"""Ordered work over blocks gives what pandas gives over the whole table, hot keys included."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesline.operators import clean, ewma, ordering, profile, quantiles, repair, windows
from salesline.operators.ordering import Series


@pytest.fixture(scope="module")
def rows():
    """Two of three rows share one key; every fifth value is unknown."""
    rng = np.random.default_rng(7)
    n = 600
    key = np.where(rng.random(n) < 0.66, "hot", rng.choice(list("abc"), n))
    value = np.where(rng.random(n) < 0.2, np.nan, rng.integers(1, 1000, n))
    value[200:260] = np.nan
    return pd.DataFrame({"rid": rng.permutation(n), "k": key, "day": rng.integers(0, 40, n), "value": value})


@pytest.fixture(scope="module")
def table(spark, rows):
    df = spark.createDataFrame(rows)
    return df.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def ordered(rows, keys=()):
    return rows.sort_values([*keys, "day", "rid"])


def collect(df, col):
    return df.select("rid", col).toPandas().set_index("rid")[col].sort_index().astype(float)


def same(got, want):
    pd.testing.assert_series_equal(got, want.sort_index().astype(float), check_names=False, check_index_type=False)


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("strategy", ["ffill", "bfill"])
def test_fill_over_blocks(table, rows, keys, strategy):
    got = clean.fill_missing(table, ["value"], strategy, ("day", "rid"), keys, blocks=7)
    want = ordered(rows).set_index("rid")
    want = getattr(want.groupby("k")["value"] if keys else want["value"], strategy)()
    same(collect(got, "value"), want)


def test_unknown_strategy(table):
    with pytest.raises(ValueError):
        clean.fill_missing(table, ["value"], "guess")


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_longer_tables_get_more_blocks(table, rows, keys, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_BLOCK", 60)
    blocks = ordering.range_blocks(table, [*keys, "day", "rid"])
    sizes = [r["count"] for r in blocks.groupBy(ordering.BLOCK).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 120
    want = ordered(rows, keys).set_index("rid")
    want = (want.groupby("k")["value"] if keys else want["value"]).ffill()
    same(collect(clean.fill_missing(table, ["value"], "ffill", ("day", "rid"), keys), "value"), want)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_sum_and_totals(table, rows, keys):
    blocks = ordering.range_blocks(table, [*keys, "day", "rid"], 7)
    got = ordering.running_sum(blocks, {"s": F.coalesce("value", F.lit(0.0))}, keys, totals=True)
    want = ordered(rows).set_index("rid").fillna({"value": 0})
    grouped = want.groupby("k")["value"] if keys else want["value"]
    same(collect(got, "s"), grouped.cumsum())
    total = grouped.transform("sum") if keys else pd.Series(want["value"].sum(), index=want.index)
    same(collect(got, "s_total"), total)


def test_row_index(table, rows):
    got = ordering.row_index(table, ["day", "rid"], ["k"], blocks=5)
    same(collect(got, "row_index"), ordered(rows).set_index("rid").groupby("k").cumcount())


def test_window_over_blocks(table, rows):
    series = Series(("k",), ("day", "rid"), daily=False, blocks=5)

    def add(df, w):
        frame = w.rowsBetween(-6, 0)
        return df.withColumn("m", F.avg("value").over(frame)).withColumn("l", F.lag("value", 3).over(w))

    got = ordering.over_series(table, series, 6, add, rows_per_block=17)
    assert got.count() == len(rows)
    want = ordered(rows).set_index("rid")
    same(collect(got, "l"), want.groupby("k")["value"].shift(3))
    mean = want.groupby("k")["value"].transform(lambda x: x.rolling(7, min_periods=1).mean())
    same(collect(got, "m"), mean)


@pytest.mark.parametrize("daily", [True, False])
def test_ewma_is_exact(spark, daily):
    rng = np.random.default_rng(3)
    n = 2600
    x = rng.normal(100, 30, n)
    x[rng.random(n) < 0.15] = np.nan
    x[700:1900] = np.nan
    pdf = pd.DataFrame({"s": "a", "rid": np.arange(n), "value": x})
    pdf = pd.concat([pdf, pd.DataFrame({"s": ["b"], "rid": [n], "value": [1.0]})])
    df = spark.createDataFrame(pdf).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    spans = (7, 28, 365)
    got = ewma.add_ewma(df, spans=spans, series=Series(("s",), ("rid",), daily=daily, blocks=4))
    for span in spans:
        want = pdf.groupby("s")["value"].transform(
            lambda v, s=span: v.shift(1).ewm(span=s, min_periods=max(s // 2, 3)).mean()
        )
        same(collect(got, f"ewma_{span}"), pd.Series(want.to_numpy(), index=pdf["rid"]))


def test_span_groups_stay_in_range():
    assert ewma.span_groups([28, 7, 14]) == [[7, 14, 28]]
    assert ewma.span_groups([3, 365]) == [[3], [365]]


@pytest.mark.parametrize("blocks", [None, 6])
def test_quantiles(table, rows, blocks):
    levels = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    got = quantiles.exact_quantiles(table, "value", levels, ["k"], blocks).toPandas().set_index("k").sort_index()
    want = rows.groupby("k")["value"].quantile(list(levels.values())).unstack()
    np.testing.assert_allclose(got[list(levels)].to_numpy(), want.to_numpy())


def test_rank_correlations(table, rows):
    pairs = rows.dropna()
    got = profile.spearman(table, "value", "day", blocks=5).first()["corr"]
    assert got == pytest.approx(pairs["value"].rank().corr(pairs["day"].rank()), abs=1e-12)
    a, b = pairs["value"].to_numpy(), pairs["day"].to_numpy()
    sa, sb = np.sign(a[:, None] - a), np.sign(b[:, None] - b)
    tau = (sa * sb).sum() / np.sqrt((sa**2).sum() * (sb**2).sum())
    assert profile.kendall(table, "value", "day", blocks=5).first()["tau"] == pytest.approx(tau, abs=1e-12)


def test_kendall_orders_every_pair_twice_only(spark, monkeypatch):
    """No row for every bit of a rank; pairs within blocks, between them, ties and weights all count."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 40, 700), rng.integers(0, 300, 700)
    df = spark.createDataFrame(pd.DataFrame({"x": a, "y": b}))
    cut, ordered_rows = ordering.range_blocks, []

    def counted(rows, *args):
        ordered_rows.append(rows.count())
        return cut(rows, *args)

    monkeypatch.setattr(profile, "range_blocks", counted)
    found = profile.kendall(df, "x", "y", blocks=9).first()
    signs = np.sign(a[:, None] - a) * np.sign(b[:, None] - b)
    assert found["discordant"] == (signs < 0).sum() / 2
    assert sum(ordered_rows) <= 2 * len(set(zip(a.tolist(), b.tolist())))


@pytest.mark.parametrize("most", [5, 1 << 40])
def test_weighted_crossing(most):
    rng = np.random.default_rng(4)
    order, w = rng.permutation(77), rng.integers(most // 2, most, 77)
    want = sum(int(w[i]) * int(w[j]) for i in range(77) for j in range(i) if order[j] > order[i])
    assert profile._crossing(order, w) == want
    assert profile._crossing(order[:1], w[:1]) == profile._crossing(order[:0], w[:0]) == 0


def test_sequential_ids(table, rows):
    ids = table.withColumn("id", F.when(F.col("rid") % 3 != 0, F.concat(F.lit("store_"), "rid")))
    got = repair.fill_ids(ids, ["rid"], blocks=4).select("rid", "id").toPandas().set_index("rid")["id"]
    top = max(r for r in range(len(rows)) if r % 3)
    unknown = [r for r in range(len(rows)) if r % 3 == 0]
    assert all(got[r] == r for r in range(len(rows)) if r % 3)
    assert [got[r] for r in unknown] == list(range(top + 1, top + 1 + len(unknown)))


def test_short_window_is_refused(table):
    with pytest.raises(ValueError):
        windows.add_rolling(table, windows=(2,), series=Series(("k",), ("rid",)))


def test_drop_short_lags(spark):
    names = ["lag_7", "lag_14", "roll_mean_7", "ewma_28", "lag_diff_1_7", "ratio_lag7_lag14", "lag_note", "value"]
    df = spark.createDataFrame([tuple(range(8))], names)
    assert windows.drop_short_lags(df, 14).columns == ["lag_14", "ewma_28", "ratio_lag7_lag14", "lag_note", "value"]
