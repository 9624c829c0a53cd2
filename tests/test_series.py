import datetime as dt
import random

import numpy as np
import pytest

from reportstar.operators import series
from reportstar.operators.forecast import (
    BAND,
    ORIGINS,
    coverage,
    derived_revenue,
    forecast,
    forecast_summary,
    forecast_tables,
)
from reportstar.operators.trend import PENALTY, SWEEPS, knots

DAY0 = dt.datetime(2026, 1, 1, 12)


def cash_of(spark, rows):
    return spark.createDataFrame(
        [(DAY0 + dt.timedelta(days=d), kind, v) for d, kind, v in rows],
        "transaction_datetime timestamp_ntz, income_expense string, amount_tnd double")


def stock_of(spark, rows):
    data = [(DAY0 + dt.timedelta(days=d), k, i, q, p) for d, k, i, q, p in rows]
    return spark.createDataFrame(
        data, "movement_datetime timestamp_ntz, in_out string, item_id bigint, quantity int, unit_price_tnd double")


def items_of(spark, *names):
    return spark.createDataFrame(list(enumerate(names, 1)), "item_id bigint, item_name string")


def test_revenue_counts_income_only_and_fills_gaps(spark):
    cash = cash_of(spark, [(0, "Income", 10.1), (0, "Income", 0.2), (1, "Expense", 99.0), (3, "Income", 5.0), (9, "Expense", 1.0)])
    got = [(r["ds"].day, r["y"]) for r in series.revenue_series(cash).orderBy("ds").collect()]
    assert got == [(1, 10.3), (2, 0.0), (3, 0.0), (4, 5.0)]


@pytest.mark.parametrize("rows", [[(0, "Expense", 5.0)], [(0, "Income", 0.0)], []])
def test_revenue_needs_income(spark, rows):
    with pytest.raises(ValueError, match="No income data found"):
        series.revenue_series(cash_of(spark, rows))


def test_consumption(spark, rows):
    moves = [(d, "Out", 1, 2, 1.0) for d in range(0, 28, 2)] + [(d, "Out", 2, 1, 1.0) for d in range(13)]
    moves += [(50, "In", 1, 9, 1.0), (29, "Out", 2, 0, 1.0), (5, "Out", 7, 4, 1.0), (5, "Out", 3, 4, 1.0)]
    kept, skipped = series.consumption_series(stock_of(spark, moves), items_of(spark, "Soda", "Chips", None))
    got = {r["ds"]: r["y"] for r in kept.filter("item_name = 'Soda'").collect()}
    # The calendar ends with the last outgoing row of any named item.
    assert len(got) == 30 and sum(got.values()) == 28 and list(got.values()).count(0.0) == 16
    assert rows(skipped) == [("Chips", 13)]
    assert {r["item_name"] for r in kept.collect()} == {"Soda"}


def test_items_of_one_name_are_one_series(spark):
    moves = [(d, "Out", 1 + d % 2, 1, 1.0) for d in range(14)]
    kept, skipped = series.consumption_series(stock_of(spark, moves), items_of(spark, "Soda", "Soda"))
    assert kept.count() == 14 and skipped.count() == 0


def test_weekly_labels_are_sundays(spark):
    moves = [(7 * d, "Out", 1, 1, 1.0) for d in range(14)] + [(100, "Out", 1, 5, 1.0)]
    kept, _ = series.consumption_series(stock_of(spark, moves), items_of(spark, "Soda"), "W")
    out = kept.orderBy("ds").collect()
    assert {r["ds"].weekday() for r in out} == {6} and len(out) == 15
    assert out[0]["ds"] == dt.date(2026, 1, 4) and sum(r["y"] for r in out) == 19


def test_no_movements_give_empty_tables(spark):
    kept, skipped = series.consumption_series(stock_of(spark, [(0, "In", 1, 1, 1.0)]), items_of(spark, "Soda"))
    assert kept.count() == 0 and skipped.count() == 0


def test_average_price_counts_positive_prices_of_all_rows(spark, rows):
    moves = [(0, "Out", 1, 1, 2.0), (0, "In", 1, 1, 3.0), (0, "In", 1, 1, 0.0), (0, "Out", 2, 1, 0.0), (0, "Out", 3, 1, 4.0)]
    items = items_of(spark, "Soda", "Chips", "Soda")
    assert rows(series.average_prices(stock_of(spark, moves), items)) == [("Soda", 3.0)]


def test_derived_revenue(spark, rows):
    c = spark.createDataFrame([("d1", "Soda", 2.0), ("d1", "Chips", 9.0), ("d2", "Chips", 1.0)],
                              "date string, item_name string, predicted_qty double")
    p = spark.createDataFrame([("Soda", 1.5)], "item_name string, avg_price double")
    assert rows(derived_revenue(c, p)) == [("d1", 3.0), ("d2", 0.0)]


def test_gaps_are_filled_behind_the_only_shuffle(spark):
    rows = [("a", 3, 1.0), ("a", 40, 2.0), ("b", 0, 5.0), ("c", 999, 7.0), (None, 5, 1.0)]
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(1000)]
    df = spark.createDataFrame([(k, days[d], y) for k, d, y in rows], "k string, ds date, y double")
    filled = series.fill_gaps(df, days[0], days[-1], "D", ["k"])
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange") and "Union" not in plan
    got = {(r["k"], r["ds"]): float(r["y"]) for r in filled.collect()}
    assert len(got) == 4000 and {(k, days.index(d), y) for (k, d), y in got.items() if y} == set(rows)


def lasso(x, y, penalty):
    """Coordinate descent over the columns of ``x``, which are standardised."""
    d = np.zeros(x.shape[1])
    for _ in range(SWEEPS):
        for j in range(len(d)):
            if x[:, j].any():
                rest = x[:, j] @ (y - x @ d) + d[j]
                d[j] = np.sign(rest) * max(abs(rest) - penalty, 0)
    return d


def brute_fit(ys, n, step, ahead):
    """Values of the next periods: bends by lasso beside a line, then means per weekday."""
    m, u = len(ys), np.arange(len(ys) + ahead, dtype=float)
    bends = np.maximum(u[:, None] - knots(np.array([n]))[0], 0)
    line = np.stack([np.ones(m), u[:m]], 1)
    off = lambda x: x - line @ np.linalg.lstsq(line, x, rcond=None)[0]
    x = off(bends[:m])
    size = np.sqrt((x * x).sum(0))
    size[size**2 <= 1e-6 * (bends[:m] ** 2).sum(0)] = 0
    x = np.divide(x, size, out=np.zeros_like(x), where=size > 0)
    noise = np.sqrt((off(ys) ** 2).sum() / (m - 2)) if m > 2 else 0.0
    d = np.divide(lasso(x, off(ys), PENALTY * noise), size, out=np.zeros(len(size)), where=size > 0)
    bent = bends @ d
    trend = np.stack([np.ones(len(u)), u], 1) @ np.linalg.lstsq(line, ys - bent[:m], rcond=None)[0] + bent
    if step == 7:
        return trend
    rest = ys - trend[:m]
    return trend + np.array([rest[k % 7 :: 7].mean() if k % 7 < m else 0.0 for k in range(len(u))])


def brute(ys, first, horizon, step):
    """The estimator written out with numpy: the same fit for the whole series and for its past."""
    ys, n = np.array(ys), len(ys)
    made = brute_fit(ys, n, step, horizon)
    errors = []
    for back in range(1, ORIGINS + 1):
        m = n - back * horizon
        if m >= (ORIGINS - 1) * horizon:
            errors += list(ys[m : m + horizon] - brute_fit(ys[:m], n, step, horizon)[m:])
    sd = np.sqrt(np.mean(np.square(errors))) if errors else np.sqrt(((ys - made[:n]) ** 2).sum() / (n - 1)) if n > 1 else 0.0
    days = [first + dt.timedelta(days=step * i) for i in range(n + horizon)]
    return [(days[i], *[max(v, 0.0) for v in (made[i], made[i] - BAND * sd, made[i] + BAND * sd)]) for i in range(n, n + horizon)]


@pytest.mark.parametrize("freq, step", [("D", 1), ("W", 7)])
def test_forecast_agrees_with_the_written_out_estimator(spark, freq, step):
    rng = random.Random(11)
    first = dt.date(2026, 1, 4)
    made = {
        "up": [i * 3 + 10 * (i % 7 == 0) + rng.random() for i in range(60)],
        "down": [500 - i * 9.5 for i in range(60)],
        "bend": [100 + 2 * max(i - 60, 0) + rng.random() for i in range(140)],
        "gone": [max(200.0 - 3 * i, 0.0) + 5 * (i % 7) for i in range(95)],
        "flat": [7.0] * 20,
        "one": [5.0],
        "short": [1.0, 4.0, 2.0],
    }
    made = {k: [round(v, 2) for v in ys] for k, ys in made.items()}
    rows = [(k, first + dt.timedelta(days=step * i), y) for k, ys in made.items() for i, y in enumerate(ys)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, ds date, y double").repartition(5)
    got = {}
    for r in forecast(df, ["k"], 10, freq).orderBy("k", "ds").collect():
        got.setdefault(r["k"], []).append(tuple(r)[1:])
    for k, ys in made.items():
        want = brute(ys, first, 10, step)
        assert [g[0] for g in got[k]] == [w[0] for w in want]
        assert np.allclose([g[1:] for g in got[k]], [w[1:] for w in want], rtol=1e-6, atol=1e-4), k


def test_a_forecast_follows_the_last_bend(spark):
    rng = random.Random(4)
    rows = [("k", DAY0.date() + dt.timedelta(days=i), 50 + 3.0 * max(i - 200, 0) + rng.gauss(0, 2)) for i in range(365)]
    rows += [("noise", DAY0.date() + dt.timedelta(days=i), 100 + rng.gauss(0, 5)) for i in range(365)]
    span = (DAY0.date(), DAY0.date() + dt.timedelta(days=364))
    got = forecast(spark.createDataFrame(rows, "k string, ds date, y double"), ["k"], 30, "D", span).orderBy("k", "ds").collect()
    last = [r for r in got if r["k"] == "k"][-1]
    assert abs(last["yhat"] - (50 + 3.0 * (394 - 200))) < 30  # a straight line is off by some 150
    assert all(abs(r["yhat"] - 100) < 5 for r in got if r["k"] == "noise")


def test_values_of_every_size(spark):
    first = DAY0.date()
    rows = [(f, first + dt.timedelta(days=i), f * (1 + i % 7)) for f in (1e21, 1.0, 1e-6) for i in range(70)]
    df = spark.createDataFrame(rows, "k double, ds date, y double")
    shapes = {}
    for r in forecast(df, ["k"], 7).orderBy("ds").collect():
        shapes.setdefault(r["k"], []).append([r[c] / r["k"] for c in ("yhat", "yhat_lower", "yhat_upper")])
    assert len(shapes) == 3
    for f in (1e21, 1e-6):
        assert np.allclose(shapes[f], shapes[1.0], rtol=1e-6, atol=1e-9)


def test_values_beyond_sums_of_money(spark):
    first = DAY0.date()
    rows = [(f, first + dt.timedelta(days=i), f * (500 + i % 7)) for f in (1e20, 1e23, 1.0) for i in range(2400)]
    df = spark.createDataFrame(rows, "k double, ds date, y double")
    shapes = {}
    for r in forecast(df, ["k"], 7).orderBy("ds").collect():
        shapes.setdefault(r["k"], []).append([r[c] / r["k"] for c in ("yhat", "yhat_lower", "yhat_upper")])
    for f in (1e20, 1e23):
        assert np.allclose(shapes[f], shapes[1.0], rtol=1e-6)


def test_coverage(spark):
    rng = random.Random(8)
    rows = [(k, DAY0.date() + dt.timedelta(days=i), max(50 + 9 * (i % 7) + rng.gauss(0, 6), 0.0)) for k in "abcdef" for i in range(200)]
    span = (DAY0.date(), DAY0.date() + dt.timedelta(days=199))
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    got = {r["k"]: (r["periods"], r["inside"]) for r in coverage(df, ["k"], 30, "D", span).collect()}
    assert set(got) == set("abcdef") and all(p == 30 for p, _ in got.values())
    assert 0.65 < sum(i for _, i in got.values()) / 180 < 0.95
    with pytest.raises(ValueError):
        coverage(df, ["k"], 300, "D", span)


def test_forecast_tables_and_summary(spark):
    cash = cash_of(spark, [(d, "Income", 100.0) for d in range(30)])
    stock = stock_of(spark, [(d, "Out", 1, 5, 2.5) for d in range(30)] + [(3, "Out", 2, 1, 1.0)])
    out = forecast_tables(cash, stock, items_of(spark, "Soda", "Chips"), horizon=7)
    revenue = out["revenue"].orderBy("date").collect()
    assert out["revenue"].columns == [
        "date", "direct_revenue_tnd", "direct_lower_tnd", "direct_upper_tnd", "derived_revenue_tnd"]
    assert len(revenue) == 7 and revenue[0]["date"] == dt.date(2026, 1, 31)
    assert [r["direct_revenue_tnd"] for r in revenue] == pytest.approx([100.0] * 7)
    assert [r["derived_revenue_tnd"] for r in revenue] == pytest.approx([12.5] * 7)
    assert out["consumption"].columns == ["date", "item_name", "predicted_qty", "lower_qty", "upper_qty"]
    summary = forecast_summary(out)
    assert [r["item_name"] for r in summary["top_items"].collect()] == ["Soda"]
    assert summary["totals"].first()["direct_revenue_tnd"] == pytest.approx(700.0)
    assert [tuple(r) for r in summary["skipped"].collect()] == [("Chips", 1)]


def test_unknown_frequency(spark):
    with pytest.raises(ValueError):
        series.revenue_series(cash_of(spark, [(0, "Income", 1.0)]), "M")
