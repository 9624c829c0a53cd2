"""Forecasts of many series at once: a trend that may bend, weekday effects, and a band from past errors.

The trend of a series is a straight line that may bend at ``KNOTS`` places, spread evenly over the first
four fifths of its periods. The bends are found from normal equations with a penalty on their size (lasso, solved by
``SWEEPS`` rounds of coordinate descent), so that a series without a break keeps a straight line. What is left per
weekday is the season. The band comes from forecasts that the series would have got at up to ``ORIGINS`` earlier
dates: the root mean square of their errors, times a fixed 80 % factor.

All of it is solved from sums per series, weekday and origin, which Spark reduces before the shuffle. The earlier
forecasts use the same sums up to their date, so no row is read for them again. Bends, weekdays and origins are few and fixed: a
series is one narrow row, whatever its length, and many rows are solved together; only the periods of the past forecasts travel
along to be compared.

It keeps the contract of the forecast tables (columns, number of rows, values of at least zero), not the numbers of
any particular forecasting library.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportstar.functions.numbers import clamp_zero
from reportstar.operators.explore import top
from reportstar.operators.lookup import attach
from reportstar.operators.series import (
    average_prices,
    item_periods,
    revenue_series,
    step_days,
)
from reportstar.operators.trend import KNOTS, Sums, solve
from reportstar.workers import reach_workers

# Fixed value: two-sided 80 % quantile of the normal distribution.
BAND = 1.2816
#: Forecasts of the past that a band is measured on. The first has at least ``ORIGINS - 1`` horizons before it.
ORIGINS = 3
TOP_ITEMS = 10

#: Series that are solved together.
TOGETHER = 1024

#: Values: 26 digits before the point. That leaves their sums, with periods as weights, six more.
_VALUE = "decimal(32,6)"
_SUM = "decimal(38,6)"


def _number(c: Column) -> Column:
    return c.cast("double")


def _periods(series: DataFrame, freq: str, span: tuple[date, date] | None) -> DataFrame:
    """``series, first, n, u, y``: each value with its number of periods since the first, and how many there are."""
    step = step_days(freq)
    if span is not None:
        first, n = F.lit(span[0]), F.lit((span[1] - span[0]).days // step + 1)
    else:
        ends = series.groupBy(F.col("series").alias("whose")).agg(F.min("ds").alias("first"), F.max("ds").alias("last"))
        series = series.join(ends, F.col("series").eqNullSafe(F.col("whose")))
        first, n = F.col("first"), (F.floor(F.datediff("last", "first") / step) + 1).cast("int")
    u = F.floor(F.datediff("ds", first) / step).cast("int")
    return series.select("series", first.alias("first"), n.alias("n"), u.alias("u"), F.col("y").cast(_VALUE).alias("y"))


def _sums(periods: DataFrame, seasons: int, horizon: int) -> DataFrame:
    """One row per series: ``sums`` per season and fold (part of the calendar between origins), and the ``tail`` of values.

    Sums of values and of their products with the parts of the trend are exact, so they don't depend on the order of rows.
    """
    n, u, y = F.col("n"), F.col("u"), F.col("y")
    times = u.cast("decimal(7,0)")
    fold = F.greatest(F.lit(0), F.lit(ORIGINS) - F.floor((n - 1 - u) / horizon)).cast("int")
    # Bends where ``trend.knots`` has them.
    hinges = [F.expr(f"cast(greatest(u - ({8 * j} * (n - 1)) div {10 * (KNOTS + 1)}, 0) as decimal(7,0)) * y") for j in range(1, KNOTS + 1)]
    parts = periods.withColumns({"season": u % seasons, "fold": fold, "uy": times * y, **{f"h{j}": h for j, h in enumerate(hinges)}})
    one = parts.groupBy("series", "first", "n", "season", "fold").agg(
        F.sum("y").cast(_SUM).alias("y"),
        F.sum("uy").cast(_SUM).alias("uy"),
        F.sum(_number(y) * _number(y)).alias("yy"),
        F.array(*[F.sum(f"h{j}").cast(_SUM) for j in range(KNOTS)]).alias("hy"),
        F.collect_list(F.when(F.col("fold") > 0, F.struct("u", _number(y).alias("y")))).alias("tail"),
    )
    return one.groupBy("series", "first", "n").agg(
        # At most seven weekdays times the folds; sorted, so that they are added up in one order.
        F.sort_array(F.collect_list(F.struct(
            "season", "fold", _number(F.col("y")).alias("y"), _number(F.col("uy")).alias("uy"), "yy", F.transform("hy", _number).alias("hy")
        ))).alias("sums"),
        F.flatten(F.collect_list("tail")).alias("tail"),
    )


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """Row number and value of every element of a list column."""
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), sizes), column.flatten()


def _numbers(elements: pa.StructArray, name: str) -> np.ndarray:
    return elements.field(name).to_numpy(zero_copy_only=False)


def _predict(batch: pa.RecordBatch, seasons: int, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of the next ``horizon`` periods of each series, and the root mean square error of its past forecasts."""
    n = batch.column("n").to_numpy().astype(np.int64)
    count, folds = len(n), ORIGINS + 1
    row, e = _flat(batch.column("sums"))
    at = row, _numbers(e, "fold")
    per = {c: np.zeros((count, folds)) for c in ("y", "uy", "yy")}
    for c, table in per.items():
        np.add.at(table, at, _numbers(e, c))
    hy = np.zeros((count, folds, KNOTS))
    np.add.at(hy, at, e.field("hy").flatten().to_numpy().reshape(-1, KNOTS))
    season = np.zeros((count, folds, seasons))
    np.add.at(season, (*at, _numbers(e, "season")), _numbers(e, "y"))
    row, e = _flat(batch.column("tail"))
    tail = np.zeros((count, ORIGINS * horizon))
    tail[row, _numbers(e, "u") - n[row] + ORIGINS * horizon] = _numbers(e, "y")

    def fit(back: int, rows: np.ndarray):
        # Folds are in the order of the calendar: what was known then is a prefix of them.
        upto = folds - back
        part = (x[rows, :upto].sum(1) for x in (*per.values(), hy, season))
        return solve(Sums(*part), n[rows], n[rows] - back * horizon)

    everyone = np.arange(count)
    whole, ahead = fit(0, everyone), np.arange(horizon)[None, :]
    squares, periods = np.zeros(count), np.zeros(count)
    for back in range(1, ORIGINS + 1):
        rows = np.flatnonzero(n - back * horizon >= (ORIGINS - 1) * horizon)
        known = tail[rows, (ORIGINS - back) * horizon : (ORIGINS - back + 1) * horizon]
        off = known - fit(back, rows).at((n[rows] - back * horizon)[:, None] + ahead)
        squares[rows] += (off * off).sum(1)
        periods[rows] += horizon
    # A series without past forecasts is short enough for all its values to be at hand.
    u = n[:, None] - ORIGINS * horizon + np.arange(ORIGINS * horizon)[None, :]
    off = np.where(u >= 0, tail - whole.at(np.maximum(u, 0)), 0.0)
    squares = np.where(periods > 0, squares, (off * off).sum(1))
    periods = np.where(periods > 0, periods, np.maximum(n - 1, 1))
    spread = np.where((n == 1) & (periods == 1), 0.0, np.sqrt(squares / periods))
    return whole.at(n[:, None] + ahead), spread


def _fit(series: DataFrame, freq: str, horizon: int, span: tuple[date, date] | None = None) -> DataFrame:
    """``series, first, n, point, spread`` of every series; ``point`` lists its next ``horizon`` values."""
    seasons = 7 if step_days(freq) == 1 else 1
    table = _sums(_periods(series, freq, span), seasons, horizon)
    kept = [table.schema[c] for c in ("series", "first", "n")]
    schema = T.StructType([*kept, T.StructField("point", T.ArrayType(T.DoubleType())), T.StructField("spread", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(first, TOGETHER)
                point, spread = _predict(part, seasons, horizon)
                lists = pa.ListArray.from_arrays(np.arange(len(point) + 1, dtype=np.int32) * horizon, pa.array(point.ravel()))
                keys = [part.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*keys, lists, pa.array(spread)], names=schema.names)

    reach_workers(series.sparkSession)
    return table.mapInArrow(run, schema)


def forecast(
    series: DataFrame,
    keys: Sequence[str],
    horizon: int,
    freq: str = "D",
    span: tuple[date, date] | None = None,
) -> DataFrame:
    """``*keys, ds, yhat, yhat_lower, yhat_upper`` for ``horizon`` periods after each series.

    ``series`` holds ``*keys, ds, y`` with every period present, or, with the ``span`` of the first and last
    period of all series, only those with a value. All values are at least 0. Values are taken with six decimals
    and below 1e26; larger ones raise an error.
    """
    step = step_days(freq)
    # One column for all keys, whose names then cannot meet those of the model.
    owner = F.struct(*keys) if keys else F.lit(0)
    fitted = _fit(series.select(owner.alias("series"), "ds", "y"), freq, horizon, span)
    ahead = fitted.select("series", "first", "n", "spread", F.posexplode("point").alias("k", "point"))
    rows = ahead.select("series", F.date_add("first", (F.col("n") + F.col("k")) * step).alias("ds"), "point", (BAND * F.col("spread")).alias("margin"))
    return rows.select(
        *[F.col("series")[k].alias(k) for k in keys],
        "ds",
        clamp_zero("point").alias("yhat"),
        clamp_zero(F.col("point") - F.col("margin")).alias("yhat_lower"),
        clamp_zero(F.col("point") + F.col("margin")).alias("yhat_upper"),
    )


def coverage(series: DataFrame, keys: Sequence[str], horizon: int, freq: str, span: tuple[date, date]) -> DataFrame:
    """``*keys, periods, inside``: how many of the last ``horizon`` periods lie inside the band forecast without them.

    ``series`` holds the periods with a value; the others of ``span`` are 0.
    """
    step = step_days(freq)
    cut = F.date_sub(F.lit(span[1]), (horizon - 1) * step)
    end = span[1].fromordinal(span[1].toordinal() - horizon * step)
    if end < span[0]:
        raise ValueError("The series is no longer than the horizon")
    made = forecast(series.filter(F.col("ds") < cut), keys, horizon, freq, (span[0], end))
    held = series.filter(F.col("ds") >= cut).select(*[F.col(k).alias(f"held_{k}") for k in keys], F.col("ds").alias("held_ds"), _number(F.col("y")).alias("y"))
    same = F.col("ds") == F.col("held_ds")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"held_{k}"))
    known = F.coalesce("y", F.lit(0.0))
    inside = F.count_if((known >= F.col("yhat_lower")) & (known <= F.col("yhat_upper")))
    return made.join(held, same, "left").groupBy(*keys).agg(F.count(F.lit(1)).alias("periods"), inside.alias("inside"))


def forecast_consumption(
    series: DataFrame, horizon: int = 30, freq: str = "D", span: tuple[date, date] | None = None
) -> DataFrame:
    return forecast(series, ["item_name"], horizon, freq, span).select(
        F.col("ds").alias("date"),
        "item_name",
        F.col("yhat").alias("predicted_qty"),
        F.col("yhat_lower").alias("lower_qty"),
        F.col("yhat_upper").alias("upper_qty"),
    )


def derived_revenue(consumption: DataFrame, prices: DataFrame) -> DataFrame:
    """``date, derived_revenue_tnd``: predicted quantity times mean price; no price counts 0."""
    priced = attach(consumption, prices, "item_name", "item_name")
    value = F.col("predicted_qty") * F.coalesce("avg_price", F.lit(0.0))
    return priced.groupBy("date").agg(F.sum(value).alias("derived_revenue_tnd"))


def forecast_direct(series: DataFrame, horizon: int = 30, freq: str = "D") -> DataFrame:
    return forecast(series, [], horizon, freq).select(
        F.col("ds").alias("date"),
        F.col("yhat").alias("direct_revenue_tnd"),
        F.col("yhat_lower").alias("direct_lower_tnd"),
        F.col("yhat_upper").alias("direct_upper_tnd"),
    )


def forecast_revenue(
    series: DataFrame, derived: DataFrame, horizon: int = 30, freq: str = "D"
) -> DataFrame:
    """Direct and derived revenue per date; ``derived`` has a row per date of the horizon at most."""
    direct = forecast_direct(series, horizon, freq)
    return attach(direct, derived, "date", "date", rows_at_most=horizon).withColumn(
        "derived_revenue_tnd", F.coalesce("derived_revenue_tnd", F.lit(0.0))
    )


def forecast_tables(
    cash: DataFrame, stock: DataFrame, items: DataFrame, horizon: int = 30, freq: str = "D"
) -> dict[str, DataFrame]:
    """``consumption``, ``revenue``, ``direct`` revenue alone and the ``skipped`` items from three star tables."""
    per_item, skipped, low, high = item_periods(stock, items, freq)
    span = (low, high) if low else None
    consumption = forecast_consumption(per_item, horizon, freq, span)
    derived = derived_revenue(consumption, average_prices(stock, items))
    income = revenue_series(cash, freq)
    return {
        "consumption": consumption,
        "revenue": forecast_revenue(income, derived, horizon, freq),
        "direct": forecast_direct(income, horizon, freq),
        "skipped": skipped,
    }


def forecast_summary(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Top items by predicted quantity, revenue over the horizon with its range, skipped items."""
    per_item = tables["consumption"].groupBy("item_name").agg(
        F.sum("predicted_qty").alias("predicted_total_qty")
    )
    totals = tables["direct"].agg(
        *[F.sum(f"{c}_tnd").alias(f"{c}_tnd") for c in ("direct_revenue", "direct_lower", "direct_upper")]
    )
    return {
        "top_items": top(per_item, "predicted_total_qty", "item_name", TOP_ITEMS),
        "totals": totals,
        "skipped": tables["skipped"],
    }
