"""Daily and weekly series from the facts, with every period of the calendar present."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportstar.functions.numbers import MONEY, money
from reportstar.functions.times import day, week_ending
from reportstar.operators.lookup import attach
from reportstar.staging import stage

# Fixed value: an item with fewer non-zero periods is not forecast.
MIN_PERIODS = 14
FREQUENCIES = {"D": 1, "W": 7}


def step_days(freq: str) -> int:
    if freq not in FREQUENCIES:
        raise ValueError(f"Unknown freq {freq!r}; expected 'D' or 'W'")
    return FREQUENCIES[freq]


def period(ds: Column, freq: str) -> Column:
    """Label of the day or of the Sunday-ending week of a date."""
    return ds if step_days(freq) == 1 else week_ending(ds)


def to_frequency(series: DataFrame, freq: str, keys: list[str]) -> DataFrame:
    """Sum a series ``*keys, ds, y`` per period."""
    return (
        series.withColumn("ds", period(F.col("ds"), freq)).groupBy(*keys, "ds").agg(F.sum("y").cast(MONEY).alias("y"))
    )


def fill_gaps(series: DataFrame, low: date, high: date, freq: str, keys: list[str]) -> DataFrame:
    """Every period from ``low`` to ``high`` for every key of ``series``; gaps are 0.

    ``series`` has one row per key and period. Its rows are all that is shuffled: behind the shuffle each is followed by zero
    rows up to the next one of its key, the first one is also led by them.
    """
    step = F.make_dt_interval(F.lit(step_days(freq)))
    own = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("ds")
    begin = F.when(F.lag("ds").over(own).isNull(), F.lit(low)).otherwise(F.col("ds"))
    end = F.coalesce(F.date_sub(F.lead("ds").over(own), step_days(freq)), F.lit(high))
    rows = series.select(*keys, "ds", "y", begin.alias("begin"), end.alias("end"))
    each = rows.select(*keys, "y", F.col("ds").alias("of"), F.explode(F.sequence("begin", "end", step)).alias("ds"))
    value = F.when(F.col("ds") == F.col("of"), F.col("y")).otherwise(F.lit(0))
    return each.select(*keys, "ds", value.cast(MONEY).alias("y"))


def revenue_series(cash: DataFrame, freq: str = "D") -> DataFrame:
    """``ds, y``: income per period from the first to the last day with income."""
    daily = stage(
        cash.filter(F.col("income_expense") == "Income")
        .groupBy(day("transaction_datetime").alias("ds"))
        .agg(F.sum(money("amount_tnd")).cast(MONEY).alias("y"))
        .filter(F.col("ds").isNotNull()),
        "daily_income",
    )
    low, high, total = daily.agg(
        F.min(period(F.col("ds"), freq)), F.max(period(F.col("ds"), freq)), F.sum("y")
    ).first()
    if not total:
        raise ValueError("No income data found in fact_cash_transactions")
    return fill_gaps(to_frequency(daily, freq, []), low, high, freq, []).select(
        "ds", F.col("y").cast("double").alias("y")
    )


def label_items(per_item: DataFrame, items: DataFrame) -> DataFrame:
    """Item names for item ids; rows of unknown or unnamed items stay with NULL."""
    names = items.groupBy("item_id").agg(F.max("item_name").alias("item_name"))
    return attach(per_item, names, "item_id", "item_id").drop("item_id")


def item_periods(
    stock: DataFrame, items: DataFrame, freq: str = "D", min_periods: int = MIN_PERIODS
) -> tuple[DataFrame, DataFrame, date | None, date | None]:
    """Outgoing quantity of the items with enough periods, the other items, first and last period.

    Returns ``(item_name, ds, y)`` with the periods that have movements, ``(item_name, nonzero)``, and the
    calendar, which runs over the days of all items together. Movements are summed per id and
    day before names are looked up.
    """
    sold = (
        stock.filter(F.col("in_out") == "Out")
        .groupBy("item_id", day("movement_datetime").alias("ds"))
        .agg(F.sum("quantity").alias("y"))
        .filter(F.col("ds").isNotNull())
    )
    named = label_items(sold, items).filter(F.col("item_name").isNotNull())
    totals = to_frequency(named, freq, ["item_name"])
    # One row per item and period: the window holds no more rows than the calendar.
    per_item = Window.partitionBy("item_name")
    totals = stage(
        totals.withColumn("nonzero", F.count_if(F.col("y") > 0).over(per_item)), "item_periods"
    )
    low, high = totals.agg(F.min("ds"), F.max("ds")).first()
    kept = totals.filter(F.col("nonzero") >= min_periods)
    skipped = totals.filter(F.col("nonzero") < min_periods).select("item_name", "nonzero").distinct()
    return kept.select("item_name", "ds", "y"), skipped, low, high


def consumption_series(
    stock: DataFrame, items: DataFrame, freq: str = "D", min_periods: int = MIN_PERIODS
) -> tuple[DataFrame, DataFrame]:
    """``item_periods`` with every period of the calendar present: ``(item_name, ds, y)``, and the skipped items."""
    kept, skipped, low, high = item_periods(stock, items, freq, min_periods)
    filled = fill_gaps(kept, low, high, freq, ["item_name"]) if low else kept
    return filled.select("item_name", "ds", F.col("y").cast("double").alias("y")), skipped


def average_prices(stock: DataFrame, items: DataFrame) -> DataFrame:
    """Mean of the positive unit prices per item name, incoming and outgoing rows alike."""
    per_id = (
        stock.filter(F.col("unit_price_tnd") > 0)
        .groupBy("item_id")
        .agg(F.sum(money("unit_price_tnd")).alias("prices"), F.count(F.lit(1)).alias("n"))
    )
    return (
        label_items(per_id, items)
        .filter(F.col("item_name").isNotNull())
        .groupBy("item_name")
        .agg((F.sum("prices").cast("double") / F.sum("n")).alias("avg_price"))
    )
