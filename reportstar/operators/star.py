"""Dimensions and facts of the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportstar.functions.text import classify_terminal, has_marker, strip
from reportstar.operators.lookup import Key, resolve_keys
from reportstar.operators.ordinals import with_ordinal

Tables = dict[str, DataFrame]


def natural_keys(sources: Sequence[tuple[DataFrame, str]], name: str) -> DataFrame:
    """Distinct trimmed names over several tables, without NULL and blank ones.

    The rows are reduced to distinct values first, map-side and then by one shuffle, so
    that only those are trimmed, tested and made distinct again. The test mentions the
    count because a test of the name alone would be pushed back down to every row.
    """
    parts = [df.select(F.col(column).alias(name)) for df, column in sources]
    values = reduce(DataFrame.unionByName, parts).groupBy(name).agg(F.count(F.lit(1)).alias("__n"))
    named = values.filter(F.when(F.col("__n") > 0, has_marker(name)))
    return named.select(strip(name).alias(name)).distinct()


def dim_cashier(cleaned: Tables) -> DataFrame:
    sources = [(cleaned[t], "cashier") for t in ("cash", "sessions", "stock")]
    return with_ordinal(natural_keys(sources, "cashier_name"), "cashier_id", [F.col("cashier_name")])


def dim_terminal(cleaned: Tables) -> DataFrame:
    """Terminals of the sessions and, where the column exists, of cash and stock."""
    sources = [(cleaned["sessions"], "terminal")]
    sources += [(cleaned[t], "terminal") for t in ("cash", "stock") if "terminal" in cleaned[t].columns]
    names = natural_keys(sources, "terminal_name")
    return with_ordinal(names, "terminal_id", [F.col("terminal_name")]).withColumn(
        "terminal_type", classify_terminal("terminal_name")
    )


def dim_item(cleaned: Tables) -> DataFrame:
    """Distinct (name, category) pairs as they stand, NULL and blank ones too."""
    pairs = cleaned["stock"].select("item_name", "category").distinct()
    order = [F.col("category").asc_nulls_last(), F.col("item_name").asc_nulls_last()]
    return with_ordinal(pairs, "item_id", order)


def dim_member(cleaned: Tables) -> DataFrame:
    """Members keep their source id; repeated ids are kept and show in the key report."""
    return cleaned["members"].select("member_id", "username", "firstname", "lastname")


def build_dims(cleaned: Tables) -> Tables:
    return {
        "dim_cashier": dim_cashier(cleaned),
        "dim_terminal": dim_terminal(cleaned),
        "dim_item": dim_item(cleaned),
        "dim_member": dim_member(cleaned),
    }


def _cashier(dims: Tables) -> Key:
    return Key("cashier", dims["dim_cashier"], "cashier_name", "cashier_id")


def _terminal(dims: Tables) -> Key:
    return Key("terminal", dims["dim_terminal"], "terminal_name", "terminal_id")


def fact_cash_transactions(cleaned: Tables, dims: Tables, **options) -> DataFrame:
    df = resolve_keys(cleaned["cash"], [_cashier(dims), _terminal(dims)], **options)
    return df.select(
        "cashier_id",
        F.col("date").alias("transaction_datetime"),
        "income_expense",
        "payment_method",
        "transaction_type",
        "amount_tnd",
        "terminal_id",
    )


def fact_sessions(cleaned: Tables, dims: Tables, **options) -> DataFrame:
    df = resolve_keys(cleaned["sessions"], [_cashier(dims), _terminal(dims)], **options)
    return df.select(
        "cashier_id",
        "terminal_id",
        "session_type",
        "is_free_time",
        "paused_duration_minutes",
        "duration_minutes",
        "order_transfer_tnd",
        "usage_tnd",
        "discount_tnd",
        "total_amount_tnd",
    )


def fact_stock_movements(cleaned: Tables, dims: Tables, **options) -> DataFrame:
    """A NULL item name finds the NULL item, unlike a NULL terminal or cashier."""
    item = Key("item_name", dims["dim_item"], "item_name", "item_id", null_safe=True)
    df = resolve_keys(cleaned["stock"], [_cashier(dims), _terminal(dims), item], **options)
    return df.select(
        "cashier_id",
        F.col("date").alias("movement_datetime"),
        "item_id",
        "in_out",
        "quantity",
        "unit_price_tnd",
        "total_amount_tnd",
        "terminal_id",
    )


def fact_member_stats(cleaned: Tables) -> DataFrame:
    return cleaned["members"].select(
        "member_id", "duration_minutes", "usage_tnd", "orders_transfer_tnd", "total_amount_tnd"
    )


def build_facts(cleaned: Tables, dims: Tables, **options) -> Tables:
    """Four facts; ``options`` go to ``resolve_keys`` (``strip_keys``, broadcast bounds)."""
    return {
        "fact_cash_transactions": fact_cash_transactions(cleaned, dims, **options),
        "fact_sessions": fact_sessions(cleaned, dims, **options),
        "fact_stock_movements": fact_stock_movements(cleaned, dims, **options),
        "fact_member_stats": fact_member_stats(cleaned),
    }


def transform(cleaned: Tables, **options) -> Tables:
    """All eight tables, dimensions first."""
    dims = build_dims(cleaned)
    return {**dims, **build_facts(cleaned, dims, **options)}
