import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reportstar.functions.text import TERMINAL_RULES
from reportstar.operators import star
from reportstar.operators.clean import clean_all
from reportstar.operators.lookup import attach, resolve_fk
from reportstar.operators.ordinals import with_ordinal
from test_clean import raw_tables

PC = TERMINAL_RULES[2][2]
T0 = dt.datetime(2026, 3, 23, 3, 23, 54)


def cleaned_tables(spark):
    cash = [("anna", T0, "Income", "Cash", "Order", "(PS5 (1))", 27.5, "PS5 (1)"),
            ("ben", T0, "Income", "Cash", "Deposit", "Money deposited", 30.0, None)]
    sessions = [("anna", f"{PC}04", "Member", 89, False, None, 0.0, 11.87, 0.0, 11.87),
                ("anna", "PS5 (1)", "Free", 105, True, 30, 0.0, 0.0, 0.0, 0.0)]
    stock = [("anna", T0, "Soda", "Drinks", "Out", 4, "(PS5 (1))", 2.0, 8.0, "PS5 (1)")]
    members = [(35, "u1", "F1", "L1", 13406, 1745.44, 0.0, 1745.44), (64, "u2", "F2", "L2", 7735, 919.72, 0.0, 919.72)]
    schemas = {n: df.schema for n, df in clean_all(raw_tables(spark)).items()}
    data = {"cash": cash, "sessions": sessions, "stock": stock, "members": members}
    return {n: spark.createDataFrame(rows, schemas[n]) for n, rows in data.items()}


def test_transform(spark, rows):
    cleaned = cleaned_tables(spark)
    out = star.transform(cleaned)
    assert list(out) == ["dim_cashier", "dim_terminal", "dim_item", "dim_member", "fact_cash_transactions",
                         "fact_sessions", "fact_stock_movements", "fact_member_stats"]
    assert rows(out["dim_cashier"]) == [(1, "anna"), (2, "ben")]
    assert rows(out["dim_terminal"]) == [(1, f"{PC}04", "Computer"), (2, "PS5 (1)", "PlayStation")]
    assert rows(out["dim_item"]) == [(1, "Soda", "Drinks")]
    assert {r["member_id"] for r in out["dim_member"].collect()} == {35, 64}
    cash = {r["cashier_id"]: r["terminal_id"] for r in out["fact_cash_transactions"].collect()}
    assert cash == {1: 2, 2: None}
    assert sorted(r["terminal_id"] for r in out["fact_sessions"].collect()) == [1, 2]
    assert tuple(out["fact_stock_movements"].first()) == (1, T0, 1, "Out", 4, 2.0, 8.0, 2)
    for fact, source in zip(list(out)[4:], ("cash", "sessions", "stock", "members")):
        assert out[fact].count() == cleaned[source].count()


def test_terminal_columns_of_cash_and_stock_are_optional(spark, rows):
    cleaned = cleaned_tables(spark)
    cleaned["cash"], cleaned["stock"] = cleaned["cash"].drop("terminal"), cleaned["stock"].drop("terminal")
    assert star.dim_terminal(cleaned).count() == 2


def test_names_are_trimmed_and_blank_ones_left_out(spark, rows):
    df = spark.createDataFrame([(" b ",), ("b",), ("\u00a0",), ("",), (None,), ("a",), ("Z",), ("é",)], "n string")
    dim = with_ordinal(star.natural_keys([(df, "n")], "name"), "id", [F.col("name")])
    assert rows(dim) == [(1, "Z"), (2, "a"), (3, "b"), (4, "é")]


def test_items_keep_null_and_blank_names_in_order(spark, rows):
    df = spark.createDataFrame(
        [("b", "x"), ("a", "x"), (None, "x"), ("", "y"), ("a", None), ("a", "x"), (None, None)],
        "item_name string, category string")
    assert rows(star.dim_item({"stock": df})) == [
        (1, "a", "x"), (2, "b", "x"), (3, None, "x"), (4, "", "y"), (5, "a", None), (6, None, None)]


@pytest.mark.parametrize("parts", [1, 16])
def test_ordinals_do_not_depend_on_the_partitions(spark, parts):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k")).repartition(parts)
    out = with_ordinal(df, "n", [F.col("k")]).orderBy("k").collect()
    assert [r["n"] for r in out] == list(range(1, 20_001))


def test_last_of_equal_names_wins_and_rows_are_not_multiplied(spark, rows):
    dim = spark.createDataFrame([(1, "Soda", "A"), (2, "Chips", "B"), (3, "Soda", "C"), (4, None, "D")],
                                "item_id bigint, item_name string, category string")
    fact = spark.createDataFrame([("Soda",), ("Soda",), ("Chips",), (None,), ("?",)], "item_name string")
    found = resolve_fk(fact, "item_name", dim, "item_name", "item_id", null_safe=True)
    assert rows(found) == sorted([("Soda", 3), ("Soda", 3), ("Chips", 2), (None, 4), ("?", None)], key=repr)
    plain = resolve_fk(fact, "item_name", dim, "item_name", "item_id")
    assert (None, None) in rows(plain)


def test_untrimmed_name_misses_unless_asked_to_trim(spark, rows):
    dim = spark.createDataFrame([(1, "X")], "id bigint, name string")
    fact = spark.createDataFrame([(" X ",), ("X",)], "t string")
    assert rows(resolve_fk(fact, "t", dim, "name", "id")) == [(" X ", None), ("X", 1)]
    assert rows(resolve_fk(fact, "t", dim, "name", "id", strip_keys=True)) == [(" X ", 1), ("X", 1)]


@pytest.mark.parametrize("null_safe", [False, True])
def test_large_lookup_with_hot_keys_gives_the_same(spark, null_safe):
    """A third of the rows has one key, a tenth NULL and a tenth a hot key nobody knows."""
    rng = random.Random(7)
    keys = ["hot"] * 4000 + [None] * 1200 + ["unknown"] * 1200 + [f"k{rng.randrange(3000)}" for _ in range(5600)]
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    names = ["hot", None] + [f"k{i}" for i in range(0, 3000, 2)]
    lookup = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, v int")
    small = attach(fact, lookup, "k", "name", null_safe)
    large = attach(fact, lookup, "k", "name", null_safe, max_rows=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    want = sorted(small.collect())
    assert sorted(large.select(*small.columns).collect()) == want and len(want) == len(keys)
