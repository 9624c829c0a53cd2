import datetime as dt

import pytest
from pyspark.sql import functions as F

from reportstar.operators.clean import CLEANED_COLUMNS, clean_all, clean_table, parse_table, rejects, rejects_of, stage_all
from reportstar.sources.layouts import LAYOUTS

CASH = [
    ("anna\u00a0", "23.03.2026 03:23:54", "Income", "Cash", "Order Incomes", "27,50 TND", "(PS5 (1))"),
    ("ben", "22.03.2026 17:41:47", "Income", "Cash", "Member Transactions", "30,00 TND", "Money deposited"),
]
SESSIONS = [
    ("anna", " PC04", "Member", None, None, "1 h 29 min", "0,00 TND", "11,87 TND", "0,00 TND", "11,87 TND"),
    ("anna", "PS5 (2)", "Free", "x", "30 min", "1 h 45 min", "0,00 TND", "0,00 TND", "0,00 TND", "0,00 TND"),
]
STOCK = [("anna", "23.03.2026 03:23:54", "Soda", "Drinks", "Out", "4", "2,00 TND", "8,00 TND", "(PS5 (1))")]
MEMBERS = [
    ("35", "u1", "F", "L", "223 h 26 min", "1\u202f745,44 TND", "0,00 TND", "1\u202f745,44 TND"),
    ("Total", None, None, None, "broken", None, None, None),
]
ROWS = {"cash": CASH, "sessions": SESSIONS, "stock": STOCK, "members": MEMBERS}


def raw_tables(spark, **changes):
    made = {}
    for name, rows in (ROWS | changes).items():
        schema = ", ".join(f"{c} string" for c in LAYOUTS[name].columns.values())
        made[name] = spark.createDataFrame(rows, schema)
    return made


def test_columns_and_types(spark):
    cleaned = clean_all(raw_tables(spark), strict=True)
    for name, df in cleaned.items():
        assert tuple(df.columns) == CLEANED_COLUMNS[name]
    types = {n: dict(df.dtypes) for n, df in cleaned.items()}
    assert types["cash"]["date"] == "timestamp_ntz" and types["cash"]["amount_tnd"] == "double"
    assert types["sessions"]["is_free_time"] == "boolean" and types["sessions"]["duration_minutes"] == "int"
    assert types["stock"]["quantity"] == "int" and types["members"]["member_id"] == "bigint"


def test_values(spark):
    cleaned = clean_all(raw_tables(spark))
    assert tuple(cleaned["cash"].first()) == (
        "anna", dt.datetime(2026, 3, 23, 3, 23, 54), "Income", "Cash", "Order Incomes", "(PS5 (1))", 27.5, "PS5 (1)")
    assert cleaned["cash"].collect()[1]["terminal"] is None
    first, second = cleaned["sessions"].collect()
    assert (first["terminal"], first["duration_minutes"], first["is_free_time"]) == ("PC04", 89, False)
    assert first["paused_duration_minutes"] is None and first["usage_tnd"] == 11.87
    assert (second["duration_minutes"], second["is_free_time"], second["paused_duration_minutes"]) == (105, True, 30)
    assert tuple(cleaned["stock"].first())[5:] == (4, "(PS5 (1))", 2.0, 8.0, "PS5 (1)")
    members = cleaned["members"].collect()
    assert [tuple(m) for m in members] == [(35, "u1", "F", "L", 13406, 1745.44, 0.0, 1745.44)]


BAD_CASH = [
    ("a", "31.02.2026 00:00:00", "Income", "Cash", "x", "1,2,3 TND", None),
    ("b", " 23.03.2026 03:23:54", "Income", "Cash", "x", "", None),
    ("c", "23.03.2026 03:23:54", "Income", "Cash", "x", None, None),
]


def test_rejects_list_every_bad_cell_and_keep_the_row(spark, rows):
    raw = raw_tables(spark, cash=BAD_CASH)["cash"]
    assert rows(rejects("cash", raw).select("table", "column", "raw_value")) == [
        ("cash", "amount", ""), ("cash", "amount", "1,2,3 TND"),
        ("cash", "date", " 23.03.2026 03:23:54"), ("cash", "date", "31.02.2026 00:00:00")]
    assert clean_table("cash", raw).count() == 3


def test_missing_required_cells_are_bad(spark, rows):
    stock = [STOCK[0][:5] + (None,) + STOCK[0][6:]]
    sessions = [SESSIONS[1][:4] + ("soon", None) + SESSIONS[1][6:]]
    raw = raw_tables(spark, stock=stock, sessions=sessions)
    assert rows(rejects("stock", raw["stock"]).select("column", "raw_value")) == [("quantity", None)]
    assert rows(rejects("sessions", raw["sessions"]).select("column", "raw_value")) == [
        ("duration", None), ("paused", "soon")]


def test_rejects_name_the_place(spark):
    raw = raw_tables(spark, cash=BAD_CASH[:1])["cash"]
    raw = raw.withColumns({"source_file": F.lit("f"), "row_idx": F.lit(7)})
    assert {(r["source_file"], r["row_idx"]) for r in rejects("cash", raw).collect()} == {("f", 7)}
    assert clean_table("cash", raw).columns[-2:] == ["source_file", "row_idx"]


def test_strict_raises(spark):
    with pytest.raises(ValueError, match="Cannot parse cash"):
        clean_all(raw_tables(spark, cash=BAD_CASH), strict=True)
    with pytest.raises(ValueError, match="45 seconds"):
        bad = [SESSIONS[0][:5] + ("45 seconds",) + SESSIONS[0][6:]]
        clean_all(raw_tables(spark, sessions=bad), strict=True)


def test_strict_cleaning_reads_its_input_once(spark, rows, tmp_path):
    good = [(n, "23.03.2026 03:23:54", "Income", "Cash", "x", f"{n},50 TND", None) for n in "1234567"]
    raw_tables(spark, cash=good)["cash"].write.parquet(f"{tmp_path}/cash")
    raw = {"cash": spark.read.parquet(f"{tmp_path}/cash")}
    sc = spark.sparkContext
    sc.setJobGroup("strict", "")
    cleaned = clean_all(raw, strict=True)
    jobs = sc.statusTracker().getJobIdsForGroup("strict")
    sc.setJobGroup("other", "")
    store, read = sc._jsc.sc().statusStore(), 0
    for stage_id in {s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds}:
        tasks = store.taskList(stage_id, 0, 1000)
        for i in range(tasks.size()):
            metrics = tasks.apply(i).taskMetrics()
            read += metrics.get().inputMetrics().recordsRead() if metrics.isDefined() else 0
    assert read == len(good)
    assert not [f for f in cleaned["cash"].inputFiles() if str(tmp_path / "cash") in f]
    assert rows(cleaned["cash"]) == rows(clean_table("cash", raw["cash"]))


def test_one_parse_gives_rows_and_rejects(spark, rows):
    parsed = stage_all(raw_tables(spark, cash=BAD_CASH))["cash"]
    raw = raw_tables(spark, cash=BAD_CASH)["cash"]
    assert rows(rejects_of("cash", parsed)) == rows(rejects("cash", raw)) and parsed.count() == 3
    plan = parse_table("cash", raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("TND,") == 2  # one parse: plain numbers, and all others
