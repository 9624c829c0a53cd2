"""Cases outside the benchmark tables: hard column names, precision, large lookups, strict runs."""

import json
from collections import Counter
from pathlib import Path

import pytest

from reportstar.functions.numbers import parse_amount, to_number
from reportstar.functions.times import parse_datetime
from reportstar.operators import explore, rows as row_rules, star
from reportstar.operators.clean import dropped_ids
from reportstar.plans.runs import run_etl
from reportstar.sources.grid import scan_with_header
from reportstar.sources.layouts import LAYOUTS
from reportstar.sources.star import write_all
from reportstar.staging import run_folders, stage
from test_clean import raw_tables
from test_grid import grid_of
from test_runs import printed
from test_star import cleaned_tables


def test_amounts_beyond_cents(spark):
    df = spark.createDataFrame([("a", 0.005), ("a", 0.005), ("a", 0.005), ("b", 9e14), ("b", 0.25), (None, 1.0)], "k string, v double")
    assert {tuple(r) for r in explore.total_by(df, ["k"], "v").collect()} == {("a", 0.015), ("b", 900000000000000.25)}
    texts = spark.createDataFrame([("1e400",), ("-1e400",), ("1e16",), ("999999999999999",), ("7,125 TND",)], "t string")
    assert [tuple(r) for r in texts.select(to_number("t"), parse_amount("t")).collect()] == [
        (None, None), (None, None), (1e16, None), (999999999999999.0, 999999999999999.0), (None, 7.125)]


def test_a_final_line_break_is_no_timestamp(spark):
    df = spark.createDataFrame([("23.03.2026 03:23:54",), ("23.03.2026 03:23:54\n",)], "t string")
    found = [r[0] for r in df.select(parse_datetime("t", trim=False)).collect()]
    assert found[0] is not None and found[1] is None


def test_any_column_name(spark, rows):
    header = ["A", "A", "A.1", "Ord.& Trans.", "a`b", None]
    grid = grid_of(spark, [{}, {}, {}, {}, {i: h for i, h in enumerate(header) if h}, {0: "x", 3: "5,00 TND", 4: "q"}, {0: "x", 3: "Ord.& Trans."}, {}], width=6)
    named = scan_with_header(grid)
    assert named.columns == ["A", "A.2", "A.1", "Ord.& Trans.", "a`b", "Unnamed: 5"]
    kept = row_rules.drop_header_rows(row_rules.drop_empty_rows(named), "Ord.& Trans.", "Ord.& Trans.")
    kept = row_rules.drop_incomplete_rows(kept, ["Ord.& Trans.", "a`b"])
    assert kept.count() == 1
    parsed = kept.select("A", parse_amount("Ord.& Trans.").alias("Ord.& Trans."))
    assert rows(explore.profile(parsed)) == [("A", "string", 1), ("Ord.& Trans.", "double", 1)]
    assert rows(explore.total_by(parsed, ["A"], "Ord.& Trans.")) == [("x", 5.0)]
    assert rows(explore.total_by(parsed, ["Ord.& Trans."], "Ord.& Trans.")) == [(5.0, 5.0)]
    assert explore.histogram(parsed, "Ord.& Trans.", 3).count() == 3
    assert [r["column"] for r in explore.summary(parsed).collect()] == ["Ord.& Trans."]


def test_summary_of_nothing(spark, rows):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b int")
    assert rows(explore.summary(df)) == [("a", 2, 2.0, 2**0.5, 1.0, 1.5, 2.0, 2.5, 3.0), ("b", 0, *[None] * 7)]
    assert rows(explore.summary(df.limit(0))) == [("a", 0, *[None] * 7), ("b", 0, *[None] * 7)]
    assert explore.summary(df.select()).collect() == []


def test_a_fact_is_read_once_whatever_the_size_of_its_lookups(spark, rows, tmp_path):
    cleaned = cleaned_tables(spark)
    dims = star.build_dims(cleaned)
    want = rows(star.fact_stock_movements(cleaned, dims))
    cleaned["stock"].write.parquet(f"{tmp_path}/stock_source")
    cleaned["stock"] = spark.read.parquet(f"{tmp_path}/stock_source")
    large = star.fact_stock_movements(cleaned, dims, max_rows=0)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("__text") and rows(large) == want
    # The columns of the fact are shuffled once, to meet the ids of all its keys.
    physical = large._jdf.queryExecution().executedPlan().toString().split("\n")
    carried = [k for k, line in enumerate(physical) if "Exchange" in line and "unit_price_tnd" in "".join(physical[k + 1 : k + 4])]
    wide = large._jdf.queryExecution().optimizedPlan().toString()
    assert len(carried) <= 1 and wide.count("unit_price_tnd") <= 4


def test_strict_run_stops_at_a_bad_cell(spark, tmp_path):
    for name in LAYOUTS:
        lines = printed(name)
        if name == "stock":
            lines[5][25] = "many"
        grid_of(spark, lines, report=name).write.parquet(f"{tmp_path}/in/{name}")
    with pytest.raises(ValueError, match="Cannot parse stock.quantity: 'many'"):
        run_etl(spark, f"{tmp_path}/in", f"{tmp_path}/out", "parquet")
    assert not (tmp_path / "out").exists()
    run_etl(spark, f"{tmp_path}/in", f"{tmp_path}/out", "parquet", strict=False)
    text = (tmp_path / "out" / "relationships.json").read_text()
    assert len(json.loads(text)["relationships"]) == 8


def test_dropped_ids_are_listed(spark):
    raw = raw_tables(spark)["members"]
    more = raw.unionByName(spark.createDataFrame([("Total", *[None] * 7), (None, *[None] * 7)], raw.schema))
    listed = lambda df: Counter((r["column"], r["raw_value"]) for r in dropped_ids("members", df).collect())
    assert listed(more) - listed(raw) == Counter([("member_id", "Total"), ("member_id", None)])


def test_run_folders_are_removed(spark, tmp_path):
    with run_folders(spark):
        kept = stage(spark.range(3), "x")
        path = kept.inputFiles()[0].removeprefix("file://")
        assert kept.count() == 3
    assert not Path(path).exists()
    write_all({"dim_a": spark.range(1).toDF("a_id")}, f"{tmp_path}/o", "parquet")
    assert json.loads((tmp_path / "o" / "relationships.json").read_text()) == {"relationships": []}
