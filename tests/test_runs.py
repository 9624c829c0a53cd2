import datetime as dt

import pytest

from reportstar.plans.runs import ingest_all, run_etl, run_forecast
from reportstar.sources.layouts import LAYOUTS
from reportstar.sources.star import read_star
from test_clean import ROWS
from test_grid import grid_of, write_text

DAYS = [dt.datetime(2026, 1, 1, 9) + dt.timedelta(days=i) for i in range(20)]


def stamp(day):
    return day.strftime("%d.%m.%Y %H:%M:%S")


TABLES = ROWS | {
    "cash": [("anna", stamp(d), "Income", "Cash", "Order", "10,00 TND", "(PS5 (1))") for d in DAYS],
    "stock": [("ben", stamp(d), "Soda", "Drinks", "Out", "3", "2,50 TND", "7,50 TND", "") for d in DAYS],
}


def printed(name):
    places = list(LAYOUTS[name].columns)
    rows = [{c: v for c, v in zip(places, r) if v is not None} for r in TABLES[name]]
    return [{0: "Report"}, {}, {}, {}, {0: "Cashier"}] + rows + [{}, {54: "Page 1/1"}]


@pytest.mark.parametrize("input_fmt", ["parquet", "text"])
def test_reports_to_forecasts(spark, rows, tmp_path, input_fmt):
    source, out, forecasts = tmp_path / "in", tmp_path / "out", tmp_path / "fc"
    source.mkdir()
    for name in LAYOUTS:
        if input_fmt == "text":
            write_text(source / name, "a.txt", printed(name))
        else:
            grid_of(spark, printed(name), report=name).write.parquet(str(source / name))
    counts = run_etl(spark, str(source), str(out), "csv", input_fmt)
    assert dict(rows(counts)) == {
        "dim_cashier": 2, "dim_terminal": 3, "dim_item": 1, "dim_member": 1, "fact_cash_transactions": 20,
        "fact_sessions": 2, "fact_stock_movements": 20, "fact_member_stats": 1}
    star = read_star(spark, str(out))
    assert star["fact_cash_transactions"].filter("terminal_id is null").count() == 0
    tables = run_forecast(spark, str(out), str(forecasts), horizon=7)
    assert tables["revenue"].count() == 7 and tables["consumption"].count() == 7
    assert {p.name for p in forecasts.iterdir()} == {"forecast_consumption", "forecast_revenue", "forecast_skipped"}


def test_missing_column_fails(spark, tmp_path):
    for name in LAYOUTS:
        grid_of(spark, printed(name), width=31, report=name).write.parquet(str(tmp_path / name))
    with pytest.raises(KeyError):
        ingest_all(spark, str(tmp_path))
