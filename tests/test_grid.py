import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reportstar.operators.strip import account, check_width, strip_artifacts
from reportstar.plans.raw_views import printed, write_printed_text
from reportstar.sources.grid import GRID_SCHEMA, scan_grid, scan_reports, scan_text_grid, scan_with_header
from reportstar.sources.layouts import LAYOUTS
from reportstar.staging import run_folders, stage

CASH = LAYOUTS["cash"]
# The 18 rows of a small printed cash report.
PRINTED = [
    {0: "Cash Reports"}, {55: "23/03/2026"}, {}, {},
    {0: "Cashier", 4: "Date", 9: "Income/Expense", 11: "Payment Method", 21: "Transaction Type", 40: "Amount",
     50: "Comment"},
    {0: "anna", 4: "23.03.2026 03:23:54", 9: "Income", 11: "Cash", 21: "Order Incomes", 40: "27,50 TND",
     51: "(PS5 (1))"},
    {0: "ben", 4: "22.03.2026 17:41:47", 9: "Income", 11: "Cash", 21: "Member Transactions", 40: "30,00 TND",
     51: "Money deposited to member"},
    {}, {}, {54: "Page 1/3"}, {}, {0: "Cashier", 4: "Date"},
    {0: "anna", 4: "21.03.2026 03:38:54", 9: "Income", 11: "Cash", 21: "Computer Incomes", 40: "24,50 TND",
     51: "(PC09)"},
    {}, {8: "Computer Incomes"}, {8: "76245,51 TND"}, {}, {54: "Page 3/3"},
]


def grid_of(spark, printed, width=60, blank=None, name="a", report="cash"):
    rows = [(report, name, i, [r.get(c, blank) for c in range(width)]) for i, r in enumerate(printed)]
    return spark.createDataFrame(rows, GRID_SCHEMA)


@pytest.mark.parametrize("blank", [None, "", " \u00a0"])
def test_strip_keeps_the_three_data_rows(spark, blank):
    grid = grid_of(spark, PRINTED, blank=blank)
    kept = strip_artifacts(grid, CASH, keep_position=True).orderBy("row_idx").collect()
    assert [r["row_idx"] for r in kept] == [5, 6, 12]
    assert [r["cashier"] for r in kept] == ["anna", "ben", "anna"]
    assert kept[0]["amount"] == "27,50 TND" and kept[2]["date"] == "21.03.2026 03:38:54"
    assert strip_artifacts(grid, CASH).columns == [
        "cashier", "date", "income_expense", "payment_method", "transaction_type", "amount", "comment"]


def test_page_marker_in_any_cell_and_only_with_numbers(spark):
    data = dict(PRINTED[5])
    printed = PRINTED[:5] + [data | {33: "see Page 1/2 below"}, data | {33: "Page one"}, data | {33: "Page x/2"}]
    kept = strip_artifacts(grid_of(spark, printed), CASH, keep_position=True)
    assert sorted(r["row_idx"] for r in kept.collect()) == [6, 7]


def test_first_rows_are_dropped_per_file(spark):
    two = grid_of(spark, PRINTED, name="a").unionByName(grid_of(spark, PRINTED, name="b"))
    assert strip_artifacts(two, CASH).count() == 6


def test_header_text_is_no_artifact_in_the_member_report(spark):
    row = {0: "Cashier", 2: "35", 6: "u", 8: "f", 13: "l", 14: "5 min", 22: "1", 27: "2", 30: "3"}
    grid = grid_of(spark, [{}] * 5 + [row], width=34, report="members")
    assert strip_artifacts(grid, LAYOUTS["members"]).count() == 1


def test_account_adds_up(spark):
    row = account(grid_of(spark, PRINTED), CASH).first().asDict()
    assert row == {"report": "cash", "source_file": "a", "rows_in": 18, "preamble": 5, "page_marker": 2,
                   "repeated_header": 1, "keyless": 7, "kept": 3, "width": 60}


def test_narrow_grid_fails(spark):
    check_width(grid_of(spark, PRINTED), CASH)
    with pytest.raises(KeyError):
        check_width(grid_of(spark, PRINTED, width=51), CASH)
    title = spark.createDataFrame([("cash", "b", 0, ["Cash Reports"])], GRID_SCHEMA)
    body = grid_of(spark, PRINTED, name="b").filter("row_idx >= 5")
    check_width(title.unionByName(body), CASH)


def write_text(folder, name, printed, width=60):
    folder.mkdir(exist_ok=True)
    lines = ["\t".join(r.get(c, "") for c in range(width)) for r in printed]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf8")


def test_text_scan_numbers_lines_across_splits(spark, tmp_path):
    folder = tmp_path / "cash"
    printed = PRINTED[:5] + [PRINTED[5] | {4: str(i)} for i in range(500)]
    write_text(folder, "a.txt", printed)
    write_text(folder, "b.txt", PRINTED)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        grid = scan_text_grid(spark, str(folder), "cash")
        got = sorted(
            (r["source_file"][-5], r["row_idx"], r["d"])
            for r in grid.select("source_file", "row_idx", F.get("cells", F.lit(4)).alias("d")).collect()
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [("a", i, r.get(4, "")) for i, r in enumerate(printed)]
    want += [("b", i, r.get(4, "")) for i, r in enumerate(PRINTED)]
    assert got == want


def test_text_is_written_once(spark, tmp_path):
    write_text(tmp_path / "cash", "a.txt", PRINTED)
    with run_folders(spark) as made:
        grid = scan_text_grid(spark, str(tmp_path / "cash"), "cash")
        kept = stage(strip_artifacts(grid, CASH, keep_position=True), "kept")
        assert kept.count() == 3
        texts = [p for p in made if any(t == "string" and c not in ("__lookup_key", "source_file") for c, t in spark.read.parquet(p).dtypes)]
        assert texts == made[-1:] and len(made) == 2  # the counts of the splits, and the rows


def test_runs_remove_their_own_folders(spark, tmp_path):
    paths = {}

    def other():
        with run_folders(spark):
            paths["other"] = stage(spark.range(3), "other").inputFiles()[0]
            begun.set()
            done.wait(60)
            assert exists(paths["other"])

    exists = lambda p: Path(p.removeprefix("file:")).exists()
    begun, done = threading.Event(), threading.Event()
    with run_folders(spark):
        outer = stage(spark.range(2), "outer").inputFiles()[0]
        thread = threading.Thread(target=other)
        thread.start()
        begun.wait(60)
        with run_folders(spark):
            inner = stage(spark.range(1), "inner").inputFiles()[0]
        assert not exists(inner) and exists(outer) and exists(paths["other"])
    assert not exists(outer) and exists(paths["other"])
    done.set()
    thread.join()
    assert not exists(paths["other"])


def test_scan_reports_from_parquet(spark, tmp_path):
    for name in LAYOUTS:
        grid_of(spark, PRINTED, report=name).write.parquet(str(tmp_path / name))
    grids = scan_reports(spark, f"{tmp_path}/")
    assert set(grids) == {"cash", "sessions", "stock", "members"}
    assert grids["stock"].count() == 18
    assert scan_grid(spark, str(tmp_path / "cash")).filter("row_idx = 9").first()["cells"][54] == "Page 1/3"
    with pytest.raises(ValueError):
        scan_reports(spark, str(tmp_path), "xls")


def test_header_scan(spark):
    head = [{}] * 4 + [{0: " Cashier ", 2: "Date", 3: "Date", 4: "  "}]
    grid = grid_of(spark, head + [{0: "anna", 2: "x", 3: "y", 4: " "}], width=5)
    named = scan_with_header(grid)
    assert named.columns == [" Cashier ", "Unnamed: 1", "Date", "Date.1", "Unnamed: 4"]
    assert tuple(named.first()) == ("anna", None, "x", "y", None)
    other = grid_of(spark, [{}] * 4 + [{0: "Other"}], width=5, name="b")
    with pytest.raises(ValueError):
        scan_with_header(grid.unionByName(other))
    with pytest.raises(ValueError):
        scan_with_header(grid, header_row=99)


def test_a_text_line_is_split_once(spark, tmp_path):
    write_text(tmp_path / "cash", "a.txt", PRINTED)
    kept = strip_artifacts(scan_text_grid(spark, str(tmp_path / "cash"), "cash"), CASH)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("split(value") == 1
    assert kept.count() == 3


def test_printed_texts_are_a_file_per_partition_in_order(spark, tmp_path):
    raw = spark.range(0, 90, 1, 3).select(*[F.concat(F.lit(f"{c} "), "id").alias(c) for c in CASH.columns.values()])
    grid = printed(raw, "cash")
    write_printed_text(grid, str(tmp_path / "cash"))
    want = {}
    for r in grid.orderBy("row_idx").collect():
        want.setdefault(r["source_file"], []).append("\t".join(r["cells"]))
    got = [f.read_text().splitlines() for f in (tmp_path / "cash").glob("*.txt")]
    assert len(got) == 3 and sorted(got) == sorted(want.values())
