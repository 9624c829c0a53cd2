import json
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reportstar.operators import quality, star
from reportstar.sources import publish
from reportstar.sources.star import load_data, read_star, read_table, write_all, write_table
from test_star import cleaned_tables


def test_relationships(spark):
    found = quality.relationships(star.transform(cleaned_tables(spark)))
    assert [(r["fromTable"], r["fromColumn"], r["toTable"]) for r in found] == [
        ("fact_cash_transactions", "cashier_id", "dim_cashier"),
        ("fact_cash_transactions", "terminal_id", "dim_terminal"),
        ("fact_sessions", "cashier_id", "dim_cashier"),
        ("fact_sessions", "terminal_id", "dim_terminal"),
        ("fact_stock_movements", "cashier_id", "dim_cashier"),
        ("fact_stock_movements", "item_id", "dim_item"),
        ("fact_stock_movements", "terminal_id", "dim_terminal"),
        ("fact_member_stats", "member_id", "dim_member"),
    ]
    assert {(r["toColumn"] == r["fromColumn"], r["cardinality"], r["active"]) for r in found} == {
        (True, "manyToOne", True)}


def test_last_dimension_with_a_key_wins(spark):
    a, b = spark.createDataFrame([(1,)], "x_id bigint"), spark.createDataFrame([(1, 2)], "x_id bigint, y_id bigint")
    found = quality.relationships({"dim_a": a, "dim_b": b, "fact_f": b})
    assert [(r["fromColumn"], r["toTable"]) for r in found] == [("x_id", "dim_b")]


def test_integrity_counts_nulls_orphans_and_repeated_keys(spark, rows):
    dim = spark.createDataFrame([(1,), (2,), (2,), (None,)], "a_id bigint")
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,), (9,), (9,)], "a_id bigint")
    tables = {"dim_a": dim, "fact_f": fact}
    assert rows(quality.integrity(tables)) == [("fact_f", "a_id", "dim_a", 6, 1, 2)]
    assert rows(quality.key_report(tables)) == [("dim_a", 4, 2, 1, 1)]
    assert rows(quality.orphans(fact, "a_id", dim, "a_id")) == [(9, 2)]


def test_integrity_by_bitmaps_and_by_groups(spark, rows, monkeypatch):
    ids = [*range(1, 70_000, 2), 5, 5, 7, None, None, 131_072, -3, 0]
    used = [*range(0, 200, 3), *range(60_001, 60_101), 131_072, 131_073, -3, -4, None, 99_999, 99_999]
    tables = {
        "dim_a": spark.createDataFrame([(i,) for i in ids], "a_id bigint"),
        "dim_b": spark.createDataFrame([(i * 10**12,) for i in range(50)], "b_id bigint"),
        "dim_c": spark.createDataFrame([], "c_id bigint"),
        "fact_f": spark.createDataFrame([(i, (i or 0) * 10**12, None) for i in used], "a_id bigint, b_id bigint, c_id int"),
        "fact_g": spark.createDataFrame([(1,), (3,)], "a_id int"),
    }
    assert quality._dense(tables) == {"dim_a"}
    mixed = rows(quality.integrity(tables)), rows(quality.key_report(tables))
    lost = sum(i is not None and i not in set(ids) for i in used)
    assert ("fact_f", "a_id", "dim_a", len(used), 1, lost) in mixed[0] and ("fact_g", "a_id", "dim_a", 2, 0, 0) in mixed[0]
    assert ("dim_a", len(ids), len(set(ids) - {None}), 2, 2) in mixed[1]
    monkeypatch.setattr(quality, "_dense", lambda _: set())
    assert (rows(quality.integrity(tables)), rows(quality.key_report(tables))) == mixed


def test_whole_bitmaps_need_one_exchange_of_the_facts(spark):
    tables = {"dim_a": spark.range(1, 1000).toDF("a_id"), "fact_f": spark.range(1, 500).select(F.col("id").alias("a_id"))}
    report = quality.integrity(tables)
    assert [tuple(r) for r in report.collect()] == [("fact_f", "a_id", "dim_a", 499, 0, 0)]
    # The stored bitmaps are reduced once more; the ids themselves were grouped by range only.
    assert report._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 2


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_round_trip(spark, rows, tmp_path, fmt):
    tables = star.transform(cleaned_tables(spark))
    write_all(tables, f"{tmp_path}/", fmt)
    write_all(tables, str(tmp_path), fmt)  # replaces the first output
    assert {p.name for p in (tmp_path / "dims").iterdir()} == {n for n in tables if n.startswith("dim_")}
    assert {p.name for p in (tmp_path / "facts").iterdir()} == {n for n in tables if n.startswith("fact_")}
    for name, df in read_star(spark, str(tmp_path), fmt=fmt).items():
        assert df.dtypes == tables[name].dtypes
        assert rows(df) == rows(tables[name])
    text = (tmp_path / "relationships.json").read_text()
    assert json.loads(text)["relationships"] == quality.relationships(tables)
    assert set(load_data(spark, str(tmp_path), fmt)) == {"cash", "stock", "items"}


def test_a_run_that_fails_leaves_the_old_star_whole(spark, rows, tmp_path):
    old = star.transform(cleaned_tables(spark))
    counts = write_all(old, str(tmp_path), "parquet")
    assert counts == {name: df.count() for name, df in old.items()}
    broken = dict(old)
    for k, name in enumerate(old):
        key = old[name].columns[0]
        bad = F.when(F.rand() < 2, F.raise_error(F.lit("lost"))).cast("bigint") if k == 2 else F.lit(7).cast("bigint")
        broken[name] = old[name].withColumn(key, bad)
    with pytest.raises(Exception, match="lost"):
        write_all(broken, str(tmp_path), "parquet")
    assert {p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")} == {"dims", "facts", "relationships.json"}
    for name, df in read_star(spark, str(tmp_path), fmt="parquet").items():
        assert rows(df) == rows(old[name])


def test_a_run_cut_off_while_it_is_published_counts(spark, rows, tmp_path, monkeypatch):
    one = {"dim_cashier": spark.sql("select 1L as cashier_id, 'anna' as cashier_name")}
    two = {"dim_cashier": spark.sql("select 2L as cashier_id, 'ben' as cashier_name")}
    write_all(one, str(tmp_path))
    moves = publish.Files.move
    monkeypatch.setattr(publish.Files, "move", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        write_all(two, str(tmp_path))
    assert rows(read_star(spark, str(tmp_path), ["dim_cashier"])["dim_cashier"]) == [(2, "ben")]
    monkeypatch.setattr(publish.Files, "move", moves)
    publish.finish(spark, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")} == {"dims", "relationships.json"}
    assert rows(read_star(spark, str(tmp_path), ["dim_cashier"])["dim_cashier"]) == [(2, "ben")]


def test_csv_layout(spark, tmp_path):
    df = spark.sql("select 1 as a, cast(null as bigint) as b, true as c, timestamp_ntz'2026-03-23 03:23:54' as d, '' as e")
    write_table(df, f"{tmp_path}/t")
    text = "".join(p.read_text() for p in Path(tmp_path, "t").glob("part-*"))
    assert text == "a,b,c,d,e\n1,,true,2026-03-23 03:23:54,\"\"\n"


def test_unknown_format_writes_nothing(spark, tmp_path):
    out = tmp_path / "out"
    with pytest.raises(ValueError, match="Unknown fmt 'xml'"):
        write_all({"dim_a": spark.range(1)}, str(out), "xml")
    assert not out.exists()


def test_missing_output(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Run the pipeline first"):
        load_data(spark, f"{tmp_path}/nothing")
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{tmp_path}/nothing", "a int", "parquet")


def test_csv_is_read_by_others(spark, tmp_path):
    names = [" Cola ", 'say "hi"', "two\nlines", "back\\slash\\", "a,b", "", "x\r\ny"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "item_id bigint, item_name string")
    write_table(df.coalesce(1), f"{tmp_path}/t")
    found = pd.read_csv(next(Path(tmp_path, "t").glob("part-*.csv")), keep_default_na=False, lineterminator="\n")
    assert [n.replace("\r\n", "\n") for n in found["item_name"]] == [n.replace("\r\n", "\n") for n in names]
    back = read_table(spark, f"{tmp_path}/t", "item_id bigint, item_name string")
    assert [r.item_name for r in back.orderBy("item_id").collect()] == names
