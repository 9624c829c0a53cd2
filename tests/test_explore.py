import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reportstar.operators import columns, explore, rows as row_rules
from reportstar.operators.quantiles import exact_quantiles, select_ranks, stage_numbers


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(3)
    pdf = pd.DataFrame({
        "k": [rng.choice("abc") for _ in range(3000)],
        "x": [rng.choice([5.0, round(rng.gauss(50, 20), 2)]) for _ in range(3000)],
        "y": [float(rng.randrange(1000)) for _ in range(3000)],
    })
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_summary_agrees_with_pandas(sample):
    pdf, df = sample
    want = pdf.describe()
    for row in explore.summary(df).collect():
        got = [row[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
        assert got == pytest.approx(want[row["column"]].tolist(), rel=1e-12)


@pytest.mark.parametrize("size", [1, 2, 5])
def test_quantiles_of_few_values(spark, size):
    values = [float(v * v) for v in range(size)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r["share"]: r["value"] for r in exact_quantiles(df, ["v"], shares).collect()}
    assert [got[s] for s in shares] == pytest.approx(np.quantile(values, shares).tolist())


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(explore.profile(df)) == [("a", "int", 2), ("b", "string", 1)]


@pytest.mark.parametrize("bins", [1, 15, 20])
def test_histogram_agrees_with_numpy(sample, bins):
    pdf, df = sample
    counts, edges = np.histogram(pdf["y"], bins)
    got = explore.histogram(df, "y", bins).orderBy("bin").collect()
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["low"] for r in got] + [got[-1]["high"]] == pytest.approx(edges.tolist())


def test_histogram_of_equal_values(spark):
    df = spark.createDataFrame([(4.0,), (4.0,), (None,)], "v double")
    counts, edges = np.histogram([4.0, 4.0], 15)
    got = explore.histogram(df, "v", 15).orderBy("bin").collect()
    assert [r["n"] for r in got] == counts.tolist()
    assert got[0]["low"] == edges[0] and math.isclose(got[-1]["high"], edges[-1])


def test_groups(spark, rows):
    df = spark.createDataFrame(
        [("a", "x", 0.1), ("a", "x", 0.2), ("b", None, 5.0), (None, "x", 7.0), ("b", "y", None)],
        "k string, l string, v double")
    assert rows(explore.count_by(df, ["k", "l"])) == [("a", "x", 2), ("b", "y", 1)]
    assert rows(explore.total_by(df, ["k"], "v")) == [("a", 0.3), ("b", 5.0)]
    assert rows(explore.total_by(df, ["k", "l"], "v")) == [("a", "x", 0.3), ("b", "y", 0.0)]
    assert rows(explore.mean_by(df, ["l"], "v")) == [("x", pytest.approx(7.3 / 3)), ("y", None)]
    assert [tuple(r) for r in explore.frequency(df, "l").collect()] == [("x", 3), ("y", 1)]
    assert rows(explore.share_of_total(df, "k", "v")) == [("a", 0.3, 5.7), ("b", 5.0, 94.3)]
    assert [r["k"] for r in explore.top(df.dropna(), "v", "k", 2).collect()] == ["a", "a"]
    assert [r["v"] for r in explore.preview(df, ["v"], 2).collect()] == [None, 0.1]
    assert rows(explore.table_counts({"t": df, "u": df.limit(2)})) == [("t", 5), ("u", 2)]


def test_daily_total(spark, rows):
    df = spark.sql(
        "select * from values (timestamp_ntz'2026-03-08 23:59:59', 1.1D), (timestamp_ntz'2026-03-08 00:00:00', 2.2D) t(d, v)")
    assert [(str(r[0]), r[1]) for r in explore.daily_total(df, "d", "v").collect()] == [("2026-03-08", 3.3)]


def test_relation_agrees_with_numpy(sample):
    pdf, df = sample
    row = explore.relation(df, "x", "y").first()
    slope, intercept = np.polyfit(pdf["x"], pdf["y"], 1)
    assert row["corr"] == pytest.approx(np.corrcoef(pdf["x"], pdf["y"])[0, 1])
    assert (row["slope"], row["intercept"]) == pytest.approx((slope, intercept))


def test_row_rules(spark):
    df = spark.createDataFrame(
        [(None, None, None), ("Cashier", "1", "1"), ("anna 23/03/2026", "1", "1"), (None, "1", "1"),
         ("ben", "UNIT price", "Total Amount"), ("ben", "unit price", "5"), ("anna", "2", None)],
        "c string, u string, t string")
    left = row_rules.drop_empty_rows(df)
    assert left.count() == 6
    left = row_rules.drop_header_rows(left, "c", "Cashier")
    assert left.count() == 5 and left.filter("c is null").count() == 1
    left = row_rules.drop_money_header_rows(left, {"u": "Unit Price", "t": "Total Amount"})
    assert left.count() == 4
    left = row_rules.drop_dated_names(left, "c")
    assert left.count() == 3
    assert row_rules.drop_incomplete_rows(left, ["c"]).count() == 2
    assert row_rules.keep_positive(spark.createDataFrame([(1,), (0,), (-1,), (None,)], "q int"), "q").count() == 1


def test_column_rules(spark):
    df = spark.createDataFrame([(1, None, "x", 2), (3, None, None, 4)], "` a ` int, `b` string, `Unnamed: 2` string, `d.e` int")
    df = columns.strip_column_names(df)
    assert columns.drop_empty_columns(df).columns == ["a", "Unnamed: 2", "d.e"]
    assert columns.drop_matching_columns(df).columns == ["a", "b", "d.e"]
    kept = columns.keep_existing(df, ["d.e", "zzz", "a"])
    assert kept.columns == ["d.e", "a"]
    raw = columns.keep_raw(kept, ["d.e", "zzz"]).withColumn("d.e", F.lit(0))
    assert tuple(raw.first()) == (0, 1, 2)


def test_quantiles_of_every_size(spark):
    values = [0.0, -0.0, 5e-324, 1e-300, -1e300, 1.7e308, -1.7e308, 1.0, 1.0 + 2**-52, -1.0, 2.0**-1022, 3.5, 3.5] * 3 + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "`a.b` double")
    known = sorted(v for v in values if v is not None and v == v)
    shares = [i / (len(known) - 1) for i in range(len(known))]
    got = {r["share"]: r["value"] for r in exact_quantiles(df, ["a.b"], shares).collect()}
    assert [got[s] for s in shares] == [pytest.approx(v, rel=1e-9) for v in known]


def test_no_task_of_a_quantile_holds_a_range(spark):
    """A million distinct values of one binary exponent: every task reads counts of ranges only."""
    numbers = stage_numbers(spark.range(0, 1_000_000, numPartitions=8).select((1 + F.col("id") * 1e-6).alias("v")), ["v"])
    sc = spark.sparkContext
    sc.setJobGroup("quantiles", "")
    found = select_ranks(numbers, {"c0": [0.25, 0.5, 0.999]})
    jobs = sc.statusTracker().getJobIdsForGroup("quantiles")
    sc.setJobGroup("other", "")
    assert found["c0", 0.5] == 1 + 499_999.5e-6 and found["c0", 0.25] == 1 + 249_999.75e-6
    store, read = sc._jsc.sc().statusStore(), []
    for job in jobs:
        for s in sc.statusTracker().getJobInfo(job).stageIds:
            tasks = store.taskList(s, 0, 1000)
            for i in range(tasks.size()):
                metrics = tasks.apply(i).taskMetrics()
                if metrics.isDefined():
                    read.append(metrics.get().shuffleReadMetrics().recordsRead())
    assert read and max(read) <= 8 * 3 * 4096
