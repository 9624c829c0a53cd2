"""Each parser against literal expectations; pandas is the yardstick where it has the operation."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reportstar.functions import numbers as n
from reportstar.functions import text as t
from reportstar.functions import times as m

THIN = "\u202f"


def check(spark, fn, cases):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, s string")
    got = {r["i"]: r["v"] for r in df.select("i", fn("s").alias("v")).collect()}
    wrong = [(c, got[i], want) for i, (c, want) in enumerate(cases) if got[i] != want]
    assert not wrong


def test_parse_amount(spark):
    check(spark, n.parse_amount, [
        ("27,50 TND", 27.5), (f"1{THIN}745,44 TND", 1745.44), ("0,00 TND", 0.0),
        (f"53{THIN}366,12 TND", 53366.12), ("8,00 TND", 8.0), ("-994,28 TND", -994.28),
        ("  12,5 TND\n", 12.5), ("27.5", 27.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("+3", 3.0),
        ("5TND", None), ("1,2,3", None), ("1 745,44 TND", None), ("1\u00a0745,44 TND", None),
        ("", None), (None, None), ("1.5d", None), ("1.5f", None), ("nan", None), ("inf", None),
        ("Infinity", None), ("1_000", None), ("0x1p3", None), ("--5", None), ("e5", None), (" TND", None),
    ])


def test_parse_amount_notebook_variant_keeps_thousands(spark):
    check(spark, lambda c: n.parse_amount(c, drop_thousands=False), [
        ("27,50 TND", 27.5), (f"1{THIN}745,44 TND", None), (None, None),
    ])


def test_parse_amount_lenient(spark):
    check(spark, lambda c: n.parse_amount_lenient(c, "Unit Price"), [
        ("27,50 TND", 27.5), (f" 1{THIN}745,44TND", 1745.44), ("1 745,44", 1745.44), ("unit price ", None),
        ("about -3,5", -3.5), ("1.2.3", None), ("5-", None), ("-", None), ("", None), (None, None),
        ("1e5 TND", 15.0), (".", None),
    ])


def test_to_int_and_to_id(spark):
    check(spark, n.to_int, [
        ("4", 4), ("4.7", 4), ("-4.7", -4), (" 4 ", 4), ("1e2", 100), ("x", None), ("", None), (None, None),
        ("99999999999", None),
    ])
    check(spark, n.to_id, [
        ("35", 35), ("35.0", 35), ("35.9", 35), ("9007199254740993", 9007199254740993), ("M-1", None),
        ("", None), (None, None), (" 7\u00a0", 7),
    ])


def test_parse_datetime(spark):
    check(spark, m.parse_datetime, [
        ("23.03.2026 03:23:54", dt.datetime(2026, 3, 23, 3, 23, 54)),
        ("01.09.2025 08:00:00", dt.datetime(2025, 9, 1, 8)),
        ("1.9.2025 8:0:5", dt.datetime(2025, 9, 1, 8, 0, 5)),
        (" 01.09.2025  08:00:00\u00a0", dt.datetime(2025, 9, 1, 8)),
        # The hour that a New York clock skips must stay as it is.
        ("08.03.2026 02:30:00", dt.datetime(2026, 3, 8, 2, 30)),
        ("29.02.2024 00:00:00", dt.datetime(2024, 2, 29)),
        ("29.02.2025 00:00:00", None), ("31.04.2025 00:00:00", None), ("01.09.25 08:00:00", None),
        ("01.09.2025 24:00:00", None), ("01.09.2025 08:60:00", None), ("01.09.2025", None),
        ("2025-09-01 08:00:00", None), ("01/09/2025 08:00:00", None), ("", None), (None, None),
    ])


def test_parse_datetime_untrimmed(spark):
    check(spark, lambda c: m.parse_datetime(c, trim=False), [
        (" 01.09.2025 08:00:00", None), ("01.09.2025 08:00:00", dt.datetime(2025, 9, 1, 8)),
    ])


def test_parse_duration(spark):
    check(spark, m.parse_duration, [
        ("1 h 29 min", 89), ("30 min", 30), ("2 h 00 min", 120), ("223 h 26 min", 13406), ("1h05min", 65),
        ("1 d 2 h 3 min", 123), ("1.5 h 30 min", 330), ("-5 min", 5), ("1\u00a0h\u202f5\u2003min", 65),
        ("5 min 7 min", 5), ("45 seconds", None), ("2 h", None), ("", None), (None, None),
        ("99999999999 min", None), ("99999999999 h 1 min", None),
    ])


def test_parse_duration_lenient(spark):
    check(spark, m.parse_duration_lenient, [
        ("1 h 29 min", 89), ("2 h", 120), ("45 seconds", 0), ("30 min", 30), ("", 0), (None, None),
    ])


def test_timedelta_agrees_with_pandas(spark):
    texts = ["1 h 29 min", "2 h", "45 seconds", "1.5 h 30 min", "1 day 2 hours", "90 m", "2h30min", "1 d 5 s"]
    check(spark, lambda c: F.round(m.parse_timedelta_minutes(c), 6), [
        (x, round(pd.to_timedelta(x).total_seconds() / 60, 6)) for x in texts
    ] + [("soon", None), ("", None), (None, None)])


def test_extract_terminal(spark):
    check(spark, t.extract_terminal, [
        ("(PC01)", "PC01"), ("(PS5 (1))", "PS5 (1)"), ("(A) (B)", "A) (B"), ("()", None), ("( X )", " X "),
        (" (X)\n", "X"), ("(a\nb)", None), ("(a\rb)", "a\rb"), ("Money deposited to member", None),
        ("x (X)", None), ("(X", None), ("", None), (None, None),
    ])


def test_has_marker_and_strip(spark):
    check(spark, t.has_marker, [("x", True), (" ", False), ("\u00a0\u202f\x1f", False), ("", False), (None, False)])
    check(spark, t.strip, [(f"{b}a{b}b{b}", f"a{b}b") for b in t.BLANKS] + [(None, None), ("  ", "")])
    assert sorted(t.BLANKS) == sorted(chr(c) for c in range(0x110000) if chr(c).isspace())


def test_classify_terminal(spark):
    computer = t.TERMINAL_RULES[2][2]
    check(spark, t.classify_terminal, [
        ("PS5 (1)", "PlayStation"), ("ps4", "PlayStation"), ("PS-VIP", "VIP"), (f"{computer}04", "Computer"),
        (f"{computer.lower()}-vip", "VIP"), (f"x{computer}", "Other"), ("Kiosk", "Other"),
    ])
    check(spark, lambda c: t.classify_terminal(c, [("Desk", "startswith", "D")], "None"), [
        ("d1", "Desk"), ("PS5", "None"),
    ])


def test_week_ending_agrees_with_pandas(spark):
    days = pd.date_range("2023-12-25", periods=30)
    labels = {}
    for label, group in pd.Series(range(30), index=days).resample("W"):
        labels.update({d.date(): label.date() for d in group.index})
    df = spark.createDataFrame([(d,) for d in labels], "d date")
    assert {r[0]: r[1] for r in df.select("d", m.week_ending("d")).collect()} == labels


@pytest.mark.parametrize("value, want", [(-2.5, 0.0), (0.0, 0.0), (3.5, 3.5)])
def test_clamp_zero(spark, value, want):
    assert spark.range(1).select(n.clamp_zero(F.lit(value))).first()[0] == want
