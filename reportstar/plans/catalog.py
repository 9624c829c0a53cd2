"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportstar.functions.numbers import (
    money_sum,
    parse_amount,
    parse_amount_lenient,
    to_id,
    to_int,
    to_number,
)
from reportstar.functions.text import classify_terminal, extract_terminal, has_marker, strip
from reportstar.functions.times import (
    day,
    parse_datetime,
    parse_duration,
    parse_duration_lenient,
    parse_timedelta_minutes,
    week_ending,
)
from reportstar.operators import columns, explore, quality, rows, series, star
from reportstar.operators import forecast as fc
from reportstar.operators.clean import clean_table, dropped_ids, rejects
from reportstar.operators.lookup import attach, resolve_fk
from reportstar.operators.ordinals import with_ordinal
from reportstar.operators.strip import account, strip_artifacts
from reportstar.plans import raw_views as v
from reportstar.plans.runs import run_etl, run_forecast
from reportstar.sources.grid import scan_text_grid, scan_with_header
from reportstar.sources.layouts import LAYOUTS
from reportstar.sources.star import read_star, write_all, write_relationships
from reportstar.staging import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _pick(k: Column, *cases: Column | str | None) -> Column:
    """Case number ``k``; cases of one type."""
    return F.get(F.array(*[c if isinstance(c, Column) else F.lit(c) for c in cases]), k.cast("int"))


def _cleaned(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    make = {"cash": v.raw_cash, "sessions": v.raw_sessions, "stock": v.raw_stock, "members": v.raw_members}
    return {n: clean_table(n, make[n](spark, sf_dir)) for n in names or make}


def _one(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _cleaned(spark, sf_dir, name)[name]


def _cash_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the cash fact that a series needs."""
    return _one(spark, sf_dir, "cash").withColumnRenamed("date", "transaction_datetime")


def _stock_and_items(
    spark: SparkSession, sf_dir: str, priced: bool = False
) -> tuple[DataFrame, DataFrame]:
    """What series need of the stock fact, and the items.

    With prices the fact is read for two results, so its texts are parsed once and staged.
    """
    wanted = ["date", "item_name", "category", "in_out", "quantity"] + ["unit_price_tnd"] * priced
    stock = _one(spark, sf_dir, "stock").select(*wanted)
    if priced:
        stock = stage(stock, "stock")
    items = star.dim_item({"stock": stock})
    fact = resolve_fk(stock, "item_name", items, "item_name", "item_id", null_safe=True)
    return fact.drop("item_name", "category").withColumnRenamed("date", "movement_datetime"), items


# ---- grids -------------------------------------------------------------------------


@query
def q_grid_strip(spark, sf_dir):
    return strip_artifacts(v.raw_grid(spark, sf_dir), LAYOUTS["cash"], keep_position=True)


@query
def q_grid_accounting(spark, sf_dir):
    return account(v.raw_grid(spark, sf_dir), LAYOUTS["cash"])


@query
def q_scan_text_grid(spark, sf_dir):
    path = new_path(spark, "printed")
    v.write_text_grid(v.raw_grid(spark, sf_dir, v.ORDERS_PER_TEXT_FILE), path)
    grid = scan_text_grid(spark, path, "cash").withColumn(
        "source_file", F.regexp_extract("source_file", "source_file=(cash_[0-9]+)", 1)
    )
    return strip_artifacts(grid, LAYOUTS["cash"], keep_position=True).select(
        "source_file", "row_idx", "date", "amount", "comment"
    )


@query
def q_header_scan(spark, sf_dir):
    named = columns.strip_column_names(scan_with_header(v.raw_grid(spark, sf_dir)))
    named = columns.drop_matching_columns(named, "^Unnamed")
    named = rows.drop_empty_rows(named).withColumn("Cashier", strip("Cashier"))
    return columns.keep_existing(
        rows.drop_header_rows(named, "Cashier", "Cashier"), ["Cashier", "Date", "Amount", "Missing"]
    )


@query
def q_preview(spark, sf_dir):
    kept = strip_artifacts(v.raw_grid(spark, sf_dir), LAYOUTS["cash"], keep_position=True)
    return explore.preview(kept, ["source_file", "row_idx"], 20).select(
        "source_file", "row_idx", "date", "amount"
    )


# ---- profiles ----------------------------------------------------------------------


@query
def q_profile(spark, sf_dir):
    return explore.profile(_one(spark, sf_dir, "cash"))


@query
def q_summary(spark, sf_dir):
    stock = _one(spark, sf_dir, "stock").withColumn("empty", F.lit(None).cast("double"))
    s = explore.summary(stock)
    return s.select(
        "column", F.col("count").alias("n"), *[F.round(c, 4).alias(c) for c in s.columns[2:]]
    )


# ---- scalar functions --------------------------------------------------------------


@query
def q_parse_amount(spark, sf_dir):
    return v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        parse_amount(v.money_text(v.cents("l_extendedprice"))).alias("amount"),
        parse_amount(v.money_text(-v.cents("l_extendedprice"))).alias("negative"),
    )


@query
def q_amount_lenient(spark, sf_dir):
    value = v.cents("l_extendedprice")
    text = v.money_text(value)
    shown = _pick(
        F.col("l_orderkey") % 4,
        F.concat(F.lit("  "), text),
        "unit PRICE ",
        F.concat(F.lit("TND "), text),
        F.concat(F.lit("about "), text),
    )
    return v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        parse_amount_lenient(shown, "Unit Price").alias("lenient"),
        parse_amount(text, drop_thousands=False).alias("notebook"),
    )


@query
def q_amount_edges(spark, sf_dir):
    value = v.cents("l_extendedprice")
    text = v.money_text(value)
    whole = value.cast("string")
    shown = _pick(
        F.col("l_orderkey") % 8,
        F.concat(F.floor(value / 100), F.lit("."), F.lpad((value % 100).cast("string"), 2, "0")),
        F.concat(whole, F.lit(",5,00 TND")),
        F.concat(whole, F.lit("TND")),
        F.replace(text, F.lit("\u202f"), F.lit("\u00a0")),
        "",
        F.concat(whole, F.lit("e-2")),
        F.concat(whole, F.lit("d")),
        F.concat(F.lit("\u00a0-"), text, F.lit("\n")),
    )
    return v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", parse_amount(shown).alias("amount")
    )


@query
def q_parse_datetime(spark, sf_dir):
    return v.table(spark, sf_dir, "events").select(
        "event_id", parse_datetime(v.stamp_text("ts")).alias("ts")
    )


@query
def q_datetime_edges(spark, sf_dir):
    stamp = F.col("stamp")
    shown = _pick(
        F.col("event_id") % 7,
        stamp,
        F.regexp_replace(stamp, r"\b0([0-9])", "$1"),
        F.concat(F.substring(stamp, 1, 6), F.substring(stamp, 9, 20)),
        F.concat(F.lit("31.02."), F.substring(stamp, 7, 20)),
        F.concat(F.lit("\u00a0"), F.replace(stamp, F.lit(" "), F.lit("   ")), F.lit(" ")),
        F.substring(F.col("ts").cast("string"), 1, 19),
        None,
    )
    return v.table(spark, sf_dir, "events").withColumn("stamp", v.stamp_text("ts")).select(
        "event_id",
        parse_datetime(shown).alias("trimmed"),
        parse_datetime(shown, trim=False).alias("as_is"),
    )


@query
def q_parse_duration(spark, sf_dir):
    return v.table(spark, sf_dir, "events").select(
        "event_id", parse_duration(v.duration_text(F.col("event_id") % 200)).alias("minutes")
    )


@query
def q_duration_lenient(spark, sf_dir):
    e = F.col("event_id")
    shown = _pick(
        e % 4,
        F.concat(e % 50, F.lit(" h "), e % 60, F.lit(" min")),
        F.concat(e % 50, F.lit(" h")),
        F.concat(e % 60, F.lit(" seconds")),
        None,
    )
    return v.table(spark, sf_dir, "events").select(
        "event_id",
        parse_duration(shown).alias("strict"),
        parse_duration_lenient(shown).alias("lenient"),
        F.round(parse_timedelta_minutes(shown), 6).alias("timedelta"),
    )


@query
def q_duration_edges(spark, sf_dir):
    e = F.col("event_id")
    shown = _pick(
        e % 6,
        F.concat(F.lit("1 d "), e % 24, F.lit(" h 3 min")),
        F.concat(F.lit("1."), e % 10, F.lit(" h 30 min")),
        F.concat(F.lit("-"), e % 60, F.lit(" min")),
        "no time",
        F.concat(F.lit("99999999999"), e, F.lit(" min")),
        F.concat(e % 24, F.lit("h\u00a005min")),
    )
    return v.table(spark, sf_dir, "events").select("event_id", parse_duration(shown).alias("minutes"))


@query
def q_extract_terminal(spark, sf_dir):
    return v.raw_cash(spark, sf_dir, "event_id").select(
        "event_id", extract_terminal("comment").alias("terminal")
    )


@query
def q_terminal_edges(spark, sf_dir):
    e = F.col("event_id").cast("string")
    shown = _pick(
        F.col("event_id") % 6,
        F.concat(F.lit("(A"), e, F.lit(") (B)")),
        "()",
        F.concat(F.lit("\u2003( "), e, F.lit(" )\n")),
        F.concat(F.lit("("), e, F.lit("\nx)")),
        F.concat(e, F.lit(" (x)")),
        None,
    )
    return v.table(spark, sf_dir, "events").select("event_id", extract_terminal(shown).alias("terminal"))


@query
def q_markers(spark, sf_dir):
    e = F.col("event_id")
    free = _pick(e % 4, "x", " ", "\u202f\u00a0", None)
    paused = _pick(e % 3, F.concat(e % 90, F.lit(" min")), "", None)
    return v.table(spark, sf_dir, "events").select(
        "event_id",
        has_marker(free).alias("is_free_time"),
        F.when(has_marker(paused), parse_duration(paused)).alias("paused_minutes"),
    )


@query
def q_to_int(spark, sf_dir):
    q = F.col("l_quantity").cast("bigint").cast("string")
    shown = _pick(
        F.col("l_orderkey") % 5,
        q,
        F.concat(F.lit("-"), q, F.lit(".7")),
        F.concat(q, F.lit(" pcs")),
        F.concat(F.lit("\u00a0"), q, F.lit(".0 ")),
        "",
    )
    return v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        to_int(shown).alias("whole"),
        F.round(to_number(shown), 4).alias("number"),
        to_id(shown).alias("id"),
    )


@query
def q_classify_terminal(spark, sf_dir):
    name = strip("terminal")
    return (
        v.raw_sessions(spark, sf_dir)
        .select(F.lower(name).alias("terminal"), classify_terminal(F.lower(name)).alias("terminal_type"))
        .groupBy("terminal", "terminal_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# ---- cleaning ----------------------------------------------------------------------


@query
def q_clean_cash(spark, sf_dir):
    return _one(spark, sf_dir, "cash")


@query
def q_clean_sessions(spark, sf_dir):
    return _one(spark, sf_dir, "sessions")


@query
def q_clean_stock(spark, sf_dir):
    return _one(spark, sf_dir, "stock")


@query
def q_clean_members(spark, sf_dir):
    return _one(spark, sf_dir, "members")


@query
def q_rejects(spark, sf_dir):
    e = F.col("event_id")
    raw = v.raw_cash(
        spark, sf_dir, F.lit("events").alias("source_file"), e.cast("int").alias("row_idx")
    )
    broken = raw.withColumns(
        {
            "amount": F.when(F.col("row_idx") % 50 == 0, "12,3,4 TND").otherwise(F.col("amount")),
            "date": F.when(F.col("row_idx") % 75 == 0, "31.02.2024 00:00:00").otherwise(F.col("date")),
        }
    )
    return rejects("cash", broken)


@query
def q_row_quality(spark, sf_dir):
    k = F.col("l_orderkey") % 10
    name = F.concat(F.lit("cashier_"), F.col("l_suppkey") % 7)
    raw = v.table(spark, sf_dir, "lineitem").select(
        F.when(k == 2, "Cashier").when(k == 3, F.concat(name, F.lit(" 23/03/2026")))
        .when(~k.isin(0, 1), name).alias("cashier"),
        F.when(k != 0, F.when(k == 5, -F.col("l_quantity")).otherwise(F.col("l_quantity"))).alias("quantity"),
        F.when(k == 4, "unit price").when(k != 0, "1,00 TND").alias("unit_price"),
        F.when(k.isin(4, 6), "TOTAL AMOUNT").when(k != 0, "2,00 TND").alias("total_amount"),
    )
    kept = rows.drop_header_rows(rows.drop_empty_rows(raw), "cashier", "Cashier")
    kept = rows.drop_money_header_rows(kept, {"unit_price": "Unit Price", "total_amount": "Total Amount"})
    kept = rows.drop_incomplete_rows(rows.drop_dated_names(kept, "cashier"), ["cashier"])
    return rows.keep_positive(kept, "quantity")


@query
def q_columns_quality(spark, sf_dir):
    raw = v.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("cashier_"), F.col("o_custkey") % 7).alias(" Cashier "),
        F.col("o_orderkey").alias("ID"),
        F.lit("x").alias("Unnamed: 1"),
        F.when(F.col("o_orderkey") < 0, "x").alias("Empty"),
        F.col("o_orderdate").alias("Date "),
        v.money_text(v.cents("o_totalprice")).alias("Amount"),
    )
    named = columns.drop_matching_columns(columns.strip_column_names(raw))
    named = columns.drop_empty_columns(named).drop("ID")
    kept = columns.keep_raw(columns.keep_existing(named, ["Cashier", "Date", "Empty", "Amount"]), ["Amount"])
    return kept.withColumn("Amount", parse_amount("Amount"))


# ---- star schema -------------------------------------------------------------------


@query
def q_dim_cashier(spark, sf_dir):
    return star.dim_cashier(_cleaned(spark, sf_dir, "cash", "sessions", "stock"))


@query
def q_dim_terminal(spark, sf_dir):
    return star.dim_terminal(_cleaned(spark, sf_dir, "cash", "sessions", "stock"))


@query
def q_dim_item(spark, sf_dir):
    return star.dim_item(_cleaned(spark, sf_dir, "stock"))


@query
def q_dim_member(spark, sf_dir):
    return star.dim_member(_cleaned(spark, sf_dir, "members"))


@query
def q_dim_ordinals_bucketed(spark, sf_dir):
    pairs = v.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return with_ordinal(pairs, "pair_id", [F.col("l_partkey"), F.col("l_suppkey").desc()])


def _star_part(spark, sf_dir, fact: str) -> dict[str, DataFrame]:
    """One fact with the dimensions it refers to."""
    if fact == "fact_member_stats":
        cleaned = _cleaned(spark, sf_dir, "members")
        return {"dim_member": star.dim_member(cleaned), fact: star.fact_member_stats(cleaned)}
    cleaned = _cleaned(spark, sf_dir, "cash", "sessions", "stock")
    dims = {"dim_cashier": star.dim_cashier(cleaned), "dim_terminal": star.dim_terminal(cleaned)}
    if fact == "fact_stock_movements":
        dims["dim_item"] = star.dim_item(cleaned)
    return {**dims, fact: getattr(star, fact)(cleaned, dims)}


@query
def q_fact_cash(spark, sf_dir):
    return _star_part(spark, sf_dir, "fact_cash_transactions")["fact_cash_transactions"]


@query
def q_fact_sessions(spark, sf_dir):
    return _star_part(spark, sf_dir, "fact_sessions")["fact_sessions"]


@query
def q_fact_stock(spark, sf_dir):
    return _star_part(spark, sf_dir, "fact_stock_movements")["fact_stock_movements"]


@query
def q_fact_stock_large(spark, sf_dir):
    """All three lookups joined by a shuffle, as beyond the broadcast bounds."""
    cleaned = _cleaned(spark, sf_dir, "cash", "sessions", "stock")
    dims = {"dim_cashier": star.dim_cashier(cleaned), "dim_terminal": star.dim_terminal(cleaned), "dim_item": star.dim_item(cleaned)}
    return star.fact_stock_movements(cleaned, dims, max_rows=0)


@query
def q_fact_members(spark, sf_dir):
    return _star_part(spark, sf_dir, "fact_member_stats")["fact_member_stats"]


@query
def q_income_by_terminal(spark, sf_dir):
    """Income per cashier and class of terminal, from raw text to labelled totals."""
    part = _star_part(spark, sf_dir, "fact_cash_transactions")
    # Sums first: what meets the dimensions has a row per pair of keys.
    sums = (
        part["fact_cash_transactions"]
        .filter(F.col("income_expense") == "Income")
        .groupBy("cashier_id", "terminal_id")
        .agg(money_sum("amount_tnd").alias("amount"), F.count(F.lit(1)).alias("n"))
    )
    labelled = attach(sums, part["dim_cashier"], "cashier_id", "cashier_id")
    labelled = attach(labelled, part["dim_terminal"], "terminal_id", "terminal_id")
    return labelled.groupBy("cashier_name", "terminal_type").agg(
        money_sum("amount").alias("income_tnd"), F.sum("n").alias("transactions")
    )


@query
def q_fk_last_wins(spark, sf_dir):
    parts = v.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("item_name"), F.col("p_type").alias("category")
    )
    items = star.dim_item({"stock": parts})
    return resolve_fk(parts, "item_name", items, "item_name", "item_id").select("p_partkey", "item_id")


@query
def q_fk_null_key(spark, sf_dir):
    fact = _star_part(spark, sf_dir, "fact_stock_movements")["fact_stock_movements"]
    return fact.groupBy("in_out").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("item_id").isNull()).alias("no_item"),
        F.count_if(F.col("terminal_id").isNull()).alias("no_terminal"),
        F.sum("item_id").alias("item_sum"),
    )


@query
def q_fk_untrimmed(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir, "cash", "sessions", "stock")
    dim = star.dim_terminal(cleaned)
    found = resolve_fk(cleaned["cash"], "terminal", dim, "terminal_name", "terminal_id")
    found = found.withColumnRenamed("terminal_id", "as_is")
    found = resolve_fk(found, "terminal", dim, "terminal_name", "terminal_id", strip_keys=True)
    return found.groupBy("terminal").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("as_is").alias("as_is"),
        F.max("terminal_id").alias("stripped"),
    )


@query
def q_relationships(spark, sf_dir):
    """Detected relationships with the measured use of each."""
    tables = star.transform(_cleaned(spark, sf_dir))
    measured = quality.integrity(tables)
    return quality.relationships_table(spark, tables).join(
        measured, ["fromTable", "fromColumn", "toTable"], "left"
    )


@query
def q_integrity(spark, sf_dir):
    return quality.key_report(star.build_dims(_cleaned(spark, sf_dir)))


@query
def q_orphans(spark, sf_dir):
    members = star.dim_member(_cleaned(spark, sf_dir, "members"))
    return quality.orphans(v.table(spark, sf_dir, "orders"), "o_custkey", members, "member_id")


@query
def q_table_counts(spark, sf_dir):
    return explore.table_counts(star.transform(_cleaned(spark, sf_dir)))


@query
def q_roundtrip_csv(spark, sf_dir):
    tables = _star_part(spark, sf_dir, "fact_sessions")
    path = new_path(spark, "star")
    write_all(tables, path, "csv")
    return read_star(spark, path, ["fact_sessions"], "csv")["fact_sessions"]


@query
def q_roundtrip_parquet(spark, sf_dir):
    tables = _star_part(spark, sf_dir, "fact_cash_transactions")
    path = new_path(spark, "star")
    write_all(tables, path, "parquet")
    names = ["fact_cash_transactions"]
    return read_star(spark, path, names, "parquet")["fact_cash_transactions"]


def _hard(key: str, name: str) -> Column:
    """Names with outer blanks, quotes, separators, backslashes and line breaks; empty and missing ones."""
    k, n = F.col(key) % 8, F.col(name)
    cases = [F.concat(F.lit("  "), n, F.lit(" ")), F.concat(F.lit('"'), n, F.lit('" \\"')), F.concat(n, F.lit("\nsecond, line\r\n")), F.concat(F.lit("\\"), n, F.lit("\\")), F.lit(""), F.lit(None).cast("string"), F.concat(F.lit(","), n), n]
    return _pick(k, *cases)


@query
def q_roundtrip_names(spark, sf_dir):
    """Item and member names that delimited files tend to change, written and read back."""
    part = v.table(spark, sf_dir, "part")
    customer = v.table(spark, sf_dir, "customer")
    tables = {
        "dim_item": part.select(F.col("p_partkey").alias("item_id"), _hard("p_partkey", "p_name").alias("item_name"), F.col("p_type").alias("category")),
        "dim_member": customer.select(F.col("c_custkey").alias("member_id"), _hard("c_custkey", "c_name").alias("username"), F.col("c_mktsegment").alias("firstname"), F.lit(" x ").alias("lastname")),
    }
    path = new_path(spark, "star")
    write_all(tables, path, "csv")
    back = read_star(spark, path, list(tables), "csv")
    items = back["dim_item"].select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), F.col("item_name").alias("name"), F.col("category").alias("other"))
    members = back["dim_member"].select(F.lit("member").alias("kind"), F.col("member_id").alias("id"), F.col("username").alias("name"), F.col("lastname").alias("other"))
    return items.unionByName(members)


def _printed_reports(spark, sf_dir, fmt: str) -> str:
    path = new_path(spark, "reports")
    for name, raw in v.raw_tables(spark, sf_dir).items():
        grid = v.printed(raw, name)
        if fmt == "text":
            v.write_printed_text(grid, f"{path}/{name}")
        else:
            grid.write.parquet(f"{path}/{name}")
    return path


@query
def q_run_etl(spark, sf_dir):
    """The whole run from staged grids to a written star: rows per table and totals of a fact read back."""
    out = new_path(spark, "star")
    counts = run_etl(spark, _printed_reports(spark, sf_dir, "parquet"), out, "csv", "parquet")
    fact = read_star(spark, out, ["fact_stock_movements"], "csv")["fact_stock_movements"]
    sums = fact.agg(F.sum("item_id").alias("item_id"), F.sum("quantity").alias("quantity"), F.count("terminal_id").alias("terminal_id"))
    sums = sums.select(F.inline(F.array(*[F.struct(F.lit(f"sum {c}").alias("table"), F.col(c).alias("rows")) for c in sums.columns])))
    return counts.unionByName(sums)


@query
def q_run_etl_text(spark, sf_dir):
    """The whole run from printed text files."""
    return run_etl(spark, _printed_reports(spark, sf_dir, "text"), new_path(spark, "star"), "parquet", "text")


@query
def q_relationships_json(spark, sf_dir):
    """The relationships as another program reads them from the written file, with their measured use."""
    tables = _star_part(spark, sf_dir, "fact_sessions")
    path = new_path(spark, "relationships") + ".json"
    write_relationships(spark, tables, path)
    found = spark.read.option("multiLine", "true").json(path).select(F.inline("relationships"))
    return found.join(quality.integrity(tables), ["fromTable", "fromColumn", "toTable"], "left")


# ---- exploration -------------------------------------------------------------------


@query
def q_money_precision(spark, sf_dir):
    """Totals of amounts with three decimals."""
    value = F.expr("cast(round(l_extendedprice * 100) as bigint)")
    text = F.concat(F.floor(value / 1000), F.lit(","), F.lpad((value % 1000).cast("string"), 3, "0"), F.lit(" TND"))
    lines = v.table(spark, sf_dir, "lineitem").select("l_returnflag", parse_amount(text).alias("amount_tnd"))
    return explore.total_by(lines, ["l_returnflag"], "amount_tnd")


@query
def q_member_report(spark, sf_dir):
    """A member report whose headers hold a dot and repeat, from the grid to totals per class."""
    named = columns.drop_matching_columns(columns.strip_column_names(scan_with_header(v.member_grid(spark, sf_dir))), "^Unnamed")
    named = rows.drop_incomplete_rows(rows.drop_header_rows(rows.drop_empty_rows(named), "Usage.1", "Usage"), ["Ord.& Trans."])
    parsed = named.select("Class", *[parse_amount(c).alias(c) for c in ("Ord.& Trans.", "Usage.1")])
    traded = explore.total_by(parsed, ["Class"], "Ord.& Trans.", "traded")
    return traded.join(explore.total_by(parsed, ["Class"], "Usage.1", "usage"), "Class")


@query
def q_member_account(spark, sf_dir):
    """Rows of the member report: read, kept, and dropped for their id."""
    raw = v.raw_members(spark, sf_dir)
    parts = {"rows_in": raw, "kept": clean_table("members", raw), "dropped": dropped_ids("members", raw)}
    return explore.table_counts(parts).withColumnRenamed("table", "part")


@query
def q_member_activity(spark, sf_dir):
    counted = explore.count_by(_one(spark, sf_dir, "members"), ["firstname", "lastname"])
    return counted.orderBy("n", "firstname", "lastname")


@query
def q_member_usage(spark, sf_dir):
    return explore.total_by(_one(spark, sf_dir, "members"), ["firstname", "lastname"], "usage_tnd")


@query
def q_top_members(spark, sf_dir):
    m = _one(spark, sf_dir, "members").select("username", "total_amount_tnd")
    return explore.top(m, "total_amount_tnd", "username", 10)


@query
def q_frequency(spark, sf_dir):
    sessions = _one(spark, sf_dir, "sessions")
    pairs = [F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in ("cashier", "session_type")]
    return explore.count_by(sessions.select(F.inline(F.array(*pairs))), ["field", "value"])


@query
def q_top_items(spark, sf_dir):
    totals = explore.total_by(_one(spark, sf_dir, "stock"), ["item_name"], "total_amount_tnd")
    return explore.top(totals, "total", "item_name", 10)


@query
def q_cashier_total(spark, sf_dir):
    return explore.total_by(_one(spark, sf_dir, "sessions"), ["cashier"], "total_amount_tnd")


@query
def q_avg_duration(spark, sf_dir):
    return explore.mean_by(
        _one(spark, sf_dir, "sessions"), ["session_type"], "duration_minutes", "avg_minutes"
    )


@query
def q_daily_total(spark, sf_dir):
    return explore.daily_total(_one(spark, sf_dir, "stock"), "date", "total_amount_tnd")


@query
def q_category_total(spark, sf_dir):
    totals = explore.total_by(_one(spark, sf_dir, "stock"), ["category"], "total_amount_tnd")
    return totals.orderBy("total", "category")


@query
def q_share(spark, sf_dir):
    return explore.share_of_total(_one(spark, sf_dir, "stock"), "in_out", "total_amount_tnd")


def _histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    h = explore.histogram(df, column, bins)
    return h.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query
def q_histogram_15(spark, sf_dir):
    return _histogram(_one(spark, sf_dir, "members"), "duration_minutes", 15)


@query
def q_histogram_20(spark, sf_dir):
    return _histogram(_one(spark, sf_dir, "sessions"), "usage_tnd", 20)


@query
def q_duration_usage_corr(spark, sf_dir):
    r = explore.relation(_one(spark, sf_dir, "members"), "duration_minutes", "usage_tnd")
    return r.select(*[F.round(c, 6).alias(c) for c in r.columns])


# ---- series and forecasts ----------------------------------------------------------


@query
def q_week_bucket(spark, sf_dir):
    return (
        v.table(spark, sf_dir, "orders")
        .groupBy(week_ending(day("o_orderdate")).alias("week"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def q_revenue_series(spark, sf_dir):
    return series.revenue_series(_cash_fact(spark, sf_dir))


@query
def q_revenue_weekly(spark, sf_dir):
    return series.revenue_series(_cash_fact(spark, sf_dir), "W")


@query
def q_consumption_series(spark, sf_dir):
    return series.consumption_series(*_stock_and_items(spark, sf_dir))[0]


@query
def q_consumption_weekly(spark, sf_dir):
    return series.consumption_series(*_stock_and_items(spark, sf_dir), "W")[0]


@query
def q_series_skipped(spark, sf_dir):
    """Many fine-grained items, of which most have too few weeks."""
    stock = v.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item_id"),
        F.col("l_shipdate").alias("movement_datetime"),
        F.when(F.col("l_returnflag") == "R", "In").otherwise("Out").alias("in_out"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    items = v.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.concat_ws(" ", "p_name", "p_brand").alias("item_name")
    )
    kept, skipped = series.consumption_series(stock, items, "W")
    kept_counts = kept.groupBy("item_name").agg(F.count_if(F.col("y") > 0).alias("nonzero"))
    return kept_counts.withColumn("kept", F.lit(True)).unionByName(skipped.withColumn("kept", F.lit(False)))


@query
def q_avg_price(spark, sf_dir):
    prices = series.average_prices(*_stock_and_items(spark, sf_dir, priced=True))
    return prices.withColumn("avg_price", F.round("avg_price", 6))


@query
def q_derived_revenue(spark, sf_dir):
    """What the quantities sold per week are worth at mean prices."""
    stock, items = _stock_and_items(spark, sf_dir, priced=True)
    sold = series.consumption_series(stock, items, "W")[0].select(
        F.col("ds").alias("date"), "item_name", F.col("y").alias("predicted_qty")
    )
    derived = fc.derived_revenue(sold, series.average_prices(stock, items))
    return derived.withColumn("derived_revenue_tnd", F.round("derived_revenue_tnd", 3))


def _rounded(df: DataFrame, places: int = 4) -> DataFrame:
    return df.select(
        *[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


@query
def q_forecast_revenue(spark, sf_dir):
    stock, items = _stock_and_items(spark, sf_dir, priced=True)
    return _rounded(fc.forecast_tables(_cash_fact(spark, sf_dir), stock, items, 30, "D")["revenue"], 3)


@query
def q_forecast_consumption(spark, sf_dir):
    per_item, _, low, high = series.item_periods(*_stock_and_items(spark, sf_dir))
    return _rounded(fc.forecast_consumption(per_item, 30, "D", (low, high)))


@query
def q_forecast_weekly(spark, sf_dir):
    per_item = series.consumption_series(*_stock_and_items(spark, sf_dir), "W")[0]
    return _rounded(fc.forecast_consumption(per_item, 8, "W"))


def _order_days(spark, sf_dir) -> tuple[DataFrame, tuple[date, date]]:
    """Orders per priority and day, as periods with a value, and the first and last day."""
    days = v.table(spark, sf_dir, "orders").groupBy("o_orderpriority", day("o_orderdate").alias("ds")).agg(F.count(F.lit(1)).alias("orders"))
    days = stage(days, "order_days")
    return days, tuple(days.agg(F.min("ds"), F.max("ds")).first())


@query
def q_forecast_trend(spark, sf_dir):
    """Orders per priority whose number rises from a day of its own on; the forecast follows the bend."""
    days, span = _order_days(spark, sf_dir)
    after = F.greatest(F.datediff("ds", F.lit(span[0])) - 400 * F.left("o_orderpriority", F.lit(1)).cast("int"), F.lit(0))
    bent = days.select("o_orderpriority", "ds", (F.col("orders") * 10 + after).alias("y"))
    return _rounded(fc.forecast(bent, ["o_orderpriority"], 30, "D", span))


@query
def q_forecast_edges(spark, sf_dir):
    """Values near the bound of sums of money, and values of a millionth."""
    days, span = _order_days(spark, sf_dir)
    scales = F.inline(F.array(*[F.struct(F.lit(n).alias("scale"), F.lit(f).alias("factor")) for n, f in (("large", 1e20), ("small", 1e-6))]))
    scaled = days.select("ds", "orders", "o_orderpriority", scales).withColumn("y", F.col("orders") * F.col("factor"))
    made = fc.forecast(scaled, ["scale", "factor", "o_orderpriority"], 7, "D", span)
    return made.select("scale", "o_orderpriority", "ds", *[F.round(F.col(c) / F.col("factor"), 4).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


@query
def q_forecast_coverage(spark, sf_dir):
    """How many of the last 30 days of each item lie inside the band forecast without them."""
    per_item, _, low, high = series.item_periods(*_stock_and_items(spark, sf_dir))
    return fc.coverage(per_item, ["item_name"], 30, "D", (low, high))


@query
def q_forecast_summary(spark, sf_dir):
    stock, items = _stock_and_items(spark, sf_dir, priced=True)
    tables = fc.forecast_tables(_cash_fact(spark, sf_dir), stock, items, 30, "D")
    summary = fc.forecast_summary(tables)
    totals = summary["totals"].select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("entry"), F.col(c).alias("value"))
                    for c in ("direct_revenue_tnd", "direct_lower_tnd", "direct_upper_tnd")
                ]
            )
        )
    )
    best = summary["top_items"].toDF("entry", "value")
    skipped = summary["skipped"].select("item_name", F.col("nonzero").cast("double")).toDF("entry", "value")
    return _rounded(totals.unionByName(best).unionByName(skipped), 3)


@query
def q_run_forecast(spark, sf_dir):
    """The whole forecast run from a written star; its revenue table read back."""
    cleaned = _cleaned(spark, sf_dir, "cash", "sessions", "stock")
    dims = {"dim_cashier": star.dim_cashier(cleaned), "dim_terminal": star.dim_terminal(cleaned), "dim_item": star.dim_item(cleaned)}
    tables = {
        "dim_item": dims["dim_item"],
        "fact_cash_transactions": star.fact_cash_transactions(cleaned, dims),
        "fact_stock_movements": star.fact_stock_movements(cleaned, dims),
    }
    path = new_path(spark, "star")
    write_all(tables, path, "parquet")
    written = run_forecast(spark, path, f"{path}/forecasts", 30, "D", "parquet")
    per_day = written["consumption"].groupBy("date").agg(F.count("*").alias("items"))
    return _rounded(written["revenue"], 3).join(per_day, "date", "left")
