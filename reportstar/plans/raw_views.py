"""Report-shaped text tables derived from the benchmark tables.

The source reports are not available, so every row of ``events``, ``lineitem``,
``customer`` and ``orders`` is written out the way the reports would print it. All of it is
narrow work except the lookup of the item names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportstar.functions.numbers import CURRENCY, THOUSANDS
from reportstar.functions.text import COMPUTER_PREFIX
from reportstar.operators.lookup import attach
from reportstar.sources.layouts import LAYOUTS
from reportstar.sources.tables import scan_table

# Twelve terminals: six computers, three consoles, two special ones and a kiosk.
# Fixed value: how the names of the computers begin.
COMPUTER = COMPUTER_PREFIX
TERMINALS = (
    *[f"{COMPUTER}{i:02}" for i in range(1, 7)],
    *[f"PS5 ({i})" for i in range(1, 4)],
    f"{COMPUTER}-VIP",
    "PS-VIP",
    "Kiosk 1",
)
GRID_WIDTH = 60
CELL_SEP = "\t"
ROWS_PER_PAGE = 40
ROWS_PER_FILE = 1000
# A printed text file of some 40 MB.
ORDERS_PER_TEXT_FILE = 250_000
# A page of the grid takes its data rows, a blank, the page marker, a blank and a header.
GRID_PAGE = ROWS_PER_PAGE + 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table; those of a single file hold one row group and are dealt over the cores on request."""
    path = f"{sf_dir}/{name}.parquet"
    small = len(spark.read.parquet(path).inputFiles()) == 1
    return scan_table(spark, path, spark.sparkContext.defaultParallelism if small else None)


def cents(amount: str) -> Column:
    return F.expr(f"cast(round({amount} * 100) as bigint)")


def money_text(value: Column) -> Column:
    """Whole cents as the reports print them."""
    shown = F.translate(F.format_number(value / 100, 2), ",.", f"{THOUSANDS},")
    return F.concat(shown, F.lit(f" {CURRENCY}"))


def duration_text(minutes: Column) -> Column:
    hours = F.floor(minutes / 60)
    return F.when(minutes < 60, F.concat(minutes, F.lit(" min"))).otherwise(
        F.concat(hours, F.lit(" h "), minutes % 60, F.lit(" min"))
    )


def stamp_text(ts: str) -> Column:
    """Cut from the ISO text, since formatting would go through the session's time zone."""
    iso = f"cast({ts} as string)"
    return F.expr(
        f"concat(substr({iso}, 9, 2), '.', substr({iso}, 6, 2), '.', substr({iso}, 1, 4), ' ', substr({iso}, 12, 8))"
    )


def terminal_name(k: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in TERMINALS]), k.cast("int"))


def _third(column: str) -> Column:
    """Position 0..11 that does not depend on the id modulo 3."""
    return F.expr(f"{column} div 3 % 12")


def _padded(text: Column) -> Column:
    return F.concat(F.lit(" \u00a0"), text, F.lit("\u202f "))


def cashier(column: str, n: int) -> Column:
    return F.expr(f"concat('cashier_', {column} % {n})")


def raw_cash(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """Columns of the cash report and any ``extra`` ones made from ``events``."""
    k = _third("event_id")
    name, inner = terminal_name(k), F.when(k == 11, " ").otherwise("")
    third = F.col("event_id") % 3
    return table(spark, sf_dir, "events").select(
        _padded(cashier("user_id", 7)).alias("cashier"),
        stamp_text("ts").alias("date"),
        F.when(F.col("event_type") == "error", "Expense").otherwise("Income").alias("income_expense"),
        F.when(F.col("event_id") % 2 == 0, "Cash").otherwise("Card").alias("payment_method"),
        F.col("event_type").alias("transaction_type"),
        money_text(cents("value")).alias("amount"),
        # Inside the parentheses of the kiosk stand blanks, which the name keeps.
        F.when(third == 0, F.concat(F.lit("("), inner, name, inner, F.lit(")")))
        .when(third == 1, "Money deposited to member")
        .alias("comment"),
        *extra,
    )


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    paid = cents("value")
    kinds = F.array(*[F.lit(x) for x in ("Member", "Guest", "Free", "Prepaid")])
    return table(spark, sf_dir, "events").select(
        _padded(cashier("event_id", 5)).alias("cashier"),
        _padded(terminal_name(e % 12)).alias("terminal"),
        F.get(kinds, (e % 4).cast("int")).alias("session_type"),
        F.when(e % 5 == 0, "x").when(e % 5 == 1, " ").alias("free_time"),
        F.when(e % 6 == 0, F.concat(e % 60, F.lit(" min"))).when(e % 6 == 1, "").alias("paused"),
        duration_text(e % 200).alias("duration"),
        money_text(paid % 500).alias("order_transfer"),
        money_text(paid).alias("usage"),
        money_text(paid % 50).alias("discount"),
        money_text(paid + paid % 500 - paid % 50).alias("total_amount"),
    )


def raw_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    lines = attach(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_returnflag", "l_shipdate",
        ),
        parts,
        "l_partkey",
        "p_partkey",
    )
    quantity = F.col("l_quantity").cast("bigint")
    total = cents("l_extendedprice")
    third = F.col("l_orderkey") % 3
    return lines.select(
        _padded(cashier("l_suppkey", 7)).alias("cashier"),
        stamp_text("l_shipdate").alias("date"),
        # Some parts lose their name, so that the NULL item occurs.
        F.when(F.col("l_partkey") % 97 != 0, F.col("p_name")).alias("item_name"),
        F.col("p_type").alias("category"),
        F.when(F.col("l_returnflag") == "R", "In").otherwise("Out").alias("in_out"),
        F.when(F.col("l_orderkey") % 2 == 0, quantity.cast("string"))
        .otherwise(F.concat(quantity, F.lit(".0")))
        .alias("quantity"),
        money_text(F.floor(total / quantity)).alias("unit_price"),
        money_text(total).alias("total_amount"),
        F.when(third == 0, F.concat(F.lit("("), terminal_name(_third("l_orderkey")), F.lit(")")))
        .when(third == 1, "shelf check")
        .alias("comment"),
    )


def raw_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row in ten has an id that is no number, one in ten a decimal one."""
    key = F.col("c_custkey")
    balance = cents("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 10 == 9, F.concat(F.lit("M-"), key))
        .when(key % 10 == 8, F.concat(key, F.lit(".0")))
        .otherwise(key.cast("string"))
        .alias("member_id"),
        F.lower("c_name").alias("username"),
        F.concat(F.lit("First"), F.col("c_nationkey")).alias("firstname"),
        F.initcap("c_mktsegment").alias("lastname"),
        duration_text(key % 1000).alias("duration"),
        money_text(balance).alias("usage"),
        money_text(F.abs(balance) % 300).alias("orders_transfer"),
        money_text(balance + F.abs(balance) % 300).alias("total_amount"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "cash": raw_cash(spark, sf_dir),
        "sessions": raw_sessions(spark, sf_dir),
        "stock": raw_stock(spark, sf_dir),
        "members": raw_members(spark, sf_dir),
    }


def _row(index: Column, cells: dict[int, Column | str]) -> Column:
    """Place and cells of one grid row."""
    parts, at = [], 0
    for i, value in sorted(cells.items()):
        parts += [F.lit(CELL_SEP * (i - at)), value if isinstance(value, Column) else F.lit(value)]
        at = i
    parts.append(F.lit(CELL_SEP * (GRID_WIDTH - 1 - at)))
    return F.struct(index.cast("bigint").alias("row_idx"), F.split(F.concat(*parts), CELL_SEP).alias("cells"))


# Header texts of the cash report; the last one stands a cell before its data.
GRID_HEADER = {
    0: "Cashier ",
    4: " Date",
    9: "Income/Expense",
    11: "Payment Method",
    21: "Transaction Type",
    40: "Amount",
    50: "Comment",
}


def raw_grid(spark: SparkSession, sf_dir: str, per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Printed cash reports of ``per_file`` orders each.

    Every order yields its own row and, at the end of a page or file, the artifacts that
    follow it. The place of a row follows from the order key alone.
    """
    key = F.col("o_orderkey")
    k = key % per_file
    page = F.floor(k / ROWS_PER_PAGE)
    at = 5 + page * GRID_PAGE + k % ROWS_PER_PAGE
    ends_page = k % ROWS_PER_PAGE == ROWS_PER_PAGE - 1
    third = key % 3
    data = _row(
        at,
        {
            0: F.concat(F.lit(" cashier_"), F.col("o_custkey") % 7),
            4: stamp_text("o_orderdate"),
            9: F.when(F.col("o_orderstatus") == "F", "Expense").otherwise("Income"),
            11: F.when(key % 2 == 0, "Cash").otherwise("Card"),
            21: F.col("o_orderpriority"),
            40: money_text(cents("o_totalprice")),
            51: F.when(third == 0, F.concat(F.lit("("), terminal_name(_third("o_orderkey")), F.lit(")")))
            .when(third == 1, "Money deposited to member")
            .otherwise(""),
        },
    )
    preamble = [
        _row(F.lit(0), {0: "Cash Reports"}),
        _row(F.lit(1), {55: "23/03/2026"}),
        _row(F.lit(2), {}),
        _row(F.lit(3), {}),
        _row(F.lit(4), GRID_HEADER),
    ]
    number = F.concat(F.lit("Page "), page + 1, F.lit(f"/{per_file // ROWS_PER_PAGE}"))
    between = [
        _row(at + 1, {}),
        _row(at + 2, {54: number}),
        _row(at + 3, {}),
        _row(at + 4, {0: "Cashier ", 4: "Date"}),
    ]
    footer = [
        _row(at + 5, {8: "Computer Incomes"}),
        _row(at + 6, {8: "76245,51 TND"}),
        _row(at + 7, {54: number}),
    ]
    rows = F.flatten(
        F.array_compact(
            F.array(
                F.when(k == 0, F.array(*preamble)),
                F.array(data),
                F.when(ends_page, F.array(*between)),
                F.when(k == per_file - 1, F.array(*footer)),
            )
        )
    )
    return table(spark, sf_dir, "orders").select(
        F.lit("cash").alias("report"),
        F.concat(F.lit("cash_"), F.floor(key / per_file)).alias("source_file"),
        F.inline(rows),
    )


def printed(raw: DataFrame, name: str) -> DataFrame:
    """A text table as a grid, one file per partition: preamble, data rows and a page marker."""
    layout = LAYOUTS[name]
    place = F.monotonically_increasing_id()
    cells = [F.lit("")] * (max(*layout.columns, 5) + 1)
    for at, column in layout.columns.items():
        cells[at] = F.col(column)
    row = lambda at, texts: F.struct(F.lit(at).cast("bigint").alias("row_idx"), texts.alias("cells"))
    width = len(cells)
    blank = F.array(*[F.lit("")] * width)
    head = F.array(*[F.lit("Cashier" if i == min(layout.columns) else "") for i in range(width)])
    page = F.array(*[F.lit("Page 1/1" if i == 5 else "") for i in range(width)])
    preamble = [row(i, blank) for i in range(4)] + [row(4, head), row(5, page)]
    numbered = raw.select(F.array(*cells).alias("own"), place.alias("place"))
    low = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    data = F.array(F.struct((low + 6).alias("row_idx"), F.col("own").alias("cells")))
    rows = F.when(low == 0, F.concat(F.array(*preamble), data)).otherwise(data)
    return numbered.select(
        F.lit(name).alias("report"),
        F.concat(F.lit(f"{name}_"), F.shiftright("place", 33)).alias("source_file"),
        F.inline(rows),
    )


def write_text_grid(grid: DataFrame, path: str) -> None:
    """One text file per ``source_file``, its rows in order."""
    (
        grid.repartition("source_file")
        .sortWithinPartitions("source_file", "row_idx")
        .select("source_file", F.array_join("cells", CELL_SEP, ""))
        .write.partitionBy("source_file")
        .text(path)
    )


def write_printed_text(grid: DataFrame, path: str) -> None:
    """Grids that ``printed`` made as one text file each: a partition is a file and holds its rows in order."""
    grid.select(F.array_join("cells", CELL_SEP, "")).write.text(path)


# Header texts of the member report as it is explored: one has a dot, two are equal.
MEMBER_HEADER = ("Member", "Usage", "Ord.& Trans.", "Usage", "Class", "")


def member_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member report with the header repeated after every fiftieth member."""
    key = F.col("c_custkey")
    balance = cents("c_acctbal")
    own = F.array(F.col("c_name"), money_text(balance), money_text(F.abs(balance) % 300), money_text(balance * 2), F.col("c_mktsegment"), F.lit(""))
    header = F.array(*[F.lit(x) for x in MEMBER_HEADER])
    row = lambda at, cells: F.struct(at.cast("bigint").alias("row_idx"), cells.alias("cells"))
    rows = F.when(key % 50 == 0, F.array(row(5 + 2 * key, own), row(6 + 2 * key, header))).otherwise(F.array(row(5 + 2 * key, own)))
    members = table(spark, sf_dir, "customer").select(F.inline(rows))
    return members.unionByName(spark.range(1).select(F.lit(4).cast("bigint").alias("row_idx"), header.alias("cells")))
