"""Typed tables from the text tables of the four reports, and the cells that do not parse.

A bad cell becomes NULL and is listed by ``rejects``; its row stays. Cleaning is one
projection, so a consumer that needs one column parses only that column. ``parse_table`` gives typed columns and bad cells
of one parse; stored once, both are read from there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reportstar.functions.numbers import parse_amount, to_id, to_int
from reportstar.functions.text import extract_terminal, has_marker, strip
from reportstar.functions.times import parse_datetime, parse_duration
from reportstar.staging import stage

#: Column of a parsed table: the cells of the row that do not parse.
BAD = "bad_cells"


@dataclass(frozen=True)
class Cell:
    """How one text column becomes a typed one, and when a failed parse is a bad cell.

    ``required`` counts a NULL as bad too; ``blank_ok`` lets blank text pass as NULL.
    """

    source: str
    target: str
    parse: Callable[[Column], Column]
    required: bool = False
    blank_ok: bool = False

    @property
    def parsed(self) -> str:
        return f"__parsed_{self.source}"

    def value(self) -> Column:
        return self.parse(F.col(self.source))

    def is_bad(self) -> Column:
        """Whether the parse of ``source``, which is in the column ``parsed``, failed."""
        failed = F.col(self.parsed).isNull()
        if self.required:
            return failed
        return failed & (has_marker(self.source) if self.blank_ok else F.col(self.source).isNotNull())


@dataclass(frozen=True)
class Rules:
    """Cleaning of one table. ``cells`` that keep their name stay in place; others are appended."""

    stripped: tuple[str, ...] = ()
    cells: tuple[Cell, ...] = ()
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)
    numeric_id: str | None = None


def _amounts(*names: str) -> tuple[Cell, ...]:
    return tuple(Cell(name, f"{name}_tnd", parse_amount) for name in names)


def _stamp(c: Column) -> Column:
    return parse_datetime(c, trim=False)


RULES = {
    "cash": Rules(
        stripped=("cashier",),
        cells=(Cell("date", "date", _stamp, blank_ok=True), *_amounts("amount")),
        derived={"terminal": lambda: extract_terminal("comment")},
    ),
    "sessions": Rules(
        stripped=("cashier", "terminal"),
        cells=(
            Cell("duration", "duration_minutes", parse_duration, required=True),
            Cell("paused", "paused_duration_minutes", parse_duration, blank_ok=True),
            *_amounts("order_transfer", "usage", "discount", "total_amount"),
        ),
        derived={"is_free_time": lambda: has_marker("free_time")},
    ),
    "stock": Rules(
        stripped=("cashier",),
        cells=(
            Cell("date", "date", _stamp, blank_ok=True),
            Cell("quantity", "quantity", to_int, required=True),
            *_amounts("unit_price", "total_amount"),
        ),
        derived={"terminal": lambda: extract_terminal("comment")},
    ),
    "members": Rules(
        cells=(
            Cell("duration", "duration_minutes", parse_duration, required=True),
            *_amounts("usage", "orders_transfer", "total_amount"),
        ),
        numeric_id="member_id",
    ),
}

# The columns of the cleaned tables, in order.
CLEANED_COLUMNS = {
    "cash": (
        "cashier", "date", "income_expense", "payment_method", "transaction_type", "comment",
        "amount_tnd", "terminal",
    ),
    "sessions": (
        "cashier", "terminal", "session_type", "duration_minutes", "is_free_time",
        "paused_duration_minutes", "order_transfer_tnd", "usage_tnd", "discount_tnd",
        "total_amount_tnd",
    ),
    "stock": (
        "cashier", "date", "item_name", "category", "in_out", "quantity", "comment",
        "unit_price_tnd", "total_amount_tnd", "terminal",
    ),
    "members": (
        "member_id", "username", "firstname", "lastname", "duration_minutes", "usage_tnd",
        "orders_transfer_tnd", "total_amount_tnd",
    ),
}


def drop_nonnumeric_ids(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose id is not a number; the id becomes BIGINT."""
    return df.withColumn(column, to_id(column)).dropna(subset=[column])


def parse_table(name: str, raw: DataFrame) -> DataFrame:
    """``clean_table`` with ``bad_cells``, the cells of the row that do not parse; each cell is parsed once."""
    rules = RULES[name]
    if rules.numeric_id:
        raw = drop_nonnumeric_ids(raw, rules.numeric_id)
    # The values are used twice, so they stay a projection of their own.
    raw = raw.withColumns({cell.parsed: cell.value() for cell in rules.cells})
    made = {c: strip(c) for c in rules.stripped}
    made |= {cell.target: F.col(cell.parsed) for cell in rules.cells}
    made |= {c: make() for c, make in rules.derived.items()}
    wanted = CLEANED_COLUMNS[name]
    extra = [c for c in ("source_file", "row_idx") if c in raw.columns]
    return raw.select(*[made.get(c, F.col(c)).alias(c) for c in wanted], *extra, _bad_cells(rules).alias(BAD))


def clean_table(name: str, raw: DataFrame) -> DataFrame:
    """Typed columns in the order of ``CLEANED_COLUMNS``; columns beyond the layout follow."""
    return parse_table(name, raw).drop(BAD)


def _entry(source: str) -> Column:
    return F.struct(F.lit(source).alias("column"), F.col(source).alias("raw_value"))


def _bad_cells(rules: Rules) -> Column:
    """The bad cells of a row; rows without any, nearly all, don't build the list that is compacted."""
    listed = F.array_compact(F.array(*[F.when(cell.is_bad(), _entry(cell.source)) for cell in rules.cells]))
    return F.when(reduce(Column.__or__, [cell.is_bad() for cell in rules.cells]), listed).otherwise(F.slice(listed, 1, 0))


def _listed(name: str, raw: DataFrame, cells: Column) -> DataFrame:
    position = {"source_file": "string", "row_idx": "bigint"}
    where = [
        (F.col(c) if c in raw.columns else F.lit(None).cast(kind)).alias(c)
        for c, kind in position.items()
    ]
    return raw.select(F.lit(name).alias("table"), *where, F.explode(cells).alias("cell")).select(
        "table", "source_file", "row_idx", "cell.column", "cell.raw_value"
    )


def rejects(name: str, raw: DataFrame) -> DataFrame:
    """One row per bad cell: ``table, source_file, row_idx, column, raw_value``."""
    return rejects_of(name, parse_table(name, raw))


def rejects_of(name: str, parsed: DataFrame) -> DataFrame:
    """``rejects`` of a table that ``parse_table`` made."""
    return _listed(name, parsed, F.col(BAD))


def dropped_ids(name: str, raw: DataFrame) -> DataFrame:
    """One row per row that cleaning drops for its id, in the form of ``rejects``; NULL ids too."""
    column = RULES[name].numeric_id
    if column is None:
        raise ValueError(f"no row of {name} is dropped for its id")
    return _listed(name, raw.filter(to_id(column).isNull()), F.array(_entry(column)))


def stage_parsed(name: str, raw: DataFrame) -> tuple[DataFrame, int]:
    """The stored table of ``parse_table`` and its number of bad cells, which are counted while it is written."""
    seen = Observation(f"bad cells of {name}")
    parsed = parse_table(name, raw).observe(seen, F.coalesce(F.sum(F.size(BAD)), F.lit(0)).alias("bad"))
    stored = stage(parsed, f"parsed_{name}")
    return stored, seen.get["bad"]


def bad_cell(name: str, parsed: DataFrame) -> ValueError:
    """The error for a parsed table with a bad cell, with the first one found."""
    cell = rejects_of(name, parsed).take(1)[0]
    return ValueError(f"Cannot parse {name}.{cell['column']}: {cell['raw_value']!r}")


def clean_all(raw: dict[str, DataFrame], strict: bool = False) -> dict[str, DataFrame]:
    """Clean every table; ``strict`` raises ``ValueError`` when any cell is bad.

    A strict table is parsed once, into a stored table from which all else is read.
    """
    if not strict:
        return {name: clean_table(name, df) for name, df in raw.items()}
    return {name: stored.drop(BAD) for name, stored in stage_all(raw, strict).items()}


def stage_all(raw: dict[str, DataFrame], strict: bool = False) -> dict[str, DataFrame]:
    """Stored tables of ``parse_table``, for typed rows and rejects alike; ``strict`` raises as ``clean_all`` does."""
    out = {}
    for name, df in raw.items():
        out[name], bad = stage_parsed(name, df)
        if strict and bad:
            raise bad_cell(name, out[name])
    return out
