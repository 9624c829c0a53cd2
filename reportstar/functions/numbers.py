"""Amounts, counts and ids held as text.

Every parser returns NULL for text it does not accept; the table cleaners list those
cells as rejects. Nothing here raises, because Catalyst drops unused columns and a
raising expression would then pass unnoticed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportstar.functions.text import _col, capture, strip

# Fixed values of the amount format.
THOUSANDS = "\u202f"
CURRENCY = "TND"

# Sums of amounts: three decimals of the dinar and three to spare, 22 digits before the point.
MONEY = "decimal(28,6)"
#: Amounts from here on are not taken: a DOUBLE no longer holds their cents.
AMOUNT_BOUND = 1e15
NUMBER_PATTERN = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
DECIMAL_PATTERN = r"^-?(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"


def _below(value: Column, bound: float) -> Column:
    """NULL for numbers of ``bound`` and more in size; NULLIF-like, so that the text is parsed once."""
    return F.get(F.filter(F.array(value), lambda x: F.abs(x) < bound), F.lit(0))


def _number(text: Column, pattern: str, bound: float, digits: int) -> Column:
    """``text`` as a DOUBLE below ``bound`` if ``pattern`` takes it.

    A plain number of up to ``digits`` digits before the point is below the bound for certain and is not compared with
    it; a comparison would need a lambda, which generated code can't hold. Others are rare.
    """
    sign = pattern[1 : pattern.index("(")]
    plain = rf"^{sign}(?:0*[0-9]{{1,{digits}}}(?:\.[0-9]*)?|\.[0-9]+)$"
    other = _below(capture(text, pattern, 0).try_cast("double"), bound)
    return F.coalesce(capture(text, plain, 0).try_cast("double"), other)


def to_number(c: Column | str) -> Column:
    """Plain decimal or scientific notation to a finite DOUBLE; blanks around it are allowed.

    The pattern keeps out what only a JVM number parser takes (``1.5d``, ``Infinity``, ``NaN``).
    """
    return _number(strip(c), NUMBER_PATTERN, float("inf"), 300)


def parse_amount(c: Column | str, drop_thousands: bool = True) -> Column:
    r"""``1\u202f745,44 TND`` (narrow no-break space) to 1745.44.

    ``drop_thousands=False`` is the notebook variant, where grouped amounts fail.
    """
    s = _col(c)
    if drop_thousands:
        s = F.replace(s, F.lit(THOUSANDS), F.lit(""))
    s = F.replace(s, F.lit(f" {CURRENCY}"), F.lit(""))
    return _number(strip(F.replace(s, F.lit(","), F.lit("."))), NUMBER_PATTERN, AMOUNT_BOUND, 14)


def parse_amount_lenient(c: Column | str, header: str) -> Column:
    """Keep only digits, dots and minus signs; a repeated header cell is NULL."""
    s = strip(c)
    body = F.when(F.lower(s) != header.lower(), F.replace(s, F.lit(","), F.lit(".")))
    return _number(F.regexp_replace(body, r"[^0-9.\-]+", ""), DECIMAL_PATTERN, AMOUNT_BOUND, 14)


def to_int(c: Column | str) -> Column:
    """Number text to INT, cut towards zero."""
    return to_number(c).try_cast("int")


def to_id(c: Column | str) -> Column:
    """Id text to BIGINT; exact for whole numbers, ``35.0`` and ``35.9`` give 35."""
    return F.coalesce(
        capture(strip(c), INTEGER_PATTERN, 0).try_cast("bigint"),
        to_number(c).try_cast("bigint"),
    )


def money(c: Column | str) -> Column:
    """Exact to six decimals, so that sums do not depend on the order of the rows."""
    return _col(c).cast(MONEY)


def money_sum(c: Column | str) -> Column:
    return F.sum(money(c)).cast("double")


def clamp_zero(c: Column | str) -> Column:
    return F.greatest(F.lit(0.0), _col(c))
