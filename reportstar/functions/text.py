"""Text cells: trimming, markers, terminal names and terminal classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank at the ends of a cell.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: how the names of the computers begin.
COMPUTER_PREFIX = "GAMEFY"
# Fixed values: (class, test, text) in the order in which they are tried.
TERMINAL_RULES = (
    ("VIP", "contains", "VIP"),
    ("PlayStation", "startswith", "PS"),
    ("Computer", "startswith", COMPUTER_PREFIX),
)
OTHER_TERMINAL = "Other"
# Fixed value: a comment that is nothing but a name in parentheses.
TERMINAL_PATTERN = r"^\(([^\n]+)\)$"


def quoted(name: str) -> str:
    """A column name as Spark takes it literally, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def _col(c: Column | str) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove Unicode blanks from both ends (plain ``trim`` only removes spaces)."""
    return F.btrim(_col(c), F.lit(BLANKS))


def capture(c: Column | str, pattern: str, group: int) -> Column:
    """Group of the first match, NULL without one; the text is evaluated only once.

    Casts that follow then see a NULL where nothing matched: a ``try_cast`` that fails is
    many times slower than one that succeeds.
    """
    return F.get(F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(group)), F.lit(0))


def has_marker(c: Column | str) -> Column:
    """True when the cell holds anything but blanks."""
    return F.coalesce(F.ltrim(_col(c), F.lit(BLANKS)) != "", F.lit(False))


def extract_terminal(c: Column | str) -> Column:
    """Name inside the outermost parentheses of a one-line comment, else NULL."""
    return capture(strip(c), TERMINAL_PATTERN, 1)


def classify_terminal(
    c: Column | str,
    rules: Sequence[tuple[str, str, str]] = TERMINAL_RULES,
    other: str = OTHER_TERMINAL,
) -> Column:
    """Class of a terminal name; the first rule that holds decides."""
    name = F.upper(_col(c))
    picked = F.lit(other)
    for label, test, text in reversed(rules):
        picked = F.when(getattr(name, test)(text), F.lit(label)).otherwise(picked)
    return picked
