"""Where the columns of each report lie in its grid."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Cell position -> column name, and the column only data rows fill."""

    columns: dict[int, str]
    key: str


# Cell positions and key columns of the four reports. The positions are
# those of the data; because of merged cells some headers stand one cell off.
LAYOUTS = {
    "cash": Layout(
        {
            0: "cashier",
            4: "date",
            9: "income_expense",
            11: "payment_method",
            21: "transaction_type",
            40: "amount",
            51: "comment",
        },
        key="date",
    ),
    "sessions": Layout(
        {
            0: "cashier",
            4: "terminal",
            9: "session_type",
            12: "free_time",
            14: "paused",
            20: "duration",
            22: "order_transfer",
            28: "usage",
            30: "discount",
            32: "total_amount",
        },
        key="terminal",
    ),
    "stock": Layout(
        {
            0: "cashier",
            4: "date",
            8: "item_name",
            13: "category",
            20: "in_out",
            25: "quantity",
            28: "unit_price",
            29: "total_amount",
            32: "comment",
        },
        key="date",
    ),
    "members": Layout(
        {
            2: "member_id",
            6: "username",
            8: "firstname",
            13: "lastname",
            14: "duration",
            22: "usage",
            27: "orders_transfer",
            30: "total_amount",
        },
        key="member_id",
    ),
}

# The print artifacts.
FIRST_DATA_ROW = 5
PAGE_TEXT = "Page "
PAGE_PATTERN = "Page [0-9]+/[0-9]+"
REPEATED_HEADER = "Cashier"
