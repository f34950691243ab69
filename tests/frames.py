"""Hand-made Bronze frames for unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tavola import schemas


def ts(d: str | None):
    return None if d is None else dt.datetime.fromisoformat(d + "T12:00:00")


def items_frame(spark, rows):
    """rows: (order, line, user, date, loyalty, item, price, qty[, restaurant, category])"""
    out = []
    for r in rows:
        order, line, user, date, loyal, item, price, qty = r[:8]
        rest = r[8] if len(r) > 8 else "R1"
        cat = r[9] if len(r) > 9 else "CAT"
        out.append(("APP", rest, ts(date), order, user, None, loyal, "USD", line, cat, item,
                    None if price is None else Decimal(price), qty))
    return spark.createDataFrame(out, schemas.ORDER_ITEMS)


def options_frame(spark, rows):
    """rows: (order, line, name, price, qty)"""
    return spark.createDataFrame(
        [(o, l, "G", n, None if p is None else Decimal(p), q) for o, l, n, p, q in rows], schemas.ORDER_ITEM_OPTIONS)


TRAP_ITEMS = [
    ("o1", "l1", "u1", "2024-01-10", True, "A", "5.00", 2),
    ("o2", "l1", "u1", "2024-01-20", False, "A", "0.00", 1),
    ("o3", "l1", "u1", "2024-02-01", True, "B", "0.00", 3),
    ("o4", "l1", None, "2024-02-21", False, "C", "4.00", 1),
    ("o5", "l1", "u2", "2023-08-21", False, "C", "4.00", 2),
    ("o5", "l1", "u2", "2023-08-21", False, "C", "4.00", 3),
    ("o6", "l1", "u2", "2023-08-20", False, "C", "4.00", 1),
    ("o7", "l1", "u3", "2024-01-07", False, "D", "7.00", 1),
    ("o8", "l1", "u4", "2024-01-06", False, "D", "7.00", 1),
]
TRAP_OPTIONS = [("o1", "l1", "x", "1.00", 1), ("o1", "l1", "y", "2.00", 1), ("o4", "l1", "x", "0.00", 1)]


def trap_sales(spark):
    from tavola.plans import clean as C
    items = C.clean_order_items(items_frame(spark, TRAP_ITEMS))
    options = C.clean_order_item_options(options_frame(spark, TRAP_OPTIONS))
    return C.sales_fact(items, options)
