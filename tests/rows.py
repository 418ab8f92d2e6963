"""Small literal tables for unit tests."""

from datetime import date
from decimal import Decimal

from tieout.schemas import BANK_FEED, LEDGER, LINES, RESPONSES


def d(text):
    return None if text is None else Decimal(str(text))


def order(order_id, amount="1000.00", refund=None, rate="0.0200"):
    refunded = None if refund is None else date(2026, 1, 7)
    return (order_id, "CUST-1", d(amount), date(2026, 1, 5), d(refund), refunded, d(rate))


def line(order_id, fee="20.00", gst="3.60", refund="0.00", net="976.40", txn=None, batch="B1"):
    txn = txn or f"T-{order_id}"
    return (txn, order_id, d("1000.00"), d(fee), d(gst), d(refund), d(net), "U1", batch)


def ledger_df(spark, *rows):
    return spark.createDataFrame(list(rows), LEDGER)


def lines_df(spark, *rows):
    # null figures are wanted in some cases
    loose = LINES.fromJson(LINES.jsonValue())
    for field in loose.fields:
        field.nullable = True
    return spark.createDataFrame(list(rows), loose)


def bank_df(spark, *rows):
    full = [(utr, d(amount), date(2026, 1, 7), batch) for utr, amount, batch in rows]
    return spark.createDataFrame(full, BANK_FEED)


def replies_df(spark, *rows):
    full = [(o, a, text, ms, "m", "p") for o, a, text, ms in rows]
    return spark.createDataFrame(full, RESPONSES)
