"""Derived tables that several plans share (built once per table set)."""

from __future__ import annotations

from aislekit.operators import history as D
from aislekit.operators import inventory as I
from aislekit.operators.sequence import may_be_hot


def _memo(t, key, fn):
    if key not in t._frames:
        t._frames[key] = fn()
    return t._frames[key]


def lifecycles(t):
    """product_lifecycles: SCD2 versions from lifecycle changes."""
    return _memo(t, "__lifecycles", lambda: D.scd2(t.view("lifecycle_changes")))


def hot_stock(t):
    """Whether a store's product may have so many movements that its history has to be split by month."""
    return _memo(t, "__hot_stock", lambda: may_be_hot(t.lineitem, ["l_suppkey", "l_partkey"]))


def hot_clicks(t):
    """Whether a session or a customer may have so many clicks that its sequence has to be split by time."""
    return _memo(t, "__hot_clicks", lambda: any(may_be_hot(t.view("clickstreams"), [k]) for k in ("session_id", "customer_id")))


def ledger(t):
    """inventory ledger with stock_after."""
    return _memo(t, "__ledger", lambda: I.stock_ledger(t.view("inventory_change_events"), split=hot_stock(t)))


def snapshots(t):
    """sparse stock snapshots."""
    return _memo(t, "__snapshots", lambda: I.sparse_changes(ledger(t), hot_stock(t)))


def cut(t, key, fn):
    """A derived table written once to the shared folder: what reads it plans against a scan, not against its whole history."""
    from aislekit.sources.io import shared_path

    def write():
        df = fn()
        path = shared_path(t.spark, "derived")
        df.write.mode("overwrite").parquet(path)
        return t.spark.read.schema(df.schema).parquet(path)
    return _memo(t, key, write)
