"""Readers, writers, table registry and the star-schema adapter."""

from lateparcel.sources.starschema import load_customers, load_order_items, load_orders
from lateparcel.sources.tables import (
    SCHEMAS,
    TableRegistry,
    pass_through,
    preview,
    read_csv,
    read_table,
    table_profile,
    write_csv,
    write_table,
    write_text_lines,
)

__all__ = [
    "SCHEMAS",
    "TableRegistry",
    "load_customers",
    "load_order_items",
    "load_orders",
    "pass_through",
    "preview",
    "read_csv",
    "read_table",
    "table_profile",
    "write_csv",
    "write_table",
    "write_text_lines",
]
