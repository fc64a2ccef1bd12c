"""Sources (parquet fixtures, JSON lines) and sinks (tab text, Parquet)."""

from affinity.sources.fixtures import (
    BOT_THRESHOLD,
    dest_items,
    item_item_signals,
    metadata_tpch,
    read_table,
    signals_events,
    signals_tpch,
    signals_union,
    source_items,
)
from affinity.sources.json_io import (
    INVENTORY_SCHEMA,
    PURCHASE_SCHEMA,
    Quarantine,
    TooManyBadLines,
    WISHLIST_SCHEMA,
    inventory_in_stock,
    inventory_metadata,
    load_inventory,
    load_purchases,
    load_wishlists,
    purchase_signals,
    wishlist_signals,
)
from affinity.sources.sinks import load_text, store_parquet, store_text, write_parquet, write_text
