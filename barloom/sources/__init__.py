"""Readers of raw files, lists and stored tables."""

from barloom.sources.files import layouts, read_csv_by_name, skipped_files
from barloom.sources.history import history_files, read_histories
from barloom.sources.lists import (
    read_actions,
    read_bulk_deals,
    read_securities,
    read_security_list,
)
from barloom.sources.prices import (
    delivery_rejects,
    read_bse_prices,
    read_delivery,
    read_full_prices,
    read_legacy_prices,
)
from barloom.sources.tables import read_action_table, read_prices

__all__ = [
    "delivery_rejects",
    "layouts",
    "read_action_table",
    "read_actions",
    "read_bse_prices",
    "read_bulk_deals",
    "read_csv_by_name",
    "read_delivery",
    "read_full_prices",
    "read_histories",
    "read_legacy_prices",
    "read_prices",
    "read_securities",
    "read_security_list",
    "skipped_files",
]
