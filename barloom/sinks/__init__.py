"""Writers of stored tables, exports and reports."""

from barloom.sinks.exports import append_log, append_report, comparison_path, export_csv, export_histories, export_in_order, read_log
from barloom.sinks.tables import (
    append_ignore,
    append_prices,
    create_if_absent,
    replace_keyed_table,
    replace_table,
    write_keyed_table,
    write_prices,
)

__all__ = [
    "append_ignore",
    "append_log",
    "append_prices",
    "append_report",
    "comparison_path",
    "create_if_absent",
    "export_csv",
    "export_histories",
    "read_log",
    "export_in_order",
    "replace_keyed_table",
    "replace_table",
    "write_keyed_table",
    "write_prices",
]
