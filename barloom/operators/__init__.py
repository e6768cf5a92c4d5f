"""DataFrame-to-DataFrame operators over end-of-day market data."""

from barloom.operators.actions import parse_actions, price_actions, unique_actions
from barloom.operators.adjust import (
    adjusted_prices,
    adjustment_impact,
    previous_closes,
    previous_trade_dates,
)
from barloom.operators.bulk import (
    bulk_sentiment,
    bulk_with_prices,
    clean_bulk_deals,
    ordered_result,
    price_premium,
)
from barloom.operators.calendar import business_days, business_days_of, missing_dates, next_load_days
from barloom.operators.compare import accuracy, compare_prices, sample_matches, top_mismatches
from barloom.operators.consolidate import (
    consolidate,
    incremental_append,
    insert_ignore,
    merge_delivery,
    ordered_prices,
    price_table,
)
from barloom.operators.dedupe import distinct_rows, keep_first, new_keys
from barloom.operators.history import (
    check_history_files,
    clean_history,
    completeness_check,
    extract_actions,
    failed_report,
    history_counts,
    history_summary,
    missing_histories,
    ohlcv,
    quality_report,
)
from barloom.operators.master import (
    first_rows,
    last_rows,
    master_coverage,
    ordered_master,
    security_master,
    select_candidates,
)
from barloom.operators.normalize import (
    clean_exchange,
    normalize_delivery,
    normalize_full,
    normalize_legacy,
)
from barloom.operators.quality import (
    coverage_report,
    dataset_summary,
    date_range,
    distinct_symbols,
    duplicate_count,
    duplicate_sources,
    high_water_mark,
    ingest_audit,
    merge_summaries,
    rejects,
    summary_counts,
    yearly_summary,
)
from barloom.operators.positions import numbered, running
from barloom.operators.wide import wide_to_long

__all__ = [name for name in dir() if not name.startswith("_")]
