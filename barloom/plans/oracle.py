"""DuckDB SQL for every registered query, written apart from the Spark operators.

Window plans and size checks on the Spark side are answered here by plain
correlated subqueries and joins over the same derived views.
"""

from __future__ import annotations

from barloom.plans.derived import with_clause

_NUMBERS = "PREV_CLOSE OPEN_PRICE HIGH_PRICE LOW_PRICE LAST_PRICE CLOSE_PRICE AVG_PRICE".split()
_PRICE_COLUMNS = [*_NUMBERS, "TTL_TRD_QNTY", "TURNOVER_LACS", "NO_OF_TRADES", "DELIV_QTY", "DELIV_PER"]
_INTEGERS = {"TTL_TRD_QNTY", "NO_OF_TRADES", "DELIV_QTY"}
_KEY = "SYMBOL, SERIES, DATE1"


def _parsed(view: str, lenient: bool = False) -> str:
    amount = r"\b(?:rs|re)\.?\s*(\d[\d,]*(?:\.\d+)?)" if lenient else r"rs?\s*(\d+(?:\.\d+)?)"
    face = r"\b(?:rs|re)\.?\s*(\d+(?:\.\d+)?)\D*?\bto\b\D*?(?:rs|re)\.?\s*(\d+(?:\.\d+)?)"

    def number(pattern: str, group: int) -> str:
        return f"try_cast(replace(regexp_extract(p, '{pattern}', {group}), ',', '') as double)"

    def ratio(group: int) -> str:
        return number(r"(\d+):(\d+)", group)

    def split(group: int) -> str:
        return f"coalesce({ratio(group)}, {number(face, group)})" if lenient else ratio(group)

    def value(kind: str, expr: str, default: str) -> str:
        return f"cast(coalesce(case when action_type = '{kind}' then {expr} end, {default}) as double)"

    return f"""
    classified as (
      select upper(trim(SYMBOL)) as symbol, EX_DATE as ex_date, lower(PURPOSE) as p,
        case when lower(PURPOSE) like '%dividend%' then 'dividend' when lower(PURPOSE) like '%bonus%' then 'bonus'
             when lower(PURPOSE) like '%split%' then 'split' when lower(PURPOSE) like '%rights%' then 'rights'
             else trim(regexp_replace(lower(PURPOSE), '\\s+', ' ', 'g')) end as action_type
      from {view}),
    actions as (
      select symbol, ex_date, action_type,
        {value('dividend', number(amount, 1), '0')} as dividend_amount,
        {value('bonus', ratio(1), '0')} as bonus_ratio_from, {value('bonus', ratio(2), '0')} as bonus_ratio_to,
        {value('split', split(1), '1')} as split_ratio_from, {value('split', split(2), '1')} as split_ratio_to
      from classified)"""


_UNIQUE = """
    unique_actions as (
      select symbol, ex_date, action_type, dividend_amount, bonus_ratio_from, bonus_ratio_to,
             split_ratio_from, split_ratio_to
      from (select *, row_number() over (partition by symbol, ex_date, action_type order by dividend_amount,
              bonus_ratio_from, bonus_ratio_to, split_ratio_from, split_ratio_to) as rn from actions) u
      where rn = 1)"""


def _multipliers(prices: str, actions: str = "actions") -> str:
    return f"""
    one_close as (
      select SYMBOL, DATE1, CLOSE_PRICE from (
        select *, row_number() over (partition by SYMBOL, DATE1 order by
            case SERIES when 'EQ' then 0 when 'BE' then 1 else 2 end, SERIES) as rn from {prices}) q
      where rn = 1),
    with_prev as (
      select a.*, (select arg_max(b.CLOSE_PRICE, b.DATE1) from one_close b
                   where b.SYMBOL = a.symbol and b.DATE1 < a.ex_date) as prev_close
      from {actions} a),
    mult as (
      select symbol, ex_date,
        case when action_type = 'dividend' and prev_close > 0 and dividend_amount > 0
               then (prev_close - dividend_amount) / prev_close
             when action_type = 'split' and split_ratio_from > 0 then split_ratio_to / split_ratio_from
             when action_type = 'bonus' and bonus_ratio_from + bonus_ratio_to > 0
               then bonus_ratio_to / (bonus_ratio_from + bonus_ratio_to)
             else 1.0 end as m
      from with_prev),
    factors as (
      select b.SYMBOL, b.DATE1, product(x.m) as factor
      from one_close b join mult x on x.symbol = b.SYMBOL and x.ex_date > b.DATE1 and x.m > 0
      group by b.SYMBOL, b.DATE1)"""


def _adjusted(
    prices: str, raw: str, columns: str, actions: str = "actions", where: str = "", scale: str = "1e6"
) -> str:
    extra = _UNIQUE + "," if actions == "unique_actions" else ""
    return f"""
    with {with_clause(prices, raw)}, {_parsed(raw)}, {extra} {_multipliers(prices, actions)}
    select {columns}, round_even(p.CLOSE_PRICE * coalesce(f.factor, 1) * {scale}, 0) / {scale} as ADJ_CLOSE_PRICE
    from {prices} p left join factors f on p.SYMBOL = f.SYMBOL and p.DATE1 = f.DATE1 {where}"""


_BAR_COLUMNS = "p.SYMBOL, p.SERIES, p.DATE1, p.OPEN_PRICE, p.HIGH_PRICE, p.LOW_PRICE, p.CLOSE_PRICE, p.TTL_TRD_QNTY"
_BUILDING = "select concat('S', c_custkey) from customer where c_mktsegment = 'BUILDING'"


def _adjusted_bars(actions: str = "actions", where: str = "") -> str:
    return _adjusted("bars", "ca_raw", _BAR_COLUMNS, actions, where)


# All sixteen columns of the adjusted price table.
_MARKET_COLUMNS = ", ".join(f"p.{c}" for c in ["SYMBOL", "SERIES", "DATE1", *_PRICE_COLUMNS])
_MULTI_SERIES = _adjusted("market", "ca_market", _MARKET_COLUMNS, scale="100.0")


def _previous(value: str) -> str:
    return f"""
    with {with_clause('bars', 'ca_raw')}, {_parsed('ca_raw')},
    events as (select distinct symbol, ex_date from actions)
    select e.symbol, e.ex_date, {value} from events e join bars b on b.SYMBOL = e.symbol and b.DATE1 < e.ex_date
    group by e.symbol, e.ex_date"""



def _double(expr: str) -> str:
    return f"try_cast(trim({expr}) as double)"


def _long(expr: str) -> str:
    return f"cast({_double(expr)} as bigint)"


def _date(expr: str) -> str:
    return f"cast(try_strptime(trim({expr}), '%d-%b-%Y') as date)"


_KEYED = "SYMBOL <> '' and SERIES <> ''"
_TEXT_KEY = "coalesce(trim(SYMBOL), '') as SYMBOL, coalesce(trim(SERIES), '') as SERIES"

_LEGACY = f"""
    legacy as (
      select distinct * from (
        select {_TEXT_KEY}, {_date('TIMESTAMP')} as DATE1, {_double('PREVCLOSE')} as PREV_CLOSE,
          {_double('OPEN')} as OPEN_PRICE, {_double('HIGH')} as HIGH_PRICE, {_double('LOW')} as LOW_PRICE,
          {_double('LAST')} as LAST_PRICE, {_double('CLOSE')} as CLOSE_PRICE,
          case when {_double('TOTTRDQTY')} <> 0 then {_double('TOTTRDVAL')} / {_double('TOTTRDQTY')} end as AVG_PRICE,
          {_long('TOTTRDQTY')} as TTL_TRD_QNTY, {_double('TOTTRDVAL')} / 100000.0 as TURNOVER_LACS,
          {_long('TOTALTRADES')} as NO_OF_TRADES
        from legacy_raw) l where {_KEYED})"""

_DELIVERY = f"""
    delivery as (
      select distinct trim(SYMBOL) as SYMBOL, coalesce(nullif(trim(SERIES), ''), 'UNKNOWN') as SERIES,
        cast(coalesce({_long('DELIV_QTY')}, 0) as bigint) as DELIV_QTY,
        coalesce({_double('DELIV_PER')}, 0.0) as DELIV_PER, DATE1
      from delivery_raw)"""


def _full_columns() -> str:
    return ", ".join(f"{_long(c) if c in _INTEGERS else _double(c)} as {c}" for c in _PRICE_COLUMNS)


def _full_rows(source: str) -> str:
    return f"select {_TEXT_KEY}, {_date('DATE1')} as DATE1, {_full_columns()} from {source}"


_FULL = f"""
    full_any as (select * from ({_full_rows('(select distinct * from full_raw) d')}) f where {_KEYED}),
    full_rows as (select * from full_any where DATE1 is not null)"""

_RAW = with_clause("legacy_raw", "delivery_raw", "full_raw")
_ORDER = ", ".join(f"{c} asc nulls last" for c in _PRICE_COLUMNS)


def _first_per_key(source: str, order: str) -> str:
    return f"""select {_KEY}, {', '.join(_PRICE_COLUMNS)} from (
      select *, row_number() over (partition by {_KEY} order by {order}) as rn from ({source}) s) r where rn = 1"""


_MERGED = """
    merged as (select l.*, d.DELIV_QTY, d.DELIV_PER from legacy l left join delivery d
      on l.SYMBOL = d.SYMBOL and l.SERIES = d.SERIES and l.DATE1 = d.DATE1)"""


def _union_all(legacy: str) -> str:
    columns = f"{_KEY}, {', '.join(_PRICE_COLUMNS)}"
    return f"select {columns}, 0 as pr from full_rows union all select {columns}, 1 as pr from {legacy}"


_LEGACY_WIDE = "(select *, cast(null as bigint) as DELIV_QTY, cast(null as double) as DELIV_PER from legacy)"

_DEALS = f"""
    deals as (select Symbol, Date, {_double("replace(Quantity_Traded, ',', '')")} as Quantity_Traded,
      {_double('Trade_Price__Wght_Avg_Price')} as Trade_Price__Wght_Avg_Price from bulk_raw)"""


def _bulk(condition: str = "") -> str:
    averages = ", ".join(f"avg(m.{c}) as {c}" for c in _PRICE_COLUMNS)
    return f"""
    with {with_clause('market', 'bulk_raw')}, {_DEALS},
    report as (
      select d.Symbol, d.Date, sum(d.Quantity_Traded) as Quantity_Traded,
        avg(d.Trade_Price__Wght_Avg_Price) as Trade_Price_Avg_Price, {averages},
        avg(case when m.CLOSE_PRICE > m.OPEN_PRICE then 1 else 0 end) as is_greater,
        avg(case when m.OPEN_PRICE = m.LOW_PRICE then 1 else 0 end) as is_open_equal_low
      from deals d left join market m on d.Symbol = m.SYMBOL and d.Date = m.DATE1 {condition}
      group by d.Symbol, d.Date)"""


_BULK_COLUMNS = ", ".join(
    f"round({c}, 8) as {c}"
    for c in ["Trade_Price_Avg_Price", *_PRICE_COLUMNS, "is_greater", "is_open_equal_low"]
)
_BULK_SELECT = f"select Symbol, Date, Quantity_Traded, {_BULK_COLUMNS} from report"

_CENTS = "round_even({0} * 100, 0) / 100"


def _comparison(where: str = "") -> str:
    return f"""
    with {with_clause('bars', 'ref_prices')},
    cmp as (
      select b.SYMBOL, b.DATE1, b.CLOSE_PRICE, {_CENTS.format('b.CLOSE_PRICE')} as ADJ_CLOSE,
        {_CENTS.format('r.AdjClose')} as ADJ_CLOSE_yfin,
        abs({_CENTS.format('r.AdjClose')} - {_CENTS.format('b.CLOSE_PRICE')}) as adj_close_diff
      from bars b join ref_prices r on b.SYMBOL = r.SYMBOL and b.DATE1 = r.DATE1 {where})"""


_SHOWN = "SYMBOL, DATE1, ADJ_CLOSE, ADJ_CLOSE_yfin, adj_close_diff"


def _listed(view: str, symbol: str, name: str, isin: str) -> str:
    return f"""(select * from (select *, row_number() over (partition by isin order by symbol asc nulls last,
        name asc nulls last) as rn from (
          select trim(replace(replace({symbol}, '#', ''), '.', '')) as symbol, {name} as name, trim({isin}) as isin
          from {view}) a where isin is not null and isin <> '') b where rn = 1)"""


_MASTER = f"""
    with {with_clause('nse_list', 'bse_list')},
    master as (
      select case when b.isin is null then ' ' else b.symbol end as BSE_SYMBOL,
        case when n.isin is null then ' ' else n.symbol end as NSE_SYMBOL,
        coalesce(nullif(n.name, ''), b.name) as COMPANY_NAME, coalesce(n.isin, b.isin) as ISIN
      from {_listed('nse_list', 'SYMBOL', 'NAME_OF_COMPANY', 'ISIN_NUMBER')} n
      full outer join {_listed('bse_list', 'Security_Id', 'Security_Name', 'ISIN_No')} b on n.isin = b.isin)"""
_MASTER_KEY = "case when NSE_SYMBOL = ' ' then 'zzz' else NSE_SYMBOL end"


def _candidates(exchange: str, suffix: str, source: str = "master") -> str:
    column = f"{exchange}_SYMBOL"
    return f"""{_MASTER}
    select trim({column}) as symbol, COMPANY_NAME, '{exchange}' as exchange,
      concat(trim({column}), '{suffix}') as ticker
    from {source} m where {column} is not null and {column} <> '' and length(trim({column})) >= 2"""


_HISTORY = f"with {with_clause('history')}"
_CHECKED = f"""{_HISTORY},
    checked as (
      select exchange, symbol, count(*) as rows, min(cast(date as date)) as first_date,
        case when count(*) < 27 then 'insufficient_data' end as reason
      from history group by exchange, symbol)"""

_AUDITED = [*_NUMBERS, "TURNOVER_LACS", "DELIV_PER", "TTL_TRD_QNTY", "NO_OF_TRADES", "DELIV_QTY"]


def _audit() -> str:
    kept = "coalesce(trim(SYMBOL), '') <> '' and coalesce(trim(SERIES), '') <> ''"

    def bad(c: str) -> str:
        return f"count(*) filter ({kept} and trim({c}) <> '' and {_double(c)} is null) as bad_{c.lower()}"

    return f"""
    with {with_clause('full_raw')}
    select count(*) as rows_read, count(*) filter (coalesce(trim(SYMBOL), '') = '') as empty_symbol,
      count(*) filter (coalesce(trim(SERIES), '') = '') as empty_series, count(*) filter ({kept}) as rows_kept,
      count(*) filter ({kept} and {_date('DATE1')} is null) as bad_dates, {', '.join(bad(c) for c in _AUDITED)}
    from full_raw"""


def _quotes(symbol: str, prefix: str) -> str:
    return f"""select '{symbol}' as SYMBOL, Date as DATE1, {prefix}_close as Close, {prefix}_adj as AdjClose
      from quotes_by_day where {prefix}_close is not null"""



def _weekdays(first: str, last: str) -> str:
    return f"""with {with_clause('loaded_days')},
    days as (select cast(d as date) as DATE1
             from (select unnest(generate_series({first}, {last}, interval 1 day)) as d) g where isodow(d) < 6)
    select DATE1 from days"""


_FIRST, _LAST = "(select min(DATE1) from loaded_days)", "(select max(DATE1) from loaded_days)"
_NOT_LOADED = " where DATE1 not in (select DATE1 from loaded_days)"

ORACLE: dict[str, str] = {
    "adjusted_prices": _adjusted_bars(),
    "adjusted_prices_by_days": _adjusted_bars(),
    "adjusted_prices_by_steps": _adjusted_bars(),
    "adjusted_prices_deduped": _adjusted_bars("unique_actions"),
    "adjusted_prices_of_symbols": _adjusted_bars(where=f"where p.SYMBOL in ({_BUILDING})"),
    "adjusted_prices_multi_series": _MULTI_SERIES,
    "adjusted_prices_multi_series_by_days": _MULTI_SERIES,
    "previous_closes": _previous("arg_max(b.CLOSE_PRICE, b.DATE1) as prev_close"),
    "previous_closes_by_steps": _previous("arg_max(b.CLOSE_PRICE, b.DATE1) as prev_close"),
    "previous_trade_dates": _previous("max(b.DATE1) as trade_date"),
    "adjustment_impact": f"""
    with {with_clause('bars', 'ca_raw')}, {_parsed('ca_raw')}, {_multipliers('bars')},
    change as (
      select round((p.CLOSE_PRICE * coalesce(f.factor, 1) / nullif(p.CLOSE_PRICE, 0) - 1) * 100, 8) as pct
      from bars p left join factors f on p.SYMBOL = f.SYMBOL and p.DATE1 = f.DATE1)
    select min(pct) as max_price_adjustment, count(*) filter (pct <> 0) as rows_adjusted from change""",
    "parse_actions": f"with {with_clause('ca_raw')}, {_parsed('ca_raw')} select * from actions",
    "parse_actions_lenient": f"with {with_clause('ca_raw')}, {_parsed('ca_raw', True)} select * from actions",
    "unique_actions": f"with {with_clause('ca_raw')}, {_parsed('ca_raw')}, {_UNIQUE} select * from unique_actions",
    "price_actions": f"""with {with_clause('ca_raw')}, {_parsed('ca_raw')}
    select * from actions where action_type in ('dividend', 'split', 'bonus')""",
    "normalize_legacy": f"with {_RAW}, {_LEGACY} select * from legacy",
    "normalize_delivery": f"with {_RAW}, {_DELIVERY} select * from delivery",
    "normalize_full": f"with {_RAW}, {_FULL} select * from full_any",
    "clean_exchange_nse": f"with {_RAW} select * from ({_full_rows('full_raw')}) f where {_KEYED}",
    "clean_exchange_bse": f"""
    with {with_clause('bse_raw')}
    select SC_CODE, SC_NAME, {_double('OPEN')} as OPEN, {_double('HIGH')} as HIGH, {_double('LOW')} as LOW,
      {_double('CLOSE')} as CLOSE, {_long('NO_OF_SHRS')} as NO_OF_SHRS, {_long('NO_TRADES')} as NO_TRADES, DATE1,
      trim(SC_CODE) as SYMBOL, trim(SC_NAME) as COMPANY_NAME from bse_raw""",
    "merge_delivery": f"with {_RAW}, {_LEGACY}, {_DELIVERY}, {_MERGED} select * from merged",
    "consolidate": f"with {_RAW}, {_LEGACY}, {_FULL} "
    + _first_per_key(_union_all(_LEGACY_WIDE), f"pr, {_ORDER}"),
    "price_table": f"with {_RAW}, {_LEGACY}, {_DELIVERY}, {_MERGED}, {_FULL} "
    + _first_per_key(_union_all("merged"), f"pr, {_ORDER}"),
    "incremental_append": f"with {_RAW}, {_LEGACY}, {_FULL} "
    + _first_per_key(
        """select * from full_rows f where not exists (select 1 from legacy l
      where l.SYMBOL = f.SYMBOL and l.SERIES = f.SERIES and l.DATE1 = f.DATE1)""",
        _ORDER,
    ),
    "insert_ignore_actions": f"""with {with_clause('ca_raw')}, {_parsed('ca_raw')}, {_UNIQUE}
    select * from unique_actions where action_type <> 'dividend'""",
    "dataset_summary": f"""with {with_clause('market')}
    select count(*) as total_records, min(DATE1) as earliest_date, max(DATE1) as latest_date,
      count(distinct SYMBOL) as unique_symbols, count(distinct SERIES) as unique_series from market""",
    "date_range": f"""with {with_clause('market')}
    select min(DATE1) as first_date, max(DATE1) as last_date from market""",
    "high_water_mark": f"""with {with_clause('market')}
    select max(DATE1) as last_date, max(DATE1) + 1 as next_date from market""",
    "distinct_symbols": f"with {with_clause('market')} select count(distinct SYMBOL) as symbols from market",
    "duplicate_count": f"""with {with_clause('file_rows')}
    select count(*) as total_rows, count(*) - (select count(*) from (select distinct * from file_rows) d)
      as duplicate_rows from file_rows""",
    "duplicate_sources": f"""with {with_clause('file_rows')},
    totals as (select {_KEY}, count(*) as rows_total, count(distinct SOURCE_FILE) as sources
      from file_rows group by {_KEY} having count(*) > 1)
    select {_KEY}, SOURCE_FILE, count(*) as rows_in_source, max(rows_total) as rows_total, max(sources) as sources
    from file_rows join totals using ({_KEY}) group by {_KEY}, SOURCE_FILE""",
    "ingest_audit": _audit(),
    "files_delivery": f"with {_RAW}, {_DELIVERY} select * from delivery",
    "files_reject_report": f"""
    with {with_clause('full_raw')}
    select case when coalesce(trim(SYMBOL), '') = '' or coalesce(trim(SERIES), '') = '' then 'blank key'
                else 'unreadable date' end as reason, count(*) as rows
    from full_raw
    where coalesce(trim(SYMBOL), '') = '' or coalesce(trim(SERIES), '') = '' or {_date('DATE1')} is null group by 1""",
    "coverage_report": f"""with {with_clause('market', 'ca_raw', 'bulk_raw')}
    select count(*) as total_records, min(DATE1) as earliest_date, max(DATE1) as latest_date,
      count(distinct SYMBOL) as unique_symbols, (select count(*) from ca_raw) as corporate_actions,
      (select count(*) from bulk_raw) as bulk_deals from market""",
    "business_days_of": _weekdays(_FIRST, _LAST),
    "missing_dates": _weekdays(_FIRST, _LAST) + _NOT_LOADED,
    "missing_dates_in_range": _weekdays("date '1994-12-01'", "date '2001-08-31'") + _NOT_LOADED,
    "next_load_days": _weekdays(f"{_LAST} + 1", "date '2001-09-30'"),
    "wide_to_long": f"""with {with_clause('quotes_by_day')}
    {_quotes('VIEW', 'view')} union all {_quotes('CLICK', 'click')} union all {_quotes('ERROR', 'error')}""",
    "compare_prices": f"{_comparison()} select * from cmp",
    "compare_prices_in_range": _comparison(
        f"where b.SYMBOL in ({_BUILDING}) and b.DATE1 between date '2024-01-10' and date '2024-01-20'"
    )
    + " select * from cmp",
    "accuracy": f"""{_comparison()}
    select count(*) as total_records, count(*) filter (adj_close_diff = 0) as matches,
      count(*) filter (adj_close_diff = 0) / count(*) * 100 as accuracy_pct from cmp""",
    "top_mismatches": f"""{_comparison()}
    select {_SHOWN} from cmp where adj_close_diff > 0
    order by adj_close_diff desc, SYMBOL, DATE1, ADJ_CLOSE, ADJ_CLOSE_yfin limit 10""",
    "sample_matches": f"""{_comparison()}
    select {_SHOWN} from cmp where adj_close_diff = 0 order by SYMBOL, DATE1, ADJ_CLOSE limit 10""",
    "clean_bulk_deals": f"with {with_clause('bulk_raw')}, {_DEALS} select * from deals",
    "bulk_with_prices": f"{_bulk()} {_BULK_SELECT}",
    "bulk_with_prices_shuffled": f"{_bulk()} {_BULK_SELECT}",
    "bulk_with_prices_one_series": _bulk("and m.SERIES = 'EQ'") + _BULK_SELECT,
    "bulk_sentiment": f"""{_bulk()}
    select round(avg(is_greater), 8) as positive_sentiment, round(avg(is_open_equal_low), 8) as strong_openings,
      round(avg(Quantity_Traded / nullif(TTL_TRD_QNTY, 0)), 8) as avg_volume_impact from report""",
    "price_premium": f"""{_bulk()}
    select Symbol, Date, round(Trade_Price_Avg_Price / nullif(CLOSE_PRICE, 0) - 1, 8) as price_premium from report""",
    "security_master": f"{_MASTER} select * from master",
    "master_coverage": f"""{_MASTER}
    select count(*) as total, count(*) filter (BSE_SYMBOL <> ' ' and NSE_SYMBOL <> ' ') as both_exchanges,
      count(*) filter (BSE_SYMBOL = ' ' and NSE_SYMBOL <> ' ') as nse_only,
      count(*) filter (BSE_SYMBOL <> ' ' and NSE_SYMBOL = ' ') as bse_only from master""",
    "master_first_rows": f"{_MASTER} select * from master order by {_MASTER_KEY}, ISIN limit 10",
    "master_last_rows": f"{_MASTER} select * from master order by {_MASTER_KEY} desc, ISIN desc limit 10",
    "candidates_nse": _candidates("NSE", ".NS"),
    "candidates_bse": _candidates("BSE", ".BO"),
    "candidates_bse_limited": _candidates(
        "BSE", ".BO", f"(select * from master where BSE_SYMBOL <> '' order by {_MASTER_KEY}, ISIN limit 50)"
    ),
    "history_ohlcv": f"""{_HISTORY}
    select exchange, symbol, date, open, high, low, close, adj_close, volume from history""",
    "extract_actions": f"""{_HISTORY}
    select exchange, symbol, date, dividends, stock_splits from history where dividends <> 0 or stock_splits <> 0""",
    "completeness_check": f"{_CHECKED} select * from checked",
    "missing_histories": f"""{_HISTORY},
    listed as (select case when c_custkey % 2 = 0 then 'NSE' else 'BSE' end as exchange,
      concat('S', c_custkey) as symbol from customer)
    select l.exchange, l.symbol, 'delisted_or_no_data' as reason from listed l
    where not exists (select 1 from history h where h.exchange = l.exchange and h.symbol = l.symbol)""",
    "quality_report": f"""{_CHECKED}
    select symbol, exchange, reason, concat('Only ', rows, ' rows') as details
    from checked where reason is not null""",
    "history_counts": f"""{_HISTORY}
    select exchange, symbol, count(*) as ohlcv_rows,
      count(*) filter (dividends <> 0 or stock_splits <> 0) as div_split_rows
    from history group by exchange, symbol""",
    "history_summary": f"""{_CHECKED},
    acted as (select distinct exchange, symbol from history where dividends <> 0 or stock_splits <> 0)
    select exchange, 'ohlcv' as kind, count(*) as n from checked group by exchange
    union all select exchange, 'div_stock_split', count(*) from acted group by exchange
    union all select null, 'skipped', count(*) from checked where reason is not null
    union all select null, 'failed', count(*) from checked where reason = 'file_read_error'""",
    "files_full_prices": f"with {_RAW}, {_FULL} select * from full_any",
    "files_legacy_prices": f"with {_RAW}, {_LEGACY} select * from legacy",
    "files_actions": f"with {with_clause('ca_raw')}, {_parsed('ca_raw')} select * from actions",
    "files_bulk_deals": f"with {with_clause('bulk_raw')}, {_DEALS} select * from deals",
    "files_security_master": f"{_MASTER} select * from master",
    "store_prices_in_range": f"""with {with_clause('market')}
    select * from market where DATE1 between date '1996-06-01' and date '1999-02-28'""",
    "store_prices_appended": f"with {_RAW}, {_LEGACY}, {_FULL}, held as ("
    + _first_per_key(_LEGACY_WIDE, _ORDER)
    + f"""), added as ({_first_per_key("select * from full_rows", _ORDER)})
    select * from held union all
    select * from added f where not exists (select 1 from held l
      where l.SYMBOL = f.SYMBOL and l.SERIES = f.SERIES and l.DATE1 = f.DATE1)""",
    "store_actions_by_key": f"""with {with_clause('ca_raw')}, {_parsed('ca_raw')}, {_UNIQUE}
    select * from unique_actions where action_type in ('dividend', 'split', 'bonus')""",
    "stream_full_prices_loaded": f"with {_RAW}, {_FULL} " + _first_per_key("select * from full_rows", _ORDER),
    "stream_reject_report": f"""
    with {with_clause('full_raw')}
    select case when coalesce(trim(SYMBOL), '') = '' or coalesce(trim(SERIES), '') = '' then 'blank key'
                else 'unreadable date' end as reason, cast(count(*) as bigint) as rows
    from full_raw
    where coalesce(trim(SYMBOL), '') = '' or coalesce(trim(SERIES), '') = '' or {_date('DATE1')} is null group by 1""",
    "files_histories_check": f"""{_HISTORY},
    counted as (
      select exchange, symbol, cast(substr(symbol, 2) as bigint) % 5 as k, count(*) as n, min(cast(date as date)) as first_date
      from history group by exchange, symbol),
    listed as (select case when c_custkey % 2 = 0 then 'NSE' else 'BSE' end as exchange,
      concat('S', c_custkey) as symbol from customer)
    select l.exchange, l.symbol, case when k = 2 then 0 else n end as rows,
      case when k not in (2, 3) then first_date end as first_date,
      case when k is null then 'delisted_or_no_data' when k = 1 then 'invalid_columns'
           when k = 2 or n < 27 then 'insufficient_data' when k = 3 then 'file_read_error' end as reason
    from listed l left join counted c using (exchange, symbol)""",
    "files_histories_roundtrip": f"""{_HISTORY}
    select exchange, symbol, 'ohlcv' as kind, date, open, high, low, close, adj_close, cast(volume as double) as volume,
      cast(null as double) as dividends, cast(null as double) as stock_splits from history
    union all
    select exchange, symbol, 'div_stock_split', date, null, null, null, null, null, null, dividends, stock_splits
    from history where dividends <> 0 or stock_splits <> 0""",
    "store_skip_log": f"""{_HISTORY},
    counted as (select exchange, symbol, count(*) as n from history group by exchange, symbol),
    runs as (select 'first' as run_id, 27 as least union all select 'second/again', 30)
    select symbol, exchange, 'insufficient_data' as reason, concat('Only ', n, ' rows') as details, run_id
    from counted, runs where n < least""",
    "table_prices_bucketed": f"""with {with_clause('market')}
    select SYMBOL, SERIES, DATE1, CLOSE_PRICE from (
      select *, row_number() over (partition by SYMBOL order by DATE1 desc, SERIES) as rn from market) r where rn = 1""",
    "table_deals_replaced": f"with {with_clause('bulk_raw')}, {_DEALS} select * from deals",
    "summary_by_sketch": f"""with {with_clause('market')}
    select cast(year(DATE1) as int) as "YEAR", count(*) as rows, min(DATE1) as first_day, max(DATE1) as last_day,
      count(distinct SYMBOL) as exact_symbols, count(distinct DATE1) as exact_days, true as symbols_close, true as days_close
    from market group by 1""",
    "files_prices_in_order": f"""with {with_clause('market')}
    select row_number() over (order by DATE1, SYMBOL, SERIES) as position, DATE1, SYMBOL, SERIES, CLOSE_PRICE from market""",
    "files_bulk_in_order": f"""with {with_clause('bulk_raw')}, {_DEALS}
    select row_number() over (order by Date nulls first, Symbol nulls first, Quantity_Traded nulls first,
      Trade_Price__Wght_Avg_Price nulls first) as position, Date, Symbol, Quantity_Traded, Trade_Price__Wght_Avg_Price from deals""",
    "files_security_lists": f"{_MASTER} select * from master",
    "files_bse_prices": f"""
    with {with_clause('bse_raw')}
    select trim(SC_CODE) as SC_CODE, trim(SC_NAME) as SC_NAME, {_double('OPEN')} as OPEN, {_double('HIGH')} as HIGH,
      {_double('LOW')} as LOW, {_double('CLOSE')} as CLOSE, {_long('NO_OF_SHRS')} as NO_OF_SHRS,
      {_long('NO_TRADES')} as NO_TRADES, cast(date_trunc('month', DATE1) as date) + 7305 as DATE1, trim(SC_CODE) as SYMBOL, trim(SC_NAME) as COMPANY_NAME
    from bse_raw""",
    "legacy_date_forms": """
    select l_orderkey, l_linenumber, case when l_linenumber % 4 < 3 then cast(l_shipdate as date) end as day from lineitem""",
}
