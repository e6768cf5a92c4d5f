"""Market-shaped views over the test tables, in SQL that Spark and DuckDB both run.

Every view reads its whole table. ``{name}`` stands for a table or an earlier view.
The raw views mimic the text files: padded keys, upper-case months, commas,
blanks, dashes for missing numbers.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_DAY = "cast(l_shipdate as date)"
_PRICE = "l_extendedprice / l_quantity"
_SEQ = "l_orderkey * 10 + l_linenumber"
_SERIES = "case l_returnflag when 'A' then 'EQ' when 'R' then 'BE' else 'N1' end"


def _dmy(day: str) -> str:
    """``05-Mar-1998`` of a date expression."""
    iso = f"cast({day} as string)"
    month = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * month({day}) - 2, 3)"
    return f"concat(substr({iso}, 9, 2), '-', {month}, '-', substr({iso}, 1, 4))"


# The full format starts a year later than the first one, so some keys are in both.
_FULL_DAY = f"({_DAY} + 365)"

VIEWS: dict[str, str] = {
    # One series, one row per symbol and day.
    "bars": """
        select concat('S', cast(user_id as string)) as SYMBOL, 'EQ' as SERIES, cast(ts as date) as DATE1,
               min_by(value, ts) as OPEN_PRICE, max(value) as HIGH_PRICE, min(value) as LOW_PRICE,
               max_by(value, ts) as CLOSE_PRICE, count(*) as TTL_TRD_QNTY
        from {events} group by user_id, cast(ts as date)""",
    # Up to three series per symbol and day, all price columns.
    "market": f"""
        select concat('P', cast(l_suppkey as string)) as SYMBOL, {_SERIES} as SERIES, {_DAY} as DATE1,
               min_by({_PRICE}, {_SEQ}) as PREV_CLOSE, min_by({_PRICE}, {_SEQ}) as OPEN_PRICE,
               max({_PRICE}) as HIGH_PRICE, min({_PRICE}) as LOW_PRICE, max_by({_PRICE}, {_SEQ}) as LAST_PRICE,
               max_by({_PRICE}, {_SEQ}) as CLOSE_PRICE, (max({_PRICE}) + min({_PRICE})) / 2 as AVG_PRICE,
               cast(sum(l_quantity) as bigint) as TTL_TRD_QNTY, max(l_extendedprice) / 100000 as TURNOVER_LACS,
               count(*) as NO_OF_TRADES, cast(max(l_quantity) as bigint) as DELIV_QTY,
               100 * max(l_quantity) / sum(l_quantity) as DELIV_PER
        from {{lineitem}} group by l_suppkey, l_returnflag, {_DAY}""",
    # Every event is an announcement; what it says depends on its number.
    "ca_raw": """
        select concat(' s', cast(user_id as string), ' ') as SYMBOL, cast(ts as date) as EX_DATE, event_id,
               case when k < 20 then concat('DIVIDEND - RS 0.', cast(1 + user_id % 5 as string), ' PER SHARE')
                    when k < 22 then concat('Bonus ', cast(1 + event_id % 3 as string), ':1')
                    when k < 26 then concat('Stock Split 1:', cast(1 + event_id % 4 as string))
                    when k < 29 then concat('Face Value Split ', cast(1 + event_id % 4 as string), ':1')
                    when k < 50 then 'RIGHTS 1:3 @ RS 100'
                    when k < 65 then 'Dividend - Rs. 5.50'
                    when k < 75 then 'SPLIT FROM RS 10/- TO RS 5/-'
                    when k < 80 then 'Interim Dividend Rs 1,250 And Bonus 2:1'
                    else '  Annual   General Meeting ' end as PURPOSE
        from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from {events}) e""",
    # The same announcements for the symbols and years of ``market``.
    "ca_market": """
        select replace(SYMBOL, 's', 'p') as SYMBOL, EX_DATE - 9000 as EX_DATE, PURPOSE from {ca_raw}""",
    "quotes_by_day": """
        select cast(ts as date) as Date,
               max(case when event_type = 'view' then value end) as view_close,
               min(case when event_type = 'view' then value end) as view_adj,
               max(case when event_type = 'click' then value end) as click_close,
               min(case when event_type = 'click' then value end) as click_adj,
               max(case when event_type = 'error' and value > 200 then value end) as error_close,
               min(case when event_type = 'error' then value end) as error_adj
        from {events} group by cast(ts as date)""",
    "legacy_raw": f"""
        select concat('P', cast(l_suppkey as string), ' ') as SYMBOL,
               case when l_linenumber = 6 and l_linestatus = 'O' then ' ' else {_SERIES} end as SERIES,
               cast({_PRICE} as string) as OPEN, cast({_PRICE} + 1 as string) as HIGH,
               cast({_PRICE} - 1 as string) as LOW, cast({_PRICE} as string) as CLOSE,
               cast({_PRICE} as string) as LAST, case when l_linenumber = 5 then '-' else '10.5' end as PREVCLOSE,
               cast(case when l_linenumber = 7 then 0 else cast(l_quantity as bigint) end as string) as TOTTRDQTY,
               cast(l_extendedprice as string) as TOTTRDVAL, upper({_dmy(_DAY)}) as TIMESTAMP,
               cast(l_linenumber as string) as TOTALTRADES
        from {{lineitem}}""",
    "delivery_raw": f"""
        select '20' as RECORD_TYPE, cast(l_linenumber as string) as SR_NO,
               concat(' P', cast(l_suppkey as string)) as SYMBOL,
               case when l_linenumber = 5 then '' when l_linenumber = 6 then null else {_SERIES} end as SERIES,
               cast(cast(l_quantity as bigint) as string) as QUANTITY_TRADED,
               case when l_linenumber = 3 then null else cast(cast(l_quantity as bigint) as string) end as DELIV_QTY,
               case when l_linenumber = 4 then null else '47.25' end as DELIV_PER, {_DAY} as DATE1
        from {{lineitem}}""",
    "full_raw": f"""
        select concat(' P', cast(l_suppkey as string)) as SYMBOL,
               case when l_linenumber = 6 and l_linestatus = 'O' then null else concat(' ', {_SERIES}) end as SERIES,
               case when l_linenumber = 2 and l_linestatus = 'O' then '31-Feb-2001' else concat(' ', {_dmy(_FULL_DAY)}) end
                   as DATE1,
               cast({_PRICE} as string) as PREV_CLOSE, cast({_PRICE} as string) as OPEN_PRICE,
               cast({_PRICE} + 1 as string) as HIGH_PRICE, cast({_PRICE} - 1 as string) as LOW_PRICE,
               case when l_linenumber = 5 then ' -' else cast({_PRICE} as string) end as LAST_PRICE,
               cast({_PRICE} + 1 as string) as CLOSE_PRICE, cast({_PRICE} as string) as AVG_PRICE,
               concat(cast(cast(l_quantity as bigint) as string), '.0') as TTL_TRD_QNTY,
               cast(l_extendedprice as string) as TURNOVER_LACS, cast(l_linenumber as string) as NO_OF_TRADES,
               case when l_linenumber = 7 then ' -' else cast(cast(l_quantity as bigint) as string) end as DELIV_QTY,
               case when l_linenumber = 7 then ' -' else '55.5' end as DELIV_PER
        from {{lineitem}}""",
    "bse_raw": f"""
        select concat(' ', cast(500000 + l_suppkey as string)) as SC_CODE,
               concat('COMPANY ', cast(l_suppkey as string), '  ') as SC_NAME,
               cast({_PRICE} as string) as OPEN, cast({_PRICE} + 1 as string) as HIGH,
               cast({_PRICE} - 1 as string) as LOW, case when l_linenumber = 1 then '' else '12.25' end as CLOSE,
               cast(cast(l_quantity as bigint) as string) as NO_OF_SHRS,
               concat(cast(l_linenumber as string), '.0') as NO_TRADES, {_DAY} as DATE1
        from {{lineitem}}""",
    # Every line is a deal, on a day near its own.
    "bulk_raw": f"""
        select concat('P', cast(l_suppkey as string)) as Symbol,
               {_DAY} + case when l_linestatus = 'O' then l_linenumber else 0 end as Date,
               concat(cast(l_orderkey % 9 + 1 as string), ',', lpad(cast(cast(l_quantity as bigint) as string), 3, '0'))
                   as Quantity_Traded,
               case when l_linenumber = 7 then '1,234.5' else cast(cast(l_quantity as int) + 100 as string) end
                   as Trade_Price__Wght_Avg_Price
        from {{lineitem}}""",
    # Two symbols share an ISIN; sizes of 50 have none.
    "nse_list": """
        select concat('N#', cast(p_partkey as string), '.') as SYMBOL, p_name as NAME_OF_COMPANY,
               case when p_size = 50 then null when p_size = 49 then ' '
                    else concat(' IN', lpad(cast(cast(floor(p_partkey / 2) as bigint) as string), 8, '0')) end
                   as ISIN_NUMBER
        from {part}""",
    "bse_list": """
        select concat(cast(500000 + c_custkey as string), ' ') as Security_Id, concat(c_name, ' Ltd') as Security_Name,
               concat('IN', lpad(cast(c_custkey + 50 as string), 8, '0'), ' ') as ISIN_No
        from {customer}""",
    # Second source: one price in five differs, and days with one trade are a day late.
    "ref_prices": """
        select SYMBOL, DATE1 + case when TTL_TRD_QNTY = 1 then 1 else 0 end as DATE1, CLOSE_PRICE as Close,
               case when TTL_TRD_QNTY % 5 = 0 then CLOSE_PRICE + 0.5 else CLOSE_PRICE end as AdjClose
        from {bars}""",
    "history": """
        select case when user_id % 2 = 0 then 'NSE' else 'BSE' end as exchange,
               concat('S', cast(user_id as string)) as symbol, cast(cast(ts as date) as string) as date,
               min_by(value, ts) as open, max(value) as high, min(value) as low, max_by(value, ts) as close,
               max_by(value, ts) as adj_close, count(*) as volume,
               cast(sum(case when event_type = 'purchase' then 1 else 0 end) as double) as dividends,
               cast(sum(case when event_type = 'error' then 2 else 0 end) as double) as stock_splits
        from {events} group by user_id, cast(ts as date)""",
    "loaded_days": "select distinct cast(o_orderdate as date) as DATE1 from {orders}",
    # Lines as rows of daily files, to find keys that several files hold.
    "file_rows": f"""
        select concat('P', cast(l_suppkey as string)) as SYMBOL, {_SERIES} as SERIES, {_DAY} as DATE1,
               concat('file_', l_linestatus, '_', cast(l_linenumber as string), '.csv') as SOURCE_FILE
        from {{lineitem}}""",
}

_NAME = re.compile(r"\{(\w+)\}")


# Views whose rows are parsed at some cost.
_TEXT_VIEWS = {"legacy_raw", "delivery_raw", "full_raw", "bse_raw", "bulk_raw"}


# Rows of a parsed view that one task sorts or groups: about 100 MB of text columns.
_TASK_ROWS = 250_000


def _spread(df: DataFrame) -> DataFrame:
    """Spread a table over the cores where it comes in fewer files than there are.

    A small table is one file with one row group, which one task would parse
    alone. A large one gets as many tasks as its rows need, so that none of them spills. By key, because
    spreading rows in turn would sort them first. Tables of many files are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    return df.repartition(max(cores, -(-df.count() // _TASK_ROWS)), df.columns[0])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view, or one of the given tables."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = {part: load(spark, sf_dir, part) for part in set(_NAME.findall(VIEWS[name]))}
    if name in _TEXT_VIEWS:
        parts = {part: _spread(df) for part, df in parts.items()}
    return spark.sql(VIEWS[name], **parts)


def with_clause(*names: str) -> str:
    """The same views as common table expressions, earlier ones first."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in order:
            for part in _NAME.findall(VIEWS[name]):
                add(part)
            order.append(name)

    for name in names:
        add(name)
    return ",\n".join(f"{n} as ({_NAME.sub(r'\1', VIEWS[n])})" for n in order)
