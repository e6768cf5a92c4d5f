"""Single CSV lists: corporate actions, bulk deals, securities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from barloom.sources.files import SOURCE_FILE, read_csv_by_name


def _read_list(spark: SparkSession, path: str) -> DataFrame:
    """All-text columns under their stripped header names, of one file, a folder or a pattern.

    Files may have their columns in any order; a column that a file lacks is NULL in its rows. A record
    may hold line ends within quotes.
    """
    rows = read_csv_by_name(spark, path, (), first_line=True, others=True, multiLine="true", escape='"')
    return rows.drop(SOURCE_FILE)


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """Corporate actions: SYMBOL, EX-DATE, PURPOSE, SERIES; one file, a folder or a pattern."""
    columns = ["SYMBOL", "EX-DATE", "PURPOSE", "SERIES"]
    rows = read_csv_by_name(spark, path, columns, required=columns[:2], multiLine="true", escape='"')
    return rows.select(*[f"`{c}`" for c in columns])


def read_bulk_deals(spark: SparkSession, path: str) -> DataFrame:
    """Bulk deals with their headers as in the file; clean with ``clean_bulk_deals``."""
    return _read_list(spark, path)


def read_security_list(spark: SparkSession, path: str, fallback: str | None = None) -> DataFrame:
    """Security list of an exchange, from ``fallback`` when ``path`` is not there."""
    try:
        return _read_list(spark, path)
    except AnalysisException as error:
        if fallback is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _read_list(spark, fallback)


def read_securities(spark: SparkSession, path: str) -> DataFrame:
    """A written security master. The blank of an absent symbol is kept."""
    return spark.read.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, quote='"'
    ).csv(path)
