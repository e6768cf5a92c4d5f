"""Raw daily price and delivery files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.functions.dates import BSE_FILE_DATE, DELIVERY_FILE_DATE
from barloom.sources.files import SOURCE_FILE, Paths, file_name, read_csv_by_name

# File name patterns.
LEGACY_GLOB = "cm*bhav.csv"
DELIVERY_GLOB = "MTO_*.DAT"
FULL_GLOB = "*.csv"
BSE_GLOB = "*.CSV"
BSE_NAME = r"EQ_ISINCODE_(\d{6})_T0\.CSV"
DELIVERY_NAME = r"MTO_(\d{8})\.DAT"

def read_legacy_prices(
    spark: SparkSession, paths: Paths, header: Sequence[str] | None = None, glob: str = LEGACY_GLOB
) -> DataFrame:
    """First daily price format as text; the literal ``NA`` is kept as a symbol.

    Files without a TIMESTAMP column are skipped, as ``skipped_files`` tells. Rows with
    too few fields keep what they have.
    """
    return read_csv_by_name(
        spark,
        paths,
        S.LEGACY_COLUMNS,
        required=S.LEGACY_COLUMNS[:2] + ["TIMESTAMP"],
        header=header,
        skip=True,
        pathGlobFilter=glob,
    )


def read_full_prices(
    spark: SparkSession, paths: Paths, header: Sequence[str] | None = None, glob: str = FULL_GLOB
) -> DataFrame:
    """Full daily price format as text, from directories or from a list of files.

    A file without the key columns in its header, in their exact letter case, is an error.
    """
    return read_csv_by_name(
        spark, paths, S.PRICES.fieldNames(), required=S.PRICE_KEY, header=header, pathGlobFilter=glob
    )


def _delivery_lines(spark: SparkSession, paths: Paths, glob: str) -> DataFrame:
    """Non-blank lines as fields, with the date of the file and whether they are detail records."""
    fields = F.split("value", ",")
    lines = spark.read.option("pathGlobFilter", glob).text(paths).where(F.trim("value") != "")
    day = F.regexp_extract(F.col("_metadata.file_path"), DELIVERY_NAME, 1)
    rows = lines.select(
        *[F.nullif(F.trim(F.get(fields, i)), F.lit("")).alias(n) for i, n in enumerate(S.DELIVERY_RAW.names)],
        F.try_to_date(day, DELIVERY_FILE_DATE).alias("DATE1"),
        file_name().alias(SOURCE_FILE),
    )
    number = r"^[0-9]+$"
    detail = F.col("RECORD_TYPE").rlike(number) & F.col("SR_NO").rlike(number)
    return rows.withColumn("detail", F.coalesce(detail, F.lit(False)))


def read_delivery(spark: SparkSession, paths: Paths, glob: str = DELIVERY_GLOB) -> DataFrame:
    """Delivery files as text, with the date in the name of the file or of its folder.

    Detail records have a numeric record type and a numeric serial number. Every other
    line is preamble, wherever it stands, so the rows do not depend on a file's size
    or on where it is split; ``delivery_rejects`` counts what is left out.
    """
    return _delivery_lines(spark, paths, glob).where("detail").drop("detail")


def delivery_rejects(spark: SparkSession, paths: Paths, glob: str = DELIVERY_GLOB) -> DataFrame:
    """Per file: detail records, and other lines (a whole preamble has four)."""
    return (
        _delivery_lines(spark, paths, glob)
        .groupBy(SOURCE_FILE)
        .agg(F.count_if("detail").alias("records"), F.count_if(~F.col("detail")).alias("other_lines"))
    )


def read_bse_prices(
    spark: SparkSession, paths: Paths, header: Sequence[str] | None = None, glob: str = BSE_GLOB
) -> DataFrame:
    """Price files of the second exchange as text, all their columns, with the date in the name of the file or of its folder.

    Other names leave the date NULL.
    """
    rows = read_csv_by_name(
        spark,
        paths,
        S.BSE_COLUMNS,
        required=S.BSE_COLUMNS[:1],
        header=header,
        others=True,
        extra={"file_path": F.col("_metadata.file_path")},
        pathGlobFilter=glob,
    )
    day = F.regexp_extract("file_path", BSE_NAME, 1)
    return rows.withColumn("DATE1", F.try_to_date(day, BSE_FILE_DATE)).drop("file_path")
