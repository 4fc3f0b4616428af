"""Register files: headerless, ``;``-separated text with a fixed all-string schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.schemas import DATASETS, text_schema

# A doubled quote is a quote, an unquoted empty field is NULL and a quoted one is ''.
# Only "\n" ends a record: a lone "\r" inside quotes is data.
FIELD_OPTIONS = {"sep": ";", "quote": '"', "escape": '"', "nullValue": "\x01"}
# Whole lines are looked at, so that a line with too many or too few fields is seen whatever columns are asked for.
FILE_OPTIONS = {**FIELD_OPTIONS, "header": "false", "lineSep": "\n", "columnPruning": "false"}

BAD_RECORD = "_bad_record"


class MalformedError(ValueError):
    """Lines that do not have the columns of their dataset."""


def _strictness(columns, bad_records: bool) -> tuple[tuple[str, ...], dict[str, str]]:
    """The columns to read and the options that say what a malformed line does."""
    if bad_records:
        return (*columns, BAD_RECORD), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    return tuple(columns), {"mode": "FAILFAST"}


def scan_csv(
    spark: SparkSession, path: str, columns, encoding: str = "UTF-8", bad_records: bool = False
) -> DataFrame:
    """Delimited files under ``path`` (a file, a folder or a glob) with the given text columns.

    A line without exactly these columns fails the query that reads it. With ``bad_records`` it is kept, padded with
    NULLs or cut, and its text is in a column of its own, for :func:`require_well_formed` or a report.
    """
    columns, modes = _strictness(columns, bad_records)
    options = {**FILE_OPTIONS, **modes, "encoding": encoding}
    return spark.read.schema(text_schema(columns)).options(**options).csv(path)


def dataset_glob(root: str, dataset: str) -> str:
    """Files named ``….SUFFIX``, or the ``dataset=SUFFIX`` folder that landing writes."""
    return f"{root.rstrip('/')}/*[.=]{DATASETS[dataset].suffix}"


def scan(
    spark: SparkSession, root: str, dataset: str, encoding: str = "UTF-8", bad_records: bool = False
) -> DataFrame:
    """A dataset's files: those below ``root`` whose name ends in the dataset's suffix.

    The files are Latin-1. Read as UTF-8, the default, every accented letter arrives as U+FFFD, which
    the transforms then repair the way the published table always had it. ``ISO-8859-1`` reads them right.
    """
    return scan_csv(spark, dataset_glob(root, dataset), DATASETS[dataset].columns, encoding, bad_records)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines, undecoded, without blank ones."""
    lines = spark.read.text(path, lineSep="\n").where(F.trim("value") != "")
    return lines.select(F.col("value").cast("binary").alias("line"))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Latin-1 lines with every character outside the kept class removed, without those that leaves blank."""
    cleaned = text.clean(F.col("line"))
    # A first character that is kept settles it, so only other lines are cleaned twice.
    first = F.substring("line", 1, 1).cast("string")
    not_blank = first.isin(*text.KEPT_VISIBLE) | (F.trim(cleaned) != "")
    return lines.where(not_blank).select(cleaned.alias("line"))


def parse_lines(lines: DataFrame, columns, bad_records: bool = False) -> DataFrame:
    """Text lines → columns, by the same rules as :func:`scan_csv`."""
    columns, modes = _strictness(columns, bad_records)
    parsed = F.from_csv(F.col("line"), ", ".join(f"{c} string" for c in columns), {**FIELD_OPTIONS, **modes})
    return lines.select(parsed.alias("r")).select("r.*")


def scan_cleaned(spark: SparkSession, root: str, dataset: str, bad_records: bool = False) -> DataFrame:
    """A dataset read through cleaning. Bytes are cleaned before they are parsed: "\\r" and stray
    characters go first, so they cannot disturb the quoting."""
    lines = scan_lines(spark, dataset_glob(root, dataset))
    return parse_lines(clean_lines(lines), DATASETS[dataset].columns, bad_records)


def require_well_formed(df: DataFrame) -> DataFrame:
    """``df`` without its bad-record column; :class:`MalformedError` if that has anything in it."""
    bad = df.where(F.col(BAD_RECORD).isNotNull()).select(F.substring(BAD_RECORD, 1, 200)).limit(3).collect()
    if bad:
        raise MalformedError(f"malformed lines, among them: {[r[0] for r in bad]}")
    return df.drop(BAD_RECORD)
