"""Folders of wide sales files.

All columns are read as text and converted here, so no value is lost unseen: what doesn't fit its
type is NULL in the row and told in the row's list of rejects.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.schema import SALES_COLUMNS, TEXT

PATTERN = "*.{csv,csv.gz}"
SOURCE_FILE = "source_file"
CORRUPT = "corrupt_row"
REJECTED = "rejected"
REJECT = "array<struct<column_name: string, value: string, reason: string>>"

UNREADABLE = "unreadable"  # the value is NULL in the row
ROUNDED = "rounded"  # the value had more decimals than its type
MALFORMED = "malformed"  # the line has too many or too few values

_EXACT = T.DecimalType(38, 10)
_NUMBER = r"^[+-]?([0-9]*)[.]?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"
_PLAIN_WHOLE = r"^[+-]?[0-9]+[.]?0*$"
_WIDE_OPEN = 1 << 40


def scan_csv_folder(
    spark: SparkSession,
    folder: str,
    *,
    mixed: bool = False,
    infer: bool = False,
    source_file: bool = False,
    corrupt_row: bool = False,
    rejects: bool = False,
) -> DataFrame:
    """All CSV files of a folder, plain or as ``.csv.gz``, as sales rows, columns found by name.

    Types come from the model, so codes such as ``00123`` stay text, and a whole number may be written
    ``34.0``. One header is read and every file must have it, else the scan fails. With ``mixed`` the
    files are grouped by header and the groups are put together by column name; a column that a file
    lacks is NULL. ``infer`` chooses each column's type by its values in all files instead.
    ``source_file`` adds the file's path, ``corrupt_row`` the text of lines with too many or too few
    values, ``rejects`` the list of values that were not taken over as they are.
    """
    groups = _files_by_header(spark, folder) if mixed else [(_header(spark, [folder]), [folder])]
    texts = [_text_scan(spark, paths, header) for header, paths in groups if header]
    if texts:
        rows = union_by_name(*texts)
    else:
        fields = [T.StructField(c, TEXT) for c in (*SALES_COLUMNS, SOURCE_FILE, CORRUPT)]
        rows = spark.createDataFrame([], T.StructType(fields))
    rows = rows.select(
        *[F.col(c) if c in rows.columns else F.lit(None).cast(TEXT).alias(c) for c in SALES_COLUMNS], SOURCE_FILE, CORRUPT
    )
    present = [c for c in SALES_COLUMNS if any(c in header for header, _ in groups)]
    kinds = inferred_types(rows, present) if infer and texts else dict(SALES_COLUMNS)
    wanted = [c for c, asked in ((SOURCE_FILE, source_file), (CORRUPT, corrupt_row)) if asked]
    found = [rejected_values(kinds).alias(REJECTED)] if rejects else []
    return rows.select(*[converted(c, kind).alias(c) for c, kind in kinds.items()], *wanted, *found)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Append frames by column name; a column that one lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _value(column: str) -> Column:
    """The text without white space around it; NULL if nothing is left."""
    trimmed = F.trim(F.col(column))
    return F.when(trimmed != "", trimmed)


def converted(column: str, kind: T.DataType) -> Column:
    """The text as ``kind``; NULL if it doesn't fit. Whole numbers may have decimals that are zero."""
    if isinstance(kind, T.StringType):
        return F.col(column)
    value = _value(column)
    direct = value.try_cast(kind)  # a decimal is rounded here, which ``rejected_values`` tells
    if not isinstance(kind, T.IntegralType):
        return direct
    whole = value.rlike(_PLAIN_WHOLE) | (decimals(value) <= 0)  # the first is cheap, and true for nearly all
    return F.coalesce(direct, F.when(whole, value.try_cast(_EXACT).try_cast(kind)))


def decimals(value: Column) -> Column:
    """How many decimals a number's text needs, however it is written: 2 for ``1.250``, ``125e-2`` and
    ``0.0125e2``, none for ``34.0`` and ``5e3``. NULL if it isn't a number. The text decides, as every
    type that it could be read as rounds somewhere."""
    part = lambda i: F.regexp_extract(value, _NUMBER, i)
    whole, fraction = part(1), F.rtrim(part(2), F.lit("0"))
    digits = F.concat(whole, fraction)
    # Without a fraction zeros at the end of the whole part take the exponent's place: 100e-4 is 0.01.
    zeros = F.when(fraction == "", F.length(whole) - F.length(F.rtrim(whole, F.lit("0")))).otherwise(0)
    exponent = F.coalesce(F.when(part(3) != "", part(3)).otherwise("0").try_cast(T.IntegerType()), F.lit(0))
    needed = F.when(F.rtrim(digits, F.lit("0")) == "", 0).otherwise(F.length(fraction) - zeros - exponent)
    return F.when(value.rlike(_NUMBER), F.greatest(needed, F.lit(0)))


def _long(value: Column, scale: int) -> Column:
    """Whether a number's text may need more than ``scale`` decimals; cheap, so that few texts are taken apart."""
    point = F.instr(value, ".")
    return value.contains("e") | value.contains("E") | ((point > 0) & (F.length(value) - point > scale))


def rejected_values(kinds: dict[str, T.DataType]) -> Column:
    """Per row the values that are not taken over as they are: column, text, reason."""
    found, none = [], F.array().cast(REJECT)
    for column, kind in kinds.items():
        if isinstance(kind, T.StringType):
            continue
        value, taken = _value(column), converted(column, kind)
        reason = F.when(value.isNotNull() & taken.isNull(), UNREADABLE)
        if isinstance(kind, T.DecimalType):
            reason = reason.when(_long(value, kind.scale) & (decimals(value) > kind.scale), ROUNDED)
        found.append(F.when(reason.isNotNull(), _reject(F.lit(column), F.col(column), reason)).otherwise(none))
    found.append(F.when(F.col(CORRUPT).isNotNull(), _reject(F.lit(CORRUPT), F.col(CORRUPT), F.lit(MALFORMED))).otherwise(none))
    return F.concat(*found)  # a filter of an array would be interpreted, with all that it is made of


def _reject(column: Column, value: Column, reason: Column) -> Column:
    """A list of one reject."""
    return F.array(F.struct(column.alias("column_name"), value.alias("value"), reason.alias("reason"))).cast(REJECT)


def reject_rows(rows: DataFrame) -> DataFrame:
    """One row per rejected value of a scan with ``source_file`` and ``rejects``."""
    return rows.select(SOURCE_FILE, F.col("id"), F.explode(REJECTED).alias("r")).select(SOURCE_FILE, "id", "r.*")


def inferred_types(rows: DataFrame, present: Sequence[str] = tuple(SALES_COLUMNS)) -> dict[str, T.DataType]:
    """The narrowest of int, bigint, double and string that holds all values of a column, from one pass
    over all files; a column without values, or not ``present`` in any file, is text."""
    ladder = [T.IntegerType(), T.LongType(), T.DoubleType()]
    fits = [
        F.struct(
            F.count(_value(c)).alias("n"),
            *[F.count(_value(c).try_cast(kind)).alias(f"n{i}") for i, kind in enumerate(ladder)],
        ).alias(c)
        for c in present
    ]
    counts = rows.agg(*fits).first() if fits else {}
    kinds: dict[str, T.DataType] = dict.fromkeys(SALES_COLUMNS, TEXT)
    for c in present:
        known = counts[c]["n"]
        kinds[c] = next((k for i, k in enumerate(ladder) if known and counts[c][f"n{i}"] == known), TEXT)
    return kinds


def _reader(spark: SparkSession):
    return spark.read.option("header", True).option("pathGlobFilter", PATTERN)


def _header(spark: SparkSession, paths: list[str]) -> tuple[str, ...]:
    """Column names of the first file; reads one line. Empty if there is no file."""
    try:
        return tuple(_reader(spark).csv(paths).columns)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return ()
        raise


def _files_by_header(spark: SparkSession, folder: str) -> list[tuple[tuple[str, ...], list[str]]]:
    """Files of a folder grouped by header, by one job: a task per file split reads the first line of
    the splits that begin a file and stops. Paths reach the driver, as for any scan."""

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                if batch.column(2)[0].as_py() == 0:
                    yield batch.slice(0, 1).select([0, 1])
                return

    reading = _session_like(spark)
    # A split of its own for every task, and rows one by one. The caller's session keeps its settings: other
    # threads may be planning with them.
    reading.conf.set("spark.sql.files.openCostInBytes", str(_WIDE_OPEN))
    reading.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    scan = reading.read.option("pathGlobFilter", PATTERN).text(folder).select("_metadata.file_path", "value", "_metadata.file_block_start")
    firsts = scan.mapInArrow(first_line, "file_path string, value string").collect()
    by_line: dict[str, list[str]] = defaultdict(list)
    for path, line in sorted(map(tuple, firsts)):
        by_line[line].append(path)
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for paths in by_line.values():  # one header is parsed per distinct first line
        groups[_header(spark, paths[:1])] += paths
    return list(groups.items())


def _session_like(spark: SparkSession) -> SparkSession:
    """A session of its own with the settings of ``spark``."""
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if not name.startswith("spark.") or spark.conf.isModifiable(name):
            other.conf.set(name, value)
    return other


def _text_scan(spark: SparkSession, paths: list[str], header: tuple[str, ...]) -> DataFrame:
    """The files' columns as text, the file's path, and the text of lines that don't fit the header."""
    fields = [T.StructField(c, TEXT) for c in header]
    reader = _reader(spark).schema(T.StructType([*fields, T.StructField(CORRUPT, TEXT)])).option("enforceSchema", False)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    scanned = reader.csv(paths)
    present = [F.col(c) for c in SALES_COLUMNS if c in header]
    return scanned.select(*present, F.col("_metadata.file_path").alias(SOURCE_FILE), CORRUPT)


