"""Ticket files: one headered CSV per creation day, read by column name."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.operators.calendar import month_bounds
from ticketloom.schema import TICKET_TYPES
from ticketloom.sources import folders

# Quotes inside a field are doubled, as CSV writers other than Spark do by default,
# and spaces are kept: a ticket with a blank resolution text is not an open one.
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# A quoted cell may hold line breaks, so a file is read from its start to its end. Every
# cell of a record is parsed, also those no query asks for: a record whose cells do not
# match the header is then found whatever is selected.
_WHOLE = {"multiLine": True, "columnPruning": False, "columnNameOfCorruptRecord": "_malformed"}
# Full microseconds; Spark's own default keeps only milliseconds.
_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
UNREADABLE = "unreadable"
# So many files are opened at a time to see their header.
OPENED_AT_ONCE = 32
# A file is read by one task, so a large day is exported as files of so many rows at most.
ROWS_A_FILE = 250_000
#: Columns that are not text, and may hold a cell that does not fit.
TYPED_COLUMNS = [c for c, t in TICKET_TYPES.items() if t != "string"]


@dataclass(frozen=True)
class Delivery:
    """A ticket file as it was listed."""

    path: str
    modified_ms: int
    length: int
    day: date


@dataclass(frozen=True)
class DayFiles:
    """Where the day files lie.

    ``partitioned=False``: ``base/2023/11/2023-11-01.csv``.
    ``partitioned=True``: ``base/created_date=2023-11-01/*.csv``, as ``export_days``
    writes it; a large day may have many files there.
    """

    base: str
    partitioned: bool = False

    def _glob(self, year: str, month: str, day: str) -> str:
        if self.partitioned:
            return f"{self.base}/created_date={year}-{month}-{day}/*"
        return f"{self.base}/{year}/{month}/*.csv"

    def _day_in(self, path: str) -> date:
        """The day a file stands for, from its path; a file not named after a day of
        the folder it lies in is refused."""
        *_, year, folder, name = path.split("/")
        if self.partitioned:
            found = re.fullmatch(r"created_date=(\d{4}-\d{2}-\d{2})", folder)
        else:
            found = re.fullmatch(rf"({re.escape(year)}-{re.escape(folder)}-\d{{2}})\.csv", name)
        try:
            return date.fromisoformat(found[1])
        except (TypeError, ValueError):
            raise ValueError(f"{path} is not named after a day of its folder") from None

    def _list(self, spark: SparkSession, glob: str) -> list[Delivery]:
        return [Delivery(*status, self._day_in(status[0])) for status in folders.matching(spark, glob)]

    def of_month(self, spark: SparkSession, year: int, month: int) -> list[Delivery]:
        return self._list(spark, self._glob(f"{year:04d}", f"{month:02d}", "*"))

    def of_days(self, spark: SparkSession, days: Sequence[date]) -> list[Delivery]:
        """The files of some days; a day without one is simply not among them."""
        months: dict[tuple[int, int], list[date]] = {}
        for day in sorted(set(days)):
            months.setdefault((day.year, day.month), []).append(day)
        found = []
        for (year, month), own in months.items():
            # Only these days' places are looked at, be it one day or many.
            if self.partitioned:
                glob = f"{self.base}/created_date={{{','.join(map(str, own))}}}/*"
            else:
                glob = f"{self.base}/{year:04d}/{month:02d}/{{{','.join(map(str, own))}}}.csv"
            found += self._list(spark, glob)
        return found

    def all(self, spark: SparkSession) -> list[Delivery]:
        return self._list(spark, self._glob("[0-9]*", "*", "*"))

    def source_day(self) -> Column:
        """The day a row's file stands for. It comes from the path, so it is known
        even where a ticket's own timestamp is not readable."""
        if self.partitioned:
            name = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
            return F.right(name, F.lit(10)).try_cast("date")
        return F.left(F.col("_metadata.file_name"), F.lit(10)).try_cast("date")


def _header_schema(spark: SparkSession, path: str, multi_line: bool = True) -> T.StructType:
    names = spark.read.options(**_CSV, multiLine=multi_line).csv(path).columns
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _header_of(read: bytes) -> bytes | None:
    """The first record that is not blank; None if it does not end within these bytes."""
    start = len(read) - len(read.lstrip(b"\r\n"))
    end = start
    while (end := read.find(b"\n", end)) >= 0:
        if read.count(b'"', start, end) % 2 == 0:
            return read[start:end].rstrip(b"\r")
        end += 1
    return None


def by_header(spark: SparkSession, found: Sequence[Delivery]) -> list[list[Delivery]]:
    """Files that have the same header, byte for byte, together; the most files first.

    Like the listing, this is one small request a file, many at a time. A file of no bytes
    has no header and no rows, and goes with the first group.
    """

    def header(file: Delivery) -> bytes:
        read = folders.first_lines(spark, file.path, lambda some: _header_of(some) is not None)
        whole = _header_of(read)
        return read.strip(b"\r\n") if whole is None else whole

    filled = [f for f in found if f.length]
    with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
        headers = list(pool.map(header, filled))
    groups: dict[bytes, list[Delivery]] = {}
    for file, own in zip(filled, headers):
        groups.setdefault(own, []).append(file)
    most_first = sorted(groups.values(), key=len, reverse=True) or [[]]
    most_first[0] += [f for f in found if not f.length]
    return most_first


def typed_by_name(columns: Iterable[str], source: str = "") -> list:
    """Select list that casts each contract column by name and keeps the others.

    A cell that does not fit its type becomes null, and its text is kept in ``_unread``, a
    map by column that is null for rows without such cells. A missing contract column is
    an error. Of a record that is ``_malformed`` no cell is given: it cannot be told which
    column one belongs to.
    """
    columns = [c for c in columns if c != "_malformed"]
    by_lower = {c.lower(): c for c in columns}
    missing = [c for c in TICKET_TYPES if c not in by_lower]
    if missing:
        raise ValueError(f"ticket source {source} lacks the columns {missing}")
    extra = [c for c in columns if c.lower() not in TICKET_TYPES]
    whole = F.col("_malformed").isNull()
    cell = lambda c: F.when(whole, F.col(f"`{by_lower.get(c, c)}`"))
    typed = [cell(c).try_cast(t).alias(c) for c, t in TICKET_TYPES.items()]
    bad = F.array(
        *(
            F.when(cell(c).try_cast(TICKET_TYPES[c]).isNull() & cell(c).isNotNull(), F.struct(F.lit(c).alias("key"), cell(c).alias("value")))
            for c in TYPED_COLUMNS
        )
    )
    bad = F.map_from_entries(F.filter(bad, lambda entry: entry.isNotNull()))
    unread = F.when(F.size(bad) > 0, bad).alias("_unread")
    return typed + [cell(c).alias(c) for c in extra] + [unread]


def _reader(spark: SparkSession, schema: T.StructType, **more):
    options = {**_CSV, **_WHOLE, **more}
    return spark.read.options(**options).option("enforceSchema", False).schema(schema)


def read_files(spark: SparkSession, files: DayFiles, found: Sequence[Delivery]) -> DataFrame:
    """Typed rows of listed files plus the file and day they came from.

    Files of one header are read by one scan, and the scans are united by name: files may
    differ in the order of columns and in columns beyond the contract, which are null for
    files without them. A file that lacks a column of the contract is an error that names
    it. A record with more or fewer cells than its file's header, or with a quote that is
    never closed, comes as one row whose text is in ``_malformed``; it is null in all other
    rows. Every header is checked again when its file is read, so a file that
    changes after the listing fails instead of shifting its values.
    """
    groups = by_header(spark, found)
    scans = [_read_alike(spark, files, group, len(groups) == 1) for group in groups]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _read_alike(spark: SparkSession, files: DayFiles, found: Sequence[Delivery], all_listed: bool) -> DataFrame:
    schema = _header_schema(spark, found[0].path)
    paths = [f.path for f in found]
    if files.partitioned and all_listed:
        paths = sorted({path.rsplit("/", 1)[0] for path in paths})
    return _reader(spark, schema.add("_malformed", "string")).csv(paths).select(
        *typed_by_name(schema.names, found[0].path),
        "_malformed",
        F.col("_metadata.file_path").alias("_source_file"),
        files.source_day().alias("source_date"),
    )


def stream_files(spark: SparkSession, files: DayFiles, files_per_batch: int) -> DataFrame | None:
    """The same rows as a stream over all files, each of them once; None while there is no
    file to take the header from."""
    found = files.all(spark)
    if not found:
        return None
    schema = _header_schema(spark, found[0].path)
    glob = files._glob("[0-9]*", "*", "*")
    return (
        spark.readStream.options(**_CSV, **_WHOLE, enforceSchema=False, maxFilesPerTrigger=files_per_batch)
        .schema(schema.add("_malformed", "string"))
        .csv(glob.rsplit("/", 1)[0])
        .select(
            *typed_by_name(schema.names),
            "_malformed",
            F.col("_metadata.file_path").alias("_source_file"),
            files.source_day().alias("source_date"),
        )
    )


def listed_days(
    spark: SparkSession, files: DayFiles, days: Sequence[date], skip_missing: bool = False
) -> list[Delivery]:
    """The files of some days. A day without a file is an error, unless ``skip_missing``."""
    found = files.of_days(spark, days)
    there = {f.day for f in found}
    missing = [str(d) for d in days if d not in there]
    if missing and not skip_missing:
        raise FileNotFoundError(f"no ticket file under {files.base} for {', '.join(missing)}")
    return found


def read_days(
    spark: SparkSession, files: DayFiles, days: Sequence[date], skip_missing: bool = False
) -> DataFrame | None:
    """The files of some days in one scan; None when no day has a file."""
    found = listed_days(spark, files, days, skip_missing)
    return read_files(spark, files, found) if found else None


def listed_month(spark: SparkSession, files: DayFiles, year: int, month: int) -> list[Delivery]:
    found = files.of_month(spark, year, month)
    if not found:
        raise FileNotFoundError(f"no ticket file under {files.base} for {year:04d}-{month:02d}")
    return found


def read_month(spark: SparkSession, files: DayFiles, year: int, month: int) -> DataFrame:
    return read_files(spark, files, listed_month(spark, files, year, month))


def read_all_days(spark: SparkSession, files: DayFiles) -> DataFrame:
    return read_files(spark, files, files.all(spark))


def read_extract(spark: SparkSession, path: str, typed: bool = True, splits: bool = False) -> DataFrame:
    """A whole ticket extract: typed by name, or as text.

    There is no load to keep malformed records aside for, so one of them is an error that
    shows it. With ``splits`` a file is read by many tasks at once; a quoted cell must then
    not hold a line break, and one that does is an error too, never two rows.
    """
    schema = _header_schema(spark, path, not splits)
    rows = _reader(spark, schema, multiLine=not splits, mode="FAILFAST").csv(path)
    if not typed:
        return rows
    rows = rows.withColumn("_malformed", F.lit(None).cast("string"))
    return rows.select(*typed_by_name(schema.names)).drop("_unread")


def read_agents(spark: SparkSession, path: str) -> DataFrame:
    """The agent list, as text columns; its layout is whatever the header says."""
    return spark.read.options(**_CSV).option("multiLine", True).csv(path)


def with_ingestion_time(df: DataFrame, ingested_at=None) -> DataFrame:
    """Stamp the load time. Pass a fixed time where one run has several actions."""
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return df.withColumn("_ingestion_ts", stamp.cast("timestamp"))


@dataclass(frozen=True)
class Export:
    """Where the tickets went; the counts add up to the extract's rows."""

    files: DayFiles
    exported: int
    out_of_range: int
    unreadable: int


def export_days(
    tickets: DataFrame,
    base: str,
    year: int | None = None,
    month: int | None = None,
    timestamp_column: str = "created_at",
) -> Export:
    """Write tickets as CSV, split by creation day; of a year or month, or all of them.

    Text cells go out as they came in: a time is parsed only to choose the folder. Rows
    whose time cannot be read, or is missing, go to the folder ``created_date=unreadable``,
    which day readers leave alone; rows of other years or months are only counted.

    Rows are gathered by day so that a small day becomes one file, and AQE splits
    a day that is larger than the advisory partition size over several tasks. A task
    starts another file after ``ROWS_A_FILE`` rows, so readers share a large day as well.
    A second export replaces the days it contains; an empty slice writes nothing.
    """
    day = F.col(timestamp_column).try_cast("timestamp_ntz").cast("date")
    wanted = F.lit(True)
    if year is not None:
        start, stop = month_bounds(year, month)
        wanted = (day >= F.lit(start)) & (day < F.lit(stop))
    seen = Observation()
    (
        tickets.withColumn("created_date", day)
        .withColumn("_wanted", F.coalesce(wanted, F.lit(True)))
        .observe(
            seen,
            F.count_if(F.col("_wanted") & F.col("created_date").isNotNull()).alias("exported"),
            F.count_if(~F.col("_wanted")).alias("out_of_range"),
            F.count_if(F.col("created_date").isNull()).alias("unreadable"),
        )
        .where("_wanted")
        .drop("_wanted")
        .withColumn("created_date", F.coalesce(F.col("created_date").cast("string"), F.lit(UNREADABLE)))
        .hint("rebalance", "created_date")
        .write.mode("overwrite")
        .options(**_CSV)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_A_FILE)
        .option("timestampFormat", _MICROS)
        .option("timestampNTZFormat", _MICROS)
        .partitionBy("created_date")
        .csv(base)
    )
    counts = seen.get
    return Export(DayFiles(base, True), counts["exported"], counts["out_of_range"], counts["unreadable"])
