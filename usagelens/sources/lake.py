"""The lake: landed JSON, curated Parquet, and the moves between them.

Layout: ``<root>/<feed prefix>/year=YYYY/month=MM/day=DD/``. Reads take the
fixed schema and let Spark discover the partitions; there is no inference pass.
Landed values are read as text and cast, so a quoted number counts as a number;
lines that hold no JSON object are left out of the rows and set apart by ``curate``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark import InheritableThread
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import schemas
from usagelens.functions.binding import bind
from usagelens.sources import envelopes

LINES = T.StructType([T.StructField("value", T.StringType()), *schemas.PARTITION_SCHEMA.fields])


def _path(root: str, prefix: str) -> str:
    return f"{root.rstrip('/')}/{prefix}"


def land(df: DataFrame, path: str, day: Column | None = None, load: str | None = None) -> None:
    """Write gzip JSON lines under zero-padded day folders.

    The folder is the arrival day when ``day`` is given, and the row's own
    year/month/day columns otherwise. Rows are not shuffled: each task writes
    the days it holds. Use :func:`compact` where that leaves small files.

    With the name of a load, rows go below the days to folders of that name, as a
    stream's batches do, and replace what the same load has written to these days:
    a load that is repeated adds nothing, and loads and a stream may share a root.
    Without, rows are added to the day folders themselves, which a root with batches
    does not allow.
    """
    placed = df if day is None else place(df, day)
    if load is None:
        landing_writer(placed).mode("append").save(path)
    else:
        land_batch(placed, path, f"load-{load}")


def land_batch(placed: DataFrame, path: str, name: str) -> None:
    """Rows with their days into folders of a batch's name, in place of those that the batch has written before."""
    writer = landing_writer(placed.withColumn("batch", F.lit(name)), ["batch"])
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)


def place(df: DataFrame, day: Column) -> DataFrame:
    """Set the partition columns to a day."""
    return df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})


def landing_writer(df: DataFrame, inner: Iterable[str] = ()) -> DataFrameWriter:
    """Writer of gzip JSON under day folders, split further by ``inner``."""
    padded = df.withColumns(
        {
            "month": F.lpad(F.col("month").cast("string"), 2, "0"),
            "day": F.lpad(F.col("day").cast("string"), 2, "0"),
        }
    )
    return (
        padded.write.format("json")
        .option("compression", "gzip")
        .option("ignoreNullFields", "false")
        .partitionBy(*schemas.PARTITION_COLUMNS, *inner)
    )


def compact(df: DataFrame) -> DataFrame:
    """Fewer, larger files per day, sized by the runtime.

    A rebalance, not a repartition: Spark splits a day that is too large for one
    task instead of sending all of it to one.
    """
    return df.hint("rebalance", *[F.col(c) for c in schemas.PARTITION_COLUMNS])


def _object(feed: schemas.Feed) -> Column:
    """A landed line's fields as text, in an array; NULL where it is no JSON object."""
    fields = ", ".join(f"`{name}`: string" for name in feed.data.fieldNames())
    return envelopes.objects(F.col("value"), f"array<struct<{fields}>>")


def _rows(lines: DataFrame, objects: Column, feed: schemas.Feed) -> DataFrame:
    return ensure_columns(lines.select(F.inline(objects), *schemas.PARTITION_COLUMNS), feed.schema)


def _lines(spark: SparkSession, base: str, path: str) -> DataFrame:
    """Landed lines with their days, which Spark reads off the folders; none below a folder without days."""
    df = spark.read.option("basePath", base).text(path)
    return df.select(*LINES.fieldNames()) if {*LINES.fieldNames()} <= {*df.columns} else spark.createDataFrame([], LINES)


def _raw_lines(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """Landed lines of a feed; None for a feed that has no files."""
    base = _path(root, schemas.PREFIXES[table])
    try:
        return _lines(spark, base, base)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_raw(spark: SparkSession, root: str, table: str, include_content: bool = False) -> DataFrame:
    """Landed JSON of a feed with its fixed schema; the folder's day wins."""
    feed = schemas.feed(table, include_content)
    base = _path(root, feed.prefix)
    return _rows(_lines(spark, base, base), _object(feed), feed)


def read_raw_or_none(
    spark: SparkSession, root: str, table: str, include_content: bool = False
) -> DataFrame | None:
    """Like :func:`read_raw`; None for a feed that has no files or no rows."""
    try:
        df = read_raw(spark, root, table, include_content)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if df.isEmpty() else df


def day_range(start: dt.date, end: dt.date) -> Column:
    """Partition predicate for the days from ``start`` to ``end``, inclusive.

    Plain comparisons on year, month and day, so Spark evaluates them on the
    folder names alone.
    """
    y, m, d = (F.col(c) for c in schemas.PARTITION_COLUMNS)

    def from_(s: dt.date) -> Column:
        return (y > s.year) | ((y == s.year) & ((m > s.month) | ((m == s.month) & (d >= s.day))))

    def to(e: dt.date) -> Column:
        return (y < e.year) | ((y == e.year) & ((m < e.month) | ((m == e.month) & (d <= e.day))))

    return from_(start) & to(end)


def any_day(days: Iterable[dt.date]) -> Column:
    """Partition predicate for a set of days."""
    y, m, d = (F.col(c) for c in schemas.PARTITION_COLUMNS)
    return (y * 10000 + m * 100 + d).isin([t.year * 10000 + t.month * 100 + t.day for t in days])


def range_folders(start: dt.date, end: dt.date) -> list[str]:
    """The fewest folders that hold the days from ``start`` to ``end``.

    Whole years and months are named by one folder.
    """
    folders, day = [], start
    while day <= end:
        next_year = dt.date(day.year + 1, 1, 1)
        next_month = (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        if day.day == day.month == 1 and next_year - dt.timedelta(days=1) <= end:
            folders.append(f"year={day.year}")
            day = next_year
        elif day.day == 1 and next_month - dt.timedelta(days=1) <= end:
            folders.append(f"year={day.year}/month={day.month:02d}")
            day = next_month
        else:
            folders.append(_day_folder(day))
            day += dt.timedelta(days=1)
    return folders


def _day_folder(day: dt.date) -> str:
    return f"year={day.year}/month={day.month:02d}/day={day.day:02d}"


def _read_folders(spark: SparkSession, root: str, table: str, folders: list[str]) -> DataFrame:
    """Landed lines below some day folders; the rest of the feed is not even listed."""
    base = _path(root, schemas.PREFIXES[table])
    try:
        if not folders:
            raise FileNotFoundError
        # One pattern, so that days without data do not count as missing paths.
        return _lines(spark, base, f"{base}/{{{','.join(folders)}}}" if len(folders) > 1 else f"{base}/{folders[0]}")
    except FileNotFoundError:
        return spark.createDataFrame([], LINES)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LINES)


def read_range(
    spark: SparkSession, root: str, table: str, start: dt.date, end: dt.date, include_content: bool = False, years: tuple[int, int] = (schemas.FIRST_YEAR, schemas.LAST_YEAR)
) -> DataFrame:
    """Landed rows of a day range; folders outside it are neither listed nor opened.

    ``years`` are the first and last year that the feed may hold; a range that
    leaves them is an error.

    The folders follow from the range, so the cost of finding files grows with
    the range and not with the history of the feed.
    """
    if start.year < years[0] or end.year > years[1]:
        raise ValueError(f"the range {start} to {end} leaves the years {years[0]} to {years[1]}; pass years to widen them")
    feed = schemas.feed(table, include_content)
    lines = _read_folders(spark, root, table, range_folders(start, end))
    return _rows(lines.filter(day_range(start, end)), _object(feed), feed)


def read_days(
    spark: SparkSession, root: str, table: str, days: Iterable[dt.date], include_content: bool = False
) -> DataFrame:
    """Landed rows of some days, found as in :func:`read_range`."""
    feed = schemas.feed(table, include_content)
    return _rows(_lines_of_days(spark, root, table, days), _object(feed), feed)


def _lines_of_days(spark: SparkSession, root: str, table: str, days: Iterable[dt.date]) -> DataFrame:
    days = sorted(days)
    return _read_folders(spark, root, table, [_day_folder(d) for d in days]).filter(any_day(days))


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in order: missing ones NULL, others cast.

    A value that does not fit its column becomes NULL.
    """
    have = dict(df.dtypes)

    def conform(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if have[field.name] == "string":
            return envelopes.fitted(F.col(field.name), field.dataType).alias(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[conform(field) for field in schema.fields])


def overwrite_partitions(df: DataFrame, path: str, compacted: bool = True) -> None:
    """Replace the days ``df`` holds and keep all others: a re-run changes nothing.

    Compacting shuffles the rows once, which many small landed files are worth.
    Turn it off where landed files are large already: then nothing is shuffled
    and each task writes the days of the files it read.
    """
    (
        (compact(df) if compacted else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*schemas.PARTITION_COLUMNS)
        .parquet(path)
    )


def read_curated(spark: SparkSession, root: str, table: str, include_content: bool = False) -> DataFrame:
    feed = schemas.feed(table, include_content)
    return spark.read.schema(feed.schema).parquet(_path(root, table)).select(*feed.schema.fieldNames())


def create_table(spark: SparkSession, root: str, table: str, include_content: bool = False) -> str:
    """Make sure a curated table exists, empty if new; returns its path."""
    path = _path(root, table)
    schema = schemas.feed(table, include_content).schema
    try:
        spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], schema)
        empty.write.option("compression", "snappy").partitionBy(*schemas.PARTITION_COLUMNS).parquet(path)
    return path


def curate(
    spark: SparkSession,
    raw_root: str,
    curated_root: str,
    table: str,
    include_content: bool = False,
    compacted: bool = True,
) -> bool:
    """Conform one feed's landed lines into its table; False when it has none."""
    create_table(spark, curated_root, table, include_content)
    lines = _raw_lines(spark, raw_root, table)
    if lines is None or lines.isEmpty():
        return False
    _store(lines, curated_root, schemas.feed(table, include_content), compacted)
    return True


def curate_days(
    spark: SparkSession, raw_root: str, curated_root: str, table: str, days: Iterable[dt.date], include_content: bool = False
) -> None:
    """Conform some days of a feed into its table."""
    _store(_lines_of_days(spark, raw_root, table, days), curated_root, schemas.feed(table, include_content))


def _store(lines: DataFrame, curated_root: str, feed: schemas.Feed, compacted: bool = True) -> None:
    """Replace the days of the lines in a table, and keep broken lines apart.

    Broken lines are counted by the write of the rows; only where there are any
    is the input read again for them. Landed files are never changed, so a day
    that has had broken lines still has them.
    """
    seen, parsed = Observation(), bind(lines, found=_object(feed))
    broken = F.col("found").isNull() & (F.trim("value") != "")
    watched = parsed.observe(seen, F.count_if(broken).alias("broken"))
    overwrite_partitions(_rows(watched, F.col("found"), feed), _path(curated_root, feed.table), compacted)
    if seen.get["broken"]:
        apart = parsed.filter(broken).select(F.col("value").alias("line"), *schemas.PARTITION_COLUMNS)
        overwrite_partitions(apart, _path(curated_root, f"{schemas.QUARANTINE_PREFIX}/{feed.table}"))


def read_quarantine(spark: SparkSession, curated_root: str, table: str) -> DataFrame:
    """Landed lines that held no JSON object, by day; :func:`landed_days` counts them."""
    schema = T.StructType([T.StructField("line", T.StringType()), *schemas.PARTITION_SCHEMA.fields])
    try:
        return spark.read.schema(schema).parquet(_path(curated_root, f"{schemas.QUARANTINE_PREFIX}/{table}"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Outcome:
    """What became of a feed: it had rows, or none, or its error."""

    table: str
    curated: bool
    error: Exception | None = None


def side_by_side(spark: SparkSession, work: Callable[[str], bool], tables: Iterable[str]) -> list[Outcome]:
    """Do something for each feed at once, each in a scheduler pool of its own; a feed that fails doesn't stop the others.

    The pools share the cluster evenly where its scheduler is fair
    (``spark.scheduler.mode``); else the first feed's tasks go first.
    """
    tables, found = list(tables), {}

    def run(table: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
        try:
            found[table] = Outcome(table, work(table))
        except Exception as error:  # whatever it is, it is this feed's alone
            found[table] = Outcome(table, False, error)

    threads = [InheritableThread(target=run, args=(t,), session=spark) for t in tables]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return [found[t] for t in tables]


def checked(outcomes: list[Outcome], what: str) -> dict[str, bool]:
    """Whether each feed had rows; the errors of those that failed, raised together."""
    errors = [o.error for o in outcomes if o.error]
    if errors:
        raise ExceptionGroup(f"feeds not {what}: {', '.join(o.table for o in outcomes if o.error)}", errors)
    return {o.table: o.curated for o in outcomes}


def land_feeds(frames: dict[str, DataFrame], root: str) -> None:
    """Land the rows of several feeds side by side; errors are raised together once every feed has had its turn."""

    def work(table: str) -> bool:
        land(frames[table], _path(root, schemas.PREFIXES[table]))
        return True

    if frames:
        checked(side_by_side(next(iter(frames.values())).sparkSession, work, frames), "landed")


def curate_feeds(
    spark: SparkSession, raw_root: str, curated_root: str, include_content: bool = False, tables: Iterable[str] = schemas.TABLES
) -> list[Outcome]:
    """Curate feeds side by side; a feed that fails doesn't stop the others."""
    return side_by_side(spark, lambda table: curate(spark, raw_root, curated_root, table, include_content), tables)


def curate_all(
    spark: SparkSession, raw_root: str, curated_root: str, include_content: bool = False
) -> dict[str, bool]:
    """Curate all feeds; whether each had rows. Errors are raised together once every feed has had its turn."""
    return checked(curate_feeds(spark, raw_root, curated_root, include_content), "curated")


def register_tables(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Expose frames under their table names; a later call replaces an earlier."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def use_curated(spark: SparkSession, curated_root: str, include_content: bool = False) -> None:
    """Let the table names mean the curated tables, as before the landed ones."""
    register_tables(
        spark, {t: read_curated(spark, curated_root, t, include_content) for t in schemas.TABLES}
    )


def publish(
    spark: SparkSession, database: str, curated_root: str, include_content: bool = False
) -> None:
    """Give the curated tables names in a catalog database, over the files they have.

    An external table that already holds a name (say, one over landed JSON) makes
    way; its files stay. A managed table is never dropped: that would delete data.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{curated_root}'")
    for table in schemas.TABLES:
        name, path = f"`{database}`.`{table}`", create_table(spark, curated_root, table, include_content)
        if spark.catalog.tableExists(f"{database}.{table}"):
            if spark.catalog.getTable(f"{database}.{table}").tableType != "EXTERNAL":
                raise ValueError(f"{database}.{table} is not an external table")
            spark.sql(f"DROP TABLE {name}")
        fields = schemas.feed(table, include_content).schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            f" PARTITIONED BY ({', '.join(schemas.PARTITION_COLUMNS)}) LOCATION '{path}'"
        )
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, in one job; a count reads no column data from Parquet."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def datasets_ready(frames: dict[str, DataFrame]) -> DataFrame:
    """Each dataset and whether it has rows."""
    counts = table_counts(frames)
    return counts.select(
        F.col("table_name").alias("dataset"), "row_count", (F.col("row_count") > 0).alias("ready")
    )


def landed_days(df: DataFrame, keys: Iterable[str] = tuple(schemas.PARTITION_COLUMNS)) -> DataFrame:
    """Rows per day folder."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
