"""A course: its activity tables, its calendar and the stamp of the run."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnertrace.sources.manifest import hadoop_path
from learnertrace.sources.schemas import ACTIVITY


@dataclass(frozen=True)
class Course:
    """Activity tables by name, plus the settings every feature needs.

    A table is a DataFrame, or a function that gives one; then it is only looked
    up when a feature reads it. A table may be absent (many courses have no
    collaborations); the features that read it are then unavailable. Tables may be stored in
    folders by date; `day` then names that column, and what needs a range of time opens the folders
    of its days only.
    """

    tables: Mapping[str, DataFrame | Callable[[], DataFrame]]
    start: str
    weeks: int
    stamp: str
    day: str | None = None

    def __post_init__(self) -> None:
        unknown = set(self.tables) - set(ACTIVITY)
        if unknown:
            raise ValueError(f"not activity tables: {sorted(unknown)}")
        if self.weeks < 1:
            raise ValueError("a course lasts at least one week")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in ACTIVITY:
            raise AttributeError(name)
        if name not in self.tables:
            raise LookupError(f"this course has no table {name!r}")
        table = self.tables[name]
        if callable(table):
            table = table()
            object.__setattr__(self, name, table)
        return table

    @property
    def start_time(self) -> Column:
        return F.lit(self.start).cast("timestamp")

    @property
    def end_time(self) -> Column:
        """First moment after the last week: that many elapsed seconds after the start, as weeks
        are counted, whatever clocks do in between."""
        return F.timestamp_seconds(F.unix_timestamp(self.start_time) + F.lit(self.weeks * 604800))

    def on_days(self, frame: DataFrame, since: Column | None = None, until: Column | None = None) -> DataFrame:
        """Rows of the folders that may hold moments from `since` to before `until`, where `frame` has
        such folders. A day more on either side covers any time zone the dates were taken in."""
        if self.day is None or self.day not in frame.columns:
            return frame
        kept = F.lit(True)
        if since is not None:
            kept = kept & (F.col(self.day) >= F.date_sub(F.to_date(since), 1))
        if until is not None:
            kept = kept & (F.col(self.day) <= F.date_add(F.to_date(until), 1))
        # What has no date may have no time either, and is for the range of times to judge.
        return frame.filter(kept | F.col(self.day).isNull())

    @property
    def extracted(self) -> str:
        """The run stamp, to the second, as an SQL expression."""
        return f"TIMESTAMP '{self.stamp[:19]}' AS date_of_extraction"


def from_files(
    spark: SparkSession, root: str, start: str, weeks: int, stamp: str,
    format: str = "parquet", names: list[str] | None = None, day: str | None = None,
) -> Course:
    """Tables stored as one folder each under `root`, in any Spark file format.

    Formats that know their types are read with those and cast; text formats are read as
    the declared types. `day` is the column of dates by which tables are stored in folders, if
    any are (<table>/<day>=2024-01-31/...).
    """
    def read(name: str) -> DataFrame:
        reader, path = spark.read.format(format), f"{root.rstrip('/')}/{name}"
        if format in ("csv", "json", "text", "xml"):
            dated = day is not None and _has_folders(spark, path, day)
            return reader.schema(ACTIVITY[name] + (f", {day} DATE" if dated else "")).load(path)
        rows = reader.load(path)
        dated = f", {day} DATE" if day is not None and day in rows.columns else ""
        return conform(rows, ACTIVITY[name] + dated)
    return replace(_course(read, start, weeks, stamp, names), day=day)


def _has_folders(spark: SparkSession, path: str, day: str) -> bool:
    files, where = hadoop_path(spark, path)
    return any(entry.getPath().getName().startswith(f"{day}=") for entry in files.listStatus(where))


def from_catalog(
    spark: SparkSession, database: str, start: str, weeks: int, stamp: str,
    names: list[str] | None = None,
) -> Course:
    """Tables of one catalogued database; the schema is checked by the cast."""
    def read(name: str) -> DataFrame:
        return conform(spark.table(f"{database}.{name}"), ACTIVITY[name])
    return _course(read, start, weeks, stamp, names)


def from_jdbc(
    spark: SparkSession, url: str, properties: Mapping[str, str], start: str, weeks: int,
    stamp: str, splits: Mapping[str, tuple[str, object, object, int]] | None = None,
    names: list[str] | None = None,
) -> Course:
    """Tables of a relational database.

    `splits` gives, per large table, the (column, lowest, highest, parts) by
    which Spark reads it in parallel; a table without an entry is read by one
    task, which is right for the small dimension tables only.
    """
    splits = splits or {}

    def read(name: str) -> DataFrame:
        reader = spark.read.format("jdbc").options(url=url, dbtable=name, **properties)
        if name in splits:
            column, lowest, highest, parts = splits[name]
            reader = reader.options(partitionColumn=column, lowerBound=str(lowest),
                                    upperBound=str(highest), numPartitions=str(parts))
        return conform(reader.load(), ACTIVITY[name])
    return _course(read, start, weeks, stamp, names)


def conform(frame: DataFrame, ddl: str) -> DataFrame:
    """Select the columns of `ddl` and cast each to its declared type."""
    columns = [part.strip().split(" ") for part in ddl.split(",")]
    return frame.selectExpr(*[f"CAST({name} AS {kind}) AS {name}" for name, kind in columns])


def _course(
    read: Callable[[str], DataFrame], start: str, weeks: int, stamp: str, names: list[str] | None,
) -> Course:
    return Course({name: partial(read, name) for name in names or ACTIVITY}, start, weeks, stamp)
