"""Feature tables on shared storage, and tables that cut a plan in two."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache, partial
from typing import Any
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnertrace.sources.course import conform
from learnertrace.sources.manifest import Manifest, hadoop_path
from learnertrace.sources.schemas import OUTPUT

#: The folders of a write: copies of the run's stamp and the feature, which the files hold as well.
LEAVES = ["run", "feature"]


class FeatureStore:
    """The output tables, one folder each under `root`.

    A write makes a folder of its own, in it one of Parquet files for each run and feature, and
    then adds a list of the folders that are the table now (`Manifest`). A write that breaks off
    changes nothing, a repeated run leaves no duplicates, a reader sees one state of the table from
    beginning to end, and of one feature it opens only the files.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def manifest(self, table: str) -> Manifest:
        return Manifest(self.spark, self.path(table))

    def create(self, table: str) -> None:
        """(Re)create a table, empty."""
        manifest = self.manifest(table)
        manifest.commit({}, manifest.read()[0])

    def replace(self, table: str, rows: DataFrame) -> None:
        """Make `rows` the whole table."""
        self._write(table, [rows], lambda key: False)

    def append(self, table: str, rows: DataFrame, ids: Iterable[int] = (),
               stamp: str | None = None) -> None:
        """Add feature rows; the same run and feature written again is replaced.

        With `ids` and `stamp`, all that was stored of these features for that run goes, also where
        a feature has no rows any more.
        """
        gone = {f"{stamp[:19]}|{i}" for i in ids} if stamp is not None else set()
        self._write(table, [rows], lambda key: key not in gone)

    def append_all(self, writes: Mapping[str, Sequence[tuple[DataFrame, Iterable[int]]]], stamp: str) -> None:
        """Add rows of one run to several tables, for each in parts of different features.

        All parts are written at the same time, and those of a table are listed together.
        """
        def append(table: str, parts: Sequence[tuple[DataFrame, Iterable[int]]]) -> None:
            gone = {f"{stamp[:19]}|{i}" for _, ids in parts for i in ids}
            self._write(table, [rows for rows, _ in parts], lambda key: key not in gone)

        at_once(self.spark, [partial(append, table, parts) for table, parts in writes.items()])

    def _write(self, table: str, rows: Sequence[DataFrame], stays) -> None:
        manifest = self.manifest(table)
        before, parts = manifest.read()
        folders = [manifest.new_folder() for _ in rows]
        at_once(self.spark, [partial(self._files, table, frame, f"{self.path(table)}/{folder}")
                             for frame, folder in zip(rows, folders)])
        kept = {key: leaf for key, leaf in parts.items() if stays(key)}
        for folder in folders:
            kept |= self._leaves(table, folder)
        manifest.commit(kept, before)

    def _files(self, table: str, rows: DataFrame, path: str) -> None:
        """Rebalancing gathers a feature's rows into few files without forcing a large feature into one task."""
        rows = conform(rows, OUTPUT[table])
        if "feature_value" not in rows.columns:
            rows.write.parquet(path)
            return
        stamp = F.date_format("date_of_extraction", "yyyy-MM-dd HH:mm:ss")
        rows = rows.withColumns({"run": stamp, "feature": F.col("feature_id")})
        rows.hint("rebalance", *LEAVES).write.partitionBy(*LEAVES).parquet(path)

    def _leaves(self, table: str, folder: str) -> dict[str, str]:
        """Run and feature (for other tables nothing) -> where below the table's folder it is."""
        if "feature_value" not in OUTPUT[table]:
            return {"": folder}
        files, root = hadoop_path(self.spark, f"{self.path(table)}/{folder}")
        found = {}
        for run in files.listStatus(root):
            name = run.getPath().getName()
            if name.startswith("run="):
                for feature in files.listStatus(run.getPath()):
                    last = feature.getPath().getName()
                    found[f"{unquote(name[4:])}|{last.removeprefix('feature=')}"] = f"{folder}/{name}/{last}"
        return found

    def read(self, table: str, ids: Iterable[int] | None = None,
             stamp: str | None = None) -> DataFrame:
        """Rows of a table as it is now, of some features and one run if given."""
        parts = self.manifest(table).read()[1]
        wanted = None if ids is None else {str(i) for i in ids}
        leaves = []
        for key, leaf in sorted(parts.items()):
            run, _, feature = key.rpartition("|")
            if (wanted is None or feature in wanted) and (stamp is None or run == stamp[:19]):
                leaves.append(f"{self.path(table)}/{leaf}")
        if not leaves:
            return self.spark.createDataFrame([], OUTPUT[table])
        return self.spark.read.schema(OUTPUT[table]).parquet(*leaves)


def at_once(spark: SparkSession, actions: Sequence[Callable[[], Any]]) -> list:
    """The results of actions that do not need each other, run at the same time.

    Where one waits for its last tasks, or has few, those of the others fill the cores. All have
    ended when an error of one is raised.
    """
    if len(actions) == 1:
        return [actions[0]()]
    threaded = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max(1, len(actions))) as pool:
        running = [pool.submit(threaded(action)) for action in actions]
    return [action.result() for action in running]


def dropped(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate tables that nothing reads any more."""
    for path in paths:
        files, where = hadoop_path(spark, path)
        files.delete(where, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables.

    Only a local session without the setting falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"learnertrace-{application}-")


def written(frame: DataFrame, *partitions: str, used: list[str] | None = None) -> DataFrame:
    """Write `frame` as a table in the shared folder and read it back.

    What follows starts from the files, so it neither repeats the work before
    nor depends on the executors that did it. The table's path is added to `used`,
    for a caller that removes it when done.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    if used is not None:
        used.append(path)
    rebalanced = frame.hint("rebalance", *partitions) if partitions else frame
    rebalanced.write.partitionBy(*partitions).parquet(path)
    return spark.read.schema(frame.schema).parquet(path).select(*frame.columns)
