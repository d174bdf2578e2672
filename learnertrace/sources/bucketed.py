"""Wide tables stored by learner, so that joins and windows per learner need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from learnertrace.sources.manifest import Manifest

KEY, ORDER = "user_id", "feature_week"


def save_by_learner(rows: DataFrame, path: str, buckets: int = 64) -> None:
    """Store rows in buckets of learners, sorted by learner and week, as the path's newest version.

    Two tables with as many buckets can be joined on the learner as they are. The number of buckets
    should let one fit a task; a learner's rows are as many as weeks.
    """
    spark, manifest = rows.sparkSession, Manifest(rows.sparkSession, path)
    before, folder = manifest.read()[0], manifest.new_folder()
    name = _name()
    (rows.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY, ORDER)
     .option("path", f"{manifest.folder}/{folder}").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table only lists them
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    manifest.commit({"folder": folder, "columns": ddl, "buckets": buckets}, before)


def open_by_learner(spark: SparkSession, path: str) -> DataFrame:
    """A table that `save_by_learner` stored, in this or another session, with its buckets known."""
    listed = Manifest(spark, path).read()[1]
    if not listed:
        raise LookupError(f"no table in {path}")
    name = _name()
    spark.sql(f"CREATE TABLE {name} ({listed['columns']}) USING parquet CLUSTERED BY ({KEY}) "
              f"SORTED BY ({KEY}, {ORDER}) INTO {listed['buckets']} BUCKETS "
              f"LOCATION '{path.rstrip('/')}/{listed['folder']}'")
    return spark.table(name)


def _name() -> str:
    return f"by_learner_{uuid.uuid4().hex}"
