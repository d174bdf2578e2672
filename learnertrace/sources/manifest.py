"""Which files are a table: numbered lists, of which the newest whole one counts.

A writer puts its files into a new folder and then adds the next list. Until that list is there
whole, readers see the state before; afterwards they see the new one; never a mixture. A list is a
new file whose creation fails if another writer made it first, so of two writers that started
from the same state one fails and has changed nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

END = "\n.\n"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


class Manifest:
    """The lists of one table, in files `list-<number>.json` of a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _numbers(self) -> list[int]:
        files, root = hadoop_path(self.spark, self.folder)
        if not files.exists(root):
            return []
        names = [entry.getPath().getName() for entry in files.listStatus(root)]
        return sorted(int(n[5:-5]) for n in names if n.startswith("list-") and n.endswith(".json"))

    def _text(self, number: int) -> str:
        files, where = hadoop_path(self.spark, f"{self.folder}/list-{number:08d}.json")
        stream = files.open(where)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def read(self) -> tuple[int, dict]:
        """Number and contents of the newest whole list; 0 and nothing before the first."""
        for number in reversed(self._numbers()):
            text = self._text(number)
            if text.endswith(END):  # else its writer is still at it, or gone
                return number, json.loads(text.removesuffix(END))
        return 0, {}

    def commit(self, parts: dict, after: int) -> int:
        """Add a list that follows the one read as number `after`; raises if another writer was first."""
        if self.read()[0] != after:
            raise RuntimeError(f"{self.folder} was changed by another writer")
        number = max([after, *self._numbers()]) + 1
        files, where = hadoop_path(self.spark, f"{self.folder}/list-{number:08d}.json")
        stream = files.create(where, False)  # not if it exists
        try:
            stream.write((json.dumps(parts) + END).encode())
        finally:
            stream.close()
        return number

    def new_folder(self) -> str:
        """A name, below the table's folder, that no list has yet."""
        return f"data-{uuid.uuid4().hex}"

    def clean(self, keep: int = 1) -> None:
        """Remove lists but the newest `keep`, and folders of data that none of these names.

        Not while others write or still read what is older.
        """
        files, root = hadoop_path(self.spark, self.folder)
        newest = self._numbers()[-keep:]
        named = "".join(self._text(number) for number in newest)
        for entry in files.listStatus(root):
            name = entry.getPath().getName()
            old = name.startswith("list-") and int(name[5:-5]) not in newest
            if old or name.startswith("data-") and name not in named:
                files.delete(entry.getPath(), True)
