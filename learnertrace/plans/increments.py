"""A course that is still running: new weeks' states are computed and merged into stored ones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from learnertrace.operators import states
from learnertrace.plans.features import features
from learnertrace.sources.course import Course
from learnertrace.sources.manifest import Manifest


class StateStore:
    """States of the ranges of time that were taken in so far, under `root`.

    Each call of `add` reads the activity of one range only, writes its states into a folder and
    then lists it (`Manifest`): a call that breaks off changes nothing, and may be repeated. Ranges
    follow each other, so none is counted twice or left out. What comes in late, with a time
    in a range taken in before, is not seen until the store is built anew.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.manifest = Manifest(spark, self.root)

    def ranges(self) -> list[tuple[str | None, str | None]]:
        """Beginning and end of each range; None where it has none."""
        return [tuple(part["range"]) for part in self.manifest.read()[1].get("parts", [])]

    def add(self, course: Course, until: str | None = None) -> None:
        """Take in the activity from where the last range ended to before `until`.

        The first range has no beginning, and also holds what has no time. Without `until` all
        that follows is taken in, and nothing can be added later.
        """
        before, listed = self.manifest.read()
        parts = self._parts(listed)
        since = parts[-1]["range"][1] if parts else None
        if parts and since is None:
            raise ValueError("the last range has no end")
        if until is not None and since is not None and until <= since:
            raise ValueError(f"{until} is not after {since}, where the last range ended")
        folder, kinds = self.manifest.new_folder(), []
        for kind, rows in states.states(course, since, until, self._kinds(course)).tables().items():
            rows.write.parquet(f"{self.root}/{folder}/{kind}")
            kinds.append(kind)
        self.manifest.commit({"parts": [*parts, {"range": [since, until], "folder": folder, "kinds": kinds,
                                                  "form": states.FORM}]}, before)

    @staticmethod
    def _parts(listed: dict) -> list[dict]:
        parts = listed.get("parts", [])
        if any(part.get("form") != states.FORM for part in parts):
            raise ValueError("the store holds states of an earlier form; build it anew")
        return parts

    @staticmethod
    def _kinds(course: Course) -> list[str]:
        """The kinds of states for which the course has the tables."""
        needs = {"events": "observed_events", "submissions": "submissions", "contributions": "collaborations"}
        return [kind for kind, table in needs.items() if table in course.tables]

    def read(self) -> states.States:
        """States of all that was taken in."""
        parts = self._parts(self.manifest.read()[1])
        found: dict[str, DataFrame] = {}
        for kind in states.KEYS:
            paths = [f"{self.root}/{part['folder']}/{kind}" for part in parts if kind in part["kinds"]]
            if paths:
                rows = self.spark.read.parquet(*paths)
                found[kind] = rows if len(paths) == 1 else states.merged(kind, rows)
        return states.States(**found)

    def features(self, course: Course, only: Iterable[int] | None = None, skip: Iterable[int] = ()) -> DataFrame:
        """Weekly features of all that was taken in; of the course's tables only those that
        describe problems, urls and resources are read."""
        return features(course, only=only, skip=skip, known_states=self.read())
