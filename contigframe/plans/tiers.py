"""Tiers of a run, one after the other: each result is written before the next tier begins, so a tier that fails, also while it runs, leaves what was there.

A tier that only adds features writes these alone, beside the tables that are there; one that changes features writes all, and the tables before go.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigframe.operators import landing, tables
from contigframe.plans.config import short_reason

COLUMNS = {"contig": "string", "id": "string", "s": "long", "e": "long", "strand": "int", "score": "double", "aa": "string", "partial5": "boolean", "partial3": "boolean", "pseudogene": "boolean", "num": "long", "ord": "int", **landing.FIELDS}


def shaped(df: DataFrame, **given: object) -> DataFrame:
    """The columns of a feature, absent ones as given, else empty."""
    empty = lambda t: F.array().cast(t) if t.startswith("array") else F.lit(0 if t == "int" else False if t == "boolean" else None).cast(t)
    value = lambda c, t: F.col(c) if c in df.columns else F.lit(given[c]) if c in given else empty(t)
    return df.select(*[value(c, t).cast(t).alias(c) for c, t in COLUMNS.items()])


#: What a tier may fail with: Spark's errors, of the plan or of a task, and those of missing or odd inputs.
FAILURES = (PySparkException, Py4JError, ValueError, KeyError, OSError)


@dataclass
class Added:
    """New features of a tier that changes no others."""

    features: DataFrame


class Tiers:
    """The features so far, and the tiers that were skipped with a word on why."""

    def __init__(self, features: DataFrame):
        self.skipped, self.done, self.paths = {}, 0, []
        self._put(features)

    def _put(self, new: DataFrame | Added) -> None:
        rows = shaped(new.features if isinstance(new, Added) else new)
        path, old = tables.placed(rows, "features"), [] if isinstance(new, Added) else self.paths
        self.paths = [path] if old else [*self.paths, path]
        self.features = rows.sparkSession.read.schema(rows.schema).parquet(*self.paths)
        for folder in old:
            tables.removed(rows.sparkSession, folder)

    def required(self, change: Callable[[DataFrame], DataFrame | Added]) -> None:
        """A tier without which there is no result: what fails here ends the run."""
        self.done += 1
        self._put(change(self.features))

    def optional(self, name: str, wanted: bool, change: Callable[[DataFrame], DataFrame | Added | None]) -> None:
        """A tier that may be missing or fail. It gives the new features; nothing, if what it needs isn't there."""
        if not wanted:
            return
        try:
            new = change(self.features)
            if new is None:
                self.skipped[name] = "missing database"
            else:
                self.required(lambda _: new)
        except FAILURES as error:
            self.skipped[name] = short_reason(error)

    def found(self, name: str, wanted: bool, search: Callable[[DataFrame], DataFrame | None]) -> DataFrame | None:
        """A table beside the features, under the same rules."""
        if not wanted:
            return None
        try:
            got = search(self.features)
            if got is None:
                self.skipped[name] = "missing database"
            return None if got is None else tables.written(got, name)
        except FAILURES as error:
            self.skipped[name] = short_reason(error)
            return None

    def added(self, new: DataFrame, kind: str | None = None, **given: object) -> Added:
        """New features, which appear after all of earlier tiers."""
        more = shaped(new if kind is None else new.withColumn("kind", F.lit(kind)), **given)
        return Added(more.withColumn("ord", F.lit(self.done + 1)))

    def ended(self, last: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A table made of the features, which go."""
        got = tables.written(last(self.features), "resolved")
        for folder in self.paths:
            tables.removed(got.sparkSession, folder)
        self.paths, self.features = [], got
        return got
