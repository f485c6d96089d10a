"""A journal of table swaps, kept as small files beside the tables of a schema.

A commit puts staged tables in the place of others by renames, which no catalog does as one step for several
tables. Before the first rename the journal gets an *intent* file that names all of them. A driver that is lost
in between leaves it behind, and whoever comes next (``recover``) finishes the commit, since a staged table is only
named in an intent after all its checks passed. An *undo* mark turns the direction: renames failed, and the
tables go back. A *done* mark says that all renames are through and only old tables are left to drop.

Every file appears whole or not at all (written under another name, then renamed). The steps look at
which tables exist, so they can be repeated from any point. One writer at a time may commit to a schema;
readers may find a table missing for the moment between its two renames.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from saleslake.errors import SaleslakeError

LOG = logging.getLogger(__name__)
FOLDER = "_commits"
INTENT, UNDO, DONE = "intent", "undo", "done"


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(new)}")


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


@dataclass(frozen=True)
class Step:
    """One table of a commit: its name, the staged table, the name its predecessor steps aside to."""

    name: str
    staged: str
    old: str
    existed: bool

    def placed(self, spark: SparkSession) -> bool:
        """Whether the staged table has its final name by now."""
        if table_exists(spark, self.staged) or not table_exists(spark, self.name):
            return False
        return not self.existed or table_exists(spark, self.old)

    def forward(self, spark: SparkSession) -> None:
        if self.placed(spark):
            return
        if not table_exists(spark, self.staged):
            raise SaleslakeError(f"staged table {self.staged} is gone; {self.name} cannot be replaced")
        if self.existed and not table_exists(spark, self.old):
            rename(spark, self.name, self.old)
        rename(spark, self.staged, self.name)

    def back(self, spark: SparkSession) -> None:
        if self.placed(spark):
            rename(spark, self.name, self.staged)
        if self.existed and table_exists(spark, self.old):
            rename(spark, self.old, self.name)


class Journal:
    """The journal of one schema, on whatever file system its tables are."""

    def __init__(self, spark: SparkSession, schema: str) -> None:
        self.spark = spark
        self.place = f"{schema_location(spark, schema)}/{FOLDER}"

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.place}/{name}" if name else self.place)

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def write(self, commit: str, kind: str, text: str = "") -> None:
        files, new = self._files(), self._path(f".{commit}.{kind}.{uuid.uuid4().hex}")
        stream = files.create(new, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not files.rename(new, self._path(f"{commit}.{kind}")):
            raise SaleslakeError(f"the journal of {self.place} cannot be written")

    def begin(self, commit: str, steps: list[Step]) -> None:
        self.write(commit, INTENT, json.dumps([asdict(s) for s in steps]))

    def steps(self, commit: str) -> list[Step]:
        lines = self.spark.read.option("wholetext", "true").text(f"{self.place}/{commit}.{INTENT}")
        return [Step(**s) for s in json.loads(lines.first()["value"])]

    def open_commits(self) -> dict[str, set[str]]:
        """The marks of each commit that has not ended; a commit begins with its intent."""
        files = self._files()
        found: dict[str, set[str]] = {}
        if files.exists(self._path()):
            for status in files.listStatus(self._path()):
                commit, _, kind = status.getPath().getName().partition(".")
                if commit:
                    found.setdefault(commit, set()).add(kind)
        return {commit: kinds for commit, kinds in sorted(found.items()) if INTENT in kinds}

    def end(self, commit: str) -> None:
        """Forget a commit; its intent goes first, since marks without one mean nothing."""
        for kind in (INTENT, UNDO, DONE):
            self._files().delete(self._path(f"{commit}.{kind}"), False)


def schema_location(spark: SparkSession, schema: str) -> str:
    """The folder of a schema's tables; for a catalog that has none, a folder of the warehouse."""
    described = spark.sql(f"DESCRIBE SCHEMA {quoted(schema)}").collect()
    found = {r["info_name"]: r["info_value"] for r in described}.get("Location")
    return (found or f"{spark.conf.get('spark.sql.warehouse.dir')}/{schema}").rstrip("/")


def _schema_of(tables: list[str]) -> str:
    schemas = {name.rpartition(".")[0] for name in tables}
    if len(schemas) != 1:
        raise SaleslakeError(f"a commit is about the tables of one schema, not {sorted(schemas)}")
    return schemas.pop()


def commit(spark: SparkSession, staged: Mapping[str, str]) -> None:
    """Put staged tables in place of tables (qualified name -> staged name), all or none.

    If a rename fails, what was renamed goes back. What cannot go back now, or is left over by a lost
    driver, is put right by the next ``recover``.
    """
    if not staged:
        return
    number = uuid.uuid4().hex
    steps = [
        Step(name, new, f"{name}__old_{number[:12]}", table_exists(spark, name)) for name, new in staged.items()
    ]
    journal = Journal(spark, _schema_of(list(staged)))
    journal.begin(number, steps)
    try:
        for step in steps:
            step.forward(spark)
    except Exception:
        journal.write(number, UNDO)
        if _back(spark, steps):
            journal.end(number)
        raise
    _finish(spark, journal, number, steps)


def _back(spark: SparkSession, steps: list[Step]) -> bool:
    """Undo what can be undone, each table for itself; whether all of them are back."""
    failures = 0
    for step in steps:
        try:
            step.back(spark)
        except Exception:
            failures += 1
            LOG.exception("%s is not back in place yet", step.name)
    return not failures


def _finish(spark: SparkSession, journal: Journal, number: str, steps: list[Step]) -> None:
    journal.write(number, DONE)
    for step in steps:
        drop(spark, step.old)
        spark.catalog.refreshTable(quoted(step.name))
    journal.end(number)


def recover(spark: SparkSession, schema: str) -> dict[str, str]:
    """End the commits that a lost driver left open in a schema; commit -> 'finished' or 'undone'.

    To be called when no other writer is at work. It may itself be interrupted and called again.
    """
    if not spark.catalog.databaseExists(schema):
        return {}
    journal = Journal(spark, schema)
    ended = {}
    for number, marks in journal.open_commits().items():
        steps = journal.steps(number)
        whole = all(s.placed(spark) or table_exists(spark, s.staged) for s in steps)
        if DONE in marks:
            _finish_again(spark, journal, number, steps)
        elif UNDO not in marks and whole:
            for step in steps:
                step.forward(spark)
            _finish(spark, journal, number, steps)
        else:
            if UNDO not in marks:
                journal.write(number, UNDO)
            if not _back(spark, steps):
                raise SaleslakeError(f"commit {number} of {schema} can be neither finished nor undone")
            for step in steps:
                drop(spark, step.staged)
            journal.end(number)
        ended[number] = "finished" if DONE in marks or (UNDO not in marks and whole) else "undone"
        LOG.warning("commit %s of %s was left open and is %s now", number, schema, ended[number])
    return ended


def _finish_again(spark: SparkSession, journal: Journal, number: str, steps: list[Step]) -> None:
    for step in steps:
        drop(spark, step.old)
    journal.end(number)
