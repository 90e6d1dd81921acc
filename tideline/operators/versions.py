"""Parquet tables as versions: data files that never change, and one small file per version that lists them.

A version is made by writing new data files and then one list, which appears whole or not at all.
A reader takes the newest list, so it sees the table before or after a change and nothing between;
a writer that stops anywhere leaves a readable table and some files that no list names. A merge
rewrites only the files in which it finds a key. Batches that were applied are noted in the list, so
a batch that is applied again changes nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import changes as ch
from tideline.operators.groups import stored, storing
from tideline.sources import files

# Files below this age that no version names may belong to a write that goes on.
GRACE_SECONDS = 86_400
# Rows of a data file where the caller names no number of files.
FILE_ROWS = 2_000_000


class Conflict(RuntimeError):
    """Another writer made the version that this one was to make."""


@dataclass
class Version:
    """One version: its number, data files, columns, clustering key, batches applied, and what was done."""

    number: int
    files: list[str]
    schema: str
    key: str | None = None
    batches: dict[str, dict] = field(default_factory=dict)
    done: dict = field(default_factory=dict)
    token: str = ""


@dataclass
class Difference:
    """Rows of the files that a later version does not have, and of those that only it has."""

    removed: DataFrame
    added: DataFrame


class VersionedTable:
    """A table under a folder: ``data/`` with the files, ``versions/`` with one list per version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- reading ----------------------------------------------------------------

    def numbers(self) -> list[int]:
        """Versions that can be read, oldest first."""
        found = files.listed(self.spark, f"{self.path}/versions")
        return sorted(int(e.name.removesuffix(".json")) for e in found if e.name.endswith(".json") and e.name[0] != ".")

    def exists(self) -> bool:
        return bool(self.numbers())

    def version(self, number: int | None = None) -> Version:
        """The list of a version, by default of the newest."""
        if number is None:
            numbers = self.numbers()
            if not numbers:
                raise FileNotFoundError(f"no table at {self.path}")
            number = numbers[-1]
        return Version(**json.loads(files.read_text(self.spark, f"{self.path}/versions/{number:012d}.json")))

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, by default of the newest."""
        version = self.version(number)
        return self._rows(version.files, version.schema)

    def difference(self, older: int, newer: int) -> Difference:
        """What changed between two versions, by whole files; rows of rewritten files are on both sides."""
        a, b = self.version(older), self.version(newer)
        gone, new = set(a.files) - set(b.files), set(b.files) - set(a.files)
        return Difference(self._rows(sorted(gone), a.schema), self._rows(sorted(new), b.schema))

    def _rows(self, names: list[str], schema: str) -> DataFrame:
        kinds = T.StructType.fromJson(json.loads(schema))
        if not names:
            return self.spark.createDataFrame([], kinds)
        return self.spark.read.schema(kinds).parquet(*[f"{self.path}/data/{name}" for name in names])

    # ---- writing ----------------------------------------------------------------

    def replace(self, df: DataFrame, key: str | None = None, batch: str | None = None, n_files: int | None = None) -> Version:
        """The next version holds the rows of ``df``, which may read this table.

        With a key, files hold ranges of it, so that later merges find their keys in few files.
        """
        before = self.version() if self.exists() else None
        if before and batch is not None and batch in before.batches:
            return before
        with storing():
            if key is not None:
                # The cuts between files take a pass of their own, which reads the stored rows.
                df = self._clustered(stored(df), key, n_files)
            names, rows = self._write(df)
        number = before.number + 1 if before else 1
        batches = dict(before.batches) if before else {}
        return self._commit(Version(number, names, df.schema.json(), key, batches), {"rows": rows, "base": number - 1}, batch)

    def merge(
        self,
        changes: DataFrame,
        key: str | None = None,
        batch: str | None = None,
        same: str = "equal",
        broadcast_rows: int = ch.BROADCAST_ROWS,
    ) -> Version:
        """The next version after changes (``op`` I, U or D, as in ``apply_changes``).

        The key column is scanned for files with changed keys; only files in which a row is updated
        or deleted are read and written anew, in ranges of the key, and inserts of keys that no file
        has go along. All other files stay as they are. A batch that was applied before changes
        nothing. ``same``: ``equal`` lets NULL keys match nothing, ``null_safe`` lets them match.
        """
        before = self.version()
        if batch is not None and batch in before.batches:
            return before
        key = key or before.key
        target = self._rows(before.files, before.schema)
        columns = target.columns
        if {c.lower() for c in changes.columns} != {c.lower() for c in columns} | {"op"}:
            raise ValueError(f"changes have columns {changes.columns}; expected op and {columns}")
        small = ch.inspect_changes(changes, key, broadcast_rows)
        found = stored(self._located(target, changes, key, small, same))
        moving = changes.filter(F.col("op").isin("U", "D")).select(F.col(key).alias("_k"), F.col("op").alias("_op"), F.struct(*columns).alias("_new"))
        # As many names as files, which the list of the version holds anyway.
        hit = found.join(moving.select("_k"), _same("_key", "_k", same), "left_semi").select("_file").distinct()
        touched = sorted(row["_file"] for row in hit.collect())
        updated = F.col("_op").eqNullSafe("U")
        kept = (
            self._rows(touched, before.schema)
            .join(ch.hinted(moving, small), _same(key, "_k", same), "left")
            .filter(~F.col("_op").eqNullSafe("D"))
            .select(*[F.when(updated, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns])
        )
        inserts = changes.filter("op = 'I'").select(*columns)
        known = found.select("_key").distinct()
        new = inserts.join(ch.hinted(known, small), _same(key, "_key", same), "left_anti")
        rows = self._clustered(kept.unionByName(new), key, len(touched) + 1)
        names, written = self._write(rows)
        stays = [name for name in before.files if name not in set(touched)]
        done = {"base": before.number, "kept": len(stays), "rewritten": len(touched), "written": len(names), "rows": written}
        return self._commit(Version(before.number + 1, stays + names, before.schema, before.key, dict(before.batches)), done, batch)

    def _located(self, target: DataFrame, changes: DataFrame, key: str, small: bool, same: str) -> DataFrame:
        """Changed keys that the table has, with the files that have them.

        Keys beyond the smallest and greatest changed one are passed over by the files' statistics.
        """
        low, high = changes.agg(F.min(key), F.max(key)).first()
        names = F.split(F.col("_metadata.file_path"), "/")
        place = F.concat_ws("/", F.element_at(names, -2), F.element_at(names, -1))
        rows = target.select(F.col(key).alias("_key"), place.alias("_file"))
        if low is not None and same == "equal":
            rows = rows.filter(F.col("_key").between(F.lit(low), F.lit(high)))
        wanted = ch.hinted(changes.select(F.col(key).alias("_k")), small)
        return rows.join(wanted, _same("_key", "_k", same), "left_semi").distinct()

    def _clustered(self, df: DataFrame, key: str, n_files: int | None) -> DataFrame:
        n = n_files or max(1, -(-df.count() // FILE_ROWS))
        return df.repartitionByRange(n, key).sortWithinPartitions(key)

    def _write(self, df: DataFrame) -> tuple[list[str], int]:
        """Names of the files that the rows were written to, under a folder of their own, and their number."""
        folder, counted = uuid.uuid4().hex, Observation()
        rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        rows.write.option("compression", "snappy").parquet(f"{self.path}/data/{folder}")
        found = files.listed(self.spark, f"{self.path}/data/{folder}")
        names = sorted(f"{folder}/{e.name}" for e in found if e.name.endswith(".parquet"))
        return names, counted.get["rows"]

    def _commit(self, version: Version, done: dict, batch: str | None) -> Version:
        version.done, version.token = done, uuid.uuid4().hex
        if batch is not None:
            version.batches[batch] = {"version": version.number, **done}
        path = f"{self.path}/versions/{version.number:012d}.json"
        if not files.put_new(self.spark, path, json.dumps(asdict(version))):
            raise Conflict(f"version {version.number} of {self.path} was made by another writer")
        if self.version(version.number).token != version.token:
            raise Conflict(f"version {version.number} of {self.path} was made by another writer")
        return version

    # ---- old versions -----------------------------------------------------------

    def expire(self, keep: int = 2, grace_seconds: float = GRACE_SECONDS) -> list[str]:
        """Delete all but the newest ``keep`` versions, and data files that none of those names.

        Lists go first, so no list names a file that is gone. Files younger than the grace stay:
        they may belong to a version that is being written.
        """
        numbers = self.numbers()
        if keep < 1:
            raise ValueError("a table keeps one version at least")
        for number in numbers[:-keep]:
            files.delete(self.spark, f"{self.path}/versions/{number:012d}.json")
        named = {name for number in numbers[-keep:] for name in self.version(number).files}
        oldest = (time.time() - grace_seconds) * 1000
        gone = []
        for folder in files.listed(self.spark, f"{self.path}/data"):
            inside = files.listed(self.spark, f"{self.path}/data/{folder.name}")
            loose = [e for e in inside if f"{folder.name}/{e.name}" not in named]
            if any(e.changed > oldest for e in loose) or folder.changed > oldest:
                continue
            if len(loose) == len(inside):
                files.delete(self.spark, f"{self.path}/data/{folder.name}")
            else:
                for e in loose:
                    files.delete(self.spark, f"{self.path}/data/{folder.name}/{e.name}")
            gone += [f"{folder.name}/{e.name}" for e in loose if e.name.endswith(".parquet")]
        return gone


def _same(a: str, b: str, same: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b)) if same == "null_safe" else F.col(a) == F.col(b)
