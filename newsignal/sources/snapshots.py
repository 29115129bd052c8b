"""Tables that are published together, by one commit that readers see whole or not at all.

A set of tables lives below a root folder:

    data/<table>/write=<id>/<by>=<date>/...   files of one write, never changed
    commits/<number>.json                     for each table: date -> write

A writer first writes the files of its dates, all of them, and then adds the next commit.
Readers are bound to a commit: what a writer has not committed, or commits later, is not
there for them.  Folders that no kept commit names are removed by ``vacuum``.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsignal.sources import files
from newsignal.sources.sinks import counted, observed

GRACE = 24 * 3600.0  # seconds that an uncommitted write may take


class Conflict(Exception):
    """Another writer has committed one of the dates meanwhile."""


@dataclass(frozen=True)
class Snapshots:
    spark: SparkSession
    root: str
    by: str = "event_date"

    def versions(self) -> list[int]:
        found = files.names(self.spark, f"{self.root}/commits")
        return sorted(int(n[:-5]) for n in found if n.endswith(".json") and not n.startswith("."))

    def commit(self, version: int | None = None) -> tuple[int, dict]:
        """Number and contents of a commit, of the latest by default; (0, {}) before the first."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return 0, {}
        return version, json.loads(files.read_text(self.spark, f"{self.root}/commits/{version:08d}.json"))

    def read(self, table: str, version: int | None = None, dates: list[str] | None = None) -> DataFrame:
        """The table at a commit, of the latest by default; only the folders of ``dates`` are listed."""
        number, tables = self.commit(version)
        if table not in tables:
            raise ValueError(f"commit {number} has no table {table}")
        entry = tables[table]
        base = f"{self.root}/data/{table}"
        folders = [
            f"{base}/write={write}/{self.by}={date}" for date, write in sorted(entry["dates"].items())
            if write and (dates is None or date in dates)
        ]
        schema = self.spark.createDataFrame([], entry["schema"]).schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(entry["schema"]).option("basePath", base).parquet(*folders)
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    def stage(self, table: str, df: DataFrame, dates: list[str]) -> dict:
        """Writes the rows of the given dates into a folder of their own; nobody reads it yet.

        A date without rows is remembered as empty.
        """
        write = uuid.uuid4().hex
        rows = df.withColumn(self.by, F.col(self.by).cast("string"))
        wanted, seen = counted(rows.filter(F.col(self.by).isin(dates)), self.by)
        wanted.hint("rebalance", self.by).write.partitionBy(self.by).parquet(f"{self.root}/data/{table}/write={write}")
        n, found = observed(seen)
        return {
            "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "rows": n,
            "dates": {date: write if date in found else None for date in sorted(set(dates))},
        }

    def publish(self, frames: dict[str, tuple[DataFrame, list[str]]], attempts: int = 20) -> int:
        """Replaces the dates of several tables in one commit; returns its number."""
        read, _ = self.commit()
        return self.add({t: self.stage(t, df, dates) for t, (df, dates) in frames.items()}, read, attempts)

    def add(self, staged: dict[str, dict], read: int, attempts: int = 20) -> int:
        """Commits what ``stage`` has written by a writer that began at commit ``read``.

        Where another writer was faster, the commit is made anew on top of the other's.  If
        that one has changed a date of this one, there is a ``Conflict`` and nothing changes.
        """
        _, began = self.commit(read)
        for _ in range(attempts):
            number, tables = self.commit()
            merged = {t: {**e, "dates": dict(e["dates"])} for t, e in tables.items()}
            for table, entry in staged.items():
                before = began.get(table, {}).get("dates", {})
                now = tables.get(table, {}).get("dates", {})
                if changed := [d for d in entry["dates"] if before.get(d) != now.get(d)]:
                    raise Conflict(f"{table}: {', '.join(changed)}")
                merged[table] = {"schema": entry["schema"], "dates": {**now, **entry["dates"]}}
            path = f"{self.root}/commits/{number + 1:08d}.json"
            if files.write_new(self.spark, path, json.dumps(merged)):
                return number + 1
        raise Conflict(f"{attempts} other commits came first")

    def vacuum(self, keep: int = 1, grace: float = GRACE) -> list[str]:
        """Removes older commits than the last ``keep`` and the folders no kept commit names.

        Folders younger than ``grace`` seconds may belong to a writer that is still at work
        and stay.  Returns what was removed.
        """
        versions, gone = self.versions(), []
        kept = [self.commit(v)[1] for v in versions[-keep:]]
        for version in versions[:-keep]:
            files.delete(self.spark, f"{self.root}/commits/{version:08d}.json")
        for table in files.names(self.spark, f"{self.root}/data"):
            used: dict[str, set[str]] = {}
            for tables in kept:
                for date, write in tables.get(table, {"dates": {}})["dates"].items():
                    used.setdefault(write, set()).add(date)
            for write in files.partitions(self.spark, f"{self.root}/data/{table}", "write"):
                folder = f"{self.root}/data/{table}/write={write}"
                if time.time() - files.modified(self.spark, folder) < grace:
                    continue
                if write not in used:
                    gone.append(folder)
                    continue
                dates = files.partitions(self.spark, folder, self.by)
                gone += [f"{folder}/{self.by}={d}" for d in dates if d not in used[write]]
        for folder in gone:
            files.delete(self.spark, folder)
        return gone
