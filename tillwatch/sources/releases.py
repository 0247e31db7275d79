"""Publishing the tables of a run as a whole.

Each run writes into a folder of its own, OUT/runs/RUN. When all of its tables are there, one small file,
OUT/published/NUMBER.json, names them; the file with the highest number is the current release. It is written
under another name and renamed, so a reader sees all of it or none. A run that ends halfway publishes nothing, and
readers keep the release before it; those that have opened one keep reading its files.

If two runs publish at once, the second takes the next number. (A file system whose rename replaces files, as a
local one, may lose the first's entry then, not its tables.)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillwatch.functions.timekeys import utc_now
from tillwatch.sources.store import file_system

ATTEMPTS = 20


@dataclass(frozen=True)
class Release:
    """The published tables of one run."""

    spark: SparkSession
    number: int
    run: str
    folder: str
    tables: tuple[str, ...]

    def path(self, table: str) -> str:
        if table not in self.tables:
            raise KeyError(f"release {self.number} has no table {table!r}")
        return f"{self.folder}/{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))


class Releases:
    """The runs and releases below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._log = f"{self.folder}/published"

    def new_run(self) -> str:
        """A folder for the tables of a run."""
        return f"{self.folder}/runs/{utc_now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"

    def numbers(self) -> list[int]:
        """The numbers of the releases, oldest first."""
        system, path = file_system(self.spark, self._log)
        if not system.exists(path):
            return []
        names = [status.getPath().getName() for status in system.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def release(self, number: int | None = None) -> Release | None:
        """The release of that number, by default the current one; None before the first."""
        if number is None:
            found = self.numbers()
            if not found:
                return None
            number = found[-1]
        (line,) = self.spark.read.text(self._entry(number), wholetext=True).collect()
        entry = json.loads(line[0])
        return Release(self.spark, number, entry["run"], f"{self.folder}/runs/{entry['run']}", tuple(entry["tables"]))

    def publish(self, run_folder: str, tables: Iterable[str]) -> Release:
        """Make the tables of a run the current release."""
        run, tables = run_folder.rstrip("/").rsplit("/", 1)[1], sorted(tables)
        text = json.dumps({"run": run, "published_at": utc_now().isoformat(), "tables": tables})
        system, draft = file_system(self.spark, f"{self._log}/.{uuid.uuid4().hex}")
        out = system.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        for _ in range(ATTEMPTS):
            number = max(self.numbers(), default=0) + 1
            _, entry = file_system(self.spark, self._entry(number))
            if not system.exists(entry) and system.rename(draft, entry):
                return Release(self.spark, number, run, f"{self.folder}/runs/{run}", tuple(tables))
        system.delete(draft, False)
        raise RuntimeError(f"could not publish {run}: others keep publishing to {self.folder}")

    def discard(self, run_folder: str) -> None:
        """Delete what a run that is not published has written."""
        system, path = file_system(self.spark, run_folder)
        system.delete(path, True)

    def prune(self, keep: int) -> list[int]:
        """Delete all releases but the newest `keep` with their runs; return their numbers."""
        if keep < 1:
            raise ValueError(f"at least one release must be kept, got {keep}")
        old = self.numbers()[:-keep]
        kept = {self.release(number).run for number in self.numbers()[-keep:]}
        for number in old:
            release = self.release(number)
            system, entry = file_system(self.spark, self._entry(number))
            # The entry goes first: no reader finds a release whose files are gone.
            system.delete(entry, False)
            if release.run not in kept:
                self.discard(release.folder)
        return old

    def _entry(self, number: int) -> str:
        return f"{self._log}/{number:010d}.json"
