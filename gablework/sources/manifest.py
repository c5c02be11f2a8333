"""Versioned sets of files: what readers see, what pruning may remove.

A store is a folder with ``files/<set>/``, the file sets that writers made, and
``versions/<number>.json``, one small manifest per version that names its
sets.  A version exists once its manifest has its final name, which the file
system gives to one writer only.  What no version names is invisible.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Version:
    """A committed version: its number, its sets of files, and when it was made (seconds)."""

    number: int
    sets: tuple[str, ...]
    made_at: float


class Store:
    """A versioned table; the folder may be on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop
        self._path = hadoop.fs.Path
        self._context = hadoop.fs.FileContext
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)

    def _file(self, *parts: str):
        return self._path("/".join([self.path, *parts]))

    def numbers(self) -> list[int]:
        """Numbers of all versions, rising."""
        folder = self._file("versions")
        if not self._fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int) -> Version:
        text = "\n".join(r[0] for r in self.spark.read.text(f"{self.path}/versions/{number:012d}.json").collect())
        found = json.loads(text)
        return Version(found["number"], tuple(found["sets"]), found["made_at"])

    def write_set(self, rows: DataFrame) -> str:
        """Write rows as a new set that no version names yet; its name."""
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/files/{name}")
        return name

    def _claim(self, version: Version) -> bool:
        """Give a manifest its final name; False if another writer has that number."""
        fs, draft = self._fs, self._file("versions", f".draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(json.dumps(asdict(version)).encode())
        out.close()
        final = self._file("versions", f"{version.number:012d}.json")
        context = self._context.getFileContext(self._path(self.path).toUri(), self._conf)
        if fs.exists(final):
            fs.delete(draft, False)
            return False
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            # Without the option to overwrite, a name that is taken refuses.
            context.rename(draft, final, options)
        except Exception:
            if fs.exists(draft):
                fs.delete(draft, False)
            if fs.exists(final):
                return False
            raise
        return True

    def commit(self, add: list[str], keep: bool = True, now: float | None = None) -> Version:
        """Make a new version of the sets of the newest one (with ``keep``) and of those added.

        Where two writers meet, the later one goes on from the other's version.
        """
        while True:
            numbers = self.numbers()
            before = self.version(numbers[-1]).sets if numbers and keep else ()
            version = Version((numbers[-1] if numbers else 0) + 1, (*before, *add), time.time() if now is None else now)
            if self._claim(version):
                return version

    def append(self, rows: DataFrame, now: float | None = None) -> Version:
        return self.commit([self.write_set(rows)], True, now)

    def replace(self, rows: DataFrame, now: float | None = None) -> Version:
        return self.commit([self.write_set(rows)], False, now)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default."""
        numbers = self.numbers()
        if not numbers or (number is not None and number not in numbers):
            raise ValueError(f"no such version: {number}")
        sets = self.version(numbers[-1] if number is None else number).sets
        return self.spark.read.parquet(*[f"{self.path}/files/{s}" for s in sets])

    def prune(self, versions: int = 10, days: float | None = None, now: float | None = None, grace_days: float = 1.0) -> list[str]:
        """Remove old versions, and every set of files that no kept version names; the names of the sets removed.

        Kept are the newest ``versions``, and with ``days`` those younger than that; the newest
        always.  Manifests go first, so no reader finds a version without its
        files.  Sets younger than ``grace_days`` stay, as their writer may be about to commit.
        """
        now = time.time() if now is None else now
        known = [self.version(n) for n in self.numbers()]
        if not known:
            return []
        kept = [v for i, v in enumerate(reversed(known)) if i == 0 or (i < versions and (days is None or now - v.made_at <= days * 86400))]
        for v in known:
            if v not in kept:
                self._fs.delete(self._file("versions", f"{v.number:012d}.json"), False)
        named = {s for v in kept for s in v.sets}
        removed = []
        for status in self._fs.listStatus(self._file("files")):
            name = status.getPath().getName()
            if name not in named and now - status.getModificationTime() / 1000 >= grace_days * 86400:
                self._fs.delete(status.getPath(), True)
                removed.append(name)
        return sorted(removed)
