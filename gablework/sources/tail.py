"""Growing log files as a stream of their lines.

Spark's own file source takes each file once, when it is new.  Here the offset of a
stream is a byte place per file, so lines appended later come too, once each.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from gablework.sources.logs import LOG_DDL, parse_time

#: Bytes of a file's beginning that tell it from another file of its name; bytes read by one task, and at once.
HEAD, RANGE, BLOCK = 256, 64 << 20, 1 << 20


def _source(head: int = HEAD, longest: int = RANGE, block: int = BLOCK) -> Any:
    """The data source, made here so that it is shipped to the workers by value."""
    import fnmatch
    import json
    import zlib
    from collections.abc import Iterator
    from dataclasses import dataclass

    import pyarrow as pa
    from pyarrow import fs as files
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    @dataclass
    class Range(InputPartition):
        """The lines of a file that begin at ``begin`` or later and before ``end``."""

        file: str
        begin: int
        end: int
        aligned: bool

    class Reader(DataSourceStreamReader):
        def __init__(self, options: dict[str, str]):
            self.path, self.pattern = options["path"], options.get("pattern", "*.log")
            self.strict = options.get("failondataloss", options.get("failOnDataLoss", "true")) == "true"

        def _open(self):
            return files.FileSystem.from_uri(self.path)

        def _mark(self, system, file: str, size: int) -> int:
            """Place after the last whole line."""
            with system.open_input_file(file) as f:
                upto = size
                while upto > 0:
                    start = max(0, upto - block)
                    found = f.read_at(upto - start, start).rfind(b"\n")
                    if found >= 0:
                        return start + found + 1
                    upto = start
            return 0

        def _digest(self, system, file: str, n: int) -> int:
            with system.open_input_file(file) as f:
                return zlib.crc32(f.read_at(n, 0))

        def initialOffset(self) -> dict:
            return {"files": "{}"}

        def latestOffset(self) -> dict:
            system, root = self._open()
            found = {}
            for info in system.get_file_info(files.FileSelector(root, allow_not_found=True)):
                if info.type == files.FileType.File and fnmatch.fnmatch(info.base_name, self.pattern):
                    place = self._mark(system, info.path, info.size)
                    known = min(head, place)
                    if place:
                        found[info.path] = [place, known, self._digest(system, info.path, known)]
            return {"files": json.dumps(found, sort_keys=True)}

        def partitions(self, start: dict, end: dict) -> list[Range]:
            system, _ = self._open()
            before, after = json.loads(start["files"]), json.loads(end["files"])
            out = []
            for file, (place, known, digest) in after.items():
                if before.get(file) == [place, known, digest]:
                    continue
                if system.get_file_info(file).type != files.FileType.File:
                    if self.strict:
                        raise FileNotFoundError(f"{file} was removed before it was read")
                    continue
                begin = self._continued(system, file, place, before, after)
                for at in range(begin, place, longest):
                    out.append(Range(file, at, min(at + longest, place), at == begin))
            return out

        def _continued(self, system, file: str, place: int, before: dict, after: dict) -> int:
            """Where the part not yet read begins: of the same file, also under a new name, else at 0."""
            own = before.get(file)
            # A file that another name's offset belongs to has been moved away from that name.
            gone = [o for name, o in before.items() if name != file and (name not in after or after[name][1:] != o[1:]) and o[1] == head]
            for seen, known, digest in ([own] if own else []) + gone:
                if seen <= place and self._digest(system, file, known) == digest:
                    return seen
            return 0

        def read(self, part: Range) -> Iterator[pa.RecordBatch]:
            system, _ = self._open()
            with system.open_input_file(part.file) as f:
                f.seek(part.begin if part.aligned else part.begin - 1)
                at, rest, skip = f.tell(), b"", not part.aligned
                while at < part.end:
                    new = f.read(block)
                    if not new:
                        return
                    data = rest + new
                    whole, newline, rest = data.rpartition(b"\n")
                    if not newline:
                        continue
                    lines, places = [], []
                    for line in whole.split(b"\n"):
                        if at < part.end and not skip:
                            lines.append(line.decode("utf-8", "replace"))
                            places.append(at)
                        skip = False
                        at += len(line) + 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lines, pa.string()), pa.array([part.file] * len(lines), pa.string()), pa.array(places, pa.int64())],
                        names=["line", "file", "place"],
                    )

    class GrowingLines(DataSource):
        @classmethod
        def name(cls) -> str:
            return "growing_lines"

        def schema(self) -> str:
            return "line string, file string, place long"

        def streamReader(self, schema) -> Reader:
            return Reader(dict(self.options))

    return GrowingLines


def tail_lines(spark: SparkSession, path: str, pattern: str = "*.log", strict: bool = True, **sizes: int) -> DataFrame:
    """Stream of (line, file, place): every whole line of the folder's files once, also after a restart.

    A last line without its end waits until it is whole.  A file whose beginning
    changed is a new one and is read from 0; one that was moved to another name
    that the pattern takes goes on where it was (files of 256 bytes or more).  With ``strict`` a
    file removed before it was read stops the stream, else its lines are
    lost.  Long files are read in ranges of 64 MB, a task each, in blocks, so memory is
    bounded by a block and the longest line.  The folder must be on a file
    system that pyarrow reaches from every machine.
    """
    spark.dataSource.register(_source(**sizes))
    options = {"path": path, "pattern": pattern, "failOnDataLoss": str(strict).lower()}
    return spark.readStream.format("growing_lines").options(**options).load()


def tail_json_lines(spark: SparkSession, path: str, ddl: str = LOG_DDL, pattern: str = "*.log", **settings) -> DataFrame:
    """The JSON log lines of growing files; blank lines are passed over, a broken line has nulls."""
    lines = tail_lines(spark, path, pattern, **settings).where(F.trim("line") != "")
    return parse_time(lines.select(F.from_json("line", ddl).alias("r")).select("r.*"))
