"""Files in any number: folders are listed level by level in tasks, and a data source reads what was listed in byte ranges.

The driver sees counts only: listings are tables in shared storage, from the first folder to the ranges that tasks read. Files are
opened in tasks through pyarrow's file systems, so a root is a path or an address that these know.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith

from dockgrid.storage import new_path, settle

C = F.col
BLOCK = 1 << 18
LISTED = "path string, name string, folder boolean, length long, mtime timestamp, error string"
FAULTS = (OSError, EOFError, zlib.error)


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path within it. Addresses of local files are taken as they are, unescaped."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def _entries(folder: str) -> Iterator[tuple]:
    """path, name, folder, length, mtime, error of what a folder holds; local folders are streamed, others come at once."""
    system, inner = _opened(folder)
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(inner) as found:
            for e in found:
                path = f"{folder.rstrip('/')}/{e.name}"
                try:
                    if e.is_dir() and e.is_symlink():
                        continue
                    at = e.stat()
                    yield path, e.name, e.is_dir(), at.st_size, datetime.fromtimestamp(at.st_mtime, timezone.utc), None
                except OSError as why:
                    yield path, e.name, False, None, None, str(why)
        return
    for e in system.get_file_info(fs.FileSelector(inner)):
        yield f"{folder.rstrip('/')}/{e.base_name}", e.base_name, e.type == fs.FileType.Directory, e.size or 0, e.mtime, None


def _level(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What the folders of each frame hold, in frames of 10,000 entries at most; a folder that can't be listed is a row with error."""
    columns = ["path", "name", "folder", "length", "mtime", "error"]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        f = pd.DataFrame(rows, columns=columns)
        return f.assign(mtime=pd.to_datetime(f["mtime"], utc=True), length=f["length"].astype("Int64"))

    rows: list[tuple] = []
    for f in frames:
        for folder in f["path"]:
            try:
                for e in _entries(folder):
                    if not e[1].startswith(("_", ".")):
                        rows.append(e)
                    if len(rows) == 10_000:
                        yield frame(rows)
                        rows = []
            except OSError as why:
                rows.append((folder, folder.rstrip("/").rsplit("/", 1)[-1], False, None, None, str(why)))
    if rows:
        yield frame(rows)


def list_files(spark: SparkSession, root: str, suffix: str | None = None, prefix: str | None = None) -> DataFrame:
    """path, name, length, mtime, error of the files below root, listed in tasks: one round a level of folders, folders dealt over tasks.

    suffix (in any case) and prefix of names are looked at where folders are listed, other names are not written. What can't be looked
    at (folders without permission, links to nothing) has an error and no length. Names that begin with _ or . are left out, as Spark's
    readers do; links to folders are not followed, so no ring of links is walked. A root that can't be listed raises.
    """
    parts = max(2, spark.sparkContext.defaultParallelism)
    front = spark.createDataFrame([(root,)], "path string")
    levels: list[DataFrame] = []
    while True:
        found = front.mapInPandas(_level, LISTED)
        keep = F.lit(True)
        if suffix is not None:
            keep &= F.lower("name").endswith(suffix.lower())
        if prefix is not None:
            keep &= C("name").startswith(prefix)
        found = settle(found.filter(C("folder") | C("error").isNotNull() | keep), "listed")
        if not levels:
            broken = found.filter((C("path") == root) & C("error").isNotNull()).first()
            if broken is not None:
                raise FileNotFoundError(broken["error"])
        levels.append(found)
        front = found.filter("folder").select("path")
        if front.isEmpty():
            break
        front = front.repartition(parts, "path")
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.filter(~C("folder")).drop("folder")


def splits(listing: DataFrame, split_bytes: int = 128 << 20) -> DataFrame:
    """path, name, start, stop of byte ranges of split_bytes at most; packed files (.gz) are one range. Empty files and errors have none."""
    step = F.when(F.lower("name").endswith(".gz"), C("length")).otherwise(F.lit(split_bytes).cast("long"))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), C("length") - 1, step)).alias("start")
    return listing.filter("length > 0 AND error IS NULL").select("path", "name", "length", step.alias("step"), starts).select("path", "name", "start", F.least(C("start") + C("step"), "length").alias("stop"))


def _raw(path: str) -> io.BufferedReader:
    system, inner = _opened(path)
    return io.BufferedReader(system.open_input_file(inner), BLOCK)


def lines_between(f: io.BufferedReader, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """Place and bytes, line end included, of the lines that begin in [start, stop): each line of a file is in one of its ranges."""
    at = start
    if start:
        f.seek(start - 1)
        at = start - 1 + len(f.readline())
    while at < stop and (line := f.readline()):
        yield at, line
        at += len(line)


def _lines(path: str, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    with _raw(path) as f:
        if path.lower().endswith(".gz"):
            with gzip.open(f) as g:
                yield from lines_between(g, 0, 1 << 62)
        else:
            yield from lines_between(f, start, stop)


def _test(kind: type, value: object) -> Callable[[str], bool] | None:
    """What a pushed filter asks of a value."""
    tests: dict[type, Callable[[str], bool]] = {
        StringStartsWith: lambda v: v.startswith(value),
        StringEndsWith: lambda v: v.endswith(value),
        StringContains: lambda v: value in v,
        EqualTo: lambda v: v == value,
        In: lambda v: v in value,
    }
    return tests.get(kind)


class _Part(InputPartition):
    """One file of the table of ranges."""


class _ListedReader(DataSourceReader):
    SCHEMA = pa.schema([("path", pa.string()), ("name", pa.string()), ("at", pa.int64()), ("line", pa.string()), ("error", pa.string())])

    def __init__(self, ranges: str) -> None:
        self.ranges = ranges
        self.asked: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", ())
            if column in (("path",), ("name",)) and _test(type(f), getattr(f, "value", None)) is not None:
                self.asked.append((column[0], type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, inner = _opened(self.ranges)
        return [_Part(i.path) for i in system.get_file_info(fs.FileSelector(inner)) if i.base_name.startswith("part-")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self.ranges)
        tests = [(column, _test(kind, value)) for column, kind, value in self.asked]
        with pq.ParquetFile(system.open_input_file(partition.value)) as table:
            for batch in table.iter_batches(1024):
                for r in batch.to_pylist():
                    if all(test(r[column]) for column, test in tests):
                        yield from self._range(r)

    def _range(self, r: dict) -> Iterator[pa.RecordBatch]:
        places: list[int | None] = []
        lines: list[str | None] = []
        held, fault = 0, None

        def batch(errors: list[str | None]) -> pa.RecordBatch:
            n = len(places)
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(([r["path"]] * n, [r["name"]] * n, places, lines, errors), self.SCHEMA.types, strict=True)], schema=self.SCHEMA)

        try:
            for at, line in _lines(r["path"], r["start"], r["stop"]):
                places.append(at)
                lines.append(line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace"))
                held += len(line)
                if held >= BLOCK or len(places) == 10_000:
                    yield batch([None] * len(places))
                    places, lines, held = [], [], 0
        except FAULTS as why:
            fault = f"{type(why).__name__}: {why}"
        if places:
            yield batch([None] * len(places))
        if fault is not None:
            places, lines = [None], [None]
            yield batch([fault])


class ListedFiles(DataSource):
    """path, name, at, line, error of the files of a stored table of ranges (option ranges): a partition is a part of that table.

    Conditions on path and name (equal, one of, begins, ends, contains) are pushed: files that fail them are never opened.
    """

    @classmethod
    def name(cls) -> str:
        return "listed_files"

    def schema(self) -> str:
        return "path string, name string, at long, line string, error string"

    def reader(self, schema: object) -> DataSourceReader:
        return _ListedReader(self.options["ranges"])


def read_listed(listing: DataFrame, split_bytes: int = 128 << 20) -> DataFrame:
    """path, name, at, line, error: every line of the listed files, at the byte where it begins (in packed files: unpacked bytes).

    Files are read in ranges of split_bytes, dealt over tasks; a long file is many tasks' work. Places order a file's lines. Empty
    files have no rows. A file with a fault has the lines before it and one row with error (null place and line); bytes that aren't
    UTF-8 are replaced. Turns on pushdown into Python data sources for the session.
    """
    spark = listing.sparkSession
    spark.dataSource.register(ListedFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    ranges = splits(listing, split_bytes)
    size = ranges.agg(F.sum(C("stop") - C("start")).alias("b"), F.count("*").alias("n")).first()
    # A task reads about 10,000 ranges or 256 MB at most, whichever is reached first.
    parts = min(size["n"], max(spark.sparkContext.defaultParallelism, size["n"] // 10_000, (size["b"] or 0) // (256 << 20)))
    at = new_path(spark, "ranges")
    ranges.repartition(max(1, parts)).write.parquet(at)
    return spark.read.format("listed_files").option("ranges", at).load()


def write_folders(lines: DataFrame, root: str, by: str, name: str = "part-0.txt") -> None:
    """lines: by, value, in the order of each file's lines, the rows of one by in one partition and together. A folder <by>=<its value> with one file each.

    Files are written in tasks through pyarrow's file systems, under a hidden name until they are whole, so a repeated task leaves one
    file. Lines are passed on batch by batch. (Spark's own writer, partitioned by folder, took about five times as long a further file.)
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = _opened(root)
        key, out, hidden, done = None, None, "", 0

        def close() -> None:
            if out is not None:
                out.close()
                system.move(hidden, f"{hidden.rpartition('/')[0]}/{name}")

        for batch in batches:
            keys, values = batch.column(0), batch.column(1)
            ends = [*pc.indices_nonzero(pc.not_equal(keys[1:], keys[:-1])).to_pylist(), len(keys) - 1] if len(keys) else []
            start = 0
            for end in ends:
                if out is None or keys[end].as_py() != key:
                    close()
                    key, done = keys[end].as_py(), done + 1
                    folder = f"{inner.rstrip('/')}/{by}={key}"
                    system.create_dir(folder, recursive=True)
                    hidden = f"{folder}/_{uuid.uuid4().hex}"
                    out = system.open_output_stream(hidden)
                out.write("".join(f"{v}\n" for v in values[start : end + 1].to_pylist()).encode())
                start = end + 1
        close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([done], pa.int64())})

    lines.select(by, "value").mapInArrow(write, "files long").agg(F.sum("files")).collect()


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds the SHA-256 of each file's bytes, read block by block; a file that can't be read has an error."""

    def one(path: str) -> tuple[str | None, str | None]:
        try:
            with _raw(path) as f:
                return hashlib.file_digest(f, "sha256").hexdigest(), None
        except FAULTS as why:
            return None, f"{type(why).__name__}: {why}"

    for f in frames:
        got = [(None, e) if isinstance(e, str) else one(p) for p, e in zip(f["path"], f["error"], strict=True)]
        yield f.assign(sha256=[x for x, _ in got], error=[e for _, e in got])


def hashed_files(listing: DataFrame) -> DataFrame:
    """path, name, length, error, sha256 of listed files (path, name, length, error), dealt over tasks and read once; without a hash they have an error."""
    spark = listing.sparkSession
    dealt = listing.select("path", "name", "length", "error").repartition(4 * spark.sparkContext.defaultParallelism, "path")
    return dealt.mapInPandas(_hashed, "path string, name string, length long, error string, sha256 string")


def _probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds the fault met on reading: first and last byte, packed files to their end."""

    def fault(path: str, length: int) -> str | None:
        try:
            with _raw(path) as f:
                if path.lower().endswith(".gz"):
                    with gzip.open(f) as g:
                        while g.read(BLOCK):
                            pass
                    return None
                first = f.read(1)
                f.seek(length - 1)
                return None if first and f.read(1) else f"shorter than its {length} bytes"
        except FAULTS as why:
            return f"{type(why).__name__}: {why}"

    for f in frames:
        yield f.assign(error=[e if isinstance(e, str) else "empty" if n == 0 else fault(p, int(n)) for p, n, e in zip(f["path"], f["length"], f["error"], strict=True)])


def checked_files(listing: DataFrame) -> DataFrame:
    """path, length, error of listed files, each opened in a task: error is 'empty', the fault met, or null."""
    dealt = listing.select("path", "length", "error").repartition(max(2, listing.sparkSession.sparkContext.defaultParallelism), "path")
    return dealt.mapInPandas(_probe, "path string, length long, error string")
