"""A warehouse table in shared files, as a Spark data source.

``spark.read.format("tierwise_warehouse").load(path)`` and ``df.write.format(...)`` work on a
folder of Parquet files and numbered manifests:

* reads are planned from the newest manifest: files whose stored column ranges exclude the
  filters of ``where`` are skipped, the rest is read in partitions of about ``split_bytes`` by row
  groups, and the filters are applied there. They are an option of the load, not Spark's own
  filter push-down: that keeps a query's filters in the DataFrame's relation (4.1), where a
  later query over the same DataFrame that pushes none would find them;
* writes commit in two phases. Tasks write files under fresh names, which no reader
  looks at, and report them; the driver then adds one manifest that names them. A
  manifest is created only if its number is free, so of two writers one starts over on
  the other's. A writer that dies before that leaves files no manifest names, and no rows;
  a task that is run twice leaves one file that is named and one that is not.

Appends add to the files of the newest manifest, overwrites replace them. Paths are local,
or of any file system Arrow can open. Creation of a manifest is atomic on local and network
file systems (a hard link); elsewhere an existing manifest is refused but two writers at the
same moment are not told apart.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T

FORMAT = "tierwise_warehouse"
SPLIT_BYTES = 128 << 20


COMPARISONS = ("==", ">", ">=", "<", "<=", "in", "null", "not null")


def register(spark: SparkSession) -> None:
    """Make the format known to ``spark``."""
    spark.dataSource.register(WarehouseSource)


def where(*tests: tuple) -> str:
    """The value of the option ``where``: rows that pass every (column, comparison, value)."""
    for column, comparison, *_ in tests:
        if comparison not in COMPARISONS:
            raise ValueError(f"{column}: comparison must be one of {COMPARISONS}")
    return json.dumps([[column, comparison, value[0] if value else None] for column, comparison, *value in tests])


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return arrow_fs.FileSystem.from_uri(path)
    return arrow_fs.LocalFileSystem(), path


def _versions(fs: arrow_fs.FileSystem, root: str) -> list[int]:
    found = fs.get_file_info(arrow_fs.FileSelector(f"{root}/_manifests", allow_not_found=True))
    return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and f.base_name[:-5].isdigit())


def _manifest(fs: arrow_fs.FileSystem, root: str, version: int) -> dict:
    with fs.open_input_stream(f"{root}/_manifests/{version:010d}.json") as stream:
        return json.loads(stream.read())


def _create(fs: arrow_fs.FileSystem, path: str, content: bytes) -> bool:
    """Write ``path`` if there is none; false if there is one."""
    staged = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(staged) as stream:
        stream.write(content)
    if isinstance(fs, arrow_fs.LocalFileSystem):
        try:
            os.link(staged, path)
            return True
        except FileExistsError:
            return False
        finally:
            fs.delete_file(staged)
    if fs.get_file_info(path).type != arrow_fs.FileType.NotFound:
        fs.delete_file(staged)
        return False
    fs.move(staged, path)
    return True


class WarehouseSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        fs, root = _open(self.options["path"])
        versions = _versions(fs, root)
        if not versions:
            raise ValueError(f"no warehouse table at {root}")
        return T.StructType.fromJson(_manifest(fs, root, versions[-1])["schema"])

    def reader(self, schema: T.StructType) -> "Reader":
        tests = [tuple(t) for t in json.loads(self.options.get("where", "[]"))]
        return Reader(self.options["path"], schema, int(self.options.get("split_bytes", SPLIT_BYTES)), tests)

    def writer(self, schema: T.StructType, overwrite: bool) -> "Writer":
        return Writer(self.options["path"], schema, overwrite)


@dataclass
class Split(ds.InputPartition):
    file: str
    groups: list[int]


def _expression(test) -> pc.Expression:
    column, kind, value = test
    c = pc.field(column)
    if kind == "in":
        return c.isin(list(value))
    if kind in ("null", "not null"):
        return c.is_null() if kind == "null" else c.is_valid()
    return {"==": c == value, ">": c > value, ">=": c >= value, "<": c < value, "<=": c <= value}[kind]


def _may_hold(stats: dict, test) -> bool:
    """Whether a file of these column ranges can hold a row that passes."""
    column, kind, value = test
    if column not in stats or kind in ("null", "not null"):
        return True
    low, high = stats[column]
    values = list(value) if kind == "in" else [value]
    try:
        return any(
            {"==": low <= v <= high, "in": low <= v <= high, ">": high > v, ">=": high >= v, "<": low < v, "<=": low <= v}[kind] for v in values if v is not None
        )
    except TypeError:  # a range of another type says nothing
        return True


class Reader(ds.DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, split_bytes: int, tests: list[tuple]):
        unknown = [t[0] for t in tests if t[0] not in schema.fieldNames()]
        if unknown:
            raise ValueError(f"filters name columns outside the table: {unknown}")
        self.path, self.columns, self.split_bytes, self.tests = path, schema.fieldNames(), split_bytes, tests

    def partitions(self):
        fs, root = _open(self.path)
        files = _manifest(fs, root, _versions(fs, root)[-1])["files"]
        splits = []
        for f in files:
            if not all(_may_hold(f["stats"], t) for t in self.tests):
                continue
            group, size = [], 0
            for i, part in enumerate(f["groups"]):
                group.append(i)
                size += part
                if size >= self.split_bytes:
                    splits.append(Split(f["file"], group))
                    group, size = [], 0
            if group:
                splits.append(Split(f["file"], group))
        return splits

    def read(self, partition: Split):
        fs, root = _open(self.path)
        wanted = None
        for test in self.tests:
            wanted = _expression(test) if wanted is None else wanted & _expression(test)
        with fs.open_input_file(f"{root}/data/{partition.file}") as handle:
            for batch in pq.ParquetFile(handle).iter_batches(row_groups=partition.groups, columns=self.columns):
                table = pa.Table.from_batches([batch]).select(self.columns)
                yield from (table if wanted is None else table.filter(wanted)).to_batches()


@dataclass
class Written(ds.WriterCommitMessage):
    files: list[dict] = field(default_factory=list)


def _ranges(metadata: pq.FileMetaData) -> dict:
    """Least and greatest value per column, where every row group has them as plain values."""
    out = {}
    for c in range(metadata.num_columns):
        found = [metadata.row_group(g).column(c) for g in range(metadata.num_row_groups)]
        name = found[0].path_in_schema if found else ""
        stats = [f.statistics for f in found]
        if "." in name or not all(s is not None and s.has_min_max for s in stats):
            continue
        low, high = min(s.min for s in stats), max(s.max for s in stats)
        if isinstance(low, (int, float, str)) and low == low and high == high:
            out[name] = [low, high]
    return out


class Writer(ds.DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite

    def write(self, iterator):
        fs, root = _open(self.path)
        fs.create_dir(f"{root}/data", recursive=True)
        name, writer = f"{uuid.uuid4().hex}.parquet", None
        stream = None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                stream = fs.open_output_stream(f"{root}/data/{name}")
                writer = pq.ParquetWriter(stream, batch.schema)
            writer.write_batch(batch)
        if writer is None:
            return Written()
        writer.close()
        stream.close()
        with fs.open_input_file(f"{root}/data/{name}") as handle:
            metadata = pq.ParquetFile(handle).metadata
        groups = [metadata.row_group(g).total_byte_size for g in range(metadata.num_row_groups)]
        return Written([{"file": name, "rows": metadata.num_rows, "groups": groups, "stats": _ranges(metadata)}])

    def commit(self, messages):
        fs, root = _open(self.path)
        fs.create_dir(f"{root}/_manifests", recursive=True)
        mine = [f for m in messages if m is not None for f in m.files]
        seen = None
        while True:
            versions = _versions(fs, root)
            if self.overwrite and seen is not None and versions != seen:
                raise RuntimeError("the table was written while it was overwritten")
            seen = versions
            before = [] if self.overwrite or not versions else _manifest(fs, root, versions[-1])["files"]
            content = json.dumps({"schema": json.loads(self.schema.json()), "files": before + mine}).encode()
            if _create(fs, f"{root}/_manifests/{(versions[-1] if versions else 0) + 1:010d}.json", content):
                return

    def abort(self, messages):
        fs, root = _open(self.path)
        for f in [f for m in messages if m is not None for f in m.files]:
            fs.delete_file(f"{root}/data/{f['file']}")
