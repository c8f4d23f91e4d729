"""Archive objects as a data source: listed, read and written by the executors (A1, A2, A5).

``spark.read.format("archive_objects")`` gives the path and size of every object below
``root``, of one ``period`` if that option is given.  The driver lists nothing and expands no pattern: a
partition takes the players whose name falls into its bucket and asks for their objects.  A
filter on ``path`` by equality or ``IN`` is taken by the source, which then asks for those objects alone.
``write`` puts one object at each ``path`` with the text of ``body``: a file of its own, or with the option ``bundled``
an object in a bundle (see :mod:`rookery.sources.bundles`).  Listing and reading know both by what is below ``root``.

Files are reached through ``pyarrow.fs``: local paths, and URIs of the file systems it knows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from posixpath import dirname
from zlib import crc32

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition
from pyspark.sql.datasource import WriterCommitMessage
from pyspark.sql import functions as F

from rookery.sources import bundles

FORMAT = "archive_objects"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Partitions that the players are dealt to, and paths asked for at once.
BUCKETS = 64
ASKED = 1000
#: Bytes of a split of objects, what opening one object counts for, and bytes read into one batch.
SPLIT_BYTES = 128 << 20
OPEN_COST = 1 << 20
BATCH_BYTES = 8 << 20


def file_system(root: str) -> tuple[fs.FileSystem, str]:
    """File system of a path or URI, and the path in it."""
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


@dataclass(frozen=True)
class Bucket(InputPartition):
    """Players whose name falls into one bucket, or the named paths that do; in bundles, the paths, of these writes."""

    number: int
    paths: tuple[str, ...] | None = None
    writes: tuple[str, ...] | None = None


class ObjectReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.period = options["root"].rstrip("/"), options.get("period")
        self.buckets = int(options.get("buckets", BUCKETS))
        self.named: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            if isinstance(one, EqualTo) and one.attribute == ("path",):
                values = {one.value}
            elif isinstance(one, In) and one.attribute == ("path",):
                values = set(one.value)
            else:
                yield one
                continue
            self.named = values if self.named is None else self.named & values

    def partitions(self) -> Sequence[InputPartition]:
        system, base = file_system(self.root)
        if bundles.has_bundles(system, base):
            writes = tuple(bundles.list_writes(system, base))
            if self.named is None:
                return [Bucket(n, None, writes) for n in range(min(self.buckets, bundles.SECTIONS))]
            dealt: dict[int, list[str]] = {}
            for path in sorted(p for p in self.named if p):
                dealt.setdefault(bundles.section_of(path) % self.buckets, []).append(path)
            return [Bucket(n, tuple(paths), writes) for n, paths in sorted(dealt.items())] or [Bucket(0, (), writes)]
        if self.named is None:
            return [Bucket(n) for n in range(self.buckets)]
        paths = sorted(p for p in self.named if p)
        return [Bucket(n, tuple(paths[n :: self.buckets])) for n in range(min(self.buckets, max(len(paths), 1)))]

    def read(self, partition: Bucket) -> Iterator[tuple[str, int] | tuple[str, int, str]]:
        system, base = file_system(self.root)
        if partition.writes is not None:
            yield from self._bundled(system, base, partition)
            return
        if partition.paths is not None:
            yield from self._asked(system, base, partition.paths)
            return
        players = fs.FileSelector(f"{base}/player", allow_not_found=True)
        names = [
            i.base_name
            for i in system.get_file_info(players)
            if i.type == fs.FileType.Directory and crc32(i.base_name.encode()) % self.buckets == partition.number
        ]
        if self.period:
            yield from self._asked(system, base, [f"player/{name}/games/{self.period}" for name in names])
            return
        for name in names:
            inside = fs.FileSelector(f"{base}/player/{name}/games", allow_not_found=True, recursive=True)
            for info in system.get_file_info(inside):
                if info.type == fs.FileType.File:
                    yield f"player/{name}/games/" + info.path.split(f"/player/{name}/games/", 1)[1], info.size

    def _asked(self, system: fs.FileSystem, base: str, paths: Sequence[str]) -> Iterator[tuple[str, int]]:
        for start in range(0, len(paths), ASKED):
            asked = paths[start : start + ASKED]
            for path, info in zip(asked, system.get_file_info([f"{base}/{p}" for p in asked])):
                if info.type == fs.FileType.File and (not self.period or path.endswith(f"/{self.period}")):
                    yield path, info.size

    def _bundled(self, system: fs.FileSystem, base: str, partition: Bucket) -> Iterator[tuple[str, int, str]]:
        """The same objects as of files, by the contents of the bundles."""
        named = None if partition.paths is None else set(partition.paths)
        sections = range(partition.number, bundles.SECTIONS, self.buckets)
        if named is not None:
            sections = sorted(set(map(bundles.section_of, named)))
        for path, size, place in bundles.find(system, base, partition.writes, sections):
            if named is not None:
                if path in named and (not self.period or path.endswith(f"/{self.period}")):
                    yield path, size, place
                continue
            top, _, rest = path.partition("/")
            below = rest.partition("/")[2]
            if top == "player" and (below == f"games/{self.period}" if self.period else below.startswith("games/")):
                yield path, size, place


class ObjectWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.root = options["root"].rstrip("/")

    def write(self, rows: Iterator) -> WriterCommitMessage:
        """Objects appear whole: each is written aside and moved to its path; a repeated task writes the same again."""
        system, base = file_system(self.root)
        aside = f"{base}/_writing/{uuid.uuid4().hex}"
        system.create_dir(aside, recursive=True)
        made: set[str] = set()
        for number, row in enumerate(rows):
            with system.open_output_stream(f"{aside}/{number}") as out:
                out.write(row["body"].encode())
            folder = dirname(f"{base}/{row['path']}")
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            system.move(f"{aside}/{number}", f"{base}/{row['path']}")
        system.delete_dir(aside)
        return WriterCommitMessage()


class ArchiveObjects(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        bundled = bundles.has_bundles(*file_system(self.options["root"].rstrip("/")))
        return "path string, size long" + ", place string" * bundled

    def reader(self, schema) -> DataSourceReader:
        return ObjectReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        system, base = file_system(self.options["root"].rstrip("/"))
        bundled, there = self.options.get("bundled", "false") == "true", bundles.has_bundles(system, base)
        if not bundled and there:
            raise ValueError(f"{self.options['root']} holds bundles: write with bundled=True")
        if bundled and not there and system.get_file_info(f"{base}/player").type != fs.FileType.NotFound:
            raise ValueError(f"{self.options['root']} holds files of one object: write without bundled")
        return bundles.BundleWriter(system, base) if bundled else ObjectWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArchiveObjects)
    spark.conf.set(PUSHDOWN, "true")


def list_objects(spark: SparkSession, root: str, period: str | None = None) -> DataFrame:
    """Path, relative to ``root``, and size of every object, of one period if given; no content is read (A2).

    Objects in bundles also have a ``place``, by which they are read.
    """
    register(spark)
    reader = spark.read.format(FORMAT).option("root", root)
    return (reader.option("period", period) if period else reader).load()


def write_objects(documents: DataFrame, root: str, bundled: bool = False) -> None:
    """One object for each row ``endpoint, body``, at the endpoint's path (A5).

    ``bundled`` puts them into bundles, which take the objects' bytes and not a block and an inode for each file and
    folder; other programs then find no file at the path.  All writes to one root must agree in this.
    """
    register(documents.sparkSession)
    rows = documents.select(F.col("endpoint").alias("path"), "body")
    rows.write.format(FORMAT).mode("append").option("root", root).option("bundled", bundled).save()


def read_listed(listed: DataFrame, root: str) -> DataFrame:
    """Documents ``endpoint, body`` of listed objects (A1).

    Objects are packed into splits by size where they are listed; the paths are dealt out by split, and
    bodies are read where they are parsed: no body crosses an exchange.  Objects of a bundle make a split, and are
    read in the order of their places.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held = uuid.uuid4().hex, 0
        for batch in batches:
            splits = []
            for size in batch.column(1).to_pylist():
                if held and held + size + OPEN_COST > SPLIT_BYTES:
                    split, held = uuid.uuid4().hex, 0
                held += size + OPEN_COST
                splits.append(split)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(splits, pa.string())], ["path", "size", "split"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(root.rstrip("/"))
        bundle = bundles.BundleReader(system, base)
        paths, bodies, held = [], [], 0

        def body_of(path: str, *place: str | int) -> bytes:
            if place:
                return bundle.body(*place)
            with system.open_input_file(f"{base}/{path}") as file:
                return file.read()

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(paths, pa.string()), pa.array(bodies, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["endpoint", "body"])

        for batch in batches:
            for path, *place in zip(*(c.to_pylist() for c in batch.columns)):
                bodies.append(body_of(path, *place).decode("utf-8", "replace"))
                paths.append(path)
                held += len(bodies[-1])
                if held >= BATCH_BYTES:
                    yield batch_of()
                    paths, bodies, held = [], [], 0
        if paths:
            yield batch_of()

    if "place" in listed.columns:
        dealt = listed.select("path", "place", "size").repartition(F.split_part("place", F.lit(":"), F.lit(1)))
        return dealt.sortWithinPartitions("place").mapInArrow(read, "endpoint string, body string")
    packed = listed.select("path", "size").mapInArrow(pack, "path string, size long, split string")
    return packed.repartition("split").select("path").mapInArrow(read, "endpoint string, body string")
