"""Bundles: many small objects in one file, for an archive that is written in bulk (A1, A2, A5).

A file system gives every file and every folder a block and an inode of its own, so a player's three months of half
a kilobyte take six blocks, and an archive of small objects many times its bytes.  A bundle holds the bodies of up to
:data:`BUNDLE_OBJECTS` objects in compressed blocks, sorted by period; behind them, in sections by the hash of the
path, which object is where; and at the end where blocks and sections are.  Every object keeps its path and its size,
is listed and read alone, and is replaced by a later write of the same path.

Bundles and the lists of them, one for each write, are in ``_bundles`` below the archive's root.  What no list names
does not exist, so a write is there as a whole or not at all.  A root holds either bundles or files of one object.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from struct import Struct
from zlib import crc32

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

FOLDER = "_bundles"
#: Parts of a bundle's table of contents, by the hash of the path: what one task knows at once of all bundles.  The
#: number is part of the format, as is what tells where a part is: offset, bytes there and bytes of the text.
SECTIONS = 256
SPAN = Struct(">QQQ")
#: Bytes of bodies and objects of a bundle, and bytes compressed together.
BUNDLE_BYTES = 64 << 20
BUNDLE_OBJECTS = 100_000
BLOCK_BYTES = 256 << 10


def section_of(path: str) -> int:
    return crc32(path.encode()) % SECTIONS


def has_bundles(system: fs.FileSystem, base: str) -> bool:
    return system.get_file_info(f"{base}/{FOLDER}").type == fs.FileType.Directory


def write_bundle(out: pa.NativeFile, objects: list[tuple[str, bytes]]) -> None:
    codec, at = pa.Codec("zstd"), 0

    def put(data: bytes) -> tuple[int, int, int]:
        nonlocal at
        packed = codec.compress(data, asbytes=True)
        out.write(packed)
        at += len(packed)
        return at - len(packed), len(packed), len(data)

    contents: list[list[tuple[str, int, str]]] = [[] for _ in range(SECTIONS)]
    block: list[tuple[str, bytes]] = []
    held = 0

    def close() -> None:
        place, start = ":".join(map(str, put(b"".join(body for _, body in block)))), 0
        for path, body in block:
            contents[section_of(path)].append((path, len(body), f"{place}:{start}"))
            start += len(body)
        block.clear()

    for one in sorted(objects, key=lambda o: (o[0].rsplit("/", 2)[1:], o[0])):
        if block and held + len(one[1]) > BLOCK_BYTES:
            close()
            held = 0
        block.append(one)
        held += len(one[1])
    close()
    out.write(b"".join(SPAN.pack(*put(json.dumps(section).encode())) for section in contents))


def _read(file: pa.NativeFile, offset: int, length: int, size: int) -> bytes:
    return pa.Codec("zstd").decompress(file.read_at(length, offset), size, asbytes=True) if size else b""


def read_section(system: fs.FileSystem, path: str, section: int) -> Iterator[tuple[str, int, str]]:
    """Path, size and place of a bundle's objects in one section."""
    with system.open_input_file(path) as file:
        span = SPAN.unpack(file.read_at(SPAN.size, file.size() - SPAN.size * (SECTIONS - section)))
        name = path.rpartition("/")[2]
        for one, size, place in json.loads(_read(file, *span)):
            yield one, size, f"{name}:{place}"


class BundleReader:
    """Bodies by their place; the last block stays, as places come in order."""

    def __init__(self, system: fs.FileSystem, base: str):
        self.system, self.base = system, base
        self.at: list[str] = []
        self.block = b""

    def body(self, place: str, size: int) -> bytes:
        *at, start = place.split(":")
        if at != self.at:
            name, *span = at
            with self.system.open_input_file(f"{self.base}/{FOLDER}/{name}") as file:
                self.at, self.block = at, _read(file, *map(int, span))
        return self.block[int(start) : int(start) + size]


def list_writes(system: fs.FileSystem, base: str) -> list[str]:
    """Names of the lists of bundles, in the order of their writes."""
    names = (i.base_name for i in system.get_file_info(fs.FileSelector(f"{base}/{FOLDER}")))
    return sorted(n for n in names if n.endswith(".json"))


def find(
    system: fs.FileSystem, base: str, writes: Sequence[str], sections: Iterable[int]
) -> Iterator[tuple[str, int, str]]:
    """Path, size and place of the objects in some sections; of a path written again the last."""
    names: list[str] = []
    for write in writes:
        with system.open_input_file(f"{base}/{FOLDER}/{write}") as file:
            names += json.loads(file.read())
    for section in sections:
        found = {}
        for name in names:
            for path, size, place in read_section(system, f"{base}/{FOLDER}/{name}", section):
                found[path] = size, place
        for path, (size, place) in found.items():
            yield path, size, place


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class BundleWriter(DataSourceArrowWriter):
    def __init__(self, system: fs.FileSystem, base: str):
        self.system, self.base = system, base

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        self.system.create_dir(f"{self.base}/{FOLDER}", recursive=True)
        names: list[str] = []
        objects: list[tuple[str, bytes]] = []
        held = 0

        def close() -> None:
            names.append(uuid.uuid4().hex)
            with self.system.open_output_stream(f"{self.base}/{FOLDER}/{names[-1]}") as out:
                write_bundle(out, objects)
            objects.clear()

        try:
            for batch in iterator:
                # As with files of one object, a row without path makes an object that no listing meets.
                for path, body in zip(map(str, batch.column("path").to_pylist()), batch.column("body").to_pylist()):
                    objects.append((path, body.encode()))
                    held += len(objects[-1][1])
                    if held >= BUNDLE_BYTES or len(objects) >= BUNDLE_OBJECTS:
                        close()
                        held = 0
            if objects:
                close()
        except BaseException:
            self._delete(names)
            raise
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        self.system.create_dir(f"{self.base}/{FOLDER}", recursive=True)
        earlier = list_writes(self.system, self.base)
        number = int(earlier[-1].partition("-")[0]) + 1 if earlier else 0
        name = f"{self.base}/{FOLDER}/{number:012d}-{uuid.uuid4().hex}"
        with self.system.open_output_stream(f"{name}.part") as out:
            out.write(json.dumps([n for m in messages if m for n in m.names]).encode())
        self.system.move(f"{name}.part", f"{name}.json")

    def abort(self, messages: list[Written | None]) -> None:
        self._delete([n for m in messages if m for n in m.names])

    def _delete(self, names: list[str]) -> None:
        for name in names:
            info = self.system.get_file_info(f"{self.base}/{FOLDER}/{name}")
            if info.type == fs.FileType.File:
                self.system.delete_file(info.path)
