"""Image rows as image files, one file per row: the writing side of Spark's image source.

``write_images`` stores rows of the image schema as PNG files through a data source
of its own, so Spark plans, schedules and repeats the work. Each task writes to a
folder that the reader ignores and renames it at its end: a task that is lost leaves
nothing visible, and one that runs twice leaves one result. ``read_images`` reads
the folder, or ``image_folders`` tells which folders below it make portions of bounded size.

Sizes and bytes that do not fit each other fail the job. A row without an image
(NULL data or a size below one) becomes a file that is none, which is read as a row
without sizes (Spark skips empty files, so a word stands in it). Rows of one name are kept apart by the task's folder and, within a
task, by a number.
"""

from __future__ import annotations

import posixpath
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

SOURCE = "png_files"
FIELDS = ["origin", "height", "width", "nChannels", "data"]
NO_IMAGE = b"none"
# The most files in one folder, and the file that lists all folders with their number of files.
FOLDER_FILES = 1_000
FOLDERS = "_FOLDERS"
# The PNG color type of each number of channels, and the order in which
# the channels of an image row (blue, green, red, alpha) are stored.
COLOR_TYPE = {1: 0, 3: 2, 4: 6}
STORED_ORDER = {1: [0], 3: [2, 1, 0], 4: [2, 1, 0, 3]}


def png_bytes(height: int, width: int, channels: int, data: bytes) -> bytes:
    """A PNG file of one image."""
    if channels not in COLOR_TYPE or len(data) != height * width * channels:
        raise ValueError(f"{len(data)} bytes are no image of {height} x {width} with {channels} channels")
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)[:, :, STORED_ORDER[channels]]
    lines = np.zeros((height, 1 + width * channels), np.uint8)  # each line begins with its filter, none
    lines[:, 1:] = pixels.reshape(height, width * channels)

    def chunk(kind: bytes, content: bytes) -> bytes:
        return struct.pack(">I", len(content)) + kind + content + struct.pack(">I", zlib.crc32(kind + content))

    head = struct.pack(">IIBBBBB", width, height, 8, COLOR_TYPE[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + chunk(b"IEND", b"")


def _file_of(row: dict) -> bytes:
    sizes = (row["height"], row["width"], row["nChannels"])
    if row["data"] is None or any(s is None or s < 1 for s in sizes):
        return NO_IMAGE
    return png_bytes(*sizes, row["data"])


def _name_of(origin: str | None, taken: set[str]) -> str:
    """File name of a row, different from those taken."""
    stem = posixpath.splitext(posixpath.basename(unquote(origin or "")))[0] or "image"
    name, number = f"{stem}.png", 1
    while name in taken:
        number += 1
        name = f"{stem} ({number}).png"
    taken.add(name)
    return name


@dataclass
class Stored(WriterCommitMessage):
    files: int
    part: str
    folder_files: int

    def folders(self) -> list[tuple[str, int]]:
        """The task's folders and how many files each has."""
        starts = range(0, self.files, self.folder_files)
        return [(f"{self.part}/{k:06d}", min(self.folder_files, self.files - at)) for k, at in enumerate(starts)]


class PngWriter(DataSourceArrowWriter):
    def __init__(self, path: str, folder_files: int):
        self.path = path
        self.folder_files = folder_files

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Stored:
        store, root = fs.FileSystem.from_uri(self.path)
        task = TaskContext.get()
        attempt = f"{root}/_attempt-{task.taskAttemptId()}"
        taken: set[str] = set()
        for batch in iterator:
            for place in range(len(batch)):
                row = batch.slice(place, 1).to_pylist()[0]
                folder = f"{attempt}/{len(taken) // self.folder_files:06d}"
                if len(taken) % self.folder_files == 0:
                    store.create_dir(folder)
                with store.open_output_stream(f"{folder}/{_name_of(row['origin'], taken)}") as out:
                    out.write(_file_of(row))
        part = f"part-{task.partitionId():06d}"
        if taken:
            final = f"{root}/{part}"
            if store.get_file_info(final).type != fs.FileType.NotFound:
                store.delete_dir(attempt)  # another attempt of this task has come first
            else:
                store.move(attempt, final)
        return Stored(len(taken), part, self.folder_files)

    def commit(self, messages: list[Stored | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root)
        with store.open_output_stream(f"{root}/{FOLDERS}") as out:
            out.write("".join(f"{folder} {n}\n" for m in messages if m for folder, n in m.folders()).encode())
        with store.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(str(sum(m.files for m in messages if m)).encode())


class PngFiles(DataSource):
    """Data source ``png_files``: writes rows of the image schema."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "origin string, height int, width int, nChannels int, data binary"

    def writer(self, schema: StructType, overwrite: bool) -> PngWriter:
        return PngWriter(self.options["path"], int(self.options["folder_files"]))


def _uri(path: str) -> str:
    """A path without a scheme is one of the session's own machine."""
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri


def write_images(images: DataFrame, path: str, folder_files: int = FOLDER_FILES) -> str:
    """Store image rows below a new folder. Gives the path."""
    images.sparkSession.dataSource.register(PngFiles)
    writer = images.select(*FIELDS).write.format(SOURCE).option("folder_files", folder_files)
    writer.mode("append").save(_uri(path))
    return path


def image_folders(path: str, files: int) -> list[list[str]]:
    """The folders that ``write_images`` has filled, in portions of so many files at most (or one folder)."""
    store, root = fs.FileSystem.from_uri(_uri(path))
    with store.open_input_stream(f"{root}/{FOLDERS}") as listed:
        lines = [line.rsplit(" ", 1) for line in listed.read().decode().splitlines()]
    portions: list[list[str]] = []
    room = 0
    for folder, n in lines:
        if not portions or int(n) > room:
            portions.append([])
            room = files
        portions[-1].append(f"{path}/{folder}")
        room -= int(n)
    return portions
