"""Landing files on any file system that a path's scheme names, one by one or as a Spark sink with commit and abort."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

# Where a job keeps the lists of files it has placed, below its folder.
LISTS = "_landed"


def place(target: str, body: bytes) -> None:
    """Write one file. It appears whole or not at all, and again with the same contents if a task is run again.

    A plain path and ``file:`` are written beside the target and renamed; other
    systems show an object only when its stream is closed, except those that know renames, where it is done alike.
    """
    system, path = fs.FileSystem.from_uri(target)
    folder, name = posixpath.split(path)
    system.create_dir(folder, recursive=True)
    renames = system.type_name in ("local", "hdfs")
    part = f"{folder}/.{uuid.uuid4().hex}" if renames else path
    with system.open_output_stream(part) as out:
        out.write(body)
    if renames:
        system.move(part, path)


def _lists(folder: str, job: str) -> str:
    return f"{folder.rstrip('/')}/{LISTS}/{job}"


@dataclass
class Placed(WriterCommitMessage):
    """The list of what a task has placed, and how many files it names."""

    listing: str
    files: int


class LandingWriter(DataSourceWriter):
    """Tasks place files and list them; a job that succeeds says so in one file, a job that fails takes its new files away."""

    def __init__(self, options: dict):
        self.folder, self.job = options["path"], uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Placed:
        root = self.folder.rstrip("/")
        listing, names, lost = f"{_lists(root, self.job)}/{uuid.uuid4().hex}", [], None
        for row in iterator:
            if row["name"] is None or row["bytes"] is None:
                continue
            name = posixpath.normpath(row["name"])
            if name.startswith(("/", "..")):
                lost = ValueError(f"not below the landing folder: {row['name']}")
                break
            system, path = fs.FileSystem.from_uri(f"{root}/{name}")
            names.append((name, system.get_file_info(path).type == fs.FileType.NotFound))
            place(f"{root}/{name}", bytes(row["bytes"]))
        # Also what a failing task has placed is listed, so that it can be taken away.
        place(listing, "\n".join(json.dumps(n) for n in names).encode())
        if lost:
            raise lost
        return Placed(listing, len(names))

    def commit(self, messages: list[Placed]) -> None:
        place(f"{_lists(self.folder, self.job)}/_SUCCESS", json.dumps({"files": sum(m.files for m in messages if m)}).encode())

    def abort(self, messages: list[Placed]) -> None:
        system, path = fs.FileSystem.from_uri(_lists(self.folder, self.job))
        root = self.folder.rstrip("/")
        for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            with system.open_input_stream(info.path) as held:
                for line in held.read().decode().splitlines():
                    name, fresh = json.loads(line)
                    found = fs.FileSystem.from_uri(f"{root}/{name}")[1]
                    if fresh and system.get_file_info(found).type == fs.FileType.File:
                        system.delete_file(found)
        if system.get_file_info(path).type == fs.FileType.Directory:
            system.delete_dir(path)


class Landing(DataSource):
    """``df.write.format("landing").mode("append").save(folder)`` of rows (name, bytes): a file each, below the folder."""

    @classmethod
    def name(cls) -> str:
        return "landing"

    def writer(self, schema, overwrite: bool) -> LandingWriter:
        if overwrite:
            raise ValueError("files are landed with mode append; one of the same name is replaced")
        if not {"name", "bytes"} <= set(schema.names):
            raise ValueError("rows to land need the columns name and bytes")
        return LandingWriter(self.options)


def land(rows: DataFrame, folder: str) -> None:
    """Land rows (name, bytes) below ``folder``, which may have any scheme that Arrow's file systems know.

    Rows without a name or bytes are not written; of several of one name one is left. Nothing of the
    files passes the driver, only the names of the tasks' lists.
    """
    rows.sparkSession.dataSource.register(Landing)
    rows.select("name", "bytes").write.format("landing").mode("append").save(folder)


def landed_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """(job, files) of every landing that was committed below ``folder``."""
    system, path = fs.FileSystem.from_uri(f"{folder.rstrip('/')}/{LISTS}")
    made = []
    for info in system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)):
        if info.base_name == "_SUCCESS":
            with system.open_input_stream(info.path) as held:
                made.append((posixpath.basename(posixpath.dirname(info.path)), json.loads(held.read())["files"]))
    return spark.createDataFrame(made, "job string, files long")
