"""Byte ranges of files in the shared folder, from inside tasks.

Every attempt of a task writes files of its own name; only the names that Spark's committed rows
carry are ever read, so a repeated or lost attempt leaves no trace in the result.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system named, as Spark itself would resolve it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def locate(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), path


def new_file(folder: str, stem: str, suffix: str) -> str:
    """A path no other task or attempt uses; the folder is made if needed."""
    system, place = locate(folder)
    system.create_dir(place, recursive=True)
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"


def create(path: str):
    system, place = locate(path)
    return system.open_output_stream(place)


def open_ranges(path: str):
    """A file with ``read_at(n, offset)`` and ``size()``."""
    system, place = locate(path)
    return system.open_input_file(place)
