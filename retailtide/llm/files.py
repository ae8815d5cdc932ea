"""Files that tasks write and read themselves, in the folder that the cluster shares.

A task writes under a name of its own attempt and returns the name as a row. Only files named in the
rows that Spark has committed count, so a lost or repeated attempt leaves a file that nobody reads.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it of a folder or file; a bare path is local."""
    if urlsplit(uri).scheme:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


#: Bytes of files that a task reads, where there are enough for all cores.
TASK_BYTES = 64 * 2**20


def tasks_for(spark: SparkSession, parts: int, size: int) -> int:
    """How many tasks are to read so many parts of files, of so many bytes in all."""
    return max(1, min(parts, max(-(-size // TASK_BYTES), spark.sparkContext.defaultParallelism)))


def new_file(folder: str, suffix: str):
    """A new file of this attempt: its uri, and a stream to write."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    name = f"part-{uuid.uuid4().hex}{suffix}"
    return f"{folder}/{name}", system.open_output_stream(f"{path}/{name}", compression=None)


def random_access(uri: str):
    """A file to read at any place; a local one is mapped to memory."""
    system, path = opened(uri)
    if isinstance(system, pafs.LocalFileSystem):
        import pyarrow as pa

        return pa.memory_map(path)
    return system.open_input_file(path)
