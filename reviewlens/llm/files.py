"""Binary files in shared storage, written and read by tasks.

A task writes files under names of its own (a retried task writes new ones);
only those that it reports in its result rows count.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext


def new_path(folder: str, suffix: str) -> str:
    task = TaskContext.get()
    return f"{folder}/{task.partitionId() if task else 0:06d}-{uuid.uuid4().hex}{suffix}"


def open_output(uri: str) -> pa.NativeFile:
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def open_input(uri: str) -> pa.NativeFile:
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)
