"""Binary files in the shared folder, written and read by tasks.

Paths are Spark's (``file:``, ``hdfs:``, ``s3:`` or plain); pyarrow opens them.
A file appears under its name only when complete, by a rename of a file that
belongs to one task attempt, so retries and lost executors leave whole files.
"""

from __future__ import annotations

from contextlib import contextmanager

import pyarrow.fs as pafs


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return pafs.LocalFileSystem(), uri


@contextmanager
def whole_file(uri: str):
    """A stream whose file appears as ``uri`` when the block ends well."""
    from pyspark import TaskContext

    task = TaskContext.get()
    fs, path = resolve(uri)
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    mine = f"{folder}/_attempt-{task.taskAttemptId() if task else 0}-{name}"
    with fs.open_output_stream(mine) as out:
        yield out
    fs.move(mine, path)


def open_file(uri: str):
    fs, path = resolve(uri)
    return fs.open_input_stream(path)
