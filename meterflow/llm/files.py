"""Binary files in the shared folder, written and read by tasks.

Spark's file formats hold rows, not bytes, so tasks open these files through Arrow's file
systems (local paths, s3, gs, hdfs). A task writes under a name of its own and names the
file in its output; only files named there count, so what a lost or repeated attempt left
behind is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext


def open_for_writing(folder: str, suffix: str) -> tuple[str, object]:
    """A new file for this attempt: its path and a stream."""
    path = f"{folder.rstrip('/')}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}{suffix}"
    system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return path, system.open_output_stream(inner, compression=None)


def open_for_reading(path: str):
    """A seekable file."""
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)
