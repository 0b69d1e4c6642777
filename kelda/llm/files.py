"""Binary files that tasks write to the shared folder and read back.

A task writes each file under a name of its own attempt and reports it in its rows; the rows are
stored by Spark's committer. So only files of committed attempts are ever listed, and a retried or
speculative attempt leaves at most a file that nobody reads.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def folder_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI (local, HDFS, S3 and so on) and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "", 1))


class TaskFiles:
    """Names and writes the files of one task attempt."""

    def __init__(self, folder: str, suffix: str) -> None:
        context = TaskContext.get()
        self.part = context.partitionId()
        self.attempt = context.taskAttemptId()
        self.folder, self.suffix, self.count = folder.rstrip("/"), suffix, 0
        self.system, self.path = folder_of(self.folder)
        self.system.create_dir(self.path, recursive=True)

    def write(self, *parts: bytes) -> str:
        """Write one file; returns its name within the folder."""
        name = f"part-{self.part:06d}-{self.count:06d}-{self.attempt}{self.suffix}"
        self.count += 1
        with self.system.open_output_stream(f"{self.path}/{name}", compression=None) as out:
            for part in parts:
                out.write(part)
        return name


def read_range(folder: str, name: str, start: int, size: int) -> bytes:
    system, path = folder_of(folder)
    with system.open_input_file(f"{path}/{name}") as file:
        file.seek(start)
        return file.read(size)


def one_task_a_file(listing: DataFrame, files: int) -> DataFrame:
    """Spread the rows of a listing so that its files are read side by side."""
    lanes = 8 * listing.sparkSession.sparkContext.defaultParallelism
    return listing.repartition(max(1, min(files, lanes)), F.col("file"))
