"""Import files under their own names, as a Spark data source to be written to.

Rows come as ``file_name`` and the cells in order. Each task writes its files into a staging folder
beside the target; a file appears there under its name when it is whole, so a task that is run again
only replaces what it wrote. When all tasks are done, the files are moved to the target; when the job fails,
the staging folder goes. Files are reached through Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "wareflow_named_files"
MOVES_AT_ONCE = 16


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path.rstrip("/")
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/").rstrip("/")
    system, inside = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system, inside.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class NamedFiles(DataSource):
    """Options: ``path``, and ``staging``, a name of the job's own."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return NamedFilesWriter(schema, dict(self.options), overwrite)


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict[str, str], overwrite: bool):
        self.columns, self.path, self.overwrite = schema.names[1:], options["path"], overwrite
        self.staging = options.get("staging") or f"_staging-{uuid.uuid4().hex}"

    def _staged(self) -> tuple[fs.FileSystem, str, str]:
        system, target = file_system(self.path)
        return system, target, f"{target}/{self.staging}"

    def write(self, iterator: Iterator[Row]) -> Written:
        """Writes the files of a task; the rows of a file stand together and in order."""
        system, _, staging = self._staged()
        system.create_dir(staging, recursive=True)
        names: list[str] = []
        stream = None

        def finish() -> None:
            if stream is not None:
                stream.close()
                system.move(f"{staging}/{part}", f"{staging}/{names[-1]}")

        part = ""
        for row in iterator:
            if not names or row[0] != names[-1]:
                finish()
                if row[0] in names:
                    raise ValueError(f"the rows of {row[0]} do not stand together")
                names.append(row[0])
                part = f"{uuid.uuid4().hex}.part"
                stream = io.TextIOWrapper(system.open_output_stream(f"{staging}/{part}"), encoding="utf-8", newline="")
                out = csv.writer(stream, lineterminator="\n")
                out.writerow(self.columns)
            out.writerow(["" if cell is None else cell for cell in row[1:]])
        finish()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        system, target, staging = self._staged()
        names = [name for m in messages if m is not None for name in m.names]
        if len(set(names)) < len(names):
            raise ValueError("rows of one file came to several tasks")
        if self.overwrite:
            old = system.get_file_info(fs.FileSelector(target, allow_not_found=True))
            for info in old:
                if info.is_file:
                    system.delete_file(info.path)
        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
            list(pool.map(lambda name: system.move(f"{staging}/{name}", f"{target}/{name}"), names))
        self._drop(system, staging)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, staging = self._staged()
        self._drop(system, staging)

    @staticmethod
    def _drop(system: fs.FileSystem, staging: str) -> None:
        if system.get_file_info(staging).type != fs.FileType.NotFound:
            system.delete_dir(staging)
