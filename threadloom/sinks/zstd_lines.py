"""A data source that writes lines as Zstandard files.

Spark's text writer offers no zstd here; the written files are read back by its text reader. Rows
are ``(value)``, ``(value, file)`` or ``(frame, file)``, frames of lines that ``frames`` has packed. With a ``file`` column every
file name becomes one file, so all rows of a name must be in one partition, next to each other. A name that two tasks wrote, or
that is there already in append mode, is refused before any file is moved. A file is a row of frames of bounded
size, so ``packed_lines`` can read it by ranges.
"""

from __future__ import annotations

import sys
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from threadloom.sources.paths import open_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of lines in a frame; a longer line is a frame by itself.
FRAME_BYTES = 4 << 20


def packed(lines: list[str]) -> bytes:
    return pa.compress("".join(lines).encode("utf-8"), codec="zstd", asbytes=True)


def runs(batch: pa.RecordBatch, column: str) -> Iterator[tuple[str | None, pa.Array]]:
    """Stretches of rows that go to the same file."""
    values = batch.column(column)
    found = pc.run_end_encode(batch.column("file").cast(pa.string()))
    start = 0
    for end, name in zip(found.run_ends.to_pylist(), found.values.to_pylist()):
        yield name, values.slice(start, end - start)
        start = end


def ended(values: pa.Array) -> list[str]:
    return pc.binary_join_element_wise(pc.fill_null(values, ""), "", "\n").to_pylist()


def frames(frame_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs ``(value, file)``, where the rows of a file are next to each other, to ``(frame, file)``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pending, size = None, [], 0

        def frame() -> pa.RecordBatch:
            row = [pa.array([packed(pending)], pa.binary()), pa.array([current], pa.string())]
            return pa.RecordBatch.from_arrays(row, ["frame", "file"])

        for batch in batches:
            for name, values in runs(batch, "value"):
                for line in ended(values):
                    if pending and (name != current or size >= frame_bytes):
                        yield frame()
                        pending, size = [], 0
                    current = name
                    pending.append(line)
                    size += len(line)
        if pending:
            yield frame()

    return pack


@dataclass
class WrittenFiles(WriterCommitMessage):
    attempt: str
    names: list


class ZstdLinesWriter(DataSourceArrowWriter):
    """Tasks write below a hidden folder of their own; the commit moves the finished files."""

    def __init__(self, path: str, overwrite: bool, frame_bytes: int = FRAME_BYTES):
        self.path = path
        self.overwrite = overwrite
        self.frame_bytes = frame_bytes
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        context = TaskContext.get()
        part, attempt = context.partitionId(), f"{context.partitionId()}-{context.taskAttemptId()}"
        system, root = open_path(self.path)
        folder = f"{root}/_temporary-{self.job}/{attempt}"
        system.create_dir(folder, recursive=True)
        names: list[str] = []
        out, pending, size = None, [], 0

        def frame() -> None:
            if pending:
                out.write(packed(pending))
                pending.clear()

        try:
            for batch in iterator:
                for name, values in self._runs(batch, f"part-{part:05d}-{self.job}.zst"):
                    if not names or names[-1] != name:
                        if name in names:
                            raise ValueError(f"rows of {name} are not next to each other")
                        if out:
                            frame()
                            out.close()
                        names.append(name)
                        out, size = system.open_output_stream(f"{folder}/{name}", compression=None), 0
                    if pa.types.is_binary(values.type):
                        for one in values.to_pylist():
                            out.write(one)
                        continue
                    for line in ended(values):
                        pending.append(line)
                        size += len(line)
                        if size >= self.frame_bytes:
                            frame()
                            size = 0
            if out:
                frame()
        finally:
            if out:
                out.close()
        return WrittenFiles(attempt, names)

    @staticmethod
    def _runs(batch: pa.RecordBatch, single: str) -> Iterator[tuple[str, pa.Array]]:
        """Stretches of rows that go to the same file."""
        if "file" in batch.schema.names:
            yield from runs(batch, "frame" if "frame" in batch.schema.names else "value")
        elif len(batch):
            yield single, batch.column("value")

    def commit(self, messages: list) -> None:
        system, root = open_path(self.path)
        there = [info for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if info.is_file]
        made = [(message.attempt, name) for message in messages if message for name in message.names]
        names = Counter(name for _, name in made)
        if not self.overwrite:
            names.update(info.base_name for info in there if info.base_name in names)
        twice = sorted(name for name, times in names.items() if times > 1)
        if twice:
            self._drop_temporary(system, root)
            raise ValueError(f"{len(twice)} file names are written twice or exist already, {twice[0]} among them")

        def move(item: tuple[str, str]) -> None:
            attempt, name = item
            system.move(f"{root}/_temporary-{self.job}/{attempt}/{name}", f"{root}/{name}")

        # On an object store a move is a copy; several run at once.
        with ThreadPoolExecutor(16) as pool:
            if self.overwrite:
                list(pool.map(system.delete_file, [info.path for info in there]))
            list(pool.map(move, made))
        self._drop_temporary(system, root)

    def abort(self, messages: list) -> None:
        self._drop_temporary(*open_path(self.path))

    def _drop_temporary(self, system: fs.FileSystem, root: str) -> None:
        folder = f"{root}/_temporary-{self.job}"
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class ZstdLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zstd_lines"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> ZstdLinesWriter:
        return ZstdLinesWriter(self.options["path"], overwrite, int(self.options.get("frame_bytes", FRAME_BYTES)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ZstdLines)
