"""Token ids of documents as flat binary files with 64-bit offsets, written and read by Spark tasks.

A folder holds, for every part,

* ``<part>.ids``: the ids of its documents one after another, unsigned little-endian integers of 16 bits where the
  vocabulary allows it and of 32 otherwise,
* ``<part>.offsets``: where each document starts in it, and its end, unsigned little-endian 64-bit integers,
* ``<part>.keys``: the documents' keys, an Arrow file,

and ``manifest.json``, which names the parts in order. A part's offsets count from its own start; its base, the number of
ids in all parts before it, is the prefix sum of the parts' sizes and stands in the manifest. So every part is written once, by
one task, and no task waits for another. Readers map the three files into memory where the folder is a mounted one, and
read ranges of them elsewhere.

Documents are dealt to parts by ranges of (key, text hash, place in the input), by bytes of text and not by key alone, so neither one
key nor null keys nor copies gather in one part. A task names its files by its attempt; only the manifest, written when
all tasks have reported, says which of them count. A repeated or speculative attempt does no harm, and a reader sees a whole set or none.

Keys ascend, null first; equal keys by text hash. Null and empty texts are the end id alone. Very long texts are encoded whole.
Repeated rows are documents of their own. An empty table gives a manifest without parts, read back as no rows. Columns other than
the key and the text are left out before anything is added, so their names can't clash.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from threadloom.llm.tokens import VOCABULARY, encoder
from threadloom.sources.paths import open_path, qualified

END = 0
#: Bytes of text in a part.
PART_BYTES = 16 << 20
#: Bytes of ids in a batch that a reader passes on; a longer document is a batch by itself.
BATCH_BYTES = 4 << 20
MANIFEST = "manifest.json"


@dataclass
class WrittenPart(WriterCommitMessage):
    number: int
    name: str
    documents: int
    tokens: int


class TokenFilesWriter(DataSourceArrowWriter):
    """Encodes the rows (key, text) of a task and writes them as one part."""

    def __init__(self, options: dict, kind: str):
        self.path = options["path"]
        self.vocabulary = options["vocabulary"]
        self.end = int(options["end"])
        self.kind = kind
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenPart:
        context = TaskContext.get()
        system, root = open_path(self.path)
        coder = encoder(self.vocabulary)
        width = "<u2" if max(coder.library.get_vocab_size() - 1, self.end) < 1 << 16 else "<u4"
        name = f"{self.job}-{context.partitionId():06d}-{context.taskAttemptId()}"
        end = np.array([self.end], "<u4").tobytes()
        documents = tokens = 0
        with ExitStack() as files:
            for batch in iterator:
                if not documents and len(batch):
                    system.create_dir(root, recursive=True)
                    ids = files.enter_context(system.open_output_stream(f"{root}/{name}.ids"))
                    offsets = files.enter_context(system.open_output_stream(f"{root}/{name}.offsets"))
                    keys = files.enter_context(system.open_output_stream(f"{root}/{name}.keys"))
                    held = files.enter_context(pa.ipc.new_file(keys, pa.schema([batch.schema.field(0)])))
                    offsets.write(np.zeros(1, "<u8").tobytes())
                ends = []
                for encoded in coder.encode_column(batch.column(1), end):
                    found = np.frombuffer(encoded, "<u4").astype(width, copy=False)
                    ids.write(found.tobytes())
                    tokens += len(found)
                    ends.append(tokens)
                if len(batch):
                    offsets.write(np.array(ends, "<u8").tobytes())
                    held.write_batch(batch.select([0]))
                    documents += len(batch)
        return WrittenPart(context.partitionId(), name, documents, tokens)

    def commit(self, messages: list) -> None:
        """Prefix sums of the parts' sizes, and the manifest that makes them count."""
        system, root = open_path(self.path)
        parts = sorted((m for m in messages if m and m.documents), key=lambda part: part.number)
        before = [0, *accumulate(part.tokens for part in parts)]
        vocabulary = encoder(self.vocabulary).library.get_vocab_size()
        manifest = {
            "kind": self.kind,
            "width": 2 if max(vocabulary - 1, self.end) < 1 << 16 else 4,
            "end": self.end,
            "tokens": before[-1],
            "parts": [
                {"name": part.name, "documents": part.documents, "tokens": part.tokens, "base": base}
                for part, base in zip(parts, before)
            ],
        }
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{MANIFEST}.{self.job}") as out:
            out.write(json.dumps(manifest).encode())
        system.move(f"{root}/{MANIFEST}.{self.job}", f"{root}/{MANIFEST}")
        self._drop({part.name for part in parts})

    def abort(self, messages: list) -> None:
        self._drop(set())

    def _drop(self, kept: set[str]) -> None:
        """Delete what attempts of this job have left that don't count."""
        system, root = open_path(self.path)
        for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            name = info.base_name.rpartition(".")[0]
            if info.base_name.startswith(self.job) and name not in kept:
                system.delete_file(info.path)


@dataclass
class Part(InputPartition):
    name: str
    documents: int
    base: int


class TokenFilesReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.manifest = read_manifest(path)

    def partitions(self) -> list[Part]:
        return [Part(part["name"], part["documents"], part["base"]) for part in self.manifest["parts"]]

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark plans one empty partition when there is no part.
            return
        system, root = open_path(self.path)
        width = self.manifest["width"]

        def opened(ending: str) -> pa.NativeFile:
            path = f"{root}/{partition.name}.{ending}"
            return pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)

        with opened("ids") as ids, opened("offsets") as offsets, opened("keys") as keys:
            places = np.frombuffer(offsets.read_buffer(8 * (partition.documents + 1)), "<u8")
            first = 0
            with pa.ipc.open_file(keys) as held:
                for number in range(held.num_record_batches):
                    column, at = held.get_batch(number).column(0), 0
                    while at < len(column):
                        most = places[first] + BATCH_BYTES // width
                        last = max(first + 1, min(first + len(column) - at, int(np.searchsorted(places, most, "right")) - 1))
                        here = places[first : last + 1]
                        ids.seek(int(here[0]) * width)
                        found = np.frombuffer(ids.read_buffer(int(here[-1] - here[0]) * width), f"<u{width}").astype("<u4")
                        ends = ((here - here[0]) * 4).astype(np.int64)
                        packed = pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(), last - first, [None, pa.py_buffer(ends), pa.py_buffer(found)]
                        )
                        yield pa.RecordBatch.from_arrays(
                            [
                                column.slice(at, last - first),
                                pa.array((here[:-1] + np.uint64(partition.base)).astype(np.int64)),
                                pa.array(np.diff(here).astype(np.int64)),
                                packed.cast(pa.binary()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )
                        at, first = at + last - first, last


def read_manifest(path: str) -> dict:
    system, root = open_path(path)
    with system.open_input_stream(f"{root}/{MANIFEST}") as file:
        return json.loads(file.read())


class TokenFiles(DataSource):
    """Format ``token_files``: writes (key, text), reads (doc_id, start, n_tokens, ids)."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        kind = read_manifest(self.options["path"])["kind"]
        return f"doc_id {kind}, start bigint, n_tokens bigint, ids binary"

    def reader(self, schema: StructType) -> TokenFilesReader:
        return TokenFilesReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> TokenFilesWriter:
        return TokenFilesWriter(dict(self.options), schema.fields[0].dataType.simpleString())


def write_token_files(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    end: int = END,
    part_bytes: int = PART_BYTES,
) -> str:
    """Encode ``docs`` in ascending order of ``doc_id`` and write them below ``path``, which must be new; returns its full name."""
    spark = docs.sparkSession
    spark.dataSource.register(TokenFiles)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = F.sum(16 + F.coalesce(F.octet_length("text"), F.lit(0)))
    parts = math.ceil((rows.agg(size.alias("n")).first()["n"] or 0) / part_bytes)
    order = ["doc_id", "_hash", "_row"]
    placed = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(max(1, parts), *order).sortWithinPartitions(*order)
    target = qualified(spark, path)
    options = {"vocabulary": vocabulary or public_tokenizers.path(VOCABULARY), "end": end}
    dealt.select("doc_id", "text").write.format("token_files").mode("append").options(**options).save(target)
    return target


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").load(qualified(spark, path))
