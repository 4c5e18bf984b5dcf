"""Lines of compressed archives, read by ranges of a file.

A ``.zst`` file may hold many frames and an ``.xz`` file many blocks and streams. Each of these can be unpacked by itself, so a
large file is cut into byte ranges and every range is a task. A frame or block belongs to the range it starts in. Frames are found
without reading what lies before: the task looks for the mark of a frame and believes it only if the headers
that follow lead, block by block, to another frame or to the end of the file. Blocks are found in the index behind
them, read from the end of the file.

Lines don't end where frames do. A range drops what comes before its first newline, unless it begins the file, and goes on into the
frames behind it up to the first newline there: that is the line the next range drops. So every line is read once.
Files of one frame or block are one task; small files share one. ``.gz``, ``.bz2`` and other names are read as one range each
(their splitting is left to Spark's own reader, see ``archive``), plain text by ranges as well.

Values are the bytes of the lines as they stand, as Spark's text reader gives them. A file that ends inside a frame or
block is an error. Frames may use windows of up to 2 GB, as archives packed with ``--long=31`` do.
"""

from __future__ import annotations

import bz2
import lzma
import re
import struct
import sys
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from threadloom.sources.paths import open_path

# Executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Packed bytes of a range, and of the small files that share a task.
SPLIT_BYTES = 32 << 20
#: Tasks beyond which ranges share them, however small ``split`` is.
MOST_TASKS = 1024
SCHEMA = "value string, file string, bytes bigint, period string"
PIECE = 1 << 17
BATCH_BYTES = 1 << 20
BYTE_ORDER_MARK = b"\xef\xbb\xbf"
# Fixed values of the two formats.
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
LONGEST_WINDOW = 1 << 31
XZ_MAGIC = b"\xfd7zXZ\x00"
XZ_END = b"YZ"
XZ_HEADER = 12


class Bytes:
    """Reads anywhere in a file, through one buffer."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file = file
        self.size = size
        self.start = 0
        self.held = b""

    def at(self, place: int, count: int) -> bytes:
        """``count`` bytes from ``place``, fewer at the end of the file."""
        count = max(0, min(count, self.size - place))
        if not (self.start <= place and place + count <= self.start + len(self.held)):
            self.start, self.held = place, self.file.read_at(max(count, min(2 * PIECE, self.size - place)), place)
        return self.held[place - self.start : place - self.start + count]


# Zstandard -----------------------------------------------------------------------------------------


def skippable_end(data: Bytes, place: int) -> int | None:
    """Where a frame without content ends, None if there is none."""
    head = data.at(place, 8)
    if len(head) < 8 or int.from_bytes(head[:4], "little") not in SKIPPABLE:
        return None
    return place + 8 + int.from_bytes(head[4:], "little")


def frame_end(data: Bytes, place: int) -> int | None:
    """Where the frame at ``place`` ends by its headers, None if they can't be those of a frame."""
    head = data.at(place, 5)
    if len(head) < 5 or head[:4] != ZSTD_MAGIC:
        return None
    about = head[4]
    single, content = about >> 5 & 1, about >> 6
    if about & 8:  # a reserved bit
        return None
    place += 5 + (1 - single) + (0, 1, 2, 4)[about & 3] + ((1, 2, 4, 8)[content] if single or content else 0)
    while True:
        head = data.at(place, 3)
        if len(head) < 3:
            return None
        block = int.from_bytes(head, "little")
        kind, size = block >> 1 & 3, block >> 3
        if kind == 3 or size > PIECE:  # a reserved kind, and more than a block may hold
            return None
        place += 3 + (1 if kind == 1 else size)
        if block & 1:
            place += 4 if about & 4 else 0
            return place if place <= data.size else None


def first_frame(data: Bytes, start: int, end: int) -> int | None:
    """The first frame that starts in the range."""
    if start == 0:
        return 0
    place = start
    while place < end:
        piece = data.at(place, min(PIECE, end - place) + 3)
        found = piece.find(ZSTD_MAGIC)
        if found < 0:
            place += max(1, len(piece) - 3)
            continue
        place += found
        after = frame_end(data, place)
        while after is not None and (skipped := skippable_end(data, after)) is not None:
            after = skipped
        if place < end and after is not None and (after == data.size or data.at(after, 4) == ZSTD_MAGIC):
            return place
        place += 1
    return None


def zstd_chunks(data: Bytes, start: int, end: int) -> Iterator[tuple[bool, bytes]]:
    """Unpacked bytes from the range's first frame on, each with whether its frame starts in the range."""
    import zstandard

    place = first_frame(data, start, end)
    while place is not None and place < data.size:
        skipped = skippable_end(data, place)
        if skipped is not None:
            place = skipped
            continue
        own = place < end
        unpack = zstandard.ZstdDecompressor(max_window_size=LONGEST_WINDOW).decompressobj()
        while not unpack.eof:
            packed = data.at(place, PIECE)
            if not packed:
                raise EOFError("the file ends inside a frame")
            unpacked = unpack.decompress(packed)
            place += len(packed) - len(unpack.unused_data)
            if unpacked:
                yield own, unpacked


# xz ------------------------------------------------------------------------------------------------


def _number(data: bytes, place: int) -> tuple[int, int]:
    """A number of seven bits a byte, the lowest first, and the place behind it."""
    value = shift = 0
    while True:
        byte = data[place]
        value |= (byte & 0x7F) << shift
        place, shift = place + 1, shift + 7
        if not byte & 0x80:
            return value, place


def xz_blocks(data: Bytes, start: int = 0) -> list[tuple[int, int, int]]:
    """(place, length, place of the stream's header) of the blocks from the stream that holds ``start`` on, in order."""
    found: list[tuple[int, int, int]] = []
    end = data.size
    while end > start:
        while end >= 4 and data.at(end - 4, 4) == bytes(4):  # padding between streams
            end -= 4
        if end < 2 * XZ_HEADER:
            if end:
                raise EOFError("the file ends inside a stream")
            break
        foot = data.at(end - XZ_HEADER, XZ_HEADER)
        check, behind = struct.unpack("<II", foot[:8])
        if foot[10:] != XZ_END or zlib.crc32(foot[4:10]) != check:
            raise EOFError("the file ends inside a stream")
        index_size = (behind + 1) * 4
        index_start = end - XZ_HEADER - index_size
        index = data.at(index_start, index_size)
        count, place = _number(index, 1)
        lengths = []
        for _ in range(count):
            length, place = _number(index, place)
            place = _number(index, place)[1]
            lengths.append((length + 3) // 4 * 4)
        header = index_start - sum(lengths) - XZ_HEADER
        if header < 0 or data.at(header, 6) != XZ_MAGIC:
            raise ValueError("the index of a stream does not lead to its header")
        ends = np.cumsum([header + XZ_HEADER, *lengths]).tolist()
        found.extend((at, length, header) for at, length in reversed(list(zip(ends, lengths))))
        end = header
    return found[::-1]


def xz_chunks(data: Bytes, start: int, end: int) -> Iterator[tuple[bool, bytes]]:
    """As ``zstd_chunks``, for blocks. A block is unpacked behind the header of its stream."""
    stream, unpack = None, lzma.LZMADecompressor(lzma.FORMAT_XZ)
    for place, length, header in xz_blocks(data, start):
        if place < start and start > 0:
            continue
        if header != stream:
            stream, unpack = header, lzma.LZMADecompressor(lzma.FORMAT_XZ)
            unpack.decompress(data.at(header, XZ_HEADER))
        behind = place + length
        own = place < end
        while place < behind:
            packed = data.at(place, min(PIECE, behind - place))
            place += len(packed)
            while packed or not unpack.needs_input:
                unpacked = unpack.decompress(packed, max_length=BATCH_BYTES)
                packed = b""
                if unpacked:
                    yield own, unpacked


# Other files ---------------------------------------------------------------------------------------


def plain_chunks(data: Bytes, start: int, end: int) -> Iterator[tuple[bool, bytes]]:
    place = start
    while place < data.size:
        own = place < end
        chunk = data.at(place, min(PIECE, end - place) if own else PIECE)
        place += len(chunk)
        yield own, chunk


def stream_chunks(unpacker: Any) -> Any:
    """Chunks of a file whose members are unpacked one after another; such a file is one range."""

    def chunks(data: Bytes, start: int, end: int) -> Iterator[tuple[bool, bytes]]:
        place, unpack = 0, unpacker()
        while place < data.size:
            packed = data.at(place, PIECE)
            if unpack.eof:
                if not packed.strip(b"\0"):
                    place += len(packed)
                    continue
                unpack = unpacker()
            unpacked = unpack.decompress(packed)
            place += len(packed) - len(unpack.unused_data)
            if unpacked:
                yield True, unpacked
        if data.size and not unpack.eof:
            raise EOFError("the file is cut off")

    return chunks


CHUNKS = {
    "zst": zstd_chunks,
    "xz": xz_chunks,
    "gz": stream_chunks(lambda: zlib.decompressobj(31)),
    "bz2": stream_chunks(bz2.BZ2Decompressor),
}
WHOLE = ("gz", "bz2")


def ending(name: str) -> str:
    """The codec part of a file name."""
    return name.rpartition(".")[2]


# Lines ---------------------------------------------------------------------------------------------


def stitched(chunks: Iterable[tuple[bool, bytes]], first: bool) -> Iterator[bytes]:
    """The bytes of a range's lines: from behind its first newline to the first one in what follows."""
    begun = first
    fresh = first
    for own, chunk in chunks:
        if fresh:
            chunk, fresh = chunk.removeprefix(BYTE_ORDER_MARK), False
        if not own and not begun:
            return
        if not own:
            cut = chunk.find(b"\n")
            yield chunk[: cut + 1] if cut >= 0 else chunk
            if cut >= 0:
                return
            continue
        if not begun:
            cut = chunk.find(b"\n")
            if cut < 0:
                continue
            chunk, begun = chunk[cut + 1 :], True
        yield chunk


def values(lines: bytes) -> pa.Array:
    """Lines that all end in a newline, as they stand."""
    held = np.frombuffer(lines, np.uint8)
    breaks = np.flatnonzero(held == 10)
    ends = np.zeros(len(breaks) + 1, np.int32)
    ends[1:] = breaks - np.arange(len(breaks))
    text = held[held != 10]
    return pa.StringArray.from_buffers(len(breaks), pa.py_buffer(ends), pa.py_buffer(text))


def line_arrays(chunks: Iterable[bytes]) -> Iterator[pa.Array]:
    """Cut byte chunks at newlines; the last line may be unterminated."""
    pending: list[bytes] = []
    size = 0
    for chunk in chunks:
        pending.append(chunk)
        size += len(chunk)
        if size < BATCH_BYTES or b"\n" not in chunk:
            continue
        whole, _, rest = b"".join(pending).rpartition(b"\n")
        yield values(whole + b"\n")
        pending, size = [rest], len(rest)
    last = b"".join(pending)
    if last:
        yield values(last if last.endswith(b"\n") else last + b"\n")


@dataclass
class Range:
    path: str
    bytes: int
    start: int
    end: int


def lines_in(data: Bytes, part: Range) -> Iterator[pa.Array]:
    chunks = CHUNKS.get(ending(part.path), plain_chunks)(data, part.start, part.end)
    yield from line_arrays(stitched(chunks, part.start == 0))


def range_lines(system: fs.FileSystem, part: Range) -> Iterator[pa.Array]:
    with system.open_input_file(part.path) as file:
        yield from lines_in(Bytes(file, part.bytes), part)


def pieces(path: str, size: int, split: int) -> int:
    """How many ranges a file has."""
    return 1 if ending(path) in WHOLE or size <= split else -(-size // split)


def cut(path: str, size: int, split: int) -> list[Range]:
    """The ranges of a file."""
    return Stretch(path, size, pieces(path, size, split)).ranges()


@dataclass
class Stretch:
    """Ranges of a file that follow each other, from ``first`` up to ``last`` of ``count``."""

    path: str
    bytes: int
    count: int
    first: int = 0
    last: int | None = None

    def ranges(self) -> list[Range]:
        last = self.count if self.last is None else self.last
        ends = [self.bytes * k // self.count for k in range(self.first, last + 1)]
        return [Range(self.path, self.bytes, start, end) for start, end in zip(ends, ends[1:])]


# The data source -----------------------------------------------------------------------------------


@dataclass
class Ranges(InputPartition):
    stretches: list[Stretch] = field(default_factory=list)


def period(name: str) -> str:
    """The ``yyyy-MM`` (or ``yyyy-MM-dd``) part of a file name, empty if there is none."""
    found = re.search(r"[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?", name)
    return found[0] if found else ""


class PackedLinesReader(DataSourceReader):
    """Lines of the ``.zst`` and ``.xz`` files of a folder, or of one file.

    Tests on names, periods and sizes are options and are applied to the listing, so a file that fails one is never
    opened. (They are not taken from the query's own conditions: Spark 4.1.2 keeps conditions that a Python source took
    over with the loaded table, and applies them to every other query on it.)
    """

    def __init__(self, options: dict):
        self.path = options["path"]
        self.endings = tuple(options.get("endings", "zst,xz").split(","))
        self.split = int(options.get("split", SPLIT_BYTES))
        self.prefix, self.contains, self.excludes = (options.get(name, "") for name in ("prefix", "contains", "excludes"))
        self.since, self.until = options.get("since"), options.get("until")
        self.above, self.zst_above = (int(options.get(name, -1)) for name in ("above", "zst_above"))
        self.upto = int(options.get("upto", 1 << 62))

    def wanted(self, name: str, size: int) -> bool:
        if name[0] in "._" or ending(name) not in self.endings or not name.startswith(self.prefix):
            return False
        if self.contains not in name or (self.excludes.strip() and self.excludes in name):
            return False
        if not self.above < size <= self.upto or (ending(name) == "zst" and size <= self.zst_above):
            return False
        when = period(name)
        if (self.since is not None or self.until is not None) and not when:
            return False
        # An end of a month or year includes its days.
        return (self.since is None or when >= self.since) and (self.until is None or when[: len(self.until)] <= self.until)

    def files(self) -> list[fs.FileInfo]:
        system, path = open_path(self.path)
        info = system.get_file_info(path)
        infos = [info] if info.is_file else system.get_file_info(fs.FileSelector(path))
        return [item for item in infos if item.is_file and self.wanted(item.base_name, item.size)]

    def partitions(self) -> list[Ranges]:
        """Ranges of large files by themselves, small files together, and small ranges if there are very many."""
        files = sorted(self.files(), key=lambda item: -item.size)
        share = max(self.split, -(-sum(item.size for item in files) // MOST_TASKS))
        least = share // 64  # opening a file has a cost of its own
        found: list[Ranges] = []
        room = 0
        for item in files:
            count, first = pieces(item.path, item.size, self.split), 0
            each = max(1, -(-item.size // count))
            while first < count:
                if each > room:
                    found.append(Ranges())
                    room = share
                last = min(count, first + max(1, room // each))
                found[-1].stretches.append(Stretch(item.path, item.size, count, first, last))
                room -= max(each * (last - first), least)
                first = last
        return found

    def read(self, partition: Ranges | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark plans one empty partition when no file matches.
            return
        system = open_path(self.path)[0]
        for stretch in partition.stretches:
            name = stretch.path.rsplit("/", 1)[-1]
            facts = {"file": name, "bytes": stretch.bytes, "period": period(name)}
            with system.open_input_file(stretch.path) as file:
                data = Bytes(file, stretch.bytes)
                for lines in (lines for part in stretch.ranges() for lines in lines_in(data, part)):
                    columns = [lines, *(pa.repeat(pa.scalar(fact), len(lines)) for fact in facts.values())]
                    yield pa.RecordBatch.from_arrays(columns, ["value", *facts])


class PackedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "packed_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PackedLinesReader:
        return PackedLinesReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PackedLines)


# Files that arrive as rows -------------------------------------------------------------------------


def lines_of_files(files: DataFrame, split: int = SPLIT_BYTES) -> DataFrame:
    """Lines ``(value, file)`` of the files ``(path, length)``, of any codec; works on a stream of files too.

    The ranges of the files are dealt out before they are read.
    """
    name = F.element_at(F.split("path", "/"), -1)
    parts = F.when(F.element_at(F.split("path", r"\."), -1).isin(*WHOLE), 1)
    parts = parts.otherwise(F.greatest(F.lit(1), F.ceil(F.col("length") / F.lit(split))).cast("int"))
    ranges = files.select("path", "length", parts.alias("parts"))
    ranges = ranges.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    edge = lambda part: F.floor(F.col("length") * part / F.col("parts")).cast("bigint")
    ranges = ranges.select(
        "path", "length", edge(F.col("part")).alias("start"), edge(F.col("part") + 1).alias("end"), name.alias("file")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start, end, file in zip(*(column.to_pylist() for column in batch.columns)):
                system, inner = open_path(path)
                for lines in range_lines(system, Range(inner, size, start, end)):
                    yield pa.RecordBatch.from_arrays([lines, pa.repeat(pa.scalar(file), len(lines))], ["value", "file"])

    # By number: the names are so short that the optimizer would put all of them into one task otherwise.
    spark = files.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    dealt = ranges.repartition(tasks, "path", "start")
    return dealt.mapInArrow(read, "value string, file string")
