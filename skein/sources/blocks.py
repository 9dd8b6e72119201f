"""Block-compressed text files, read by many tasks each.

Call files are often compressed in blocks: a gzip file of many small members, each of which says in its header how long it is. A split
of such a file is a range of bytes. Its task looks for the first block that begins there, and reads lines until one begins beyond the last;
the line that is under way where a split begins belongs to the split before. So one large file is read by as many tasks as it has splits,
while Spark's own text reader gives all of it to one.

Rows are those of ``text.lines``: file, line_no (offset of the line's block times 65,536 plus its offset in the block, so they ascend within a file
as lines do, over all splits) and value. ``fields`` are the tab-separated columns to keep of lines that don't begin with ``##``: other samples' columns are
dropped before a row is made. ``regions`` keeps header lines and the lines of these stretches; with ``sorted`` files, splits that can't have any
aren't read: planning looks at the first line of each split.

Gzip files without such blocks and plain files are read by one task each. Paths are files, folders or patterns of the last part of a path, on any file system that
pyarrow knows. An empty file has no lines; a file that ends without a line end has its last line; a broken block is an error.
"""

from __future__ import annotations

import fnmatch
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "file string, line_no long, value string"
#: Bytes of a split, of what is read at once, and of the text in one block that is written.
SPLIT, CHUNK, BLOCK = 64 << 20, 4 << 20, 0xFF00
#: A member with an extra field; in it, the two letters and the length of the field that has the block's size less one (the format's fixed values).
_BLOCK = re.compile(rb"\x1f\x8b\x08\x04.{6}(..)BC\x02\x00(..)", re.S)
#: The empty block that ends a file (fixed value of the format).
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def opened(path: str):
    """(file system, path in it) of a uri or local path."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def listed(path: str) -> list[tuple[str, int]]:
    """(uri, size) of the files that a path names: itself, those in a folder, or those whose last part fits a pattern."""
    fs, inner = opened(path)
    head = path[: len(path) - len(inner)] if path.endswith(inner) else "file://"
    pattern = inner.rsplit("/", 1)[-1]
    if any(c in pattern for c in "*?["):
        found = [x for x in fs.get_file_info(pafs.FileSelector(inner.rsplit("/", 1)[0])) if fnmatch.fnmatch(x.base_name, pattern)]
    else:
        info = fs.get_file_info(inner)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(inner))
    return sorted((head + x.path, x.size) for x in found if x.is_file and not x.base_name.startswith(("_", ".")))


def block_size(header: bytes) -> int | None:
    """The size of the block that begins with these bytes, None where none does."""
    found = _BLOCK.match(header)
    return struct.unpack("<H", found[2])[0] + 1 if found else None


class Blocks:
    """A file's blocks from the first that begins at an offset or later: (offset, text) of each."""

    def __init__(self, path: str, start: int) -> None:
        fs, inner = opened(path)
        self.file, self.start, self.path = fs.open_input_file(inner), start, path

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        with self.file as f:
            size, at, data = f.size(), self.start, b""
            if at:
                # A block is shorter than 64 KB, so its successor's header is at most so far away; compressed bytes can look like one, its successor's then don't.
                data = f.read_at(CHUNK, at)
                for found in _BLOCK.finditer(data):
                    after = found.start() + struct.unpack("<H", found[2])[0] + 1
                    if at + after == size or block_size(data[after : after + 18]):
                        at, data = at + found.start(), data[found.start() :]
                        break
                else:
                    return
            while at < size:
                if len(data) < 18:
                    data += f.read_at(CHUNK, at + len(data))
                length = block_size(data[:18])
                if not length:
                    raise ValueError(f"{self.path}: no block begins at {at}")
                if len(data) < length:
                    data += f.read_at(max(CHUNK, length), at + len(data))
                if len(data) < length:
                    raise ValueError(f"{self.path}: the block at {at} is cut off")
                head = 12 + struct.unpack("<H", data[10:12])[0]
                yield at, zlib.decompress(data[head : length - 8], -15)
                at, data = at + length, data[length:] if length < len(data) else b""


def lines_in(path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(line_no, line) of the lines that belong to a split of a file of blocks."""
    number, parts, skip = 0, [], start > 0
    for at, text in Blocks(path, start):
        begin = 0
        while (stop := text.find(b"\n", begin)) >= 0:
            if not skip:
                if not parts:
                    number = at << 16 | begin
                yield number, b"".join(parts) + text[begin:stop]
            elif at >= end:
                return  # one line goes through the whole split
            parts, skip, begin = [], False, stop + 1
            # The line that begins where the next split's first block does is this one's last.
            if at >= end:
                return
        if begin < len(text) and not skip:
            if not parts:
                number = at << 16 | begin
            parts.append(text[begin:])
    if parts:
        yield number, b"".join(parts)


def _plain(path: str) -> Iterator[tuple[int, bytes]]:
    """(line_no, line) of a file without blocks, compressed by gzip or not; numbers are offsets in the text."""
    fs, inner = opened(path)
    with fs.open_input_stream(inner, compression="gzip" if fs.open_input_file(inner).read(2) == b"\x1f\x8b" else None) as f:
        at, rest = 0, b""
        while chunk := f.read(CHUNK):
            *whole, rest = (rest + chunk).split(b"\n")
            for line in whole:
                yield at, line
                at += len(line) + 1
        if rest:
            yield at, rest


def _region(text: str) -> tuple[bytes, int, int]:
    """chrom, chrom:pos, chrom:from-to or chrom:from- (to its end)."""
    name, _, span = text.partition(":")
    low, to, high = span.replace(",", "").partition("-")
    return name.encode(), int(low or 0), int(high or (1 << 62 if to or not low else low))


def _place(line: bytes) -> tuple[bytes, int] | None:
    cells = line.split(b"\t", 2)
    return (cells[0], int(cells[1])) if len(cells) > 2 and not line.startswith(b"#") and cells[1].isdigit() else None


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int
    blocks: bool


class BlockReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT))
        self.fields = [int(x) for x in options.get("fields", "").split(",") if x]
        self.regions = [_region(x) for x in options.get("regions", "").split(";") if x]
        self.sorted = options.get("sorted", "false").lower() == "true"

    def partitions(self) -> list[Split]:
        out = []
        for path, size in listed(self.path):
            fs, inner = opened(path)
            with fs.open_input_file(inner) as f:
                blocks = block_size(f.read(18)) is not None
            starts = range(0, size, self.split) if blocks else [0]
            splits = [Split(path, at, min(at + self.split, size), blocks) for at in starts]
            out += self._pruned(splits) if self.regions and self.sorted and blocks else splits
        return out

    def _pruned(self, splits: list[Split]) -> list[Split]:
        """The splits of a sorted file that can have lines of the regions: those between whose first line and the next one's a region can lie. The first has the header."""
        firsts = [next((p for _, line in lines_in(s.path, s.start, s.end) if (p := _place(line))), None) for s in splits]
        out = splits[:1]
        for k in range(1, len(splits)):
            low, high = firsts[k], firsts[k + 1] if k + 1 < len(splits) else None
            same = low and high and low[0] == high[0]
            if not low or not same or any(name == low[0] and a <= high[1] and b >= low[1] for name, a, b in self.regions):
                out.append(splits[k])
        return out

    def _wanted(self, line: bytes) -> bool:
        if line.startswith(b"#"):
            return True
        place = _place(line)
        return place is not None and any(name == place[0] and low <= place[1] <= high for name, low, high in self.regions)

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        numbers, values, held = [], [], 0
        names = ["file", "line_no", "value"]
        cut = max(self.fields, default=0) + 1
        for number, line in lines_in(split.path, split.start, split.end) if split.blocks else _plain(split.path):
            if self.regions and not self._wanted(line):
                continue
            if self.fields and not line.startswith(b"##"):
                cells = line.split(b"\t", cut)
                line = b"\t".join([cells[k] for k in self.fields if k < len(cells)])
            numbers.append(number)
            values.append(line)
            held += len(line)
            if held >= CHUNK or len(numbers) >= 10_000:
                yield _batch(split.path, numbers, values, names)
                numbers, values, held = [], [], 0
        if numbers:
            yield _batch(split.path, numbers, values, names)


def _batch(path: str, numbers: list[int], values: list[bytes], names: list[str]) -> pa.RecordBatch:
    lines = pa.array([v[:-1] if v.endswith(b"\r") else v for v in values], pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array([path] * len(numbers), pa.string()), pa.array(numbers, pa.int64()), lines], names)


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class BlockWriter(DataSourceArrowWriter):
    """Writes the column value as lines, a file for each task; files of failed tasks go."""

    def __init__(self, options) -> None:
        self.path = options["path"].rstrip("/")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, inner = opened(self.path)
        fs.create_dir(inner, recursive=True)
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.vcf.gz"
        hidden, rows, rest = f"_{name}", 0, b""
        with fs.open_output_stream(f"{inner}/{hidden}", compression=None) as f:
            for batch in batches:
                values = batch.column("value").to_pylist()
                rows += len(values)
                rest += "".join(f"{v}\n" for v in values if v is not None).encode()
                whole = len(rest) - len(rest) % BLOCK
                for k in range(0, whole, BLOCK):
                    f.write(block(rest[k : k + BLOCK]))
                rest = rest[whole:]
            f.write((block(rest) if rest else b"") + END)
        return Written(hidden if rows else None)

    def commit(self, messages: list[Written | None]) -> None:
        """Only files whose tasks ended well lose their hidden names."""
        fs, inner = opened(self.path)
        for m in messages:
            if m and m.path:
                fs.move(f"{inner}/{m.path}", f"{inner}/{m.path[1:]}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, inner = opened(self.path)
        for m in messages:
            if m and m.path:
                fs.delete_file(f"{inner}/{m.path}")


def block(text: bytes) -> bytes:
    """A block of up to BLOCK bytes of text."""
    packed = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = packed.compress(text) + packed.flush()
    if len(data) + 26 > 1 << 16:  # text that doesn't compress
        packed = zlib.compressobj(0, zlib.DEFLATED, -15)
        data = packed.compress(text) + packed.flush()
    return END[:16] + struct.pack("<H", len(data) + 25) + data + struct.pack("<II", zlib.crc32(text), len(text))


class BlockSource(DataSource):
    """format("blocks"): options path, splitBytes, fields, regions and sorted."""

    @classmethod
    def name(cls) -> str:
        return "blocks"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BlockReader:
        return BlockReader(self.options)

    def writer(self, schema, overwrite: bool) -> BlockWriter:
        return BlockWriter(self.options)


def block_lines(spark: SparkSession, path: str, split_bytes: int = SPLIT, fields: list[int] | None = None, regions: list[str] | None = None, in_order: bool = False) -> DataFrame:
    """file, line_no and value of the lines of block-compressed files. in_order: the files are sorted by place, as call files with an index are."""
    spark.dataSource.register(BlockSource)
    reader = spark.read.format("blocks").option("splitBytes", split_bytes).option("sorted", str(in_order).lower())
    if fields is not None:
        reader = reader.option("fields", ",".join(map(str, fields)))
    if regions is not None:
        reader = reader.option("regions", ";".join(regions))
    return reader.load(path)


def write_blocks(lines: DataFrame, path: str) -> None:
    """Writes lines (value) as block-compressed files under a new folder, in the order of the partitions' rows."""
    lines.sparkSession.dataSource.register(BlockSource)
    lines.select("value").write.format("blocks").mode("append").save(path)
