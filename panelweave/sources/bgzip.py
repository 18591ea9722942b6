"""Block-gzip text: gzip members of at most 64 KB that say their size.

Any gzip reader reads them as one text.  An index (a Parquet table beside each
file) says where the lines of each member begin and, of tab-separated lines that
start with a chromosome and a position, which positions they span; a filter on
``chr`` and ``pos`` reads only the members that it needs.  A folder holds a file
a partition of the writer, in order; ``_parts.json`` lists them.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.taskcontext import TaskContext

from ..functions import require
from ..functions.shared import open_input, open_output

# fixed values of the format: header up to the size, the empty member at the end,
# bytes of text in a member
HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00"
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
MEMBER = 0xFF00
RANGE_BYTES = 64 << 20
#: An entry a member in which a line begins: its offset in the file, where in it
#: the first of its lines begins, the number of that line in the file, how many
#: begin here, and the first and last chromosome and position of those.
INDEX = pa.schema([("offset", pa.int64()), ("inside", pa.int32()), ("line", pa.int64()), ("lines", pa.int64()), ("chr", pa.string()), ("first", pa.int64()), ("last_chr", pa.string()), ("last", pa.int64())])


def member(text: bytes) -> bytes:
    """One member of at most ``MEMBER`` bytes of text."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = deflate.compress(text) + deflate.flush()
    return HEAD + (len(data) + 25).to_bytes(2, "little") + data + zlib.crc32(text).to_bytes(4, "little") + len(text).to_bytes(4, "little")


def place(line: bytes) -> tuple[str | None, int | None]:
    """Chromosome and position of a line; none of a header or of other text."""
    f = line.split(b"\t", 2)
    if line.startswith(b"#") or len(f) < 2 or not f[1].isdigit():
        return None, None
    return f[0].decode(), int(f[1])


class _Indexer:
    """Entries of the members of a file, as they come."""

    def __init__(self) -> None:
        self.entries: list[tuple] = []
        self.lines, self.rest = 0, b""

    def add(self, offset: int, text: bytes) -> None:
        """A member's text; the start of its last line may be in an earlier one."""
        at = 0
        if self.rest is not None and self.rest != b"":
            end = text.find(b"\n")
            if end < 0:
                self.rest = self.rest[:256] + text[:1]
                return
            at, self.rest = end + 1, b""
        if at >= len(text):
            return
        *whole, rest = text[at:].split(b"\n")
        begun = [*whole, *([rest] if rest else [])]
        self.rest = rest
        places = [place(x) for x in begun]
        self.entries.append((offset, at, self.lines, len(begun), *places[0], *places[-1]))
        self.lines += len(begun)

    def table(self) -> pa.Table:
        return pa.Table.from_pylist([dict(zip(INDEX.names, e)) for e in self.entries], schema=INDEX)


class _Part(WriterCommitMessage):
    def __init__(self, number: int, file: str, size: int, lines: int):
        self.number, self.file, self.size, self.lines = number, file, size, lines


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator[Any]) -> _Part:
        number, file, index, at = TaskContext.get().partitionId(), f"part-{uuid.uuid4().hex}.gz", _Indexer(), 0
        with open_output(f"{self.path}/{file}") as out:

            def put(text: bytes) -> None:
                nonlocal at
                for k in range(0, len(text), MEMBER):
                    some = text[k : k + MEMBER]
                    index.add(at, some)
                    at += out.write(member(some))

            held: list[bytes] = []
            size = 0
            for row in rows:
                line = (row[0] or "").encode() + b"\n"
                # members end with lines where lines are short
                if held and size + len(line) > MEMBER:
                    put(b"".join(held))
                    held, size = [], 0
                held.append(line)
                size += len(line)
            put(b"".join(held))
            at += out.write(END)
        with open_output(f"{self.path}/{file}.idx") as out:
            pq.write_table(index.table(), out)
        return _Part(number, file, at, index.lines)

    def commit(self, messages: list[_Part | None]) -> None:
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        with open_output(f"{self.path}/_parts.json") as out:
            out.write(json.dumps([[m.file, m.size, m.lines] for m in parts]).encode())


class _Slice(InputPartition):
    def __init__(self, file: str, low: int, high: int, line: int):
        self.file, self.low, self.high, self.line = file, low, high, line


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.step = options["path"], int(options.get("range_bytes", RANGE_BYTES))
        self.chr, self.low, self.high, self.header = None, None, None, False

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = getattr(f, "attribute", None)
            if name == ("chr",) and isinstance(f, EqualTo):
                self.chr = f.value
            elif name in (("chr",), ("pos",)) and isinstance(f, IsNull):
                self.header = True
            elif name == ("pos",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    self.low = max(f.value, self.low) if self.low is not None else f.value
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.high = min(f.value, self.high) if self.high is not None else f.value
            yield f  # members are coarse; Spark filters the lines

    def partitions(self) -> list[_Slice]:
        with open_input(f"{self.path}/_parts.json") as file:
            parts = json.loads(file.read())
        out, line = [], 0
        for name, size, lines in parts:
            out += [_Slice(f"{self.path}/{name}", a, min(a + self.step, size), line) for a in range(0, size, self.step)]
            line += lines
        return out

    def _wanted(self, e: dict) -> bool:
        told = e["chr"] is not None and e["last_chr"] is not None
        if self.header:
            return e["chr"] is None or e["last_chr"] is None
        if not told or e["chr"] != e["last_chr"]:
            # headers only, or several chromosomes: the latter may hold any
            asked = self.chr is not None or self.low is not None or self.high is not None
            return not (asked and e["chr"] is None and e["last_chr"] is None)
        if self.chr is not None and e["chr"] != self.chr:
            return False
        return not ((self.low is not None and e["last"] < self.low) or (self.high is not None and e["first"] > self.high))

    def read(self, part: _Slice) -> Iterator[pa.RecordBatch]:
        with open_input(f"{part.file}.idx") as file:
            entries = pq.read_table(file).to_pylist()
        ends = [(n["offset"], n["inside"]) for n in entries[1:]] + [(None, 0)]
        mine = [k for k, e in enumerate(entries) if part.low <= e["offset"] < part.high and self._wanted(e)]
        with open_input(part.file) as file:
            for run in np.split(mine, np.flatnonzero(np.diff(mine) != 1) + 1) if mine else []:
                first, (stop, inside) = entries[run[0]], ends[run[-1]]
                yield from self._lines(file, first["offset"], first["inside"], stop, inside, part.line + first["line"])

    def _lines(self, file: Any, offset: int, skip: int, stop: int | None, inside: int, number: int) -> Iterator[pa.RecordBatch]:
        """Lines from a place in one member to a place in another one, or the end."""
        held: list[bytes] = []
        size = 0
        for at, text in members(file, offset, stop if not inside else None):
            last = stop is not None and at == stop
            text = text[skip if at == offset else 0 : inside if last else None]
            held.append(text)
            size += len(text)
            if size >= 1 << 22 and b"\n" in text:
                whole, _, rest = b"".join(held).rpartition(b"\n")
                batch = self._batch(whole.split(b"\n"), number)
                number += batch.num_rows
                yield batch
                held, size = [rest], len(rest)
            if last:
                break
        lines = b"".join(held).split(b"\n")
        if lines[-1] == b"":
            lines.pop()
        if lines:
            yield self._batch(lines, number)

    @staticmethod
    def _batch(lines: list[bytes], number: int) -> pa.RecordBatch:
        places = [place(x) for x in lines]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(number, number + len(lines))), pa.array([p[0] for p in places], pa.string()), pa.array([p[1] for p in places], pa.int64()), pa.array(lines, pa.binary()).cast(pa.string())], names=["line", "chr", "pos", "value"])


def members(file: Any, offset: int, stop: int | None = None) -> Iterator[tuple[int, bytes]]:
    """Offset and text of the members from ``offset`` to ``stop`` or the end."""
    file.seek(offset)
    while stop is None or offset < stop:
        head = file.read(12)
        if not head:
            return
        require(head[:4] == HEAD[:4], f"no member of a block-gzip file at byte {offset}")
        extra, size, at = file.read(int.from_bytes(head[10:12], "little")), None, 0
        while at < len(extra):
            if extra[at : at + 2] == b"BC":
                size = int.from_bytes(extra[at + 4 : at + 6], "little") + 1
            at += 4 + int.from_bytes(extra[at + 2 : at + 4], "little")
        require(size is not None, f"the member at byte {offset} does not say its size")
        body = file.read(size - 12 - len(extra))
        text = zlib.decompress(body[:-8], -15)
        require(zlib.crc32(text) == int.from_bytes(body[-8:-4], "little"), f"the member at byte {offset} is damaged")
        yield offset, text
        offset += size


class BgzipLines(DataSource):
    """``format("bgzip_lines")``: line (number), chr, pos, value of each line;
    written from rows whose first column is the line."""

    @classmethod
    def name(cls) -> str:
        return "bgzip_lines"

    def schema(self) -> str:
        return "line long, chr string, pos long, value string"

    def reader(self, schema: Any) -> _Reader:
        return _Reader(dict(self.options))

    def writer(self, schema: Any, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def write_bgzip(df: DataFrame, column: str, order: str, path: str, parts: int | None = None) -> None:
    """Lines in order, a block-gzip file a range of them, to a new folder; tasks
    write their own files and indexes."""
    df.sparkSession.dataSource.register(BgzipLines)
    ranges = df.repartitionByRange(*([parts] if parts else []), order).sortWithinPartitions(order)
    ranges.select(F.col(column).alias("value")).write.format("bgzip_lines").mode("append").save(path)


def read_bgzip(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """line, chr, pos, value of the lines of a folder, in ranges of its members.
    Filters on chr and pos leave only the members that may hold such lines."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BgzipLines)
    return spark.read.format("bgzip_lines").option("range_bytes", range_bytes).load(path)


def index_files(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Index block-gzip files from elsewhere, a task a file, and list them in
    this order; then ``read_bgzip`` reads the folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column(0).to_pylist():
                index, size = _Indexer(), 0
                with open_input(f"{folder}/{name}") as file:
                    for at, text in members(file, 0):
                        index.add(at, text)
                    size = file.tell()
                with open_output(f"{folder}/{name}.idx") as out:
                    pq.write_table(index.table(), out)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size]), pa.array([index.lines])], names=["name", "size", "lines"])

    files = spark.createDataFrame([(n,) for n in names], "name string").repartition(len(names), "name")
    found = {r.name: [r.name, r.size, r.lines] for r in files.mapInArrow(run, "name string, size long, lines long").collect()}
    with open_output(f"{folder}/_parts.json") as out:
        out.write(json.dumps([found[n] for n in names]).encode())
