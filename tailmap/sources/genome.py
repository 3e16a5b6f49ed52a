"""A genome's sequences as chunks, from FASTA files that are read in byte ranges: no row is as long as a chromosome.

A data source gives the letters of each range as fragments, numbered by the record within the range; record 0 is what goes on
from the range before.  How many letters of a record stand in the ranges before comes from a running sum over the first and
last records of the ranges, two rows for each; then fragments are cut at the borders of chunks and put together by chunk.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tailmap.operators.lineage import stored

#: Bytes of a range, and letters of a fragment.
RANGE, FRAGMENT = 32 << 20, 1 << 16

FRAGMENTS = "file string, range int, record long, id string, at long, text string"


class FastaRange(InputPartition):
    """Bytes from ``begin`` to ``end`` of a file; a gzipped file is one range."""

    def __init__(self, path: str, number: int, begin: int, end: int):
        super().__init__((path, number, begin, end))
        self.path, self.number, self.begin, self.end = path, number, begin, end


def _opened(path: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return system.open_input_file(name)


def _lines(part: FastaRange, block: int) -> Iterator[tuple[bytes, bool]]:
    """Pieces of the lines that a range holds, at most ``block`` bytes long, and whether a piece begins a line.

    A header belongs to the range in which it begins, whole; other lines are cut wherever a range ends.
    """
    with _opened(part.path) as raw:
        packed = part.path.endswith(".gz")
        file = gzip.GzipFile(fileobj=raw) if packed else raw
        at, starts, header = 0, True, b""
        if not packed:
            if part.begin:
                raw.seek(part.begin - 1)
                starts = raw.read(1) in (b"\n", b"\r")
                # In the middle of a line: whether it is a header shows at its beginning.
                at = part.begin
                if not starts and _in_header(raw, part.begin):
                    rest = b""
                    raw.seek(part.begin)
                    while b"\n" not in rest:
                        more = raw.read(4096)
                        if not more:
                            return
                        rest, at = more, at + len(more)
                    at -= len(rest) - rest.index(b"\n") - 1
                    starts = True
            raw.seek(at)
        while packed or at < part.end:
            data = file.read(block if packed else min(block, part.end - at))
            if not data:
                break
            at += len(data)
            for piece in data.splitlines(keepends=True):
                if header or (starts and piece.startswith(b">")):
                    header += piece
                    if piece.endswith((b"\n", b"\r")):
                        yield header, True
                        header, starts = b"", True
                    continue
                yield piece, starts
                starts = piece.endswith((b"\n", b"\r"))
        if header:
            # The header goes on behind the range's end.
            while b"\n" not in header and (more := file.read(4096)):
                header += more
            yield header.split(b"\n", 1)[0], True


def _in_header(raw, at: int, step: int = 4096) -> bool:
    """Whether the line that the byte before ``at`` is in begins with a header's mark."""
    while at > 0:
        low = max(0, at - step)
        raw.seek(low)
        data = raw.read(at - low)
        if b"\n" in data:
            line = data[data.rindex(b"\n") + 1 :]
            return line.startswith(b">") if line else raw.read(1) == b">"
        if low == 0:
            return data.startswith(b">")
        at = low
    return False


class FastaReader(DataSourceReader):
    """The fragments of the ranges of some files."""

    def __init__(self, files: list[tuple[str, int]], step: int, fragment: int):
        self.files, self.step, self.fragment = files, step, fragment

    def partitions(self) -> list[FastaRange]:
        """Ranges of ``step`` bytes."""
        return [FastaRange(path, k, k * self.step, min(size, (k + 1) * self.step)) for path, size in self.files for k in range(1 if path.endswith(".gz") else -(-size // self.step))]

    def read(self, partition: FastaRange) -> Iterator[pa.RecordBatch]:
        """Fragments in order; a record without letters has an empty one."""
        record, name, at, parts, held, rows = 0, None, 0, [], 0, []

        def end() -> None:
            nonlocal at, parts, held
            text = b"".join(parts).decode()
            if text or (record and not at):
                rows.append((partition.path, partition.number, record, name, at, text))
            at, parts, held = at + len(text), [], 0

        def batch() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string())
            out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=[c.split()[0] for c in FRAGMENTS.split(", ")])
            rows.clear()
            return out

        for piece, starts in _lines(partition, self.fragment):
            if starts and piece.startswith(b">"):
                end()
                record, name, at = record + 1, piece[1:].decode().strip(), 0
            else:
                piece = b"".join(piece.split())
                while held + len(piece) >= self.fragment:
                    cut = self.fragment - held
                    parts.append(piece[:cut])
                    piece = piece[cut:]
                    end()
                parts.append(piece)
                held += len(piece)
            if len(rows) >= 16:
                yield batch()
        end()
        yield batch()


class FastaSource(DataSource):
    """``fasta_ranges``: options ``files`` (path and size, one a line), ``step`` and ``fragment``."""

    @classmethod
    def name(cls) -> str:
        """The name to read it by."""
        return "fasta_ranges"

    def schema(self) -> str:
        """The columns of fragments."""
        return FRAGMENTS

    def reader(self, schema: object) -> FastaReader:
        """A reader of the files that the options name."""
        files = [line.rsplit("\t", 1) for line in self.options["files"].split("\n") if line]
        return FastaReader([(path, int(size)) for path, size in files], int(self.options["step"]), int(self.options["fragment"]))


def read_genome(spark: SparkSession, path: str, *, size: int = 65_536, overlap: int = 256, trim: str = r"\s", step: int = RANGE, fragment: int = FRAGMENT) -> DataFrame:
    """chr, chunk, part of FASTA files: what ``chunked`` gives of ``read_fasta``, without a row that is longer than a chunk.

    chr is a header up to white space, or to what ``trim`` matches.  Letters before the first header of a file go; records
    without letters have no chunk.  The files' names and sizes reach the driver.
    """
    spark.dataSource.register(FastaSource)
    files = sorted((r.path, r.length) for r in spark.read.format("binaryFile").load(path).select("path", "length").collect() if r.length)
    found = spark.read.format("fasta_ranges").options(files="\n".join(f"{p}\t{n}" for p, n in files), step=str(step), fragment=str(fragment)).load()
    found = stored(found, "fragments")
    whole = found.groupBy("file", "range", "record").agg(F.max("id").alias("id"), F.sum(F.length("text")).alias("n"))
    ends = whole.withColumn("last", F.max("record").over(W.partitionBy("file", "range"))).where("record = 0 or record = last")
    line = W.partitionBy("file").orderBy("range", "record")
    ends = ends.withColumn("name", F.last("id", ignorenulls=True).over(line)).withColumn("which", F.count("id").over(line))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file", "which").orderBy("range", "record").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ends = ends.withColumn("before", before).where("record = 0").select(F.col("file").alias("f"), F.col("range").alias("r"), "name", "before")
    known = found.join(ends, (F.col("file") == F.col("f")) & (F.col("range") == F.col("r")) & (F.col("record") == 0), "left")
    header, begin = F.coalesce("id", "name"), F.col("at") + F.coalesce("before", F.lit(0))
    rows = known.where(header.isNotNull() & (F.length("text") > 0)).select(F.regexp_extract(header, rf"^((?:(?!{trim}).)*)", 1).alias("chr"), begin.alias("begin"), "text")
    # A fragment belongs to the chunks that it lies in, and to the one before these where it is in the overlap.
    first = F.greatest(F.floor((F.col("begin") - overlap) / size), F.lit(0))
    cut = rows.withColumn("chunk", F.explode(F.sequence(first, F.floor((F.col("begin") + F.length("text") - 1) / size))))
    low, high = F.col("chunk") * size, (F.col("chunk") + 1) * size + overlap
    start, stop = F.greatest("begin", low), F.least(F.col("begin") + F.length("text"), high)
    piece = F.struct(start.alias("start"), F.substring("text", (start - F.col("begin") + 1).cast("int"), (stop - start).cast("int")).alias("text"))
    pieces = cut.where(start < stop).groupBy("chr", F.col("chunk").cast("int").alias("chunk")).agg(F.sort_array(F.collect_list(piece)).alias("pieces"), F.min(start).alias("least"))
    # What lies in the overlap alone is no chunk of its own.
    return pieces.where(F.col("least") == F.col("chunk").cast("long") * size).select("chr", "chunk", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("part"))
