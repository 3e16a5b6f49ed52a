"""Token ids as sorted-string-table shards, written and read by executors.

Documents are range-partitioned and sorted by id; each task encodes its documents and writes one shard through
``pyarrow.fs``, under a name of its own attempt that a move makes final, so a task that runs again leaves one whole shard.  A
manifest row a shard is all that reaches the driver.

Encoding follows the library: a pre-token is encoded once and its ids are kept in a bounded cache of the worker.  Texts in
which the split into pre-tokens could differ from the library's (a character outside ``PLAIN``, or a special token spelled
out) are given to the library whole.

Defined results: a null text is empty and gives the end id alone; null ids come before all others; repeated ids are separate
entries in the order of a hash of their texts, also where they are parted over shards; an empty table gives no shard and no row.
"""

from __future__ import annotations

import bisect
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sstable
from .common import shared_dir

#: Characters whose class (letter, number, space, other) is the same in all versions of Unicode that matter here.
PLAIN = r"[^\t\n\r\x20-\x7e¡-ȳЀ-џА-я‐-‧ぁ-ゖァ-ヺ一-龥가-힣]"
#: Which of these are letters and numbers, as ranges.
CLASSES = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ȳЀ-џぁ-ゖァ-ヺ一-龥가-힣", r"\p{N}": "0-9²³¹¼-¾"}
#: Entries of a worker's cache of pre-tokens, and the longest pre-token that is kept.
CACHE_ENTRIES, CACHE_CHARS = 800_000, 32

MANIFEST = "shard int, path string, first_id long, last_id long, n_docs long, n_ids long, n_bytes long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"

_ENCODERS: dict[str, Encoder] = {}


def plain_split(pattern: str) -> Callable[[str], list[str]]:
    """A pattern's pre-tokens of texts without a character outside ``PLAIN``.

    There classes are ranges, which Python's own engine splits by in about half the time; it is not given what it may read
    in another way.
    """
    import regex

    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.DOTALL):
        ranges = CLASSES.get(part)
        out.append(part if ranges is None else ranges if inside else f"[{ranges}]")
        inside = part == "[" or (inside and part != "]")
    try:
        return regex.compile(pattern).findall if re.search(r"\\[wWbB]|\(\?[a-zA-Z<]|&&|--|\|\||~~|\[\[", pattern) else re.compile("".join(out)).findall
    except re.error:
        return regex.compile(pattern).findall


class Encoder:
    """Texts to packed ids with a tokenizers file, by cached pre-tokens."""

    def __init__(self, tokenizer_path: str, pattern: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.split, self.odd = plain_split(pattern), re.compile(PLAIN).search
        with open(tokenizer_path) as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        self.cache: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], at_once: int = 4096) -> list[bytes]:
        """Packed ids of pre-tokens, many in one call of the library, cut where its ids go to the next one."""
        out: list[bytes] = []
        for at in range(0, len(words), at_once):
            part = words[at : at + at_once]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ends = np.flatnonzero(np.diff(np.array(found.word_ids))) + 1
            packed, ends = np.array(found.ids, dtype=self.dtype).tobytes(), [0, *(ends * self.dtype.itemsize).tolist(), len(found.ids) * self.dtype.itemsize]
            # A file that has no ids for some pre-token leaves it out.
            out += [packed[a:b] for a, b in pairwise(ends)] if len(ends) == len(part) + 1 else self._library(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        out: list[bytes | None] = [None] * len(texts)
        split: list[tuple[int, list[str]]] = []
        whole: list[int] = []
        for i, text in enumerate(texts):
            if self.odd(text) or any(s in text for s in self.special):
                whole.append(i)
            else:
                split.append((i, self.split(text)))
        words = set().union(*[w for _, w in split])
        if len(self.cache) > CACHE_ENTRIES:
            # What these texts hold stays, so that frequent pre-tokens are not encoded anew.
            self.cache = {w: self.cache[w] for w in words if w in self.cache}
        fresh = list(words.difference(self.cache))
        self.cache.update(zip(fresh, self._words(fresh), strict=True))
        for i, w in split:
            out[i] = b"".join(map(self.cache.__getitem__, w))
        for w in fresh:
            if len(w) > CACHE_CHARS:
                del self.cache[w]
        for i, b in zip(whole, self._library([texts[i] for i in whole]) if whole else [], strict=True):
            out[i] = b
        return out


def encoder(tokenizer_path: str, pattern: str) -> Encoder:
    """This worker's encoder for a file."""
    if tokenizer_path not in _ENCODERS:
        _ENCODERS[tokenizer_path] = Encoder(tokenizer_path, pattern)
    return _ENCODERS[tokenizer_path]


def _pieces(batches: Iterator[pa.RecordBatch], chars: int = 4_000_000) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, in lists of about so many characters."""
    ids, texts, n = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ids.append(i)
            texts.append(t or "")
            n += len(texts[-1])
            if n >= chars:
                yield ids, texts
                ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_shards(
    docs: DataFrame, folder: str, tokenizer_path: str, pattern: str, *, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write all documents as shards under ``folder`` (a URI that pyarrow.fs opens); returns the manifest, one row a shard."""
    run = uuid.uuid4().hex[:12]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileType

        task = TaskContext.get()
        part = task.partitionId()
        made = writer = out = None
        first = last = None
        filesystem, root = _filesystem(folder)
        mine, final = f"{root}/.{part:05d}-{task.taskAttemptId()}", f"{root}/shard-{part:05d}-{run}.sst"
        enc = encoder(tokenizer_path, pattern)
        end = b"" if end_id is None else np.array([end_id], dtype=enc.dtype).tobytes()
        for ids, texts in _pieces(batches):
            if writer is None:
                filesystem.create_dir(root, recursive=True)
                out = filesystem.open_output_stream(mine)
                writer, first = sstable.Writer(out, enc.dtype.itemsize), ids[0]
            for i, packed in zip(ids, enc.encode(texts), strict=True):
                writer.add(sstable.key_of(i), packed + end)
            last = ids[-1]
        if writer is not None:
            writer.close()
            out.close()
            # A move onto a name that exists is an error in some file systems; what an earlier attempt of this task left is the same.
            if filesystem.get_file_info(final).type == FileType.NotFound:
                filesystem.move(mine, final)
            else:
                filesystem.delete_file(mine)
            made = [[part], [final], [first], [last], [len(writer.keys)], [writer.n_ids], [writer.at]]
            types = [pa.int32(), pa.string(), *[pa.int64()] * 5]
            names = [x.split()[0] for x in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, types, strict=True)], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The second key parts the rows of one id, should it have very many.
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    spark = docs.sparkSession
    shards = dealt.mapInArrow(write, MANIFEST).collect()  # one short row a shard
    return spark.createDataFrame(sorted(shards), MANIFEST)


def _scan(manifest: DataFrame, folder: str, schema: str, take: Callable) -> DataFrame:
    """Run ``take(reader, shard's row, ids before it)``, which gives record batches, with a task for each shard."""
    spark: SparkSession = manifest.sparkSession
    rows = sorted(manifest.collect(), key=lambda r: r.shard)
    before = np.concatenate([[0], np.cumsum([r.n_ids for r in rows], dtype=np.int64)]).tolist()
    shards = [(r.path, n) for r, n in zip(rows, before, strict=False)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(folder)
        for b in batches:
            for k in b.column(0).to_pylist():
                path, n = shards[k]
                with filesystem.open_input_file(path) as f:
                    yield from take(sstable.Reader(f, f.size()), n)

    return spark.range(0, len(shards), 1, max(1, len(shards))).mapInArrow(read, schema)


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document, read from the shards."""

    def take(reader: sstable.Reader, start: int) -> Iterator[pa.RecordBatch]:
        dtype = np.dtype(f"<u{reader.id_bytes}")
        for i in range(len(reader.index)):
            out: list[tuple] = []
            for key, value in reader.block(i):
                ids = np.frombuffer(value, dtype=dtype)
                out.append((sstable.id_of(key), start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                start += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _scan(manifest, folder, RESULT, take)


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id and its ids (array of int), with the end id, of every document, in shard order."""

    def take(reader: sstable.Reader, start: int) -> Iterator[pa.RecordBatch]:
        dtype = np.dtype(f"<u{reader.id_bytes}")
        for i in range(len(reader.index)):
            keys, values = zip(*reader.block(i), strict=True)
            ids = pa.array([np.frombuffer(v, dtype=dtype).astype(np.int32) for v in values], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([sstable.id_of(k) for k in keys], pa.int64()), ids], names=["doc_id", "ids"])

    return _scan(manifest, folder, "doc_id long, ids array<int>", take)


def lookup(manifest: DataFrame, folder: str, wanted: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """doc_id and ids of the wanted documents by binary-search lookup, a row for each entry of an id.

    An id, also the null one, is dealt to all shards whose range of keys holds it; what the shards lack gives no row.
    """
    shards = sorted(manifest.select("shard", "path", "first_id", "last_id").collect(), key=lambda r: r.shard)  # one short row a shard
    paths, first, last = [r.path for r in shards], [sstable.key_of(r.first_id) for r in shards], [sstable.key_of(r.last_id) for r in shards]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, places = [], []
            for i in b.column(0).to_pylist():
                key = sstable.key_of(i)
                here = range(bisect.bisect_left(last, key), bisect.bisect_right(first, key))
                ids += [i] * len(here)
                places += here
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(ids, pa.int64())], names=["place", "doc_id"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(folder)
        place = file = reader = None
        for b in batches:
            keys, values = [], []
            for p, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if p != place:
                    if file is not None:
                        file.close()
                    place, file = p, filesystem.open_input_file(paths[p])
                    reader = sstable.Reader(file, file.size())
                for v in reader.get(sstable.key_of(i)):
                    keys.append(i)
                    values.append(np.frombuffer(v, dtype=f"<u{reader.id_bytes}").astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    pairs = wanted.select(F.col(id_col).cast("long").alias("doc_id")).distinct().mapInArrow(deal, "place int, doc_id long")
    # The second key parts what one shard is asked for.
    dealt = pairs.repartition("place", F.floor(F.col("doc_id") / 4096)).sortWithinPartitions("place", "doc_id")
    return dealt.mapInArrow(find, "doc_id long, ids array<int>")


def token_digests(docs: DataFrame, tokenizer_path: str, pattern: str, *, folder: str | None = None) -> DataFrame:
    """Write the shards of all documents and return what reading them gives."""
    folder = folder or f"{shared_dir(docs.sparkSession)}/token-shards-{uuid.uuid4().hex}"
    return read_digests(write_shards(docs, folder, tokenizer_path, pattern), folder)
