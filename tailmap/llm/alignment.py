"""Alignment of two tokenizers by a dictionary of groups.

A byte-level BPE (A) reads a space and the text; a SentencePiece model (B) reads the text and adds the space itself.  Byte
offsets at which tokens of both end cut a document into groups of A ids and B ids.  What two tokens share lies within a group
and depends on the ids of the group alone, so:

1. a task reads slices of about ``SLICE_CHARS`` characters.  Words that both tokenizers see on their own are solved once for a
   slice, or taken from a bounded cache; a document is left as codes of the slice's distinct groups and how often each occurs;
2. the slices' groups are summed to the corpus's dictionary of distinct groups, and links are expanded once for each of these;
3. a link's number of occurrences is the sum of the frequencies of its groups, and these numbers are summed up for each group;
4. groups go back to the slices that hold them by their key, one row for a group and slice however often it occurs there, and
   meet the documents' codes.  So no group of rows is larger than a slice, and the most frequent word is one row a slice.

Where a text may be cut, so that parts can be solved alone: between two pre-tokens of A, and only if no piece of B holds the
two characters that meet there.  A text with a character whose class may differ between libraries goes whole to A's library.

Defined results: a text that is null or empty, or whose joined A or B bytes are not those of the space and the text, has no
tokens: zeros and an empty string; it counts for nothing.  Repeated rows, repeated ids and null ids are documents of their own;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .pieces import Model
from .token_output import PLAIN

#: Characters of a slice, entries of a worker's caches, and the longest word that is kept there.
SLICE_CHARS, CACHE_ENTRIES, CACHE_CHARS = 8_000_000, 400_000, 64

CODED = "slice long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, codes array<int>, times array<int>, groups array<string>, freqs array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_ALIGNERS: dict[tuple[str, str], Aligner] = {}

#: A part of a text: a pre-token, or those that B may see together.
Part = str | tuple[str, ...]


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 is itself, the rest follows."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def groups_of(a: list[int], b: list[int], a_len: list[int], b_len: list[int], spelled: list[str]) -> list[str]:
    """The groups ``a1,a2|b1`` of ids whose bytes join to the same text."""
    if len(a) == len(b) == 1:
        return [f"{spelled[a[0]]}|{spelled[b[0]]}"]
    out, i, j, x, y, at_a, at_b, n = [], 0, 0, 0, 0, 0, 0, len(a)
    while i < n:
        # One token of each at least, then the side that is behind goes on.
        x += a_len[a[i]]
        y += b_len[b[j]]
        i += 1
        j += 1
        while x != y:
            if x < y:
                x += a_len[a[i]]
                i += 1
            else:
                y += b_len[b[j]]
                j += 1
        if i == at_a + 1 and j == at_b + 1:
            out.append(f"{spelled[a[at_a]]}|{spelled[b[at_b]]}")
        else:
            out.append(",".join([spelled[k] for k in a[at_a:i]]) + "|" + ",".join([spelled[k] for k in b[at_b:j]]))
        at_a, at_b = i, j
    return out


def links_of(group: str, a_len: list[int], b_len: list[int]) -> list[tuple[int, int]]:
    """All pairs of an A and a B token of a group whose byte ranges overlap; at most one fewer than it has tokens."""
    a, b = (list(map(int, side.split(","))) for side in group.split("|"))
    out, i, j, x, y = [], 0, 0, a_len[a[0]], b_len[b[0]]
    while True:
        out.append((a[i], b[j]))
        on_a, on_b = x <= y, y <= x
        if on_a:
            i += 1
        if on_b:
            j += 1
        if i == len(a) or j == len(b):
            return out
        if on_a:
            x += a_len[a[i]]
        if on_b:
            y += b_len[b[j]]


class Aligner:
    """Two tokenizers of a worker, and what it has solved."""

    def __init__(self, a_path: str, pattern: str, b_path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        self.a_bytes = [bytes(alphabet.get(c, 0) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.split, self.odd = regex.compile(pattern).findall, regex.compile(PLAIN).search
        self.a_len, self.b_len = [len(x) for x in self.a_bytes], [len(x) for x in self.b_bytes]
        self.spelled = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        pairs = Model.load(b_path).pairs
        # A character that no piece holds stands before parts without a space, so that none is added to them.
        self.before = len(self.b.encode("\n"))
        if any("\n" in p for p in pairs):
            raise ValueError("pieces hold line ends")
        letters = sorted({c for p in pairs for c in p})
        self.place, self.n = {c: k for k, c in enumerate(letters, 1)}, len(letters) + 1
        self.together = np.zeros(self.n * self.n, dtype=bool)
        for x, y in pairs:
            self.together[self.place[x] * self.n + self.place[y]] = True
        #: For a word the places of its first and last character; ids of a word; one copy of each group; what is known of a part.
        self.edges: dict[str, int] = {}
        self.words: dict[str, list[int]] = {}
        self.names: dict[str, str] = {}
        self.parts: dict[Part, tuple[int, int, tuple[str, ...]] | None] = {}

    def cut(self, text: str) -> list[Part]:
        """The parts of a space and the text."""
        words = self.split(" " + text)
        if len(self.edges) > CACHE_ENTRIES:
            self.edges.clear()
        for w in set(words).difference(self.edges):
            self.edges[w] = self.place.get(w[0], 0) << 32 | self.place.get(w[-1], 0)
        edges = np.fromiter(map(self.edges.__getitem__, words), dtype=np.int64, count=len(words))
        held = self.together[(edges[:-1] & 0xFFFFFFFF) * self.n + (edges[1:] >> 32)]
        if not held.any():
            return words
        ends = [*(np.flatnonzero(~held) + 1).tolist(), len(words)]
        out, at = [], 0
        for e in ends:
            out.append(words[at] if e == at + 1 else tuple(words[at:e]))
            at = e
        return out

    def _by_a(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(words, add_special_tokens=False)]

    def _by_b(self, texts: list[str]) -> list[list[int]]:
        # An empty text gets no space from B, so a space alone is told as parts without one are.
        plain = [t[1:] if t[0] == " " != t else "\n" + t for t in texts]
        return [ids if t[0] == " " != t else ids[self.before :] for t, ids in zip(texts, self.b.encode(plain, num_threads=1), strict=True)]

    def _told(self, text: str, a: list[int], b: list[int]) -> tuple[int, int, tuple[str, ...]] | None:
        """Numbers of tokens and groups of a part; None where the tokens' bytes are not the text's."""
        raw = text.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        same = self.names.setdefault
        return len(a), len(b), tuple([same(g, g) for g in groups_of(a, b, self.a_len, self.b_len, self.spelled)])

    def solve(self, wanted: set[Part]) -> dict[Part, tuple[int, int, tuple[str, ...]] | None]:
        """What ``_told`` says of these parts; short ones are kept."""
        for kept in (self.parts, self.words, self.names):
            if len(kept) > CACHE_ENTRIES:
                kept.clear()
        known = self.parts
        new = [p for p in wanted if p not in known]
        alone = [p for p in new if isinstance(p, str)]
        ids = dict(zip(alone, self._by_a(alone), strict=True)) if alone else {}
        joined = [p for p in new if not isinstance(p, str)]
        inside = {w for p in joined for w in p}
        words = list(inside.difference(self.words))
        extra = dict(zip(words, self._by_a(words), strict=True)) if words else {}
        within = {w: extra[w] if w in extra else self.words[w] for w in inside}
        self.words.update((w, x) for w, x in extra.items() if len(w) <= CACHE_CHARS)
        order, texts = alone + joined, alone + ["".join(p) for p in joined]
        out: dict[Part, tuple[int, int, tuple[str, ...]] | None] = {}
        for p, text, b in zip(order, texts, self._by_b(texts) if texts else [], strict=True):
            out[p] = self._told(text, ids[p] if p in ids else [i for w in p for i in within[w]], b)
            if len(text) <= CACHE_CHARS:
                known[p] = out[p]
        return {p: out[p] if p in out else known[p] for p in wanted}

    def whole(self, text: str) -> tuple[int, int, tuple[str, ...]] | None:
        """A text that is not cut."""
        return self._told(" " + text, self._by_a([" " + text])[0], self.b.encode(text))


def aligner(a_path: str, pattern: str, b_path: str) -> Aligner:
    """This worker's aligner for two files."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, pattern, b_path)
    return _ALIGNERS[a_path, b_path]


class _Slice:
    """The documents of a slice, coded by the slice's own dictionary of parts and of groups."""

    def __init__(self, solver: Aligner):
        self.solver, self.rows, self.chars = solver, [], 0
        self.code: dict[Part, int] = {}
        self.n_a, self.n_b, self.sizes, self.joined = [], [], [], []
        self.flat: list[int] = []
        self.group: dict[str, int] = {}

    def _add(self, part: Part, told: tuple[int, int, tuple[str, ...]] | None) -> int:
        self.n_a.append(told[0] if told else -1)
        self.n_b.append(told[1] if told else 0)
        names = told[2] if told else ()
        self.joined.append(";".join(names))
        self.sizes.append(len(names))
        self.flat.extend([self.group.setdefault(g, len(self.group)) for g in names])
        return len(self.sizes) - 1

    def add(self, doc_id: int | None, text: str) -> None:
        if not text:
            self.rows.append((doc_id, None, ""))
            return
        self.chars += len(text)
        if self.solver.odd(text):
            codes = np.array([self._add(text, self.solver.whole(text))])
        else:
            parts = self.solver.cut(text)
            new = set(parts).difference(self.code)
            if new:
                told = self.solver.solve(new)
                for p in new:
                    self.code[p] = self._add(p, told[p])
            codes = np.fromiter(map(self.code.__getitem__, parts), dtype=np.int64, count=len(parts))
        listed = codes.tolist()
        if min(map(self.n_a.__getitem__, listed)) < 0:
            self.rows.append((doc_id, None, ""))
            return
        # A part without a group does not exist: every part has a byte.
        digest = hashlib.sha256(";".join(map(self.joined.__getitem__, listed)).encode()).hexdigest()
        self.rows.append((doc_id, codes, digest))

    def batch(self, number: int) -> pa.RecordBatch:
        """A row for each document, and one with the slice's groups and how often they occur."""
        n_a, n_b, sizes = (np.array(x, dtype=np.int64) for x in (self.n_a, self.n_b, self.sizes))
        starts, flat = np.cumsum(sizes) - sizes, np.array(self.flat, dtype=np.int64)
        freqs, codes, times, tallies = np.zeros(len(self.group), dtype=np.int64), [], [], []
        for _, parts, _ in self.rows:
            if parts is None:
                codes.append(flat[:0])
                times.append(flat[:0])
                tallies.append((0, 0, 0))
                continue
            n = sizes[parts]
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            c, t = np.unique(flat[np.repeat(starts[parts], n) + within], return_counts=True)
            freqs[c] += t
            codes.append(c)
            times.append(t)
            tallies.append((int(n_a[parts].sum()), int(n_b[parts].sum()), int(n.sum())))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(c) for c in codes])]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([flat[:0], *x]).astype(np.int32))) for x in (codes, times)]
        used = freqs > 0  # groups of documents that have no tokens after all
        names, k = np.array(list(self.group), dtype=object), len(self.rows)
        columns = [
            pa.array([number] * (k + 1), pa.int64()),
            pa.array([r[0] for r in self.rows] + [None], pa.int64()),
            *[pa.array([t[j] for t in tallies] + [None], pa.int64()) for j in range(3)],
            pa.array([r[2] for r in self.rows] + [None], pa.string()),
            *[pa.concat_arrays([x, pa.nulls(1, x.type)]) for x in lists],
            pa.array([None] * k + [[g if u else None for g, u in zip(names.tolist(), used.tolist(), strict=True)]], pa.list_(pa.string())),
            pa.array([None] * k + [freqs.tolist()], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in CODED.split(", ")])


def coded_documents(docs: DataFrame, a_path: str, pattern: str, b_path: str, *, slice_chars: int = SLICE_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``CODED``: for each document its numbers and codes, and for each slice its groups and their frequencies."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver, number = aligner(a_path, pattern, b_path), TaskContext.get().partitionId() << 32
        part = _Slice(solver)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                few = b.slice(at, 256)
                for i, t in zip(few.column(0).to_pylist(), few.column(1).to_pylist(), strict=True):
                    part.add(i, t or "")
                    if part.chars >= slice_chars:
                        yield part.batch(number)
                        part, number = _Slice(solver), number + 1
        if part.rows:
            yield part.batch(number)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, CODED)


def slice_groups(coded: DataFrame) -> DataFrame:
    """slice, code, group, freq: one row for a slice and a group that it holds."""
    held = coded.where("groups is not null").select("slice", F.posexplode(F.arrays_zip("groups", "freqs")).alias("code", "g"))
    return held.where("g.groups is not null").select("slice", "code", F.col("g.groups").alias("group"), F.col("g.freqs").alias("freq"))


def group_links(groups: DataFrame, a_path: str, pattern: str, b_path: str) -> DataFrame:
    """group, freq, a, b, times: the links of each distinct group, those of equal ids as one row."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = aligner(a_path, pattern, b_path)
        for b in batches:
            rows = []
            for group, freq in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                times: dict[tuple[int, int], int] = {}
                for link in links_of(group, solver.a_len, solver.b_len):
                    times[link] = times.get(link, 0) + 1
                rows += [(group, freq, x, y, n) for (x, y), n in times.items()]
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["group", "freq", "a", "b", "times"])

    return groups.select("group", "freq").mapInArrow(expand, "group string, freq long, a int, b int, times long")


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, count, best: how many links of the corpus hold a pair of ids, and whether that is the most of its B id."""
    pairs = stored(links.groupBy("a", "b").agg(F.sum(F.col("freq") * F.col("times")).alias("count")), "pairs")
    most = pairs.groupBy("b").agg(F.max("count").alias("most"))
    return pairs.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def _meet(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
    """The documents of a slice with the sums of their groups' numbers."""
    n = (pc.max(told["code"]).as_py() if told.num_rows else -1) + 1
    places = told["code"].to_numpy()
    codes, times = docs["codes"].combine_chunks(), docs["times"].combine_chunks()
    sizes = pc.list_value_length(codes).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    flat, often = codes.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    sums = []
    for name in ("n_links", "n_best", "count_sum"):
        of_group = np.zeros(n, dtype=np.int64)
        of_group[places] = told[name].to_numpy()
        total = np.zeros(len(sizes), dtype=np.int64)
        # Whole numbers: a float's 53 bits would not hold the largest sums.
        np.add.at(total, owner, of_group[flat] * often)
        sums.append(pa.array(total))
    return pa.table({"doc_id": docs["doc_id"], "n_a": docs["n_a"], "n_b": docs["n_b"], "n_groups": docs["n_groups"], **dict(zip(("n_links", "n_best", "count_sum"), sums, strict=True)), "groups_sha256": docs["groups_sha256"]})


def align(docs: DataFrame, a_path: str, pattern: str, b_path: str, *, slice_chars: int = SLICE_CHARS, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: a row for each document (``RESULT``), the dictionary of groups (group, freq), and ``pair_counts``."""
    coded = stored(coded_documents(docs, a_path, pattern, b_path, slice_chars=slice_chars, id_col=id_col, text_col=text_col), "coded")
    held = slice_groups(coded)
    groups = stored(held.groupBy("group").agg(F.sum("freq").alias("freq")), "groups")
    links = stored(group_links(groups, a_path, pattern, b_path), "links")
    pairs = stored(pair_counts(links), "pair-counts")
    told = links.join(pairs, ["a", "b"]).groupBy("group").agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    back = held.join(stored(told, "told"), "group").select(F.col("slice").alias("of_slice"), "code", "n_links", "n_best", "count_sum")
    rows = coded.where("groups is null").drop("groups", "freqs")
    return rows.groupBy("slice").cogroup(back.groupBy("of_slice")).applyInArrow(_meet, RESULT), groups, pairs
