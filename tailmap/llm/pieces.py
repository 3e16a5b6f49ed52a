"""SentencePiece encoding and decoding by a relational lattice.

Texts are cut where no piece can reach across: between two characters that no piece holds next to each other.  So what is
left to solve are short segments, few of which are new.  Every distinct segment of the corpus is solved once:

1. its substrings, up to the length of the longest piece, are exploded and equi-joined to the piece table, which is as small
   as the vocabulary; a match is an edge of the segment's lattice;
2. edges are grouped by segment (the explosion keeps the partitioning, so this costs no shuffle);
3. a higher-order ``aggregate`` folds the edges to the path.

The fold depends on the model.  For unigram models it is Viterbi's: the best sum of scores at every position.  A BPE model
merges instead: the best-ranked edge that joins two neighbours of the current path, the leftmost of equals, is taken until
none is left, and the positions that are still borders are a bit mask.  One pass over the edges in their order does that
unless a merge makes a better edge possible than itself; only edges marked late can be such, the pass looks at these after
every merge, and the segments where it happens start from the best edge again after every merge.  Viterbi's path over a BPE
model's ranks is another one than the library's, so ``encode`` takes the fold from its caller.  Segments with more characters
than a mask has bits are solved by a worker with the rule of the fold.

Segments that are frequent, ``COMMON`` at most, go to the workers as a broadcast; each of the others goes by a shuffle to the
buckets of documents that hold it, and meets them there.  A bucket holds about ``BUCKET_BYTES`` of text.

Defined results: a null text is encoded as an empty one, to no id; characters without a piece become their UTF-8 bytes'
pieces, or the unknown piece where the model has none; texts of any length are encoded whole; repeated rows and null ids get
a row each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

SPACE = "▁"
#: Most frequent segments that are broadcast, text of a bucket, characters of a segment that the fold takes.
COMMON, BUCKET_BYTES, FOLD_CHARS = 300_000, 8 << 20, 60
#: Distinct segments that a worker keeps before it passes them on, by a factor of a few.
CACHE = 100_000

#: An edge as one number: rank, start (6 bits), length (6 bits), whether it is late (1 bit), id (20 bits).
_ID_BITS, _LEN_BITS = 21, 6
_LATE = 1 << 20
_NONE = _LATE - 1


@dataclass(frozen=True)
class Model:
    """The pieces of a SentencePiece model: text (with spaces for the space mark), id and score of the normal ones, ids of the
    256 bytes (or none), unknown id, characters that stand together in a piece, and the most characters of one."""

    pieces: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...]
    unknown: int
    pairs: frozenset[str] = field(repr=False)
    longest: int

    @staticmethod
    def of(pieces: list[tuple[str, int, float]], byte_ids: list[int] = (), unknown: int = 0) -> Model:
        pieces = [(p.replace(SPACE, " "), i, s) for p, i, s in pieces]
        pairs = frozenset(p[i : i + 2] for p, _, _ in pieces for i in range(len(p) - 1))
        return Model(tuple(pieces), tuple(byte_ids), unknown, pairs, max((len(p) for p, _, _ in pieces), default=1))

    @staticmethod
    def load(path: str) -> Model:
        """From a model file whose normaliser keeps characters as they are; others raise an error."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " Ａﬁ①  á \t x "
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model's normaliser changes characters")
        ids = range(sp.get_piece_size())
        normal = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        return Model.of([(sp.id_to_piece(i), i, sp.get_score(i)) for i in normal], [i for i in ids if sp.is_byte(i)], sp.unk_id())

    @property
    def unknown_score(self) -> float:
        """What a character without a piece adds to a path: 10 less than the worst piece."""
        return min((s for _, _, s in self.pieces), default=0.0) - 10.0

    def ranks(self) -> dict[str, tuple[int, int]]:
        """rank (0 is the best score; equal scores share one) and id of every piece."""
        place = {s: r for r, s in enumerate(sorted({s for _, _, s in self.pieces}, reverse=True))}
        return {p: (place[s], i) for p, i, s in self.pieces}

    def late(self) -> set[str]:
        """Pieces that do not rank behind both parts of every way to join them: a merge may make a better one possible."""
        ranks = self.ranks()
        place = lambda p: ranks[p][0] if p in ranks and len(p) > 1 else (-1 if len(p) == 1 else None)
        out = set()
        for p, (rank, _) in ranks.items():
            for i in range(1, len(p)):
                a, b = place(p[:i]), place(p[i:])
                if a is not None and b is not None and max(a, b) >= rank:
                    out.add(p)
        return out

    def fallback(self, char: str) -> list[int]:
        """Ids of a character without a piece."""
        return [self.byte_ids[b] for b in char.encode("utf-8", "replace")] if self.byte_ids else [self.unknown]

    def table(self, spark: SparkSession) -> DataFrame:
        """piece, id, rank, late, score: as many rows as the vocabulary has."""
        if len(self.pieces) >= _NONE:
            raise ValueError("the vocabulary is too large for an edge's bits")
        ranks, late = self.ranks(), self.late()
        return spark.createDataFrame([(p, i, ranks[p][0], p in late, s) for p, i, s in self.pieces], "piece string, id int, rank int, late boolean, score double")


class Cutter:
    """Cuts texts between characters that no piece holds next to each other; spaces stand for the space mark."""

    def __init__(self, pairs: frozenset[str]):
        letters = sorted({c for p in pairs for c in p})
        self.place = np.zeros(0x110000, dtype=np.uint16)
        self.place[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.n = len(letters) + 1
        self.together = np.zeros(self.n * self.n, dtype=bool)
        for x, y in pairs:
            self.together[int(self.place[ord(x)]) * self.n + int(self.place[ord(y)])] = True

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All segments of texts (none is null), one after another, and the n + 1 places of the texts among them."""
        texts = pc.replace_substring(texts, SPACE, " ")
        texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(" ", texts, ""))
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1, offset=4 * texts.offset)
        raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        codes = self.place[np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)].astype(np.int32)
        begins = np.flatnonzero((raw & 0xC0) != 0x80)  # bytes at which characters begin
        starts = np.ones(len(codes), dtype=bool)
        if len(codes):
            starts[1:] = ~self.together[codes[:-1] * self.n + codes[1:]]
        edges = offsets.astype(np.int64) - offsets[0]
        inside = edges[edges < len(raw)]
        starts[np.searchsorted(begins, inside)] = True
        at = begins[starts]
        ends = np.append(at, len(raw)).astype(np.int32)
        segments = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes()))
        return segments, np.searchsorted(at, edges)


def merged(segment: str, model: Model, ranks: dict[str, tuple[int, int]]) -> list[int]:
    """Ids of a long segment: its best-ranked neighbours merged, the leftmost of equals first."""
    n = len(segment)
    after, before, end, alive = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(a: int) -> None:
        b = after[a]
        if b < n and end[b] - a <= model.longest and (r := ranks.get(segment[a : end[b]])) is not None:
            heapq.heappush(heap, (r[0], a, end[b]))

    for a in range(n - 1):
        offer(a)
    while heap:
        _, a, e = heapq.heappop(heap)
        b = after[a] if alive[a] else n
        if b >= n or end[b] != e:
            continue
        alive[b], end[a], after[a] = False, e, after[b]
        if after[a] < n:
            before[after[a]] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    out: list[int] = []
    a = 0
    while a < n:
        known = ranks.get(segment[a : end[a]])
        out += [known[1]] if known else model.fallback(segment[a])
        a = after[a]
    return out


def lattice(segments: DataFrame, table: DataFrame, *, unknown_score: float | None = None) -> DataFrame:
    """seg, n, edges (array of bigint in the order of rank, then start), of rows seg, n with distinct segments.

    Every character has an edge, with the id ``_NONE`` where it has no piece.  With ``unknown_score``, that of a character
    without a piece, edges are structs of edge and score.
    """
    size, start = F.length("seg"), F.col("s")
    at = segments.select("seg", "n", F.explode(F.sequence(F.lit(1), size)).alias("s"))
    # No piece that begins with these three characters is longer than ``reach``; other pieces are shorter than three.
    reach = table.where("length(piece) > 2").groupBy(F.substring("piece", 1, 3).alias("head")).agg(F.max(F.length("piece")).alias("reach"))
    at = at.join(F.broadcast(reach), F.expr("substring(seg, s, 3)") == F.col("head"), "left")
    parts = at.select("seg", "n", "s", F.explode(F.sequence(F.lit(1), F.least(F.coalesce("reach", F.lit(2)), size - start + 1))).alias("len"))
    parts = parts.select("seg", "n", "s", "len", F.expr("substring(seg, s, len)").alias("part"))
    # The table is the vocabulary, whatever the corpus: Model.table checks its size.
    found = parts.join(F.broadcast(table), F.col("part") == F.col("piece"), "left").where("id is not null or len = 1")
    rank = F.coalesce("rank", F.lit(0)).cast("long")
    edge = F.shiftleft(rank, 2 * _LEN_BITS + _ID_BITS).bitwiseOR(F.shiftleft((F.col("s") - 1).cast("long"), _LEN_BITS + _ID_BITS))
    edge = edge.bitwiseOR(F.shiftleft(F.col("len").cast("long"), _ID_BITS)).bitwiseOR(F.coalesce("id", F.lit(_NONE)).cast("long"))
    edge = edge.bitwiseOR(F.when(F.col("late"), F.lit(_LATE)).otherwise(F.lit(0)).cast("long"))
    if unknown_score is not None:
        edge = F.struct(edge.alias("edge"), F.coalesce("score", F.lit(unknown_score)).alias("score"))
    return found.select("seg", "n", edge.alias("edge")).groupBy("seg", "n").agg(F.sort_array(F.collect_list("edge")).alias("edges"))


def _parts(edge: str) -> tuple[str, str, str]:
    """SQL of an edge's start, length and id."""
    return f"cast(shiftright({edge}, {_LEN_BITS + _ID_BITS}) & {(1 << _LEN_BITS) - 1} as int)", f"cast(shiftright({edge}, {_ID_BITS}) & {(1 << _LEN_BITS) - 1} as int)", f"cast({edge} & {_NONE} as int)"


def _spelled(tokens: str, model: Model) -> Column:
    """Ids of edges in the order of their starts, with the bytes of what has no piece."""
    start, _, number = _parts("t")
    if model.byte_ids:
        text = f"hex(encode(substring(seg, {start} + 1, 1), 'UTF-8'))"
        other = f"transform(sequence(0, length({text}) div 2 - 1), i -> array({', '.join(map(str, model.byte_ids))})[cast(conv(substring({text}, 2 * i + 1, 2), 16, 10) as int)])"
    else:
        other = f"array({model.unknown})"
    return F.expr(f"flatten(transform({tokens}, t -> if({number} = {_NONE}, {other}, array({number}))))")


def fold_merges(edges: DataFrame, model: Model) -> DataFrame:
    """seg, n, ids of a BPE model: the best edge that joins two neighbours is taken until there is none."""
    start, size, _ = _parts("e")
    borders = f"shiftleft(1L, {start}) | shiftleft(1L, {start} + {size})"
    inner = f"(shiftleft(1L, {start} + {size}) - 1) & ~(shiftleft(2L, {start}) - 1)"
    shaped = f"transform(edges, e -> named_struct('edge', e, 'ends', {borders}, 'inner', {inner}))"
    rows = edges.select("seg", "n", F.expr(shaped).alias("all"))
    rows = rows.select("*", F.expr("filter(all, x -> x.inner <> 0)").alias("long"))
    rows = rows.withColumn("late", F.expr(f"filter(long, x -> (x.edge & {_LATE}) <> 0)"))
    joins = lambda x, mask: f"(({mask}) & {x}.ends) = {x}.ends and bit_count(({mask}) & {x}.inner) = 1"
    better = f"exists(late, y -> y.edge < x.edge and {joins('y', 'mask & ~x.inner')})"
    once = f"aggregate(long, shiftleft(1L, length(seg) + 1) - 1, (mask, x) -> if(mask > 0 and {joins('x', 'mask')}, if({better}, -1L, mask & ~x.inner), mask))"
    rows = rows.withColumn("once", F.expr(once))
    # The edges come best first: the first that fits a mask is the one to take.
    taken = "aggregate(long, 0L, (done, x) -> if(done = 0 and (mask & x.ends) = x.ends and bit_count(mask & x.inner) = 1, x.inner, done))"
    mask = f"aggregate(sequence(1, greatest(length(seg) - 1, 1)), shiftleft(1L, length(seg) + 1) - 1, (mask, i) -> mask & ~{taken})"
    rows = rows.select("seg", "n", "all", F.expr(f"if(once > 0, once, {mask})").alias("mask"))
    path = "filter(all, x -> (mask & x.ends) = x.ends and (mask & x.inner) = 0)"
    # Without its rank an edge sorts by its start.
    tokens = f"array_sort(transform({path}, x -> x.edge & {(1 << (2 * _LEN_BITS + _ID_BITS)) - 1}))"
    return rows.select("seg", "n", F.expr(tokens).alias("tokens")).select("seg", "n", _spelled("tokens", model).alias("ids"))


def fold_viterbi(edges: DataFrame, model: Model) -> DataFrame:
    """seg, n, ids of a unigram model, of edges with scores: the path with the largest sum; see ``Model.unknown_score``.

    Of equal sums the path whose last piece is longest is taken, at every position.
    """
    start, size, _ = _parts("e.edge")
    rows = edges.select("seg", "n", F.expr(f"transform(edges, e -> named_struct('edge', e.edge, 's', {start}, 'end', {start} + {size}, 'score', e.score))").alias("all"))
    zero = "named_struct('sum', 0D, 'back', 0, 'edge', 0L)"
    options = "transform(filter(all, x -> x.end = j), x -> named_struct('sum', best[x.s].sum + x.score, 'back', -x.s, 'edge', x.edge))"
    best = f"aggregate(sequence(1, length(seg)), array({zero}), (best, j) -> concat(best, array(array_max({options}))))"
    rows = rows.select("seg", "n", F.expr(best).alias("best"))
    back = "aggregate(sequence(1, length(seg)), named_struct('at', length(seg), 'path', cast(array() as array<bigint>)), (p, i) -> if(p.at = 0, p, named_struct('at', -best[p.at].back, 'path', concat(array(best[p.at].edge), p.path))), p -> p.path)"
    return rows.select("seg", "n", F.expr(back).alias("tokens")).select("seg", "n", _spelled("tokens", model).alias("ids"))


def best_path(segment: str, model: Model, scores: dict[str, tuple[float, int]]) -> list[int]:
    """Ids of a long segment by the rule of ``fold_viterbi``."""
    best, unknown = [(0.0, 0)], model.unknown_score
    for end in range(1, len(segment) + 1):
        options = []
        for start in range(max(0, end - model.longest), end):
            known = scores.get(segment[start:end])
            if known or end - start == 1:
                options.append((best[start][0] + (known[0] if known else unknown), -start))
        best.append(max(options))
    out: list[list[int]] = []
    end = len(segment)
    while end:
        start = -best[end][1]
        known = scores.get(segment[start:end])
        out.append([known[1]] if known else model.fallback(segment[start]))
        end = start
    return [i for ids in reversed(out) for i in ids]


def _slices(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about so many bytes, whole rows each."""
    for b in batches:
        step = max(1, int(b.num_rows * size / max(1, b.nbytes)))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def _summed(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("seg", use_threads=False).aggregate([("n", "sum")]).rename_columns(["seg", "n"])


def segment_counts(docs: DataFrame, model: Model) -> DataFrame:
    """seg, n: segments with how often they occur, counted for each task; the row without a segment has the bytes of text."""
    pairs = model.pairs

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, size = Cutter(pairs), 0
        kept = [pa.table({"seg": pa.array([], pa.string()), "n": pa.array([], pa.int64())})]
        for b in _slices(batches):
            texts = pc.fill_null(b.column(0), "")
            size += pc.sum(pc.binary_length(texts)).as_py() or 0
            coded = cutter(texts)[0].dictionary_encode()
            kept.append(pa.table({"seg": coded.dictionary, "n": np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))}))
            if sum(t.num_rows for t in kept) > 2 * CACHE:
                kept = [_summed(kept)]
                pa.default_memory_pool().release_unused()
                if kept[0].num_rows > CACHE:
                    yield from kept.pop().to_batches()
        if kept:
            yield from _summed(kept).to_batches()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([size], pa.int64())], names=["seg", "n"])

    return docs.select("text").mapInArrow(count, "seg string, n long")


def lexicon(docs: DataFrame, model: Model, *, fold: str = "merge") -> tuple[DataFrame, int]:
    """seg, n, ids of every distinct segment of the rows text, stored; and the bytes of text."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = segment_counts(docs, model).repartition(parts, "seg").groupBy("seg").agg(F.sum("n").alias("n"))
    counts = stored(counts, "segments")
    size = counts.where("seg is null").select("n").first()  # one number
    short = counts.where("seg is not null").where(F.length("seg") <= FOLD_CHARS).repartition(parts, "seg")
    table = model.table(spark)
    if fold == "merge":
        solved = fold_merges(lattice(short, table), model)
    else:
        solved = fold_viterbi(lattice(short, table, unknown_score=model.unknown_score), model)

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, scores = model.ranks(), {p: (s, i) for p, i, s in model.pieces}
        for b in batches:
            ids = [merged(s, model, ranks) if fold == "merge" else best_path(s, model, scores) for s in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.list_(pa.int32()))], names=["seg", "n", "ids"])

    rest = counts.where("seg is not null").where(F.length("seg") > FOLD_CHARS)
    return stored(solved.union(rest.select("seg", "n").mapInArrow(long, "seg string, n long, ids array<int>")), "lexicon"), size.n if size else 0


def common_from(lexicon_: DataFrame, most: int = COMMON) -> int:
    """The least count with which a segment is common, so that at most ``most`` are; steps of an eighth of a doubling."""
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = lexicon_.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("segments"), F.min("n").alias("least")).collect()  # at most 8 * 63 rows
    total, least = 0, 1 << 62
    for r in sorted(steps, key=lambda r: -r.step):
        total += r.segments
        if total > most:
            break
        least = r.least
    return least


def _as_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def _column(table: pa.Table, name: str, kind: pa.DataType) -> pa.Array:
    """A column as one array."""
    column = table.column(name).cast(kind)
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], kind)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, ids of documents, their sizes and texts: a compressed row for each bucket of a batch."""
    press = zstandard.ZstdCompressor(level=6)
    for b in _slices(batches, 16 << 20):
        by: dict[int, tuple[list, list[bytes]]] = {}
        for k, i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), pc.fill_null(b.column(2), "").cast(pa.binary()).to_pylist(), strict=True):
            ids, texts = by.setdefault(k, ([], []))
            ids.append(i)
            texts.append(t)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(by), pa.int32()), pa.array([ids for ids, _ in by.values()], pa.list_(pa.int64())), pa.array([list(map(len, t)) for _, t in by.values()], pa.list_(pa.int64())), pa.array([press.compress(b"".join(t)) for _, t in by.values()], pa.binary())],
            names=["bucket", "doc_ids", "sizes", "packed"],
        )


def encode(docs: DataFrame, model: Model, *, fold: str = "merge", decoded: bool = False, common: int = COMMON, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int), one row per document; with ``decoded`` also decoded_crc32, of the text the ids stand for."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lex, size = lexicon(rows, model, fold=fold)
    least = common_from(lex, common)
    # ``common`` segments at most.
    shared = spark.sparkContext.broadcast(_as_bytes(lex.where(F.col("n") >= least).select("seg", "ids").toArrow()))
    buckets = max(spark.sparkContext.defaultParallelism, -(-size // bucket_bytes))
    dealt = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int").alias("bucket"), "doc_id", "text")
    pairs = model.pairs

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, known = Cutter(pairs), _column(_from_bytes(shared.value), "seg", pa.string())
        kept: list[pa.Table] = []

        def out() -> Iterator[pa.RecordBatch]:
            if kept:
                yield from pa.concat_tables(kept).group_by(["bucket", "r_seg"], use_threads=False).aggregate([]).select(["bucket", "r_seg"]).to_batches()
                kept.clear()

        for b in _slices(batches):
            segments, ends = cutter(pc.fill_null(b.column(1), ""))
            coded = segments.dictionary_encode()
            strange = pc.invert(pc.is_in(coded.dictionary, value_set=known)).to_numpy(zero_copy_only=False)
            codes = coded.indices.to_numpy()
            at = np.flatnonzero(strange[codes])
            bucket = np.repeat(b.column(0).to_numpy(zero_copy_only=False), np.diff(ends))[at]
            both = np.unique(bucket.astype(np.int64) << 32 | codes[at])
            kept.append(pa.table({"bucket": pa.array((both >> 32).astype(np.int32)), "r_seg": coded.dictionary.take(pa.array(both & 0xFFFFFFFF))}))
            if sum(t.num_rows for t in kept) > 2 * CACHE:
                yield from out()
        yield from out()

    wanted = dealt.select("bucket", "text").mapInArrow(rare, "bucket int, r_seg string")
    needed = wanted.join(lex.where(F.col("n") < least).select("seg", "ids"), F.col("r_seg") == F.col("seg")).select("bucket", "seg", "ids")
    packed = dealt.mapInArrow(_packed, "bucket int, doc_ids array<bigint>, sizes array<bigint>, packed binary")
    found = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))] + [("decoded_crc32", pa.int64())] * decoded)
    texts_of = decoder(model) if decoded else None

    def meet(texts: pa.Table, segments: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return found.empty_table()
        common_, cutter, unpack = _from_bytes(shared.value), Cutter(pairs), zstandard.ZstdDecompressor()
        known, more = _column(common_, "seg", pa.string()), _column(segments, "seg", pa.string())
        spelled = pa.concat_arrays([_column(common_, "ids", found.field("ids").type), _column(segments, "ids", found.field("ids").type)])
        out, waiting, held = [], ([], [], []), 0
        left = texts.num_rows
        for ids, sizes, data in zip(texts.column("doc_ids").to_pylist(), texts.column("sizes").to_pylist(), texts.column("packed").to_pylist(), strict=True):
            waiting[0].extend(ids), waiting[1].extend(sizes), waiting[2].append(unpack.decompress(data))
            held, left = held + sum(sizes), left - 1
            if left and held < 1 << 20:
                continue
            (ids, sizes, data), waiting, held = waiting, ([], [], []), 0
            ends = np.cumsum([0, *sizes]).astype(np.int32)
            cut_, at = cutter(pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends.tobytes()), pa.py_buffer(b"".join(data))))
            coded = cut_.dictionary_encode()
            place = pc.coalesce(pc.index_in(coded.dictionary, value_set=known), pc.add(pc.index_in(coded.dictionary, value_set=more), pa.scalar(len(known), pa.int32())))
            lists = spelled.take(place.take(coded.indices))
            begins = lists.offsets.to_numpy()[at]
            columns = [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(begins, pa.int32()), lists.values)]
            if decoded:
                columns.append(pa.array([zlib.crc32(t) for t in texts_of(columns[1]).cast(pa.binary()).to_pylist()], pa.int64()))
            out.append(pa.RecordBatch.from_arrays(columns, schema=found))
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches(out, found)

    return packed.groupBy("bucket").cogroup(needed.groupBy("bucket")).applyInArrow(meet, "doc_id long, ids array<int>" + ", decoded_crc32 long" * decoded)


def decoder(model: Model) -> Callable[[pa.Array], pa.Array]:
    """A function that gives the texts of lists of ids, some at a time."""
    spelled = {i: p.encode() for p, i, _ in model.pieces} | {i: bytes([b]) for b, i in enumerate(model.byte_ids)}
    top = max(spelled, default=-1) + 1
    table = pa.array([spelled.get(i, b"") for i in range(top + 1)], pa.binary())

    def some(ids: pa.Array) -> pa.Array:
        flat = pc.fill_null(ids.flatten(), top).to_numpy(zero_copy_only=False)
        flat = np.where((flat < 0) | (flat > top), top, flat)
        parts = table.take(pa.array(flat))
        sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
        ends = np.frombuffer(parts.buffers()[1], dtype=np.int32, count=len(parts) + 1)[sizes]
        joined = pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends.tobytes()), parts.buffers()[2]])
        try:
            text = joined.cast(pa.string())
        except pa.ArrowInvalid:
            text = pa.array([b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())
        text = pc.if_else(pc.starts_with(text, " "), pc.utf8_slice_codeunits(text, 1), text)
        return pc.if_else(ids.is_valid(), text, pa.scalar(None, pa.string()))

    def texts(ids: pa.Array) -> pa.Array:
        # In parts of about so many ids.
        step = max(1, int(len(ids) * 500_000 / max(1, len(ids.flatten()))))
        parts = [some(ids.slice(at, step)) for at in range(0, len(ids), step)]
        pa.default_memory_pool().release_unused()
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return texts


def decode(rows: DataFrame, model: Model, *, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``rows`` with the text of an array of ids; a column of that name is replaced.

    Null ids give null; what is no UTF-8 becomes U+FFFD; null or unknown ids in an array give nothing.
    """
    texts = decoder(model)
    return rows.withColumn(out_col, F.arrow_udf(lambda ids: texts(ids), "string")(F.col(ids_col)))


def encode_decode(docs: DataFrame, model: Model, **options: object) -> DataFrame:
    """doc_id, ids, n_tokens, decoded_crc32 (of the text that the ids are decoded to, in UTF-8).

    The worker that has encoded a slice of documents decodes their ids before it takes the next.
    """
    rows = encode(docs, model, decoded=True, **options)
    return rows.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded_crc32")
