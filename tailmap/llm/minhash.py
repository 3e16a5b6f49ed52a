"""Near-duplicate groups by min-max hashing.

A document's set is its distinct word shingles as 64-bit hashes.  Under each permutation both the smallest and the largest
value are kept, so half as many hash evaluations give a signature of the same length; min and max agree between two documents
with probability equal to their similarity, and nearly independently of each other.  Bands of the signature are bucket keys.

What is compared, and how no group of rows is too large:

* Documents with one and the same set form a class; only classes go on, so exact copies make no pairs.
* A bucket links its classes through representatives: in each round every class that is not yet in one component with the
  bucket's representative is compared with it, and the representatives change from round to round.  A large group of near
  copies falls into one component after a round or two, by as many comparisons as it has members.
* Of the classes in buckets that then still hold several components, only the rarest shingles are looked at: two sets with
  links share one of their first n - ceil(PERCENT * n / 100) + 1 shingles in the order of rarity, whatever they are.  These
  shingles are the buckets of one more round with representatives, and then of all pairs that are still apart, so that no
  link is lost; what classes have in common with very many, such as a passage, comes last in that order and makes no pairs.
* A comparison counts the intersection of the full sets.

Defined results: null or wordless text has an empty set, n_shingles 0, and a component of its own; rows that repeat an id are
one document with several texts, all in one component; rows without an id have no component and are kept; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored
from .components import connected_components

#: Words of a shingle, permutations (two signature values each), values of a band, links need 100 * |A & B| >= PERCENT * |A | B|.
SHINGLE, PERMUTATIONS, BAND_ROWS, PERCENT = 5, 40, 4, 85
#: Rounds with one representative for each bucket before the rarest shingles of what is left are looked at.
STAR_ROUNDS = 3

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts, one after another, and the n + 1 offsets of the texts.

    Words are what ASCII white space separates, A-Z lower-cased; a text with fewer words than a shingle is one shingle.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = words.offsets.to_numpy().astype(np.int64)
    coded = words.values[offsets[0] : offsets[-1]].dictionary_encode() if len(words) else pa.array([], pa.string()).dictionary_encode()
    vocabulary = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    codes = coded.indices.to_numpy()
    filled = np.array([bool(w) for w in coded.dictionary.to_pylist()], dtype=bool)[codes] if len(codes) else np.zeros(0, dtype=bool)
    # Splitting leaves empty words at the ends of a text.
    kept = np.concatenate([[0], np.cumsum(filled)])
    offsets = kept[offsets - offsets[0]]
    h = vocabulary[codes[filled]] if len(codes) else np.zeros(0, dtype=np.uint64)
    rolled = np.zeros(max(0, len(h) - shingle + 1), dtype=np.uint64)
    factor = 1
    for j in range(shingle - 1, -1, -1):
        rolled += h[j : j + len(rolled)] * np.uint64(factor)
        factor = factor * int(_MIX) % (1 << 64)
    rolled = _mixed(rolled)
    sets, sizes = [], [0]
    for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if e - s >= shingle:
            one = np.unique(rolled[s : e - shingle + 1])
        elif e > s:
            one = np.array([xxhash.xxh3_64_intdigest(h[s:e].tobytes())], dtype=np.uint64)
        else:
            one = h[:0]
        sets.append(one)
        sizes.append(len(one))
    return np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64), np.cumsum(sizes)


def permutations(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of n permutations of the 64-bit values."""
    random = np.random.default_rng(seed)
    top = np.iinfo(np.uint64).max
    return random.integers(0, top, n, dtype=np.uint64, endpoint=True) | np.uint64(1), random.integers(0, top, n, dtype=np.uint64, endpoint=True)


def signatures(values: np.ndarray, offsets: np.ndarray, n: int = PERMUTATIONS) -> np.ndarray:
    """Min-max signatures of the sets that are not empty, 2 n values each: the minima, then the maxima, of each permutation."""
    starts = offsets[:-1][offsets[1:] > offsets[:-1]]
    out = np.zeros((len(starts), 2 * n), dtype=np.uint64)
    if len(starts):
        for k, (a, b) in enumerate(zip(*permutations(n), strict=True)):
            v = values * a + b
            out[:, 2 * k] = np.minimum.reduceat(v, starts)
            out[:, 2 * k + 1] = np.maximum.reduceat(v, starts)
    return out


def band_keys(signature: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` values; bands differ in their keys."""
    n = signature.shape[1] // rows
    keys = np.zeros((len(signature), n), dtype=np.uint64)
    for j in range(n):
        k = np.full(len(signature), j + 1, dtype=np.uint64)
        for r in range(rows):
            k = _mixed(k * _MIX + signature[:, j * rows + r])
        keys[:, j] = k
    return keys


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def _small(batches: Iterator[pa.RecordBatch], chars: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about so many bytes, whole rows each."""
    for b in batches:
        step = max(1, int(b.num_rows * chars / max(1, b.nbytes)))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def document_bands(docs: DataFrame, *, shingle: int = SHINGLE, permutations_: int = PERMUTATIONS, band_rows: int = BAND_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit hash of the set, null if empty), bands (array of bigint)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            values, offsets = shingle_sets(b.column(1), shingle)
            bands = band_keys(signatures(values, offsets, permutations_), band_rows)
            sizes = np.diff(offsets)
            keys = [xxhash.xxh3_128_digest(values[s:e].tobytes()) if e > s else None for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            counts = np.concatenate([[0], np.cumsum((sizes > 0) * bands.shape[1])])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), _lists(bands.ravel(), counts)], names=["doc_id", "n_shingles", "set_key", "bands"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_shingles long, set_key binary, bands array<bigint>")


def document_sets(docs: DataFrame, *, shingle: int = SHINGLE) -> DataFrame:
    """node and its set (array of bigint), of rows node, text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            values, offsets = shingle_sets(b.column(1), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(values, offsets)], names=["node", "hashes"])

    return docs.select("node", "text").mapInArrow(work, "node long, hashes array<bigint>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (u, v) whose full sets are similar enough; the set of u travels once a pair, that of v not at all."""
    of = lambda c: sets.select(F.col("node").alias(f"n_{c}"), F.col("hashes").alias(f"set_{c}"))
    both = pairs.join(of("u"), F.col("u") == F.col("n_u")).join(of("v"), F.col("v") == F.col("n_v"))
    n, m = F.size("set_u"), F.size("set_v")
    shared = F.size(F.array_intersect("set_u", "set_v"))
    # Sizes alone rule out many pairs: the intersection is no larger than the smaller set.
    return both.where((100 * F.least(n, m) >= percent * F.greatest(n, m))).where(100 * shared >= percent * (n + m - shared)).select("u", "v")


def prefix_buckets(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """node, bucket, n, left: of each node's set the first shingles in the order of rarity among these nodes that others hold too.

    left: how many shingles of the set, n in all, come in that order from this one on.
    """
    held = sets.join(nodes, "node", "left_semi").select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("bucket"))
    often = stored(held.groupBy("bucket").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1"), "holders")
    node = W.partitionBy("node")
    common = held.join(often, "bucket").withColumns({"place": F.row_number().over(node.orderBy("holders", "bucket")), "common": F.count(F.lit(1)).over(node)})
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    at = F.col("n") - F.col("common") + F.col("place")
    return stored(common.where(at <= first).select("node", "bucket", "n", (F.col("n") - at + 1).alias("left")), "prefix-buckets")


def _placed(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The rows of ``buckets`` with their nodes' components, stored."""
    if labels is None:
        return buckets.withColumn("component", F.col("node"))
    here = buckets.join(labels, "node", "left").select(*buckets.columns, F.coalesce("component", "node").alias("component"))
    return stored(here, "placed")


def _centres(here: DataFrame, turn: int) -> DataFrame:
    """bucket, rep, rep_component: this turn's representative of each bucket that holds several components.

    Stored, so that a join with it stands alone and its large buckets can be split.
    """
    order = F.struct(F.xxhash64("node", "bucket", F.lit(turn)), "node", "component")
    found = here.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min(order).alias("r"))
    return stored(found.where("lo < hi").select("bucket", F.col("r.node").alias("rep"), F.col("r.component").alias("rep_component")), "centres")


def _apart(here: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of a prefix bucket that are apart and can be linked.

    At the first shingle that two sets share, what they share is no more than what is left of either from there on.
    """
    other = here.select(F.col("node").alias("rep"), "bucket", F.col("component").alias("rep_component"), F.col("n").alias("rep_n"), F.col("left").alias("rep_left"))
    enough = (100 + percent) * F.least("left", "rep_left") >= percent * (F.col("n") + F.col("rep_n"))
    one, two = here.alias("one"), other.alias("two")
    return one.join(two, (F.col("one.bucket") == F.col("two.bucket")) & (F.col("component") < F.col("rep_component")) & enough).select("node", "rep")


def near_groups(
    docs: DataFrame,
    *,
    percent: int = PERCENT,
    shingle: int = SHINGLE,
    permutations_: int = PERMUTATIONS,
    band_rows: int = BAND_ROWS,
    star_rounds: int = STAR_ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable), kept."""
    rows = stored(document_bands(docs, shingle=shingle, permutations_=permutations_, band_rows=band_rows, id_col=id_col, text_col=text_col), "bands")
    named = rows.where("doc_id is not null and set_key is not null")
    classes = stored(named.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")), "classes")
    buckets = classes.select("node", F.explode("bands").alias("bucket"))
    shared = stored(buckets.groupBy("bucket").count().where("count > 1").select("bucket"), "shared-buckets")
    buckets = stored(buckets.join(shared, "bucket"), "buckets")
    wanted = buckets.select("node").distinct()
    # A class's set comes from the document that names it; the class key tells apart texts that repeat an id.
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    sets = stored(document_sets(texts.join(wanted, "node", "left_semi"), shingle=shingle), "sets")

    repeated = named.groupBy("doc_id").agg(F.count_distinct("set_key").alias("n")).where("n > 1").select("doc_id")
    versions = named.join(repeated, "doc_id").join(classes.select("set_key", "node"), "set_key").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    links, checked, labels = versions.where("u <> v"), None, None
    for turn in range(star_rounds + 2):
        here = _placed(buckets, labels)
        centres = _centres(here, turn)
        if turn == star_rounds:
            apart = stored(here.join(centres, "bucket").select("node").distinct(), "apart")
            buckets = prefix_buckets(sets, apart, percent)
            here = _placed(buckets, labels)
            centres = _centres(here, turn)
        if turn > star_rounds:
            pairs = _apart(stored(here.join(centres.select("bucket"), "bucket"), "open"), percent)
        else:
            pairs = here.join(centres, "bucket").where("component <> rep_component").select("node", "rep")
        pairs = pairs.select(F.least("node", "rep").alias("u"), F.greatest("node", "rep").alias("v")).distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["u", "v"], "left_anti")
        pairs = stored(pairs, "pairs")
        if turn and pairs.isEmpty():
            # Pairs that no representative is part of come last, whatever a round before found.
            continue
        links = links.union(stored(_linked(pairs, sets, percent), "links"))
        checked = pairs if checked is None else checked.union(pairs)
        labels = connected_components(links)
    groups = classes.join(labels, "node", "left").select(F.col("set_key").alias("k"), F.coalesce("component", "node").alias("of_class"))
    joined = rows.join(groups, F.col("set_key") == F.col("k"), "left").select("doc_id", "n_shingles", "of_class")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("of_class", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def dedup_near(docs: DataFrame, *, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group, with all their columns."""
    gone = near_groups(docs, percent=percent, id_col=id_col, text_col=text_col).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
