"""N-gram Jaccard join by a forest of count-vector R-trees.

A document's set is its distinct word shingles as 64-bit hashes.  Tokens of a set are hashed into groups, and the numbers of
tokens in each group are the set's point: of two sets, the sum over the groups of the smaller count is at least as large as
their intersection, so pairs whose sum is too small for a link are ruled out without their sets.  What is left is verified on
the full sets.

Roots.  Points of unrelated texts lie about equally far apart, so that boxes over all points would rule out little.  What two
linked sets of n and m tokens do not share is at most (100 - PERCENT) / (100 + PERCENT) * (n + m) tokens.  With more groups
than that, they have a whole group in common, token for token.  So the number of groups follows the size of the sets (a
*class* of sizes; sets near its lower end appear in the class below as well), and the trees' roots are the keys (class, group,
hash of the tokens in the group): no link is outside a root.  A group holds about ten tokens, so what very many documents have
in common, as a line or a passage, fills no group by itself and makes no root.  Groups without a token are roots only for sets
which have so many of these that all common groups may be among them.

A root whose documents are those of another root adds nothing and goes.  A point counts tokens in four times as many groups as
there are roots, so that it hides little of what two sets do not share.

Inside a root points are packed by size into leaves of ``LEAF`` points, and leaves into branches of ``FAN``.  A box is the
largest count of each group and the range of sizes.  A pair of branches, then of leaves, is opened where the boxes' summed
minima are enough for a link of the smallest sizes; the points of two leaves are compared in arrays of LEAF x LEAF.  Points
within a leaf are compared as it is packed, and a root that is one leaf, as most are, has no more to do.

Groups of copies.  Sets that are equal are one class of documents.  First each root's points are compared with one of
them, which is the same for all roots where that can be, in rounds; what is by then in one component is compared no more.  Trees
are packed only over the roots that still hold several components.

Defined results: null or wordless text has an empty set, n_shingles 0, and a component of its own; rows that repeat an id are
one document with several texts, all in one component; rows without an id have no component; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored
from .components import connected_components
from .minhash import _linked, _lists, _mixed, _placed, _small, document_sets, shingle_sets

#: Words of a shingle; links need 100 * |A & B| >= PERCENT * |A | B|.
SHINGLE, PERCENT = 3, 90
#: Sizes of a class: from one bound to half as many again.  Groups of a point for each root.
GROWTH, FINER = 1.5, 4
#: Points of a leaf, leaves of a branch, and rounds with one point for each root.
LEAF, FAN, STAR_ROUNDS = 128, 32, 4

PACKED = "u long, v long, root long, leaf long, branch long, n_lo long, n_hi long, c_lo long, c_hi long, box binary, nodes array<bigint>, sizes array<bigint>, components array<bigint>, counts binary"
PACKED_SCHEMA = pa.schema([(c, {"long": pa.int64(), "binary": pa.binary()}.get(kind, pa.list_(pa.int64()))) for c, kind in (x.split() for x in PACKED.split(", "))])


def apart_at_most(n: int, m: int, percent: int) -> int:
    """The most tokens that linked sets of n and m tokens do not share."""
    return (100 - percent) * (n + m) // (100 + percent)


def size_classes(largest: int, percent: int) -> list[tuple[int, int, int, int]]:
    """For each class its sizes (from, to), its number of groups, and how many of these linked sets share at least.

    As many classes as sets up to ``largest`` are in.  Smaller sets than the first class has are linked with equal sets only.
    """
    low = next(n for n in range(1, 10_000) if apart_at_most(n, 100 * n // percent, percent))
    out = []
    while percent * low <= 100 * largest:
        high = max(low, int(low * GROWTH))
        differ = apart_at_most(high, high, percent)
        spare = 2 + differ // 32
        out.append((low, high, differ + spare, spare))
        low = high + 1
    return out


def classes_of(n: int, classes: list[tuple[int, int, int, int]], percent: int) -> list[int]:
    """The classes that a set of n tokens is in: that of its size, and those above whose smallest sets can be linked with it."""
    return [k for k, (low, high, _, _) in enumerate(classes) if n <= high and 100 * n >= percent * low]


def group_bounds(values: np.ndarray, groups: int) -> np.ndarray:
    """Where each group begins in a sorted set, and its end: a group is a range of hashes."""
    edges = (np.arange(1, groups, dtype=np.float64) * (2.0**64 / groups)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])


def roots_of(values: np.ndarray, k: int, groups: int, spare: int) -> np.ndarray:
    """Keys of (class, group, tokens of the group) of a sorted set; the lowest byte is the class."""
    bounds = group_bounds(values, groups)
    filled = np.diff(bounds) > 0
    sums = np.zeros(groups, dtype=np.uint64)
    # The sum of mixed hashes stands for a group's tokens; equal keys of other tokens only cost a comparison.
    sums[filled] = np.add.reduceat(_mixed(values ^ np.uint64(0x5851F42D4C957F2D)), bounds[:-1][filled])
    keys = _mixed(sums ^ _mixed(np.arange(1, groups + 1, dtype=np.uint64))) & ~np.uint64(0xFF) | np.uint64(k)
    return keys if (~filled).sum() >= spare else keys[filled]


def packed_counts(counts: np.ndarray) -> bytes:
    """A point as bytes, an even number of counts: the bits of a count, then four bits each where all are below 16, as nearly all points are."""
    most = int(counts.max(initial=0))
    if most < 16:
        low, high = np.split(counts.astype(np.uint8), 2)
        return b"\4" + (low | high << 4).tobytes()
    return b"\x08" + counts.astype(np.uint8).tobytes() if most < 256 else b"\x10" + counts.astype("<u2").tobytes()


def counts_of(packed: bytes) -> np.ndarray:
    """The counts that ``packed_counts`` was given."""
    if packed[0] == 16:
        return np.frombuffer(packed, "<u2", offset=1)
    values = np.frombuffer(packed, np.uint8, offset=1)
    return (values if packed[0] == 8 else np.concatenate([values & 15, values >> 4])).astype(np.uint16)


def document_roots(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit hash of the set, null if empty), roots (array of bigint)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            values, offsets = shingle_sets(b.column(1), shingle)
            sizes = np.diff(offsets)
            classes, none = size_classes(int(sizes.max(initial=0)), percent), np.zeros(0, dtype=np.uint64)
            flat, keys = [], []
            for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                one = values[s:e]
                keys.append(xxhash.xxh3_128_digest(one.tobytes()) if e > s else None)
                flat.append(np.concatenate([none, *[roots_of(one, k, *classes[k][2:]) for k in classes_of(e - s, classes, percent)]]))
            ends = np.concatenate([[0], np.cumsum([len(r) for r in flat])])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), _lists(np.concatenate([none, *flat]), ends)], names=["doc_id", "n_shingles", "set_key", "roots"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_shingles long, set_key binary, roots array<bigint>")


def set_points(sets: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """node, n, own (the class of its size), points: the packed counts in its own class and those above it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            sizes, own, points = [], [], []
            for values in b.column(1):
                hashes = values.values.to_numpy().view(np.uint64)
                classes = size_classes(len(hashes), percent)
                inside = classes_of(len(hashes), classes, percent)
                sizes.append(len(hashes))
                own.append(inside[0] if inside else None)
                points.append([packed_counts(np.diff(group_bounds(hashes, FINER * classes[k][2]))) for k in inside])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(own, pa.int32()), pa.array(points, pa.list_(pa.binary()))], names=["node", "n", "own", "points"])

    return sets.select("node", "hashes").mapInArrow(work, "node long, n long, own int, points array<binary>")


def enough(shared, n, m, percent: int):
    """Whether sets of n and m tokens can be linked if they share no more than so many."""
    return (100 + percent) * shared >= percent * (n + m)


def in_pairs(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those rows of ``nodes`` whose node is in a pair (u, v): a round has few pairs, and the others need not travel to meet them."""
    ends = stored(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "pair-ends")
    return nodes.join(ends, "node", "left_semi")


def bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Those pairs (u, v) whose points' summed minima are enough for a link."""
    of = lambda c: points.select(*[F.col(x).alias(f"{x}_{c}") for x in ("node", "n", "own", "points")])
    both = pairs.join(of("u"), F.col("u") == F.col("node_u")).join(of("v"), F.col("v") == F.col("node_v"))
    cls = F.greatest("own_u", "own_v")
    # Sizes alone rule out many pairs.
    near = both.where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
    rows = near.select("u", "v", "n_u", "n_v", *[F.get(f"points_{c}", cls - F.col(f"own_{c}")).alias(f"point_{c}") for c in "uv"])
    # A row that repeats an id with another text may be in other classes; then so is the row that has the root.
    rows = rows.where("point_u is not null and point_v is not null")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = b.column(2).to_numpy(), b.column(3).to_numpy()
            shared = [int(np.minimum(counts_of(x), counts_of(y)).sum(dtype=np.int64)) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)]
            yield b.select([0, 1]).filter(pa.array(enough(np.array(shared, dtype=np.int64), n, m, percent)))

    return rows.mapInArrow(work, "u long, v long")


def _minima(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.minimum(x, y).sum(axis=-1, dtype=np.int64)


class _Packer:
    """Leaves and branches of the roots of one partition, whose points come in order, and the pairs within leaves."""

    def __init__(self, part: int, percent: int, size: int):
        self.size, self.percent, self.leaf, self.branch = size, percent, part << 33, part << 33
        self.root, self.points, self.rows, self.pairs = None, [], [], []
        #: Whether the root may have more than one leaf; the leaf that is kept until that is known; what its branch is so far.
        self.many, self.kept, self.over, self.first = False, None, [], True

    def add(self, root: int, point: tuple) -> None:
        if root != self.root:
            self._end_root()
            # A partition's first root may have begun in the one before.
            self.root, self.many, self.first = root, self.first, False
        self.points.append(point)
        if len(self.points) == self.size:
            self._end_leaf()

    def _end_leaf(self) -> None:
        if not self.points:
            return
        n, node, component = (np.array([p[k] for p in self.points], dtype=np.int64) for k in range(3))
        counts = np.stack([counts_of(p[3]) for p in self.points])
        self.points = []
        for i in range(len(n) - 1):
            good = np.flatnonzero(enough(_minima(counts[i], counts[i + 1 :]), n[i], n[i + 1 :], self.percent) & (component[i] != component[i + 1 :])) + i + 1
            if len(good):
                self.pairs.append((np.minimum(node[i], node[good]), np.maximum(node[i], node[good])))
        span = {"n_lo": int(n.min()), "n_hi": int(n.max()), "c_lo": int(component.min()), "c_hi": int(component.max())}
        leaf = {"root": self.root, **span, "box": counts.max(axis=0), "nodes": node.tolist(), "sizes": n.tolist(), "components": component.tolist(), "counts": counts.tobytes()}
        if self.kept is not None:
            self.many = True
            self._put(self.kept)
            self.kept = None
        if self.many:
            self._put(leaf)
        else:
            self.kept = leaf

    def _put(self, leaf: dict) -> None:
        self.leaf += 1
        self.rows.append(leaf | {"leaf": self.leaf, "branch": self.branch, "box": leaf["box"].tobytes()})
        self.over.append(leaf)
        if len(self.over) == FAN:
            self._end_branch()

    def _end_branch(self) -> None:
        if self.over:
            span = {k: (min if k.endswith("lo") else max)(x[k] for x in self.over) for k in ("n_lo", "n_hi", "c_lo", "c_hi")}
            self.rows.append({"root": self.root, "branch": self.branch, **span, "box": np.max([x["box"] for x in self.over], axis=0).tobytes()})
            self.over, self.branch = [], self.branch + 1

    def _end_root(self, last: bool = False) -> None:
        self._end_leaf()
        if last and self.kept is not None:
            self._put(self.kept)
        self.kept = None
        self._end_branch()

    def taken(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """What there is by now; with ``last`` all of it."""
        if last:
            self._end_root(last=True)
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, schema=PACKED_SCHEMA)
        if self.pairs:
            ends = [pa.array(np.concatenate([p[k] for p in self.pairs])) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*ends, *[pa.nulls(len(ends[0]), f.type) for f in list(PACKED_SCHEMA)[2:]]], schema=PACKED_SCHEMA)
        self.rows, self.pairs = [], []


def packed(here: DataFrame, points: DataFrame, percent: int, leaf: int = LEAF) -> DataFrame:
    """Rows of ``PACKED``: pairs u, v within leaves; leaves with their points and branches, of roots that may have several leaves.

    here: root, node, component.  A leaf has neighbours in the order of root and size; a root of any size is spread over tasks.
    """
    cls = F.col("root").bitwiseAND(F.lit(0xFF)).cast("int")
    rows = here.join(points, "node").select("root", "n", "node", "component", F.get("points", cls - F.col("own")).alias("point")).where("point is not null")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId(), percent, leaf)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                root, *point = (c.to_pylist() for c in b.slice(at, 1024).columns)
                for r, *p in zip(root, *point, strict=True):
                    packer.add(r, p)
                yield from packer.taken()
        yield from packer.taken(last=True)

    return stored(rows.repartitionByRange("root", "n", "node").sortWithinPartitions("root", "n", "node").mapInArrow(work, PACKED), "packed")


def meeting(boxes: DataFrame, id_: str, percent: int, above: DataFrame | None = None) -> DataFrame:
    """root, x, y: pairs of boxes of a root, in the order of size, that may hold points which can be linked.

    above: root, x, y of the branches that meet; without it all boxes of a root are looked at.  A branch meets itself too.
    """
    of = lambda c: boxes.select(F.col("root").alias(f"root_{c}"), F.col(id_).alias(c), *[F.col(k).alias(f"{k}_{c}") for k in ("branch", "n_lo", "n_hi", "c_lo", "c_hi", "box")])
    one, two = of("x"), of("y")
    apart = (F.col("c_lo_x") < F.col("c_hi_y")) | (F.col("c_lo_y") < F.col("c_hi_x"))
    can = (F.col("x") <= F.col("y") if id_ == "branch" else F.col("x") < F.col("y")) & (100 * F.col("n_hi_x") >= percent * F.col("n_lo_y")) & apart
    if above is None:
        both = one.join(two, (F.col("root_x") == F.col("root_y")) & can)
    else:
        known = above.select("root", F.col("x").alias("bx"), F.col("y").alias("by"))
        both = known.join(one, (F.col("root") == F.col("root_x")) & (F.col("bx") == F.col("branch_x"))).join(two, (F.col("root") == F.col("root_y")) & (F.col("by") == F.col("branch_y")) & can)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shared = [int(np.minimum(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)).sum(dtype=np.int64)) for x, y in zip(b.column(5).to_pylist(), b.column(6).to_pylist(), strict=True)]
            yield b.select([0, 1, 2]).filter(pa.array(enough(np.array(shared, dtype=np.int64), b.column(3).to_numpy(), b.column(4).to_numpy(), percent)))

    return both.select(F.col("root_x").alias("root"), "x", "y", "n_lo_x", "n_lo_y", "box_x", "box_y").mapInArrow(work, "root long, x long, y long")


def tree_pairs(here: DataFrame, points: DataFrame, percent: int, leaf: int = LEAF) -> DataFrame:
    """u, v: pairs of nodes of a root, in different components, whose points' summed minima are enough for a link."""
    all_ = packed(here, points, percent, leaf)
    within, leaves, branches = all_.where("u is not null").select("u", "v"), all_.where("nodes is not null"), all_.where("leaf is null and root is not null")
    if leaves.isEmpty():
        return within.distinct()
    light = leaves.select("root", "leaf", "branch", "n_lo", "n_hi", "c_lo", "c_hi", "box")
    met = stored(meeting(branches, "branch", percent), "branch-pairs")
    pairs = stored(meeting(light, "leaf", percent, met), "leaf-pairs")
    of = lambda c: leaves.select(F.col("root").alias(f"root_{c}"), F.col("leaf").alias(f"leaf_{c}"), *[F.col(k).alias(f"{k}_{c}") for k in ("nodes", "sizes", "components", "counts")])
    opened = pairs.join(of("x"), (F.col("root") == F.col("root_x")) & (F.col("x") == F.col("leaf_x"))).join(of("y"), (F.col("root") == F.col("root_y")) & (F.col("y") == F.col("leaf_y")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                (u, n, c, p), (v, m, d, q) = ((np.array(r[f"nodes_{s}"]), np.array(r[f"sizes_{s}"]), np.array(r[f"components_{s}"]), np.frombuffer(r[f"counts_{s}"], np.uint16).reshape(len(r[f"nodes_{s}"]), -1)) for s in "xy")
                for i in range(len(u)):
                    good = np.flatnonzero(enough(_minima(p[i], q), n[i], m, percent) & (c[i] != d))
                    if len(good):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u[i], v[good])), pa.array(np.maximum(u[i], v[good]))], names=["u", "v"])

    across = opened.select(*[f"{k}_{s}" for s in "xy" for k in ("nodes", "sizes", "components", "counts")]).mapInArrow(work, "u long, v long")
    return within.union(across).distinct()


def joined_groups(docs: DataFrame, *, percent: int = PERCENT, shingle: int = SHINGLE, star_rounds: int = STAR_ROUNDS, leaf: int = LEAF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    rows = stored(document_roots(docs, shingle=shingle, percent=percent, id_col=id_col, text_col=text_col).withColumn("row", F.monotonically_increasing_id()), "roots")
    named = rows.where("doc_id is not null and set_key is not null")
    # Of documents with one set the smallest id stands for all; its roots are read where they are.
    first = F.min(F.struct("doc_id", "row"))
    classes = stored(named.groupBy("set_key").agg(first.alias("of"), F.count(F.lit(1)).alias("n")).select("set_key", F.col("of.doc_id").alias("node"), F.col("of.row").alias("row"), "n"), "classes")
    # Roots stay where they are: what is looked up are the rows that are copies, which are fewer than those that are not.
    copied = stored(classes.where("n > 1").select("set_key", F.col("row").alias("first")), "copied-sets")
    copies = stored(named.select("set_key", "row").join(copied, "set_key").where("row <> first").select("row"), "copies")
    # Most roots are of one document: they go first, where they have been dealt by root once.
    held = named.join(copies, "row", "left_anti").select(F.col("doc_id").alias("node"), F.explode("roots").alias("root"))
    held = held.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("root"))).where("n > 1")
    held = stored(held.select("root", "node"), "held-by-several")
    # Copies are one document now.  Roots of the same documents, told by their number and 128 bits of their ids, are one.
    ids = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in range(2)]
    shared = held.groupBy("root").agg(F.count(F.lit(1)).alias("n"), *ids).where("n > 1")
    shared = stored(shared.groupBy("n", "x0", "x1").agg(F.min("root").alias("root")).select("root"), "shared-roots")
    held = stored(held.join(shared, "root"), "held")
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    repeated = stored(named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("node")), "repeated-ids")
    if not repeated.isEmpty():
        texts = texts.join(repeated, "node", "left_anti").union(texts.join(repeated, "node", "left_semi").dropDuplicates())
    # Stored, so that their real size decides whether texts are shuffled to meet them.
    wanted = stored(held.select("node").distinct(), "wanted")
    sets = stored(document_sets(texts.join(wanted, "node", "left_semi"), shingle=shingle), "sets")
    points = stored(set_points(sets, percent=percent), "points")
    versions = named.select(F.col("doc_id").alias("node"), "set_key").join(repeated, "node").distinct().select(F.col("node").alias("u"), "set_key").join(classes.select("set_key", F.col("node").alias("v")), "set_key").select("u", "v")
    links, checked = stored(versions.where("u <> v"), "versions"), None
    labels = None if links.isEmpty() else connected_components(links)
    for turn in range(star_rounds + 1):
        here = _placed(held, labels)
        order = F.struct(F.xxhash64("node", F.lit(turn)), "node", "component")
        centres = here.groupBy("root").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min(order).alias("r"))
        centres = stored(centres.where("lo < hi").select("root", F.col("r.node").alias("rep"), F.col("r.component").alias("rep_component")), "centres")
        if turn == star_rounds:
            pairs = tree_pairs(here.join(centres.select("root"), "root"), points, percent, leaf)
        else:
            pairs = here.join(centres, "root").where("component <> rep_component").select(F.least("node", "rep").alias("u"), F.greatest("node", "rep").alias("v")).distinct()
        pairs = stored(pairs if checked is None else pairs.join(checked, ["u", "v"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        near = stored(bounded(pairs, in_pairs(points, pairs), percent) if turn < star_rounds else pairs, "near")
        links = links.union(stored(_linked(near, in_pairs(sets, near), percent), "links"))
        checked = pairs if checked is None else checked.union(pairs)
        labels = connected_components(links)
    found = classes.select(F.col("set_key").alias("k"), "node")
    found = found.join(labels, "node", "left") if labels is not None else found.withColumn("component", F.col("node"))
    joined = rows.join(found.select("k", F.coalesce("component", "node").alias("of_class")), F.col("set_key") == F.col("k"), "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("of_class", "doc_id")).alias("component_id"))
