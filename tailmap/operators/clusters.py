"""Clusters of neighbouring sites.

Greedy claiming is sequential, but what a site does hangs on the better ones near it only.  So it works on tiles of positions,
and what depends on sites beyond a tile is left to a further round with other tiles.  The merging of clusters works on tiles as
well; what runs from one into the next is a small function of each tile, put into that of the next (``_chained``).  So no group
is larger than a tile however dense sites and clusters are, but for the functions of a strand, some rows a tile.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tailmap.operators.lineage import stored

PAS = "array<struct<motif:string,rel:int,abs:bigint>>"


#: Positions of a tile.
PACK = 100_000


def claim(positions: list[int], up: int, down: int, *, seeds: list[int | None] | None = None, first: int | None = None, past: int | None = None) -> list[int | None]:
    """For each position, given in the order of its rank, the position that claims it; None where that cannot be told here.

    seeds: what is known already.  first, past: positions before and from there on exist but are not given, and may claim those
    within their reach.  A site is left open where a better one that claims it is not given or is open itself.
    """
    by_pos = sorted(range(len(positions)), key=positions.__getitem__)
    places = [positions[i] for i in by_pos]
    seed = list(seeds) if seeds else [None] * len(positions)
    unsure = [(first is not None and p - down < first) or (past is not None and p + up >= past) for p in positions]
    barred = [False] * len(positions)
    for i, p in enumerate(positions):
        if (seed[i] is not None and seed[i] != p) or (seed[i] is None and barred[i]):
            continue
        reach = by_pos[bisect.bisect_left(places, p - up) : bisect.bisect_right(places, p + down)]
        if seed[i] is None and unsure[i]:
            for j in reach:
                unsure[j] = True
            continue
        for j in reach:
            if seed[j] is None and not unsure[j]:
                seed[j] = p
            # Claimed by this one or a better one: it claims nothing itself.
            barred[j] = True
    return seed


def _claimer(names: list[str], ranks: list[str], strand_at: int, tile: int, shift: int, halo: int, upstream: int, downstream: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """The function that claims within a tile, and returns the tile's own sites."""

    def work(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        low = int(key[-1]) * tile + shift
        up, down = (upstream, downstream) if key[strand_at] == "+" else (downstream, upstream)
        pdf = pdf.sort_values([*ranks, "pos"], ascending=[False] * len(ranks) + [True], na_position="last")
        known = [None if pd.isna(s) else int(s) for s in pdf["seed"]]
        seeds = claim(pdf["pos"].tolist(), up, down, seeds=known, first=low - halo, past=low + tile + halo)
        return pdf.assign(seed=pd.array(seeds, dtype="Int64"))[pdf["pos"].between(low, low + tile - 1)][names]

    return work


def greedy_claim(sites: DataFrame, order: list[str], *, upstream: int, downstream: int, keys: tuple[str, ...] = ("chr", "strand"), tile: int = PACK, halo: int = 2_000) -> DataFrame:
    """chr, strand, pos, and seed (the position that claims it) of every site, with further ``keys``.

    order: columns by which sites rank, the largest first, nulls last; ties go to the smaller position.  Sites must differ in
    keys and position; those without a position go.

    A task claims within a tile of positions, of which it sees ``halo`` more on both sides, and leaves open what depends on
    sites beyond.  Those are decided in further rounds, whose tiles lie half a tile further along.  A group has no more than
    tile + 2 * halo positions however dense the sites are, and the result is that of claiming a whole strand in order: in one
    of two rounds the best open site lies farther from the ends of its tile than a window reaches.
    """
    tile = max(tile, 4 * (upstream + downstream + 1))
    halo = min(halo, tile // 2)
    ranks = [f"_o{i}" for i in range(len(order))]
    state = sites.where("pos is not null").select(*keys, F.col("pos").cast("long").alias("pos"), F.lit(None).cast("long").alias("seed"), *[F.col(c).alias(r) for c, r in zip(order, ranks, strict=True)])
    turn = 0
    while not turn or not state.where("seed is null").isEmpty():
        shift = turn % 2 * (tile // 2)
        tile_of = [F.floor((F.col("pos") - shift + by) / tile) for by in (0, -halo, halo)]
        dealt = state.withColumn("_tile", F.explode(F.array_distinct(F.array(*tile_of))))
        if turn:
            open_ = state.where("seed is null").select(*[F.col(k).alias(f"_{k}") for k in keys], tile_of[0].alias("_t")).distinct()
            same = F.col("_tile") == F.col("_t")
            for k in keys:
                same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
            dealt, rest = dealt.join(open_, same, "left_semi"), state.withColumn("_tile", tile_of[0]).join(open_, same, "left_anti").drop("_tile")
        work = _claimer(state.columns, ranks, keys.index("strand"), tile, shift, halo, upstream, downstream)
        found = dealt.groupBy(*keys, "_tile").applyInPandas(work, state.schema)
        state = stored(rest.union(found) if turn else found, "claimed")
        turn += 1
    return state.select(*keys, "pos", "seed")


def mini_clusters(sites: DataFrame, *, upstream: int = 25, downstream: int = 25) -> DataFrame:
    """Per sample: sample, chr, strand, seed, seed_cnt, reads, has_pas, positions of clusters around the most read sites.

    sites: sample, chr, strand, pos, cnt, has_pas; those with a count of zero take no part.
    """
    keys = ("sample", "chr", "strand")
    rows = stored(sites.where("cnt > 0").select(*keys, F.col("pos").cast("long").alias("pos"), F.col("cnt").cast("long").alias("cnt"), "has_pas"), "counted-sites")
    seeds = greedy_claim(rows, ["cnt"], upstream=upstream, downstream=downstream, keys=keys)
    return rows.join(seeds, [*keys, "pos"]).groupBy(*keys, "seed").agg(
        F.max(F.when(F.col("pos") == F.col("seed"), F.col("cnt"))).alias("seed_cnt"), F.sum("cnt").alias("reads"), F.max("has_pas").alias("has_pas"), F.array_sort(F.collect_list("pos")).alias("positions")
    )


def read_cutoffs(clusters: DataFrame, *, cutoff: float = 90.0) -> DataFrame:
    """sample, read_cutoff: clusters with so many reads or fewer are background.

    In the order of reads the share of clusters with a signal is followed from the second after the first hundredth on; the
    first that brings it below ``cutoff`` percent gives the number.  If it is the very first looked at, it is that of the
    largest cluster.  Nothing below: 0.

    Clusters are put in order by range, so that a sample is spread over tasks: sums run within a range, from what the ranges of
    the sample before it hold (a row for each).
    """
    order = [F.col("sample"), F.col("reads").desc(), F.concat_ws(":", "chr", "strand"), F.col("seed_cnt").desc(), F.col("seed")]
    rows = clusters.select("sample", "reads", "chr", "strand", "seed_cnt", "seed", F.col("has_pas").cast("int").alias("pas"))
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()).select("sample", "reads", "pas", "at"), "ranked")
    placed = placed.withColumn("range", F.shiftright("at", 33))
    sample = W.partitionBy("s")
    before = sample.orderBy("r").rowsBetween(W.unboundedPreceding, -1)
    per = placed.groupBy(F.col("sample").alias("s"), F.col("range").alias("r")).agg(F.count(F.lit(1)).alias("k"), F.sum("pas").alias("p"), F.max("reads").alias("most"))
    per = per.select("s", "r", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("k0"), F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p0"), F.sum("k").over(sample).alias("n"), F.max("most").over(sample).alias("largest"))
    within = W.partitionBy("sample", "range").orderBy("at")
    running = placed.withColumns({"place": F.row_number().over(within), "held": F.sum("pas").over(within.rowsBetween(W.unboundedPreceding, W.currentRow))})
    ranked = running.join(per, F.col("sample").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    idx, start = F.col("k0") + F.col("place") - 1, F.floor(F.col("n") / 100) + 1
    low = (idx >= start) & (F.round((F.col("p0") + F.col("held")) * 100 / (idx + 1), 2) < cutoff)
    said = F.when(low, F.struct(idx.alias("idx"), F.when(idx == start, F.col("largest")).otherwise(F.col("reads")).alias("reads")))
    return ranked.groupBy("sample").agg(F.min(said).alias("at")).select("sample", F.coalesce("at.reads", F.lit(0)).cast("long").alias("read_cutoff"))


def above_background(sites: DataFrame, *, upstream: int = 25, downstream: int = 25, cutoff: float = 90.0) -> DataFrame:
    """``sites`` in mini-clusters of their sample with more reads than its cutoff."""
    sites = stored(sites, "sites")
    minis = stored(mini_clusters(sites, upstream=upstream, downstream=downstream), "mini-clusters")
    good = minis.join(read_cutoffs(minis, cutoff=cutoff), "sample").where(F.col("reads") > F.col("read_cutoff"))
    return sites.join(good.select("sample", "chr", "strand", F.explode("positions").alias("pos")), ["sample", "chr", "strand", "pos"], "left_semi")


def primary_clusters(support: DataFrame, *, upstream: int = 12, downstream: int = 12, pas: DataFrame | None = None) -> DataFrame:
    """chr, strand, start1, end, rep, total_tpm, pas, is_ip_candidate, tpm (map of sample to sum) of ``site_support`` rows.

    The representative is the site that is the largest of its cluster in most samples, of equals the most downstream.  Where a
    member has a signal that begins less than its length before the member, or behind it, the cluster is a candidate for
    internal priming: then the most downstream member represents it.  pas: chr, strand, pos, pas; none without.
    """
    keys = ["chr", "strand"]
    support = stored(support, "support")
    seeds = greedy_claim(support, ["n_supported", "mean_tpm"], upstream=upstream, downstream=downstream)
    # A table of a row for each site is small in its file and large in memory: it is not sent to all tasks.
    rows = support.join(seeds.hint("merge"), [*keys, "pos"])
    rows = rows.join(pas.hint("merge"), [*keys, "pos"], "left") if pas is not None else rows.withColumn("pas", F.lit(None).cast(PAS))
    members = stored(rows.select(*keys, "seed", "pos", "mean_tpm", F.coalesce("pas", F.array().cast(PAS)).alias("pas"), "per"), "members")
    # Votes: for each sample the members that reach its largest value.
    long = members.select(*keys, "seed", "pos", F.explode("per").alias("p")).select(*keys, "seed", "pos", "p.sample", "p.tpm")
    top = long.withColumn("most", F.max("tpm").over(W.partitionBy(*keys, "seed", "sample"))).where("tpm = most")
    downstream_first = F.when(F.col("strand") == "-", -F.col("pos")).otherwise(F.col("pos"))
    votes = top.groupBy(*keys, "seed", "pos").agg(F.count(F.lit(1)).alias("votes"))
    rep = votes.groupBy(*keys, "seed").agg(F.max_by("pos", F.struct("votes", downstream_first)).alias("voted"))
    per = long.groupBy(*keys, "seed", "sample").agg(F.round(F.sum("tpm"), 6).alias("tpm")).groupBy(*keys, "seed").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("sample", "tpm")))).alias("tpm"))
    late = F.exists("pas", lambda p: p["rel"] >= -F.length(p["motif"]))
    whole = members.groupBy(*keys, "seed").agg(
        F.min("pos").alias("start1"), F.max("pos").alias("end"), F.sum("mean_tpm").alias("total_tpm"), F.max(late).alias("is_ip_candidate"), F.max_by("pos", downstream_first).alias("last"), F.map_from_entries(F.collect_list(F.struct("pos", "pas"))).alias("all_pas")
    )
    done = whole.join(rep, [*keys, "seed"]).join(per, [*keys, "seed"]).withColumn("rep", F.when(F.col("is_ip_candidate"), F.col("last")).otherwise(F.col("voted")))
    return done.select(*keys, "start1", "end", "rep", "total_tpm", F.element_at("all_pas", F.col("rep")).alias("pas"), "is_ip_candidate", "tpm")


class _Cluster(dict):
    """A row of a cluster as it is merged; ``marks`` are the places of its signals."""

    @property
    def marks(self) -> set[int]:
        return {p["abs"] for p in self["pas"]}


def _joined(leader: _Cluster, other: _Cluster) -> _Cluster:
    tpm = {s: leader["tpm"].get(s, 0.0) + other["tpm"].get(s, 0.0) for s in {**leader["tpm"], **other["tpm"]}}
    return _Cluster(leader, start1=min(leader["start1"], other["start1"]), end=max(leader["end"], other["end"]), total_tpm=leader["total_tpm"] + other["total_tpm"], tpm=tpm)


def _merged(a: _Cluster, b: _Cluster) -> _Cluster:
    """The one with the larger total leads, the first of equals."""
    return _joined(b, a) if a["total_tpm"] < b["total_tpm"] else _joined(a, b)


def resolve_internal_priming(clusters: list[_Cluster], strand: str, least_distance: int) -> list[_Cluster]:
    """Candidates join the next cluster downstream that is none, stand on their own, or go.  Clusters by position."""
    sign = 1 if strand == "+" else -1
    line: list[_Cluster | None] = clusters[::sign]
    for i, c in enumerate(line):
        if c is None or not c["is_ip_candidate"]:
            continue
        k = next((j for j in range(i + 1, len(line)) if line[j] is not None and not line[j]["is_ip_candidate"]), None)
        if k is not None and (theirs := line[k].marks):
            new_beyond = any((m - c["rep"]) * sign > 0 for m in theirs - c.marks)
            if theirs & c.marks and not new_beyond:
                line[k], line[i] = _joined(line[k], c), None
                continue
        # The nearest signal is the most downstream one; without any the cluster stays.
        near = max(c.marks, key=lambda m: m * sign, default=None)
        line[i] = _Cluster(c, is_ip_candidate=False) if near is None or abs(c["rep"] - near) >= least_distance else None
    return [c for c in line[::sign] if c is not None]


def _chain(clusters: list[_Cluster], together: Callable[[_Cluster, _Cluster], bool]) -> list[_Cluster]:
    """Neighbours merged from left to right wherever ``together`` says so of what has been merged and the next."""
    out: list[_Cluster] = []
    for c in clusters:
        if out and together(out[-1], c):
            out[-1] = _merged(out[-1], c)
        else:
            out.append(c)
    return out


def merge_same_signals(clusters: list[_Cluster], strand: str) -> list[_Cluster]:
    """Neighbours merge if both have signals and the downstream one has none that the upstream one lacks."""

    def together(a: _Cluster, b: _Cluster) -> bool:
        up, down = (a, b) if strand == "+" else (b, a)
        return bool(a.marks and b.marks and down.marks <= up.marks)

    return _chain(clusters, together)


def merge_small(clusters: list[_Cluster], most: int) -> list[_Cluster]:
    """Neighbours merge if they are at most so wide together."""
    return _chain(clusters, lambda a, b: b["end"] - a["start1"] + 1 <= most)


def runs_without_signals(clusters: list[_Cluster], most: int, *, compat: str = "clean") -> list[list[_Cluster]]:
    """Runs of neighbours without signals that lie close together; every other cluster is a run.

    compat="reference": the last cluster of the strand, known by ``_from_end``, is in no run with others.
    """
    runs: list[list[_Cluster]] = []
    for c in clusters:
        before = runs[-1][-1] if runs else None
        alone = before is None or c.marks or before.marks or c["start1"] - before["end"] > most // 2 or (compat == "reference" and c["_from_end"] == 1)
        if alone:
            runs.append([c])
        else:
            runs[-1].append(c)
    return runs


def merge_without_signals(clusters: list[_Cluster], most: int, *, compat: str = "clean") -> list[_Cluster]:
    """Runs of clusters without signals that lie close together merge if not too wide, else go.

    compat="reference": the last cluster of all is not looked at, and of a last run that is too wide the last cluster stays.
    """
    out: list[_Cluster] = []
    line = [_Cluster(c, _from_end=len(clusters) - i) for i, c in enumerate(clusters)]
    for run in runs_without_signals(line, most, compat=compat):
        untouched = compat == "reference" and run[-1]["_from_end"] == 1
        if run[0].marks or untouched or run[-1]["end"] - run[0]["start1"] <= 2 * most:
            out.append(functools.reduce(_merged, run))
        elif compat == "reference" and run[-1]["_from_end"] == 2:
            out.append(run[-1])
    return [_Cluster({k: v for k, v in c.items() if k != "_from_end"}) for c in out]


def merge_line(clusters: list[_Cluster], strand: str, *, least_distance: int, most: int, compat: str = "clean") -> list[_Cluster]:
    """All four phases on the clusters of a strand, by position; ``merge_clusters`` gives the same by tiles."""
    clusters = resolve_internal_priming(clusters, strand, least_distance)
    clusters = merge_small(merge_same_signals(clusters, strand), most)
    return merge_without_signals(clusters, most, compat=compat)


CLUSTER = f"chr string, strand string, start1 bigint, end bigint, rep bigint, total_tpm double, pas {PAS}, is_ip_candidate boolean, tpm map<string,double>"


def _frame(rows: list, names: list[str]) -> pd.DataFrame:
    """Rows (tuples, or clusters with more keys) as a result; each column keeps plain values, None among them."""
    rows = [tuple(r[k] for k in names) if isinstance(r, dict) else r for r in rows]
    return pd.DataFrame(rows, columns=names, dtype=object)


def _line(pdf: pd.DataFrame, names: list[str]) -> list[_Cluster]:
    """The rows by position, as clusters."""
    out = []
    for row in pdf.sort_values(["rep", "start1"])[names].to_dict("records"):
        tpm = row["tpm"]
        row["tpm"] = dict(tpm if isinstance(tpm, dict) else list(tpm))
        row["pas"] = [dict(p) if isinstance(p, dict) else p.asDict() for p in row["pas"]]
        out.append(_Cluster(row))
    return out


def _dealt(clusters: DataFrame, tile: int, halo: int) -> DataFrame:
    """``clusters`` with _tile: that of the representative, and those whose halo it is in."""
    tiles = [F.floor((F.col("rep") + by) / tile) for by in (0, -halo, halo)]
    return clusters.withColumn("_tile", F.explode(F.array_distinct(F.array(*tiles))))


#: How far a run goes that begins at a place of a line: the place behind it.  totals, starts, ends and marks are those of the line.
Reach = Callable[[int, list[float], list[int], list[int], list[set[int]], str], int]


def reach_same_signals(i: int, totals: list[float], starts: list[int], ends: list[int], marks: list[set[int]], strand: str) -> int:
    """The place behind the run that ``merge_same_signals`` makes from i on."""
    total, lead, j = totals[i], marks[i], i + 1
    while j < len(totals):
        up, down = (lead, marks[j]) if strand == "+" else (marks[j], lead)
        if not (up and down and down <= up):
            break
        if total < totals[j]:
            lead = marks[j]
        total, j = total + totals[j], j + 1
    return j


def reach_small(i: int, totals: list[float], starts: list[int], ends: list[int], marks: list[set[int]], strand: str, *, most: int) -> int:
    """The place behind the run that ``merge_small`` makes from i on."""
    first, j = starts[i], i + 1
    while j < len(starts) and ends[j] - first + 1 <= most:
        first, j = min(first, starts[j]), j + 1
    return j


def _chained(clusters: DataFrame, reach: Reach, tile: int, halo: int, name: str) -> DataFrame:
    """Neighbours merged from left to right, run by run, where ``reach`` says how far a run goes.

    Where a run begins hangs on where the one before it ended, and so on to the beginning of the strand; but how far it goes
    hangs on its first cluster alone.  So a tile is summed up as a function: for every cluster at which a run that comes from
    the left may make the first run of the tile begin, where the first run behind the tile begins then.  The functions of a
    strand, some rows for each tile, are put one into the other, which gives the place where each tile really begins; then the
    tiles merge on their own.  A run's representatives lie within ``halo`` of its first one; a longer one is an error.
    """
    names = clusters.columns
    clusters = stored(clusters, name)
    light = clusters.select("chr", "strand", "rep", "start1", "end", "total_tpm", F.transform("pas", lambda p: p["abs"]).alias("marks"))

    def summary(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        chr_, strand, t = key
        low, high = int(t) * tile, (int(t) + 1) * tile
        pdf = pdf.sort_values(["rep", "start1"])
        reps, columns = pdf["rep"].tolist(), [pdf[c].tolist() for c in ("total_tpm", "start1", "end")]
        marks = [set(m) for m in pdf["marks"]]
        own = [i for i, r in enumerate(reps) if low <= r < high]
        if not own:
            return _frame([], ["chr", "strand", "_tile", "entry", "exit", "covered"])
        behind = [reach(i, *columns, marks, strand) if r < high else 0 for i, r in enumerate(reps)]
        entries = {own[0], *(j for i, j in enumerate(behind) if reps[i] < low and j < len(reps) and low <= reps[j] < high)}
        to: dict[int, tuple[int | None, int]] = {}
        for i in reversed(own):
            j = behind[i]
            to[i] = to[j] if j < len(reps) and reps[j] < high else (reps[j] if j < len(reps) else None, reps[j - 1])
        rows = [(chr_, strand, t, reps[i], *to[i]) for i in sorted(entries)]
        return _frame(rows, ["chr", "strand", "_tile", "entry", "exit", "covered"])

    def composed(pdf: pd.DataFrame) -> pd.DataFrame:
        begin, covered, out = None, None, []
        for t, rows in pdf.sort_values(["_tile", "entry"]).groupby("_tile", sort=True):
            ways = {int(e): (None if pd.isna(x) else int(x), int(c)) for e, x, c in zip(rows["entry"], rows["exit"], rows["covered"], strict=True)}
            at = begin if begin is not None else next((e for e in ways if covered is None or e > covered), None)
            if at is None:
                continue
            if at not in ways:
                raise ValueError("clusters merge over more than the gap that parts them: a larger split_gap is needed")
            out.append((rows["chr"].iloc[0], rows["strand"].iloc[0], t, at))
            begin, covered = ways[at]
        return _frame(out, ["chr", "strand", "_tile", "entry"])

    def merged(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        strand, high = key[1], (int(key[2]) + 1) * tile
        entry, line = int(pdf["entry"].iloc[0]), _line(pdf, names)
        columns, marks, out = [[c[k] for c in line] for k in ("total_tpm", "start1", "end")], [c.marks for c in line], []
        i = next(i for i, c in enumerate(line) if c["rep"] == entry)
        while i < len(line) and line[i]["rep"] < high:
            j = reach(i, *columns, marks, strand)
            if line[j - 1]["rep"] - line[i]["rep"] > halo:
                raise ValueError("clusters merge over more than the gap that parts them: a larger split_gap is needed")
            out.append(functools.reduce(_merged, line[i:j]))
            i = j
        return _frame(out, names)

    keys = ["chr", "strand", "_tile"]
    ways = stored(_dealt(light, tile, halo).groupBy(*keys).applyInPandas(summary, "chr string, strand string, _tile bigint, entry bigint, exit bigint, covered bigint"), f"{name}-tiles")
    begins = stored(ways.groupBy("chr", "strand").applyInPandas(composed, "chr string, strand string, _tile bigint, entry bigint"), f"{name}-begins")
    return _dealt(clusters, tile, halo).join(begins, keys).groupBy(*keys).applyInPandas(merged, _schema(names))


def _schema(names: list[str]) -> str:
    return ", ".join(c for c in CLUSTER.split(", ") if c.split()[0] in names)


def _with_place_from_end(clusters: DataFrame) -> DataFrame:
    """``clusters`` with _from_end: 1 for the last of a strand, 2 for the one before, else 0."""
    last = clusters.groupBy("chr", "strand").agg(F.max("rep").alias("_last"))
    joined = clusters.join(last, ["chr", "strand"])
    second = joined.where("rep < _last").groupBy("chr", "strand").agg(F.max("rep").alias("_second"))
    place = F.when(F.col("rep") == F.col("_last"), 1).when(F.col("rep") == F.col("_second"), 2).otherwise(0)
    return joined.join(second, ["chr", "strand"], "left").withColumn("_from_end", place).drop("_last", "_second")


def merge_clusters(clusters: DataFrame, *, least_distance: int = 15, most: int = 25, split_gap: int = 100, compat: str = "clean", tile: int = PACK) -> DataFrame:
    """Primary clusters merged in four phases; columns as of ``primary_clusters``.  The result is ``merge_line``'s of each strand.

    A task works within a tile of positions, of which it sees ``split_gap`` more on both sides, however dense the clusters are.
    split_gap: clusters whose representatives are farther apart have no signal in common and do not touch: wider than the
    windows in which signals are looked for, and than twice the widest cluster and ``most``.  Runs that are longer are an error.
    """
    names = [c.split()[0] for c in CLUSTER.split(", ") if c.split()[0] in clusters.columns]
    halo, tile = split_gap, max(tile, split_gap)
    keys = ["chr", "strand", "_tile"]

    def owned(key: tuple, line: list[_Cluster]) -> pd.DataFrame:
        low = int(key[2]) * tile
        return _frame([c for c in line if low <= c["rep"] < low + tile], names)

    def resolved(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return owned(key, resolve_internal_priming(_line(pdf, names), key[1], least_distance))

    def without_signals(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        low, line = int(key[2]) * tile, _line(pdf, [*names, "_from_end"])
        runs = runs_without_signals(line, most, compat=compat)
        out = []
        for run in runs:
            end = run[-1].pop("_from_end")
            wide = run[-1]["end"] - run[0]["start1"] > 2 * most
            if run[0].marks or not wide or end == 1:
                if low <= run[0]["rep"] < low + tile:
                    out.append(functools.reduce(_merged, run))
            elif compat == "reference" and end == 2 and low <= run[-1]["rep"] < low + tile:
                out.append(run[-1])
        return _frame(out, names)

    rows = clusters.select(*names)
    rows = _dealt(rows, tile, halo).groupBy(*keys).applyInPandas(resolved, _schema(names))
    rows = _chained(rows, reach_same_signals, tile, halo, "with-signals")
    rows = stored(_chained(rows, functools.partial(reach_small, most=most), tile, halo, "small"), "merged-small")
    rows = _with_place_from_end(rows) if compat == "reference" else rows.withColumn("_from_end", F.lit(0))
    return _dealt(rows, tile, halo).groupBy(*keys).applyInPandas(without_signals, _schema(names))


def cluster_statistics(clusters: DataFrame) -> DataFrame:
    """clusters, total_tpm, and the percent of it in clusters wider than one nucleotide."""
    wide = F.sum(F.when(F.col("end") > F.col("start1"), F.col("total_tpm")).otherwise(0.0))
    return clusters.agg(F.count(F.lit(1)).alias("clusters"), F.sum("total_tpm").alias("total_tpm"), (wide * 100 / F.nullif(F.sum("total_tpm"), F.lit(0.0))).alias("percent_wide"))
