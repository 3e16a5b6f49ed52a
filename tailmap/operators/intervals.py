"""Interval joins and gene features.  Intervals are half-open: columns s and e, on chr and strand.

Spark pairs all rows of a key when the rest of a join's condition is an inequality.  Here an interval is dealt to the bins
that it touches, and pairs meet in a bin by an equi-join; a pair that shares several bins is kept in the first of them only,
so no distinct is needed.  Longer intervals have wider bins, by levels: a pair meets in the bins of the longer one's level.  So
an interval is dealt to some ``FACTOR`` bins of its own level at most, and to one or two of each level above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tailmap.operators.alignments import exon_model

#: Width of the finest bins, how much wider each next level's are, and how many levels there are.
BIN, FACTOR, LEVELS = 1024, 32, 4

# Features by priority, highest first.
PRIORITY = ("TE", "EX", "IN", "DS", "AE", "AI", "AU")


def _level(s: Column, e: Column) -> Column:
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(e - s <= BIN * FACTOR ** (k + 1), k).otherwise(level)
    return level


def _bins(s: Column, e: Column, width: Column) -> Column:
    return F.sequence(F.floor(s / width), F.floor((e - 1) / width))


def overlap_join(left: DataFrame, right: DataFrame, *, how: str = "inner", keys: tuple[str, ...] = ("chr", "strand"), prefix: str = "r_") -> DataFrame:
    """Pairs of overlapping rows with equal keys; the right's columns get a prefix.  how: inner or left.

    A pair meets at the level of the longer one: on side L where that is the left one, or both, else on side R.  So an interval
    stands alone on its own level's side, and is dealt to the other side of its level and of all above.
    Empty or null intervals overlap nothing; repeated rows pair each.
    """
    width = F.lit(BIN) * F.pow(F.lit(FACTOR), F.col("_l")).cast("long")
    named = left.withColumn("_row", F.monotonically_increasing_id()) if how == "left" else left

    def dealt(rows: DataFrame, own: str, other: str, first: int) -> DataFrame:
        """Rows in the bins of their own level on side ``own``, and of those from ``first`` above it on side ``other``."""
        level = _level(F.col("s"), F.col("e"))
        at = lambda k, side: F.struct(k.cast("int").alias("l"), F.lit(side).alias("side"))
        above = F.filter(F.array(*[at(F.lit(k), other) for k in range(LEVELS)]), lambda x: x["l"] >= level + first)
        spread = rows.where("s < e").withColumn("_at", F.explode(F.concat(F.array(at(level, own)), above)))
        spread = spread.withColumns({"_l": F.col("_at.l"), "_side": F.col("_at.side")}).drop("_at")
        return spread.withColumn("_b", F.explode(_bins(F.col("s"), F.col("e"), width)))

    a = dealt(named, "L", "R", 1)
    b = dealt(right, "R", "L", 0).select(*[F.col(c).alias(f"{prefix}{c}") for c in [*right.columns, "_l", "_side", "_b"]])
    same = [F.col(k) == F.col(f"{prefix}{k}") for k in keys] + [F.col("_l") == F.col(f"{prefix}_l"), F.col("_side") == F.col(f"{prefix}_side"), F.col("_b") == F.col(f"{prefix}_b")]
    met = (F.col("s") < F.col(f"{prefix}e")) & (F.col(f"{prefix}s") < F.col("e"))
    first = F.col("_b") == F.greatest(F.floor(F.col("s") / width), F.floor(F.col(f"{prefix}s") / width))
    condition = met & first
    for c in same:
        condition &= c
    # By size a planner would send a side to all tasks, as it does not see that rows are dealt to several bins.
    pairs = a.join(b.hint("merge"), condition).drop("_l", "_side", "_b", f"{prefix}_l", f"{prefix}_side", f"{prefix}_b")
    if how == "inner":
        return pairs
    alone = named.join(pairs.select("_row").distinct(), "_row", "left_anti")
    return pairs.drop("_row").unionByName(alone.drop("_row"), allowMissingColumns=True)


def feature_model(exons: DataFrame, *, ds_range: int = 1000, compat: str = "clean") -> DataFrame:
    """chr, strand, s, e, feature, transcript_id of transcripts given as exons.

    On the transcript's strand: EX exons, IN the gaps between, TE the last exon, DS ``ds_range`` nucleotides beyond it.  On the
    other strand: AE and AI opposite exons and introns of transcripts with more than one exon, AU upstream of the first exon.
    compat="reference": the exon with the highest coordinates of such a transcript is AI rather than EX on its own strand.
    """
    model = exon_model(exons).withColumn("other", F.when(F.col("strand") == "-", "+").otherwise("-"))
    minus, last = F.col("strand") == "-", F.col("n") == F.col("exons")
    gap_s = F.when(minus, F.col("end")).otherwise(F.col("start0") - F.col("intron"))
    beyond = F.when(minus, F.col("start0") - ds_range).otherwise(F.col("end"))
    before = F.when(minus, F.col("end")).otherwise(F.col("start0") - ds_range)
    many = F.col("exons") > 1
    own = F.lit("EX")
    if compat == "reference":
        own = F.when(many & F.when(minus, F.col("n") == 1).otherwise(last), "AI").otherwise(own)
    part = lambda keep, strand, s, e, name: F.when(keep, F.struct(strand.alias("strand"), s.cast("long").alias("s"), e.cast("long").alias("e"), name.alias("feature")))
    parts = F.array(
        part(F.lit(True), F.col("strand"), F.col("start0"), F.col("end"), own),
        part(last, F.col("strand"), F.col("start0"), F.col("end"), F.lit("TE")),
        part(last, F.col("strand"), beyond, beyond + ds_range, F.lit("DS")),
        part(F.col("intron") > 0, F.col("strand"), gap_s, gap_s + F.col("intron"), F.lit("IN")),
        part(many, F.col("other"), F.col("start0"), F.col("end"), F.lit("AE")),
        part(F.col("intron") > 0, F.col("other"), gap_s, gap_s + F.col("intron"), F.lit("AI")),
        part(F.col("n") == 1, F.col("other"), before, before + ds_range, F.lit("AU")),
    )
    return model.select("chr", "transcript_id", F.explode(F.filter(parts, lambda p: p.isNotNull())).alias("p")).select("chr", "p.strand", "p.s", "p.e", "p.feature", "transcript_id")


def priority_of(feature: Column) -> Column:
    """Rank of a feature, 0 for the one that goes first; null for others."""
    return F.get(F.array(*[F.lit(i) for i in range(len(PRIORITY))]), F.array_position(F.array(*[F.lit(p) for p in PRIORITY]), feature).cast("int") - 1)


def annotate(clusters: DataFrame, features: DataFrame, *, id_col: str = "cluster_id") -> DataFrame:
    """``clusters`` (chr, strand, s, e) with annotation: of the features that overlap the one that goes first, else IG."""
    rank = priority_of(F.col("r_feature"))
    best = overlap_join(clusters.select(id_col, "chr", "strand", "s", "e"), features.select("chr", "strand", "s", "e", "feature"))
    best = best.groupBy(F.col(id_col).alias("_id")).agg(F.min_by("r_feature", rank).alias("annotation"))
    return clusters.join(best, F.col(id_col) == F.col("_id"), "left").drop("_id").withColumn("annotation", F.coalesce("annotation", F.lit("IG")))


def counted_genes(clusters: DataFrame, genes: DataFrame, *, id_col: str = "cluster_id") -> DataFrame:
    """``clusters`` with gene_name and gene_id: arrays of value and n, the genes that overlap, sorted by id, and how often; or null.

    Pairs are counted as they are found, so that what travels hangs on the genes of a cluster, not on its overlaps.
    """
    pairs = overlap_join(clusters.select(id_col, "chr", "strand", "s", "e"), genes.select("chr", "strand", "s", "e", "gene_id", "gene_name"))
    counts = pairs.groupBy(F.col(id_col).alias("_id"), "r_gene_id", "r_gene_name").agg(F.count(F.lit(1)).cast("int").alias("n"))
    sets = counts.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("r_gene_id", "r_gene_name", "n"))).alias("g"))
    of = lambda c: F.transform("g", lambda x: F.struct(x[c].alias("value"), x["n"].alias("n")))
    return clusters.join(sets.select("_id", of("r_gene_name").alias("gene_name"), of("r_gene_id").alias("gene_id")), F.col(id_col) == F.col("_id"), "left").drop("_id")


def spelled(counted: Column) -> Column:
    """The values of ``counted_genes``, each as often as it was counted, joined by |; without those that are null."""
    one = lambda x: F.when(x["value"].isNotNull(), F.array_join(F.array_repeat(x["value"], x["n"]), "|"))
    return F.array_join(F.transform(counted, one), "|")


def gene_overlaps(clusters: DataFrame, genes: DataFrame, *, id_col: str = "cluster_id") -> DataFrame:
    """``clusters`` with gene_name and gene_id of all genes that overlap, sorted by id and joined by |, or null."""
    return counted_genes(clusters, genes, id_col=id_col).withColumns({c: spelled(F.col(c)) for c in ("gene_name", "gene_id")})


def genes_with_kept(gtf: DataFrame, types: tuple[str, ...], *, level: int | None = None) -> DataFrame:
    """GTF rows (feature, gene_id, kind, support) of these kinds and at most that level of support, with the rows of their genes."""
    good = F.col("kind").isin(*types) & (F.col("feature") != "gene")
    kept = gtf.where(good if level is None else good & (F.col("support").try_cast("int") <= level))
    return gtf.where("feature = 'gene'").join(kept.select("gene_id").distinct(), "gene_id", "left_semi").select(*gtf.columns).unionByName(kept)


def sorted_for_lookup(rows: DataFrame, *, chromosome: str = "chr", start: str = "s", partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted by place, so that a written table's statistics find a locus without an index."""
    by = [chromosome, start]
    return (rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)).sortWithinPartitions(*by)


def lines_with(lines: DataFrame, column: int, wanted: str) -> DataFrame:
    """Lines (value) whose field number ``column`` (from 1, between white space) equals ``wanted``."""
    return lines.where(F.get(F.split(F.trim("value"), r"\s+"), F.lit(column - 1)) == wanted)
