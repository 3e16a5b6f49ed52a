"""3' end sites: counting, pooling, normalization, internal priming, background.

Sites stay in long form, a row for each site and sample (chr, strand, pos, sample, cnt); a row that is missing is a count of
zero.  Only a sink pivots, with the list of samples given, so that no pass looks for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tailmap.functions import sequence as S
from tailmap.operators.lineage import stored

SITE = ("chr", "strand", "pos")


def exclude_chromosomes(rows: DataFrame, samples: DataFrame, *, excluded: Sequence[str] = ("MT",), female: str = "Y") -> DataFrame:
    """Rows but those on excluded chromosomes, to which the female one counts unless the sample's sex is F, when only others do.

    samples (sample, sex) is the sample sheet, a row a sample.
    """
    lists = samples.select("sample", F.explode(F.when(F.col("sex") == "F", F.array(*[F.lit(c) for c in dict.fromkeys([*excluded, female])])).otherwise(F.array(*[F.lit(c) for c in excluded if c != female]).cast("array<string>"))).alias("chr"))
    return rows.join(lists, ["sample", "chr"], "left_anti")


def three_prime_ends(bed: DataFrame, *, correction: int = 0, strict: bool = False, least: int = 4, names: bool = False) -> DataFrame:
    """chr, strand, pos, sample, cnt of reads (chr, start0, end, read_id, strand, sample, mmid where strict); with read names if asked."""
    kept = bed.where(S.anchored(F.col("mmid"), F.col("strand"), least)) if strict else bed
    pos = S.three_prime_position(F.col("start0"), F.col("end"), F.col("strand"), correction)
    more = [F.array_join(F.array_sort(F.collect_list(F.col("read_id").cast("string"))), ",").alias("reads")] if names else []
    return kept.groupBy("chr", "strand", pos.cast("long").alias("pos"), "sample").agg(F.count(F.lit(1)).alias("cnt"), *more)


def chromosome_rank(chromosome: Column) -> Column:
    """The order of chromosomes in files: numbers, X, Y, then others."""
    number = F.regexp_extract(chromosome, r"^(?:chr)?(\d{1,3})$", 1).try_cast("int")
    return F.coalesce(number, F.when(F.regexp_replace(chromosome, "^chr", "") == "X", 1001).when(F.regexp_replace(chromosome, "^chr", "") == "Y", 1002), F.lit(1003))


def numbered_sites(sites: DataFrame, partitions: int | None = None) -> DataFrame:
    """``sites`` with idx, from 1, in the order of files: chromosomes, the + strand first, positions.

    Ranges are sorted side by side; only how many rows each has (a row a range) is summed in one place.
    """
    order = [chromosome_rank(F.col("chr")), F.col("chr"), F.when(F.col("strand") == "+", 0).otherwise(1), F.col("pos"), *[F.col(c) for c in ("sample",) if c in sites.columns]]
    dealt = sites.repartitionByRange(partitions, *order) if partitions else sites.repartitionByRange(*order)
    placed = dealt.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    # Stored, so that what is read again has the same numbers even if executors are lost.
    placed = stored(placed, "placed-sites")
    part = F.shiftright("_at", 33)
    begin = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_begin"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(begin), "_part")  # a row a range
    return numbered.withColumn("idx", F.col("_begin") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_part", "_at", "_begin")


def union_all(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Rows of all tables, repeats kept; columns by name, null where a table has none."""
    for rows in more:
        first = first.unionByName(rows, allowMissingColumns=True)
    return first


def chrom_sizes(genome: DataFrame) -> DataFrame:
    """chr, size of a genome (chr, seq)."""
    return genome.groupBy("chr").agg(F.max(F.length("seq")).cast("long").alias("size"))


def library_sizes(sites: DataFrame) -> DataFrame:
    """sample, libsize: counts of sites that are not primed internally (is_ip may be missing)."""
    rows = sites.where(~F.coalesce("is_ip", F.lit(False))) if "is_ip" in sites.columns else sites
    return rows.groupBy("sample").agg(F.sum("cnt").alias("libsize"))


def pool(sites: DataFrame, samples: Sequence[str]) -> DataFrame:
    """chr, strand, pos and a column of counts for each sample, zero where it has none."""
    rows = sites.where(~F.coalesce("is_ip", F.lit(False))) if "is_ip" in sites.columns else sites
    return rows.groupBy(*SITE).pivot("sample", list(samples)).agg(F.sum("cnt")).fillna(0, list(samples))


def tpm(sites: DataFrame, sizes: DataFrame) -> DataFrame:
    """Sites with tpm, the count in a million of the sample's library as it was before any filter, to six places.

    The sizes, a row a sample, go to all tasks: sites dealt by sample would be in as many tasks as there are samples.
    """
    return sites.join(F.broadcast(sizes), "sample").withColumn("tpm", F.round(F.col("cnt") * 1e6 / F.col("libsize"), 6)).drop("libsize")


def site_support(sites_tpm: DataFrame, n_samples: int) -> DataFrame:
    """chr, strand, pos, n_supported, mean_tpm over all samples, and per (array of sample, tpm).

    Means are rounded to nine places: sums in another order must not change how sites rank.
    """
    return sites_tpm.where("cnt > 0").groupBy(*SITE).agg(
        F.count(F.lit(1)).alias("n_supported"), F.round(F.sum("tpm") / n_samples, 9).alias("mean_tpm"), F.array_sort(F.collect_list(F.struct("sample", "tpm"))).alias("per")
    )


def strand_counts(sites: DataFrame, *, only_ip: bool = False) -> DataFrame:
    """Per sample: sites and reads on either strand; what is not + counts as minus."""
    rows = sites.where("is_ip") if only_ip else sites
    plus = F.coalesce(F.col("strand") == "+", F.lit(False))
    return rows.groupBy("sample").agg(
        F.count_if(plus).alias("plus_sites"), F.count_if(~plus).alias("minus_sites"), F.sum(F.when(plus, F.col("cnt")).otherwise(0)).alias("plus_reads"), F.sum(F.when(~plus, F.col("cnt")).otherwise(0)).alias("minus_reads")
    )


def mark_internal_priming(sites_with_flank: DataFrame, **options: object) -> DataFrame:
    """Sites with is_ip, from their column ``flank``, which goes."""
    return sites_with_flank.withColumn("is_ip", S.internal_priming(F.col("flank"), **options)).drop("flank")


def chunked(genome: DataFrame, *, size: int = 65_536, overlap: int = 256) -> DataFrame:
    """chr, chunk, part of a genome (chr, seq): pieces of ``size`` letters and the ``overlap`` letters that follow.

    A sequence is one value here; ``read_genome`` gives the same rows straight from files.
    """
    last = F.when(F.length("seq") > 0, ((F.length("seq") - 1) / size).cast("int"))
    # The pieces are cut before they are unfolded, so that a sequence is not carried along for each of them.
    pieces = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(k.alias("chunk"), F.substring("seq", k * size + 1, F.lit(size + overlap)).alias("part")))
    return genome.select("chr", F.explode(pieces).alias("piece")).select("chr", "piece.chunk", "piece.part")


def fetch_windows(rows: DataFrame, chunks: DataFrame, start: Column, end: Column, *, out: str = "flank", size: int = 65_536, overlap: int = 256) -> DataFrame:
    """``rows`` (chr, strand) with the sequence in [start, end), reverse-complemented on the minus strand, in capitals.

    Null where the window leaves the chromosome.  A window may have ``overlap`` letters at most; it meets its chunk by an
    equi-join, so only the chunk and the row travel.
    """
    asked = rows.withColumns({"_s": start.cast("long"), "_e": end.cast("long")}).withColumn("_chunk", F.when(F.col("_s") >= 0, F.floor(F.col("_s") / size)).cast("int"))
    asked = asked.withColumn("_fit", F.assert_true(F.col("_e") - F.col("_s") <= overlap, F.lit("a window is wider than the chunks overlap"))).drop("_fit")
    # In a chunk of one byte a letter a place is found at once; else letters are counted from the chunk's begin, for every row.
    bytes_ = (F.octet_length("part") == F.length("part")).alias("_bytes")
    found = asked.join(chunks.select(F.col("chr").alias("_c"), F.col("chunk").alias("_k"), "part", bytes_), (F.col("chr") == F.col("_c")) & (F.col("_chunk") == F.col("_k")), "left")
    cut = lambda part: F.substring(part, (F.col("_s") - F.col("_chunk") * size + 1).cast("int"), (F.col("_e") - F.col("_s")).cast("int"))
    text = F.upper(F.when(F.col("_bytes"), cut(F.col("part").cast("binary")).cast("string")).otherwise(cut(F.col("part"))))
    text = F.when(F.length(text) == F.col("_e") - F.col("_s"), F.when(F.col("strand") == "-", S.reverse_complement(text)).otherwise(text))
    return found.withColumn(out, text).drop("_s", "_e", "_chunk", "_c", "_k", "_bytes", "part")


def overwrite_counts(sites: DataFrame, filtered: DataFrame) -> DataFrame:
    """Sites with the counts of ``filtered``; a site that is missing there is zero and goes."""
    return sites.drop("cnt").join(filtered.select(*SITE, "sample", "cnt"), [*SITE, "sample"]).where("cnt > 0")


def supported_sites(sites: DataFrame) -> DataFrame:
    """Sites that some sample counts."""
    return sites.groupBy(*SITE).agg(F.max("cnt").alias("most")).where("most > 0").drop("most")


def noise_free_metrics(sites: DataFrame) -> DataFrame:
    """Per sample: sites, reads, those with a signal (has_pas), and whole percents."""
    per = sites.where("cnt > 0").groupBy("sample").agg(
        F.count(F.lit(1)).alias("sites"), F.sum("cnt").alias("reads"), F.count_if("has_pas").alias("pas_sites"), F.sum(F.when(F.col("has_pas"), F.col("cnt")).otherwise(0)).alias("pas_reads")
    )
    percent = lambda a, b: F.when(F.col(b) > 0, F.floor(F.col(a) * 100 / F.col(b))).otherwise(0).cast("long")
    return per.withColumns({"pas_sites_percent": percent("pas_sites", "sites"), "pas_reads_percent": percent("pas_reads", "reads")})
