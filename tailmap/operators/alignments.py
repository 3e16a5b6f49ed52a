"""Alignments: dedup, best and unique hits, lifting from transcripts to the genome, and conversion to intervals.

Columns: qname, flag, rname, pos (1-based), mapq, cigar, seq, qual, nm, md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tailmap.functions import sequence as S
from tailmap.functions import strings as X

PLACE = ("qname", "flag", "rname", "pos", "cigar")


def distinct_alignments(sam: DataFrame) -> DataFrame:
    """One of each (qname, flag, rname, pos, cigar): the one with the smallest edit distance, then md."""
    order = W.partitionBy(*PLACE).orderBy(*[F.col(c).asc_nulls_last() for c in ("nm", "md", "seq") if c in sam.columns])
    return sam.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def best_alignments(sam: DataFrame, *, keep_mm: int | None = 0) -> DataFrame:
    """Alignments with the least edit distance of their read, with nh, how many these are.

    keep_mm: None keeps reads with one such alignment, 0 all, k those with at most k.
    """
    read = W.partitionBy("qname")
    best = sam.withColumn("_least", F.min("nm").over(read)).where(F.col("nm") == F.col("_least")).drop("_least")
    best = best.withColumn("nh", F.count(F.lit(1)).over(read))
    return best if keep_mm == 0 else best.where(F.col("nh") <= (keep_mm or 1))


def multimap_report(best: DataFrame, *, more_than: int = 1) -> DataFrame:
    """qname, n of the reads with more best alignments; of ``keep_mm=k`` those beyond k are the heavy ones that it drops."""
    return best.groupBy("qname").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)


def unique_mappers(rows: DataFrame, *, read: str = "read_id") -> DataFrame:
    """Rows of the reads that occur once."""
    return rows.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(read))).where("_n = 1").drop("_n")


def mapped_counts(rows: DataFrame, *, read: str = "read_id", by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Per sample: mapped (distinct reads), unique (reads with one alignment), multi."""
    per = rows.groupBy(*by, read).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(*by).agg(F.count(F.lit(1)).alias("mapped"), F.count_if(F.col("n") == 1).alias("unique"), F.count_if(F.col("n") > 1).alias("multi"))


def sam_to_bed(sam: DataFrame) -> DataFrame:
    """chr, start0, end, read_id, nm, strand, mmid; alignments without an md string have no mmid."""
    start = F.col("pos").cast("long") - 1
    return sam.select(
        F.col("rname").alias("chr"), start.alias("start0"), (start + S.reference_length(F.col("cigar"))).alias("end"), F.col("qname").alias("read_id"), "nm",
        S.strand_of(F.col("flag")).alias("strand"), X.mmid(F.col("cigar"), F.col("md"), F.col("seq")).alias("mmid"),
    )


def exon_model(exons: DataFrame) -> DataFrame:
    """Exons (chr, start0, end, transcript_id, strand) in the order of transcription: n, exons, length, cum_length, intron before."""
    transcript = W.partitionBy("transcript_id")
    order = transcript.orderBy(F.when(F.col("strand") == "-", -F.col("start0")).otherwise(F.col("start0")))
    gap = F.when(F.col("strand") == "-", F.lag("start0").over(order) - F.col("end")).otherwise(F.col("start0") - F.lag("end").over(order))
    return exons.withColumns(
        {
            "n": F.row_number().over(order),
            "exons": F.count(F.lit(1)).over(transcript).cast("int"),
            "length": F.col("end") - F.col("start0"),
            "cum_length": F.sum(F.col("end") - F.col("start0")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)),
            "intron": gap,
        }
    )


def lift_alignments(sam: DataFrame, exons: DataFrame, *, least_overlap: int = 1, stranded: bool = True, monoexonic: bool = False) -> DataFrame:
    """Transcript alignments on the genome: ``sam`` with rname, pos, flag, cigar, seq, qual, md there, and a status.

    status: lifted, or why not: reverse_complemented, not_found, no_junction, below_min_overlap; the latter keep their columns.
    Transcripts become one row each, an array of exons; an alignment meets its own by an equi-join.
    """
    part = F.struct("n", "start0", "end", "length", "cum_length", "intron")
    table = exon_model(exons).groupBy("transcript_id").agg(F.first("chr").alias("t_chr"), F.first("strand").alias("t_strand"), F.array_sort(F.collect_list(part)).alias("t_exons"))
    joined = sam.join(table, sam["rname"] == table["transcript_id"], "left").drop("transcript_id")
    joined = joined.withColumn("t_end", F.col("pos") + S.reference_length(F.col("cigar")) - 1)
    # Exons that the alignment overlaps, each with how much.
    over = F.filter("t_exons", lambda x: (x["cum_length"] >= F.col("pos")) & (x["cum_length"] - x["length"] < F.col("t_end")))
    joined = joined.withColumn("t_over", F.transform(over, lambda x: F.struct((F.least(x["cum_length"], F.col("t_end")) - F.greatest(x["cum_length"] - x["length"] + 1, F.col("pos")) + 1).alias("overlap"), x["intron"].alias("intron"), x["start0"].alias("start0"), x["end"].alias("end"), x["cum_length"].alias("cum"), x["length"].alias("length"))))
    first, last, n = F.get("t_over", F.lit(0)), F.get("t_over", F.size("t_over") - 1), F.size("t_over")
    outside = F.col("t_chr").isNull() | (n < 1) | (last["cum"] < F.col("t_end"))
    status = (
        F.when(S.on_reverse_strand(F.col("flag")) & F.lit(stranded), "reverse_complemented")
        .when(F.col("t_chr").isNull(), "not_found")
        .when((F.size("t_exons") == 1) & ~F.lit(monoexonic), "no_junction")
        .when((n == 1) & ~outside & ~F.lit(monoexonic), "no_junction")
        .when((n > 1) & (first["overlap"] < least_overlap), "below_min_overlap")
        .when(outside, "not_found")
        .when((n > 1) & (last["overlap"] < least_overlap), "below_min_overlap")
        .otherwise("lifted")
    )
    minus = F.col("t_strand") == "-"
    # On either strand the genomic start is where the outermost overlap begins.
    start = F.when(minus, last["end"] - (F.col("t_end") - (last["cum"] - last["length"])) + 1).otherwise(first["end"] - (first["cum"] - F.col("pos")))
    flat = F.flatten(F.transform("t_over", lambda x, i: F.when(i == 0, F.array(x["overlap"])).otherwise(F.array(x["intron"], x["overlap"]))))
    ready = joined.withColumns({"status": status, "t_start": start, "t_parts": F.when(minus, F.reverse(flat)).otherwise(flat)})
    ok = F.col("status") == "lifted"
    turned = ok & minus
    new = {
        "rname": F.when(ok, F.col("t_chr")).otherwise(F.col("rname")),
        "pos": F.when(ok, F.col("t_start")).otherwise(F.col("pos")).cast("long"),
        "flag": F.when(turned, F.when(F.col("flag") == 0, 16).otherwise(0)).otherwise(F.col("flag")),
        "cigar": F.when(ok, X.genomic_cigar(F.col("cigar"), F.col("t_strand"), F.col("t_parts"))).otherwise(F.col("cigar")),
        "seq": F.when(turned, S.reverse_complement(F.col("seq"))).otherwise(F.col("seq")),
        "qual": F.when(turned, F.reverse("qual")).otherwise(F.col("qual")),
        "md": F.when(turned, X.reverse_md(F.col("md"))).otherwise(F.col("md")),
    }
    return ready.withColumns({k: v for k, v in new.items() if k in sam.columns}).select(*sam.columns, "status")


def lift_report(lifted: DataFrame) -> DataFrame:
    """status, alignments, percent."""
    n = F.count(F.lit(1))
    return lifted.groupBy("status").agg(n.alias("alignments")).withColumn("percent", F.col("alignments") * 100.0 / F.sum("alignments").over(W.partitionBy()))
