"""Writers: tracks, per-sample clusters, sorted tables.  Each ``*_rows`` gives the rows; ``write_*`` partitions and writes them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailmap.functions.sequence import fixed


def cluster_bed_rows(clusters: DataFrame, per_sample: DataFrame, *, id_col: str = "cluster_id") -> DataFrame:
    """Eleven columns for every cluster and sample, and for the sample ``atlas`` with the total.

    clusters: id, chr, strand, start1, end, rep, total_tpm, frac_samples, nr_prots, annotation, pas; per_sample: id, sample, tpm.
    Clusters with no tpm in a sample are kept where ``per_sample`` has them.
    """
    whole = clusters.select(id_col, F.lit("atlas").alias("sample"), F.col("total_tpm").alias("tpm"))
    rows = per_sample.select(id_col, "sample", "tpm").unionByName(whole).join(clusters, id_col)
    return rows.select(
        "sample", "chr", (F.col("start1") - 1).alias("start0"), "end", F.concat_ws(":", "chr", F.col("rep").cast("string"), "strand").alias("name"), fixed(F.col("tpm"), 4).alias("tpm"),
        "strand", fixed(F.col("frac_samples"), 2).alias("frac_samples"), "nr_prots", fixed(F.col("total_tpm"), 4).alias("total_tpm"), "annotation", "pas",
    )


def bedgraph_rows(clusters: DataFrame, per_sample: DataFrame, chromosomes: DataFrame, *, id_col: str = "cluster_id") -> DataFrame:
    """sample, strand, chr (renamed by chromosomes: chr, ucsc), start0, end, tpm > 0; chromosomes without a name go."""
    rows = per_sample.where("tpm > 0").select(id_col, "sample", "tpm").join(clusters.select(id_col, "chr", "strand", "start1", "end"), id_col)
    rows = rows.where(F.col("strand").isin("+", "-")).join(chromosomes, "chr")
    return rows.select("sample", "strand", F.col("ucsc").alias("chr"), (F.col("start1") - 1).alias("start0"), "end", fixed(F.col("tpm"), 4).alias("tpm"))


def track_lines(samples: DataFrame, url: str) -> DataFrame:
    """sample, strand, line: the track line of each sample and strand."""
    both = samples.select("sample", F.explode(F.array(F.lit("plus"), F.lit("minus"))).alias("strand"))
    colour = F.when(F.col("strand") == "plus", "0,0,255").otherwise("255,0,0")
    line = F.format_string(f'track type=bigWig name="%s %s" description="%s, %s strand" visibility="full" color="%s" bigDataUrl="{url}/%s_%s.bw"', "sample", "strand", "sample", "strand", colour, "sample", "strand")
    return both.withColumn("line", line)


def write_tracks(rows: DataFrame, path: str, by: list[str]) -> None:
    """Gzipped, tab separated, one folder a value of ``by``, sorted by place in each file."""
    place = [c for c in ("chr", "start0") if c in rows.columns]
    dealt = rows.repartition(*by, F.substring("chr", 1, 5)) if "chr" in rows.columns else rows.repartition(*by)
    dealt.sortWithinPartitions(*by, *place).write.partitionBy(*by).csv(path, sep="\t", compression="gzip")


def locus_rows(clusters: DataFrame, genes: DataFrame | None = None, per_sample: DataFrame | None = None, labels: DataFrame | None = None, *, id_col: str = "cluster_id") -> DataFrame:
    """Clusters that are no candidates for internal priming, in the columns of the locus search.

    genes (id, gene_name, gene_id; as text, or counted, to be spelled out behind a sort) adds names; per_sample (id, sample, tpm) and labels (sample, label) add a column for each
    sample, under its label: as many as the sheet has.
    """
    rows = clusters.where(~F.col("is_ip_candidate"))
    more = []
    if genes is not None:
        rows, more = rows.join(genes.select(id_col, "gene_name", "gene_id"), id_col, "left"), ["gene_name", "gene_id"]
    if per_sample is not None:
        names = [r.label for r in labels.orderBy("sample").collect()]  # the sample sheet
        wide = per_sample.join(labels, "sample").groupBy(id_col).pivot("label", names).agg(F.sum("tpm"))
        rows, more = rows.join(wide, id_col, "left").fillna(0.0, names), [*more, *[f"`{n}`" for n in names]]
    return rows.select("chr", F.col("start1").alias("start"), "end", F.concat_ws(":", "chr", F.col("rep").cast("string"), "strand").alias("name"), "total_tpm", "strand", *more)


def described_samples(samples: DataFrame) -> DataFrame:
    """sample, label: id, protocol, source, title and treatment joined by |, blanks left out by name only."""
    return samples.select("sample", F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in ("sample", "protocol", "source", "title", "treatment")]).alias("label"))


def write_sheet(sheet: DataFrame, path: str) -> None:
    """A sample sheet as tab separated text with a header; one row a sample, so one file."""
    sheet.coalesce(1).sortWithinPartitions(sheet.columns[0]).write.csv(path, sep="\t", header=True)
