"""Whole pipelines: reads on the genome to sites, and sites of many samples to an annotated atlas."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailmap.functions import sequence as S
from tailmap.operators import alignments, clusters, intervals, sites, support
from tailmap.operators.lineage import stored
from tailmap.plans.protocols import correction_of
from tailmap.sources.sinks import bedgraph_rows

# The hexamers that signal polyadenylation.
SIGNALS = ("AATAAA", "ATTAAA", "TATAAA", "AGTAAA", "AATACA", "CATAAA", "AATATA", "GATAAA", "AATGAA", "AATAAT", "AAGAAA", "ACTAAA", "AATAGA", "ATTACA", "AACAAA", "ATTATA", "AACAAG", "AATAAG")


@dataclass(frozen=True)
class Settings:
    """Parameters of the two pipelines."""

    excluded: tuple[str, ...] = ("MT",)
    female: str = "Y"
    least_match: int = 4
    ip_upstream: int = 60
    ip_downstream: int = 10
    ip_total: int = 7
    ip_consecutive: int = 6
    ip_patterns: tuple[str, ...] = ()
    ip_patterns_3reads: tuple[str, ...] = ("AGAA", "AA")
    signals: tuple[str, ...] = SIGNALS
    pas_upstream: int = 59
    pas_downstream: int = 10
    cutoff: float = 90.0
    mini_window: int = 25
    cluster_window: int = 12
    max_cluster: int = 25
    least_distance: int = 15
    ds_range: int = 1000


# The keys of a settings file, and the field of ``Settings`` that each gives.
SETTING_KEYS = {
    "excluded_chr": "excluded",
    "female_chr": "female",
    "min_3p_align": "least_match",
    "IP.upstream_region": "ip_upstream",
    "IP.downstream_region": "ip_downstream",
    "IP.total_As": "ip_total",
    "IP.consecutive_As": "ip_consecutive",
    "IP.downstream_patterns": "ip_patterns",
    "IP.downstream_patterns.3READS": "ip_patterns_3reads",
    "polyA_signals": "signals",
    "sample.BG_polyAsignal_cutoff": "cutoff",
    "CL.max_cluster_size": "max_cluster",
    "CL.min_dist_to_PAS": "least_distance",
    "ds_range": "ds_range",
}
#: Windows that reach as far up as down: both keys must agree.
WINDOW_KEYS = {"mini_window": ("sample.BG_upstream_clustering", "sample.BG_downstream_clustering"), "cluster_window": ("CL.upstream_clustering", "CL.downstream_clustering")}


def settings_of(config: dict[str, object]) -> Settings:
    """``Settings`` of what ``read_settings`` has read; keys that are not there keep their defaults, those of other tools are left out.

    Numbers must not be negative, the cutoff is a percentage, and lists hold text; all else is an error.
    """
    found: dict[str, object] = {SETTING_KEYS[k]: v for k, v in config.items() if k in SETTING_KEYS}
    for field, keys in WINDOW_KEYS.items():
        values = {config[k] for k in keys if k in config}
        if len(values) > 1:
            raise ValueError(f"{' and '.join(keys)} differ")
        found |= {field: v for v in values}
    default = Settings()
    for field, value in found.items():
        kind = type(getattr(default, field))
        if kind is tuple:
            listed = [] if value is None else value if isinstance(value, list) else [value]
            if not all(isinstance(x, str | int) for x in listed):
                raise ValueError(f"{field} is no list of text: {value}")
            found[field] = tuple(str(x) for x in listed)
        elif kind is str:
            found[field] = str(value)
        elif isinstance(value, bool) or not isinstance(value, int | float) or value < 0 or (kind is int and value != int(value)):
            raise ValueError(f"{field} is no such number as it should be: {value}")
        else:
            found[field] = kind(value)
    if found.get("cutoff", 0.0) > 100:
        raise ValueError(f"the cutoff is a percentage: {found['cutoff']}")
    return replace(default, **found)


def chromosome_names(spark: SparkSession, config: dict[str, object]) -> DataFrame:
    """chr, ucsc: the names of chromosomes in tracks, of the map ``chromosome_names``; an error without it."""
    names = config.get("chromosome_names")
    if not isinstance(names, dict) or not names:
        raise ValueError("the settings have no map chromosome_names")
    return spark.createDataFrame([(str(k), str(v)) for k, v in names.items()], "chr string, ucsc string")


def atlas_tracks(atlas: DataFrame, config: dict[str, object]) -> DataFrame:
    """The bedGraph rows of all samples of an atlas, chromosomes named as the settings say."""
    return bedgraph_rows(atlas, per_sample(atlas), chromosome_names(atlas.sparkSession, config))


def chunks_of(genome: DataFrame) -> DataFrame:
    """A genome as chunks: of ``read_genome`` as it is, of whole sequences (chr, seq) cut."""
    return genome if "chunk" in genome.columns else sites.chunked(genome)


def reads_to_sites(bed: DataFrame, samples: DataFrame, genome: DataFrame, settings: Settings = Settings(), *, protocol: str | None = None) -> DataFrame:
    """chr, strand, pos, sample, cnt, is_ip of mapped reads (chr, start0, end, read_id, strand, mmid, sample) of one protocol."""
    unique = alignments.unique_mappers(bed.withColumn("_read", F.struct("sample", "read_id")), read="_read").drop("_read")
    kept = sites.exclude_chromosomes(unique, samples, excluded=settings.excluded, female=settings.female)
    found = sites.three_prime_ends(kept, correction=correction_of(protocol), strict=True, least=settings.least_match)
    s, e = S.window(F.col("pos") - 1, F.col("pos"), F.col("strand"), settings.ip_upstream, settings.ip_downstream)
    flanked = sites.fetch_windows(found, chunks_of(genome), s, e)
    patterns = settings.ip_patterns_3reads if protocol == "3'READS" else settings.ip_patterns
    return sites.mark_internal_priming(flanked, upstream=settings.ip_upstream, downstream=settings.ip_downstream, total_as=settings.ip_total, consecutive_as=settings.ip_consecutive, patterns=patterns)


def sam_to_sites(sam: DataFrame, sample: str, protocol: str, samples: DataFrame, genome: DataFrame, settings: Settings = Settings(), *, lifted: DataFrame | None = None) -> DataFrame:
    """Sites of one sample's alignments on the genome, with those lifted from transcripts (columns of SAM) beside them.

    Of every read the distinct alignments with the least edit distance count; reads with more than one go.
    """
    hits = sam if lifted is None else sites.union_all(sam, lifted.drop("status"))
    best = alignments.best_alignments(alignments.distinct_alignments(hits))
    return reads_to_sites(alignments.sam_to_bed(best).withColumn("sample", F.lit(sample)), samples, genome, settings, protocol=protocol)


def site_signals(found: DataFrame, genome: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """chr, strand, pos, pas of the distinct sites."""
    one = found.select(*sites.SITE).distinct()
    s, e = S.window(F.col("pos") - 1, F.col("pos"), F.col("strand"), settings.pas_upstream, settings.pas_downstream)
    read = sites.fetch_windows(one, chunks_of(genome), s, e)
    return read.select(*sites.SITE, S.polya_signals(F.col("flank"), F.col("pos"), F.col("strand"), settings.signals, upstream=settings.pas_upstream).alias("pas"))


def sites_to_atlas(found: DataFrame, samples: DataFrame, genome: DataFrame, exons: DataFrame, n_samples: int, settings: Settings = Settings()) -> DataFrame:
    """Merged clusters with annotation, support and per-sample tpm, of the sites of all samples."""
    found = stored(found, "sites")
    genuine = found.where(~F.col("is_ip"))
    signals = stored(site_signals(genuine, genome, settings), "signals")
    sizes = sites.library_sizes(found)
    marked = genuine.join(signals.select(*sites.SITE, (F.size("pas") > 0).alias("has_pas")), list(sites.SITE))
    clean = clusters.above_background(marked, upstream=settings.mini_window, downstream=settings.mini_window, cutoff=settings.cutoff)
    backed = sites.site_support(sites.tpm(clean.drop("has_pas"), sizes), n_samples)
    primary = clusters.primary_clusters(backed, upstream=settings.cluster_window, downstream=settings.cluster_window, pas=signals)
    merged = clusters.merge_clusters(primary, least_distance=settings.least_distance, most=settings.max_cluster, split_gap=max(100, 4 * settings.max_cluster))
    named = stored(merged, "merged").withColumns({"cluster_id": F.concat_ws(":", "chr", F.col("rep").cast("string"), "strand"), "s": F.col("start1") - 1, "e": F.col("end")})
    annotated = stored(intervals.annotate(named, intervals.feature_model(exons, ds_range=settings.ds_range)), "annotated")
    backing = support.cluster_support(per_sample(annotated), samples)
    return annotated.drop("s", "e").join(backing, "cluster_id", "left")


def per_sample(atlas: DataFrame) -> DataFrame:
    """cluster_id, sample, tpm."""
    return atlas.select("cluster_id", F.explode("tpm").alias("sample", "tpm"))
