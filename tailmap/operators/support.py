"""Support of clusters across samples, summaries of an atlas, and documents of results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Annotations in the order of a summary.
ANNOTATIONS = ("TE", "EX", "IN", "DS", "AE", "AI", "AU", "IG")


def cluster_support(per_sample: DataFrame, samples: DataFrame, *, by: Sequence[str] = ("cluster_id",)) -> DataFrame:
    """Per cluster: frac_samples with tpm > 0 among all samples, nr_prots, the number of their protocols.

    per_sample: the cluster's key, sample, tpm; samples: sample, protocol (a row a sample).  Samples without a row have no tpm.
    """
    n = samples.select(F.count(F.lit(1)).alias("n_samples"))  # one row
    seen = per_sample.where("tpm > 0").join(samples.select("sample", "protocol"), "sample").groupBy(*by).agg(F.count_distinct("sample").alias("k"), F.count_distinct("protocol").alias("nr_prots"))
    every = per_sample.select(*by).distinct().join(seen, list(by), "left")
    return every.select(*by, (F.coalesce("k", F.lit(0)) / n.scalar()).alias("frac_samples"), F.coalesce("nr_prots", F.lit(0)).cast("int").alias("nr_prots"))


def annotation_histogram(clusters: DataFrame) -> DataFrame:
    """annotation, clusters: with a row for each annotation, zero or not."""
    names = clusters.sparkSession.createDataFrame([(a,) for a in ANNOTATIONS], "annotation string")
    return names.join(clusters.groupBy("annotation").agg(F.count(F.lit(1)).alias("clusters")), "annotation", "left").fillna(0, ["clusters"])


def atlas_statistics(clusters: DataFrame) -> DataFrame:
    """clusters, with_pas (those with a signal), percent (whole)."""
    return clusters.agg(F.count(F.lit(1)).alias("clusters"), F.count_if("has_pas").alias("with_pas")).withColumn(
        "percent", F.when(F.col("clusters") > 0, F.floor(F.col("with_pas") * 100 / F.col("clusters"))).otherwise(0).cast("long")
    )


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``current`` with the values of ``incoming`` where keys agree and a value is given, and its new rows.

    A key that occurs twice in ``current`` is an error when the result is read.
    """
    values = [c for c in current.columns if c not in keys]
    counted = current.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    once = counted.withColumn("_ok", F.assert_true(F.col("_n") == 1, F.lit("a key occurs more than once"))).where(F.col("_ok").isNull()).drop("_n", "_ok")
    new = incoming.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(v).alias(f"_{v}") for v in values])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    condition = same[0]
    for c in same[1:]:
        condition &= c
    return once.join(new, condition, "full_outer").select(*[F.coalesce(f"_{c}", c).alias(c) for c in current.columns])


def insert_absent(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` and the rows of ``incoming`` whose keys it has not."""
    return current.unionByName(incoming.join(current.select(*keys).distinct(), list(keys), "left_anti").select(*current.columns))


def with_genome_level(key: Column, genome: str) -> Column:
    """A dotted key with the genome's name before its last part, unless a part is ``raw``."""
    parts = F.split(F.rtrim(key, F.lit(":")), r"\.")
    n = F.size(parts)
    placed = F.concat(F.slice(parts, F.lit(1), n - 1), F.array(F.lit(genome)), F.slice(parts, n, F.lit(1)))
    return F.array_join(F.when(F.array_contains(parts, "raw"), parts).otherwise(placed), ".")


def longest_read(protocol: Column, read_length: Column, shortening: int = 5) -> Column:
    """The most letters of a valid read, by protocol: what its fixed pattern takes off, or ``shortening`` where reads must end."""
    # Lengths of the patterns.
    less = F.when(protocol == "A-seq2", 7).when(protocol == "3'READS", 6).when(protocol == "3P-Seq", 2).when(protocol.isin("A-seq", "3'-Seq (Mayr)"), shortening).otherwise(0)
    return read_length - less


def nested_documents(metrics: DataFrame, genome: str, fields: DataFrame | None = None) -> DataFrame:
    """sample, document: nested JSON of dotted keys (sample, key, value), with ``fields`` (sample, key, text) beside them.

    Keys of up to six parts are nested, a level at a time, each by one aggregation; what a longer key has more stays together.
    """
    entries = metrics.select("sample", with_genome_level(F.col("key"), genome).alias("key"), F.col("value").cast("string").alias("json")).distinct()
    if fields is not None:
        entries = entries.unionByName(fields.select("sample", "key", F.to_json(F.struct("text")).alias("json")).select("sample", "key", F.regexp_extract("json", r'^\{"text":(.*)\}$', 1).alias("json")))
    part = F.split("key", r"\.", 6)
    names = [f"p{i}" for i in range(6)]
    rows = entries.select("sample", *[F.get(part, F.lit(i)).alias(n) for i, n in enumerate(names)], "json")
    # An object is its members in order of their names, joined.
    for depth in reversed(range(6)):
        by = ["sample", *names[:depth]]
        member = F.when(F.col(names[depth]).isNotNull(), F.concat(F.lit('"'), F.col(names[depth]), F.lit('":'), F.col("json")))
        rows = rows.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(member)), ",").alias("members"), F.max(F.when(F.col(names[depth]).isNull(), F.col("json"))).alias("leaf"))
        rows = rows.withColumn("json", F.when(F.col("members") != "", F.concat(F.lit("{"), F.col("members"), F.lit("}"))).otherwise(F.col("leaf"))).drop("members", "leaf")
    return rows.select("sample", F.col("json").alias("document"))


# The counters of a sample's document before anything is counted.
_PLUS_MINUS = {"plus": 0, "minus": 0}
_UNIQUE = {"md5sum": "", "nr": 0}
_SITES = {"internalpriming": {"md5sum": "", "number": _PLUS_MINUS, "reads": _PLUS_MINUS}, "md5sum": "", "number": _PLUS_MINUS, "reads": _PLUS_MINUS}
SKELETON = {
    "reads": {
        "raw": {"nr": 0, "md5sum": "", "length": {"max": 0, "min": 0}},
        "trimmed": {"nr": 0, "md5sum": "", "md5sumcollapsed": "", "md5sumNoPolyA": "", "md5sum5p": "", "length": {"max": 0, "min": 0}},
        "genome": {"uniqueMappers": _UNIQUE, "multiMappers": _UNIQUE},
        "mapped": {"uniqueMappers": _UNIQUE},
        "transcriptome": {"uniqueMappers": _UNIQUE},
        "valid": {"nr": 0, "md5sum": "", "cutoffs": {"maxLength": 0, "maxAs": 0.8, "maxNs": 2}},
    },
    "sites": {"all": _SITES, "highconfidence": _SITES},
    "visible": True,
    "pairedEnd": False,
}
# The keys of a document that are columns of the sample sheet.
SHEET_KEYS = {
    "GEOseriesID": "series_id",
    "PubMedID": "pubmed",
    "title": "title",
    "organism": "organism",
    "sex": "sex",
    "adaptor3p": "threeAdapter",
    "adaptor5p": "fiveAdapter",
    "protocol": "protocol",
    "tobereversed": "reverse_compl",
    "source": "source",
    "treatment": "treatment",
}


def _as_struct(value: object) -> Column:
    return F.struct(*[_as_struct(v).alias(k) for k, v in value.items()]) if isinstance(value, dict) else F.lit(value)


def skeleton_documents(samples: DataFrame, genome: str) -> DataFrame:
    """sample, document: the nested JSON of samples for a genome before anything is counted.

    samples: sample, and the columns of the sheet; those that are missing are null in the document.  A column
    sample_genome_id is taken as it is; without it, it is the sample and the genome.
    """
    of_sheet = [(F.col(c) if c in samples.columns else F.lit(None).cast("string")).alias(k) for k, c in SHEET_KEYS.items()]
    own = F.col("sample_genome_id") if "sample_genome_id" in samples.columns else F.concat_ws("_", "sample", F.lit(genome))
    ids = [F.col("sample").alias("GEOsampleID"), own.alias("sample_genome_id"), F.lit(genome).alias("genome")]
    counters = [_as_struct(v).alias(k) for k, v in SKELETON.items()]
    whole = F.struct(*ids, *of_sheet, *counters, F.array().cast("array<string>").alias("log"))
    return samples.select("sample", F.to_json(whole, {"ignoreNullFields": "false"}).alias("document"))


def documents(metrics: DataFrame, genome: str) -> DataFrame:
    """sample, document: one JSON object of dotted keys per sample, of metrics (sample, key, value)."""
    entry = F.struct(with_genome_level(F.col("key"), genome).alias("key"), "value")
    return metrics.groupBy("sample").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_set(entry)))).alias("document"))
