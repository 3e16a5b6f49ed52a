"""Readers of text formats as typed DataFrames; gzipped files are read by Spark itself, a task a file."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tailmap.functions.sequence import gtf_attribute
from tailmap.operators.lineage import stored

SHEET = "sample_id string, SRR string, series_id string, source string, sex string, protocol string, readlen int, fiveAdapter string, threeAdapter string, paired boolean, reverse_compl boolean, title string, treatment string, pubmed string"
BED6 = "chr string, start0 long, end long, name string, score double, strand string"
BED7 = "chr string, start0 long, end long, read_id string, nm int, strand string, mmid string"
_GTF = "chr string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The sample sheet, with runs (array) of the comma list SRR."""
    sheet = spark.read.schema(SHEET).csv(path, sep="\t", header=True, comment="#", mode="PERMISSIVE")
    return sheet.withColumn("runs", F.transform(F.split("SRR", ","), lambda r: F.trim(r)))


def read_bed(spark: SparkSession, path: str, schema: str = BED6) -> DataFrame:
    """A BED file without its comments."""
    return spark.read.schema(schema).csv(path, sep="\t", comment="#")


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    """chr, size of a table of chromosomes."""
    return spark.read.schema("chr string, size long").csv(path, sep="\t", comment="#")


def read_pooled(spark: SparkSession, path: str, *, first_count: int = 4) -> DataFrame:
    """chr, strand, pos, sample, cnt (where not zero), libsize of a pooled table in one file or several.

    Its header has a line ``#number;path;library size`` for each column of counts, in their order; the sample's name is the
    path's last part up to its first dot.  first_count: the column of the first count, from 1.  Headers are as many as samples.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    head = lines.where(F.startswith("value", F.lit("#"))).select("file", F.split(F.substring("value", 2, 1 << 20), ";").alias("h"))
    head = head.select("file", F.get("h", F.lit(0)).cast("int").alias("place"), F.substring_index(F.substring_index(F.get("h", F.lit(1)), "/", -1), ".", 1).alias("sample"), F.get("h", F.lit(2)).cast("long").alias("libsize"))
    # Header lines may be numbered in any way: the order counts.
    head = head.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("place", "sample", "libsize"))).alias("samples"))
    rows = lines.where(~F.startswith("value", F.lit("#")) & (F.trim("value") != "")).select("file", F.split("value", r"\s+").alias("f")).join(head, "file")
    counts = F.transform("samples", lambda s, i: F.struct(s["sample"].alias("sample"), F.get("f", i + (first_count - 1)).cast("long").alias("cnt"), s["libsize"].alias("libsize")))
    place = [F.get("f", F.lit(i)).cast(t).alias(n) for i, (n, t) in enumerate((("chr", "string"), ("strand", "string"), ("pos", "long")))]
    return rows.select(*place, F.explode(counts).alias("c")).select("chr", "strand", "pos", "c.sample", "c.cnt", "c.libsize").where("cnt > 0")


def read_sheet_documents(spark: SparkSession, path: str, organism: str) -> DataFrame:
    """The sample sheet's columns of the visible documents (JSON lines) of one organism."""
    schema = "GEOsampleID string, SRR string, GEOseriesID string, organism string, visible boolean, source string, sex string, protocol string, reads struct<raw:struct<length:struct<max:int>>>, adaptor5p string, adaptor3p string, pairedEnd boolean, tobereversed boolean, title string, treatment string, PubMedID string"
    rows = spark.read.schema(schema).json(path).where((F.col("organism") == organism) & F.col("visible"))
    names = {"GEOsampleID": "sample_id", "SRR": "SRR", "GEOseriesID": "series_id", "source": "source", "sex": "sex", "protocol": "protocol", "reads.raw.length.max": "readlen", "adaptor5p": "fiveAdapter", "adaptor3p": "threeAdapter", "pairedEnd": "paired", "tobereversed": "reverse_compl", "title": "title", "treatment": "treatment", "PubMedID": "pubmed"}
    return rows.select(*[F.col(a).alias(b) for a, b in names.items()])


def _setting(text: str, where: str) -> object:
    """A plain value: quoted or bare text, a number, true, false or nothing."""
    text = text.strip()
    if text[:1] in ("'", '"') and text[-1:] == text[:1] and len(text) > 1:
        return text[1:-1]
    known = {"": None, "null": None, "~": None, "true": True, "false": False, "[]": [], "{}": {}}
    if text.lower() in known:
        return known[text.lower()]
    if text[0] in "[{&*!|>%@`'\"":
        raise ValueError(f"{where}: only plain values, lists and maps by indentation are read: {text}")
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def read_settings(path: str) -> dict[str, object]:
    """A settings file: maps of ``key: value`` lines and lists of ``- item`` lines, nested by indentation; keys are text.

    A list may stand as far left as its key.  What this reader does not know, such as maps in lists, is an error with its line.
    """
    with open(path, encoding="utf-8") as file:
        lines = [(k, re.sub(r"(^|\s)#.*", "", x.rstrip("\n")).rstrip()) for k, x in enumerate(file, 1)]
    lines = [(k, len(x) - len(x.lstrip()), x.lstrip()) for k, x in lines if x.strip() and x not in ("---", "...")]

    def is_item(text: str) -> bool:
        return text == "-" or text.startswith("- ")

    def block(at: int, indent: int) -> tuple[object, int]:
        """The map or list whose lines begin at ``indent``, and the place behind it."""
        out: dict[str, object] | list[object] = [] if is_item(lines[at][2]) else {}
        while at < len(lines) and lines[at][1] == indent and is_item(lines[at][2]) == isinstance(out, list):
            number, _, text = lines[at]
            where = f"{path}:{number}"
            if isinstance(out, list):
                if re.match(r"[^'\"]*:(\s|$)", text[1:]) or is_item(text[1:].strip()):
                    raise ValueError(f"{where}: maps and lists in lists are not read: {text}")
                out.append(_setting(text[1:], where))
                at += 1
                continue
            found = re.match(r"""("[^"]*"|'[^']*'|[^:]+?)\s*:(?:\s+(.*))?$""", text)
            if not found:
                raise ValueError(f"{where}: neither a key nor an item: {text}")
            key = str(_setting(found[1], where)) if found[1][0] in "'\"" else found[1]
            if key in out:
                raise ValueError(f"{where}: {key} stands twice")
            at += 1
            below = lines[at] if at < len(lines) else None
            if not found[2] and below and (below[1] > indent or (below[1] == indent and is_item(below[2]))):
                out[key], at = block(at, below[1])
            else:
                out[key] = _setting(found[2] or "", where)
        if at < len(lines) and lines[at][1] > indent:
            raise ValueError(f"{path}:{lines[at][0]}: this line stands too far right: {lines[at][2]}")
        return out, at

    if not lines:
        return {}
    out, at = block(0, lines[0][1])
    if at < len(lines) or not isinstance(out, dict):
        raise ValueError(f"{path}:{lines[min(at, len(lines) - 1)][0]}: this line belongs to no map")
    return out


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF lines with gene_id, gene_name, transcript_id, kind (biotype) and support."""
    rows = spark.read.schema(_GTF).csv(path, sep="\t", comment="#", quote="\u0000")
    of = lambda k: gtf_attribute(F.col("attributes"), k)
    support = F.regexp_extract(of("transcript_support_level"), r"^(\d+)", 1)
    return rows.withColumns({"gene_id": of("gene_id"), "gene_name": of("gene_name"), "transcript_id": of("transcript_id"), "kind": F.coalesce(of("transcript_biotype"), of("gene_biotype")), "support": F.nullif(support, F.lit(""))})


def exons_of(gtf: DataFrame) -> DataFrame:
    """chr, start0, end, transcript_id, strand of the exon lines."""
    return gtf.where("feature = 'exon'").select("chr", (F.col("start") - 1).alias("start0"), "end", "transcript_id", "strand")


def numbered_lines(lines: DataFrame) -> DataFrame:
    """file, n (from 0 in each file), value of the rows file, block, value of text files that may be read in several blocks.

    A task counts within the blocks that it reads; how many lines stand before a block is a running sum over the blocks of its
    file, a row for each.  So the lines are read twice and not shuffled.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for b in batches:
            places = []
            for key in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                last, n = key, n + 1 if key == last else 0
                places.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(places, pa.int64())], names=["file", "block", "value", "n"])

    counts = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"))
    line = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(F.col("file").alias("f"), F.col("block").alias("b"), F.coalesce(F.sum("lines").over(line), F.lit(0)).alias("before"))
    placed = lines.mapInArrow(work, "file string, block long, value string, n long").join(stored(before, "blocks"), (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    return placed.select("file", (F.col("before") + F.col("n")).alias("n"), "value")


def read_fastq(spark: SparkSession, path: str | list[str], *, sample: str | None = None) -> DataFrame:
    """sample, file, read_no (from 1 in each file), seq of FASTQ files; without a sample there is no such column.

    Gzipped files are read whole, others in as many parts as Spark makes of them: see ``numbered_lines``.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    rows = numbered_lines(lines).where(F.col("n") % 4 == 1).select("file", (F.floor(F.col("n") / 4) + 1).alias("read_no"), F.col("value").alias("seq"))
    return rows if sample is None else rows.select(F.lit(sample).alias("sample"), "file", "read_no", "seq")


def read_sheet_runs(spark: SparkSession, path: str | list[str], sheet: DataFrame) -> DataFrame:
    """sample, file, read_no, seq of the runs of all samples in one scan: a file's name is its run.

    sheet: sample_id, runs (array); files that no sample names go.  The plan is the same for any number of samples.
    """
    of_run = sheet.select(F.col("sample_id").alias("sample"), F.explode("runs").alias("run"))
    reads = read_fastq(spark, path).withColumn("run", F.regexp_extract("file", r"([^/]+?)(?:\.fastq|\.fq)?(?:\.gz)?$", 1))
    return reads.join(of_run, "run").select("sample", "file", "read_no", "seq")


def read_runs(spark: SparkSession, runs: dict[str, list[str]]) -> DataFrame:
    """sample, file, read_no, seq of all runs of all samples (sample to the paths of its FASTQ files), one after another."""
    parts = [read_fastq(spark, paths, sample=name) for name, paths in runs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_fasta(spark: SparkSession, path: str, *, trim: str = r"\s") -> DataFrame:
    """id (up to white space, or what ``trim`` matches), seq of FASTA files; records may have several lines."""
    rows = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    first, rest = F.substring_index("value", "\n", 1), F.expr("substring(value, instr(value, '\n') + 1)")
    body = F.when(F.contains("value", F.lit("\n")), F.regexp_replace(rest, r"\s", "")).otherwise(F.lit(""))
    return rows.select(F.regexp_extract(first, rf"^((?:(?!{trim}).)*)", 1).alias("id"), body.alias("seq"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """The eleven fields of SAM lines, tags (map of TAG to its value), and nm, md, nh of them; lines with fewer fields go."""
    rows = spark.read.text(path).where(~F.col("value").rlike(r"^@[A-Za-z]{2}\t")).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 11)
    kinds = ("string", "int", "string", "long", "int", "string", "string", "long", "long", "string", "string")
    names = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
    fields = F.transform(F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.substring(t, F.lit(6), F.length(t)).alias("v")))
    # Of a tag that a line repeats the first counts.
    tags = F.map_from_entries(F.filter(fields, lambda t, i: ~F.exists(F.slice(fields, F.lit(1), i), lambda u: u["k"] == t["k"])))
    typed = rows.select(*[F.get("f", F.lit(i)).cast(k).alias(n) for i, (n, k) in enumerate(zip(names, kinds, strict=True))], tags.alias("tags"))
    return typed.withColumns({"nm": F.col("tags")["NM"].cast("int"), "md": F.col("tags")["MD"], "nh": F.col("tags")["NH"].cast("int")})


def runs_of(sheet: DataFrame) -> DataFrame:
    """sample_id, run, url_path: one row a run, with its place in the public archive's layout (by the accession's length)."""
    run = F.col("run")
    digits = F.length(run) - 3
    folder = F.when(digits <= 6, F.lit("")).otherwise(F.concat(F.lpad(F.substring(run, 10, 10), 3, "0"), F.lit("/")))
    return sheet.select("sample_id", F.explode("runs").alias("run")).withColumn("url_path", F.concat(F.substring(run, 1, 6), F.lit("/"), folder, run, F.lit("/"), run, F.lit(".fastq.gz")))
