"""Readers and writers of small files."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from tailmap.functions import strings as X
from tailmap.operators import reads, support
from tailmap.plans import protocols
from tailmap.sources import sinks, text


def test_pooled_tables(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("#4;/a/b/GSM1.3pSites.bed.gz;100\n#5;/a/GSM2.x.gz;50\nchr1\t+\t7\t3\t0\nchrX\t-\t9\t0\t12\n")
    got = sorted(map(tuple, text.read_pooled(spark, str(tmp_path / "p.tsv")).collect()))
    assert got == [("chr1", "+", 7, "GSM1", 3, 100), ("chrX", "-", 9, "GSM2", 12, 50)]


def test_sheets(spark, tmp_path):
    docs = [{"GEOsampleID": "G1", "organism": "human", "visible": True, "protocol": "DRS", "reads": {"raw": {"length": {"max": 40}}}}, {"GEOsampleID": "G2", "organism": "human", "visible": False}, {"GEOsampleID": "G3", "organism": "mouse", "visible": True}]
    (tmp_path / "d.json").write_text("\n".join(map(json.dumps, docs)))
    sheet = text.read_sheet_documents(spark, str(tmp_path / "d.json"), "human")
    assert [(r.sample_id, r.protocol, r.readlen) for r in sheet.collect()] == [("G1", "DRS", 40)]
    sinks.write_sheet(sheet, str(tmp_path / "sheet"))
    again = text.read_sample_sheet(spark, str(tmp_path / "sheet")).first()
    assert (again.sample_id, again.protocol, again.readlen) == ("G1", "DRS", 40)
    (tmp_path / "c.txt").write_text("chr1\t100\nchr2\t5\n")
    assert text.read_chrom_sizes(spark, str(tmp_path / "c.txt")).agg(F.sum("size")).first()[0] == 105


def test_settings(tmp_path):
    (tmp_path / "s.yaml").write_text("# head\na.b: 0.1  # rate\nn: 12\nname: 'x: y'\nempty:\nlist:\n  - AATAAA\n  - 3\nflag: true\n")
    assert text.read_settings(str(tmp_path / "s.yaml")) == {"a.b": 0.1, "n": 12, "name": "x: y", "empty": None, "list": ["AATAAA", 3], "flag": True}


def test_settings_with_maps(spark, tmp_path):
    from tailmap.plans import pipeline

    path = tmp_path / "s.yaml"
    path.write_text("---\nexcluded_chr:\n- MT\n- 7\nchromosome_names:\n  1: chr1\n  X: 'chrX'  # sex\n  deep:\n    - a\nIP.total_As: 5\nCL.upstream_clustering: 9\nCL.downstream_clustering: 9\nsample.BG_polyAsignal_cutoff: 80\nurl: \"http://x.org: 1\"\nnone:\n...\n")
    config = text.read_settings(str(path))
    assert config["chromosome_names"] == {"1": "chr1", "X": "chrX", "deep": ["a"]} and config["url"] == "http://x.org: 1" and config["none"] is None
    settings = pipeline.settings_of(config)
    assert (settings.excluded, settings.ip_total, settings.cluster_window, settings.cutoff, settings.mini_window) == (("MT", "7"), 5, 9, 80.0, 25)
    del config["chromosome_names"]["deep"]
    atlas = spark.createDataFrame([("k1", "1", "+", 11, 12, {"S": 2.0}), ("k2", "9", "+", 1, 2, {"S": 1.0})], "cluster_id string, chr string, strand string, start1 long, end long, tpm map<string,double>")
    assert [(r.chr, r.start0, r.end) for r in pipeline.atlas_tracks(atlas, config).collect()] == [("chr1", 10, 12)]
    with pytest.raises(ValueError, match="chromosome_names"):
        pipeline.chromosome_names(spark, {})
    for bad, what in (("a:\n  - b: c\n", "maps and lists"), ("a: [1, 2]\n", "plain values"), ("a\n", "neither"), ("a: 1\n  b: 2\n", "too far right"), ("a: 1\na: 2\n", "twice"), ("- a\n", "no map")):
        path.write_text(bad)
        with pytest.raises(ValueError, match=what):
            text.read_settings(str(path))
    for bad in ({"min_3p_align": -1}, {"ds_range": 1.5}, {"sample.BG_polyAsignal_cutoff": 101}, {"polyA_signals": [{"a": 1}]}, {"CL.upstream_clustering": 1, "CL.downstream_clustering": 2}):
        with pytest.raises(ValueError):
            pipeline.settings_of(bad)


def test_runs_and_split_files(spark, tmp_path):
    for name, seq in (("r1", "ACGT"), ("r2", "GGG"), ("r3", "TT")):
        (tmp_path / f"{name}.fastq").write_text(f"@a\n{seq}\n+\nIIII\n" * 3)
    path = lambda n: str(tmp_path / f"{n}.fastq")
    got = text.read_runs(spark, {"A": [path("r1"), path("r2")], "B": [path("r3")]}).groupBy("sample", "seq").count().collect()
    assert sorted(map(tuple, got)) == [("A", "ACGT", 3), ("A", "GGG", 3), ("B", "TT", 3)]
    sheet = spark.createDataFrame([("A", ["r1", "r2"]), ("B", ["r3"])], "sample_id string, runs array<string>")
    long = "".join(f"@{k}\n{'ACGT'[k % 4] * (k % 9 + 1)}\n+\n{'I' * (k % 9 + 1)}\n" for k in range(200))
    (tmp_path / "r3.fastq").write_text(long)
    (tmp_path / "r4.fastq.gz").write_bytes(gzip.compress(b"@x\nAC\n+\nII\n"))
    want = sorted(("ACGT"[k % 4] * (k % 9 + 1), k + 1) for k in range(200))
    for size in ("16", "61", "1000", "1000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            assert sorted((r.seq, r.read_no) for r in text.read_fastq(spark, path("r3"), sample="B").collect()) == want
            got = text.read_sheet_runs(spark, str(tmp_path), sheet).groupBy("sample").count().collect()
            assert sorted(map(tuple, got)) == [("A", 6), ("B", 200)]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_sheet_of_all_protocols_in_one_plan(spark):
    rng = random.Random(9)
    three, five = "[AN]*AGATCGGAAGAG", "GATTCCATTG"
    samples = {}
    for k, protocol in enumerate(protocols.STEPS):
        for j, (a, b) in enumerate(((None, three), (five, None), (five, "AGATCGGAAGAG"), ("", ""))):
            samples[f"s{k}_{j}"] = protocols.Sample(protocol, a, b, [60, None, 40, 0][j], j == 1)
    reads = []
    for name in samples:
        for i in range(12):
            parts = [rng.choice(["", five, five[3:], "ACGTTTT", "TTTT"]), "".join(rng.choices("ACGTN", weights=[3, 3, 3, 3, 0.1], k=rng.randint(0, 40))), rng.choice(["", "AA", "A" * 9]), rng.choice(["", "AGATCGGAAGAG", "AGATCG", "AGATGGAAGAGTT"])]
            reads.append((name, i, "".join(parts)))
    table = spark.createDataFrame([*reads, ("none", 1, "ACGT")], "sample string, read_id long, seq string")
    sheet = spark.createDataFrame([(n, s.protocol, s.five_adapter, s.three_adapter, s.read_length, s.reverse_compl) for n, s in samples.items()], "sample_id string, protocol string, fiveAdapter string, threeAdapter string, readlen int, reverse_compl boolean")
    got = protocols.valid_of_sheet(table, sheet)
    want = None
    for name, sample in samples.items():
        one = protocols.valid_of(protocols.trim_reads(table.where(F.col("sample") == name), sample), sample).withColumn("protocol", F.lit(sample.protocol))
        want = one if want is None else want.unionByName(one)
    rows = lambda df: sorted((r["sample"], r.read_id, r.seq, r.protocol) for r in df.collect())
    found = rows(got)
    assert found == rows(want) and len({r[3] for r in found}) == len(protocols.STEPS)
    with pytest.raises(Exception, match="unknown protocol"):
        protocols.valid_of_sheet(table, sheet.withColumn("protocol", F.lit("x"))).collect()


def test_repeated_tags(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@HD\tVN:1\nq\t0\tchr1\t5\t9\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:1\tMD:Z:4\tNM:i:2\n")
    r = text.read_sam(spark, str(tmp_path / "x.sam")).first()
    assert (r.qname, r.nm, r.md) == ("q", 1, "4")


def test_documents(spark):
    rows = spark.createDataFrame([("S", "reads.trimmed.length.max", 5), ("S", "sites", 7), ("S", "a.b", 1)], "sample string, key string, value long")
    texts = spark.createDataFrame([("S", "source", 'li"ver')], "sample string, key string, text string")
    assert json.loads(support.nested_documents(rows, "G", texts).first().document) == {"a": {"G": {"b": 1}}, "G": {"sites": 7}, "reads": {"trimmed": {"length": {"G": {"max": 5}}}}, "source": 'li"ver'}
    sheet = spark.createDataFrame([("S", "DRS", None, "t", True)], "sample string, protocol string, source string, treatment string, reverse_compl boolean")
    new = json.loads(support.skeleton_documents(sheet, "G38").first().document)
    assert new["reads"]["valid"]["cutoffs"] == {"maxLength": 0, "maxAs": 0.8, "maxNs": 2} and new["sites"]["all"]["internalpriming"]["reads"] == {"plus": 0, "minus": 0} and new["source"] is None
    assert new["reads"]["raw"] == {"nr": 0, "md5sum": "", "length": {"max": 0, "min": 0}} and new["reads"]["trimmed"]["md5sumNoPolyA"] == "" and new["log"] == []
    assert (new["GEOsampleID"], new["sample_genome_id"], new["genome"], new["tobereversed"], new["title"], new["visible"]) == ("S", "S_G38", "G38", True, None, True)


def test_better_of_two_adapters(spark):
    three, five = "AGATCGGA", "CCTTGA"
    assert X.trimmed_best(["TTTT" + three, five + "TTTT", five + "TTTT" + three], [three] * 3, [five] * 3) == ["TTTT", "TTTT", five + "TTTT"]
    reads_ = spark.createDataFrame([(1, five + "ACGTACGTACGTACGTACGT")], "read_id long, seq string")
    assert protocols.trim_reads(reads_, protocols.Sample("A-seq", five, three)).first().seq == "ACGTACGTACGTACGTACGT"
    assert reads.id_list(reads_).count() == 1
