"""Operators against brute force and hand-made cases."""

import random

import pytest
from pyspark.sql import functions as F

from tailmap.operators import alignments, clusters, intervals, sites, support
from tailmap.plans import pipeline, protocols
from tailmap.sources import sinks, text
from tailmap.streaming.sites import append_sites


def claimed_in_order(rows):
    want = {}
    for key in {r[:2] for r in rows}:
        mine = sorted([r for r in rows if r[:2] == key], key=lambda r: (-r[3], -r[4], r[2]))
        up, down = (12, 5) if key[1] == "+" else (5, 12)
        for r in mine:
            if (*key, r[2]) not in want:
                for x in mine:
                    if r[2] - up <= x[2] <= r[2] + down:
                        want.setdefault((*key, x[2]), r[2])
    return want


def test_claim_by_tiles_is_claim_of_all(spark):
    rng = random.Random(3)
    rows = [("chr1" if rng.random() < 0.7 else None, rng.choice("+-"), p, rng.randint(1, 5), rng.random()) for p in rng.sample(range(3000), 900)]
    # Each better than the one before: what claims the first is known only when the last is.
    rows += [("chain", s, 5 * i, 1, float(i)) for s in "+-" for i in range(60)]
    df = spark.createDataFrame(rows, "chr string, strand string, pos bigint, n_supported int, mean_tpm double")
    for tile, halo in ((100_000, 2_000), (100, 20)):
        got = {(r.chr, r.strand, r.pos): r.seed for r in clusters.greedy_claim(df, ["n_supported", "mean_tpm"], upstream=12, downstream=5, tile=tile, halo=halo).collect()}
        assert got == claimed_in_order(rows)
    assert clusters.greedy_claim(df.limit(0), ["n_supported"], upstream=12, downstream=5).count() == 0


def test_claim_leaves_open_what_others_may_decide():
    # The site at 3 may be claimed from before 0, the one at 10 by it; the one at 30 is out of reach of both.
    assert clusters.claim([3, 30, 10], 8, 8, first=0) == [None, 30, None]
    assert clusters.claim([30, 3, 10], 8, 8, seeds=[30, 3, None], first=0) == [30, 3, 3]
    # Claimed by 10 or by a site before 0, so it claims nothing: 8 is free of it.
    assert clusters.claim([10, 3, 40], 8, 8, first=0) == [10, None, 40]


def cluster(start, end, rep, total, marks=(), ip=False):
    return clusters._Cluster(chr="c", strand="+", start1=start, end=end, rep=rep, total_tpm=float(total), pas=[{"motif": "AATAAA", "rel": m - rep, "abs": m} for m in marks], is_ip_candidate=ip, tpm={"S": float(total)})


def shape(line):
    return [(c["start1"], c["end"], c["rep"], c["total_tpm"], c["is_ip_candidate"]) for c in line]


def test_internal_priming_is_resolved():
    # Joins the next cluster, which shares its signal.
    line = clusters.resolve_internal_priming([cluster(100, 105, 105, 1, (90,), True), cluster(110, 112, 111, 5, (90,))], "+", 15)
    assert shape(line) == [(100, 112, 111, 6.0, False)]
    # The next has a signal of its own behind it; its own is far: it stays.
    line = clusters.resolve_internal_priming([cluster(100, 105, 105, 1, (90,), True), cluster(120, 122, 121, 5, (90, 108))], "+", 15)
    assert shape(line) == [(100, 105, 105, 1.0, False), (120, 122, 121, 5.0, False)]
    # Its own is near: it goes.
    assert shape(clusters.resolve_internal_priming([cluster(100, 105, 105, 1, (95,), True)], "+", 15)) == []
    # Without a signal it stays, without the mark.
    assert shape(clusters.resolve_internal_priming([cluster(100, 105, 105, 1, (), True)], "-", 15)) == [(100, 105, 105, 1.0, False)]
    # On the minus strand downstream is to the left.
    line = clusters.resolve_internal_priming([cluster(90, 92, 91, 5, (120,)), cluster(100, 105, 100, 1, (120,), True)], "-", 15)
    assert shape(line) == [(90, 105, 91, 6.0, False)]


def test_merging_phases():
    a, b, c = cluster(100, 105, 103, 2, (90, 95)), cluster(130, 135, 133, 9, (95,)), cluster(170, 171, 170, 1, (99,))
    assert shape(clusters.merge_same_signals([a, b, c], "+")) == [(100, 135, 133, 11.0, False), (170, 171, 170, 1.0, False)]
    assert len(clusters.merge_same_signals([b, a], "+")) == 2
    assert shape(clusters.merge_small([cluster(1, 10, 5, 1), cluster(20, 25, 22, 1), cluster(30, 31, 30, 1)], 25)) == [(1, 25, 5, 2.0, False), (30, 31, 30, 1.0, False)]
    runs = [cluster(1, 10, 5, 1), cluster(20, 30, 25, 3), cluster(35, 60, 50, 2), cluster(80, 90, 85, 1, (70,)), cluster(200, 210, 205, 1)]
    assert shape(clusters.merge_without_signals(runs, 25)) == [(80, 90, 85, 1.0, False), (200, 210, 205, 1.0, False)]
    assert shape(clusters.merge_without_signals(runs[:2], 25)) == [(1, 30, 25, 4.0, False)]
    assert shape(clusters.merge_without_signals(runs[:2], 25, compat="reference")) == [(1, 10, 5, 1.0, False), (20, 30, 25, 3.0, False)]


@pytest.mark.parametrize("compat", ["clean", "reference"])
@pytest.mark.parametrize("steps", [(4, 9, 14, 30, 90, 160), (1, 2, 3, 5), (6, 12, 13)])
def test_merging_by_tiles_is_merging_of_a_strand(spark, compat, steps):
    """Sparse and dense strands, tiles that are crossed by runs, against all phases on a whole strand in order."""
    rng = random.Random(len(steps))
    rows, pos = [], {"+": 0, "-": 0}
    for _ in range(500):
        strand = rng.choice("+-")
        start = pos[strand] + rng.choice(steps)
        end = start + rng.randint(0, 6)
        rep = rng.randint(start, end)
        pas = [("AATAAA", -20, rep // 40 * 40 - 20 + rng.choice([0, 0, 7])) for _ in range(rng.choice([0, 0, 1, 2]))]
        rows.append(("c", strand, start, end, rep, float(rng.randint(1, 9)), pas, rng.random() < 0.3, {rng.choice("ST"): 1.0}))
        pos[strand] = end
    names = [c.split()[0] for c in clusters.CLUSTER.split(", ")]
    want = []
    for strand in "+-":
        line = [clusters._Cluster(zip(names, r, strict=True)) | {"pas": [dict(zip(("motif", "rel", "abs"), p, strict=True)) for p in r[6]]} for r in rows if r[1] == strand]
        line = [clusters._Cluster(c) for c in sorted(line, key=lambda c: c["rep"])]
        want += clusters.merge_line(line, strand, least_distance=15, most=25, compat=compat)
    shown = lambda c: (c["strand"], c["start1"], c["end"], c["rep"], c["total_tpm"], c["is_ip_candidate"], sorted(c["tpm"].items()), len(c["pas"]))
    got = clusters.merge_clusters(spark.createDataFrame(rows, clusters.CLUSTER), split_gap=130, compat=compat, tile=200).collect()
    assert sorted(map(shown, got)) == sorted(map(shown, want)) and len(want) > 10


def test_overlap_join_is_naive_join(spark):
    rng = random.Random(1)
    make = lambda n, wide: [(i, rng.choice(["a", "b"]), rng.choice("+-"), s := rng.randint(-50, 200_000), s + rng.choice([0, 1, 5, 900, 5000, wide])) for i in range(n)]
    left, right = make(120, 30_000), make(150, 1_500_000)
    schema = "id int, chr string, strand string, s bigint, e bigint"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    want = sorted((x[0], y[0]) for x in left for y in right if x[1:3] == y[1:3] and x[3] < x[4] and y[3] < y[4] and x[3] < y[4] and y[3] < x[4])
    assert sorted((r.id, r.r_id) for r in intervals.overlap_join(a, b).collect()) == want
    outer = intervals.overlap_join(a, b, how="left")
    assert outer.count() == len(want) + len({x[0] for x in left} - {w[0] for w in want})


def test_genes_of_many_overlaps_are_counted(spark):
    # a cluster in many intervals of few genes is a few counted values until it is spelled out; nulls are left out.
    here = spark.createDataFrame([(1, "c", "+", 0, 50), (2, "c", "+", 900, 950), (3, "c", "-", 0, 50)], "cluster_id int, chr string, strand string, s long, e long")
    rows = [("c", "+", i % 40, i % 40 + 5, g, n) for i in range(300) for g, n in (("g1", "b"), ("g1", "a"), ("g2", None))] + [("c", "-", 1, 9, None, None)]
    genes = spark.createDataFrame(rows, "chr string, strand string, s long, e long, gene_id string, gene_name string")
    counted = {r.cluster_id: r for r in intervals.counted_genes(here, genes).collect()}
    assert [tuple(x) for x in counted[1].gene_name] == [("a", 300), ("b", 300), (None, 300)] and counted[2].gene_name is None
    got = {r.cluster_id: (r.gene_name, r.gene_id) for r in intervals.gene_overlaps(here, genes).collect()}
    assert got == {1: ("|".join(["a"] * 300 + ["b"] * 300), "|".join(["g1"] * 600 + ["g2"] * 300)), 2: (None, None), 3: ("", "")}


def test_lift(spark):
    exons = spark.createDataFrame([("1", 100, 120, "t", "+"), ("1", 200, 230, "t", "+"), ("1", 1000, 1010, "u", "-"), ("1", 1100, 1120, "u", "-"), ("1", 5, 50, "m", "+")], "chr string, start0 bigint, end bigint, transcript_id string, strand string")
    sam = spark.createDataFrame(
        [("a", 0, "t", 11, "15M", "A" * 15, "15"), ("b", 0, "u", 16, "10M", "ACGTACGTAC", "3A6"), ("c", 0, "m", 3, "10M", "A" * 10, "10"), ("d", 16, "t", 1, "5M", "A" * 5, "5"), ("e", 0, "x", 1, "5M", "A" * 5, "5"), ("f", 0, "t", 45, "15M", "A" * 15, "15")],
        "qname string, flag int, rname string, pos bigint, cigar string, seq string, md string",
    )
    got = {r.qname: r for r in alignments.lift_alignments(sam, exons).collect()}
    assert (got["a"].status, got["a"].pos, got["a"].cigar, got["a"].flag) == ("lifted", 111, "10M80N5M", 0)
    assert (got["b"].pos, got["b"].cigar, got["b"].flag, got["b"].seq, got["b"].md) == (1006, "5M90N5M", 16, "GTACGTACGT", "6T3")
    assert [got[k].status for k in "cdef"] == ["no_junction", "reverse_complemented", "not_found", "not_found"]
    one = {r.qname: r for r in alignments.lift_alignments(sam, exons, monoexonic=True).collect()}
    assert (one["c"].status, one["c"].pos, one["c"].cigar) == ("lifted", 8, "10M")
    assert alignments.lift_report(alignments.lift_alignments(sam, exons)).count() == 4


def test_windows_leave_the_chromosome(spark):
    genome = spark.createDataFrame([("1", "ACGTACGTAC")], "chr string, seq string")
    rows = spark.createDataFrame([("1", "+", -1, 3), ("1", "+", 0, 3), ("1", "-", 7, 10), ("1", "+", 8, 11), ("2", "+", 0, 1)], "chr string, strand string, a bigint, b bigint")
    got = {(r.chr, r.a): r.flank for r in sites.fetch_windows(rows, sites.chunked(genome, size=4, overlap=4), F.col("a"), F.col("b"), size=4, overlap=4).collect()}
    assert got == {("1", -1): None, ("1", 0): "ACG", ("1", 7): "GTA", ("1", 8): None, ("2", 0): None}


def test_feature_quirk(spark):
    exons = spark.createDataFrame([("1", 100, 120, "t", "-"), ("1", 200, 230, "t", "-")], "chr string, start0 bigint, end bigint, transcript_id string, strand string")
    of = lambda c: {(r.s, r.feature) for r in intervals.feature_model(exons, ds_range=10, compat=c).collect() if r.strand == "-"}
    assert of("clean") == {(100, "EX"), (200, "EX"), (100, "TE"), (90, "DS"), (120, "IN")}
    assert of("reference") == {(100, "EX"), (200, "AI"), (100, "TE"), (90, "DS"), (120, "IN")}


def test_cutoff_cases(spark):
    rows = [("a", "c", "+", 1, i, i, i > 3) for i in range(1, 6)] + [("b", "c", "+", 1, 9, 9, True)] + [("d", "c", "+", 1, i, i, False) for i in (3, 2)]
    df = spark.createDataFrame(rows, "sample string, chr string, strand string, seed bigint, seed_cnt bigint, reads bigint, has_pas boolean")
    assert {r.sample: r.read_cutoff for r in clusters.read_cutoffs(df).collect()} == {"a": 3, "b": 0, "d": 3}


def test_upsert_and_errors(spark):
    now = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="more than once"):
        support.upsert(now, now.limit(1), ["k"]).collect()
    assert spark.range(1).select(support.with_genome_level(F.lit("sites.count:"), "hg")).first()[0] == "sites.hg.count"


def test_formats(spark, tmp_path):
    import gzip

    for n in (1, 2):
        with gzip.open(tmp_path / f"r{n}.fq.gz", "wt") as f:
            f.write("".join(f"@x{i}\nACG{'T' * i}\n+\nIIII\n" for i in range(n + 1)))
    reads = text.read_fastq(spark, str(tmp_path / "*.fq.gz"), sample="s").collect()
    assert sorted((r.file[-7], r.read_no, r.seq) for r in reads) == [("1", 1, "ACG"), ("1", 2, "ACGT"), ("2", 1, "ACG"), ("2", 2, "ACGT"), ("2", 3, "ACGTT")]
    (tmp_path / "x.fa").write_text(">a|1 extra\nACG\nT\n>b\n\n>c\nGG\n")
    assert sorted(map(tuple, text.read_fasta(spark, str(tmp_path / "x.fa"), trim=r"[\s|]").collect())) == [("a", "ACGT"), ("b", ""), ("c", "GG")]
    (tmp_path / "x.sam").write_text("@HD\tVN:1\nq\t0\t1\t5\t9\t3M\t*\t0\t0\tACG\tIII\tNM:i:1\tMD:Z:1A1\nbad\t1\n")
    sam = text.read_sam(spark, str(tmp_path / "x.sam")).collect()
    assert len(sam) == 1 and (sam[0].nm, sam[0].md, sam[0].pos, sam[0].nh) == (1, "1A1", 5, None)
    (tmp_path / "x.gtf").write_text('#c\n1\te\texon\t5\t9\t.\t+\t.\tgene_id "g"; transcript_id "t"; transcript_biotype "k"; transcript_support_level "2 (x)";\n')
    gtf = text.read_gtf(spark, str(tmp_path / "x.gtf"))
    assert tuple(gtf.select("gene_id", "transcript_id", "kind", "support").first()) == ("g", "t", "k", "2")
    assert tuple(text.exons_of(gtf).first()) == ("1", 4, 9, "t", "+")
    (tmp_path / "s.tsv").write_text("sample_id\tSRR\tseries_id\tsource\tsex\tprotocol\treadlen\tfiveAdapter\tthreeAdapter\tpaired\treverse_compl\ttitle\ttreatment\tpubmed\n#x\ns1\tSRR123456,SRR1234567\te\tl\tF\tA-seq\t36\t\tAG\tFalse\tTrue\tt\t\t\n")
    sheet = text.read_sample_sheet(spark, str(tmp_path / "s.tsv"))
    assert sheet.first().runs == ["SRR123456", "SRR1234567"] and sheet.first().reverse_compl is True
    assert [r.url_path for r in text.runs_of(sheet).orderBy("run").collect()] == ["SRR123/SRR123456/SRR123456.fastq.gz", "SRR123/007/SRR1234567/SRR1234567.fastq.gz"]


def test_protocols(spark):
    reads = spark.createDataFrame([(1, "ACGTTTTCCCCCCCCCCCCCCCCGGGAGATCGGAAG"), (2, "CCCC")], "read_id bigint, seq string")
    got = protocols.trim_reads(reads, protocols.Sample("A-seq2", three_adapter="AGATCGGAAG")).collect()
    assert [(r.read_id, r.seq) for r in got] == [(1, "CCCGGGGGGGGGGGGGGGG")]
    for name in protocols.STEPS:
        protocols.valid_of(protocols.trim_reads(reads, protocols.Sample(name, "ACG", "[C]*AGAT", 36)), protocols.Sample(name, read_length=36)).collect()


def test_reads_to_atlas(spark):
    rng = random.Random(7)
    genome = [(f"chr{c}", "".join(rng.choice("ACGT") for _ in range(4000))) for c in range(3)]
    ends = [(c, rng.choice("+-"), rng.randint(200, 3800)) for c in range(3) for _ in range(15)]
    reads, n = [], 0
    for c, strand, p in ends:
        for _ in range(rng.randint(2, 30)):
            at, n = p + rng.randint(-3, 3), n + 1
            s, e = (at - 20, at) if strand == "+" else (at - 1, at + 19)
            reads.append((f"chr{c}", s, e, f"r{n}", strand, "20", f"S{rng.randint(0, 2)}"))
    bed = spark.createDataFrame(reads, "chr string, start0 bigint, end bigint, read_id string, strand string, mmid string, sample string")
    samples = spark.createDataFrame([("S0", "F", "p"), ("S1", "M", "q"), ("S2", None, "p")], "sample string, sex string, protocol string")
    g = spark.createDataFrame(genome, "chr string, seq string")
    exons = spark.createDataFrame([("chr0", 0, 1500, "t", "+"), ("chr0", 2000, 3000, "t", "+")], "chr string, start0 bigint, end bigint, transcript_id string, strand string")
    found = pipeline.reads_to_sites(bed, samples, g).cache()
    assert found.agg(F.sum("cnt")).first()[0] == len(reads)
    atlas = pipeline.sites_to_atlas(found, samples, g, exons, 3, pipeline.Settings(cutoff=0.0)).cache()
    assert atlas.count() > 0 and atlas.where("annotation in ('EX', 'TE')").count() > 0
    assert atlas.where("frac_samples is null or nr_prots > 2 or start1 > rep or rep > end").count() == 0
    assert pipeline.per_sample(atlas).count() >= atlas.count()


def test_tracks_are_written(spark, tmp_path):
    rows = spark.createDataFrame([("s", "+", "1", 5, 6, "1.0"), ("s", "-", "1", 2, 3, "2.0")], "sample string, strand string, chr string, start0 bigint, end bigint, tpm string")
    sinks.write_tracks(rows, str(tmp_path / "t"), ["sample", "strand"])
    assert spark.read.option("sep", "\t").csv(str(tmp_path / "t")).count() == 2


def test_stream(spark, tmp_path):
    reads = spark.createDataFrame([("1", 0, 5, "a", "+", "s"), ("1", 0, 5, "b", "+", "s")], "chr string, start0 bigint, end bigint, read_id string, strand string, sample string")
    reads.write.parquet(str(tmp_path / "in"))
    append_sites(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [(r.pos, r.cnt) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(5, 2)]


def test_empty_tables(spark):
    none = lambda schema: spark.createDataFrame([], schema)
    assert clusters.merge_clusters(none(clusters.CLUSTER)).count() == 0
    assert clusters.mini_clusters(none("sample string, chr string, strand string, pos bigint, cnt bigint, has_pas boolean")).count() == 0
    assert intervals.overlap_join(none("chr string, strand string, s bigint, e bigint"), none("chr string, strand string, s bigint, e bigint")).count() == 0


def test_windows_are_cut_by_bytes_where_letters_are_bytes(spark):
    seqs = {"a": "ACGTTGCAAC" * 30, "b": "ACGÉTGC\U0001f600AC" * 30}
    chunks = sites.chunked(spark.createDataFrame(list(seqs.items()), "chr string, seq string"), size=64, overlap=16)
    rows = spark.createDataFrame([(c, "+", s) for c in seqs for s in (-1, 0, 60, 63, 64, 290, 291, 400)], "chr string, strand string, s bigint")
    found = sites.fetch_windows(rows, chunks, F.col("s"), F.col("s") + 10, size=64, overlap=16)
    assert found.columns == ["chr", "strand", "s", "flank"]
    assert {(r.chr, r.s): r.flank for r in found.collect()} == {(c, s): t[s : s + 10] if 0 <= s <= 290 else None for c, t in seqs.items() for s in (-1, 0, 60, 63, 64, 290, 291, 400)}
    assert "as binary" in found._jdf.queryExecution().optimizedPlan().toString()
