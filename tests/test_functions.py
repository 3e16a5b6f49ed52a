"""Functions on hand-made values."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tailmap.functions import sequence as S
from tailmap.functions import strings as X


def one(spark, column, **values):
    types = {str: "string", int: "bigint", type(None): "string"}
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in values.items())) if values else spark.range(1)
    return row.select(column).first()[0]


def test_patterns(spark):
    assert one(spark, S.strip_5p(F.col("s"), "NNTT"), s="AGTTCC") == "CC"
    assert one(spark, S.strip_5p(F.col("s"), "NNTT"), s="AGTT") == ""
    assert one(spark, S.strip_3p(F.col("s"), "AA"), s="CCAAA") == "CCA"
    assert one(spark, S.trim_leading(F.col("s"), "T"), s="TTTATT") == "ATT"
    assert one(spark, S.trim_trailing(F.col("s"), "CN"), s="ACGCNC") == "ACG"
    assert one(spark, S.adapter_class(F.col("s")), s="[AN]*GATC") == "AN"
    assert one(spark, S.adapter_sequence(F.col("s")), s="C*AGAT") == "AGAT"
    assert one(spark, S.reverse_complement(F.col("s")), s="ACGTNa") == "tNACGT"


def test_composition_edges(spark):
    assert one(spark, S.composition_within(F.col("s"), "A", 0.8), s="AAAAC") is True
    assert one(spark, S.composition_within(F.col("s"), "A", 0.79), s="AAAAC") is False
    assert one(spark, S.composition_within(F.col("s"), "N", 2), s="NNNC") is False
    assert one(spark, S.composition_within(F.col("s"), "A", 0.8), s="") is True
    assert one(spark, S.is_valid_read(F.col("s")), s="CCCA") is False


def test_reference_length_and_anchor(spark):
    assert one(spark, S.reference_length(F.col("s")), s="5S10M2I3D100N7M") == 120
    for mmid, strand, good in (("30", "+", True), ("3", "+", True), ("26MAT3", "+", False), ("25MAT4", "+", True), ("3MAT26", "-", False), ("IG29", "-", False), ("26MAT", "+", False)):
        assert one(spark, S.anchored(F.col("m"), F.col("t")), m=mmid, t=strand) is good, mmid
    assert one(spark, S.three_prime_position(F.col("a"), F.col("b"), F.col("t"), 1), a=9, b=20, t="+") == 21
    assert one(spark, S.three_prime_position(F.col("a"), F.col("b"), F.col("t")), a=9, b=20, t="-") == 10


def test_internal_priming(spark):
    ip = S.internal_priming(F.col("s"))
    assert one(spark, ip, s=None) is True
    assert one(spark, ip, s="C" * 70) is True
    assert one(spark, ip, s="C" * 71) is False
    assert one(spark, ip, s="C" * 61 + "AAAAAACCCC") is True
    assert one(spark, ip, s="C" * 61 + "AAACAACAAC") is True
    assert one(spark, ip, s="C" * 61 + "AAACAACAGC") is False
    assert one(spark, S.internal_priming(F.col("s"), patterns=("AGAA",)), s="C" * 61 + "AGAACCCCCC") is True


def test_signals(spark):
    seq = "C" * 39 + "AATAAA" + "C" * 14 + "ATTAAA" + "C" * 5
    hits = one(spark, S.polya_signals(F.col("s"), F.lit(1000), F.lit("+"), ("AATAAA", "ATTAAA")), s=seq)
    assert [(h.motif, h.rel, h.abs) for h in hits] == [("AATAAA", -21, 980), ("ATTAAA", -1, 1000)]
    hits = one(spark, S.polya_signals(F.col("s"), F.lit(1000), F.lit("-"), ("AATAAA",)), s=seq)
    assert [(h.rel, h.abs) for h in hits] == [(-21, 1020)]
    assert one(spark, S.polya_signals(F.col("s"), F.lit(1), F.lit("+"), ("AATAAA",)), s=None) == []


def test_edit_strings():
    assert X.edit_string("30M", "30", "A" * 30) == "30"
    assert X.edit_string("3S5M1I4M2D3M", "5A3^CG3", "TTT" + "AAAAA" + "G" + "CAAA" + "AAA") == "5IGMAC3DCDG3"
    assert X.reversed_md("10A5^AC3") == "3^GT5T10"
    assert X.spliced_cigar("30M", "+", [10, 500, 20]) == "10M500N20M"
    assert X.spliced_cigar("10M2I20M", "-", [5, 100, 10, 50, 15]) == "5M100N10M50N5M2I10M"
    assert X.spliced_cigar("12M", "+", [12]) == "12M"


@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from("MID")), min_size=1, max_size=6), st.data())
@settings(max_examples=80, deadline=None)
def test_introns_keep_the_rest(steps, data):
    cigar = "".join(f"{n}{s}" for n, s in steps)
    size = sum(n for n, s in steps if s in "MD")
    if size < 3:
        return
    cuts = sorted(data.draw(st.sets(st.integers(1, size - 1), max_size=3)))
    exons = [b - a for a, b in zip([0, *cuts], [*cuts, size])]
    parts = [exons[0]] + [x for e in exons[1:] for x in (77, e)]
    spliced = [(int(n), s) for n, s in X._STEP.findall(X.spliced_cigar(cigar, "+", parts))]
    assert sum(s == "N" for _, s in spliced) == len(cuts)
    assert sum(n for n, s in spliced if s in "MD") == size
    seen, at = [], 0
    for n, s in spliced:
        at += n if s in "MD" else 0
        seen += [at] if s == "N" else []
    assert seen == cuts


def test_adapters():
    cut = lambda trim, seq, *adapters, **k: trim([seq], *[[a] for a in adapters], **k)[0]
    assert cut(X.trimmed_3p, "ACGTACGTTTAGATCGG", "AGATCGGAAG") == "ACGTACGTTT"
    assert cut(X.trimmed_3p, "ACGTACGT", "TTTTTT") == "ACGTACGT"
    assert cut(X.trimmed_3p, "ACGTAGATCGGTAGCCC", "AGATCGGAAGCC", error_rate=0.1) == "ACGT"
    assert cut(X.trimmed_5p, "TTTACGTCC", "GGTTT") == "ACGTCC"
    assert cut(X.trimmed_3p, "", "ACG") == ""
    # A letter too few and one too many in the read.
    assert cut(X.trimmed_3p, "ACGTTTAGATGGAAGCCTT", "AGATCGGAAGCC") == "ACGTTT"
    assert cut(X.trimmed_3p, "ACGTTTAGATCCGGAAGCCTT", "AGATCGGAAGCC") == "ACGTTT"


def plain_place(seq, adapter, rate, overlap):
    """The alignment table of one sequence, cell by cell, as (cost, matches, begin)."""
    m, best = len(adapter), None
    column = [(i, 0, 0) for i in range(m + 1)]
    for j, x in enumerate(seq):
        new = [(0, 0, j + 1)]
        for i, c in enumerate(adapter, 1):
            d, a, l = column[i - 1], new[i - 1], column[i]
            if c in (x, "N"):
                new.append((d[0], d[1] + 1, d[2]))
            else:
                one = d if d[0] <= min(a[0], l[0]) else a if a[0] <= l[0] else l
                new.append((one[0] + 1, *one[1:]))
        column = new
        for i in [m] * (m >= overlap) + (list(range(overlap, m + 1)) if j == len(seq) - 1 else []):
            cost, matches, begin = column[i]
            if cost <= int(rate * i) and (best is None or (matches, -cost) > best[0]):
                best = (matches, -cost), begin
    return (-1, 0) if best is None else (best[0][0], best[1])


def test_adapters_by_a_plain_table():
    rng = random.Random(7)
    for adapter, rate, overlap in (("AGATCGGAAGAGC", 0.1, 3), ("ACNTNNGA", 0.3, 1), ("A" * 14, 0.1, 1), ("ACG", 0.5, 4), ("", 0.1, 3)):
        seqs = ["", "A", "N" * 9, "é" * 5]
        for _ in range(300):
            inside = [c for c in adapter.replace("N", "T") for c in rng.choice([c, c, c, c, c, c, "", c + rng.choice("ACGT"), rng.choice("ACGT")])]
            seqs.append("".join([*rng.choices("ACGT", k=rng.randint(0, 30)), *inside[: rng.choice([len(inside), rng.randint(0, 14)])], *rng.choices("ACGT", k=rng.choice([0, 0, 5]))]))
        matches, begins = X.adapter_places(seqs, adapter, rate, overlap)
        for k, s in enumerate(seqs):
            want = plain_place(s, adapter, rate, overlap)
            assert (int(matches[k]), int(begins[k]) if matches[k] >= 0 else 0) == want, (s, adapter)


def test_edit_strings_by_built_in_functions(spark):
    rng = random.Random(3)
    rows = [("30M", "30", "A" * 30), ("3S5M1I4M2D3M", "5A3^CG3", "TTTAAAAAGCAAAAAA"), ("4M", None, "ACGT"), (None, "4", "ACGT"), ("5M100N5M", "4A5", "ACGTACGTAC"), ("2M", "0A0C0", "GT")]
    for _ in range(150):
        cigar, md, run, seq = "", "", 0, ""
        for k, step in enumerate(["S"] * rng.randint(0, 1) + ["M"] + [x for _ in range(rng.randint(0, 3)) for x in (rng.choice("IDN"), "M")] + ["S"] * rng.randint(0, 1)):
            n = rng.randint(1, 9)
            cigar += f"{n}{step}"
            seq += "".join(rng.choices("ACGT", k=0 if step in "DN" else n))
            if step == "D":
                md, run = md + f"{run}^" + "".join(rng.choices("ACGT", k=n)), 0
            for _ in range(n if step == "M" else 0):
                if rng.random() < 0.2:
                    md, run = md + f"{run}{rng.choice('ACGTN')}", 0
                else:
                    run += 1
        rows.append((cigar, md + str(run), seq))
    got = spark.createDataFrame(list(enumerate(rows)), "i int, r struct<cigar:string,md:string,seq:string>").select("i", X.mmid(F.col("r.cigar"), F.col("r.md"), F.col("r.seq")).alias("m")).collect()
    for r in got:
        assert r.m == (None if None in rows[r.i] else X.edit_string(*rows[r.i])), rows[r.i]


def test_adapters_in_short_and_long_cells():
    # cells of 32 bits for short adapters, of 64 for long ones, over several blocks, as the plain table has it.
    rng = random.Random(11)
    assert X._SHORT == 30
    for m, rate, overlap in ((29, 0.3, 3), (30, 1.0, 1), (31, 0.3, 3), (33, 1.2, 2)):
        adapter = "".join(rng.choice("ACGTN") for _ in range(m))
        seqs = ["".join(rng.choice("ACGT") for _ in range(rng.randint(0, 25))) + adapter[: rng.randint(0, m)].replace("N", "C") for _ in range(40)]
        matches, begins = X.adapter_places(seqs * 500, adapter, rate, overlap)
        for k, s in enumerate(seqs):
            want = plain_place(s, adapter, rate, overlap)
            assert (int(matches[k]), int(begins[k]) if matches[k] >= 0 else 0) == want, (s, adapter)
        assert matches.tolist() == matches[:40].tolist() * 500 and begins.tolist() == begins[:40].tolist() * 500


def test_edit_strings_of_a_batch_share_templates(spark):
    # one walk for all reads of equal CIGAR, mismatches and length; odd reads are walked on their own.
    rows = [("2S10M1I7M2D8M2S", "5A11^CG3T4", "".join(random.Random(k).choices("ACGTN", k=30))) for k in range(300)]
    X._template.cache_clear()
    assert X.walked_all(*map(list, zip(*rows, strict=True))) == [X.edit_string(*r) for r in rows]
    assert X._template.cache_info().misses == 1
    odd = [("4M", "1A2", "A=GT"), ("4M", "1A2", "A%GT"), ("6M", "1A0C3", "AC"), ("3M2I", "3", "ACG"), ("", "", ""), ("2M", "99999999999", "AC")]
    got = spark.createDataFrame(odd, "c string, m string, s string").select(X.mmid(F.col("c"), F.col("m"), F.col("s")).alias("e")).collect()
    assert [r.e for r in got] == ["1MA3", "1MA%2", "1MAC3", "3", "", ""]
