"""Column functions over sequences, CIGAR strings and coordinates; all are built-in expressions and stay in generated code.

A null argument gives null, unless a function says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def pattern_of(adapter: str) -> str:
    """The regular expression of an adapter in which N stands for any nucleotide."""
    return adapter.upper().replace("N", ".")


def strip_5p(seq: Column, adapter: str) -> Column:
    """What follows the adapter at the start; empty where the adapter is not there or nothing follows (such reads are dropped)."""
    return F.regexp_extract(seq, f"^{pattern_of(adapter)}(.*)$", 1)


def strip_3p(seq: Column, adapter: str) -> Column:
    """What precedes the adapter at the end; empty where the adapter is not there or nothing precedes."""
    return F.regexp_extract(seq, f"^(.*){pattern_of(adapter)}$", 1)


def trim_leading(seq: Column, nucleotides: str) -> Column:
    """Without the run of these nucleotides at the start."""
    return F.regexp_replace(seq, f"^[{nucleotides}]+", "")


def trim_trailing(seq: Column, nucleotides: str) -> Column:
    """Without the run of these nucleotides at the end."""
    return F.regexp_replace(seq, f"[{nucleotides}]+$", "")


def adapter_class(adapter: Column) -> Column:
    """The nucleotides to trim besides an adapter written ``CLASS*ADAPTER``, without brackets; empty where there is none."""
    return F.when(F.contains(adapter, F.lit("*")), F.translate(F.substring_index(adapter, "*", 1), "[]", "")).otherwise(F.lit(""))


def adapter_sequence(adapter: Column) -> Column:
    """The adapter proper of ``CLASS*ADAPTER`` or ``ADAPTER``."""
    return F.substring_index(adapter, "*", -1)


def count_of(seq: Column, nucleotide: str) -> Column:
    """How often one letter occurs, in its case."""
    return F.length(seq) - F.length(F.replace(seq, F.lit(nucleotide), F.lit("")))


def composition_within(seq: Column, nucleotide: str, most: float, *, fraction: bool | None = None) -> Column:
    """Whether a letter occurs at most so often, or as so large a fraction where ``most`` is below 1 or ``fraction`` is set.

    An empty sequence is within every limit.
    """
    if fraction if fraction is not None else most < 1:
        return F.coalesce(count_of(seq, nucleotide) / F.nullif(F.length(seq), F.lit(0)), F.lit(0.0)) <= most
    return count_of(seq, nucleotide) <= most


def is_valid_read(seq: Column, *, max_n: int = 2, max_a: float = 0.8, max_length: int | None = None) -> Column:
    """Few N, few A, no A at the end, and not too long: one condition, so the scan filters once."""
    good = composition_within(seq, "N", max_n, fraction=False) & composition_within(seq, "A", max_a, fraction=True) & ~F.endswith(seq, F.lit("A"))
    return good if max_length is None else good & (F.length(seq) <= max_length)


def reverse_complement(seq: Column) -> Column:
    """Reversed, with A, C, G and T exchanged in either case and other letters kept."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def on_reverse_strand(flag: Column) -> Column:
    """Whether bit 16 of an alignment's flag is set."""
    return flag.bitwiseAND(16) != 0


def strand_of(flag: Column) -> Column:
    """+ or -."""
    return F.when(on_reverse_strand(flag), "-").when(flag.isNotNull(), "+")


def reference_length(cigar: Column) -> Column:
    """How much of the reference an alignment covers: its M, D and N."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def anchored(mmid: Column, strand: Column, least: int = 4) -> Column:
    """Whether the 3' end of a read matches: ``least`` matches at that end, or a read that matches from end to end."""
    tail = F.when(strand == "+", F.regexp_extract(mmid, r"(\d+)$", 1)).otherwise(F.regexp_extract(mmid, r"^(\d+)", 1))
    return mmid.rlike(r"^\d+$") | (F.coalesce(tail.try_cast("long"), F.lit(0)) >= least)


def three_prime_position(start0: Column, end: Column, strand: Column, correction: int = 0) -> Column:
    """The 1-based position of the 3' end, moved downstream by a correction."""
    return F.when(strand == "+", end + correction).otherwise(start0 + 1 - correction)


def window(start0: Column, end: Column, strand: Column, upstream: int, downstream: int) -> tuple[Column, Column]:
    """Half-open bounds of a strand-aware window around an interval."""
    plus = strand == "+"
    return F.when(plus, start0 - upstream).otherwise(start0 - downstream), F.when(plus, end + downstream).otherwise(end + upstream)


def internal_priming(flank: Column, *, upstream: int = 60, downstream: int = 10, total_as: int = 7, consecutive_as: int = 6, patterns: Sequence[str] = ()) -> Column:
    """Whether a site is primed internally by the sequence around it (``upstream``, the site, ``downstream`` nucleotides).

    So is a site whose sequence is missing or incomplete.
    """
    after = F.substring(flank, upstream + 2, downstream)
    ten = F.substring(after, 1, 10)
    found = (count_of(ten, "A") >= total_as) | ten.rlike(f"A{{{consecutive_as}}}")
    for p in patterns:
        found |= after.rlike(f"^(?:{p})")
    return F.coalesce(F.length(flank) != upstream + 1 + downstream, F.lit(True)) | F.coalesce(found, F.lit(True))


def polya_signals(seq: Column, position: Column, strand: Column, motifs: Sequence[str], *, upstream: int = 59) -> Column:
    """array<struct<motif, rel, abs>> of all motifs in the window around a site, by place.

    The window has ``upstream`` nucleotides, the site, and what follows.  rel counts from the site without a zero; abs is the
    genomic position of a motif's first nucleotide.  A window that is null or shorter than a motif has none.
    """
    sizes = sorted({len(m) for m in motifs})
    site = upstream + 1

    def of(size: int) -> Column:
        wanted = F.array(*[F.lit(m.upper()) for m in motifs if len(m) == size])
        places = F.when(F.length(seq) >= size, F.sequence(F.lit(0), F.length(seq) - size)).otherwise(F.array().cast("array<int>"))
        words = F.transform(places, lambda i: F.struct(i.alias("i"), F.upper(F.substring(seq, i + 1, F.lit(size))).alias("motif")))
        return F.filter(words, lambda w: F.array_contains(wanted, w["motif"]))

    found = F.array_sort(F.concat(*[of(s) for s in sizes])) if sizes else F.array()
    rel = lambda i: F.when(i < site, i - site).otherwise(i - site + 1)
    shift = lambda i: (i - upstream).cast("long")
    each = lambda w: F.struct(
        w["motif"].alias("motif"), rel(w["i"]).cast("int").alias("rel"), F.when(strand == "+", position + shift(w["i"])).otherwise(position - shift(w["i"])).cast("long").alias("abs")
    )
    # Most windows hold no motif: one look with all motifs spares them the places.
    any_ = F.upper(seq).rlike("|".join(m.upper() for m in motifs)) if motifs else F.lit(False)
    return F.coalesce(F.when(any_, F.transform(found, each)), F.array().cast("array<struct<motif:string,rel:int,abs:bigint>>"))


def gtf_attribute(attributes: Column, key: str) -> Column:
    """The value of ``key "value";`` in a GTF line's attributes; null where it is missing."""
    return F.nullif(F.regexp_extract(attributes, rf'(?:^|[\s;]){key} "([^"]*)"', 1), F.lit(""))


def fixed(value: Column, digits: int) -> Column:
    """A number as text with so many digits after the point."""
    return F.format_string(f"%.{digits}f", value)
