"""Which steps turn the raw reads of a protocol into the sense strand up to the cleavage site."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailmap.functions import sequence as S
from tailmap.functions import strings as X
from tailmap.operators.reads import replace_seq, valid_reads


@dataclass(frozen=True)
class Sample:
    """What the sheet says of a sample, as far as trimming needs it."""

    protocol: str
    five_adapter: str | None = None
    three_adapter: str | None = None
    read_length: int | None = None
    reverse_compl: bool = False


@dataclass(frozen=True)
class Limits:
    """Parameters of trimming and of valid reads."""

    five_pattern: str = "NNNNTTT"
    five_pattern_3reads: str = "NNNNTT"
    three_pattern: str = "AA"
    min_length: int = 15
    max_n: int = 2
    max_a: float = 0.8
    error_rate: float = 0.1
    least_shortening: int = 5


# The steps of each protocol, in order.
STEPS: dict[str, tuple[str, ...]] = {
    "A-seq2": ("five_pattern", "three_adapter", "revcomp"),
    "3'READS": ("five_adapter_pattern", "three_adapter", "revcomp", "polya"),
    "PAS-Seq": ("leading_t", "three_adapter", "three_class", "revcomp"),
    "SAPAS": ("three_adapter", "three_class", "revcomp"),
    "A-seq": ("three_adapter",),
    "3'-Seq (Mayr)": ("three_adapter", "polya"),
    "DRS": ("revcomp",),
    "PolyA-seq": ("three_adapter", "revcomp"),
    "2P-Seq": ("three_adapter", "revcomp"),
    "3P-Seq": ("revcomp_if_asked", "three_pattern", "polya"),
    "PAPERCLIP": ("five_adapter_if_given", "polya"),
    "QuantSeq_REV": ("five_adapter", "revcomp", "polya"),
}
#: Protocols whose reads must end before the sequencer does.
BOUNDED = ("A-seq", "3'-Seq (Mayr)")


def _step(name: str, seq: Column, sample: Sample, limits: Limits) -> Column:
    three = (sample.three_adapter or "").split("*")[-1]
    kind = (sample.three_adapter or "").split("*")[0].strip("[]") if "*" in (sample.three_adapter or "") else ""
    cut3 = X.trim_adapter_3p(seq, three, error_rate=limits.error_rate) if three else seq
    if sample.five_adapter and sample.protocol != "3'READS":
        # A 5' adapter that the sheet names is looked for along with the 3' one; the better match goes.
        five = sample.five_adapter
        cut3 = X.trim_adapters(seq, three, five, error_rate=limits.error_rate) if three else X.trim_adapter_5p(seq, five, error_rate=limits.error_rate)
    if name == "five_pattern":
        return S.strip_5p(F.upper(seq), limits.five_pattern)
    if name == "five_adapter_pattern":
        return S.strip_5p(F.upper(seq), sample.five_adapter or limits.five_pattern_3reads)
    if name == "three_pattern":
        return S.strip_3p(F.upper(seq), limits.three_pattern)
    if name == "leading_t":
        return S.trim_leading(seq, "T")
    if name == "three_class":
        return S.trim_trailing(seq, kind) if kind else seq
    if name == "three_adapter":
        return cut3
    if name == "five_adapter" or name == "five_adapter_if_given":
        return X.trim_adapter_5p(seq, sample.five_adapter, error_rate=limits.error_rate) if sample.five_adapter else seq
    if name == "polya":
        return X.trim_polya(seq, error_rate=limits.error_rate)
    if name == "revcomp" or sample.reverse_compl:
        return S.reverse_complement(seq)
    return seq


def trim_reads(reads: DataFrame, sample: Sample, limits: Limits = Limits()) -> DataFrame:
    """The reads (read_id, seq) of one sample after its protocol's steps; reads that get too short go."""
    for name in STEPS[sample.protocol]:
        short = 1 if name in ("five_pattern", "five_adapter_pattern", "three_pattern") or name.startswith("revcomp") else limits.min_length
        reads = replace_seq(reads, _step(name, F.col("seq"), sample, limits), least=short)
    return reads


def valid_of(reads: DataFrame, sample: Sample, limits: Limits = Limits()) -> DataFrame:
    """Trimmed reads that are valid for the protocol."""
    most = sample.read_length - limits.least_shortening if sample.protocol in BOUNDED and sample.read_length else None
    return valid_reads(reads, max_n=limits.max_n, max_a=limits.max_a, max_length=most)


#: Steps that leave reads of any length but none.
_SHORT = ("five_pattern", "five_adapter_pattern", "three_pattern", "revcomp", "revcomp_if_asked")


def _applied(reads: DataFrame, names: tuple[str, ...], limits: Limits) -> DataFrame:
    """``reads`` after that one of these steps which their protocol has, if any; rows with other protocols pass as they are.

    What a function in Python works on is null for the rows that do not need it, so that these cost no work there.
    """
    seq, five = F.col("seq"), F.coalesce("_five", F.lit(""))
    three, kind = S.adapter_sequence(F.coalesce("_three", F.lit(""))), S.adapter_class(F.coalesce("_three", F.lit("")))
    spelled = lambda pattern: F.replace(F.upper(pattern), F.lit("N"), F.lit("."))
    after = lambda pattern: F.call_function("regexp_extract", F.upper(seq), F.concat(F.lit("^"), pattern, F.lit("(.*)$")), F.lit(1))
    error = {"error_rate": limits.error_rate}

    def changed(name: str, here: Column) -> Column:
        mine = lambda more: F.when(here & more, seq)
        if name == "leading_t":
            return S.trim_leading(seq, "T")
        if name == "five_pattern":
            return S.strip_5p(F.upper(seq), limits.five_pattern)
        if name == "five_adapter_pattern":
            return after(spelled(F.when(five == "", limits.five_pattern_3reads).otherwise(five)))
        if name in ("five_adapter", "five_adapter_if_given"):
            return F.coalesce(X.trim_adapter_5p(mine(five != ""), five, **error), seq)
        if name == "three_adapter":
            both = (five != "") & (F.col("_protocol") != "3'READS")
            cut = [X.trim_adapters(mine(both & (three != "")), three, five, **error), X.trim_adapter_5p(mine(both & (three == "")), five, **error), X.trim_adapter_3p(mine(~both & (three != "")), three, **error)]
            return F.coalesce(*cut, seq)
        if name == "three_class":
            return F.when(kind == "", seq).otherwise(F.call_function("regexp_replace", seq, F.concat(F.lit("["), kind, F.lit("]+$")), F.lit("")))
        if name == "three_pattern":
            return S.strip_3p(F.upper(seq), limits.three_pattern)
        if name == "polya":
            return F.coalesce(X.trim_polya(F.when(here, seq), **error), seq)
        return S.reverse_complement(seq) if name == "revcomp" else F.when(F.coalesce("_reversed", F.lit(False)), S.reverse_complement(seq)).otherwise(seq)

    out, least = seq, F.lit(0)
    for name in names:
        here = F.col("_protocol").isin([p for p, steps in STEPS.items() if name in steps])
        out = F.when(here, changed(name, here)).otherwise(out)
        least = F.when(here, 1 if name in _SHORT else limits.min_length).otherwise(least)
    return reads.withColumns({"seq": out, "_least": least}).where(F.length("seq") >= F.col("_least")).drop("_least")


#: Steps in an order in which every protocol has its own; of those that stand together a protocol has one at most.
ORDER = (("leading_t", "five_pattern", "five_adapter_pattern", "five_adapter", "five_adapter_if_given"), ("three_adapter",), ("three_class",), ("revcomp", "revcomp_if_asked"), ("three_pattern",), ("polya",))


def valid_of_sheet(reads: DataFrame, sheet: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The reads (sample, seq, and more) of all samples of a sheet that are valid after their protocols' steps, with ``protocol``.

    sheet: sample_id, protocol, fiveAdapter, threeAdapter, readlen, reverse_compl.  The plan is one chain of steps, whatever the
    number of samples; adapters are columns.  Reads of samples that the sheet lacks go; an unknown protocol is an error.
    """
    known = F.when(F.col("protocol").isin(list(STEPS)), F.col("protocol")).otherwise(F.raise_error(F.concat(F.lit("unknown protocol: "), F.coalesce("protocol", F.lit("none")))))
    bound = F.when(F.col("protocol").isin(list(BOUNDED)) & (F.coalesce("readlen", F.lit(0)) > 0), F.col("readlen") - limits.least_shortening)
    of = sheet.select(F.col("sample_id").alias("_sample"), known.alias("_protocol"), F.col("fiveAdapter").alias("_five"), F.col("threeAdapter").alias("_three"), F.col("reverse_compl").alias("_reversed"), F.coalesce(bound, F.lit((1 << 31) - 1)).alias("_most"))
    rows = reads.join(of, F.col("sample") == F.col("_sample"))
    for names in ORDER:
        rows = _applied(rows, names, limits)
    good = S.is_valid_read(F.col("seq"), max_n=limits.max_n, max_a=limits.max_a, max_length=F.col("_most"))
    return rows.where(good).withColumn("protocol", F.col("_protocol")).select(*reads.columns, "protocol")


def correction_of(protocol: str | None) -> int:
    """By how much a protocol's 3' ends lie upstream."""
    return 1 if protocol == "DRS" else 0
