"""The library's registered queries: each applies an operator to a view of the driver's tables; and DuckDB's SQL for the same."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailmap.functions import sequence as S
from tailmap.functions import strings as X
from tailmap.operators import alignments, clusters, intervals, reads, sites, support
from tailmap.operators.lineage import shared_dir, stored
from tailmap.plans import pipeline
from tailmap.plans.standins import sql_of, view
from tailmap.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def _seqs(seq: str, where: str) -> str:
    return sql_of("reads") + f"select read_id, {seq} as seq from reads where {where}"


def _edited(spark: SparkSession, sf: str, seq: F.Column, least: int = 1) -> DataFrame:
    return reads.replace_seq(view(spark, sf, "reads"), seq, least=least).select("read_id", "seq")


# Reads

@_query(_seqs("regexp_extract(seq, '^..A(.*)$', 1)", "regexp_extract(seq, '^..A(.*)$', 1) <> ''"))
def seq_filter_5p(spark, sf):
    return _edited(spark, sf, S.strip_5p(F.col("seq"), "NNA"))


@_query(_seqs("regexp_extract(seq, '^(.*)AA$', 1)", "regexp_extract(seq, '^(.*)AA$', 1) <> ''"))
def seq_filter_3p(spark, sf):
    return _edited(spark, sf, S.strip_3p(F.col("seq"), "AA"))


@_query(_seqs("regexp_replace(seq, '^[T]+', '')", "length(regexp_replace(seq, '^[T]+', '')) >= 15"))
def seq_trim_lead(spark, sf):
    return _edited(spark, sf, S.trim_leading(F.col("seq"), "T"), 15)


@_query(_seqs("regexp_replace(seq, '[CA]+$', '')", "length(regexp_replace(seq, '[CA]+$', '')) >= 15"))
def seq_trim_tail(spark, sf):
    return _edited(spark, sf, S.trim_trailing(F.col("seq"), "CA"), 15)


@_query(_seqs("seq", "length(seq) <= 100"))
def seq_length(spark, sf):
    return reads.keep_short(view(spark, sf, "reads"), 100).select("read_id", "seq")


@_query(_seqs("seq", "length(seq) > 0 and (length(seq) - length(replace(seq, 'A', ''))) / length(seq) <= 0.35 or length(seq) = 0"))
def seq_composition(spark, sf):
    return view(spark, sf, "reads").where(S.composition_within(F.col("seq"), "A", 0.35)).select("read_id", "seq")


@_query(_seqs("seq", "seq not like '%A'"))
def seq_last_nuc(spark, sf):
    return view(spark, sf, "reads").where(~F.endswith("seq", F.lit("A"))).select("read_id", "seq")


_VALID = "length(seq) - length(replace(seq, 'N', '')) <= 12 and case when length(seq) = 0 then true else (length(seq) - length(replace(seq, 'A', ''))) / length(seq) <= 0.8 end and seq not like '%A'"


@_query(_seqs("seq", _VALID))
def valid_reads(spark, sf):
    return reads.valid_reads(view(spark, sf, "reads"), max_n=12).select("read_id", "seq")


@_query(_seqs("seq", _VALID + " and length(seq) <= 115"))
def valid_reads_maxlen(spark, sf):
    return reads.valid_reads(view(spark, sf, "reads"), max_n=12, max_length=115).select("read_id", "seq")


@_query(_seqs("reverse(translate(seq, 'ACGTacgt', 'TGCAtgca'))", "true"))
def revcomp(spark, sf):
    return view(spark, sf, "reads").select("read_id", S.reverse_complement(F.col("seq")).alias("seq"))


@_query(sql_of("reads") + "select sample, count(*) as reads, min(length(seq)) as min_length, max(length(seq)) as max_length from reads group by sample")
def read_metrics(spark, sf):
    return reads.read_metrics(view(spark, sf, "reads"))


@_query(sql_of("reads") + "select 'raw' as scope, sample, unnest(['reads', 'min_length', 'max_length']) as key, unnest([count(*), min(length(seq)), max(length(seq))]) as value from reads group by sample")
def metrics_long(spark, sf):
    return reads.metrics_long(reads.read_metrics(view(spark, sf, "reads")), "raw")


@_query(sql_of("reads") + "select read_id, seq from reads where read_id in (select o_orderkey from orders where o_orderkey % 3 = 0)")
def fasta_keep(spark, sf):
    return reads.keep_ids(view(spark, sf, "reads"), spark.read.parquet(f"{sf}/orders.parquet").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("read_id"))).select("read_id", "seq")


@_query(sql_of("reads") + "select read_id, seq from reads where read_id not in (select o_orderkey from orders where o_orderkey % 3 = 0)")
def fasta_discard(spark, sf):
    return reads.keep_ids(view(spark, sf, "reads"), spark.read.parquet(f"{sf}/orders.parquet").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("read_id")), mode="discard").select("read_id", "seq")


@_query(sql_of("reads") + "select read_id from reads")
def read_ids(spark, sf):
    return reads.id_list(view(spark, sf, "reads"))


@_query("select o_orderkey || chr(9) || o_orderstatus || ' ' || o_orderpriority as value from orders where o_orderstatus = 'F'")
def lines_with(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet")
    return intervals.lines_with(rows.select(F.concat(F.col("o_orderkey").cast("string"), F.lit("\t"), "o_orderstatus", F.lit(" "), "o_orderpriority").alias("value")), 2, "F")


# Sequence around sites

_WINDOW = "case when {s} >= 0 and {e} <= length(seq) then case when strand = '-' then reverse(translate(substr(seq, {s} + 1, {e} - {s}), 'ACGT', 'TGCA')) else substr(seq, {s} + 1, {e} - {s}) end end"
_S, _E = "(case when strand = '+' then pos - 1 - 60 else pos - 1 - 10 end)", "(case when strand = '+' then pos + 10 else pos + 60 end)"
_FLANKS = sql_of("contigs", "contig_sites") + ", f as (select s.chr, strand, pos, " + _WINDOW.format(s=_S, e=_E) + " as flank from contig_sites s left join contigs c on c.chr = s.chr) "


def _flanks(spark, sf):
    rows = view(spark, sf, "contig_sites")
    s, e = S.window(F.col("pos") - 1, F.col("pos"), F.col("strand"), 60, 10)
    return sites.fetch_windows(rows, sites.chunked(view(spark, sf, "contigs"), size=500), s, e, size=500)


@_query(_FLANKS + "select * from f")
def flank_fetch(spark, sf):
    return _flanks(spark, sf)


_DS = "substr(flank, 62, 10)"
_IP = f"coalesce(length(flank) <> 71, true) or coalesce(length({_DS}) - length(replace({_DS}, 'A', '')) >= 5 or regexp_matches({_DS}, 'A{{4}}') or regexp_matches({_DS}, '^(AGAA|AA)'), true)"


@_query(_FLANKS + f"select chr, strand, pos, {_IP} as is_ip from f")
def ip_flag(spark, sf):
    return sites.mark_internal_priming(_flanks(spark, sf), total_as=5, consecutive_as=4, patterns=("AGAA", "AA"))


_MOTIFS = ", ".join(f"'{m}'" for m in pipeline.SIGNALS)


@_query(
    sql_of("contigs", "contig_sites")
    + ", f as (select s.chr, strand, pos, " + _WINDOW.format(s="(case when strand = '+' then pos - 1 - 59 else pos - 1 - 10 end)", e="(case when strand = '+' then pos + 10 else pos + 59 end)") + " as flank from contig_sites s left join contigs c on c.chr = s.chr),"
    + f" w as (select *, unnest(range(0, 65)) as i from f where flank is not null) select chr, strand, pos, substr(flank, i::int + 1, 6) as motif, case when i < 60 then i - 60 else i - 59 end as rel, case when strand = '+' then pos - 59 + i else pos + 59 - i end as abs from w where substr(flank, i::int + 1, 6) in ({_MOTIFS})"
)
def pas_scan(spark, sf):
    rows = view(spark, sf, "contig_sites")
    s, e = S.window(F.col("pos") - 1, F.col("pos"), F.col("strand"), 59, 10)
    read = sites.fetch_windows(rows, sites.chunked(view(spark, sf, "contigs"), size=500), s, e, size=500)
    return read.select("chr", "strand", "pos", F.explode(S.polya_signals(F.col("flank"), F.col("pos"), F.col("strand"), pipeline.SIGNALS)).alias("p")).select("chr", "strand", "pos", "p.motif", "p.rel", "p.abs")


# Alignments

@_query(sql_of("hits") + "select read_id, rname, pos from hits qualify count(*) over (partition by read_id) = 1")
def unique_mappers(spark, sf):
    return alignments.unique_mappers(view(spark, sf, "hits")).select("read_id", "rname", "pos")


_BEST = sql_of("hits") + ", m as (select *, min(nm) over (partition by qname) as least from hits), b as (select *, count(*) over (partition by qname) as nh from m where nm = least) "


@_query(_BEST + "select qname, rname, pos, nm, nh from b where nh <= 2")
def best_alignments(spark, sf):
    return alignments.best_alignments(view(spark, sf, "hits"), keep_mm=2).select("qname", "rname", "pos", "nm", "nh")


@_query(_BEST + "select qname, count(*) as n from b group by qname having count(*) > 1")
def multimap_report(spark, sf):
    return alignments.multimap_report(alignments.best_alignments(view(spark, sf, "hits")))


@_query(sql_of("hits") + "select qname, flag, rname, pos, cigar, min(nm) as nm from (select * from hits union all select * from hits) group by all")
def distinct_alignments(spark, sf):
    twice = view(spark, sf, "hits")
    return alignments.distinct_alignments(twice.union(twice)).select("qname", "flag", "rname", "pos", "cigar", "nm")


@_query(sql_of("hits") + "select sample, count(*) as mapped, count(*) filter (n = 1) as \"unique\", count(*) filter (n > 1) as multi from (select sample, read_id, count(*) as n from hits group by all) group by sample")
def mapped_counts(spark, sf):
    return alignments.mapped_counts(view(spark, sf, "hits"))


_REF = "list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[MDN]', 1), lambda x: x::bigint))::bigint"


@_query(sql_of("hits") + f"select qname, pos - 1 as start0, pos - 1 + {_REF} as \"end\", case when flag & 16 <> 0 then '-' else '+' end as strand from hits")
def cigar_intervals(spark, sf):
    start = F.col("pos").cast("long") - 1
    return view(spark, sf, "hits").select("qname", start.alias("start0"), (start + S.reference_length(F.col("cigar"))).alias("end"), S.strand_of(F.col("flag")).alias("strand"))


def _bed(spark, sf):
    return view(spark, sf, "hits").select("sample", F.col("rname").alias("chr"), (F.col("pos") - 1).alias("start0"), (F.col("pos") - 1 + S.reference_length(F.col("cigar"))).alias("end"), "read_id", S.strand_of(F.col("flag")).alias("strand"))


_BED = sql_of("hits", "samples") + f", bed as (select sample, rname as chr, pos - 1 as start0, pos - 1 + {_REF} as \"end\", read_id, case when flag & 16 <> 0 then '-' else '+' end as strand from hits) "


@_query(_BED + "select chr, strand, case when strand = '+' then \"end\" + 1 else start0 + 1 - 1 end as pos, sample, count(*) as cnt from bed group by all")
def three_prime_ends(spark, sf):
    return sites.three_prime_ends(_bed(spark, sf), correction=1)


@_query(_BED + "select chr, strand, case when strand = '+' then \"end\" else start0 + 1 end as pos, sample, count(*) as cnt, string_agg(read_id::varchar, ',' order by read_id::varchar) as reads from bed group by all")
def named_three_prime_ends(spark, sf):
    return sites.three_prime_ends(_bed(spark, sf), names=True)


@_query(_BED + "select b.* from bed b left join samples s on s.sample = b.sample where not (coalesce(s.sex, '') = 'F' and b.chr in ('chr0', 'chr1') or coalesce(s.sex, '') <> 'F' and s.sex is not null and b.chr = 'chr0')")
def exclude_chr(spark, sf):
    return sites.exclude_chromosomes(_bed(spark, sf), view(spark, sf, "samples"), excluded=("chr0",), female="chr1")


_LIFT = (
    sql_of("hits", "exons")
    + ", model as (select *, row_number() over w as n, end_ - start0 as length, sum(end_ - start0) over (w rows unbounded preceding)::bigint as cum, case when strand = '-' then lag(start0) over w - end_ else start0 - lag(end_) over w end as intron "
    "from exons window w as (partition by transcript_id order by case when strand = '-' then -start0 else start0 end)), "
    "t as (select transcript_id, min(chr) as t_chr, min(strand) as t_strand, list(struct_pack(s := start0, e := end_, l := length, c := cum, i := intron) order by n) as ex from model group by transcript_id), "
    "h as (select qname, flag, 't' || pos as rname, qname % 150 + 1 as pos, nm, '5A14' as md, seq, 'I' as qual, nm * 40 + 20 as len from hits), "
    "o as (select *, pos + len - 1 as t_end, list_transform(list_filter(ex, lambda x: x.c >= pos and x.c - x.l < pos + len - 1), lambda x: struct_pack(o := least(x.c, pos + len - 1) - greatest(x.c - x.l + 1, pos) + 1, i := x.i, e := x.e, c := x.c, l := x.l)) as ov from h left join t on transcript_id = rname), "
    "j as (select *, coalesce(len(ov), 0) as n, t_chr is null or len(ov) < 1 or ov[len(ov)].c < t_end as outside from o), "
    "st as (select *, case when flag & 16 <> 0 then 'reverse_complemented' when t_chr is null then 'not_found' when len(ex) = 1 or (n = 1 and not outside) then 'no_junction' when n > 1 and ov[1].o < 1 then 'below_min_overlap' when outside then 'not_found' when n > 1 and ov[n].o < 1 then 'below_min_overlap' else 'lifted' end as status from j), "
    "f as (select *, status = 'lifted' as ok, status = 'lifted' and t_strand = '-' as turned  from st) "
)


def _spliced_sql() -> str:
    """The stretches and the gaps before them, in the order of the genome."""
    forward = "array_to_string(list_transform(ov, lambda x, k: case when k > 1 then x.i || 'N' || x.o || 'M' else x.o || 'M' end), '')"
    back = "array_to_string(list_reverse(list_transform(ov, lambda x, k: case when k > 1 then x.o || 'M' || x.i || 'N' else x.o || 'M' end)), '')"
    return f"case when not ok then len || 'M' when t_strand = '-' then {back} else {forward} end"


@_query(
    _LIFT + f"select qname, case when turned then case when flag = 0 then 16 else 0 end else flag end as flag, case when ok then t_chr else rname end as rname, "
    "(case when turned then ov[n].e - (t_end - (ov[n].c - ov[n].l)) + 1 when ok then ov[1].e - (ov[1].c - pos) else pos end)::bigint as pos, "
    f"{_spliced_sql()} as cigar, nm, case when turned then '14T5' else md end as md, case when turned then 'T' else seq end as seq, qual, status from f"
)
def lift_alignments(spark, sf):
    exons = view(spark, sf, "exons")
    hits = view(spark, sf, "hits").withColumns({"rname": F.concat(F.lit("t"), F.col("pos").cast("string")), "pos": F.col("read_id") % 150 + 1, "qual": F.lit("I"), "cigar": F.concat((F.col("nm") * 40 + 20).cast("string"), F.lit("M")), "md": F.lit("5A14")})
    return alignments.lift_alignments(hits.drop("sample", "read_id"), exons)


@_query(_LIFT + "select status, count(*) as alignments, count(*) * 100.0 / sum(count(*)) over () as percent from f group by status")
def lift_report(spark, sf):
    return alignments.lift_report(lift_alignments(spark, sf))


# What the CIGAR and the mismatches below make of 30 letters: positions 8, 13 and 24 are read in place of A, inserted, and read in place of T.
@_query(sql_of("reads") + "select read_id, '5MA' || substr(seq, 8, 1) || '4I' || substr(seq, 13, 1) || '7DCDG3MT' || substr(seq, 24, 1) || '4' as mmid from (select read_id, unnest(regexp_extract_all(seq, '.{30}')) as seq from reads)")
def mmid(spark, sf):
    # The CIGAR is of 30 letters: each 30 of a read are aligned by it.
    rows = view(spark, sf, "reads").where(F.length("seq") >= 30).select("read_id", F.explode(F.regexp_extract_all("seq", F.lit(".{30}"), F.lit(0))).alias("seq"))
    return rows.select("read_id", X.mmid(F.lit("2S10M1I7M2D8M2S"), F.lit("5A11^CG3T4"), F.col("seq")).alias("mmid"))


def _table_sql(name: str, seq: str, adapter: str, rate: float, overlap: int) -> str:
    """DuckDB's alignment table, a step for each letter of the read; cells are cost * 10^12 + matches * 10^6 + begin.

    The best place so far is (matches * 1000 + 999 - cost) * 10^6 + begin; of equal ones the first stays.
    """
    m, cost = len(adapter), lambda x: f"({x} // 1000000000000)"
    d, a, l = "r.cells[x[1]]", "acc[len(acc)]", "r.cells[x[1] + 1]"
    other = f"case when {cost(d)} <= {cost(a)} and {cost(d)} <= {cost(l)} then {d} when {cost(a)} <= {cost(l)} then {a} else {l} end + 1000000000000"
    places = str([[i] for i in range(1, m + 1)]) + "::bigint[][]"
    column = f"list_reduce({places}, lambda acc, x: list_append(acc, case when substr('{adapter}', x[1]::int, 1) = substr(r.seq, r.j + 1, 1) then {d} + 1000000 else {other} end), [r.j + 1])"
    score = f"(cells[x[1] + 1] // 1000000 % 1000000 * 1000 + 999 - {cost('cells[x[1] + 1]')})"
    better = f"{cost('cells[x[1] + 1]')} <= floor({rate} * x[1] + 1e-9) and {score} > acc[1] // 1000000 and (x[2] = 1 or j = length(seq))"
    offered = str([[m, 1]] * (m >= overlap) + [[i, 0] for i in range(overlap, m + 1)]) + "::bigint[][]"
    best = f"list_reduce({offered}, lambda acc, x: case when {better} then [{score} * 1000000 + cells[x[1] + 1] % 1000000] else acc end, [best])[1]"
    return (
        f"{name}_r as (select read_id, {seq} as seq, 0::bigint as j, -1::bigint as best, list_transform(range(0, {m + 1}), lambda i: i * 1000000000000) as cells from reads union all "
        f"select read_id, seq, j, {best}, cells from (select r.read_id, r.seq, r.j + 1 as j, r.best, {column} as cells from {name}_r r where r.j < length(r.seq))), "
        f"{name} as (select read_id, seq, case when best < 0 then length(seq) else best % 1000000 end as kept from {name}_r where j = coalesce(length(seq), 0))"
    )


@_query(
    sql_of("reads").replace("with ", "with recursive ", 1) + ", " + ", ".join([_table_sql("p3", "seq", "AGATCGGA", 0.3, 3), _table_sql("p5", "reverse(seq)", "GATTCCA"[::-1], 0.3, 3), _table_sql("pa", "seq", "A" * 14, 0.1, 1)])
    + " select read_id, left(p3.seq, p3.kept) as trimmed, right(reverse(p5.seq), p5.kept) as trimmed_5p, left(pa.seq, pa.kept) as tail_free from p3 join p5 using (read_id) join pa using (read_id)"
)
def adapter_trim(spark, sf):
    seq = F.col("seq")
    return view(spark, sf, "reads").select("read_id", X.trim_adapter_3p(seq, "AGATCGGA", error_rate=0.3).alias("trimmed"), X.trim_adapter_5p(seq, "GATTCCA", error_rate=0.3).alias("trimmed_5p"), X.trim_polya(seq).alias("tail_free"))


_SAM = sql_of("hits") + ", sam as (select *, 10 + nm * 5 as n from hits) "


def _sam(spark, sf):
    """Alignments of as many letters as their edit distance says, with one mismatch or none."""
    n = F.col("nm") * 5 + 10
    md = F.when(F.col("nm") == 0, n.cast("string")).otherwise(F.concat(F.lit("4C"), (n - 5).cast("string")))
    return view(spark, sf, "hits").withColumns({"cigar": F.concat(n.cast("string"), F.lit("M")), "md": md, "seq": F.expr("substring(repeat('ACGT', 5), 1, nm * 5 + 10)")})


@_query(_SAM + "select rname as chr, pos - 1 as start0, pos - 1 + n as \"end\", qname as read_id, nm, case when flag & 16 <> 0 then '-' else '+' end as strand, case when nm = 0 then n::varchar else '4MCA' || (n - 5) end as mmid from sam")
def sam_to_bed(spark, sf):
    return alignments.sam_to_bed(_sam(spark, sf))


@_query(_BEST + "select qname, count(*) as n from b group by qname having count(*) > 2")
def heavy_multimappers(spark, sf):
    return alignments.multimap_report(alignments.best_alignments(view(spark, sf, "hits")), more_than=2)


@_query(sql_of("hits") + "select qname, rname, pos, null as status from hits union all select qname, 't' || rname, pos, 'lifted' from hits where nm = 0")
def union_alignments(spark, sf):
    rows = view(spark, sf, "hits").select("qname", "rname", "pos")
    return sites.union_all(rows, view(spark, sf, "hits").where("nm = 0").select("qname", F.concat(F.lit("t"), F.col("rname")).alias("rname"), "pos", F.lit("lifted").alias("status")))


def _ends(where: str, correction: int) -> str:
    return f"case when strand = '+' then pos - 1 + 30 + {correction} else pos - 1 + 1 - {correction} end as pos{where}"


def _protocol_sql(correction: int, patterns: str) -> str:
    return (
        sql_of("contigs", "contig_sites") + f", r as (select chr, strand, {_ends('', correction)}, count(*) as cnt from contig_sites group by all), "
        "f as (select r.chr, strand, pos, cnt, " + _WINDOW.format(s=_S, e=_E) + " as flank from r left join contigs c on c.chr = r.chr) "
        f"select chr, strand, pos, 'S' as sample, cnt, coalesce(length(flank) <> 71, true) or coalesce(length({_DS}) - length(replace({_DS}, 'A', '')) >= 7 or regexp_matches({_DS}, 'A{{6}}'){patterns}, true) as is_ip from f"
    )


def _of_protocol(spark, sf, protocol):
    rows = view(spark, sf, "contig_sites").select(F.concat_ws(":", "chr", "pos").alias("qname"), F.when(F.col("strand") == "+", 0).otherwise(16).alias("flag"), F.col("chr").alias("rname"), "pos", F.lit("30M").alias("cigar"), F.lit("A" * 30).alias("seq"), F.lit(0).alias("nm"), F.lit("30").alias("md"))
    samples = spark.createDataFrame([("S", "M")], "sample string, sex string")
    # Every alignment is there twice: once on the genome, once lifted.
    return pipeline.sam_to_sites(rows, "S", protocol, samples, view(spark, sf, "contigs"), lifted=rows.withColumn("status", F.lit("lifted")))


@_query(_protocol_sql(1, ""))
def sites_of_protocol(spark, sf):
    return _of_protocol(spark, sf, "DRS")


@_query(_protocol_sql(0, f" or regexp_matches({_DS}, '^(AGAA|AA)')"))
def sites_of_3reads(spark, sf):
    return _of_protocol(spark, sf, "3'READS")


# Sites

@_query(sql_of("sites") + "select chr, strand, pos, sample, cnt, row_number() over (order by chr, case when strand = '+' then 0 else 1 end, pos, sample) as idx from sites")
def numbered_sites(spark, sf):
    return sites.numbered_sites(view(spark, sf, "sites").select("chr", "strand", "pos", "sample", "cnt"))


@_query(sql_of("contigs") + "select chr, length(seq) as size from contigs")
def chrom_sizes(spark, sf):
    return sites.chrom_sizes(view(spark, sf, "contigs"))

@_query(sql_of("sites") + "select sample, sum(cnt)::bigint as libsize from sites where not is_ip group by sample")
def lib_sizes(spark, sf):
    return sites.library_sizes(view(spark, sf, "sites"))


_PIVOT = ", ".join(f"coalesce(sum(cnt) filter (sample = 'S{i}'), 0)::bigint as \"S{i}\"" for i in range(4))


@_query(sql_of("sites") + f"select chr, strand, pos, {_PIVOT} from sites where not is_ip group by chr, strand, pos")
def pool_sites(spark, sf):
    return sites.pool(view(spark, sf, "sites"), ["S0", "S1", "S2", "S3"])


_TPM = sql_of("sites") + ", l as (select sample, sum(cnt) as libsize from sites where not is_ip group by sample), t as (select s.*, round(cnt * 1e6 / libsize, 6) as tpm from sites s join l using (sample) where not is_ip) "


def _tpm(spark, sf):
    rows = view(spark, sf, "sites")
    return sites.tpm(rows.where(~F.col("is_ip")), sites.library_sizes(rows))


@_query(_TPM + "select chr, strand, pos, sample, round(tpm, 3) as tpm from t")
def site_tpm(spark, sf):
    return _tpm(spark, sf).select("chr", "strand", "pos", "sample", F.round("tpm", 3).alias("tpm"))


@_query(_TPM + "select chr, strand, pos, count(*) as n_supported, round(sum(tpm) / 4, 3) as mean_tpm from t group by chr, strand, pos")
def site_support(spark, sf):
    return sites.site_support(_tpm(spark, sf), 4).select("chr", "strand", "pos", "n_supported", F.round("mean_tpm", 3).alias("mean_tpm"))


_COUNTS = "select sample, count(*) filter (strand = '+') as plus_sites, count(*) filter (strand <> '+') as minus_sites, coalesce(sum(cnt) filter (strand = '+'), 0)::bigint as plus_reads, coalesce(sum(cnt) filter (strand <> '+'), 0)::bigint as minus_reads from sites {} group by sample"


@_query(sql_of("sites") + _COUNTS.format(""))
def strand_counts(spark, sf):
    return sites.strand_counts(view(spark, sf, "sites"))


@_query(sql_of("sites") + _COUNTS.format("where is_ip"))
def ip_counts(spark, sf):
    return sites.strand_counts(view(spark, sf, "sites"), only_ip=True)


_MARKED = sql_of("sites") + ", marked as (select chr, strand, pos, sample, case when pos % 5 = 0 then 0 else cnt end as cnt, pos % 3 <> 0 as has_pas from sites) "


def _marked(spark, sf):
    return view(spark, sf, "sites").select("chr", "strand", "pos", "sample", F.when(F.col("pos") % 5 == 0, 0).otherwise(F.col("cnt")).alias("cnt"), (F.col("pos") % 3 != 0).alias("has_pas"))


@_query(_MARKED + "select chr, strand, pos, sample, cnt from marked where cnt > 0")
def nobg_overwrite(spark, sf):
    rows = view(spark, sf, "sites").select("chr", "strand", "pos", "sample", "cnt")
    return sites.overwrite_counts(rows, _marked(spark, sf)).select("chr", "strand", "pos", "sample", "cnt")


@_query(_MARKED + "select chr, strand, pos from marked group by all having max(cnt) > 0")
def nobg_filter(spark, sf):
    return sites.supported_sites(_marked(spark, sf))


@_query(
    _MARKED + "select *, (floor(pas_sites * 100 / sites))::bigint as pas_sites_percent, (floor(pas_reads * 100 / reads))::bigint as pas_reads_percent from "
    "(select sample, count(*) as sites, sum(cnt)::bigint as reads, count(*) filter (has_pas) as pas_sites, coalesce(sum(cnt) filter (has_pas), 0)::bigint as pas_reads from marked where cnt > 0 group by sample)"
)
def nobg_per_sample(spark, sf):
    return sites.noise_free_metrics(_marked(spark, sf))


_BINNED = _MARKED + ", c as (select sample, chr, strand, pos // 25 as seed, max(cnt) as seed_cnt, sum(cnt)::bigint as reads, max(has_pas) as has_pas from marked where cnt > 0 group by all), "


@_query(
    _BINNED + "o as (select *, row_number() over w - 1 as idx, count(*) over (partition by sample) as n, max(reads) over (partition by sample) as largest, "
    "round(sum(has_pas::int) over (w rows unbounded preceding) * 100 / row_number() over w, 2) as pc from c window w as (partition by sample order by reads desc, chr || ':' || strand, seed_cnt desc, seed)), "
    "f as (select sample, arg_min(case when idx = n // 100 + 1 then largest else reads end, idx) as cut from o where idx >= n // 100 + 1 and pc < 98.9 group by sample) "
    "select s.sample, coalesce(cut, 0)::bigint as read_cutoff from (select distinct sample from c) s left join f using (sample)"
)
def sample_cutoff(spark, sf):
    binned = _marked(spark, sf).where("cnt > 0").groupBy("sample", "chr", "strand", F.floor(F.col("pos") / 25).alias("seed")).agg(F.max("cnt").alias("seed_cnt"), F.sum("cnt").alias("reads"), F.max("has_pas").alias("has_pas"))
    return clusters.read_cutoffs(binned, cutoff=98.9)


def _claimed(rows: str, keys: str, order: str, reach: int) -> str:
    """DuckDB's claims over a table: seeds are folded in the order of their rank, and a site goes to the first that reaches it."""
    near = f"q - {reach} and q + {reach}"
    return (
        f"o as (select {keys}, list([pos] order by {order}, pos) as ps from {rows} group by {keys}), "
        f"seeds as (select {keys}, list_reduce(ps, lambda a, x: case when len(list_filter(a, lambda q: x[1] between {near})) = 0 then list_concat(a, x) else a end) as seeds from o), "
        f"claimed as (select r.*, list_filter(seeds, lambda q: pos between {near})[1] as seed from {rows} r join seeds using ({keys})) "
    )


_MINI = _MARKED + ", kept as (select * from marked where cnt > 0), " + _claimed("kept", "sample, chr, strand", "cnt desc", 25) + (
    ", mini as (select sample, chr, strand, seed, max(case when pos = seed then cnt end) as seed_cnt, sum(cnt)::bigint as reads, max(has_pas) as has_pas, list(pos order by pos) as positions from claimed group by sample, chr, strand, seed) "
)


@_query(_MINI + "select * replace (array_to_string(positions, ',') as positions) from mini")
def mini_clusters(spark, sf):
    return clusters.mini_clusters(_marked(spark, sf)).withColumn("positions", F.array_join(F.col("positions").cast("array<string>"), ","))


@_query(
    _MINI + ", r as (select *, row_number() over w - 1 as idx, count(*) over (partition by sample) as n, max(reads) over (partition by sample) as largest, "
    "round(sum(has_pas::int) over (w rows unbounded preceding) * 100 / row_number() over w, 2) as pc from mini window w as (partition by sample order by reads desc, chr || ':' || strand, seed_cnt desc, seed)), "
    "f as (select sample, arg_min(case when idx = n // 100 + 1 then largest else reads end, idx) as cut from r where idx >= n // 100 + 1 and pc < 98.9 group by sample), "
    "good as (select sample, chr, strand, unnest(positions) as pos from mini left join f using (sample) where reads > coalesce(cut, 0)) "
    "select m.* from marked m semi join good g on m.sample = g.sample and m.chr = g.chr and m.strand = g.strand and m.pos = g.pos"
)
def above_background(spark, sf):
    return clusters.above_background(_marked(spark, sf), cutoff=98.9)


def _signals(rows):
    """Signals made of positions, for clustering."""
    one = lambda off, p: F.struct(F.lit("AATAAA").alias("motif"), (F.lit(-20) + off).cast("int").alias("rel"), (p - 20 + off).cast("long").alias("abs"))
    p = F.col("pos")
    return rows.select("chr", "strand", "pos", F.when(p % 4 != 0, F.array(one(F.pmod(p, F.lit(17)), p), one(F.pmod(p, F.lit(5)), p))).otherwise(F.array().cast(clusters.PAS)).alias("pas"))


def _primary(spark, sf):
    backed = stored(sites.site_support(_tpm(spark, sf), 4), "backed")  # read for the signals as well
    return clusters.primary_clusters(backed, pas=_signals(backed))


def _merged(spark, sf):
    return clusters.merge_clusters(_primary(spark, sf), split_gap=100)


def _flat(rows):
    """Clusters with signals and samples as text."""
    pas = F.array_join(F.transform("pas", lambda p: F.concat_ws(":", p["motif"], p["rel"].cast("string"), p["abs"].cast("string"))), ",")
    tpm = F.array_join(F.transform(F.array_sort(F.map_entries("tpm")), lambda e: F.format_string("%s=%.6f", e["key"], e["value"])), ",")
    return rows.withColumns({"pas": pas, "tpm": tpm, "total_tpm": F.round("total_tpm", 8)})


_PAS_TEXT = "case when rep % 4 <> 0 then 'AATAAA:' || (-20 + rep % 17) || ':' || (rep - 20 + rep % 17) || ',AATAAA:' || (-20 + rep % 5) || ':' || (rep - 20 + rep % 5) else '' end"


_PRIMARY = (
    _TPM + ", backed as (select chr, strand, pos, count(*) as n_supported, round(sum(tpm) / 4, 9) as mean_tpm from t group by chr, strand, pos), " + _claimed("backed", "chr, strand", "n_supported desc, mean_tpm desc", 12)
    + ", m as (select c.*, sample, tpm, max(tpm) over (partition by c.chr, c.strand, seed, sample) as most from claimed c join t on t.chr = c.chr and t.strand = c.strand and t.pos = c.pos), "
    "v as (select chr, strand, seed, pos, count(*) as votes from m where tpm = most group by all), "
    "rep as (select chr, strand, seed, arg_max(pos, {'v': votes, 'd': case when strand = '-' then -pos else pos end}) as voted from v group by all), "
    "per_sample as (select chr, strand, seed, sample, round(sum(tpm), 6) as tpm from m group by all), "
    "per as (select chr, strand, seed, string_agg(sample || '=' || printf('%.6f', tpm), ',' order by sample) as tpm from per_sample group by all), "
    "w as (select chr, strand, seed, min(pos) as start1, max(pos) as \"end\", round(sum(mean_tpm), 8) as total_tpm, bool_or(pos % 4 <> 0 and pos % 17 >= 14) as is_ip_candidate, arg_max(pos, case when strand = '-' then -pos else pos end) as last from claimed group by all), "
    "d as (select w.*, per.tpm, case when is_ip_candidate then last else voted end as rep from w join rep using (chr, strand, seed) join per using (chr, strand, seed)) "
)


@_query(_PRIMARY + "select chr, strand, start1, \"end\", rep, total_tpm, " + _PAS_TEXT + " as pas, is_ip_candidate, tpm from d")
def greedy_clusters(spark, sf):
    return _flat(_primary(spark, sf))


def _chain_sql(name: str, source: str, joins: str) -> str:
    """Neighbours r (what has been merged) and b of a line, merged from left to right where ``joins``; the larger total leads."""
    return (
        f"{name}_n as (select chr, strand, rep, m, total, start1, \"end\", members, row_number() over (partition by chr, strand order by rep, start1) as n from {source}), "
        f"{name}_r as (select chr, strand, n, n as g, rep, m, total, start1, \"end\", members, start1 as first_start, \"end\" as last_end from {name}_n where n = 1 union all "
        f"select b.chr, b.strand, b.n, case when {joins} then r.g else b.n end, case when {joins} and r.total >= b.total then r.rep else b.rep end, case when {joins} and r.total >= b.total then r.m else b.m end, "
        f"b.total + case when {joins} then r.total else 0 end, case when {joins} then least(r.start1, b.start1) else b.start1 end, case when {joins} then greatest(r.\"end\", b.\"end\") else b.\"end\" end, "
        f"case when {joins} then list_concat(r.members, b.members) else b.members end, case when {joins} then r.first_start else b.start1 end, b.\"end\" "
        f"from {name}_r r join {name}_n b on b.chr = r.chr and b.strand = r.strand and b.n = r.n + 1), "
        f"{name} as (select * from {name}_r qualify n = max(n) over (partition by chr, strand, g)), "
    )


def _merging_sql(compat: bool) -> str:
    """The four phases in DuckDB: the first as a join, the others as runs along a strand."""
    seen = "not (b.n = (select max(x.n) from phase4_n x where x.chr = b.chr and x.strand = b.strand)) and " if compat else ""
    ends = "max(n) over (partition by chr, strand) as last_n"
    kept = "len(m) > 0 or last_end - first_start <= 50" + (" or n = last_n or n = last_n - 1" if compat else "")
    # Of a last run that is too wide its last cluster stays as it was.
    spared = "not (len(m) > 0 or last_end - first_start <= 50) and n = last_n - 1" if compat else "false"
    return (
        _PRIMARY.replace("with ", "with recursive ", 1)
        + ", line as (select chr, strand, start1, \"end\", rep, total_tpm as total, is_ip_candidate as ip, [rep] as members, case when strand = '+' then 1 else -1 end as sign, "
        "case when rep % 4 <> 0 then [rep - 20 + rep % 17, rep - 20 + rep % 5] else []::bigint[] end as m from d), "
        "placed as (select *, row_number() over (partition by chr, strand order by sign * rep) as o from line), "
        "followed as (select *, min(case when not ip then o end) over (partition by chr, strand order by o rows between 1 following and unbounded following) as k from placed), "
        "judged as (select i.*, i.ip and k.o is not null and len(list_intersect(i.m, k.m)) > 0 and len(list_filter(k.m, lambda x: not list_contains(i.m, x) and (x - i.rep) * i.sign > 0)) = 0 as joins, "
        "len(i.m) = 0 or abs(i.rep - case when i.sign = 1 then list_max(i.m) else list_min(i.m) end) >= 15 as stays from followed i left join placed k on k.chr = i.chr and k.strand = i.strand and k.o = i.k), "
        "aims as (select *, case when joins then k else o end as target from judged where not ip or joins or stays), "
        "phase1 as (select chr, strand, min(start1) as start1, max(\"end\") as \"end\", arg_min(rep, joins::int) as rep, sum(total) as total, arg_min(m, joins::int) as m, flatten(list(members)) as members from aims group by chr, strand, target), "
        + _chain_sql("phase2", "phase1", "(len(r.m) > 0 and len(b.m) > 0 and case when r.strand = '+' then list_has_all(r.m, b.m) else list_has_all(b.m, r.m) end)")
        + _chain_sql("phase3", "phase2", "(b.\"end\" - r.start1 + 1 <= 25)")
        + _chain_sql("phase4", "phase3", f"({seen}len(r.m) = 0 and len(b.m) = 0 and b.start1 - r.last_end <= 12)")
        + f"told as (select *, {ends} from phase4), out as (select chr, strand, case when {spared} then (select struct_pack(a := x.start1, b := x.\"end\", r := x.rep, t := x.total, w := x.members) from phase4_n x where x.chr = told.chr and x.strand = told.strand and x.n = told.n) "
        f"else struct_pack(a := start1, b := \"end\", r := rep, t := total, w := members) end as c from told where {kept}), "
        "final as (select chr, strand, c.a as start1, c.b as \"end\", c.r as rep, c.t as total, c.w as members from out), "
        "sums as (select chr, strand, rep, string_agg(sample || '=' || printf('%.6f', tpm), ',' order by sample) as tpm from (select f.chr, f.strand, f.rep, sample, sum(p.tpm) as tpm "
        "from (select chr, strand, rep, unnest(members) as member from final) f join d on d.chr = f.chr and d.strand = f.strand and d.rep = f.member join per_sample p on p.chr = d.chr and p.strand = d.strand and p.seed = d.seed group by all) group by chr, strand, rep) "
        "select f.chr, f.strand, start1, \"end\", rep, round(total, 8) as total_tpm, " + _PAS_TEXT + " as pas, false as is_ip_candidate, sums.tpm from final f join sums using (chr, strand, rep)"
    )


@_query(_merging_sql(False))
def merged_clusters(spark, sf):
    return _flat(_merged(spark, sf))


@_query(_merging_sql(True))
def merged_clusters_compat(spark, sf):
    return _flat(clusters.merge_clusters(_primary(spark, sf), compat="reference"))


@_query(sql_of("clusters") + "select count(*) as clusters, round(sum(total_tpm), 3) as total_tpm, round(sum(case when \"end\" > start1 then total_tpm else 0 end) * 100 / sum(total_tpm), 6) as percent_wide from clusters")
def cluster_statistics(spark, sf):
    return clusters.cluster_statistics(view(spark, sf, "clusters")).withColumns({"total_tpm": F.round("total_tpm", 3), "percent_wide": F.round("percent_wide", 6)})


# Intervals

_MODEL = sql_of("exons") + """, m as (select chr, transcript_id, strand, start0, end_, row_number() over w as n, count(*) over (partition by transcript_id) as exons, sum(end_ - start0) over (w rows unbounded preceding) as cum_length,
    case when strand = '-' then lag(start0) over w - end_ else start0 - lag(end_) over w end as intron from exons window w as (partition by transcript_id order by case when strand = '-' then -start0 else start0 end)) """


@_query(_MODEL + "select chr, transcript_id, strand, start0, end_ as \"end\", n, exons, end_ - start0 as length, cum_length::bigint as cum_length, intron from m")
def exon_model(spark, sf):
    return alignments.exon_model(view(spark, sf, "exons"))


@_query(
    _MODEL + ", p as (select *, case when strand = '-' then '+' else '-' end as other, case when strand = '-' then end_ else start0 - intron end as g from m) "
    "select chr, strand, start0 as s, end_ as e, 'EX' as feature, transcript_id from p union all select chr, strand, start0, end_, 'TE', transcript_id from p where n = exons "
    "union all select chr, strand, case when strand = '-' then start0 - 1000 else end_ end, case when strand = '-' then start0 else end_ + 1000 end, 'DS', transcript_id from p where n = exons "
    "union all select chr, strand, g, g + intron, 'IN', transcript_id from p where intron > 0 union all select chr, other, start0, end_, 'AE', transcript_id from p where exons > 1 "
    "union all select chr, other, g, g + intron, 'AI', transcript_id from p where intron > 0 "
    "union all select chr, other, case when strand = '-' then end_ else start0 - 1000 end, case when strand = '-' then end_ + 1000 else start0 end, 'AU', transcript_id from p where n = 1"
)
def feature_model(spark, sf):
    return intervals.feature_model(view(spark, sf, "exons"))


_MET = "c.chr = f.chr and c.strand = f.strand and c.s < f.e and f.s < c.e"
_ANNOTATED = sql_of("clusters", "features") + f", a as (select c.cluster_id, coalesce(arg_min(feature, list_position(['TE','EX','IN','DS','AE','AI','AU'], feature)), 'IG') as annotation from clusters c left join features f on {_MET} group by c.cluster_id) "


@_query(_ANNOTATED + "select * from a")
def annotate_clusters(spark, sf):
    return intervals.annotate(view(spark, sf, "clusters"), view(spark, sf, "features")).select("cluster_id", "annotation")


@_query(sql_of("clusters", "features") + f"select c.cluster_id, string_agg(gene_name, '|' order by gene_id, gene_name) as gene_name, string_agg(gene_id, '|' order by gene_id, gene_name) as gene_id from clusters c left join features f on {_MET} group by c.cluster_id")
def gene_overlap(spark, sf):
    return intervals.gene_overlaps(view(spark, sf, "clusters"), view(spark, sf, "features")).select("cluster_id", "gene_name", "gene_id")


@_query(sql_of("gtf") + "select g.* from gtf g where feature = 'gene' and gene_id in (select gene_id from gtf where kind in ('protein_coding', 'lincRNA') and support::int <= 3 and feature <> 'gene') union all select * from gtf where feature <> 'gene' and kind in ('protein_coding', 'lincRNA') and support::int <= 3")
def gtf_filter(spark, sf):
    return intervals.genes_with_kept(view(spark, sf, "gtf"), ("protein_coding", "lincRNA"), level=3)


# Atlas

_SUPPORT = sql_of("clusters", "cluster_tpm", "samples") + ", sup as (select cluster_id, count(distinct s.sample) filter (tpm > 0) / (select count(*) from samples) as frac_samples, count(distinct protocol) filter (tpm > 0)::int as nr_prots from cluster_tpm t left join samples s using (sample) group by cluster_id) "


@_query(_SUPPORT + "select cluster_id, round(frac_samples, 6) as frac_samples, nr_prots from sup")
def cluster_support(spark, sf):
    return support.cluster_support(view(spark, sf, "cluster_tpm"), view(spark, sf, "samples")).withColumn("frac_samples", F.round("frac_samples", 6))


@_query(_ANNOTATED + "select n as annotation, count(cluster_id) as clusters from (select unnest(['TE','EX','IN','DS','AE','AI','AU','IG']) as n) left join a on a.annotation = n group by n")
def annotation_histogram(spark, sf):
    return support.annotation_histogram(intervals.annotate(view(spark, sf, "clusters"), view(spark, sf, "features")))


@_query(sql_of("clusters") + "select count(*) as clusters, count(*) filter (has_pas) as with_pas, floor(count(*) filter (has_pas) * 100 / count(*))::bigint as percent from clusters")
def atlas_statistics(spark, sf):
    return support.atlas_statistics(view(spark, sf, "clusters"))


@_query(
    _SUPPORT + "select t.sample, c.chr, c.start1 - 1 as start0, c.\"end\", c.chr || ':' || c.rep || ':' || c.strand as name, printf('%.4f', t.tpm) as tpm, c.strand, printf('%.2f', frac_samples) as frac_samples, nr_prots, printf('%.4f', total_tpm) as total_tpm, 'TE' as annotation, 'NA' as pas "
    "from (select cluster_id, sample, tpm from cluster_tpm union all select cluster_id, 'atlas', total_tpm from clusters) t join clusters c using (cluster_id) join sup using (cluster_id)"
)
def sample_bed(spark, sf):
    rows = view(spark, sf, "cluster_tpm")
    backed = view(spark, sf, "clusters").join(support.cluster_support(rows, view(spark, sf, "samples")), "cluster_id").withColumns({"annotation": F.lit("TE"), "pas": F.lit("NA")})
    return sinks.cluster_bed_rows(backed, rows)


_BEDGRAPH = sql_of("clusters", "cluster_tpm") + "select sample, strand, 'ucsc_' || chr as chr, start1 - 1 as start0, \"end\", printf('%.4f', tpm) as tpm from cluster_tpm join clusters using (cluster_id) where tpm > 0 and chr in ('chr0', 'chr1')"


@_query(_BEDGRAPH)
def bedgraph(spark, sf):
    names = spark.createDataFrame([("chr0", "ucsc_chr0"), ("chr1", "ucsc_chr1")], "chr string, ucsc string")
    return sinks.bedgraph_rows(view(spark, sf, "clusters"), view(spark, sf, "cluster_tpm"), names)


@_query(_BEDGRAPH)
def written_tracks(spark, sf):
    """The tracks as they are in their files: written compressed, a folder for each sample and strand, and read back."""
    path = f"{shared_dir(spark)}/tracks-{uuid.uuid4().hex}"
    sinks.write_tracks(bedgraph(spark, sf), path, ["sample", "strand"])
    return spark.read.schema("chr string, start0 long, end long, tpm string, sample string, strand string").csv(path, sep="\t")


@_query(
    sql_of("samples") + "select sample, strand, 'track type=bigWig name=\"' || sample || ' ' || strand || '\" description=\"' || sample || ', ' || strand || ' strand\" visibility=\"full\" color=\"' || case when strand = 'plus' then '0,0,255' else '255,0,0' end || '\" bigDataUrl=\"http://host/' || sample || '_' || strand || '.bw\"' as line "
    "from samples, (select unnest(['plus', 'minus']) as strand)"
)
def track_info(spark, sf):
    return sinks.track_lines(view(spark, sf, "samples"), "http://host")


@_query(sql_of("clusters") + "select chr, start1 as start, \"end\", chr || ':' || rep || ':' || strand as name, total_tpm, strand from clusters where not is_ip_candidate")
def locus_table(spark, sf):
    return intervals.sorted_for_lookup(sinks.locus_rows(view(spark, sf, "clusters")), start="start")


@_query("select coalesce(i.c_custkey, c.c_custkey) as c_custkey, coalesce(i.c_name, c.c_name) as c_name, round(coalesce(i.c_acctbal, c.c_acctbal), 2) as c_acctbal from (select * from customer where c_custkey % 3 <> 0) c full join (select c_custkey, case when c_custkey % 4 = 0 then null else 'new' end as c_name, c_acctbal + 1 as c_acctbal from customer where c_custkey % 2 = 0) i on i.c_custkey = c.c_custkey")
def upsert_documents(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name", "c_acctbal")
    new = c.where("c_custkey % 2 = 0").select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, "new").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return support.upsert(c.where("c_custkey % 3 <> 0"), new, ["c_custkey"]).withColumn("c_acctbal", F.round("c_acctbal", 2))


@_query("select c_custkey, c_name from customer where c_custkey % 3 <> 0 union all select c_custkey, 'new' from customer where c_custkey % 3 = 0")
def insert_absent(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name")
    return support.insert_absent(c.where("c_custkey % 3 <> 0"), c.withColumn("c_name", F.lit("new")), ["c_custkey"])


@_query(sql_of("reads") + "select sample, '{\"reads.GRCh38.n\":' || count(*) || ',\"reads.raw.max\":' || max(length(seq)) || '}' as document from reads where sample is not null group by sample")
def documents(spark, sf):
    per = view(spark, sf, "reads").where("sample is not null").groupBy("sample").agg(F.count(F.lit(1)).alias("reads.n"), F.max(F.length("seq")).cast("long").alias("reads.raw.max"))
    return support.documents(per.unpivot(["sample"], [F.col("`reads.n`"), F.col("`reads.raw.max`")], "key", "value"), "GRCh38")


_LABELS = ", ".join(f"coalesce(sum(tpm) filter (sample = 'S{i}'), 0) as \"S{i}|P||t|\"" for i in range(10))


@_query(
    sql_of("clusters", "cluster_tpm", "features") + f", g as (select c.cluster_id, string_agg(gene_name, '|' order by gene_id, gene_name) as gene_name, string_agg(gene_id, '|' order by gene_id, gene_name) as gene_id from clusters c left join features f on {_MET} group by c.cluster_id), "
    f"w as (select c.cluster_id, {_LABELS} from clusters c left join cluster_tpm t using (cluster_id) group by c.cluster_id) "
    "select chr, start1 as start, \"end\", chr || ':' || rep || ':' || strand as name, total_tpm, strand, gene_name, gene_id, w.* exclude (cluster_id) from clusters c join g using (cluster_id) join w using (cluster_id) where not is_ip_candidate"
)
def locus_file(spark, sf):
    rows = view(spark, sf, "clusters")
    sheet = spark.createDataFrame([(f"S{i}", "P", None, "t", None) for i in range(10)], "sample string, protocol string, source string, title string, treatment string")
    full = sinks.locus_rows(rows, intervals.counted_genes(rows, view(spark, sf, "features")), view(spark, sf, "cluster_tpm"), sinks.described_samples(sheet))
    # Genes are spelled out after rows are sorted: a sort would hold the long texts of all clusters of a place.
    return intervals.sorted_for_lookup(full, start="start").withColumns({c: intervals.spelled(F.col(c)) for c in ("gene_name", "gene_id")})


@_query(
    sql_of("reads") + "select sample, '{\"protocol\":\"3P-Seq\",\"reads\":{\"GRCh38\":{\"nr\":' || count(*) || '},\"raw\":{\"length\":{\"max\":' || max(length(seq)) || '}},\"valid\":{\"cutoffs\":{\"GRCh38\":{\"maxLength\":' || (max(length(seq)) - 2) || '}}}}}' as document from reads where sample is not null group by sample"
)
def nested_documents(spark, sf):
    per = view(spark, sf, "reads").where("sample is not null").groupBy("sample").agg(F.count(F.lit(1)).alias("nr"), F.max(F.length("seq")).cast("long").alias("longest"))
    keys = {"reads.nr": F.col("nr"), "reads.raw.length.max": F.col("longest"), "reads.valid.cutoffs.maxLength": support.longest_read(F.lit("3P-Seq"), F.col("longest"))}
    metrics = per.select("sample", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("long").alias("value")) for k, v in keys.items()])).alias("m")).select("sample", "m.*")
    return support.nested_documents(metrics, "GRCh38", per.select("sample", F.lit("protocol").alias("key"), F.lit("3P-Seq").alias("text")))


_KEYS_SQL = " || ',' || ".join([f"'\"{k}\":\"' || {c} || '\"'" if c in ("protocol", "sex") else f"'\"{k}\":null'" for k, c in support.SHEET_KEYS.items()])
_COUNTERS = json.dumps(support.SKELETON, separators=(",", ":"))[1:-1]


@_query(sql_of("samples") + f"select sample, '{{\"GEOsampleID\":\"' || sample || '\",\"sample_genome_id\":\"' || sample || '_G\",\"genome\":\"G\",' || {_KEYS_SQL} || ',{_COUNTERS},\"log\":[]}}' as document from samples")
def skeleton_documents(spark, sf):
    return support.skeleton_documents(view(spark, sf, "samples"), "G")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Sites of all samples, normalized, clustered and merged."""
    return _merged(spark, sf)
