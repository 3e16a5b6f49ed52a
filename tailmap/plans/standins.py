"""Views that show the driver's tables as reads, sites, alignments, exons and features, the same in Spark and in DuckDB.

Each is SQL over the plain tables and keeps all of them; ``sql_of`` gives DuckDB's text, which differs in the flag that
replaces all matches and in how lists are made and unfolded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPARK = {"g": "", "list": "array", "series": "explode(sequence", "pieces": "posexplode_outer(pieces) as (i, piece)"}
_DUCK = {"g": ",'g'", "list": "list_value", "series": "unnest(generate_series", "pieces": "generate_subscripts(pieces, 1) - 1 as i, unnest(pieces) as piece"}
# The letters of a text become nucleotides, one letter each: reads of 120 one after another, the last of them shorter.  A
# text's first read has its id, the next that and 10^10, and so on; a text without letters is an empty read, null a null one.
READS = """select doc_id + cast(i as bigint) * 10000000000 as read_id, lang as sample, translate(lower(piece),'abcdefghijklmnopqrstuvwxyz','ACGTNAACGTATCAGTACTGATCGAA') as seq
  from (select doc_id, lang, {pieces}
  from (select doc_id, lang, case when length(letters) > 0 then regexp_extract_all(letters, '.{{1,120}}', 0) else {list}(letters) end as pieces
  from (select doc_id, lang, regexp_replace(text,'[^A-Za-z]',''{g}) as letters from documents) l) p) r"""
CONTIGS = """select concat('c', cast(doc_id as varchar(20))) as chr,
  translate(lower(regexp_replace(text,'[^A-Za-z]',''{g})),'abcdefghijklmnopqrstuvwxyz','ACGTNAACGTATCAGTACTGATCGAA') as seq
  from documents where text is not null"""
#: Seven sites at least, and the last behind the contig's end.
CONTIG_SITES = """select chr, case when k % 2 = 0 then '+' else '-' end as strand, cast(40 + k * 97 as bigint) as pos
  from (select concat('c', cast(doc_id as varchar(20))) as chr, {series}(1, greatest(7, cast(ceil(length(regexp_replace(text,'[^A-Za-z]',''{g})) / 97) as int)))) as k
  from documents where text is not null) s"""
SITES = """select concat('chr',cast(l_suppkey % 3 as varchar(9))) as chr, case when l_linestatus='O' then '+' else '-' end as strand,
  cast(l_partkey*3 + (l_orderkey % 3) as bigint) as pos, concat('S',cast(l_linenumber % 4 as varchar(9))) as sample, count(*) as cnt,
  l_partkey % 7 = 0 as is_ip
  from lineitem group by 1,2,3,4,6"""
#: Alignments of reads (orders) at several places.
HITS = """select concat('S',cast(l_orderkey % 5 as varchar(9))) as sample, l_orderkey as read_id, l_orderkey as qname, case when l_linestatus='O' then 0 else 16 end as flag,
  concat('chr',cast(l_suppkey % 3 as varchar(9))) as rname, l_partkey as pos, concat(cast(cast(l_quantity as int) as varchar(9)),'M',cast(l_linenumber as varchar(9)),'N10M') as cigar,
  l_linenumber % 3 as nm, cast(l_linenumber as varchar(9)) as md, 'A' as seq from lineitem"""
FEATURES = """select concat('chr',cast(o_custkey%3 as varchar(9))) as chr, case when o_orderstatus='O' then '+' else '-' end as strand,
  cast(o_orderkey%60000 as bigint) as s, cast(o_orderkey%60000+1+(o_custkey%400) as bigint) as e,
  case substring(o_orderpriority,1,1) when '1' then 'TE' when '2' then 'EX' when '3' then 'IN' when '4' then 'DS' else 'AE' end as feature,
  concat('g',cast(o_custkey%50 as varchar(9))) as gene_id, concat('n',cast(o_custkey%50 as varchar(9))) as gene_name
  from orders"""
#: Exons of transcripts (customers): ranges that do not overlap.
EXONS = """select concat('chr',cast(o_custkey%3 as varchar(9))) as chr, cast(row_number() over (partition by o_custkey order by o_orderkey)*1000 + o_orderkey%300 as bigint) as start0,
  cast(row_number() over (partition by o_custkey order by o_orderkey)*1000 + o_orderkey%300 + 100 + o_orderkey%200 as bigint) as end_,
  concat('t',cast(o_custkey as varchar(20))) as transcript_id, case when o_custkey%2=0 then '+' else '-' end as strand from orders"""
CLUSTERS = """select cast(p_partkey as bigint) as cluster_id, concat('chr',cast(p_partkey%3 as varchar(9))) as chr, case when p_size%2=0 then '+' else '-' end as strand,
  cast(p_partkey*3 as bigint) as s, cast(p_partkey*3+1+p_size as bigint) as e, cast(p_partkey*3+1 as bigint) as start1, cast(p_partkey*3+1+p_size as bigint) as \"end\",
  cast(p_partkey*3+2 as bigint) as rep, cast(p_retailprice as double) as total_tpm, p_partkey%5=0 as is_ip_candidate, p_partkey%4<>0 as has_pas from part"""
CLUSTER_TPM = """select cast(l_partkey as bigint) as cluster_id, concat('S',cast(l_suppkey%10 as varchar(9))) as sample, cast(sum(cast(l_quantity as int)%7) as double) as tpm from lineitem group by 1,2"""
SAMPLES = """select concat('S',cast(s_suppkey as varchar(9))) as sample, concat('P',cast(s_nationkey%4 as varchar(9))) as protocol, case when s_suppkey%2=0 then 'F' else 'M' end as sex from supplier"""
GTF = """select case when l_linenumber=1 then 'gene' else 'exon' end as feature, concat('g',cast(l_orderkey as varchar(20))) as gene_id,
  case when l_returnflag='A' then 'protein_coding' when l_returnflag='N' then 'lincRNA' else 'other' end as kind, cast(l_linenumber%6 as varchar(9)) as support, l_linenumber as n from lineitem"""

VIEWS = {"reads": READS, "contigs": CONTIGS, "contig_sites": CONTIG_SITES, "sites": SITES, "hits": HITS, "features": FEATURES, "exons": EXONS, "clusters": CLUSTERS, "cluster_tpm": CLUSTER_TPM, "samples": SAMPLES, "gtf": GTF}
_TABLES = ("documents", "lineitem", "orders", "part", "supplier")


#: Rows of ``lineitem`` that a task counts to sites.
SITE_ROWS = 500_000


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view of sites.  Rows are dealt by site to as many tasks as the table is long for, before they are counted.

    So what a task counts does not grow with the table, and what is summed up for each site needs no other shuffle.  Counting
    before rows are dealt would gain next to nothing, as few rows share a site and sample.
    """
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    inner, keys = SITES.split(" from lineitem")[0].replace("count(*) as cnt,", ""), ["chr", "strand", "pos", "sample"]
    tasks = max(spark.sparkContext.defaultParallelism, rows.count() // SITE_ROWS + 1)
    dealt = spark.sql(inner + " from {rows}", rows=rows).repartition(tasks, "chr", "strand", "pos")
    return dealt.groupBy(*keys, "is_ip").agg(F.count(F.lit(1)).alias("cnt")).select(*keys, "cnt", "is_ip")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame; the driver's tables are read through Spark."""
    if name == "sites":
        return _sites(spark, sf_dir)
    text = VIEWS[name].format(**_SPARK).replace('"end"', "`end`").replace("{", "{{").replace("}", "}}")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES if f" {t}" in text}
    for t in tables:
        text = text.replace(f"from {t}", f"from {{{t}}}")
    df = spark.sql(text, **tables)
    return df.withColumnRenamed("end_", "end")


def sql_of(*names: str) -> str:
    """A WITH clause for DuckDB of some views."""
    return "with " + ", ".join(f"{n} as ({VIEWS[n].format(**_DUCK)})" for n in names) + " "
