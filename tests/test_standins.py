"""The views keep the whole tables."""

from pyspark.sql import functions as F

from tailmap.operators import sites
from tailmap.plans import standins
from tailmap.plans.standins import view
from tailmap.queries import QUERIES

SF = "/root/testdata/sf0.001"


def letters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null")
    return docs.select("doc_id", F.length(F.regexp_replace("text", "[^A-Za-z]", "")).alias("n"))


def test_reads_hold_every_letter(spark):
    reads = view(spark, SF, "reads").select(F.pmod("read_id", F.lit(10**10)).alias("doc_id"), "read_id", F.length("seq").alias("n"))
    assert reads.select("read_id").distinct().count() == reads.count()
    assert reads.agg(F.max("n")).first()[0] == 120
    got = reads.groupBy("doc_id").agg(F.sum("n").alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {r.doc_id: r.n for r in letters(spark).collect()}
    assert QUERIES["mmid"](spark, SF).count() == reads.agg(F.sum(F.floor(F.col("n") / 30))).first()[0]


def test_reads_in_order(spark):
    text = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id = 3").first().text
    kept = "".join(c for c in text if c.isascii() and c.isalpha()).lower().translate(str.maketrans("abcdefghijklmnopqrstuvwxyz", "ACGTNAACGTATCAGTACTGATCGAA"))
    assert "".join(r.seq for r in view(spark, SF, "reads").where("read_id % 10000000000 = 3").orderBy("read_id").collect()) == kept


def test_contigs_whole_and_covered(spark):
    whole = {f"c{r.doc_id}": r.n for r in letters(spark).collect()}
    assert {r.chr: len(r.seq) for r in view(spark, SF, "contigs").collect()} == whole
    last = {r.chr: r.pos for r in view(spark, SF, "contig_sites").groupBy("chr").agg(F.max("pos").alias("pos")).collect()}
    assert all(last[c] >= n for c, n in whole.items())


def test_samples_are_all_suppliers(spark, tmp_path):
    spark.range(25).select(F.col("id").alias("s_suppkey"), (F.col("id") % 7).alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    assert view(spark, str(tmp_path), "samples").count() == 25


def test_sites_are_dealt_to_as_many_tasks_as_the_table_is_long_for(spark, monkeypatch):
    # F8: what a task counts must not grow with the table, and no step may deal sites by their sample.
    monkeypatch.setattr(standins, "SITE_ROWS", 100)
    rows = view(spark, SF, "sites")
    backed = sites.site_support(sites.tpm(rows, sites.library_sizes(rows)), 4)
    lineitems = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert backed.rdd.getNumPartitions() == lineitems // 100 + 1
    assert rows.agg(F.sum("cnt")).first()[0] == lineitems
