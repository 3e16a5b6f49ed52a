"""Exact dedup by content-defined chunk recipes, with DataFrame functions only.

Each normalised text is cut where its own content says so: a chunk ends at the first place, after a least length, where a
character stands twice in a row and the next comes again soon (in scripts of many signs the first is enough).  Such places
are about as far apart as a chunk is long, so equal passages soon give equal chunks, wherever they stand.  Where there is
none, a chunk ends at the greatest length.  A chunk becomes a 64-bit identifier; the
identifiers are verified against SHA-256 digests over the whole corpus, and an identifier that stands for more than one
content is replaced by the digest itself.  Two texts are equal if and only if their ordered lists of verified identifiers are.  Only these short lists
are shuffled, never the texts.

Defined results: a null text counts as empty, and all empty texts are one group; a null doc_id is smaller than any other and
stays only where its group has no id at all; repeated rows (same id, same text) share their result; an empty table gives an
empty table; columns besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: Fewest and most characters of a chunk, and what it ends with: some 2 of 1,000 places, or of 100 in scripts of many signs.
CHUNK_MIN, CHUNK_MAX, CHUNK_CUT = 256, 8192, r"(.)\1(?:(.).\2|(?<=[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}\p{IsThai}]))"


def normalised(text: Column) -> Column:
    """What texts are compared by: A-Z as a-z, and null as empty."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def chunk_pattern(least: int = CHUNK_MIN, most: int = CHUNK_MAX, cut: str = CHUNK_CUT) -> str:
    """A regular expression whose successive matches are the chunks of a text; ``cut`` takes five characters at most."""
    return rf"(?s).{{{least - 5},{most - 5}}}?{cut}|.{{1,{most}}}+"


def recipes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", pattern: str | None = None, id_bits: int = 64) -> DataFrame:
    """Columns doc_id, text_sha256, ids (array of bigint) and digests (array of binary), one row per document, in one narrow pass.

    id_bits: bits kept of a chunk's identifier; fewer than 64 serve tests, which force collisions.
    """
    short = lambda c: F.xxhash64(c) if id_bits == 64 else F.pmod(F.xxhash64(c), F.lit(1 << id_bits))
    norm = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    cut = norm.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), F.regexp_extract_all("norm", F.lit(pattern or chunk_pattern()), F.lit(0)).alias("chunks"))
    return cut.select(
        "doc_id", "text_sha256", F.transform("chunks", short).alias("ids"), F.transform("chunks", lambda c: F.unhex(F.sha2(c, 256))).alias("digests")
    )


def verified(rows: DataFrame) -> DataFrame:
    """``rows`` of recipes with a column recipe: the ordered identifiers, each standing for one content in the whole corpus."""
    chunks = rows.select(F.explode(F.arrays_zip("ids", "digests")).alias("c")).select(F.col("c.ids").alias("id"), F.col("c.digests").alias("digest"))
    ambiguous = chunks.distinct().groupBy("id").count().where("count > 1").select("id")
    if ambiguous.isEmpty():
        return rows.select("doc_id", "text_sha256", F.col("ids").alias("recipe"), F.lit(None).cast("array<binary>").alias("spelled"))
    # Some identifier has two contents: texts that hold one are compared by digests as well.
    doubtful = (
        rows.select("text_sha256", F.explode("ids").alias("id")).join(ambiguous, "id", "left_semi").select("text_sha256").distinct()
    )
    flagged = rows.join(doubtful.withColumn("doubt", F.lit(True)), "text_sha256", "left")
    return flagged.select("doc_id", "text_sha256", F.col("ids").alias("recipe"), F.when(F.col("doubt"), F.col("digests")).alias("spelled"))


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", pattern: str | None = None, id_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The groups of one text come from a partial aggregation, so a group of a third of all rows is a few rows per task; only
    groups of two or more are stored and joined back, a join that adaptive execution can split at a hot recipe.
    """
    rows = verified(stored(recipes(docs, id_col=id_col, text_col=text_col, pattern=pattern, id_bits=id_bits), "recipes"))
    groups = stored(
        rows.groupBy("recipe", "spelled").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"), "recipe-groups"
    )
    g = groups.select(F.col("recipe").alias("g_recipe"), F.col("spelled").alias("g_spelled"), "keep_id", "group_size", F.lit(True).alias("found"))
    both: Column = (F.col("recipe") == F.col("g_recipe")) & F.col("spelled").eqNullSafe(F.col("g_spelled"))
    keep = F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return rows.join(g, both, "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256"
    )


def dedup_exact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns.

    What goes is told by id and text together: an id, or none, that loses one text keeps its others; see ``exact_groups``.
    Of rows that have both in common any one stays.
    """
    groups = exact_groups(docs, id_col=id_col, text_col=text_col)
    key = [F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_text")]
    gone = groups.where(~F.col("kept")).select(*key).distinct()
    own = "_own_text"
    while own in {c.lower() for c in docs.columns}:
        own += "_"
    named = docs.withColumn(own, F.sha2(normalised(F.col(text_col)), 256))
    here = lambda rows: named[id_col].eqNullSafe(rows["_id"]) & (named[own] == rows["_text"])
    again = stored(groups.where("kept and group_size > 1").groupBy(*key).count().where("count > 1").select("_id", "_text"), "repeated")
    if again.isEmpty():
        return named.join(gone, here(gone), "left_anti").drop(own)
    out = gone.union(again)
    alone = named.join(out, here(out), "left_anti")
    return alone.union(named.join(again, here(again), "left_semi").dropDuplicates([id_col, own])).drop(own)
