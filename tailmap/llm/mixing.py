"""Mixing sources to target weights by Pareto order sampling.

Sources share a number of words by weight; a source's target stops at a multiple of what it has, and what it cannot take is
shared anew among the others.  Within a source a document is expected to be taken e times, in proportion to its odds (the
share of letters in its text, or what the caller gives), up to the same multiple.  The whole part of e is certain.  The rest
is an inclusion probability p: documents are ranked by their random odds u / (1 - u) divided by their inclusion odds
p / (1 - p), and are taken from the front of this order until the source's words are as near to its target as they can be.

No source is sorted in one task: ranks are counted in steps of their logarithm, sums of words over coarse steps (some hundreds
a source, whatever its size) show in which a source's order ends, those over the fine steps of that one show it more closely,
and only the documents of one fine step, a twenty-thousandth of the source, are put in order.  Sources may be as many as there
are documents: they are numbered in code-point order by ranges, and targets are found by sums over all of them.

u is drawn from the MD5 digest of the document's id, its text's hash, and a number that tells rows with the same of both
apart, so that reruns agree on how often rows with the same id and text are taken together.

Defined results: a null text has no words, and a document without words takes none; a null source is a source, after all
others; rows that repeat an id, or have none, are drawn for each; an empty table gives an empty table; other columns are
ignored; odds that are null, negative or not a number count as 0, and such a document is taken only where its source is
taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, stored

#: Weights of the sources in code-point order, repeating; words of the mix as a share of all; the most that is taken of anything.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Fine and coarse steps for each doubling of a rank.
STEPS, COARSE = 4096, 16
#: Rounds in which documents whose odds would take them above ``MOST`` are set to it; p is a little off after the last.
CAP_ROUNDS = 40
#: Odds of a text without letters.
LEAST_ODDS = 0.05


def words(text: Column) -> Column:
    """The number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column) -> Column:
    """A number in (0, 1) that a key always gets: the first 52 bits of its MD5 digest."""
    bits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def letter_odds(text: Column) -> Column:
    """The share of letters in a text, to hundredths, ``LEAST_ODDS`` at least."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]++", ""))
    return F.greatest(F.round(letters / F.nullif(F.length(text), F.lit(0)), 2), F.lit(LEAST_ODDS))


def numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` (stored, with a column seq of increasing numbers) with a column that counts rows of the same keys from 0.

    Keys that occur once, all of them as a rule, need no more than the counting.  For the others rows are counted within what
    one task has read, and then over these parts, so a key with a third of all rows is no one's alone.
    """
    same = lambda other: [F.col(k).eqNullSafe(other[f"_{k}"]) for k in keys]
    again = stored(rows.groupBy(*keys).count().where("count > 1").select(*[F.col(k).alias(f"_{k}") for k in keys]), "repeated")
    if again.isEmpty():
        return rows.withColumn(name, F.lit(0).cast("long"))
    those = stored(rows.join(again, same(again), "left_semi").select(*keys, "seq", F.shiftright("seq", 33).alias("part")), "repeats")
    parts = those.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy(*keys).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("part").alias("_part"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("begin"))
    within = those.withColumn("nth", F.row_number().over(W.partitionBy(*keys, "part").orderBy("seq")) - 1)
    found = within.join(parts, [*same(parts), F.col("part") == F.col("_part")]).select(F.col("seq").alias("_seq"), (F.col("nth") + F.col("begin")).cast("long").alias(name))
    return stored(rows.join(found, F.col("seq") == F.col("_seq"), "left").withColumn(name, F.coalesce(name, F.lit(0))).drop("_seq"), "numbered")


def source_targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, weight, target: one row a source, of rows source, size."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).repartitionByRange(F.col("source").asc_nulls_last())
    per = stored(per.sortWithinPartitions(F.col("source").asc_nulls_last()).withColumn("seq", F.monotonically_increasing_id()), "sources")
    part, place = F.shiftright("seq", 33), F.col("seq").bitwiseAND((1 << 33) - 1)
    # One row for each of the ranges that sources are sorted in.
    begin = per.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("begin"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("part", part).join(begin, "part").withColumn("weight", F.get(cycle, ((place + F.col("begin")) % len(weights)).cast("int")))
    limit = F.lit(most) * F.col("source_size")
    per = stored(per.select("source", "source_size", "weight", limit.alias("limit")), "source-weights")
    pot = share * (per.agg(F.sum("source_size")).first()[0] or 0)
    # What a source of weight 1 gets: it grows as more sources reach their limit, until no more do.
    rate, full = 0.0, -1
    while True:
        at = F.col("weight") * F.lit(rate) > F.col("limit")
        now, used, left = per.agg(F.count(F.when(at, 1)), F.coalesce(F.sum(F.when(at, F.col("limit"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~at, F.col("weight"))), F.lit(0.0))).first()
        if now == full or not left:
            break
        rate, full = (pot - used) / left, now
    return per.select("source", "source_size", "weight", F.least(F.col("weight") * F.lit(rate), F.col("limit")).alias("target"))


def _with_rates(sizes: DataFrame, targets: DataFrame, most: float) -> DataFrame:
    """Targets with a column rate: a document's expected times are least(most, rate * odds).

    The rates are found on the sums of words by source and odds, not on documents.
    """
    spread = stored(sizes.groupBy(F.col("source").alias("s"), "odds").agg(F.sum("size").alias("words")), "odds")
    whole = F.col("target") >= F.lit(most) * F.col("source_size")
    per = stored(targets.withColumn("rate", F.when(whole, F.lit(float("inf"))).otherwise(F.lit(0.0))), "rates")
    for _ in range(CAP_ROUNDS):
        of = per.where("rate < double('infinity')").select("source", "target", "rate")
        full = F.col("rate") * F.col("odds") >= most
        sums = spread.join(of, F.col("source").eqNullSafe(F.col("s"))).groupBy("s").agg(
            F.sum(F.when(full, F.col("words") * F.lit(most)).otherwise(F.lit(0.0))).alias("shut"), F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("odds") * F.col("words"))).alias("open")
        )
        again = per.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        new = F.when(F.col("open") > 0, F.greatest("rate", (F.col("target") - F.col("shut")) / F.col("open"))).otherwise(F.col("rate"))
        again = stored(again.withColumns({"moved": new > F.col("rate") * (1 + 1e-9), "rate": new}).drop("shut", "open"), "rates")
        per = again.drop("moved")
        if again.where("moved").isEmpty():
            break
    return per


def _crossing(sums: DataFrame, step: str) -> DataFrame:
    """l_source, last (the step in which a source's words reach its rest), rest, begin (words before that step).

    sums: source, step, words, rest, begin; a source whose words stay below its rest gets no row.
    """
    ordered = W.partitionBy("source").orderBy(step)
    ends = sums.withColumn("end", F.col("begin") + F.sum("words").over(ordered)).where("end >= rest")
    return ends.groupBy("source").agg(F.min_by(F.struct(F.col(step).alias("last"), "rest", (F.col("end") - F.col("words")).alias("begin")), step).alias("at")).select(F.col("source").alias("l_source"), "at.*")


def mix(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    odds: Column | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies (int), taken (size * copies), text_key, nth.

    odds: what documents of a source are taken in proportion to; the share of letters by default.  text_key (a hash of the
    text) and nth tell rows with one id apart.
    """
    text = F.col(text_col).cast("string")
    odds = (letter_odds(text) if odds is None else odds).cast("double")
    odds = F.when(odds.isNull() | F.isnan(odds) | (odds < 0), F.lit(0.0)).otherwise(odds)
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text).alias("text_key"), words(text).alias("size"), odds.alias("odds"))
    sizes = numbered(stored(sizes.withColumn("seq", F.monotonically_increasing_id()), "sizes"), ["doc_id", "text_key"], "nth")
    sizes = sizes.withColumn("u", uniform(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_key"), F.col("nth"))))
    targets = stored(_with_rates(sizes, source_targets(sizes, weights=weights, share=share, most=most), most), "targets")
    of = targets.select(F.col("source").alias("s"), "source_size", "target", "rate")
    rows = sizes.join(of, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    whole = F.col("rate") == float("inf")
    times = F.when(whole, F.lit(most)).otherwise(F.least(F.lit(most), F.col("rate") * F.col("odds")))
    rows = rows.withColumn("sure", F.floor(times).cast("int")).withColumn("p", times - F.col("sure"))
    rank = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("rank", F.when((F.col("p") > 0) & (F.col("size") > 0), rank)).withColumns({"fine": F.floor(F.log2("rank") * STEPS), "coarse": F.floor(F.log2("rank") * COARSE)})
    ranked = rows.where("rank is not null")
    # What the certain copies leave of a target, and the step in which the order reaches it.
    sure = stored(rows.groupBy("source").agg((F.first("target") - F.sum(F.col("sure") * F.col("size"))).alias("rest")).withColumnRenamed("source", "r_source"), "rests")
    sums = ranked.groupBy("source", "coarse").agg(F.sum("size").alias("words"))
    sums = sums.join(sure, F.col("source").eqNullSafe(F.col("r_source"))).withColumn("begin", F.lit(0).cast("long"))
    rough = stored(_crossing(sums, "coarse"), "coarse-steps")
    here = lambda level, at: F.col("source").eqNullSafe(at["l_source"]) & (F.col(level) == at["last"])
    sums = ranked.join(rough, here("coarse", rough)).groupBy("source", "fine").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("begin").alias("begin"))
    last = stored(_crossing(sums, "fine"), "last-steps")
    place = F.struct("rank", "doc_id", "text_key", "nth")
    edge = ranked.withColumn("place", place).select("source", "fine", "place", "size").join(last, here("fine", last))
    # A document is taken while that brings the sum nearer to the target: its middle lies before it.
    order = W.partitionBy("source").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = edge.withColumn("middle", F.col("begin") + F.sum("size").over(order) - F.col("size") / 2).where("middle <= rest")
    edge = stored(edge.groupBy("source").agg(F.max("place").alias("upto")).select(F.col("source").alias("e_source"), "upto"), "edges")
    ends = stored(last.join(edge, F.col("l_source").eqNullSafe(F.col("e_source")), "left").select("l_source", F.col("last").alias("last_step"), "upto"), "ends")
    done = rows.join(ends, F.col("source").eqNullSafe(F.col("l_source")), "left")
    # A source whose order ends before its target takes all of it.
    within = F.col("last_step").isNull() | (F.col("fine") < F.col("last_step")) | ((F.col("fine") == F.col("last_step")) & F.coalesce(place <= F.col("upto"), F.lit(False)))
    copies = F.when(F.col("size") > 0, F.col("sure") + (F.col("rank").isNotNull() & within).cast("int")).otherwise(F.lit(0))
    return done.select("doc_id", "source", "size", "source_size", "target", copies.cast("int").alias("copies"), (F.col("size") * copies).cast("long").alias("taken"), "text_key", "nth")


def take_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mix takes them.

    Rows that share id and text are numbered as in the mix; which of them gets which number makes no difference to it.
    """
    mixed = stored(mix(docs, id_col=id_col, text_col=text_col, **options).select(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"), F.col("nth").alias("m_nth"), "copies"), "mixed")
    again = stored(mixed.where("m_nth > 0").select(F.col("m_id").alias("a_id"), F.col("m_key").alias("a_key")).distinct(), "taken-repeats")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key"))
    taken, own = mixed.where("copies > 0"), F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_key") == F.col("m_key"))
    alone, out = rows, None
    if not again.isEmpty():
        those = F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("text_key") == F.col("a_key"))
        alone = rows.join(again, those, "left_anti")
        repeats = stored(rows.join(again, those, "left_semi").withColumn("seq", F.monotonically_increasing_id()), "repeated-rows")
        out = numbered(repeats, ["doc_id", "text_key"], "nth").join(taken, own & (F.col("nth") == F.col("m_nth"))).select("row", "copies")
    found = alone.join(taken.where("m_nth = 0"), own).select("row", "copies")
    found = found if out is None else found.union(out)
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
