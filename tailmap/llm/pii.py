"""Personal data: fixed patterns, and terms that give a protected value away, with DataFrame functions only.

Fixed kinds are ``email``, ``ip``, ``card`` and ``phone``; the values found are the protected entities.  The method adds kind
``term``: words near an entity are weighed by what the corpus says of them.  With N documents, n_e that hold entity e, n_t
that hold term t and c that hold t near e, the term's pointwise mutual information with the entity is
ln(N c / (n_e n_t)), and the entity's information is ln(N / n_e); their ratio is the share of the entity that the term
discloses.  A term that stands near the entity in at least ``MIN_SUPPORT`` documents and discloses at least ``GENERALISE`` of
it is generalised, from ``REMOVE`` on it is removed.  All counts are over the whole corpus.

Offsets are code points, ends exclusive.  Spark's regular expressions return matches but not where they are: the places come
from the lengths of the matches and of what lies between them, summed block by block (``scanned_over``), and windows are read
from pieces of the text rather than from its start.  The patterns are written so that no attempt scans a run of characters
again from its middle, and with possessive loops.  So a text of any length takes time and memory in proportion, and no stack.
Whether a term overlaps an entity is told from the sorted starts and ends of both, by windows over the spans of one text.

Defined results: a null text is empty; repeated rows have the same result each and count once in the corpus; rows without an id get a row each; an empty
table gives an empty table; columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import free_name, stored

KINDS = ("email", "ip", "card", "phone")

# The patterns.  A match begins where no match could have begun a character earlier, or where the last one ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this character has no match.
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}

#: Characters on either side of an entity in which terms count as near, what a term is, and the thresholds.
NEAR, TERM, MIN_SUPPORT, GENERALISE, REMOVE = 80, r"[\p{L}\p{N}]{3,}+", 3, 0.8, 0.95


#: Elements that are summed at a time, and the power of two of a piece's characters.
BLOCK, PIECE_BITS = 256, 10

SPAN = "start:int,end:int,hit:string"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scanned_over(items: Column, at: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """array<kind> of what ``step`` makes of (at, item), item by item; its first result is the next item's ``at``.

    An array that grows by one is copied each time, so blocks of ``BLOCK`` items grow alone and are strung together at the end.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")

    def one(acc: Column, x: Column) -> Column:
        to, made = step(acc["at"], x)
        return F.struct(to.alias("at"), F.concat(acc["out"], F.array(made)).alias("out"))

    def block(acc: Column, part: Column) -> Column:
        grown = F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("out")), one)
        return _let(grown, lambda g: F.struct(g["at"].alias("at"), F.concat(acc["out"], F.array(g["out"])).alias("out")))

    blocks = _let(items, lambda v: F.transform(F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(BLOCK)), lambda i: F.slice(v, i + 1, F.lit(BLOCK))))
    start = F.struct(at.cast("int").alias("at"), F.expr(f"cast(array() as array<array<{kind}>>)").alias("out"))
    return F.flatten(F.aggregate(blocks, start, block, lambda a: a["out"]))


def _placed(text: Column, pattern: str, offset: Column | None = None) -> Column:
    """array<struct<start, end, hit>> of all leftmost non-overlapping matches."""
    # What lies between matches is one more than there are; the last has no match behind it.
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + x["gap"]
        end = start + F.length(x["hit"])
        return end, F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"))

    return scanned_over(F.filter(pairs, lambda x: x["hit"].isNotNull()), F.lit(0) if offset is None else offset, step, f"struct<{SPAN}>")


def _pieces(text: Column) -> Column:
    """The text in pieces of 2^PIECE_BITS characters."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{1 << PIECE_BITS}}}+"), F.lit(0))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from start to end, from the pieces that hold it."""
    first = F.shiftright(start, PIECE_BITS)
    whole = F.array_join(F.slice(pieces, first + 1, F.shiftright(end - 1, PIECE_BITS) - first + 1), "")
    return F.when(end > start, F.substring(whole, start.bitwiseAND((1 << PIECE_BITS) - 1) + 1, end - start)).otherwise(F.lit(""))


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits: from the right, every second digit doubled, digit sums added."""

    def worth(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _holds(kind: str, hit: Column) -> Column:
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.right(p, F.lit(9)).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(hit, r"\."), small)
    digits = F.translate(hit, " ().+-", "")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """array<struct<start, end, hit>> of one fixed kind; ``text`` must not be null."""
    found = F.filter(_placed(text, PATTERNS[kind]), lambda s: _holds(kind, s["hit"]))
    return F.when(F.contains(text, F.lit(NEEDED[kind])), found).otherwise(F.expr(f"cast(array() as array<struct<{SPAN}>>)"))


def _entity(kind: Column, hit: Column) -> Column:
    value = F.when(kind == "email", F.lower(hit)).when(kind == "ip", hit).otherwise(F.translate(hit, " ().+-", ""))
    return F.concat_ws(":", kind, value)


def scan_base(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", near: int = NEAR) -> DataFrame:
    """doc_id, text_key, spans (array of kind, start, end, hit, before, after) in one narrow pass.

    ``before`` and ``after`` are the whole words near a span, bounded by ``near`` characters.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    named = lambda kind: F.transform(base_spans(F.col("text"), kind), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit")))
    rows = rows.select("doc_id", "text", F.length("text").alias("size"), F.concat(*[named(k) for k in KINDS]).alias("base"))

    def full(pieces: Column, s: Column) -> Column:
        cut, to = F.greatest(s["start"] - near, F.lit(0)), F.least(s["end"] + near, F.col("size"))
        # From where the window is cut to the first space a word is not whole; so at the other end.
        left = _between(pieces, cut, s["start"])
        left = F.when(cut == 0, left).otherwise(F.regexp_extract(left, r"(?s)\s.*+", 0))
        right = _between(pieces, s["end"], to)
        right = F.when(to - s["end"] < near, right).otherwise(F.regexp_extract(right, r"(?s)^.*\s", 0))
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"), left.alias("before"), right.alias("after"))

    spans = _let(_pieces(F.col("text")), lambda pieces: F.transform("base", lambda s: full(pieces, s)))
    none = F.expr(f"cast(array() as array<struct<kind:string,{SPAN},before:string,after:string>>)")
    return rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.when(F.size("base") > 0, spans).otherwise(none).alias("spans"))


def _document_counts(docs: DataFrame, repeated: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """term, n_term: in how many documents each word occurs, rows that repeat a document counted once.

    repeated: doc_id, text_key, copies of such documents.  Words are counted before they are shuffled, and meet wanted terms
    only as counts: a join with the words of the documents has a row for each document that holds a term.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(TERM), F.lit(0)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    held = rows.select(F.explode(words).alias("term"), F.lit(1).cast("long").alias("by"))
    if not repeated.isEmpty():
        again = repeated.select(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"), "copies")
        one = rows.join(again, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.xxhash64("text") == F.col("r_key"))).dropDuplicates(["r_id", "r_key"])
        held = held.union(one.select(F.explode(words).alias("term"), (1 - F.col("copies")).alias("by")))
    return held.groupBy("term").agg(F.sum("by").alias("n_term"))


def near_terms(scanned: DataFrame) -> DataFrame:
    """row, doc_id, text_key, entity, term, start, end: the words near each entity that overlap no entity's span.

    scanned: row, doc_id, text_key and spans, with a number of its own for each row.
    """
    hit = scanned.select("row", "doc_id", "text_key", F.explode("spans").alias("s"))
    words = F.concat(_placed(F.col("s.before"), TERM, F.col("s.start") - F.length("s.before")), _placed(F.col("s.after"), TERM, F.col("s.end")))
    words = hit.select("row", "doc_id", "text_key", _entity(F.col("s.kind"), F.col("s.hit")).alias("entity"), F.explode(words).alias("w"))
    words = words.select("row", "doc_id", "text_key", "entity", F.lower("w.hit").alias("term"), F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.lit(None).cast("int").alias("from"), F.lit(None).cast("int").alias("to"))
    spans = hit.select("row", "doc_id", "text_key", F.lit(None).cast("string").alias("entity"), F.lit(None).cast("string").alias("term"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.start").alias("from"), F.col("s.end").alias("to"))
    up_to = W.partitionBy("row").orderBy("start").rangeBetween(W.unboundedPreceding, W.currentRow)
    # Frames that reach to the end of a partition cost its square; this one reads it backwards.
    beyond = W.partitionBy("row").orderBy(-F.col("start")).rangeBetween(W.unboundedPreceding, -1)
    met = words.union(spans).withColumns({"before": F.max("to").over(up_to), "next": F.min("from").over(beyond)})
    apart = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.col("next").isNull() | (F.col("next") >= F.col("end")))
    return met.where(F.col("term").isNotNull() & apart).drop("from", "to", "before", "next")


def disclosing_terms(docs: DataFrame, scanned: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_support: int = MIN_SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """row, start, end, share: the places where a term stands near an entity that it discloses."""
    near = stored(near_terms(scanned), "near-terms")
    # A document counts once for a pair, however often the term stands near; rows that repeat a document count as one.
    pairs = near.select("doc_id", "text_key", "entity", "term").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
    pairs = stored(pairs.where(F.col("n_both") >= min_support), "near-pairs")
    if pairs.isEmpty():
        return near.select("row", "start", "end", F.lit(0.0).alias("share")).limit(0)
    hit = scanned.select("doc_id", "text_key", F.explode("spans").alias("s")).select("doc_id", "text_key", _entity(F.col("s.kind"), F.col("s.hit")).alias("entity"))
    holders = hit.distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    # Rows that repeat a document count as one in all four numbers.
    documents = stored(scanned.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies")), "pii-documents")
    n = documents.count()
    information = F.log(F.lit(float(n)) / F.col("n_entity"))
    pmi = F.log(F.lit(float(n)) * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    share = F.when(information > 0, pmi / information).otherwise(F.lit(0.0))
    counts = _document_counts(docs, documents.where("copies > 1"), id_col=id_col, text_col=text_col)
    weighed = pairs.join(holders, "entity").join(counts, "term").select("entity", "term", share.alias("share"))
    weighed = stored(weighed.where(F.col("share") >= generalise), "disclosing")
    return near.join(weighed, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("share").alias("share"))


def personal_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **thresholds: float) -> DataFrame:
    """doc_id, text_key, spans (base spans by kind as listed, then start), terms (array of start, end, share by start): a row each.

    The texts are read, not shuffled; what is stored and joined has a row of counts and spans for each document.
    """
    scanned = stored(scan_base(docs, id_col=id_col, text_col=text_col).withColumn("row", F.monotonically_increasing_id()), "pii")
    terms = disclosing_terms(docs, scanned, id_col=id_col, text_col=text_col, **thresholds)
    listed = terms.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))
    joined = scanned.join(stored(listed, "pii-terms"), "row", "left")
    kept = F.coalesce("terms", F.expr("cast(array() as array<struct<start:int,end:int,share:double>>)"))
    short = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return joined.select("doc_id", "text_key", short.alias("spans"), kept.alias("terms"))


def _joined(spans: Column, kind: str | None = None) -> Column:
    name = (lambda s: s["kind"]) if kind is None else (lambda s: F.lit(kind))
    return F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string")))


def pii_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows = personal_spans(docs, id_col=id_col, text_col=text_col)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base, terms = _joined(F.col("spans")), _joined(F.col("terms"), "term")
    return rows.select("doc_id", *[count(k) for k in KINDS], F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, terms), ",").alias("spans"))


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", remove: float = REMOVE, **thresholds: float) -> DataFrame:
    """``docs`` with personal data in the text replaced by its kind in brackets, and disclosing terms by [TERM] or by nothing."""
    found = personal_spans(docs, id_col=id_col, text_col=text_col, **thresholds).where((F.size("spans") > 0) | (F.size("terms") > 0)).dropDuplicates(["doc_id", "text_key"])
    cuts = F.sort_array(
        F.concat(
            F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by"))),
            F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= remove, F.lit("")).otherwise(F.lit("[TERM]")).alias("by"))),
        )
    )
    id_, key, by = (free_name(docs, x) for x in ("p_id", "p_key", "p_cuts"))
    found = found.select(F.col("doc_id").alias(id_), F.col("text_key").alias(key), cuts.alias(by))
    text = F.col(text_col)

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        inside = s["start"] < at
        return F.greatest(at, s["end"]), F.struct(F.when(inside, s["start"]).otherwise(at).alias("from"), s["start"].alias("to"), F.when(inside, F.lit("")).otherwise(s["by"]).alias("by"))

    last = F.struct(F.length(text).alias("start"), F.length(text).alias("end"), F.lit("").alias("by"))
    kept = scanned_over(F.concat(by, F.array(last)), F.lit(0), step, "struct<from:int,to:int,by:string>")
    clean = _let(_pieces(text), lambda pieces: F.array_join(F.transform(kept, lambda k: F.concat(_between(pieces, k["from"], k["to"]), k["by"])), ""))
    both = docs[id_col].eqNullSafe(F.col(id_)) & (F.xxhash64(docs[text_col]) == F.col(key))
    return docs.join(found, both, "left").withColumn(text_col, F.when(F.col(by).isNotNull(), clean).otherwise(text)).drop(id_, key, by)
