"""Repair of the structure of conversations by a higher-order fold.

Turns should have the roles ``(s?(ua)+)?`` by their initials: an optional system turn, then user and assistant by turns.  A
turn can be kept (K, cost 0), given the role user or assistant (R, 1) or deleted (D, 2; a blank or repeated one must be), and a
turn of either role without text can be inserted anywhere (I, 5); a truncated turn that stays costs 5 more.  The cheapest
edits are wanted, and of equal ones those whose letters sort first.

1. Equal turns are one row with a number, and rows are put in order by range, so that a conversation of any length is spread
   over tasks.  Windows flag faults: within a range first, then between the ranges.
2. Turns are collected in their order as blocks of ``BLOCK`` rows.  ``aggregate`` carries four structs of cost and letters,
   one for each state of the pattern (empty, after the system, after a user, after an assistant turn), and takes the
   ``least`` of each state's ways.  Two ways of one cost through the same turns are never a prefix of each other, so the
   least letters of a part are part of the least letters of all.
3. A block is folded from each of the four states that it may be entered in.  Blocks of a conversation are composed in the same
   manner, up to ``BLOCK`` at a time, until there is one a conversation.
4. Edits meet the turns again in a stream sorted by conversation: one pass gives the repaired turns, or their hash, without
   holding a conversation.

Defined results: a null role or text is one space, in a conversation's and turn's number as well where these are hashed;
null turns come first; rows of one turn are in the order of role and text; equal rows are turns of their own, all but
the first of them repeated; null conv_ids are one conversation; a conversation without rows after damage has zeros, no letters
and the hash of nothing; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

#: Rows of a block, as a number of bits.
BLOCK_BITS = 10
#: Costs of the edits, and of keeping a truncated turn.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: More than any way costs: the state cannot be reached.
NO_WAY = 1 << 50
#: What is no ASCII white space.
FILLED = r"[^\x20\x09-\x0D]"


def damaged(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies: rows by crc32 of ``conv_id:turn``, modulo 20, dropped (0), emptied (1), without
    ``[.!?]`` (2), repeated (3) or with role user (4)."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space(text_col), ".!?", "")).otherwise(space(text_col))
    return rows.where(kind != 0).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(space(role_col)).alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies")
    )


def in_order(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies, at: equal turns as one row, and a number that rises with conversation, turn, role
    and text; its bits above the 33rd are the range."""
    counted = turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    order = ["conv_id", "turn", "role", "text"]
    return stored(counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "turns")


def faults(turns: DataFrame) -> DataFrame:
    """conv_id, at, turn, copies, initial, repeated, blank, truncated of the rows of ``in_order``.

    repeated: a row before has the same role and text; of ``copies`` equal turns all but the first are repeated anyway.
    """
    last = F.regexp_extract("text", rf"({FILLED})[\x20\x09-\x0D]*\z", 1)
    light = turns.select(
        "conv_id", "at", "turn", "copies", F.substring("role", 1, 1).alias("initial"), F.shiftright("at", 33).alias("range"), F.unhex(F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256)).alias("key"), last.alias("last")
    )
    # Most repetitions are seen within a range; only a range's first ones are compared with those of other ranges.
    here = light.withColumn("again", F.row_number().over(W.partitionBy("conv_id", "key", "range").orderBy("at")) > 1)
    alone = F.when(F.col("again"), F.col("at")).otherwise(F.lit(-1))
    seen = here.withColumn("before", F.row_number().over(W.partitionBy("conv_id", "key", alone).orderBy("at")) > 1)
    blank = F.col("last") == ""
    return seen.select("conv_id", "at", "turn", "copies", "initial", (F.col("again") | F.col("before")).alias("repeated"), blank.alias("blank"), (~blank & ~F.col("last").isin(".", "!", "?")).alias("truncated"))


_STATES = ("empty", "system", "user", "assistant")


def _way(cost: Column, audit: Column) -> Column:
    return F.struct(cost.alias("cost"), audit.alias("audit"))


def _ways(*four: Column) -> Column:
    return F.struct(*[w.alias(s) for w, s in zip(four, _STATES, strict=True)])


def _on(way: Column, cost: Column | int, letter: str) -> Column:
    """A way with an edit more."""
    return _way(way["cost"] + (cost if isinstance(cost, Column) else F.lit(cost)), F.concat(way["audit"], F.lit(letter)))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often it is named."""
    return F.transform(F.array(value), then)[0]


def _inserted(ways: Column) -> Column:
    """The ways to the four states with turns that are inserted here; a second one can only follow a user's."""
    user = F.least(ways["user"], *[_on(ways[s], INSERT, "I") for s in ("empty", "system", "assistant")])
    return _let(user, lambda u: _ways(ways["empty"], ways["system"], u, F.least(ways["assistant"], _on(u, INSERT, "I"))))


def _deleted(ways: Column, copies: Column) -> Column:
    letters = F.repeat(F.lit("D"), copies.cast("int"))
    return _ways(*[_way(ways[s]["cost"] + copies * DELETE, F.concat(ways[s]["audit"], letters)) for s in _STATES])


def _edited(ways: Column, turn: Column) -> Column:
    """The ways after a turn that is kept, rewritten or deleted."""
    more = turn["more"]
    kept = lambda state, initial: F.when(turn["initial"] == initial, _on(ways[state], more, "K"))
    rewritten = lambda state: _on(ways[state], more + REROLE, "R")
    gone = [_on(ways[s], DELETE, "D") for s in _STATES]
    user = [x for s in ("empty", "system", "assistant") for x in (kept(s, "u"), rewritten(s))]
    # least leaves out what is null: a turn that is no user's cannot be kept as one.
    return _ways(gone[0], F.least(gone[1], kept("empty", "s")), F.least(gone[2], *user), F.least(gone[3], kept("user", "a"), rewritten("user")))


def _starts() -> Column:
    """For each state the ways of entering there: none of the others is a way."""
    way = lambda here: _way(F.lit(0 if here else NO_WAY).cast("long"), F.lit(""))
    return F.array(*[_ways(*[way(j == k) for j in range(4)]) for k in range(4)])


def _after(ways: Column, turn: Column) -> Column:
    """The ways after a row: of equal turns the first is edited, unless it must go, and the others are deleted."""
    edited = F.when(turn["gone"], ways).otherwise(_edited(ways, turn))
    left = turn["copies"] - F.when(turn["gone"], 0).otherwise(1)
    return _let(edited, lambda e: _let(F.when(left > 0, _deleted(e, left)).otherwise(e), _inserted))


def folded(turns: Column) -> Column:
    """For each state in which sorted turns may be entered, the cheapest ways to the four states behind them.

    Turns are inserted before the first row and after every row.
    """
    return F.transform(_starts(), lambda start: F.aggregate(turns, _inserted(start), _after))


def composed(blocks: Column) -> Column:
    """The same for sorted blocks, one behind the other.  Inserts at a seam are those of the block before it or behind it."""

    def on(ways: Column, block: Column) -> Column:
        through = lambda mid, j, to: _way(ways[mid]["cost"] + block["ways"][j][to]["cost"], F.concat(ways[mid]["audit"], block["ways"][j][to]["audit"]))
        return _ways(*[F.least(*[through(mid, j, to) for j, mid in enumerate(_STATES)]) for to in _STATES])

    return F.transform(_starts(), lambda start: F.aggregate(blocks, start, on))


def cheapest_edits(flagged: DataFrame) -> DataFrame:
    """conv_id, cost, audit, illegal of every conversation of ``faults``."""
    more = F.when(F.col("truncated"), TRUNCATED).otherwise(0).cast("long")
    turn = F.struct("at", "initial", "copies", more.alias("more"), (F.col("blank") | F.col("repeated")).alias("gone"))
    blocks = flagged.groupBy("conv_id", F.shiftright("at", BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    initials = F.transform("turns", lambda t: t["initial"])
    size = F.size("turns")
    steps = F.zip_with(F.slice(initials, 1, size - 1), F.slice(initials, 2, size - 1), lambda a, b: F.concat(a, b))
    illegal = _illegal(steps) + F.aggregate(F.transform("turns", lambda t: t["copies"] - 1), F.lit(0).cast("long"), lambda n, c: n + c)
    at = F.col("block")
    state = stored(blocks.select("conv_id", at.alias("at"), folded(F.col("turns")).alias("ways"), illegal.alias("illegal"), F.element_at(initials, 1).alias("first"), F.element_at(initials, -1).alias("last")), "blocks")
    while not state.groupBy("conv_id").count().where("count > 1").isEmpty():
        place = F.row_number().over(W.partitionBy("conv_id").orderBy("at")) - 1
        few = state.withColumn("block", F.shiftright(place, BLOCK_BITS)).groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("at", "ways", "illegal", "first", "last"))).alias("blocks"))
        n = F.size("blocks")
        seams = F.zip_with(F.slice("blocks", 1, n - 1), F.slice("blocks", 2, n - 1), lambda a, b: F.concat(a["last"], b["first"]))
        within = F.aggregate("blocks", F.lit(0).cast("long"), lambda s, b: s + b["illegal"])
        # One block is left as it is: only long conversations and those at a seam are composed.
        ways = F.when(n == 1, F.col("blocks")[0]["ways"]).otherwise(composed(F.col("blocks")))
        state = stored(few.select("conv_id", F.col("block").cast("long").alias("at"), ways.alias("ways"), (within + _illegal(seams)).alias("illegal"), F.col("blocks")[0]["first"].alias("first"), F.element_at("blocks", -1)["last"].alias("last")), "blocks")
    best = F.least(F.col("ways")[0]["empty"], F.col("ways")[0]["assistant"])
    return state.select("conv_id", best["cost"].alias("cost"), best["audit"].alias("audit"), "illegal")


def _illegal(steps: Column) -> Column:
    return F.size(F.filter(steps, lambda s: ~s.isin("su", "ua", "au"))).cast("long")


def fault_counts(flagged: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated: each turn's first fault, in this order, counts."""
    blank, copies = F.col("blank"), F.col("copies")
    again = F.when(F.col("repeated"), copies).otherwise(copies - 1)
    counts = flagged.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        F.sum(F.when(blank, copies).otherwise(0)).alias("blank"),
        F.sum(F.when(blank, 0).otherwise(again)).alias("duplicate"),
        F.sum(F.when(F.col("truncated") & ~F.col("repeated"), 1).otherwise(0)).cast("long").alias("truncated"),
    )
    return counts.withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))


def _walk(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits and turns of a conversation behind each other: first the row with the letters, then the turns in order."""
    first = edits.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), "audit")
    rows = turns.select("conv_id", "at", "turn", "role", "text", "copies", F.lit(None).cast("string").alias("audit"))
    return first.union(rows).repartition("conv_id").sortWithinPartitions("conv_id", "at")


class _Repair:
    """The repaired turns of one conversation, as its turns come."""

    def __init__(self, audit: str):
        self.audit, self.at = audit, 0
        # The turns after the system's are even in number.
        self.system = (len(audit) - audit.count("D")) % 2
        self.made = 0

    def _role(self) -> str:
        self.made += 1
        return "user" if (self.made - self.system) % 2 else "assistant"

    def inserted(self) -> Iterator[str]:
        """Roles of what is inserted here."""
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield self._role()

    def edited(self, role: str) -> str | None:
        """The role that this turn gets, none if it goes."""
        letter = self.audit[self.at]
        self.at += 1
        if letter == "D":
            return None
        wanted = self._role()
        return role if letter == "K" else wanted


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """conv_id, place, turn, role, text, edit of the stream of ``_walk``, slice by slice; place 0 begins a conversation."""
    repair = conv = None
    for b in batches:
        for at in range(0, b.num_rows, 512):
            out = []
            for r in b.slice(at, 512).to_pylist():
                if r["audit"] is not None:
                    repair, conv = _Repair(r["audit"]), r["conv_id"]
                    out.append((conv, 0, None, None, None, None))
                    out += [(conv, repair.made, None, role, "", "I") for role in repair.inserted()]
                for _ in range(r["copies"]):
                    letter, role = repair.audit[repair.at], repair.edited(r["role"])
                    if role is not None:
                        out.append((conv, repair.made, r["turn"], role, r["text"], letter))
                    out += [(conv, repair.made, None, role, "", "I") for role in repair.inserted()]
            yield out


def _batch(columns: list[list], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def repaired_turns(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, place, turn, role, text, edit: the turns after repair; place counts from 1 within a conversation, and those
    that were inserted have no turn."""
    conv, names = turns.schema["conv_id"].dataType, ["conv_id", "place", "turn", "role", "text", "edit"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [to_arrow_type(conv), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for rows in _applied(batches):
            rows = [r for r in rows if r[1]]
            yield _batch([[r[k] for r in rows] for k in range(6)], kinds, names)

    return _walk(turns, edits).mapInArrow(work, f"conv_id {conv.simpleString()}, place long, turn long, role string, text string, edit string")


def repaired_hashes(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of ``role:text`` of the turns after repair, joined by line ends."""
    conv, names = turns.schema["conv_id"].dataType, ["conv_id", "repaired_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, of, digest = [to_arrow_type(conv), pa.string()], None, None
        for rows in _applied(batches):
            done = []
            for conv_id, place, _, role, text, _ in rows:
                if place:
                    digest.update((("\n" if place > 1 else "") + role + ":" + text).encode())
                    continue
                if digest is not None:
                    done.append((of, digest.hexdigest()))
                of, digest = conv_id, hashlib.sha256()
            yield _batch([[d[k] for d in done] for k in range(2)], kinds, names)
        if digest is not None:
            yield _batch([[of], [digest.hexdigest()]], kinds, names)

    return _walk(turns, edits).mapInArrow(work, f"conv_id {conv.simpleString()}, repaired_sha256 string")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The turns in order, their faults, and the cheapest edits of each conversation (conv_id, cost, audit, illegal).

    turns: conv_id, turn, role, text, copies; ``repaired_turns(turns, edits)`` applies the edits.
    """
    ordered = in_order(turns)
    flagged = stored(faults(ordered), "faults")
    return ordered, flagged, stored(cheapest_edits(flagged), "edits")


def repair_digests(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conv_id of ``rows``, after damage: gaps, faults, cost, letters and hash of the repaired turns."""
    ordered, flagged, edits = repair(damaged(rows, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col))
    out = rows.select(F.col(conv_col).alias("conv_id")).distinct()
    for k, part in enumerate((fault_counts(flagged), edits, repaired_hashes(ordered, edits))):
        part = part.withColumnRenamed("conv_id", f"_c{k}")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col(f"_c{k}")), "left").drop(f"_c{k}")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
