"""Repair of conversation structure: the cheapest edits that make the roles of a conversation ``(s?(ua)+)?``, found by a native fold.

Faults are window-derived flags: a turn is blank, else a repetition of an earlier role and text, else cut off (its last character is no ``.!?``). Sorted turn structs are collected per conversation, and ``aggregate``
folds them through four (cost, audit) structs: nothing so far, a system turn, a user turn last, an assistant turn last. Each turn is kept (0), given another role (2) or deleted (3, the only way
for blank and repeated turns); empty user and assistant turns may be inserted anywhere (2); a turn that is cut off and stays adds 1. Structs are chosen by ``least``, first by cost, then by audit; two audits of
equal cost after the same turn hold as many insertions, so neither begins the other, and choosing early chooses right.

Inside the fold an audit has a letter an edit that also names the role: D, I and J (insert user, assistant), K, R and S (role to user, assistant). After equal letters the state is equal and so is the role, so the order is that of
the plain letters D, I, K, R. Conversations of more than ``LONG`` turns are folded in slices from each of the four states, and the slices are joined, so that audits are not copied once a turn.

One exchange by conversation; everything is built in. A conversation is the unit: its repaired text is one value, so it must fit one row (2 GB); the fold itself is linear but for one copy of the audit a slice.

Edge cases: null role or text counts as one space; null turns stand first, turns of equal number by role, then text; repeated rows are repetitions; a null id is a conversation of its own; a conversation without
turns left has zeros, an empty audit and no repaired turns; unknown roles must be changed or deleted; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

LONG = 256
SLICE = 64
STATES = ("start", "system", "user", "assistant")
DELETE, REROLE, INSERT, CUT_OFF = 3, 2, 2, 1
FAR = 10**12  # the cost of a state that cannot be reached
WHITE = r"\x20\x09-\x0D"


def damage(conversations: DataFrame) -> DataFrame:
    """Turns with seeded faults, by crc32 of ``conv_id:turn`` modulo 20: 0 dropped (``present`` false), 1 emptied, 2 without its marks, 3 repeated, 4 given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(key) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") != 0).alias("present"), F.explode(times).alias("again")).drop("again")


def flagged(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text, present) with their place, their first fault, and whether number and neighbour are new or out of order."""
    order = [F.desc("present"), F.asc_nulls_first("turn"), "role", "text"]
    row = W.Window.partitionBy("conv_id").orderBy(*order)
    same = W.Window.partitionBy("conv_id", "role", "text").orderBy(*order[:2])
    initial = F.substring("role", 1, 1)
    rows = turns.withColumns({"place": F.row_number().over(row), "before": F.lag(initial).over(row), "last_turn": F.lag("turn").over(row)})
    rows = rows.withColumn("nth", F.row_number().over(same))
    blank = ~F.col("text").rlike(f"[^{WHITE}]")
    cut = ~F.col("text").rlike(rf"[.!?][{WHITE}]*\z")
    fault = F.when(blank, "blank").when(F.col("nth") > 1, "duplicate").when(cut, "truncated")
    known = F.concat("before", initial).isin("su", "ua", "au")
    return rows.select(
        "conv_id", "turn", "role", "text", "present", "place", fault.alias("fault"), initial.alias("initial"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("last_turn"))).alias("new_turn"), ((F.col("place") > 1) & ~known).alias("illegal"),
    )


def _way(cost: Column, audit: Column) -> Column:
    return F.struct(cost.cast("long").alias("cost"), audit.alias("audit"))


def _by(way: Column, cost: Column | int, letters: str | Column) -> Column:
    """A way that is prolonged by some edits."""
    return _way(way["cost"] + cost, F.concat(way["audit"], F.lit(letters) if isinstance(letters, str) else letters))


def _ways(start: Column, system: Column, user: Column, assistant: Column) -> Column:
    return F.struct(start.alias("start"), system.alias("system"), user.alias("user"), assistant.alias("assistant"))


def _with_inserts(w: Column) -> Column:
    """Ways that may go on by inserted turns."""
    user = F.least(w["user"], *[_by(w[s], INSERT, "I") for s in ("start", "system", "assistant")])
    assistant = F.least(w["assistant"], _by(w["user"], INSERT, "J"), *[_by(w[s], 2 * INSERT, "IJ") for s in ("start", "system")])
    return _ways(w["start"], w["system"], user, assistant)


def _step(w: Column, t: Column) -> Column:
    """Ways after one more turn (initial, gone: must be deleted, extra: cost of staying)."""
    first, stays, extra = t["initial"], ~t["gone"], t["extra"]
    gone = {s: _by(w[s], DELETE, "D") for s in STATES}
    as_user, as_assistant = F.when(first == "u", "K").otherwise("R"), F.when(first == "a", "K").otherwise("S")
    to_user = F.least(*[_by(w[s], F.when(first == "u", extra).otherwise(extra + REROLE), as_user) for s in ("start", "system", "assistant")])
    to_assistant = _by(w["user"], F.when(first == "a", extra).otherwise(extra + REROLE), as_assistant)
    after = _ways(
        gone["start"], F.least(gone["system"], F.when(stays & (first == "s"), _by(w["start"], extra, "K"))), F.least(gone["user"], F.when(stays, to_user)), F.least(gone["assistant"], F.when(stays, to_assistant))
    )
    return F.transform(F.array(after), _with_inserts)[0]  # names the ways, so that each is worked out once


def _from(state: str) -> Column:
    return _ways(*[_way(F.lit(0 if s == state else FAR), F.lit("")) for s in STATES])


def _slices(turns: Column) -> Column:
    """Of each slice of turns, the ways from each of the four states."""
    parts = F.transform(F.sequence(F.lit(0), F.ceil(F.size(turns) / SLICE).cast("int") - 1), lambda k: F.slice(turns, k * SLICE + 1, SLICE))
    return F.transform(parts, lambda p: F.struct(*[F.aggregate(p, _from(s), _step).alias(s) for s in STATES]))


def _join(w: Column, part: Column) -> Column:
    onward = lambda to: F.least(*[_way(w[s]["cost"] + part[s][to]["cost"], F.concat(w[s]["audit"], part[s][to]["audit"])) for s in STATES])
    return _ways(*[onward(s) for s in STATES])


def fold(turns: Column) -> Column:
    """The cheapest way (cost, audit with roles) through an array of turns."""
    done = lambda w: F.least(w["start"], w["assistant"])
    begin = F.transform(F.array(_from("start")), _with_inserts)[0]
    return F.when(F.size(turns) > LONG, F.aggregate(_slices(turns), begin, _join, done)).otherwise(F.aggregate(turns, begin, _step, done))


def _edited(letters: Column, t: Column) -> Column:
    """The turns that an edit with the insertions before it leaves."""
    made = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    user, assistant, none = F.lit("user"), F.lit("assistant"), F.lit("")
    one = lambda c: F.when(c == "I", made(user, none)).when(c == "J", made(assistant, none)).when(c == "K", made(t["role"], t["text"])).when(c == "R", made(user, t["text"])).when(c == "S", made(assistant, t["text"]))
    return F.filter(F.transform(F.split(letters, ""), one), lambda x: x.isNotNull())


def repair(turns: DataFrame) -> DataFrame:
    """Per conversation: counts of faults, cost and audit of the cheapest repair, and the repaired turns. Rows that are not ``present`` only name their conversation."""
    rows = flagged(turns if "present" in turns.columns else turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(True).alias("present")))
    here = F.col("present")
    turn = F.struct("place", "role", "text", "initial", F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False)).alias("gone"), F.when(F.col("fault") == "truncated", CUT_OFF).otherwise(0).alias("extra"))
    count = lambda c: F.count(F.when(here & c, 1))
    number = F.when(here, F.col("turn"))
    got = rows.groupBy("conv_id").agg(
        F.coalesce(F.max(number) - F.min(number) + 1 - count(F.col("new_turn")), F.lit(0)).cast("long").alias("gaps"),
        *[count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")], count(F.col("illegal")).alias("illegal"),
        F.sort_array(F.collect_list(F.when(here, turn))).alias("turns"),
    )
    got = got.withColumn("way", fold(F.col("turns")))
    audit = F.col("way.audit")
    edits = F.regexp_extract_all(audit, F.lit("[IJ]*[DKRS]"), F.lit(0))
    kept = F.flatten(F.zip_with(edits, F.col("turns"), _edited))
    empty = F.struct(F.lit("").alias("role"), F.lit("").alias("text"))
    tail = _edited(F.regexp_extract(audit, "[IJ]*$", 0), empty)
    return got.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", F.col("way.cost").alias("cost"), F.translate(audit, "JS", "IR").alias("audit"), F.concat(kept, tail).alias("repaired"))


def repaired_text(repaired: Column) -> Column:
    """``role:text`` of the repaired turns, a line each."""
    return F.concat_ws("\n", F.transform(repaired, lambda r: F.concat(r["role"], F.lit(":"), r["text"])))
