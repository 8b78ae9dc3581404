"""Repair of damaged conversations by generalised LR parsing with weighted edits.

The role grammar (an optional system turn, then user/assistant pairs, or nothing) becomes a
small LR automaton. A conversation's turns are read one after the other by all stacks at
once; before each turn any stack may insert turns, and the turn is kept, given another
role or deleted, each at its price. Stacks that share their beginnings differ only above
them, and stacks with equal tops accept the same continuations, so of those only the one
with the smallest (cost, audit) lives on. What one turn does to the set of tops depends on
the tops, their cost differences and the turn's kind alone, so that step is looked up after
the first time, and a turn leaves one reference behind for reading the edits back.

On Spark: turns are put in order by one range-partitioned sort on (conversation, turn,
role, text), which splits a hot conversation too; repeats are found by a pre-aggregated
first position; a conversation is gathered only as one character and one position per turn
(``edits``); its edits are joined back to the turns by position (``repair``).

Defined results: null roles and texts read as one space; a null conversation id is a
conversation of its own; null turns come first, equal turns follow role and text; an empty
role, like any role that does not begin with s, u or a, can only be replaced or deleted.
A conversation without turns has no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridpanel.llm.common import written

SPACE = " \t\n\x0b\f\r"
ENDS = ".!?"
RULES = (("G", ""), ("G", "sP"), ("G", "P"), ("P", "PQ"), ("P", "Q"), ("Q", "ua"))
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
#: A stack this much dearer than the cheapest cannot win: the cheapest could follow it by
#: two inserts and one deletion, and save no more than a truncated turn.
HOPELESS = 2 * INSERT + DELETE + TRUNCATED
STEPS = 1 << 16         # steps kept for reuse
ROLE_OF = {"u": "user", "a": "assistant"}


# ---- the automaton -----------------------------------------------------------------

def lr_tables(rules=RULES) -> tuple[list[dict[str, int]], dict[int, tuple[str, str]], set[int]]:
    """(moves of each state, the rule to reduce by in states that hold a finished one,
    states that accept). The first rule's left side is the start."""
    start = rules[0][0]

    def closed(items):
        items = set(items)
        while True:
            wanted = {rules[r][1][p] for r, p in items if p < len(rules[r][1])}
            more = {(r, 0) for r, (left, _) in enumerate(rules) if left in wanted} - items
            if not more:
                return frozenset(items)
            items |= more

    states = [closed({(r, 0) for r, (left, _) in enumerate(rules) if left == start})]
    moves: list[dict[str, int]] = []
    for items in states:            # grows while it is read
        out: dict[str, int] = {}
        for symbol in sorted({rules[r][1][p] for r, p in items if p < len(rules[r][1])}):
            to = closed({(r, p + 1) for r, p in items if rules[r][1][p:p + 1] == symbol})
            if to not in states:
                states.append(to)
            out[symbol] = states.index(to)
        moves.append(out)
    done = [[rules[r] for r, p in items if p == len(rules[r][1])] for items in states]
    due = {i: rule for i, found in enumerate(done) for rule in found if rule[0] != start}
    return moves, due, {i for i, found in enumerate(done) if any(left == start for left, _ in found)}


MOVES, DUE, ACCEPT = lr_tables()


def push(stack: tuple[int, ...], role: str) -> tuple[int, ...] | None:
    """The stack after a turn of this role and the reductions that are due then."""
    to = MOVES[stack[-1]].get(role)
    if to is None:
        return None
    stack = (*stack, to)
    while rule := DUE.get(stack[-1]):
        stack = stack[:len(stack) - len(rule[1])]
        stack = (*stack, MOVES[stack[-1]][rule[0]])
    return stack


# ---- weighted steps of all stacks --------------------------------------------------
# A head is (cost, origin, audit, roles, stack): origin numbers the stacks before the turn in
# the order of their audits; audit and roles are what was added since. No two audits of
# stacks between turns begin one another (each holds one edit per turn read and ends with
# it), so (origin, audit) orders whole audits.

def _merged(heads) -> list[tuple]:
    """The least head of each top."""
    best: dict[int, tuple] = {}
    for head in heads:
        top = head[4][-1]
        if top not in best or head < best[top]:
            best[top] = head
    return list(best.values())


def _inserted(heads) -> list[tuple]:
    """The heads with any inserts before the next turn."""
    best: dict[int, tuple] = {}
    todo = list(heads)
    while todo:
        head = todo.pop()
        cost, origin, audit, roles, stack = head
        if stack[-1] in best and best[stack[-1]] <= head:
            continue
        best[stack[-1]] = head
        todo += [(cost + INSERT, origin, audit + "I", roles + r, to) for r in "ua" if (to := push(stack, r))]
    return list(best.values())


def turn_code(initial: Column, fault: Column) -> Column:
    """One character for a turn: its role's initial, whether it must go, whether it is cut."""
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    state = F.when(fault.isin("blank", "duplicate"), 1).when(fault == "truncated", 2).otherwise(0)
    return F.char((F.lit(65) + 3 * kind + state).cast("long"))


def _step(tops: tuple, code: str) -> tuple[tuple, int, tuple]:
    """(tops, what was taken off their costs, (origin, audit, roles) of each top) after a
    turn. Tops are (stack, cost) in the order of their audits."""
    kind, state = divmod(ord(code) - 65, 3)
    extra = TRUNCATED if state == 2 else 0
    after = []
    for cost, origin, audit, roles, stack in _inserted((c, i, "", "", s) for i, (s, c) in enumerate(tops)):
        after.append((cost + DELETE, origin, audit + "D", roles + "-", stack))
        if state != 1:
            if kind < 3 and (to := push(stack, "sua"[kind])):
                after.append((cost + extra, origin, audit + "K", roles + "-", to))
            after += [(cost + REROLE + extra, origin, audit + "R", roles + r, to) for r in "ua" if (to := push(stack, r))]
    after = _merged(after)
    least = min(h[0] for h in after)
    after = sorted((h for h in after if h[0] - least <= HOPELESS), key=lambda h: h[1:4])
    return tuple((h[4], h[0] - least) for h in after), least, tuple(h[1:4] for h in after)


_steps: dict[tuple, tuple] = {}     # steps that this process has seen


def cheapest_edits(codes: str) -> tuple[int, str, str]:
    """(cost, audit, roles given by inserts and reroles, - elsewhere) of a conversation's
    turn codes: the least cost, then the least audit."""
    tops, total, trail = (((0,), 0),), 0, []
    for code in codes:
        step = _steps.get((tops, code))
        if step is None:
            if len(_steps) >= STEPS:
                _steps.clear()
            step = _steps[tops, code] = _step(tops, code)
        tops, least, back = step
        total += least
        trail.append(back)
    ended = _inserted((c, i, "", "", s) for i, (s, c) in enumerate(tops))
    cost, origin, audit, roles, _ = min(h for h in ended if h[4][-1] in ACCEPT)
    audits, given = [audit], [roles]
    for back in reversed(trail):
        origin, audit, roles = back[origin]
        audits.append(audit)
        given.append(roles)
    return total + cost, "".join(reversed(audits)), "".join(reversed(given))


# ---- on Spark ----------------------------------------------------------------------

def damaged(turns: DataFrame) -> DataFrame:
    """The turns with reproducible damage, by the checksum of ``conv_id:turn``: dropped,
    emptied, without sentence ends, said twice, or said by the user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(key), F.lit(20))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return (turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
            .where("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def ordered(turns: DataFrame) -> DataFrame:
    """The turns in a written table, with their place ``pos`` in its order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    keys = ["conv_id", "turn", "role", "text"]
    return written(turns.sparkSession, rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("pos", F.monotonically_increasing_id()), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, initial, fault) of ``ordered`` turns, where fault is the first of blank,
    duplicate and truncated, or null. Texts are not moved for it, only their digests."""
    told = F.rtrim("text", F.lit(SPACE))
    about = rows.select("conv_id", "pos", "role", F.substring("role", 1, 1).alias("initial"), (told == "").alias("blank"),
                        F.right(told, F.lit(1)).isin(*ENDS).alias("ended"), F.md5("text").alias("digest"))
    said = about.where("not blank").groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos"))
    return (about.drop("role", "digest").join(said.select("pos", F.lit(True).alias("first")), "pos", "left")
            .select("conv_id", "pos", "initial", F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate")
                    .when(~F.col("ended"), "truncated").alias("fault")))


def edits(marks: DataFrame) -> DataFrame:
    """The cheapest edits of turns of these ``faults``: conv_id, place (from 0), edit (Keep, Rerole,
    Delete, Insert by its initial), given (new role or null), cost, illegal (whether the turn
    may not follow the one before it), pos of the turn (null: inserted) and its fault."""
    code = turn_code(F.col("initial"), F.col("fault"))
    turn = F.struct("pos", code.alias("code"), "fault")
    packed = (marks.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
              .select("conv_id", F.col("t.pos").alias("pos"), F.col("t.fault").alias("fault"),
                      F.array_join("t.code", "").alias("codes")))

    def task(batches):
        for batch in batches:
            turns = zip(batch.column("pos"), batch.column("fault"), batch.column("codes").to_pylist(), strict=True)
            for i, (pos, fault, codes) in enumerate(turns):
                _, audit, given = cheapest_edits(codes)
                n, edit = len(audit), np.frombuffer(audit.encode(), np.uint8)
                own = edit != ord("I")
                kind, state = np.divmod(np.frombuffer(codes.encode(), np.uint8).astype(np.int64) - 65, 3)
                pair = 4 * kind[:-1] + kind[1:]
                illegal, at, cut = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, bool)
                illegal[np.flatnonzero(own)[1:]] = ~np.isin(pair, (1, 6, 9))        # su, ua, au
                at[own] = pos.values.to_numpy()
                nth = np.cumsum(own) - 1
                cut[own] = state == 2
                cost = np.select([edit == ord("D"), ~own, edit == ord("R")], [DELETE, INSERT, REROLE], 0)
                cost[cut & (edit != ord("D"))] += TRUNCATED
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv_id").take(pa.array(np.full(n, i))), pa.array(np.arange(n)),
                     pa.array(list(audit), pa.string()), pa.array([ROLE_OF.get(r) for r in given], pa.string()),
                     pa.array(cost, pa.int64()), pa.array(illegal), pa.array(at, mask=~own),
                     fault.values.take(pa.array(nth, mask=~own))],
                    ["conv_id", "place", "edit", "given", "cost", "illegal", "pos", "fault"])

    id_type = marks.schema["conv_id"].dataType.simpleString()
    return packed.mapInArrow(task, f"conv_id {id_type}, place bigint, edit string, given string, cost bigint, "
                                   "illegal boolean, pos bigint, fault string")


def repair(turns: DataFrame) -> DataFrame:
    """Every turn of the conversations with what is done to it, and every turn put in:
    conv_id, place, edit, role and text after it, fault, cost, illegal, and the turn's number
    (null for inserts). The repaired conversation is the rows whose edit is not D, by place."""
    rows = ordered(turns)
    done = written(turns.sparkSession, edits(faults(rows)), "edits")
    own = (done.where("edit <> 'I'").join(rows.drop("conv_id"), "pos")
           .withColumn("role", F.coalesce("given", "role")).drop("given", "pos"))
    new = done.where("edit = 'I'").select("conv_id", "place", "edit", F.col("given").alias("role"), F.lit("").alias("text"),
                                          "fault", "cost", "illegal", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"))
    return own.select(new.columns).unionByName(new)


def digest_columns(turns: DataFrame, repaired: DataFrame) -> DataFrame:
    """Per conversation of ``turns``: counts of faults, cost, audit and the digest of the
    repaired turns. The digest is over a whole conversation, which is one row here."""
    number = F.col("turn").cast("long")
    counts = repaired.groupBy("conv_id").agg(
        F.coalesce(F.max(number) - F.min(number) + 1 - F.count_distinct(number), F.lit(0)).cast("long").alias("gaps"))
    told = F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text"))
    facts = repaired.groupBy("conv_id").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.count_if("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_sort(F.collect_list(F.struct("place", "edit", told.alias("line")))).alias("t"))
    facts = facts.select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost",
                         F.array_join("t.edit", "").alias("audit"), F.sha2(F.array_join("t.line", "\n"), 256).alias("sha"))
    # one row per conversation from each side, put together by a union: null ids are a group
    parts = (turns.select("conv_id").distinct().unionByName(counts, allowMissingColumns=True)
             .unionByName(facts, allowMissingColumns=True))
    zero = [F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return parts.groupBy("conv_id").agg(*zero, F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
                                        F.coalesce(F.max("sha"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
