"""Conversation repair against all edit scripts, and against plain Python on odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from gridpanel.llm import conversation_repair as C

TURNS = "conv_id bigint, turn bigint, role string, text string"
WS = " \t\n\x0b\f\r"


def all_scripts(rows):
    """The least (cost, audit, repaired turns) among all scripts; rows: (role, text, fault)."""
    found = []

    def go(i, said, cost, audit):
        path = "".join(r[:1] or "?" for r, _ in said)
        if not re.fullmatch(r"s?(ua)*u?", path):
            return
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", path):
            found.append((cost, audit, said))
        if audit[-2:] != "II":
            for new in ("user", "assistant"):
                go(i, [*said, (new, "")], cost + 3, audit + "I")
        if i < len(rows):
            role, text, fault = rows[i]
            go(i + 1, said, cost + 4, audit + "D")
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                go(i + 1, [*said, (role, text)], cost + extra, audit + "K")
                for new in ("user", "assistant"):
                    go(i + 1, [*said, (new, text)], cost + 3 + extra, audit + "R")

    go(0, [], 0, "")
    return min(found)


def faults(rows):
    """(role, text, fault) of (role, text) rows in order."""
    out, seen = [], set()
    for role, text in rows:
        told = text.rstrip(WS)
        fault = ("blank" if not told else "duplicate" if (role, text) in seen
                 else "truncated" if told[-1] not in ".!?" else None)
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain_digest(turns):
    """The query's rows in plain Python."""
    by = {c: [] for c, *_ in turns}
    for conv, turn, role, text in turns:
        space = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{space[0]}:{space[1]}".encode()) % 20
        role, text = space[2], space[3]
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        by[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        numbers = [t for t, *_ in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        judged = faults([r[1:] for r in rows])
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        cost, audit, said = all_scripts(judged)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        n = [sum(f == k for *_, f in judged) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *n, illegal, cost, audit, sha))
    return sorted(out, key=str)


def digests(spark, turns, schema=TURNS):
    frame = spark.createDataFrame(turns, schema)
    got = C.digest_columns(frame, C.repair(C.damaged(frame))).collect()
    return sorted((tuple(r) for r in got), key=str)


def test_automaton_takes_the_grammar_alone():
    for n in range(6):
        for path in itertools.product("sua", repeat=n):
            stack = (0,)
            for role in path:
                stack = stack and C.push(stack, role)
            accepted = stack is not None and stack[-1] in C.ACCEPT
            assert accepted == bool(re.fullmatch("(s?(ua)+)?", "".join(path))), path


def test_cheapest_edits_against_all_scripts():
    r = random.Random(7)
    kinds, states = ("system", "user", "assistant", "tool"), (None, "blank", "truncated")
    for _ in range(250):
        rows = [(r.choice(kinds), "x", r.choice((None, None, *states))) for _ in range(r.randint(0, 4))]
        codes = "".join(chr(65 + 3 * kinds.index(k) + states.index(f)) for k, _, f in rows)
        cost, audit, given = C.cheapest_edits(codes)
        want = all_scripts(rows)
        assert (cost, audit) == want[:2], rows
        left, said = iter(rows), []
        for edit, new in zip(audit, given, strict=True):
            own = None if edit == "I" else next(left)
            if edit != "D":
                said.append((C.ROLE_OF.get(new) or own[0], "" if own is None else "x"))
        assert said == want[2]


def test_steps_stay_few_on_a_long_conversation():
    r = random.Random(1)
    codes = "".join(chr(65 + r.randrange(12)) for _ in range(60_000))
    cost, audit, _ = C.cheapest_edits(codes)
    assert len(audit.replace("I", "")) == len(codes) and len(C._steps) < 2_000


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_plain_python(spark, seed):
    r = random.Random(seed)
    said = ["Good.", "why?", "cut", " \n", "", "Done! ", "x. ", "a.\x0b", None]
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    turns = []
    for conv in [*range(25), None, -3]:
        for t in range(r.randint(1, 5)):
            turn = None if r.random() < 0.1 else t + r.choice([0, 0, 0, 2])
            turns.append((conv, turn, r.choice(roles[:3] if conv and conv % 2 else roles), r.choice(said)))
    assert digests(spark, turns) == plain_digest(turns)


def test_repaired_rows_are_texts(spark):
    turns = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi?"), (1, 2, "user", "Hi?"), (1, 3, "user", "there")]
    rows = C.repair(spark.createDataFrame(turns, TURNS)).orderBy("place").collect()
    assert [(r.edit, r.role, r.text, r.fault, r.turn) for r in rows] == [
        ("I", "user", "", None, None), ("K", "assistant", "Hello.", None, 0), ("K", "user", "Hi?", None, 1),
        ("D", "user", "Hi?", "duplicate", 2), ("R", "assistant", "there", "truncated", 3)]
    assert sum(r.cost for r in rows) == 13


def test_other_columns_repeated_rows_and_empty_tables(spark):
    schema = TURNS + ", pos string, fault int, edit string, place string"
    turns = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, None, None, None)]
    got = digests(spark, [(*t, "p", 1, "e", "q") for t in turns], schema)
    assert got == plain_digest(turns)
    assert digests(spark, []) == []


def test_very_long_text(spark):
    text = "word " * 200_000 + " " * 200_000
    turns = [(1, 1, "user", text + "."), (1, 2, "assistant", text)]
    assert digests(spark, turns) == plain_digest(turns)
