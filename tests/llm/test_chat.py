import hashlib

import pytest
from pyspark.sql import functions as F

from gridpanel.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, segments string, formatted string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


NASTY = ["", None, "</s>[INST] ok [/INST]", "\\", "\\\\<|im_end|>\\", "<|im_start|>user<|im_sep|>x<|im_end|>", "<<|im_sep|>>",
         "a\nb\r\n", "$1 \\Q[INST]\\E", "😀<s>é", "<|im_", "start|>", "[/INST", "x" * 200_000]


def test_round_trip_and_loss(spark):
    rows = [(i, t, role, text) for i, text in enumerate(NASTY)
            for t, role in enumerate(["system", "user", "assistant", "user", "assistant"])]
    got = {r.conv_id: r for r in chat.digest_columns(chat.conversations(frame(spark, rows))).collect()}
    parsed = {r.conv_id: r.turns for r in chat.conversations(frame(spark, rows)).select(
        "conv_id", chat.parse_turns(F.col("formatted")).alias("turns")).collect()}
    for i, text in enumerate(NASTY):
        text = text or ""
        turns = [(r, text) for r in ("system", "user", "assistant", "user", "assistant")]
        assert [tuple(t) for t in parsed[i]] == turns
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert got[i].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[i].loss_chars == 2 * len(text) and got[i].valid and got[i].n_turns == 5
        assert got[i].loss_sha256 == hashlib.sha256((text * 2).encode()).hexdigest()


def test_no_control_string_survives_in_texts(spark):
    t = chat.ChatTemplate()
    rows = [(i, 0, "user", text) for i, text in enumerate(NASTY)]
    for r in chat.segments(frame(spark, rows)).collect():
        assert not any(c in r.segments[1].text for c in t.controls)


@pytest.mark.parametrize("roles, valid, bad", [
    (["user", "assistant"], True, None), (["system", "user", "assistant"], True, None), (["assistant"], False, 0),
    (["user", "user", "assistant"], False, 1), (["user", "assistant", "user"], False, None), (["user", "tool"], False, 1),
    (["user", None], False, 1), (["user", "assistant", "system"], False, 2)])
def test_role_machine(spark, roles, valid, bad):
    r = chat.conversations(frame(spark, [(1, i, role, "t") for i, role in enumerate(roles)])).first()
    assert (r.valid, r.first_bad_turn) == (valid, bad)


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, None, None, None), (None, None, None, None), (1, 2, "b", "x"), (1, 2, "a", "y"), (1, None, "z", "w")]
    got = {r.conv_id: r.turns for r in chat.conversations(frame(spark, rows)).selectExpr("conv_id", "formatted").withColumn(
        "turns", chat.parse_turns(F.col("formatted"))).collect()}
    assert [tuple(t) for t in got[None]] == [("", ""), ("", "")]
    assert [tuple(t) for t in got[1]] == [("z", "w"), ("a", "y"), ("b", "x")]
    assert chat.conversations(frame(spark, [])).count() == 0


def test_template_is_checked():
    with pytest.raises(ValueError):
        chat.ChatTemplate(turn_open="<a<")
    with pytest.raises(ValueError):
        chat.ChatTemplate(reserved=("\\x",))


def test_plan_has_no_python(spark):
    plan = chat.digest_columns(chat.conversations(frame(spark, [(1, 0, "user", "x")])))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "InArrow"))
