r"""Chat formatting with DataFrame functions only.

A declarative template names the strings that frame a turn, the roles whose texts
are learned, and a finite-state machine over roles. Each turn becomes three
segments - opening, text, closing - and only the text of a learned role carries the
loss flag. Control strings inside roles and texts are escaped: every backslash is
doubled and one backslash is put after the first character of a control string, so
that the frame can be read back without doubt (:func:`parse_turns`).

``segments`` is row-wise and needs no shuffle. ``conversations`` puts the segments of
a conversation together; one conversation is one row of the result and so has to fit
into one (at most 2 GB), however many conversations there are.

Defined results: a null role or text counts as empty; a null conv_id is a conversation
of its own; turns are ordered by (turn, role, text), a null turn first; repeated rows
are repeated turns; unknown roles are formatted and make the conversation invalid;
an empty table has no conversations. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

ESCAPE = "\\"
STUCK = ""      # no state's name


@dataclass(frozen=True)
class ChatTemplate:
    turn_open: str = "<|im_start|>"
    role_end: str = "<|im_sep|>"
    turn_end: str = "<|im_end|>"
    #: Further strings that must not appear inside a text.
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state
    moves: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })

    def __post_init__(self):
        heads = {c[0] for c in self.controls}
        for c in self.controls:
            if len(c) < 2 or ESCAPE in c or heads & set(c[1:]):
                raise ValueError(f"{c!r}: a control string needs two characters or more, no backslash, "
                                 "and no first character of a control string after its own first")

    @property
    def controls(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((self.turn_open, self.role_end, self.turn_end, *self.reserved)))


def escape(text: Column, template: ChatTemplate) -> Column:
    heads = "|".join(f"{_quoted(c[0])}(?={_quoted(c[1:])})" for c in template.controls)
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, f"({heads})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _quoted(s: str) -> str:
    return re.sub(r"([^0-9A-Za-z])", r"\\\1", s)


def _turn_segments(role: Column, text: Column, template: ChatTemplate) -> Column:
    opening = F.concat(F.lit(template.turn_open), escape(role, template), F.lit(template.role_end))
    return F.array(
        F.struct(opening.alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(text, template).alias("text"), role.isin(*template.loss_roles).alias("loss")),
        F.struct(F.lit(template.turn_end).alias("text"), F.lit(False).alias("loss")))


def segments(turns: DataFrame, template: ChatTemplate | None = None, conv_col: str = "conv_id",
             turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conversation, turn, role, text and its three segments."""
    template = template or ChatTemplate()
    plain = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                         F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return plain.withColumn("segments", _turn_segments(F.col("role"), F.col("text"), template))


def _run_machine(roles: Column, template: ChatTemplate) -> Column:
    """Struct of the state after all roles (STUCK once a move is missing) and the
    position of the first role without a move."""
    table = F.create_map(*[F.lit(x) for state, by_role in template.moves.items()
                           for role, then in by_role.items() for x in (f"{state}\n{role}", then)])
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"),
                     F.lit(None).cast("int").alias("stuck"))

    def move(acc, role):
        then = F.coalesce(F.try_element_at(table, F.concat(acc["state"], F.lit("\n"), role)), F.lit(STUCK))
        return F.struct(then.alias("state"), (acc["at"] + 1).alias("at"),
                        F.when(acc["stuck"].isNull() & (then == STUCK), acc["at"]).otherwise(acc["stuck"]).alias("stuck"))

    return F.aggregate(roles, begin, move)


def conversations(turns: DataFrame, template: ChatTemplate | None = None, **columns) -> DataFrame:
    """One row per conversation: segments in order, the formatted text, whether the
    roles are a path of the machine to an accepting state, and the 0-based position of
    the first turn that has no move (null if none)."""
    template = template or ChatTemplate()
    rows = segments(turns, template, **columns)
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "segments")))
    whole = rows.groupBy("conv_id").agg(ordered.alias("turns"))
    return (whole
            .withColumn("machine", _run_machine(F.transform("turns", lambda t: t["role"]), template))
            .withColumn("segments", F.flatten(F.transform("turns", lambda t: t["segments"])))
            .select("conv_id", "segments",
                    F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    F.coalesce(F.col("machine.state").isin(*template.accept), F.lit(False)).alias("valid"),
                    F.col("machine.stuck").alias("first_bad_turn")))


def parse_turns(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    template = template or ChatTemplate()
    body = F.substring(formatted, len(template.turn_open) + 1, 2**31 - 1)
    pieces = F.split(body, _quoted(template.turn_open), -1)

    def turn(piece):
        parts = F.split(piece, _quoted(template.role_end), 2)
        text = F.substring_index(parts[1], template.turn_end, 1)
        return F.struct(unescape(parts[0]).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(segs: Column) -> Column:
    """The unescaped text under the loss flags, nothing between the pieces."""
    return F.array_join(F.transform(F.filter(segs, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digest_columns(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """The query's columns, read back from the formatted conversations."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (formatted.withColumn("turns", parse_turns(F.col("formatted"), template))
            .withColumn("learned", loss_text(F.col("segments")))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"),
                    F.sha2("learned", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"), "valid"))
