"""Chat formatting: conversations to text segments with loss flags, and back. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT = "array<struct<text: string, loss: boolean>>"


@dataclass(frozen=True)
class Template:
    """A turn is ``open``, role, newline, text, ``close``, newline; ``escape`` guards ``guarded`` inside texts.

    ``moves`` is the finite-state machine: from a state ("start" or the last role) to the roles that may
    follow; a conversation is valid if it ends in one of ``final``. Text of ``learned`` roles carries the loss.
    """

    open: str = "<|im_start|>"
    close: str = "<|im_end|>"
    guarded: str = "<|"
    escape: str = "\\"
    learned: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)


CHATML = Template()


def _escaped(text: Column, t: Template, role: bool = False) -> Column:
    """Escape signs doubled, then one put inside each guarded string; in roles also before a newline."""
    first, rest = t.guarded[0], t.guarded[1:]
    out = F.replace(text, F.lit(t.escape), F.lit(t.escape * 2))
    out = F.replace(out, F.lit(t.guarded), F.lit(first + t.escape + rest))
    return F.replace(out, F.lit("\n"), F.lit(t.escape + "\n")) if role else out


def _unescaped(text: Column, t: Template) -> Column:
    return F.regexp_replace(text, rf"(?s)\Q{t.escape}\E(.)", "$1")


def formatted(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """``(conv_id, segments, valid, broken_at)``: one row per conversation, all its turns in order.

    Turns come in order of ``turn``, then role and text; nulls first. A null text or role is empty; repeated
    rows are repeated turns; rows without ``conv_id`` are one conversation. ``valid`` tells whether the roles
    pass the machine, ``broken_at`` is the number (from 1) of the first turn that may not follow, the number
    after the last if only the end is wrong, null if valid. Invalid conversations are flagged, not dropped.
    A conversation is one value of the result, so its turns have to meet in one task.
    """
    t = template
    turn = F.struct(
        F.col("turn").alias("at"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda x: F.array(
                segment(F.concat(F.lit(t.open), _escaped(x.role, t, role=True), F.lit("\n")), F.lit(False)),
                segment(_escaped(x.text, t), x.role.isin(*t.learned)),
                segment(F.lit(t.close + "\n"), F.lit(False)),
            ),
        )
    )
    before = F.concat(F.array(F.lit("start")), F.transform("turns", lambda x: x.role))

    def may_follow(role: Column, place: Column) -> Column:
        state, answer = F.get(F.col("roles_before"), place), F.lit(False)
        for name, roles in t.moves.items():
            answer = F.when(state == name, role.isin(*roles)).otherwise(answer)
        return answer

    checked = turns.withColumn("roles_before", before).withColumn(
        "broken",
        F.array_position(
            F.concat(
                F.transform(F.transform("turns", lambda x: x.role), lambda r, i: ~may_follow(r, i)),
                F.array(~F.element_at("roles_before", -1).isin(*t.final)),
            ),
            F.lit(True),
        ),
    )
    return checked.select(
        "conv_id",
        segments.cast(SEGMENT).alias("segments"),
        (F.col("broken") == 0).alias("valid"),
        F.when(F.col("broken") > 0, F.col("broken")).alias("broken_at"),
    )


def full_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s.text), "")


def learned_text(segments: Column, template: Template = CHATML) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    under = F.filter(segments, lambda s: s.loss)
    return F.array_join(F.transform(under, lambda s: _unescaped(s.text, template)), "")


def turns_of(text: Column, template: Template = CHATML) -> Column:
    """``array<struct<role, text>>`` read back from formatted text.

    No control string stands inside a text or a role, so every part after an ``open`` is one turn.
    """
    t = template
    parts = F.slice(F.split(text, rf"\Q{t.open}\E"), 2, 1 << 30)
    head = rf"(?s)^((?:[^\n\Q{t.escape}\E]++|\Q{t.escape}\E.)*+)\n"
    end = F.lit(-len(t.close) - 1)

    def turn(part: Column) -> Column:
        role = F.regexp_extract(part, head, 1)
        body = F.substring(part, F.char_length(role) + 2, F.char_length(part) - F.char_length(role) - 1 + end)
        return F.struct(_unescaped(role, t).alias("role"), _unescaped(body, t).alias("text"))

    return F.transform(parts, turn)
