"""Chat formatting by a declarative template, with a loss flag for every segment.

The template names the control strings and the roles whose text is learned.
Control strings inside a text are escaped, so a formatted conversation can be
read back without loss. The order of turns is checked by a finite-state machine
over roles, which is a table of transitions, too.

Escaping: a run ``<\\...\\|`` gets one more backslash. So no escaped text holds
``<|``, with which every control string begins, and taking one backslash away
restores it. In roles, ``\\``, line feed and ``<`` are written as ``\\\\``,
``\\n`` and ``\\l``.

Defined results: a null text or role is empty; turns with equal numbers go by
role, then text; a null turn comes last; repeated rows are repeated turns; a null
conversation is a conversation of its own; an order of roles that the machine
refuses is formatted all the same and marked in ``valid``. A conversation is one
row, as it is one training example; nothing else brings rows together.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What surrounds a turn, which roles bear loss, and which role may follow which state."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    # (state, role) -> state. The first state is "start".
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )

    def __post_init__(self):
        if not (self.start.startswith("<|") and self.end.startswith("<|")) or self.start == self.end:
            raise ValueError("control strings must begin with <| and differ")
        if "<|" in self.start[1:] or "<|" in self.end[1:]:
            raise ValueError("a control string must not hold <| inside")


DEFAULT = Template()
_REFUSED = "refused"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    out = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("<"), F.lit("\\l"))


def unescape_role(role: Column) -> Column:
    def part(p: Column) -> Column:
        return F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\l"), F.lit("<"))

    return F.array_join(F.transform(F.split(role, r"\\\\", -1), part), "\\")


def final_state(roles: Column, template: Template = DEFAULT) -> Column:
    """The state of the machine after all roles; ``refused`` once a role was out of order."""
    entries = [F.lit(x) for (state, role), to in template.transitions.items() for x in (f"{state}\n{role}", to)]
    table = F.create_map(*entries)
    return F.aggregate(
        roles,
        F.lit("start"),
        lambda state, role: F.coalesce(F.try_element_at(table, F.concat(state, F.lit("\n"), role)), F.lit(_REFUSED)),
    )


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turns: array of (role, text) in order. ``turns`` has columns conv_id, turn, role, text."""
    row = F.struct(
        F.col("turn").isNull().alias("late"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = F.transform(
        F.array_sort(F.collect_list(row)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    )
    return turns.groupBy("conv_id").agg(ordered.alias("turns"))


def segments(turns: Column, template: Template = DEFAULT) -> Column:
    """array of (text, loss) whose texts, joined, are the formatted conversation. Of a turn only the learned text has loss."""

    def of(turn: Column) -> Column:
        head = F.concat(F.lit(template.start), escape_role(turn["role"]), F.lit("\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), turn["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.end + "\n").alias("text"), F.lit(False).alias("loss")),
        )

    return F.flatten(F.transform(turns, of))


def format_chats(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """conv_id, segments, formatted, state, valid: one row per conversation.

    valid: the machine took every role, so the conversation ends in a state of its table.
    """
    made = conversations(turns).select(
        "conv_id",
        segments(F.col("turns"), template).alias("segments"),
        final_state(F.col("turns.role"), template).alias("state"),
    )
    return made.select(
        "conv_id",
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        "state",
        (F.col("state") != _REFUSED).alias("valid"),
    )


def _quoted(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c not in "_ " else c for c in text)


def read_back(formatted: Column, template: Template = DEFAULT) -> Column:
    """array of (role, text): the turns of a formatted conversation, unescaped."""
    parts = F.split(formatted, _quoted(template.start), -1)
    tail = len(template.end) + 1

    def turn(part: Column) -> Column:
        at = F.instr(part, "\n")
        body = F.substring(part, at + 1, F.length(part) - at - tail)
        return F.struct(unescape_role(F.substring(part, F.lit(1), at - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_text(segs: Column) -> Column:
    """All text under the loss mask, unescaped."""
    learned = F.transform(F.filter(segs, lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return F.array_join(learned, "")
