"""Chat formatting: a finite-state machine over roles, and text segments with loss flags from a template.

Only DataFrame functions run on the executors. A conversation is one training example and so one row of the result; the
rows of a conversation meet in one group, and nothing else does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import compute_once

_ESCAPE = "\\"
#: Second character of an escape, for the escape itself, the marks of a turn's start, end, and end of role.
_CODES = ("b", "o", "c", "r")
START = "start"


@dataclass(frozen=True)
class ChatTemplate:
    """Marks of a turn, roles that bear loss, and the order of turns as a machine: state -> role -> next state.

    A turn is `open` role `after_role` text `close` `between`. `open` and `close` are control strings; texts that hold
    them, and the escape character, are escaped. Roles that the machine does not know are written like others.
    """

    open: str = "<turn "
    after_role: str = ">\n"
    close: str = "</turn>"
    between: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    machine: dict[str, dict[str, str]] = field(default_factory=lambda: {
        START: {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for mark in (self.open, self.after_role, self.close):
            if not mark or _ESCAPE in mark or mark[0] in _CODES:
                raise ValueError(f"a mark must not be empty, hold {_ESCAPE} or start with one of {_CODES}: {mark!r}")
            if any(mark.startswith(mark[-n:]) for n in range(1, len(mark))):
                raise ValueError(f"a mark must not start as it ends: {mark!r}")
        if self.open in self.between + self.close or self.close in self.open:
            raise ValueError("marks must not hold one another")
        states = {START, *self.machine, *self.final, *(s for step in self.machine.values() for s in step.values())}
        if any("\n" in s for s in states):
            raise ValueError("names of states must be single lines")

    @property
    def steps(self) -> dict[str, str]:
        """Next state by state, newline and role."""
        return {f"{state}\n{role}": after for state, step in self.machine.items() for role, after in step.items()}


def escape(text: Column, template: ChatTemplate, role: bool = False) -> Column:
    """The text without control strings; a role also without the mark that ends it."""
    marks = [_ESCAPE, template.open, template.close, *[template.after_role] * role]
    for mark, code in zip(marks, _CODES):
        text = F.replace(text, F.lit(mark), F.lit(_ESCAPE + code))
    return text


def unescape(text: Column, template: ChatTemplate) -> Column:
    """The text that `escape` was given."""
    marks = [_ESCAPE, template.open, template.close, template.after_role]
    for mark, code in reversed(list(zip(marks, _CODES))):
        text = F.replace(text, F.lit(_ESCAPE + code), F.lit(mark))
    return text


def turn_fault(roles: Column, template: ChatTemplate) -> Column:
    """1-based position of the first turn that the machine has no step for; one more than all turns if it stops too early; null if sound."""
    steps = F.create_map(*[F.lit(x) for pair in template.steps.items() for x in pair])
    begin = F.struct(F.lit(START).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("fault"))

    def step(now: Column, role: Column) -> Column:
        after = F.try_element_at(steps, F.concat(now["state"], F.lit("\n"), role))
        at = now["at"] + 1
        return F.struct(after.alias("state"), at.alias("at"), F.coalesce(now["fault"], F.when(after.isNull(), at)).alias("fault"))

    return F.aggregate(roles, begin, step, lambda end: F.coalesce(end["fault"], F.when(~end["state"].isin(*template.final), end["at"] + 1)))


def format_conversations(turns: DataFrame, template: ChatTemplate = ChatTemplate(), key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, n_turns, fault, segments, formatted) of each conversation.

    `segments`: array of (text, loss), whose texts joined are `formatted`; loss stands on the escaped texts of the template's loss roles
    alone. `fault` is null where the machine accepts the roles, see turn_fault; conversations with a fault are formatted too.
    Turns go by number, null first, ties by role and text. Null roles and texts are empty; rows of null key are one conversation;
    repeated rows are turns of their own; other columns are ignored; an empty table gives an empty one.
    A conversation must fit in one row (2 GB).
    """
    whole = turns.select(
        F.col(key), F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")).alias("__turn")
    ).groupBy(key).agg(F.array_sort(F.collect_list("__turn")).alias("__turns"))
    piece = lambda words, loss: F.struct(words.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    segments = F.flatten(F.transform("__turns", lambda t: F.array(
        piece(F.concat(F.lit(template.open), escape(t["role"], template, role=True), F.lit(template.after_role)), no),
        piece(escape(t["text"], template), t["role"].isin(*template.loss_roles)),
        piece(F.lit(template.close + template.between), no),
    )))
    fault = turn_fault(F.transform("__turns", lambda t: t["role"]), template).cast("long")
    made = compute_once(whole, {"segments": segments, "fault": fault, "n_turns": F.size("__turns").cast("long")})
    return made.select(key, "n_turns", "fault", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """array of (role, text): the turns that `formatted` was made of."""
    parts = F.split(formatted, rf"\Q{template.open}\E", -1)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, template.after_role, 1)
        rest = F.substr(part, F.length(role) + len(template.after_role) + 1)
        return F.struct(unescape(role, template).alias("role"), unescape(F.substring_index(rest, template.close, 1), template).alias("text"))

    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def loss_text(segments: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The unescaped texts under the loss flags, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
