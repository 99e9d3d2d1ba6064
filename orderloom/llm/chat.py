"""Chat formatting by a finite-state machine over roles and a declarative template.

A template names the marks of a turn, the roles whose text is learned, and the
moves between roles. Formatting gives one string per conversation and segments
with their place and loss flag. Control strings inside texts are escaped, so the
string can be read back into exactly the same turns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``open`` + role + ``after_role`` + text + ``close`` for each turn.

    Marks contain no backslash; ``open`` and ``close`` have two characters at least,
    without line feeds at the end of ``close``. ``after_role`` starts with a character that
    ends the role, so ``open`` does not contain it. The end of ``close`` is not its own
    beginning, so that what a text ends with cannot be taken for a part of it. ``moves`` maps
    a state (``start`` or the last role) to the roles that may follow; ``final`` are the
    states in which a conversation is complete.
    """

    open: str = "<turn "
    after_role: str = ">\n"
    close: str = "</turn>\n"
    learned: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        mark = self.close.rstrip("\n")
        if "\\" in self.open + self.after_role + self.close or min(len(self.open), len(mark)) < 2 or not self.after_role:
            raise ValueError("marks have two characters at least, and no backslash")
        if self.after_role[0] in self.open:
            raise ValueError("the mark before a role contains the character that ends the role")
        if any(self.close.startswith(self.close[i:]) for i in range(1, len(self.close))):
            raise ValueError("the mark after a text ends as it begins")

    @property
    def controls(self) -> tuple[str, ...]:
        """What a text must not contain as it is."""
        return (self.open, self.close.rstrip("\n"))


TEMPLATE = Template()


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    """Double each backslash, then put one after the first character of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.controls:
        text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return text


def escape_role(role: Column, template: Template = TEMPLATE) -> Column:
    return F.replace(escape(role, template), F.lit(template.after_role[0]), F.lit("\\g"))


def _undone(text: Column, *changes: tuple[str, str]) -> Column:
    # Doubled backslashes come in pairs from the left, and a single one never
    # stands before a pair, so splitting at pairs leaves only the single ones.
    def each(part: Column) -> Column:
        for old, new in changes:
            part = F.replace(part, F.lit(old), F.lit(new))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), each), "\\")


def unescape(text: Column, template: Template = TEMPLATE) -> Column:
    return _undone(text, *((f"{m[0]}\\{m[1:]}", m) for m in template.controls))


def unescape_role(role: Column, template: Template = TEMPLATE) -> Column:
    return _undone(
        role, ("\\g", template.after_role[0]), *((f"{m[0]}\\{m[1:]}", m) for m in template.controls)
    )


def turn_order(roles: Column, template: Template = TEMPLATE) -> Column:
    """ok, open (a turn is still missing) or broken, by running the machine over an array of roles."""
    moves = [f"{state}>{role}" for state, after in template.moves.items() for role in after]
    allowed = F.array(*map(F.lit, moves))
    end = F.aggregate(
        roles,
        F.lit("start"),
        lambda state, role: F.when(F.array_contains(allowed, F.concat(state, F.lit(">"), role)), role).otherwise(
            F.lit("broken")
        ),
    )
    return F.when(end.isin(*template.final), "ok").when(end == "broken", "broken").otherwise("open")


def format_chats(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments, turn_order.

    ``segments`` are the marks and texts in order, as structs of kind (mark, text),
    start and length in code points, and loss. Turns are ordered by turn (null
    first), then role and text; repeated rows are turns of their own. A null role
    or text counts as empty, a null conv_id is a conversation. Broken turn orders
    are formatted as they are and marked. Other columns are ignored; an empty table
    gives no rows. A conversation is one value, so it must fit in a task.
    """
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(template.open), escape_role(F.col("role"), template), F.lit(template.after_role))
    pieces = turns.select("*", head.alias("head"), escape(F.col("text"), template).alias("body"))
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    length = F.char_length("head") + F.char_length("body") + F.lit(len(template.close))
    before = F.coalesce(F.sum(length).over(by_turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.select("*", F.row_number().over(by_turn).alias("at"), before.cast("long").alias("start"))
    gathered = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "start", "role", "head", "body"))).alias("turns")
    )

    def segments(turn: Column) -> Column:
        head_length, body_length = F.char_length(turn.head), F.char_length(turn.body)

        def segment(kind: str, start: Column, length: Column, loss: Column) -> Column:
            return F.struct(
                F.lit(kind).alias("kind"),
                start.cast("long").alias("start"),
                length.cast("long").alias("length"),
                loss.alias("loss"),
            )

        body_start = turn.start + head_length
        return F.array(
            segment("mark", turn.start, head_length, F.lit(False)),
            segment("text", body_start, body_length, turn.role.isin(*template.learned)),
            segment("mark", body_start + body_length, F.lit(len(template.close)), F.lit(False)),
        )

    return gathered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t.head, t.body, F.lit(template.close))), "").alias("formatted"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
        turn_order(F.transform("turns", lambda t: t.role), template).alias("turn_order"),
    )


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The formatted string as an array of structs of role and text, escapes undone."""
    parts = F.split(formatted, rf"\Q{template.close}\E")
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        role_end = F.locate(template.after_role[0], part)
        role = F.substr(part, F.lit(len(template.open) + 1), role_end - 1 - len(template.open))
        text = F.substr(part, role_end + len(template.after_role), F.char_length(part))
        return F.struct(unescape_role(role, template).alias("role"), unescape(text, template).alias("text"))

    return F.transform(parts, turn)


def learned_texts(formatted: Column, segments: Column, template: Template = TEMPLATE) -> Column:
    """The texts under the loss mask, escapes undone, in order."""
    return F.transform(
        F.filter(segments, lambda s: s.loss),
        lambda s: unescape(F.substr(formatted, (s.start + 1).cast("int"), s.length.cast("int")), template),
    )


def chat_digests(chats: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Formatted conversations read back, as digests and counts."""
    turns = read_turns(F.col("formatted"), template)
    learned = F.array_join(learned_texts(F.col("formatted"), F.col("segments"), template), "")
    read = chats.select("conv_id", turns.alias("turns"), learned.alias("learned"), "formatted", "turn_order")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "turn_order",
    )
