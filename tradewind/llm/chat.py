r"""Chat formatting by grammar round trip, with DataFrame functions only.

Grammar of a formatted conversation:

    conversation := turn*
    turn         := "### " role ": " body "</turn>\n"

Control strings are "### ", "</turn>" and, in a role, ": ". The parser splits at turn ends, reads the role up to the
first ": ", rejects bodies and roles that hold a control string, and takes one backslash out of each escaped one.
A control string is escaped by one backslash more after its first character; one that has backslashes there
already gets one more, too, so taking one out always gives the source back.

Each turn is first rendered as it is, reparsed and compared with the source. Where the recovered turn differs or is
rejected, the turn is rendered again with its conflicting strings escaped, until both are identical.

Defined cases: a null role or text is empty; turns go by turn (null first), then role, then text; repeated rows are
turns of their own; a null conv_id is one conversation; an empty table gives no rows; texts of any length are
formatted whole; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
TURN_END = "</turn>\n"
#: (first character, rest) of the control strings, as patterns.
_CONTROL = [("#", "## "), ("<", "/turn>")]
_ROLE_CONTROL = [*_CONTROL, (":", " ")]


def _escaped(text: Column, control: list[tuple[str, str]]) -> Column:
    for first, rest in control:
        text = F.regexp_replace(text, rf"{first}(\\*){rest}", rf"{first}\\$1{rest}")
    return text


def unescaped(text: Column, control: list[tuple[str, str]] = _CONTROL) -> Column:
    for first, rest in control:
        text = F.regexp_replace(text, rf"{first}\\(\\*){rest}", rf"{first}$1{rest}")
    return text


def _holds_control(text: Column, control: list[tuple[str, str]]) -> Column:
    found = F.lit(False)
    for first, rest in control:
        found = found | text.contains(first + rest)
    return found


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("### "), role, F.lit(": "), text, F.lit(TURN_END))


def parsed(formatted: Column) -> Column:
    """Turns of a formatted conversation as array<struct<role, text>>; a piece that the grammar rejects gives nulls."""

    def turn(piece: Column) -> Column:
        colon = F.instr(piece, ": ")
        role, body = F.substring(piece, F.lit(5), colon - 5), F.substring(piece, colon + 2, F.length(piece))
        valid = piece.startswith("### ") & (colon >= 5) & ~_holds_control(role, _ROLE_CONTROL) & ~_holds_control(body, _CONTROL)
        return F.struct(
            F.when(valid, unescaped(role, _ROLE_CONTROL)).alias("role"), F.when(valid, unescaped(body)).alias("text")
        )

    pieces = F.split(formatted, TURN_END, -1)
    return F.transform(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def _until_identical(role: Column, text: Column) -> Column:
    """struct<role, text> as rendered: the first form from which the parser recovers the source."""
    forms = [(role, text), (_escaped(role, _ROLE_CONTROL), _escaped(text, _CONTROL))]
    chosen = F.lit(None)
    for form_role, form_text in reversed(forms):
        recovered = parsed(_rendered(form_role, form_text))
        same = (F.size(recovered) == 1) & recovered[0]["role"].eqNullSafe(role) & recovered[0]["text"].eqNullSafe(text)
        chosen = F.when(same, F.struct(form_role.alias("role"), form_text.alias("text"))).otherwise(chosen)
    return chosen


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (array of struct<start, length> of the assistant's bodies in code points from 0),
    and round_trip: whether the reparsed conversation equals the source."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = turns.withColumn("form", _until_identical(F.col("role"), F.col("text")))
    turns = turns.withColumn("piece", _rendered(F.col("form.role"), F.col("form.text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.select(
        "conv_id",
        "role",
        "text",
        "piece",
        F.row_number().over(order).alias("place"),
        (F.sum(F.length("piece")).over(before) - F.length("piece") + F.length("form.role") + 6).alias("start"),
        F.length("form.text").cast("long").alias("length"),
    )
    rows = F.sort_array(F.collect_list(F.struct("place", "piece", "role", "text", "start", "length")))
    spoken = F.filter("rows", lambda r: r["role"] == ASSISTANT)
    return (
        turns.groupBy("conv_id")
        .agg(rows.alias("rows"))
        .select(
            "conv_id",
            F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
            F.transform(spoken, lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"))).alias("loss_spans"),
            F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("source"),
        )
        .withColumn("round_trip", F.col("source").eqNullSafe(parsed(F.col("formatted"))))
        .drop("source")
    )


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(
        spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
