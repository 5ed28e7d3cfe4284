"""Chat formatting with a grammar round trip, in DataFrame expressions only.

Grammar of the rendered text (one conversation):

    rendered  := turn*
    turn      := open text close
    open      := "[INST]" (user) | "<s>" (assistant) | "[ROLE:" hex "]" (any other role)
    close     := "[/INST]"       | "</s>"            | "[/ROLE]"
    text      := characters without any of these control strings

A control string decides the token it starts, so parsing is deterministic: cut the rendered text
at its control strings, and the pieces alternate between empty gaps and texts.  Every text is
unescaped when read.  Rendering starts with the plain texts, reparses, and compares with the
source: a turn that does not come back identical is escaped; should the whole conversation still
differ, all its turns are; a difference after that is an error.
Escaping doubles each backslash and puts one after the first character of each control string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTROL = r"</?s>|\[/?INST\]|\[ROLE:[0-9A-F]*\]|\[/ROLE\]"
_CONTROL_TAIL = r"(<)(/?s>)|(\[)(/?INST\]|ROLE:[0-9A-F]*\]|/ROLE\])"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, _CONTROL_TAIL, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    """Drop each backslash that is not itself behind one: the inverse of ``escape``."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def opening(role: Column) -> Column:
    other = F.concat(F.lit("[ROLE:"), F.hex(role.cast("binary")), F.lit("]"))
    return F.when(role == "user", "[INST]").when(role == "assistant", "<s>").otherwise(other)


def closing(role: Column) -> Column:
    return F.when(role == "user", "[/INST]").when(role == "assistant", "</s>").otherwise("[/ROLE]")


def _role_of(mark: Column) -> Column:
    name = F.unhex(F.regexp_extract(mark, r"^\[ROLE:([0-9A-F]*)\]$", 1)).cast("string")
    return F.when(mark == "[INST]", "user").when(mark == "<s>", "assistant").otherwise(name)


def parse(rendered: Column) -> Column:
    """The turns of a rendered text as array<struct<role, text, raw, good>>; null if it is not in the grammar.

    ``raw`` is the text as rendered.
    """
    marks = F.regexp_extract_all(rendered, F.lit(f"({CONTROL})"), F.lit(1))
    pieces = F.split(rendered, CONTROL, -1)
    # Arrays are made once and zipped: an expression inside a lambda would run again for every turn.
    zipped = F.arrays_zip(
        F.filter(marks, lambda m, i: i % 2 == 0).alias("opened"),
        F.filter(marks, lambda m, i: i % 2 == 1).alias("closed"),
        F.filter(pieces, lambda p, i: i % 2 == 1).alias("raw"),
    )
    turns = F.transform(
        zipped,
        lambda z: F.struct(
            _role_of(z["opened"]).alias("role"),
            unescape(z["raw"]).alias("text"),
            z["raw"].alias("raw"),
            F.coalesce(
                ~z["opened"].rlike(r"^(</s>|\[/)") & (z["closed"] == closing(_role_of(z["opened"]))), F.lit(False)
            ).alias("good"),
        ),
    )
    gaps = F.array_join(F.filter(pieces, lambda p, i: i % 2 == 0), "")
    return F.when((gaps == "") & F.forall(turns, lambda t: t["good"]), turns)


def _rendered(role: Column, body: Column) -> Column:
    return F.concat(opening(role), body, closing(role))


def _comes_back(parsed: Column, role: Column, text: Column) -> Column:
    """True if the parsed array is exactly this one turn."""
    same = (F.size(parsed) == 1) & (F.get(parsed, F.lit(0))["role"] == role) & (
        F.get(parsed, F.lit(0))["text"] == text
    )
    return F.coalesce(same, F.lit(False))


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``rendered``, ``turns`` as read back from ``rendered``.

    ``rows`` has conv_id, turn, role, text; other columns are ignored. Turns are ordered by turn, then
    role and text, so that equal turn numbers and repeated rows have one order; null turns come first.
    Null roles and texts count as empty; a null conv_id is a conversation of its own. An empty table
    gives no rows.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    plain = turns.withColumn("trial", parse(_rendered(F.col("role"), F.col("text"))))
    body = F.when(_comes_back(F.col("trial"), F.col("role"), F.col("text")), F.col("text")).otherwise(
        escape(F.col("text"))
    )
    whole = (
        plain.withColumn("body", body)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "body"))).alias("source"))
    )

    def render(how) -> Column:
        return F.array_join(F.transform("source", lambda t: _rendered(t["role"], how(t))), "")

    def pairs(turns: Column) -> Column:
        return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))

    first = whole.withColumn("rendered", render(lambda t: t["body"])).withColumn(
        "turns", parse(F.col("rendered"))
    )
    same = F.coalesce(pairs(F.col("turns")) == pairs(F.col("source")), F.lit(False))
    second = (
        first.withColumn("same", same)
        .withColumn(
            "rendered",
            F.when(F.col("same"), F.col("rendered")).otherwise(render(lambda t: escape(t["text"]))),
        )
        .withColumn("turns", F.when(F.col("same"), F.col("turns")).otherwise(parse(F.col("rendered"))))
    )
    checked = F.when(
        F.coalesce(pairs(F.col("turns")) == pairs(F.col("source")), F.lit(False)), F.col("rendered")
    ).otherwise(F.raise_error(F.lit("a conversation does not survive its round trip")))
    return second.select("conv_id", checked.alias("rendered"), "turns")


def loss_mask(formatted: DataFrame) -> DataFrame:
    """conv_id, start, length (code points of ``rendered``) of each assistant text, escapes included."""
    turns = formatted.select("conv_id", F.posexplode("turns").alias("i", "t"))
    before = Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    opened, raw = F.length(opening(F.col("t.role"))), F.length("t.raw")
    passed = F.coalesce(F.sum(opened + raw + F.length(closing(F.col("t.role")))).over(before), F.lit(0))
    return (
        turns.select("conv_id", "t.role", (passed + opened).alias("start"), raw.alias("length"))
        .where("role = 'assistant'")
        .select("conv_id", "start", "length")
    )


def round_trip_report(rows: DataFrame) -> DataFrame:
    """Digests of what is read back from each formatted conversation.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars; see
    ``format_conversations`` for nulls, ties and repeated rows.
    """
    said = F.filter("turns", lambda t: t["role"] == "assistant")
    loss = F.array_join(F.transform(said, lambda t: t["text"]), "")
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return format_conversations(rows).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("rendered").cast("long").alias("formatted_chars"),
    )
