"""Chat formatting: schema fingerprints choose how a record becomes turns; a reversible template writes them.

Everything is a DataFrame expression.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Each layout: its field paths and, as SQL, the turns it stands for. A mapping is declared, not coded.
LAYOUTS = {
    "turns": (
        ["turns[].role", "turns[].text"],
        "transform(turns, t -> named_struct('role', t.role, 'text', t.text))",
    ),
    "messages": (
        ["messages[].role", "messages[].content"],
        "transform(messages, m -> named_struct('role', m.role, 'text', m.content))",
    ),
    "from_value": (
        ["conversations[].from", "conversations[].value"],
        "transform(conversations, c -> named_struct('role', "
        "CASE c.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE c.from END, 'text', c.value))",
    ),
    "prompt_response": (
        ["prompt", "response"],
        "array(named_struct('role', 'user', 'text', prompt), named_struct('role', 'assistant', 'text', response))",
    ),
    "prompt_completion": (
        ["prompt", "completion"],
        "array(named_struct('role', 'user', 'text', prompt), named_struct('role', 'assistant', 'text', completion))",
    ),
    "question_answer": (
        ["question", "answer"],
        "array(named_struct('role', 'user', 'text', question), named_struct('role', 'assistant', 'text', answer))",
    ),
    "instruction": (
        ["instruction", "output"],
        "array(named_struct('role', 'user', 'text', instruction), named_struct('role', 'assistant', 'text', output))",
    ),
    "instruction_input": (
        ["input", "instruction", "output"],
        "array(named_struct('role', 'user', 'text', concat(instruction, '\\n\\n', input)), "
        "named_struct('role', 'assistant', 'text', output))",
    ),
}
TURNS = "array<struct<role string, text string>>"
START, END, TRAINED = "<|im_start|>", "<|im_end|>", "assistant"


def paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """The leaf paths of a schema; ``[]`` marks the elements of an array."""
    found = []
    for field in schema.fields:
        kind, path = field.dataType, prefix + field.name
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        found += paths(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return found


def fingerprint(field_paths: list[str]) -> str:
    return hashlib.md5("\n".join(sorted(field_paths)).encode()).hexdigest()


def row_fingerprint(df: DataFrame) -> Column:
    """Hash of the known field paths that hold something in a row; unknown columns do not count."""
    known = {path for need, _ in LAYOUTS.values() for path in need}
    present = [
        F.when(F.col(f"`{path.split('[]')[0].split('.')[0]}`").isNotNull(), F.lit(path))
        for path in sorted(known & set(paths(df.schema)))
    ]
    return F.md5(F.concat_ws("\n", *present).cast("binary"))


def canonical_turns(df: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns, ``layout`` and ``turns`` (role, text) of records in any known layout.

    Rows of one table may differ in layout: a column that is null in a row is absent there. A
    null text or role inside a turn is empty. A row whose fingerprint is not known has a null layout
    and no turns.
    """
    there = set(paths(df.schema))
    usable = {name: rule for name, rule in LAYOUTS.items() if set(rule[0]) <= there}
    mark = row_fingerprint(df)
    layout, turns = F.lit(None).cast("string"), F.expr(f"CAST(array() AS {TURNS})")
    for name, (need, mapping) in usable.items():
        same = mark == fingerprint(need)
        layout = F.when(same, F.lit(name)).otherwise(layout)
        turns = F.when(same, F.expr(mapping).cast(TURNS)).otherwise(turns)
    filled = F.transform(
        turns,
        lambda t: F.struct(
            F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")
        ),
    )
    return df.select(*keep, layout.alias("layout"), filled.alias("turns"))


def escape(text: Column) -> Column:
    """Put one more backslash between ``<`` and ``|``, so no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role is one line: a line break and the escape sign are written as hex codes."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def segments(turns: Column) -> Column:
    """The formatted conversation in pieces: text, and whether the loss counts it (assistant texts)."""

    def pieces(turn: Column) -> Column:
        def piece(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        return F.array(
            piece(F.concat(F.lit(START), escape_role(turn["role"]), F.lit("\n")), F.lit(False)),
            piece(escape(turn["text"]), turn["role"] == TRAINED),
            piece(F.lit(f"{END}\n"), F.lit(False)),
        )

    return F.flatten(F.transform(turns, pieces))


def joined(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "")


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation, read back from its text alone."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda b: b != "")
    bodies = F.transform(blocks, lambda b: F.substring(b, len(START) + 1, 2**31 - 1))

    def turn(body: Column) -> Column:
        role = F.substring_index(body, "\n", 1)
        text = F.substr(body, F.length(role) + 2)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(bodies, turn)


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")


def format_chats(records: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``layout``, ``segments`` (text, loss) and ``formatted`` of records in any known layout.

    Without turns, ``formatted`` is the empty text.
    """
    turns = canonical_turns(records, keep).withColumn("segments", segments(F.col("turns"))).drop("turns")
    return turns.withColumn("formatted", joined(F.col("segments")))


def grouped_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows as one ``turns`` record per conversation, by turn.

    Rows of one turn number are ordered by role and text; a null number comes first. A null conv_id
    is a conversation of its own. One conversation has to fit one row; its rows meet only there.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return grouped.withColumn("turns", F.expr("transform(turns, t -> named_struct('role', t.role, 'text', t.text))"))


def format_digests(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, each read back from the output."""
    read = formatted.select("conv_id", "formatted", parsed(F.col("formatted")).alias("turns"), "segments")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        read.withColumn("loss", loss_text(F.col("segments")))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )
