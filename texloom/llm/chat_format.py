"""Chat formatting by schema fingerprint, in DataFrame functions only.

A record is a struct column as ``spark.read.json`` gives it for mixed layouts: fields of other layouts are
null. Its fingerprint is the hash of the sorted nested field paths that it has (``messages[].role``, ...).
``LAYOUTS`` maps fingerprints to declarative mappings: for a layout, the fields that hold turns, in order, or
the array of turns with the names of its role and text. ``format_chats`` turns every record into canonical
turns (role, text) and renders them with one template; ``parse_chats`` reads the turns and the loss mask back.

Template of a turn: ``<|start|>ROLE<|text|>TEXT<|end|>``; the text of a role that is learned (the loss mask)
is opened by ``<|loss|>`` instead. Inside roles and texts a backslash is doubled, and the first character of
a control string (of this template, or of the common templates listed in ``CONTROL``) is followed by a
backslash. So no control string is left in a text, and ``unescape`` gives the text back exactly.

Defined results: a null role or text is empty. A record without any field, or with a layout that has no
mapping, has ``layout`` and ``formatted`` null and its fingerprint is reported. Of a list of parts, parts without a text are empty;
parts with other fields than a text and its type (images) have another fingerprint and no layout. An empty array of turns gives
an empty text. Repeated records give repeated rows. Other columns stay; those named like a column of the
result are replaced. Turns of one conversation meet in one value, as the formatted text is one string.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._catalog import register
from ._cluster import read_table

START, TEXT, LOSS, END = "<|start|>", "<|text|>", "<|loss|>", "<|end|>"
#: Control strings of common chat templates: <s> </s> <<SYS>> <</SYS>> [INST] [/INST] and all that open with <|
CONTROL = r"<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"

#: Layouts by name. ``turns``: (array, role field, text field); a text field (array, text) is a list of parts, whose
#: texts are put together. ``fields``: (role, field) in order. ``optional`` fields (of a record, or of a part) may be absent, the
#: others are the fingerprint.
LAYOUTS = {
    "messages": {"turns": ("messages", "role", "content")},
    "parts": {"turns": ("messages", "role", ("content", "text")), "optional": ("type",)},
    "sharegpt": {"turns": ("conversations", "from", "value"), "roles": {"human": "user", "gpt": "assistant"}},
    "completion": {"fields": (("user", "prompt"), ("assistant", "completion"))},
    "instruction": {"fields": (("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
                    "optional": ("system", "input")},
    "question": {"fields": (("user", "question"), ("assistant", "answer"))},
}


def escape(text: Column) -> Column:
    """Double backslashes; put one after the first character of every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _paths(kind: T.DataType, path: str) -> list[tuple[str, Callable[[Column], Column]]]:
    """The nested paths of a type, each with whether a value has it; into arrays of any depth."""
    def present(x: Column) -> Column:
        return x.isNotNull()

    def field(name: str, has: Callable) -> Callable:
        return lambda x: has(x[name])

    def element(has: Callable) -> Callable:
        return lambda x: F.coalesce(F.exists(x, lambda y: has(y)), F.lit(False))

    if isinstance(kind, T.StructType):
        return [(p, field(f.name, has)) for f in kind.fields for p, has in _paths(f.dataType, f"{path}.{f.name}" if path else f.name)]
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return [(f"{path}[]", present)] + [(p, element(has)) for p, has in _paths(kind.elementType, f"{path}[]")]
    return [(f"{path}[]" if isinstance(kind, T.ArrayType) else path, present)]


def fingerprint(df: DataFrame, record: str) -> Column:
    """Hash of the sorted nested field paths that a record has."""
    paths = [F.when(has(F.col(record)), F.lit(p)) for p, has in _paths(df.schema[record].dataType, "")]
    return F.xxhash64(F.array_join(F.array_sort(F.array_compact(F.array(*paths))), "\n"))


def _variants(layout: dict) -> list[list[str]]:
    """The path lists that select a layout: with and without each optional field."""
    some = layout.get("optional", ())
    subsets = reduce(lambda acc, f: acc + [s | {f} for s in acc], some, [frozenset()])
    if "turns" in layout:
        array, role, text = layout["turns"]
        if isinstance(text, str):
            full = [f"{array}[]", f"{array}[].{role}", f"{array}[].{text}"]
            return [full, full[:1]]  # an empty array has no fields in it
        list_, inner = text
        base = [f"{array}[]", f"{array}[].{role}", f"{array}[].{list_}[]"]
        at = f"{array}[].{list_}[]."
        return [base, base[:1], *(base + [at + f for f in (inner, *s)] for s in subsets)]
    fields = [f for _, f in layout["fields"]]
    return [sorted(f for f in fields if f not in some or f in s) for s in subsets]


def _turns(df: DataFrame, record: str, layout: dict) -> Column | None:
    """Canonical turns of a layout, or None if the table has not the layout's fields."""
    names = {f.name for f in df.schema[record].dataType.fields}
    row = F.col(record)
    roles = layout.get("roles", {})

    def renamed(role: Column) -> Column:
        return reduce(lambda c, x: F.when(role == x[0], F.lit(x[1])).otherwise(c), roles.items(), role)

    if "turns" in layout:
        array, role, text = layout["turns"]
        if array not in names:
            return None
        inner = {f.name: f.dataType for f in df.schema[record].dataType[array].dataType.elementType.fields}
        field = text if isinstance(text, str) else text[0]
        if not {role, field} <= inner.keys():
            return None
        if isinstance(text, str):
            if isinstance(inner[field], (T.ArrayType, T.StructType, T.MapType)):
                return None  # no text: another layout's
            said = lambda x: x[field].cast("string")
        else:
            parts = inner[field]
            if not (isinstance(parts, T.ArrayType) and isinstance(parts.elementType, T.StructType) and text[1] in parts.elementType.names):
                return None
            said = lambda x: F.array_join(F.transform(x[field], lambda p: F.coalesce(p[text[1]].cast("string"), F.lit(""))), "")
        return F.transform(row[array], lambda x: F.struct(F.coalesce(renamed(x[role].cast("string")), F.lit("")).alias("role"),
                                                          F.coalesce(said(x), F.lit("")).alias("text")))
    present = [(r, f) for r, f in layout["fields"] if f in names]
    if len(present) < len(layout["fields"]) - len(layout.get("optional", ())):
        return None
    return F.filter(F.array(*[F.struct(F.lit(r).alias("role"), row[f].cast("string").alias("text")) for r, f in present]),
                    lambda x: x["text"].isNotNull())


def canonical_turns(df: DataFrame, record: str, layouts: dict | None = None) -> DataFrame:
    """Adds ``fingerprint``, ``layout`` and ``turns`` (array of role, text)."""
    mark = fingerprint(df, record)
    df = df.withColumn("fingerprint", mark)
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for key, layout in (layouts or LAYOUTS).items():
        if (out := _turns(df, record, layout)) is None:
            continue
        fits = F.col("fingerprint").isin(*[_hash(df.sparkSession, v) for v in _variants(layout)])
        name, turns = F.when(fits, F.lit(key)).otherwise(name), F.when(fits, out).otherwise(turns)
    return df.withColumn("layout", name).withColumn("turns", turns)


def _hash(spark: SparkSession, paths: Sequence[str]) -> Column:
    return F.xxhash64(F.lit("\n".join(sorted(paths))))


def render(turns: Column, learned: Sequence[str] = ("assistant",)) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), escape(t["role"]), F.when(t["role"].isin(*learned), F.lit(LOSS)).otherwise(F.lit(TEXT)),
        escape(t["text"]), F.lit(END))), "")


def format_chats(df: DataFrame, record: str = "record", learned: Sequence[str] = ("assistant",),
                 layouts: dict | None = None) -> DataFrame:
    """Rows of ``df`` without the record, with ``fingerprint``, ``layout`` and ``formatted``."""
    out = canonical_turns(df.drop(*[c for c in df.columns if c in ("fingerprint", "layout", "formatted", "turns")]),
                          record, layouts)
    return out.withColumn("formatted", render(F.col("turns"), learned)).drop(record, "turns")


def parse_chats(df: DataFrame, formatted: str = "formatted") -> DataFrame:
    """Adds ``parsed``: array of (role, text, loss), read back from the formatted text."""
    pieces = F.filter(F.split(F.col(formatted), r"<\|end\|>"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        loss = F.contains(piece, F.lit(LOSS))
        halves = F.split(piece, r"<\|(?:text|loss)\|>", 2)
        return F.struct(unescape(F.substring(halves[0], len(START) + 1, 2**31 - 1)).alias("role"),
                        unescape(halves[1]).alias("text"), loss.alias("loss"))

    return df.withColumn("parsed", F.transform(pieces, turn))


def conversation_records(rows: DataFrame) -> DataFrame:
    """Rows by turn -> one record per conversation, in the layout that its turns have.

    A user turn and its answer is a ``completion`` record; system, user and assistant an ``instruction``
    record; any other conversation a ``messages`` record. Turns go by number, then role and text; null
    numbers first.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                                                 F.coalesce("text", F.lit("")).alias("text"))))
    grouped = rows.groupBy("conv_id").agg(turns.alias("t"))
    roles = F.array_join(F.transform("t", lambda x: x["role"]), ",")
    pair, triple = roles == "user,assistant", roles == "system,user,assistant"
    text = lambda k: F.col("t")[k]["text"]
    messages = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    record = F.struct(
        F.when(pair, text(0)).alias("prompt"), F.when(pair, text(1)).alias("completion"),
        F.when(triple, text(0)).alias("system"), F.when(triple, text(1)).alias("instruction"),
        F.when(triple, text(2)).alias("output"),
        F.when(~(pair | triple), messages).alias("messages"))
    return grouped.select("conv_id", record.alias("record"))


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(role) + length(text)
    + length(role) - length(replace(role, chr(92), '')) + length(text) - length(replace(text, chr(92), ''))
    + len(regexp_extract_all(role, '<\||</?s>|<</?SYS>>|\[/?INST\]')) + len(regexp_extract_all(text, '<\||</?s>|<</?SYS>>|\[/?INST\]'))
    + 9 + 8 + 7 AS chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@register("op7_chat_format", SQL)
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = "</s>[INST] ok [/INST]"
    rows = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    F.lit(told).alias("text"))
    formatted = format_chats(conversation_records(rows.unionByName(planted)))
    read = parse_chats(formatted.select("conv_id", "formatted"))
    said = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("parsed", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select(
        "conv_id", F.size("parsed").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
