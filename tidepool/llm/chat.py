"""Chat formatting by schema fingerprints (operator 6), with DataFrame functions
only.

A record's layout is named by the hash of its sorted nested field paths with
their types' shapes (array, field, value).  The fingerprint selects a
declarative mapping, a set of SQL expressions that turn a record of that layout
into canonical turns (conversation id, place, role, text).  Tables of one layout
are fingerprinted by their schema (``fingerprint``), tables of JSON records,
each of a layout of its own, record by record (``record_turns``).

The template marks each turn: ``<|im_start|>role``, line break, text,
``<|im_end|>``, line break.  A text or role cannot forge a mark: between ``<``
and ``|``, with any number of backslashes between them, one more backslash is
put, and taking one away gives the text back.  In roles a line break is
written ``\\n`` and a backslash ``\\\\`` as well.

The loss mask is the list of spans (start, length, in code points) of assistant
texts in the formatted conversation.

Null text: empty.  Null role: the empty role.  Turns go by their place, ties by
role, then text; a null place comes first; repeated rows stay.  Rows without a
conversation id are one conversation with a null id.  A record without turns
(null or empty messages) gives no conversation, one with an unknown layout
appears in ``record_turns`` as no turn and in ``unknown_layouts``.  Other columns are not
read.  A conversation is one row in the end, so its turns meet in one task: that
is one document's size, not a group of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"


# -- layouts --------------------------------------------------------------
def paths(kind: T.DataType, at: str = "") -> list[str]:
    """Sorted nested field paths; ``[]`` steps into an array."""
    if isinstance(kind, T.StructType):
        return sorted(p for f in kind.fields for p in paths(f.dataType, f"{at}.{f.name}" if at else f.name))
    if isinstance(kind, T.ArrayType):
        return paths(kind.elementType, at + "[]")
    return [at]


def fingerprint(kind: T.DataType, names: set[str] | None = None) -> str:
    """Hash of a layout's field paths, of the top-level ``names`` only if given."""
    import hashlib

    found = [p for p in paths(kind) if names is None or p.split(".")[0].split("[")[0] in names]
    return hashlib.sha256("\n".join(found).encode()).hexdigest()


def _layout(*found: str) -> str:
    import hashlib

    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


#: Layouts of one row a turn: id, place, role and text as SQL.
TURN_ROWS = {
    _layout("conv_id", "turn", "role", "text"): ("conv_id", "turn", "role", "text"),
    _layout("conversation_id", "index", "role", "content"): ("conversation_id", "index", "role", "content"),
}
#: Layouts of one row a conversation: its turns as an array of (role, text), in SQL.
RECORDS = {
    _layout("messages[].role", "messages[].content"): "transform(messages, m -> struct(m.role as role, m.content as text))",
    _layout("messages[].role", "messages[].text"): "transform(messages, m -> struct(m.role as role, m.text as text))",
    _layout("conversations[].from", "conversations[].value"): (
        "transform(conversations, m -> struct(case m.from when 'human' then 'user' when 'gpt' then 'assistant' else m.from end as role, m.value as text))"
    ),
    _layout("prompt", "response"): "array(struct('user' as role, prompt as text), struct('assistant' as role, response as text))",
    _layout("prompt", "completion"): "array(struct('user' as role, prompt as text), struct('assistant' as role, completion as text))",
    _layout("instruction", "output"): "array(struct('user' as role, instruction as text), struct('assistant' as role, output as text))",
    _layout("instruction", "input", "output"): (
        "array(struct('user' as role, concat_ws('\\n\\n', instruction, nullif(input, '')) as text), struct('assistant' as role, output as text))"
    ),
}
#: JSON schemas of the same layouts, for tables of records.
RECORD_SCHEMAS = {
    _layout("messages[].role", "messages[].content"): "messages array<struct<role:string,content:string>>",
    _layout("messages[].role", "messages[].text"): "messages array<struct<role:string,text:string>>",
    _layout("conversations[].from", "conversations[].value"): "conversations array<struct<`from`:string,value:string>>",
    _layout("prompt", "response"): "prompt string, response string",
    _layout("prompt", "completion"): "prompt string, completion string",
    _layout("instruction", "output"): "instruction string, output string",
    _layout("instruction", "input", "output"): "instruction string, input string, output string",
}
TURN = "conv_id long, turn long, role string, text string"


def canonical_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Turns of a table whose layout a mapping knows.  The fields that tell the
    layout are tried with and without the id; columns of no layout are ignored
    when the known ones are among them."""
    names = {f.name for f in df.schema.fields}
    for layout, (conv, place, role, text) in TURN_ROWS.items():
        if {conv, place, role, text} <= names and fingerprint(df.schema, {conv, place, role, text}) == layout:
            return df.selectExpr(f"cast({conv} as long) conv_id", f"cast({place} as long) turn", f"cast({role} as string) role", f"cast({text} as string) text")
    wanted = names - {id_col}
    found = next((expr for layout, expr in RECORDS.items() if fingerprint(df.schema, wanted) == layout), None)
    if found is None:
        found = next((expr for layout, expr in RECORDS.items() if any(fingerprint(df.schema, set(c)) == layout for c in _choices(layout))), None)
    if found is None:
        raise ValueError(f"no mapping for the layout {paths(df.schema)}")
    turns = df.select(F.col(id_col).cast("long").alias("conv_id"), F.expr(found).alias("turns"))
    return _exploded(turns)


def _choices(layout: str) -> list[list[str]]:
    fields = T._parse_datatype_string(RECORD_SCHEMAS[layout]).fieldNames()
    return [fields]


def _exploded(turns: DataFrame) -> DataFrame:
    rows = turns.select("conv_id", F.posexplode("turns").alias("turn", "t"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("t.role").cast("string").alias("role"), F.col("t.text").cast("string").alias("text"))


def record_layout(record: Column) -> Column:
    """Fingerprint of one JSON record: its nested field paths, from the record's
    own schema, hashed in sorted order (two levels: fields, and the fields of
    an array's objects)."""
    keys = F.array_sort(F.json_object_keys(record))
    found = F.flatten(
        F.transform(
            keys,
            lambda k: F.coalesce(
                F.transform(
                    F.json_object_keys(F.call_function("get_json_object", record, F.concat(F.lit("$['"), k, F.lit("'][0]")))),
                    lambda x: F.concat(k, F.lit("[]."), x),
                ),
                F.array(k),
            ),
        )
    )
    return F.sha2(F.array_join(F.array_sort(found), "\n"), 256)


def record_turns(df: DataFrame, id_col: str = "conv_id", record_col: str = "record") -> DataFrame:
    """Turns of a table of JSON records, each of a known layout of its own."""
    rows = df.select(F.col(id_col).cast("long").alias("conv_id"), F.col(record_col).alias("record")).withColumn("layout", record_layout(F.col("record")))
    case = None
    for layout, schema in RECORD_SCHEMAS.items():
        parsed = F.from_json("record", schema)
        expr = RECORDS[layout]
        fields = T._parse_datatype_string(schema).fieldNames()
        part = rows.filter(F.col("layout") == layout).select("conv_id", parsed.alias("r")).select("conv_id", *[F.col(f"r.`{f}`").alias(f) for f in fields])
        turns = _exploded(part.select("conv_id", F.expr(expr).alias("turns")))
        case = turns if case is None else case.unionByName(turns)
    return case


def unknown_layouts(df: DataFrame, record_col: str = "record") -> DataFrame:
    """``(layout, n)`` of the records that no mapping knows."""
    layout = F.coalesce(record_layout(F.col(record_col)), F.lit("unreadable"))
    return df.select(layout.alias("layout")).filter(~F.col("layout").isin(list(RECORDS))).groupBy("layout").agg(F.count(F.lit(1)).alias("n"))


# -- the template -----------------------------------------------------------
def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def _role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_back(role: Column) -> Column:
    # Two backslashes are one, a backslash before n is a line break: split at the former first.
    parts = F.split(unescaped(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def formatted(turns: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss)`` per conversation, from canonical turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.concat(F.lit(START), _role(role), F.lit("\n")).alias("head"), escaped(text).alias("body"))
    rows = rows.withColumn("size", F.length("head") + F.length("body") + len(END) + 1)
    # Where each turn begins: the running sum of the sizes before it.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn("at", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    part = F.struct("place", "head", "body", (F.col("at") + F.length("head")).alias("start"), (F.col("role") == "assistant").alias("trained"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    whole = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), "")
    loss = F.transform(F.filter("parts", lambda p: p["trained"]), lambda p: F.struct(p["start"].cast("int").alias("start"), F.length(p["body"]).alias("length")))
    return conv.select("conv_id", whole.alias("formatted"), loss.alias("loss"))


def read_back(chats: DataFrame) -> DataFrame:
    """``(conv_id, turns, trained)`` from formatted conversations: every turn's
    role and text, and the texts under the loss mask, unescaped."""
    chats = chats.withColumn("pieces", F.split("formatted", r"<\|im_end\|>\n", -1))
    pieces = F.slice("pieces", 1, F.size("pieces") - 1)
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            _role_back(F.substring_index(F.substring(p, F.lit(len(START) + 1), F.length(p)), "\n", 1)).alias("role"),
            unescaped(F.substring(p, F.locate("\n", p) + 1, F.length(p))).alias("text"),
        ),
    )
    trained = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return chats.select("conv_id", turns.alias("turns"), trained.alias("trained"), "formatted")
