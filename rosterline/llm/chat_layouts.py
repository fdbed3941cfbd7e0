"""Chat formatting by schema fingerprint: the hash of a record's nested field paths selects its mapping.

Records are VARIANT values (or JSON text) of different layouts. A declared `Layout` says which
field paths it has and where its turns are; records with other paths stay unmapped and can be
listed by fingerprint. Everything is done with Spark's own functions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of this and other chat templates. The escape goes in after the
# first character of each, so none of them can come from a text.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    paths: the record's fields as schema_of_variant shows them, without the types of values.
    Either `turns` is the field of a list whose entries have the fields `role` and `text`, or
    `fields` gives role and field names of each turn; several fields of one turn are joined by
    an empty line. roles: other names of roles.
    """

    name: str
    paths: str
    turns: str = ""
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)


OTHER_ROLES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}
LAYOUTS = (
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", turns="messages"),
    Layout("conversations", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>", turns="conversations",
           role="from", text="value", roles=OTHER_ROLES),
    Layout("prompt", "OBJECT<completion, prompt>", fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt with system", "OBJECT<completion, prompt, system>",
           fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("instruction", "OBJECT<instruction, output>", fields=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction with input", "OBJECT<input, instruction, output>",
           fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("question", "OBJECT<answer, question>", fields=(("user", ("question",)), ("assistant", ("answer",)))),
)


def field_paths(record: Column) -> Column:
    """The nested field paths of a VARIANT, without the types of its values."""
    return F.regexp_replace(F.schema_of_variant(record), r": (?!OBJECT<|ARRAY<)[A-Z]+(\(\d+,\s?\d+\))?", "")


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def _turns(record: Column, layout: Layout) -> Column:
    """array<struct<role, text>> of a record of this layout."""
    if layout.turns:
        kind = f"array<struct<`{layout.role}`: string, `{layout.text}`: string>>"
        found = F.coalesce(F.variant_get(record, f"$.{layout.turns}", kind), F.array().cast(kind))
        pair = lambda t: (t[layout.role], t[layout.text])
        made = F.transform(found, lambda t: F.struct(*[F.coalesce(v, F.lit("")).alias(n) for v, n in zip(pair(t), ("role", "text"), strict=True)]))
    else:
        get = lambda f: F.variant_get(record, f"$.{f}", "string")
        texts = [
            F.coalesce(get(names[0]), F.lit("")) if len(names) == 1
            else F.array_join(F.filter(F.array(*map(get, names)), lambda x: x.isNotNull() & (x != "")), "\n\n")
            for _, names in layout.fields
        ]
        made = F.array(*[F.struct(F.lit(r).alias("role"), t.alias("text")) for (r, _), t in zip(layout.fields, texts, strict=True)])
    if not layout.roles:
        return made
    named = F.create_map(*[F.lit(x) for pair in layout.roles.items() for x in pair])
    return F.transform(made, lambda t: F.struct(F.coalesce(F.try_element_at(named, t["role"]), t["role"]).alias("role"), t["text"].alias("text")))


def canonical(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """records with `fingerprint`, `layout` and `turns`, array<struct<role, text>>.

    Null roles and texts become empty. A record that is null, no JSON or of no declared layout
    has a null layout and null turns, and stays. Columns called like new ones are replaced.
    """
    value = F.col(f"`{record}`")
    if dict(records.dtypes)[record] == "string":
        value = F.try_parse_json(value)
    rows = records.withColumn("_record", value).withColumn("fingerprint", fingerprint(field_paths(F.col("_record"))))
    rows = rows.withColumn("fingerprint", F.when(F.col("_record").isNotNull(), F.col("fingerprint")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for known in layouts:
        same = F.col("fingerprint") == fingerprint(F.lit(known.paths))
        layout = F.when(same, F.lit(known.name)).otherwise(layout)
        turns = F.when(same, _turns(F.col("_record"), known)).otherwise(turns)
    return rows.withColumn("layout", layout).withColumn("turns", turns).drop("_record")


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(control[0] + ESCAPE + control[1:]))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def formatted(rows: DataFrame, learned: str = "assistant") -> DataFrame:
    """rows with `formatted`, the turns in the template, and `loss`, array<struct<start, length>>.

    loss: which UTF-8 bytes of `formatted` are texts of the role to be learned.
    """
    safe = F.transform("turns", lambda t: F.struct(escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text"), (t["role"] == learned).alias("learned")))
    rows = rows.withColumn("_safe", safe)
    piece = lambda t: F.concat(F.lit(START), t["role"], F.lit(MIDDLE), t["text"], F.lit(END + "\n"))
    rows = rows.withColumn("formatted", F.array_join(F.transform("_safe", piece), ""))
    frame = len(START) + len(MIDDLE) + len(END) + 1
    sizes = F.transform("_safe", lambda t: F.octet_length(t["role"]) + F.octet_length(t["text"]) + frame)
    rows = rows.withColumn("_ends", F.aggregate(sizes, F.array(F.lit(0)), lambda a, n: F.array_append(a, F.element_at(a, -1) + n)))
    spans = F.zip_with(
        "_safe", F.slice("_ends", 1, F.size("_safe")),
        lambda t, at: F.struct(
            (at + len(START) + F.octet_length(t["role"]) + len(MIDDLE)).alias("start"),
            F.octet_length(t["text"]).alias("length"), t["learned"].alias("learned"),
        ),
    )
    spans = F.transform(F.filter(spans, lambda s: s["learned"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    return rows.withColumn("loss", spans).drop("_safe", "_ends")


def read_turns(text: Column) -> Column:
    """The turns of a formatted conversation, array<struct<role, text>>."""
    parts = F.filter(F.split(text, r"<\|im_start\|>"), lambda p: p != "")
    body = lambda p: F.substring_index(F.substring_index(p, END, 1), MIDDLE, -1)
    return F.transform(parts, lambda p: F.struct(unescaped(F.substring_index(p, MIDDLE, 1)).alias("role"), unescaped(body(p)).alias("text")))


def read_loss(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    raw = text.cast("binary")
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(raw, s["start"] + 1, s["length"]).cast("string"))), "")


def format_chats(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS, learned: str = "assistant") -> DataFrame:
    """records with fingerprint, layout, turns, formatted and loss (see `canonical` and `formatted`).

    Control strings in roles and texts are escaped reversibly; `read_turns` and `read_loss`
    give back what went in. Unmapped records have nulls; a record without turns an empty text.
    Repeated rows are treated alike, other columns stay, an empty table gives no rows.
    """
    return formatted(canonical(records, record, layouts), learned)


def turn_records(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, record): the rows of each conversation by turn as one VARIANT in one of three layouts.

    A user and an assistant turn make a prompt record, with a system turn before them one with
    system; all else is a list of messages. Null roles and texts are empty, rows of the same
    turn follow each other by role and text, null turns come first, a null id is an id. A
    conversation is one value of the result, so its rows meet in one row.
    """
    part = F.struct(
        F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("content"),
    )
    whole = rows.groupBy(F.col(f"`{id}`").alias(id)).agg(F.sort_array(F.collect_list(part)).alias("_rows"))
    roles = F.transform("_rows", lambda r: r["role"])
    at = lambda i: F.get("_rows", F.lit(i))["content"]
    is_like = lambda *names: roles == F.array(*map(F.lit, names))
    listed = F.transform("_rows", lambda r: F.struct(r["role"].alias("role"), r["content"].alias("content")))
    record = (
        F.when(is_like("user", "assistant"), F.to_variant_object(F.struct(at(0).alias("prompt"), at(1).alias("completion"))))
        .when(is_like("system", "user", "assistant"),
              F.to_variant_object(F.struct(at(0).alias("system"), at(1).alias("prompt"), at(2).alias("completion"))))
        .otherwise(F.to_variant_object(F.struct(listed.alias("messages"))))
    )
    return whole.select(id, record.alias("record"))
