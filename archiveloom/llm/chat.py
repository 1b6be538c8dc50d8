"""Chat formatting (9): schema fingerprints choose declarative mappings; built-in functions only.

A record is a JSON object. Its fingerprint is a hash of its nested field paths, as Spark's
variant schema lists them (sorted, list elements merged), with the scalar types left out. Each
known fingerprint names a mapping: where the turns are, which role and text each has. All
layouts come out as one canonical list of (role, text), which one template renders.

Template: ``<|start|>role<|message|>text<|end|>`` per turn. Inside roles and texts a backslash
is doubled and one is put into every control string of common chat templates after its first
character, so none survives; dropping each backslash and keeping what follows restores the text.

Defined results: a NULL text or role is empty; a record that is no JSON object, or whose
fingerprint no mapping has, keeps NULL turns and the layout ``unknown``; a conversation without
turns formats to the empty string; rows of one turn number are ordered by role and text.

Records come with public names for roles, which :func:`canonical` turns into the standard ones.
Rows by turn keep their roles. They are laid out as records of any layout that can say them, whose
fields hold the numbers of the roles and texts; the layout's mapping finds the numbers, and the
numbers find the values, so a text never passes through JSON whatever its length.

A JSON record is read as a variant, which takes at most 20,000,000 characters in a string and
128 MiB: a record of more than ``RECORD_CHARS`` characters that cannot be read raises an error,
whether it breaks a limit or is no JSON. For rows by turn that is a conversation of millions of
turns. A formatted conversation is one value, at most 2 GiB in Spark.

Equal records or rows stay as many as they are; an empty table gives no rows. Columns named
``layout``, ``turns``, ``formatted`` or ``loss`` are replaced by the operator's own; no other column
is touched, whatever its name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom.llm.names import unused

START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
# Control strings of public chat templates, cut after their first character.
CONTROL = r"([<\[])(?=\||/?s>|/?INST\]|<SYS>>|</SYS>>|/?think>|start_of_turn>|end_of_turn>)"
# Scalar types in a variant schema; a field that is NULL in one record is text in another.
SCALARS = r"\b(STRING|VOID|BIGINT|DOUBLE|FLOAT|BOOLEAN|DATE|TIMESTAMP(_NTZ)?|BINARY|VARIANT|DECIMAL\(\d+,\s*\d+\))(?=[,>]|$)"
# No record up to this length reaches the limits of a variant: a string holds no more characters.
RECORD_CHARS = 20_000_000
# Role names of public data sets and what they stand for.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


@dataclass(frozen=True)
class Mapping:
    """A layout: its field paths as JSON with empty values, and where its turns lie.

    ``turns`` is the list field with the ``role`` and ``text`` fields of its elements; or
    ``fields`` are (role, field, ...) tuples, each one turn of those fields joined by blank lines.
    """

    name: str
    example: str
    turns: str | None = None
    role: str | None = None
    text: str | None = None
    fields: tuple[tuple[str, ...], ...] = ()


MAPPINGS = (
    Mapping("messages", '{"messages":[{"role":"","content":""}]}', "messages", "role", "content"),
    Mapping("conversations", '{"conversations":[{"from":"","value":""}]}', "conversations", "from", "value"),
    Mapping("conversation", '{"conversation":[{"role":"","text":""}]}', "conversation", "role", "text"),
    Mapping("prompt-completion", '{"prompt":"","completion":""}', fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt-response", '{"prompt":"","response":""}', fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("question-answer", '{"question":"","answer":""}', fields=(("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", '{"instruction":"","output":""}', fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction-input", '{"instruction":"","input":"","output":""}', fields=(("user", "instruction", "input"), ("assistant", "output"))),
    Mapping(
        "system-instruction", '{"system":"","instruction":"","output":""}',
        fields=(("system", "system"), ("user", "instruction"), ("assistant", "output")),
    ),
    Mapping("nested-data", '{"data":{"messages":[{"role":"","content":""}]}}', "data.messages", "role", "content"),
)


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a variant."""
    return F.xxhash64(F.regexp_replace(F.schema_of_variant(record), SCALARS, "_"))


def _named(role: Column) -> Column:
    """The standard name of a role."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[role], role)


def _variant(record: Column) -> Column:
    """The parsed record, NULL if it is no JSON; an error if that cannot be told from a limit."""
    said = F.concat(
        F.lit("a record of "), F.length(record).cast("string"),
        F.lit(" characters cannot be read: it is no JSON, or has a string of over 20,000,000 characters or over 128 MiB"),
    )
    return F.coalesce(F.try_parse_json(record), F.when(F.length(record) > RECORD_CHARS, F.raise_error(said).cast("variant")))


def _turns(mapping: Mapping, record: Column) -> Column:
    turn = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    if mapping.turns is None:
        said = []
        for role, *names in mapping.fields:
            parts = [F.variant_get(record, f"$.{n}", "string") for n in names]
            parts = [parts[0], *[F.nullif(p, F.lit("")) for p in parts[1:]]]
            said.append(turn(F.lit(role), F.coalesce(F.concat_ws("\n\n", *parts), F.lit(""))))
        return F.array(*said)
    items = F.variant_get(record, f"$.{mapping.turns}", f"array<struct<`{mapping.role}` string, `{mapping.text}` string>>")
    role = lambda m: F.coalesce(m[mapping.role], F.lit(""))
    return F.transform(items, lambda m: turn(_named(role(m)), F.coalesce(m[mapping.text], F.lit(""))))


def canonical(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds ``layout`` and ``turns``, an array of (role, text)."""
    whole, mark = unused(records, "_variant", "_print")
    parsed = records.withColumn(whole, _variant(F.col(record))).withColumn(mark, fingerprint(F.col(whole)))
    known = lambda m: F.col(mark) == fingerprint(F.parse_json(F.lit(m.example)))
    layout, turns = F.lit("unknown"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for m in reversed(mappings):
        layout = F.when(known(m), m.name).otherwise(layout)
        turns = F.when(known(m), _turns(m, F.col(whole))).otherwise(turns)
    return parsed.withColumns({"layout": layout, "turns": turns}).drop(whole, mark)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(conversations: DataFrame, learn: str = "assistant") -> DataFrame:
    """Adds ``formatted`` and ``loss``, the (start, length) in code points of texts to learn from."""
    piece = lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(MESSAGE), escape(t["text"]), F.lit(END))
    (pieces,) = unused(conversations, "_parts")
    parts = conversations.withColumn(
        pieces,
        F.transform(
            "turns",
            lambda t: F.struct(
                piece(t).alias("s"),
                (t["role"] == learn).alias("learn"),
                F.length(piece(t)).alias("all"),
                F.length(escape(t["text"])).alias("text"),
            ),
        ),
    )
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("found"))

    def step(a: Column, p: Column) -> Column:
        upto = a["at"] + p["all"]
        span = F.struct((upto - len(END) - p["text"]).alias("start"), p["text"].cast("long").alias("length"))
        return F.struct(upto.alias("at"), F.when(p["learn"], F.array_append(a["found"], span)).otherwise(a["found"]).alias("found"))

    return (
        parts.withColumn("formatted", F.array_join(F.transform(pieces, lambda p: p["s"]), ""))
        .withColumn("loss", F.aggregate(pieces, begin, step, lambda a: a["found"]))
        .drop(pieces)
    )


def read_back(text: str = "formatted") -> Column:
    """The turns of a formatted string, as an array of (role, text)."""
    bare = F.filter(F.split(text, r"<\|end\|>"), lambda s: s != "")
    part = lambda s, i: unescape(F.split(F.substring(s, len(START) + 1, 2**31 - 1), r"<\|message\|>")[i])
    return F.transform(bare, lambda s: F.struct(part(s, 0).alias("role"), part(s, 1).alias("text")))


def under_mask(text: str = "formatted", loss: str = "loss") -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda p: unescape(F.substring(F.col(text), (p["start"] + 1).cast("int"), p["length"].cast("int")))), "")


def _gathered(rows: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """(id, _said): the messages of each conversation, by turn."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    message = F.struct(F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("content"))
    return rows.groupBy(F.col(id).alias(id)).agg(F.sort_array(F.collect_list(message)).alias("_said"))


def records_of_rows(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, record): rows by turn gathered into one ``messages`` record per conversation."""
    messages = F.transform("_said", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return _gathered(rows, id, turn, role, text).select(id, F.to_json(F.struct(messages.alias("messages"))).alias("record"))


def _numbered(mapping: Mapping) -> Column:
    """The record of ``_said`` in a layout, with the number of a turn for its role and its text."""
    number = lambda i: i.cast("string")
    if mapping.turns is None:
        # a turn of several fields is said by the first, the others are empty
        first = {fields[0]: str(i) for i, (_, *fields) in enumerate(mapping.fields)}
        return F.to_json(F.struct(*[F.lit(first.get(f, "")).alias(f) for _, *fields in mapping.fields for f in fields]))
    record = F.transform("_said", lambda m, i: F.struct(number(i).alias(mapping.role), number(i).alias(mapping.text)))
    for field in reversed(mapping.turns.split(".")):
        record = F.struct(record.alias(field))
    return F.to_json(record)


def _sayable(mapping: Mapping) -> Column:
    """Whether a layout can say the turns of ``_said``: a list any, fields only their own roles."""
    if mapping.turns is not None:
        return F.lit(True)
    roles = F.transform("_said", lambda m: m["role"])
    return F.coalesce(roles == F.array(*[F.lit(role) for role, *_ in mapping.fields]), F.lit(False))


def canonical_rows(
    rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    mappings: tuple[Mapping, ...] = MAPPINGS, deal: Column | None = None,
) -> DataFrame:
    """(id, layout, turns): conversations by turn, read back from records of a layout each.

    ``deal``, a whole number made of ``id``, picks among the layouts that can say a
    conversation, in the order of ``mappings``; without it the first of them is taken.
    """
    said = _gathered(rows, id, turn, role, text)
    able = F.array_compact(F.array(*[F.when(_sayable(m), F.lit(i)) for i, m in enumerate(mappings)]))
    chosen = said.withColumn("_able", able).withColumn(
        "_layout", F.get("_able", F.pmod(F.lit(0) if deal is None else deal, F.greatest(F.size("_able"), F.lit(1))).cast("int"))
    )
    record = F.lit(None).cast("string")
    for i, m in enumerate(mappings):
        record = F.when(F.col("_layout") == i, _numbered(m)).otherwise(record)
    found = canonical(chosen.withColumn("_record", record), "_record", mappings)
    at = lambda reference: F.get("_said", reference.try_cast("int"))
    turns = F.transform(
        "turns",
        lambda t: F.struct(F.coalesce(at(t["role"])["role"], t["role"]).alias("role"), at(t["text"])["content"].alias("text")),
    )
    return found.select(id, "layout", turns.alias("turns"))
