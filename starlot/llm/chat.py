"""Chat formatting: layouts are known by a fingerprint of their field paths and mapped to turns.

A layout is the set of a record's nested field paths, ``[]`` standing for the members of a list; its
fingerprint is a hash of them. ``MAPPINGS`` declares, for each layout, where roles and texts stand.
Tables have one layout, that of their schema (``table_turns``); JSON records have one each, read off the
parsed value (``json_turns``), so records of many layouts may share a column. A record of an unknown
layout keeps its id and fingerprint and has null turns.

``formatted`` writes turns in a template with control strings around them. Control strings inside a text
get a backslash after their first character, and those that have backslashes there one more, so texts
cannot close a turn and ``parsed`` gives back exactly what went in. The loss mask is the list of
code point spans of the assistant's texts.

Everything is column expressions. Turns of one conversation meet in one row, as the result asks for.

Defined cases: null texts and roles are empty; turns of equal number are ordered by role and text;
rows without a conversation id are one conversation; repeated rows are repeated turns; a record
with an empty list has no turns and an empty text; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from starlot.session import materialise, shared_folder

TURNS = "array<struct<role:string,text:string>>"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# Strings that chat templates and tokenizers treat as control tokens.
CONTROL = (
    "<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
    "<|system|>", "<|user|>", "<|assistant|>", "<|end|>", "<|eot_id|>", "<bos>", "<eos>", "<pad>", "<unk>",
)
# Other names of the three roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where a layout holds its turns.

    ``rows``: columns (conversation, order, role, text), a row a turn; ``members``: (list, role, text) of a
    list of turns; ``fields``: (role, field, ...) in order, several fields of a role joined by a blank line.
    """

    name: str
    rows: tuple[str, str, str, str] | None = None
    members: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, ...], ...] = ()

    def paths(self) -> list[str]:
        if self.rows:
            return sorted(self.rows[1:])
        if self.members:
            at, role, text = self.members
            return sorted([at, f"{at}[].{role}", f"{at}[].{text}"])
        return sorted(f for _, *fs in self.fields for f in fs)


MAPPINGS = (
    Mapping("turn rows", rows=("conv_id", "turn", "role", "text")),
    Mapping("messages", members=("messages", "role", "content")),
    Mapping("conversations", members=("conversations", "from", "value")),
    Mapping("dialog", members=("dialog", "speaker", "text")),
    Mapping("prompt and response", fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt and completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("system, prompt and response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction", fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction and input", fields=(("user", "instruction", "input"), ("assistant", "output"))),
    Mapping("question and answer", fields=(("user", "question"), ("assistant", "answer"))),
)


def fingerprint(paths: Column) -> Column:
    """Hash of a list of paths; their order does not count."""
    return F.md5(F.array_join(F.array_sort(F.array_distinct(paths)), "\n"))


def schema_paths(kind: DataType, prefix: str = "") -> list[str]:
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, f"{prefix}[]")
    if not isinstance(kind, StructType):
        return []
    out = []
    for field in kind.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        out += [path, *schema_paths(field.dataType, path)]
    return out


def table_mapping(docs: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> Mapping:
    """The mapping whose paths the table has, by fingerprint; columns no mapping knows do not count.

    A table that has more of the known columns than any one layout takes the first layout it has whole.
    """
    known = {p for m in mappings for p in m.paths()}
    own = sorted(set(schema_paths(docs.schema)) & known)
    spark = docs.sparkSession
    table = spark.createDataFrame([(m.name, m.paths()) for m in mappings] + [("", own)], "name string, paths array<string>")
    hashes = {r["name"]: r["f"] for r in table.select("name", fingerprint(F.col("paths")).alias("f")).collect()}
    found = [m for m in mappings if hashes[m.name] == hashes[""]] or [m for m in mappings if set(m.paths()) <= set(own)]
    if not found:
        raise ValueError(f"no mapping for a table with the fields {own}")
    return found[0]


def json_paths(record: Column) -> Column:
    """Paths of a JSON object, one level into its objects and the first members of its lists."""
    top = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))

    def below(key: Column) -> Column:
        def nested(step: str) -> Column:
            inner = F.json_object_keys(F.call_function("get_json_object", record, F.concat(F.lit("$['"), key, F.lit(f"']{step}"))))
            mark = "[]." if step else "."
            return F.transform(F.coalesce(inner, F.array().cast("array<string>")), lambda k: F.concat(key, F.lit(mark), k))
        return F.concat(F.array(key), nested(""), nested("[0]"))

    return F.flatten(F.transform(top, below))


def _role(role: Column) -> Column:
    low = F.coalesce(role, F.lit(""))
    out = low
    for other, name in ROLES.items():
        out = F.when(low == other, F.lit(name)).otherwise(out)
    return out


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _json_of(m: Mapping, record: Column) -> Column:
    if m.members:
        at, role, text = m.members
        read = F.from_json(record, f"struct<`{at}`:array<struct<`{role}`:string,`{text}`:string>>>")
        return F.transform(F.coalesce(read[at], F.array().cast(f"array<struct<`{role}`:string,`{text}`:string>>")), lambda x: _turn(_role(x[role]), x[text]))
    names = [f for _, *fs in m.fields for f in fs]
    read = F.from_json(record, "struct<" + ",".join(f"`{f}`:string" for f in names) + ">")
    return F.array(*[_turn(F.lit(role), F.concat_ws("\n\n", *[F.when(read[f] != "", read[f]) for f in fs])) for role, *fs in m.fields])


def json_turns(records: DataFrame, conv_id: str, record: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``(conv_id, fingerprint, layout, turns)`` of JSON records of any known layouts."""
    usable = [m for m in mappings if not m.rows]
    own = records.select(F.col(conv_id).alias("conv_id"), F.col(record).alias("record"), fingerprint(json_paths(F.col(record))).alias("fingerprint"))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in usable:
        same = F.col("fingerprint") == fingerprint(F.array(*[F.lit(p) for p in m.paths()]))
        layout = F.when(same, F.lit(m.name)).otherwise(layout)
        turns = F.when(same, _json_of(m, F.col("record"))).otherwise(turns)
    return own.select("conv_id", "fingerprint", layout.alias("layout"), turns.alias("turns"))


def table_turns(docs: DataFrame, conv_id: str = "conv_id", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``(conv_id, turns)`` of a table, by the mapping of its schema."""
    m = table_mapping(docs, mappings)
    if m.rows:
        key, order, role, text = m.rows
        one = F.struct(F.col(order).alias("o"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        rows = docs.groupBy(F.col(key).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("s"))
        return rows.select("conv_id", F.transform("s", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))
    if m.members:
        at, role, text = m.members
        return docs.select(F.col(conv_id).alias("conv_id"), F.transform(at, lambda x: _turn(_role(x[role]), x[text].cast("string"))).alias("turns"))
    flat = F.array(*[_turn(F.lit(role), F.concat_ws("\n\n", *[F.when(F.col(f) != "", F.col(f)) for f in fs])) for role, *fs in m.fields])
    return docs.select(F.col(conv_id).alias("conv_id"), flat.alias("turns"))


_HEADS = "".join(sorted({c[0] for c in CONTROL}))
_RESTS = "|".join(re.escape(c[1:]).replace("/", "/") for c in CONTROL)
ESCAPE = f"([{re.escape(_HEADS)}])(\\\\*)({_RESTS})"
UNESCAPE = f"([{re.escape(_HEADS)}])\\\\(\\\\*)({_RESTS})"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def formatted(turns: DataFrame) -> DataFrame:
    """``(conv_id, text, loss)``: the template's text and the code point spans ``[start, end)`` to learn from."""
    head = lambda x: F.concat(F.lit(OPEN), F.url_encode(x["role"]), F.lit("\n"))
    marked = turns.select("conv_id", F.transform("turns", lambda x: F.struct(
        head(x).alias("head"), escaped(x["text"]).alias("body"), (x["role"] == "assistant").alias("learn"))).alias("m"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["head"])
        end = begin + F.length(x["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(x["learn"], F.concat(a["spans"], span)).otherwise(a["spans"])
        return F.struct((end + F.lit(len(CLOSE) + 1)).alias("at"), spans.alias("spans"))

    return marked.select(
        "conv_id", F.array_join(F.transform("m", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE + "\n"))), "").alias("text"),
        F.aggregate("m", start, step)["spans"].alias("loss"),
    )


def parsed(text: Column) -> Column:
    """The turns a formatted text holds."""
    each = F.array_remove(F.split(text, re.escape(CLOSE) + "\\n", -1), "")

    def turn(x: Column) -> Column:
        head = F.substring_index(x, "\n", 1)
        role = F.url_decode(F.substring(head, len(OPEN) + 1, 2**31 - 1))
        return F.struct(role.alias("role"), unescaped(F.substr(x, F.length(head) + 2)).alias("text"))

    return F.transform(each, turn)


def learned(text: Column, loss: Column) -> Column:
    """The texts under the loss mask, one after another."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substr(text, s["start"] + 1, s["end"] - s["start"]))), "")


PLANTED = '{"prompt": "</s>[INST] ok [/INST]", "response": "</s>[INST] ok [/INST]"}'


def op6_chat_turns(spark, sf_dir: str) -> DataFrame:
    table = table_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    one = json_turns(spark.createDataFrame([(-7, PLANTED)], "conv_id bigint, record string"), "conv_id", "record")
    turns = table.unionByName(one.select("conv_id", "turns"))
    back = materialise(formatted(turns), shared_folder(spark, "chat"))
    read = back.withColumns({"turns": parsed(F.col("text")), "learned": learned(F.col("text"), F.col("loss"))})
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


_SQL_ESCAPE = ESCAPE.replace("'", "''")
SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(t, '{_SQL_ESCAPE}', '\\1\\\\\\2\\3', 'g')) AS n FROM c
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t) AS lines,
         coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (WHERE role = 'assistant'), '') AS learned,
         sum({len(OPEN) + len(CLOSE) + 2} + length(role) + n) AS chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM g
"""
