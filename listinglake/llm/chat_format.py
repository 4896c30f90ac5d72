"""Chat formatting (operator 10) by schema fingerprints, with built-in expressions only.

A record is a JSON value (VARIANT) in any layout. The nested field paths it has, out of the paths that
some mapping names, are hashed; the hash selects a declarative mapping, which turns the record into
canonical turns (pos, role, text). Records whose paths fit no mapping come back from ``unmapped``.

Template: ``### role: text</turn>\\n`` for each turn. Inside roles and texts a backslash becomes
``\\b``, ``</turn>`` becomes ``\\t`` and ``### `` becomes ``\\h`` (in roles also ``: `` becomes ``\\c``), so
no control string is left in them and the original comes back exactly. The formatted conversation
is a list of segments with a loss flag; assistant texts, and only they, are under the loss.

Defined results: null roles and texts are empty; a null position sorts first, ties sort by role and
text, and repeated rows are repeated turns; rows without a conv_id are one conversation; an empty
table gives no rows; other columns are never read. A conversation is one value, as its consumers
need it; its turns are gathered after the per-turn work is done.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "struct<pos: bigint, role: string, text: string>"
END, HEAD, SEP = "</turn>\n", "### ", ": "


@dataclass(frozen=True)
class Mapping:
    """Layout with exactly these ``paths`` (of all paths that mappings name). Either ``items`` =
    (list, role, text) names a list of messages, or ``row`` = (position, role, text) a record that is one
    turn, or ``turns`` gives (role, paths whose non-empty texts are joined by a blank line)."""
    name: str
    paths: tuple[str, ...]
    items: tuple[str, str, str] | None = None
    row: tuple[str, str, str] | None = None
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)

    @property
    def signature(self) -> str:
        return "\n".join(sorted(self.paths))


SHARED_ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant"}


def _flat(name: str, *turns: tuple[str, tuple[str, ...]]) -> list[Mapping]:
    with_system = (("system", ("system",)), *turns)
    return [Mapping(n, tuple(p for _, ps in t for p in ps), turns=t) for n, t in ((name, turns), (f"system_{name}", with_system))]


MAPPINGS: tuple[Mapping, ...] = (
    Mapping("turn_row", ("turn", "role", "text"), row=("turn", "role", "text")),
    Mapping("messages", ("messages[].role", "messages[].content"), items=("messages", "role", "content")),
    Mapping("shared", ("conversations[].from", "conversations[].value"), items=("conversations", "from", "value"), roles=SHARED_ROLES),
    *_flat("prompt_completion", ("user", ("prompt",)), ("assistant", ("completion",))),
    *_flat("prompt_response", ("user", ("prompt",)), ("assistant", ("response",))),
    *_flat("instruction", ("user", ("instruction",)), ("assistant", ("output",))),
    *_flat("instruction_input", ("user", ("instruction", "input")), ("assistant", ("output",))),
    *_flat("question_answer", ("user", ("question",)), ("assistant", ("answer",))),
)


def _at(record: Column, path: str, kind: str) -> Column:
    return F.variant_get(record, "$." + path.replace("[]", "[0]"), kind)


def fingerprint(record: Column, mappings: tuple[Mapping, ...] = MAPPINGS) -> Column:
    """Hash of the sorted nested field paths that the record has."""
    known = sorted({p for m in mappings for p in m.paths})
    has = [F.when(F.try_variant_get(record, "$." + p.replace("[]", "[0]"), "variant").isNotNull(), F.lit(p)) for p in known]
    return F.xxhash64(F.concat_ws("\n", *has))


def _text(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, f"$.{path}", "string"), F.lit(""))


def _renamed(role: Column, roles: dict[str, str]) -> Column:
    for old, new in roles.items():
        role = F.when(role == old, F.lit(new)).otherwise(role)
    return role


def _turns(m: Mapping, record: Column) -> Column:
    if m.items:
        path, role, text = m.items
        messages = F.try_variant_get(record, f"$.{path}", "array<variant>")
        return F.transform(messages, lambda x, i: F.struct(
            i.cast("bigint").alias("pos"), _renamed(_text(x, role), m.roles).alias("role"), _text(x, text).alias("text")))
    if m.row:
        pos, role, text = m.row
        return F.array(F.struct(F.try_variant_get(record, f"$.{pos}", "bigint").alias("pos"),
                                _renamed(_text(record, role), m.roles).alias("role"), _text(record, text).alias("text")))
    out = []
    for i, (role, paths) in enumerate(m.turns):
        parts = [F.when(_text(record, p) != "", _text(record, p)) for p in paths]
        out.append(F.struct(F.lit(i).cast("bigint").alias("pos"), F.lit(role).alias("role"),
                            F.concat_ws("\n\n", *parts).alias("text")))
    return F.array(*out)


def canonical_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``records`` (conv_id, record: variant) → conv_id, pos, role, text of every mapped record."""
    marked = records.select("conv_id", "record", fingerprint(F.col("record"), mappings).alias("_schema"))
    turns = F.lit(None).cast(f"array<{TURN}>")
    for m in mappings:
        turns = F.when(F.col("_schema") == F.xxhash64(F.lit(m.signature)), _turns(m, F.col("record"))).otherwise(turns)
    return marked.select("conv_id", F.explode(turns).alias("t")).select("conv_id", "t.pos", "t.role", "t.text")


def unmapped(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Records that no mapping fits (also null ones and broken JSON)."""
    known = [F.col("_schema") == F.xxhash64(F.lit(m.signature)) for m in mappings]
    fits = known[0]
    for k in known[1:]:
        fits = fits | k
    return records.withColumn("_schema", fingerprint(F.col("record"), mappings)).filter(~fits).drop("_schema")


def escaped(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    out = F.replace(F.replace(out, F.lit("</turn>"), F.lit("\\t")), F.lit(HEAD), F.lit("\\h"))
    return F.replace(out, F.lit(SEP), F.lit("\\c")) if role else out


def unescaped(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\c"), F.lit(SEP)), F.lit("\\h"), F.lit(HEAD))
    return F.replace(F.replace(out, F.lit("\\t"), F.lit("</turn>")), F.lit("\\b"), F.lit("\\"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, segments (text, loss) in order, and formatted, their concatenation."""
    head = F.concat(F.lit(HEAD), escaped(F.col("role"), True), F.lit(SEP))
    rows = turns.select("conv_id", F.struct(F.col("pos"), F.col("role"), F.col("text"), head.alias("head"),
                                            escaped(F.col("text")).alias("body")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t"), _before).alias("ts"))
    segments = F.flatten(F.transform("ts", lambda t: F.array(
        F.struct(t["head"].alias("text"), F.lit(False).alias("loss")),
        F.struct(t["body"].alias("text"), (t["role"] == "assistant").alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))))
    done = grouped.select("conv_id", segments.alias("segments"))
    return done.select("conv_id", "segments", F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"))


def _before(a: Column, b: Column) -> Column:
    out = F.lit(0)
    for c in ("text", "role"):
        out = F.when(a[c] < b[c], F.lit(-1)).when(a[c] > b[c], F.lit(1)).otherwise(out)
    least = F.lit(-(1 << 63))
    pa, pb = F.coalesce(a["pos"], least), F.coalesce(b["pos"], least)
    return F.when(pa < pb, F.lit(-1)).when(pa > pb, F.lit(1)).otherwise(out)


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) parsed from the formatted text, loss_text from the loss flags."""
    pieces = F.filter(F.split("formatted", END.replace("\n", "\\n")), lambda p: p != "")
    def turn(p):
        role = F.substring_index(F.substr(p, F.lit(len(HEAD) + 1)), SEP, 1)
        return F.struct(unescaped(role).alias("role"),
                        unescaped(F.substr(p, F.length(role) + len(HEAD) + len(SEP) + 1)).alias("text"))
    loss = F.concat_ws("", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])))
    return formatted.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"), loss.alias("loss_text"))
