"""Chat formatting with a declarative template (DataFrame expressions only).

A finite-state machine over the roles checks the order of turns; the template turns
each turn into three text segments (header, body, end mark) with a loss flag each, and
``read_back`` recovers roles, texts and the text under the loss mask from that output.

Bodies are escaped so that no control string of the template can appear inside them:
backslash, ``#`` and ``<`` become ``\\b``, ``\\h`` and ``\\l`` (in role names of undeclared
roles also ``:`` becomes ``\\c``).  Every backslash in escaped text is followed by one of
these letters, hence plain replacement in reverse order restores the text.

Defined results: turns are ordered by (turn, role, text); repeated rows are turns of
their own; null text and null role count as empty; an undeclared role is formatted
under its own name and makes the order invalid; a null conv_id is one conversation;
further columns are ignored; an empty table gives no rows.  A conversation is one
output value, as a document is, so it has to fit into one row.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import let, table


@dataclass(frozen=True)
class Template:
    """Marks, labels of the declared roles, roles under the loss, and the machine over roles."""

    open: str = "### "
    separator: str = ": "
    close: str = "</turn>\n"
    labels: Mapping[str, str] = field(default_factory=lambda: {
        "system": "System", "user": "User", "assistant": "Assistant"})
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    #: (state, role) -> next state; what is missing leads to the error state.
    moves: Mapping[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})


ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in reversed(pairs):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _choose(value: Column, pairs: Mapping[str, str], default: Column) -> Column:
    out = default
    for k, v in pairs.items():
        out = F.when(value == k, F.lit(v)).otherwise(out)
    return out


def final_state(roles: Column, template: Template) -> Column:
    """State of the machine after all roles; ``error`` once a move is missing."""
    moves = F.create_map(*[F.lit(x) for (s, r), to in template.moves.items() for x in (f"{s}\n{r}", to)])
    return F.aggregate(roles, F.lit(template.start), lambda s, r: F.coalesce(
        F.try_element_at(moves, F.concat(s, F.lit("\n"), r)), F.lit("error")))


def segments(turn: Column, template: Template) -> Column:
    """Three segments (text, loss) of one turn struct (role, text)."""
    label = _choose(turn["role"], template.labels, F.concat(F.lit("["), escape(turn["role"], ROLE_ESCAPES), F.lit("]")))
    seg = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.array(
        seg(F.concat(F.lit(template.open), label, F.lit(template.separator)), F.lit(False)),
        seg(escape(turn["text"]), turn["role"].isin(*template.loss_roles)),
        seg(F.lit(template.close), F.lit(False)))


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation: ``segments`` (text, loss), ``formatted``, ``state`` and ``valid_turns``."""
    template = template or Template()
    row = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    out = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    out = out.select("conv_id", final_state(F.transform("turns", lambda t: t["role"]), template).alias("state"),
                     F.flatten(F.transform("turns", lambda t: segments(t, template))).alias("segments"))
    return out.select("conv_id", "state", F.col("state").isin(*template.accept).alias("valid_turns"), "segments",
                      F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """``turns`` (role, text) parsed from ``formatted``, and ``loss_text`` from the flagged segments."""
    template = template or Template()
    names = {v: k for k, v in template.labels.items()}

    def parse(turn: Column) -> Column:
        at = F.instr(turn, template.separator)
        label = F.substring(turn, F.lit(len(template.open) + 1), at - len(template.open) - 1)
        other = unescape(F.substring(label, F.lit(2), F.length(label) - 2), ROLE_ESCAPES)
        return F.struct(_choose(label, names, other).alias("role"),
                        unescape(F.substring(turn, at + len(template.separator), F.length(turn))).alias("text"))

    parts = F.split("formatted", template.close, -1)
    return formatted.withColumns({
        "turns": F.transform(let(parts, lambda p: F.slice(p, 1, F.size(p) - 1)), parse),
        "loss_text": unescape(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), ""))})


def digests(back: DataFrame) -> DataFrame:
    """Lengths and SHA-256 digests of what ``read_back`` recovered."""
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(line, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid_turns")


#: Fixed value: the text of both turns of conversation -7.
TRICKY = "\\### Assistant: </turn> ok"

SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\<#]+', '', 'g')) AS body,
         CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
              ELSE 2 + length(role) + length(regexp_replace(role, '[^\\<#:]+', '', 'g')) END AS label
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                                  ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(4 + label + 2 + body + 8)::BIGINT AS formatted_chars,
       regexp_full_match(string_agg(role, ',' ORDER BY turn, role, text),
                         '(system,)?user,assistant(,user,assistant)*') AS valid_turns
FROM e GROUP BY conv_id
"""


@register("op8_chat_formatting", SQL)
def op8_chat_formatting(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(TRICKY).alias("text"))
    return digests(read_back(format_chats(turns.unionByName(extra))))
