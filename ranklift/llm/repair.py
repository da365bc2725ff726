"""Repair of damaged conversations at least cost, by an auction shortest-path algorithm.

Every turn of a conversation is kept, given another role or deleted, and empty turns are
inserted, so that the role initials read ``(s?(ua)+)?``.  The choices form a lattice: a node
(i, q) stands for i turns read and state q (0 start, 1 after the system turn, 2 after a
user, 3 after an assistant), an arc for one edit with a whole-number cost.

The auction keeps a price for every node, at most an arc's cost plus the price at its end,
and a path of arcs where both are equal.  From the path's last node it either contracts
(the price rises to the least of cost plus price over the arcs, and the path goes back a
node) or extends along that least arc, until it meets a node whose price is final.  Origins
are taken from the last turn to the first and keep each other's prices, so each needs few
steps.  In the end a price is the least cost from its node, the tight arcs (price = cost
plus price at the end) are those of the cheapest repairs, and following the least letter of
a tight arc spells the least repair.

Only a turn's sort is needed for that: one letter for its initial and first fault.  A
conversation is a string of such letters, each distinct string is solved once, and the
letters of the answer go back to the turns by conversation and place.  Places are numbered
along a global order cut into ranges, and repeated turns are found by digest, so texts of
one conversation are never gathered; the digest of its repaired text is one SHA-256 stream,
which one task reads batch by batch.  Its string of letters, the ``audit`` of the result,
has to fit into a row, as the contract returns it so, and its lattice into a task.

Defined results: turns are ordered by (turn with null first, role, text), after damage;
null role and null text are one space, and so is a null turn or conv_id in the damage's
key; rows without a conv_id are one conversation; a turn's initial is the first character
of its role, and an empty or other role has to be changed or deleted; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import table, written

#: Costs of the edits, and what a truncated turn costs that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FINE, BLANK, DUPLICATE, CUT = range(4)
INITIALS = "sua"
#: Letters of a string that are gathered at once.
BLOCK = 4096
SPACES = " \t\n\v\f\r"
_MOVES = {0: "u", 1: "u", 2: "a", 3: "u"}  # state -> the role that may follow, besides a first system turn
_AFTER = {"s": 1, "u": 2, "a": 3}
_ROLES = {"u": "user", "a": "assistant"}


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) after the faults that crc32 of their key deals out."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return (rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault"))
            .filter("fault <> 0").select(
                "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
                .otherwise(F.col("text")).alias("text"),
                F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def _places(batches):
    """Adds the range and the place in it, counted from 1 within a conversation, to rows in order."""
    pid, key, k = TaskContext.get().partitionId(), None, 0
    for b in batches:
        keys = b.column("key").to_pylist()
        new = np.array([x != y for x, y in zip(keys, [key, *keys[:-1]], strict=True)], bool)
        begun = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
        place = np.where(begun < 0, np.arange(len(keys)) + k + 1, np.arange(len(keys)) - begun + 1)
        if len(keys):
            key, k = keys[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(keys), pid)), pa.array(place)],
                                         names=[*b.schema.names, "pid", "place"])


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with a non-null string ``key`` for conv_id, and ``place`` (from 1) in the conversation's order."""
    rows = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), "turn", "role", "text")
    order = ["key", F.col("turn").asc_nulls_first(), "role"]
    rows = rows.repartitionByRange(*order, F.left("text", F.lit(64))).sortWithinPartitions(*order, "text")
    kind = "key string, turn long, role string, text string, pid long, place long"
    rows = written(rows.mapInArrow(_places, kind), "places")
    before = Window.partitionBy("key").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = (rows.groupBy("key", "pid").agg(F.max("place").alias("n"))
               .select("key", "pid", F.sum("n").over(before).alias("before")).filter("before is not null"))
    # one row at most for each range, for the conversation that it goes on with
    return (rows.join(F.broadcast(carried), ["key", "pid"], "left")
            .select("key", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "turn", "role", "text"))


def letters(rows: DataFrame) -> DataFrame:
    """(key, place, letter): initial and first fault of each turn, as one letter from A on."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    light = rows.select("key", "place", digest.alias("digest"), F.instr(F.lit(INITIALS), F.left("role", F.lit(1))).alias("i"),
                        (F.left("role", F.lit(1)) == "").alias("none"), (trimmed == "").alias("blank"),
                        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    again = light.groupBy("key", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    fault = (F.when(F.col("blank"), BLANK).when(F.coalesce(F.col("place") > F.col("first"), F.lit(False)), DUPLICATE)
             .when(F.col("cut"), CUT).otherwise(FINE))
    initial = F.when(F.col("none") | (F.col("i") == 0), len(INITIALS)).otherwise(F.col("i") - 1)
    return (light.join(again.drop("n"), ["key", "digest"], "left")
            .select("key", "place", F.char(F.lit(65) + initial * 4 + fault).alias("letter")))


def _joined(order: Column, value: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value.alias("x")))), lambda s: s["x"]), "")


def patterns(marks: DataFrame) -> DataFrame:
    """(key, pattern): the letters of a conversation in order, gathered block by block."""
    block = F.floor((F.col("place") - 1) / BLOCK).alias("block")
    parts = marks.groupBy("key", block).agg(_joined(F.col("place"), F.col("letter")).alias("part"))
    return parts.groupBy("key").agg(_joined(F.col("block"), F.col("part")).alias("pattern"))


def _arcs(q: int, initial: int, fault: int) -> list[tuple[str, int, int, int, str]]:
    """(letter, cost, turns read, next state, role given) of the edits at a turn in state q; ascending letters."""
    role = _MOVES[q]
    out = [("D", DELETE, 1, q, "-"), ("I", INSERT, 0, _AFTER[role], role)]
    if fault in (FINE, CUT):
        extra = TRUNCATED if fault == CUT else 0
        own = INITIALS[initial] if initial < len(INITIALS) else ""
        if own == role or (own == "s" and q == 0):
            out.append(("K", KEEP + extra, 1, _AFTER[own], own))
        out.append(("R", REROLE + extra, 1, _AFTER[role], role))
    return out


#: Arcs by sort of turn and state; those after the last turn are inserts.
_ARCS = {(x, q): _arcs(q, *divmod(x, 4)) for x in range(16) for q in range(4)}
_LAST = {q: [("I", INSERT, 0, _AFTER[_MOVES[q]], _MOVES[q])] for q in range(4)}
_DONE = (0, 3)


def auction(pattern: str) -> tuple[int, str, str]:
    """(cost, edits, roles): the cheapest edits' letters, least first among equals, and the role each one gives."""
    sorts = [ord(x) - 65 for x in pattern]
    n = len(sorts)
    sink = 4 * (n + 1)
    price = [0] * (sink + 1)
    final = bytearray(sink + 1)
    final[sink] = 1

    def arcs(node):
        i, q = divmod(node, 4)
        own = _ARCS[sorts[i], q] if i < n else _LAST[q]
        for letter, cost, read, to, role in own:
            yield cost, 4 * (i + read) + to, letter, role
        if i == n and q in _DONE:
            yield 0, sink, "", ""

    for origin in range(sink - 1, -1, -1):
        path = [origin]
        while not final[path[-1]]:
            node = path[-1]
            best, to = min((cost + price[end], end) for cost, end, _, _ in arcs(node))
            if price[node] < best:  # contract
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:  # extend
                path.append(to)
        for node in path:
            final[node] = 1

    node, edits, roles = 0, [], []
    while True:
        _, node, letter, role = min((letter, end, letter, role) for cost, end, letter, role in arcs(node)
                                    if price[node] == cost + price[end])
        if node == sink:
            return price[0], "".join(edits), "".join(roles)
        edits.append(letter)
        roles.append(role)


_PAIRS = {"su", "ua", "au"}


def _solve(batches):
    for b in batches:
        out = []
        for p in b.column("pattern").to_pylist():
            codes = np.frombuffer(p.encode(), np.uint8) - 65
            initials = "".join((INITIALS + "-")[i] for i in codes >> 2)
            illegal = sum(initials[k:k + 2] not in _PAIRS for k in range(len(p) - 1))
            counts = np.bincount(codes & 3, minlength=4)
            out.append((p, *(int(counts[f]) for f in (BLANK, DUPLICATE, CUT)), illegal, *auction(p)))
        kinds = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                         names=["pattern", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "roles"])


def _edits(batches):
    """(key, place, step, edit, role) of each letter of an audit; an insert has the place of the turn that follows."""
    for b in batches:
        for key, audit, roles in zip(*(b.column(c).to_pylist() for c in ("key", "audit", "roles")), strict=True):
            letters_, given = (np.frombuffer(x.encode(), "S1").astype(str) for x in (audit, roles))
            read = letters_ != "I"
            place = np.cumsum(read) + ~read
            for a in range(0, len(place), 1 << 16):
                z = min(a + (1 << 16), len(place))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * (z - a), pa.string()), pa.array(place[a:z]), pa.array(np.arange(a, z)),
                     pa.array(letters_[a:z], pa.string()), pa.array(given[a:z], pa.string())],
                    names=["key", "place", "step", "edit", "role"])


def _digest(batches):
    """(key, repaired_sha256) from edits and turns in order: a turn comes right after its edit."""
    key, h, line, edit, given = None, None, False, "", ""
    for b in batches:
        out = []
        for k, e, role, text in zip(*(b.column(c).to_pylist() for c in ("key", "edit", "role", "text")), strict=True):
            if k != key:
                if key is not None:
                    out.append((key, h.hexdigest()))
                key, h, line = k, hashlib.sha256(), False
            if e is not None:
                edit, given = e, role
                if e != "I":
                    continue
                role, text = _ROLES[given], ""
            elif edit == "D":
                continue
            elif edit == "R":
                role = _ROLES[given]
            h.update(b"\n" * line + role.encode() + b":" + text.encode())
            line = True
        yield _digests(out)
    if key is not None:
        yield _digests([(key, h.hexdigest())])


def _digests(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)],
                                      names=["key", "repaired_sha256"])


def repair(rows: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text; no null role or text): faults, edits, digest.

    Conversations that only ``before`` (conv_id) has get a row of zeros.
    """
    turns = placed(rows)
    solved = written(patterns(letters(turns)), "patterns")
    answers = solved.select("pattern").distinct().mapInArrow(
        _solve, "pattern string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, roles string")
    solved = written(solved.join(answers, "pattern").drop("pattern"), "answers")
    edits = solved.select("key", "audit", "roles").mapInArrow(_edits, "key string, place long, step long, edit string, role string")
    stream = (edits.select("*", F.lit(None).cast("string").alias("text")).unionByName(turns.select(
        "key", "place", F.lit(None).cast("long").alias("step"), F.lit(None).cast("string").alias("edit"), "role", "text"))
        .repartition("key").sortWithinPartitions("key", "place", F.col("step").asc_nulls_last()))
    digests = stream.select("key", "edit", "role", "text").mapInArrow(_digest, "key string, repaired_sha256 string")
    span = F.try_subtract(F.max("turn"), F.min("turn"))
    gaps = (turns.filter("turn is not null").groupBy("key", "turn").agg(F.count("*")).groupBy("key")
            .agg(F.try_subtract(span, F.count("*") - 1).alias("gaps")))
    ids = (before if before is not None else rows).select("conv_id").distinct()
    ids = ids.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (ids.join(solved.drop("roles"), "key", "left").join(digests, "key", "left").join(gaps, "key", "left")
            .select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))


def _sql() -> str:
    """DuckDB SQL: damage with a table-driven CRC, then the least (cost, letters) by turn and state."""
    edit = lambda s, cost, letter, line="''": (
        f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 't': {s}.t || {line}}} END")
    insert = lambda s, role: edit(s, INSERT, "I", f"'{role}:' || chr(10)")
    least = lambda *xs: f"list_min([{', '.join(xs)}])"
    keep = lambda s, i: f"CASE WHEN ini = '{i}' AND f IN (0, 3) THEN {edit(s, 'extra', 'K', 'role || chr(58) || text || chr(10)')} END"
    given = lambda s, role: f"CASE WHEN f IN (0, 3) THEN {edit(s, 'extra + 1', 'R', f"'{role}:' || text || chr(10)")} END"
    user = [x for s in ("s0", "s1", "i3") for x in (keep(s, "u"), given(s, "user"))]
    return f"""
WITH bits AS (SELECT b::UBIGINT AS b, b AS v0 FROM range(256) r(b)),
c8 AS (
  WITH RECURSIVE s AS (SELECT b, b AS v, 0 AS i FROM bits
    UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, i + 1 FROM s WHERE i < 8)
  SELECT list(v ORDER BY b) AS tab FROM s WHERE i = 8),
ids AS (SELECT DISTINCT coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
crc AS (
  WITH RECURSIVE w AS (SELECT s, 1 AS i, 4294967295::UBIGINT AS v FROM ids
    UNION ALL SELECT s, i + 1, xor(v >> 8, tab[1 + (xor(v, ascii(s[i])::UBIGINT) & 255)::BIGINT])
    FROM w, c8 WHERE i <= length(s))
  SELECT s, (xor(v, 4294967295::UBIGINT) % 20)::BIGINT AS fault FROM w WHERE i = length(s) + 1),
dam AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
         unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM conversations JOIN crc ON s = coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')
  WHERE fault <> 0),
r AS (SELECT coalesce(conv_id::VARCHAR, '') AS key, turn, role, text, left(role, 1) AS ini,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM dam),
z AS (SELECT *, CASE WHEN regexp_full_match(text, '[\\x20\\x09-\\x0D]*') THEN 1 WHEN seen > 1 THEN 2
        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 3 ELSE 0 END AS f,
        lead(ini) OVER (PARTITION BY key ORDER BY k) AS after_, lead(k) OVER (PARTITION BY key ORDER BY k) AS next_ FROM r),
st AS (SELECT key, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (f = 1) AS blank, count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated,
         count(*) FILTER (next_ IS NOT NULL AND ini || '|' || after_ NOT IN ('s|u', 'u|a', 'a|u')) AS illegal FROM z GROUP BY key),
rec AS (
  WITH RECURSIVE p AS (
    SELECT key, 0::BIGINT AS k, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s1,
           NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s3 FROM st
    UNION ALL
    SELECT key, k, {edit('s0', DELETE, 'D')}, {least(edit('s1', DELETE, 'D'), keep('s0', 's'))},
           {least(edit('i2', DELETE, 'D'), *user)}, {least(edit('i3', DELETE, 'D'), keep('i2', 'a'), given('i2', 'assistant'))}
    FROM (SELECT *, {least('s3', insert('i2', 'assistant'))} AS i3
          FROM (SELECT p.key, z.k, z.role, z.text, z.ini, z.f, CASE WHEN z.f = 3 THEN 5 ELSE 0 END AS extra, s0, s1, s3,
                       {least('s2', insert('s0', 'user'), insert('s1', 'user'), insert('s3', 'user'))} AS i2
                FROM p JOIN z ON z.key = p.key AND z.k = p.k + 1)))
  SELECT key, {least('s0', 's3', insert(least('s2', insert('s0', 'user'), insert('s1', 'user')), 'assistant'))} AS best
  FROM p JOIN st USING (key) WHERE p.k = st.n)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(CASE WHEN best.t = '' THEN '' ELSE left(best.t, length(best.t) - 1) END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '') AS key FROM conversations) c
LEFT JOIN st USING (key) LEFT JOIN rec USING (key)
"""


SQL = _sql()


@register("op12_conversation_repair", SQL)
def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damage(rows), rows)
