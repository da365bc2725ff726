"""Quality rules as a short-circuit cascade (DataFrame expressions only).

Every rule is a boolean column "this document is rejected".  ``plan_cascade``
measures each rule on a sample (seconds and rejected share) and orders the rules by
rejected share per second, so that cheap and selective rules come first;
``cascade`` turns the order into one CASE expression, which Spark evaluates branch
by branch: a later rule runs only on documents that every earlier rule let pass.
The verdict does not depend on the order.

Defined results: a null text counts as empty (no words, rejected by the first
rule); repeated rows are judged one by one; further columns pass through; names that
start with ``__q_`` are reserved for intermediate columns; an empty table gives an
empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import WORD, let, saved, table

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8


Measures = Mapping[str, Column]


@dataclass(frozen=True)
class Rule:
    """``reject`` makes a boolean column from the measures named in ``needs``."""

    name: str
    needs: tuple[str, ...]
    reject: Callable[[Measures], Column]

    def hit(self, m: Measures) -> Column:
        return F.coalesce(self.reject(m), F.lit(False))


def words_of(text: Column) -> Column:
    """Words of a whole text; null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_chars(text: Column) -> Column:
    """Code points inside words."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]+", "")).cast("long")


def symbol_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def worded_lines(text: Column) -> Column:
    """Lines (split at line feeds) that hold at least one word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))


def duplicate_lines(lines: Column) -> Column:
    """Lines equal to an earlier one."""
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by ``window``-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hash.  Texts whose window hashes are all different
    (one hash-set pass) end there; the others sort (hash, position) once and sum the
    stretches that the repeated windows cover.
    """
    n = F.size(words)
    hashes = F.when(n >= window, F.transform(F.sequence(F.lit(1), n - window + 1),
                                             lambda i: F.xxhash64(F.slice(words, i, window)))).otherwise(
        F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i"))))

        def positions(s: Column) -> Column:
            again = F.filter(s, lambda e, i: (F.get(s, i - 1)["h"].eqNullSafe(e["h"]) & (i > 0))
                             | F.get(s, i + 1)["h"].eqNullSafe(e["h"]))
            return F.sort_array(F.transform(again, lambda e: e["i"]))

        start = F.struct(F.lit(-window).cast("long").alias("last"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(
            let(ordered, positions), start,
            lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(window).cast("long"),
                                                                         p - a["last"])).alias("total")),
            lambda a: a["total"])

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
               .otherwise(covered(h)))


def letter_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}]+", "")).cast("long")


def measures(words: Column, lines: Column, text: Column) -> dict[str, Column]:
    """Every measure as an expression over the word array, the line array and the text."""
    return {"n_words": F.size(words).cast("long"), "word_chars": word_chars(text), "n_symbols": symbol_count(text),
            "n_lines": F.size(lines).cast("long"), "n_dup_lines": duplicate_lines(lines),
            "n_repeat_words": repeated_words(words), "letter_chars": letter_chars(text)}


def base_rules() -> list[Rule]:
    """The two fixed rules: too few words, too many words inside repeated windows."""
    return [Rule("few_words", ("n_words",), lambda m: m["n_words"] < 20),
            Rule("repeats", ("n_words", "n_repeat_words"), lambda m: m["n_repeat_words"] * 100 > m["n_words"] * 30)]


def extra_rules() -> list[Rule]:
    """Lenient rules for junk: symbols, word lengths, repeated lines, texts with hardly any letters."""
    return [
        Rule("symbols", ("n_symbols", "n_words"), lambda m: m["n_symbols"] * 5 > m["n_words"]),
        Rule("word_length", ("word_chars", "n_words"),
             lambda m: let(m["word_chars"] / F.greatest(m["n_words"], F.lit(1)), lambda x: (x < 2) | (x > 20))),
        Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda m: m["n_dup_lines"] * 2 > m["n_lines"]),
        Rule("letters", ("letter_chars", "word_chars"), lambda m: m["letter_chars"] * 2 < m["word_chars"]),
    ]


def _tokenised(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    frame = docs.withColumns({"__q_words": words_of(F.col("text")), "__q_lines": worded_lines(F.col("text"))})
    return frame, measures(F.col("__q_words"), F.col("__q_lines"), F.col("text"))


def plan_cascade(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = 2000, seed: int = 7) -> list[Rule]:
    """Rules ordered by rejected share per second, both measured on about ``sample_rows`` rows.

    The sample only steers the order, never a verdict.  Ties and an empty sample keep
    the given order.
    """
    total = docs.count()
    if not total:
        return list(rules)
    sample = saved(docs.select("text").sample(fraction=min(1.0, sample_rows / total), seed=seed).coalesce(2))
    size, scored = sample.count(), []
    frame, m = _tokenised(sample)
    for at, rule in enumerate(rules):
        began = time.perf_counter()
        hits = frame.agg(F.count_if(rule.hit(m))).first()[0]
        seconds = max(time.perf_counter() - began, 1e-4)
        scored.append((-(hits / max(size, 1)) / seconds, at, rule))
    return [r for _, _, r in sorted(scored, key=lambda x: x[:2])]


def cascade(rules: Sequence[Rule], m: Measures) -> Column:
    """True if no rule rejects; the rules run in order and stop at the first rejection."""
    verdict = F
    for r in rules:
        verdict = verdict.when(r.hit(m), F.lit(False))
    return verdict.otherwise(F.lit(True)) if rules else F.lit(True)


def quality_report(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every row of ``docs`` (columns ``doc_id``, ``text``)."""
    rules = extra_rules() if rules is None else list(rules)
    ordered = plan_cascade(docs, rules, sample_rows)
    frame, m = _tokenised(docs.select("doc_id", "text"))
    shown = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    frame = frame.withColumns({k: m[k] for k in shown})
    m = m | {k: F.col(k) for k in shown}
    few, repeats = base_rules()
    frame = frame.withColumn("base_failed", few.hit(m) | repeats.hit(m))
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(ordered, m))
    return frame.withColumn("kept", kept).select("doc_id", *shown, "base_failed", "kept")


def quality_filter(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """Rows that no rule rejects, with the columns of ``docs``.

    All rules, the base ones included, form one cascade over expressions, so the dear
    measures are computed only for the rows that come that far.
    """
    rules = plan_cascade(docs, [*base_rules(), *extra_rules()], sample_rows)
    text = F.col("text")
    # bound by let: a filter is pushed below a column of words, which would then be split again for every window
    passed = let(words_of(text), lambda words: cascade(rules, measures(words, worded_lines(text), text)))
    return docs.filter(passed)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
base AS (SELECT doc_id, t, len(w)::BIGINT AS n_words,
                length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
                len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l,
                length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS letters, w
         FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS g FROM base, unnest(range(1, len(w) - 6)) u(i)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j)::BIGINT AS n FROM rep, range(0, 8) r(j) GROUP BY 1),
m AS (SELECT b.*, len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM base b LEFT JOIN cov c USING (doc_id)),
f AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 5 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_dup_lines > n_lines OR 2 * letters < word_chars) AS kept
FROM f
"""


@register("op1_quality_rules", SQL)
def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents")).drop("n_lines")
