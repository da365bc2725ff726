"""Scalar column functions (inventory C1-C20, X2).

All of these compile to built-in Catalyst expressions, so they stay inside
whole-stage codegen and run unchanged on batch or streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must match the reference's behaviour -----------------
# Title marker: the last parenthesised chunk at the very end of the title.
MARKER_PATTERN = r"\(([^)]*)\)$"
# Label of titles without a marker (a level of its own, not a missing value).
NO_MARKER = "[SIN SUFIJO]"
# Level used for a null allergens value.
ALLERGENS_NONE = "NONE"
# Sentence separator: whitespace that follows a period.
SENTENCE_SPLIT = r"(?<=\.)\s+"
# The structural (non-informative) sentence of a description.
STRUCTURAL_SENTENCE = r"^Listed under .* storage\.$"
# Three leading numbers of a dimensions text such as 3.3 x 4.0 x 4.1".
DIMENSIONS_PATTERN = r"^\s*([\d.]+)\s*x\s*([\d.]+)\s*x\s*([\d.]+)"
# Word tokens of two or more word characters; BPE pre-tokens.
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"
PRE_TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"
# -----------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rnd(col, digits: int = 6) -> Column:
    """Round half up with plain double arithmetic (same bits in any SQL engine)."""
    scale = float(10 ** digits)
    return (F.floor(_c(col) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


# C1 / C2 ---------------------------------------------------------------------
def extract_marker(title) -> Column:
    t = _c(title)
    return F.when(t.rlike(MARKER_PATTERN), F.regexp_extract(t, MARKER_PATTERN, 1)).otherwise(F.lit(NO_MARKER))


def strip_marker(title) -> Column:
    return F.trim(F.regexp_replace(_c(title), MARKER_PATTERN, ""))


# C3-C6 -----------------------------------------------------------------------
def split_sentences(text) -> Column:
    return F.split(F.trim(_c(text)), SENTENCE_SPLIT)


def final_sentence(text) -> Column:
    return F.trim(F.element_at(split_sentences(text), -1))


def extract_tail_sentence(text) -> Column:
    last = final_sentence(text)
    return F.when(last.rlike(STRUCTURAL_SENTENCE), F.lit("")).otherwise(last)


def strip_tail_sentence(text) -> Column:
    parts = split_sentences(text)
    last = F.trim(F.element_at(parts, -1))
    drop = (F.size(parts) > 1) & ~last.rlike(STRUCTURAL_SENTENCE)
    kept = F.when(drop, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.trim(F.array_join(kept, " "))


# C7 --------------------------------------------------------------------------
def text_segments(title="title", description="description", keep_marker: bool = True,
                  keep_tail: bool = True) -> tuple[Column, Column]:
    a = _c(title) if keep_marker else strip_marker(title)
    b = _c(description) if keep_tail else strip_tail_sentence(description)
    return a, b


def combined_text(title="title", description="description", keep_marker: bool = True,
                  keep_tail: bool = True) -> Column:
    a, b = text_segments(title, description, keep_marker, keep_tail)
    return F.concat_ws(" [SEP] ", a, b)


# C8-C12 ----------------------------------------------------------------------
def parse_dimensions(dims) -> list[Column]:
    """Three leading numbers; no match gives null in all three (never imputed)."""
    # without a match the extract is empty, which is no number
    return [F.regexp_extract(_c(dims), DIMENSIONS_PATTERN, i).try_cast("double") for i in (1, 2, 3)]


def dim_volume(l, w, h) -> Column:
    return _c(l) * _c(w) * _c(h)


def position_in_range(x, lo, hi) -> Column:
    x, lo, hi = _c(x), _c(lo), _c(hi)
    return F.when(hi != lo, (x - lo) / (hi - lo))


def price_per_unit(price, weight) -> Column:
    return F.when(_c(weight) != 0, _c(price) / _c(weight))


def null_as_category(col, label: str = ALLERGENS_NONE) -> Column:
    return F.coalesce(_c(col), F.lit(label))


# C13 -------------------------------------------------------------------------
def cyclic_time(ts) -> dict[str, Column]:
    """sin/cos of hour/24, weekday/7 (Monday = 0) and (month-1)/12."""
    t = _c(ts)
    two_pi = 2.0 * 3.141592653589793
    parts = {"hour": (F.hour(t), 24.0), "dow": (F.weekday(t), 7.0), "month": (F.month(t) - 1, 12.0)}
    out = {}
    for name, (v, period) in parts.items():
        angle = F.lit(two_pi) * v / F.lit(period)
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


# C15 -------------------------------------------------------------------------
def tier(marker, high: list[str], mid: list[str], labels=("ALTO", "MEDIO", "CERO")) -> Column:
    m = _c(marker)
    return (F.when(m.isin(list(high)), F.lit(labels[0]))
            .when(m.isin(list(mid)), F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


# C17 / C18 -------------------------------------------------------------------
def normalise_list(col, sep: str = ",") -> Column:
    items = F.transform(F.split(_c(col), sep), lambda s: F.trim(s))
    return F.array_sort(F.array_distinct(F.filter(items, lambda s: s != "")))


def word_count(col) -> Column:
    t = F.trim(_c(col))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"\s+")))


# C19 / C20 -------------------------------------------------------------------
def target01(col) -> Column:
    return _c(col).cast("int")


def logit_prior(p) -> Column:
    p = _c(p)
    return F.when((p > 0) & (p < 1), F.log(p / (F.lit(1.0) - p))).otherwise(
        F.raise_error(F.lit("logit_prior: prevalence must lie strictly inside (0, 1)")))


# X2 --------------------------------------------------------------------------
def hash_bigint(key, seed: int | str = 42) -> Column:
    """First 32 bits of md5('seed:key') as a non-negative bigint."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def hash_uniform(key, seed: int | str = 42) -> Column:
    """Deterministic u in [0, 1), independent of partitioning and row order."""
    return hash_bigint(key, seed) / F.lit(4294967296.0)
