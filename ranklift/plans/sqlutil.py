"""Helpers shared by the oracle SQL strings (DuckDB dialect)."""

from __future__ import annotations


def R(expr: str, digits: int = 6) -> str:
    """Round half up with double arithmetic; the twin of ``functions.scalars.rnd``."""
    scale = f"1e{digits}"
    return f"(floor(({expr}) * {scale} + 0.5) / {scale})"


# DuckDB has no look-behind: split on '.<spaces>' by re-inserting the period.
def SENTENCES(col: str) -> str:
    return f"string_split(regexp_replace(trim({col}), '\\.\\s+', '.' || chr(1), 'g'), chr(1))"


HIGH_MARKERS = ["PROMO", "LARGE"]
MID_MARKERS = ["MEDIUM"]


def sql_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


MARKER_SQL = ("CASE WHEN regexp_matches(title, '\\(([^)]*)\\)$') "
              "THEN regexp_extract(title, '\\(([^)]*)\\)$', 1) ELSE '[SIN SUFIJO]' END")

TIER_SQL = (f"CASE WHEN {MARKER_SQL} IN {sql_list(HIGH_MARKERS)} THEN 'ALTO' "
            f"WHEN {MARKER_SQL} IN {sql_list(MID_MARKERS)} THEN 'MEDIO' ELSE 'CERO' END")
