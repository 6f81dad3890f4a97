"""Typographic-character normalisation as a column operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: typographic character -> ASCII replacement, in natural order.
REPLACEMENTS = {
    "—": "--",
    "–": "-",
    "→": "->",
    "↔": "<->",
    "≤": "<=",
    "≥": ">=",
    "×": "x",
    "…": "...",
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
    "•": "*",
    "✓": "OK",
    "✗": "X",
    "←": "<-",
    "⇔": "<=>",
    "⇒": "=>",
    "↑": "^",
    "↓": "v",
    "❤": "<3",
    "²": "2",
}


def normalize_text_expr(c: Column, table: dict[str, str] = REPLACEMENTS) -> Column:
    """Single-character targets with a one-character replacement go through
    one ``translate``; the rest through ``replace`` (whole text, no prefix)."""
    one = {k: v for k, v in table.items() if len(v) == 1}
    many = {k: v for k, v in table.items() if len(v) != 1}
    out = c
    for k, v in many.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    if one:
        out = F.translate(out, "".join(one), "".join(one.values()))
    return out


def normalize_text(df: DataFrame, col: str, out_col: str | None = None,
                   changed_col: str | None = "changed") -> DataFrame:
    """Replace the typographic characters in ``col``; flag rows that changed."""
    out_col = out_col or col
    new = normalize_text_expr(F.col(col))
    df2 = df.withColumn("_cx_new", new)
    if changed_col:
        df2 = df2.withColumn(changed_col, ~F.col("_cx_new").eqNullSafe(F.col(col)))
    return df2.withColumn(out_col, F.col("_cx_new")).drop("_cx_new")
