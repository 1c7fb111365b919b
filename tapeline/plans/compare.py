"""The same rounding in Spark and in the SQL twins: floor(x * 1e6 + 0.5) / 1e6, since the engines' own round() part ways at ties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[(F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def same_rounding(sql: str | None) -> str | None:
    """Writes out every `round(x, 6)` of a twin."""
    if not sql:
        return sql
    at = 0
    while (at := sql.find("round(", at)) >= 0:
        depth, end = 1, at + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[at + 6 : end - 1]
        if inner.endswith(", 6") and (not at or not (sql[at - 1].isalnum() or sql[at - 1] == "_")):
            sql = f"{sql[:at]}(floor(({inner[:-3]})::double * 1e6 + 0.5) / 1e6){sql[end:]}"
        at += 6
    return sql
