"""A few values known to the driver as rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def local_rows(spark: SparkSession, columns: Mapping[str, str], rows: Iterable[tuple]) -> DataFrame:
    """A few values known to the driver as a frame that plans without Python."""
    structs = []
    for row in rows:
        cells = []
        for (name, kind), value in zip(columns.items(), row):
            text = "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
            cells.append(f"CAST({text} AS {kind}) AS `{name}`")
        structs.append(f"struct({', '.join(cells)})")
    kinds = ", ".join(f"`{name}`: {kind}" for name, kind in columns.items())
    text = f"inline(array({', '.join(structs)}))" if structs else f"inline(CAST(array() AS array<struct<{kinds}>>))"
    return spark.range(1).select(F.expr(text))

