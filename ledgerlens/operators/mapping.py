"""Schema mapping: select + rename + cast in one projection, struct flattening,
derived columns and the non-empty key filter.

All of these compile to a single ``Project``/``Filter`` over the scan, so
Catalyst can prune columns and push the filter into the reader.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import non_empty
from ..schemas import Mapping

_TYPES = {"string": "string", "int": "int", "integer": "int", "long": "bigint",
          "bigint": "bigint", "double": "double", "float": "float",
          "boolean": "boolean", "date": "date", "timestamp": "timestamp"}


def quote(name: str) -> str:
    """Back-quote a column name so that dots are part of the name."""
    return "`" + name.replace("`", "``") + "`"


def _field_type(schema: StructType, path: list[str]):
    t = schema
    for p in path:
        if not isinstance(t, StructType):
            return None
        match = [f for f in t.fields if f.name.lower() == p.lower()]
        if not match:
            return None
        t = match[0].dataType
    return t


class _Resolver:
    """Looks names up in one snapshot of the schema (a schema call per column
    would cost a round trip to the JVM each time)."""

    def __init__(self, df: DataFrame):
        self.schema = df.schema
        self.top = {f.name.lower(): f.name for f in self.schema.fields}

    def sql(self, source: str) -> str | None:
        """SQL reference to ``source`` or None when it does not exist."""
        if source.lower() in self.top:
            return quote(self.top[source.lower()])
        path = source.split(".")
        if len(path) > 1 and _field_type(self.schema, path) is not None:
            return ".".join(quote(p) for p in path)
        return None

    def __call__(self, source: str) -> Column | None:
        ref = self.sql(source)
        return None if ref is None else F.col(ref)


def resolve(df: DataFrame, source: str) -> Column | None:
    """Column for ``source``: a flat (possibly dotted) name first, else a
    nested struct path; None when neither exists.  Matching ignores case."""
    return _Resolver(df)(source)


def _spark_type(t: str) -> str:
    return _TYPES.get(t.lower(), t)


def mapped_sql(ref: str | None, m: Mapping) -> str:
    target = _spark_type(m.target_type)
    if ref is None:
        return f"CAST(NULL AS {target}) AS {quote(m.target)}"
    # A cast to the type the column already has is removed by the optimizer.
    return f"try_cast({ref} AS {target}) AS {quote(m.target)}"


def apply_mapping(df: DataFrame, mappings: Iterable[Mapping]) -> DataFrame:
    """Keep, rename and cast the mapped columns; drop all others.

    One ``select`` regardless of the number of columns (a ``withColumn`` loop
    over hundreds of columns would grow the plan quadratically).  Casts are
    ``try_cast`` because raw values may be malformed; a mapped column that is
    missing in the source becomes a typed null.
    """
    r = _Resolver(df)
    # Built as SQL text: one call into the JVM however wide the mapping is.
    return df.selectExpr(*[mapped_sql(r.sql(m.source), m) for m in mappings])


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> top-level columns named by their dotted path.

    Arrays are left as they are.  A single projection; no data movement.
    """
    cols: list[Column] = []

    def walk(t: StructType, prefix: list[str]):
        for f in t.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, StructType):
                walk(f.dataType, path)
            else:
                cols.append(F.col(".".join(quote(p) for p in path)).alias(sep.join(path)))

    walk(df.schema, [])
    return df.select(*cols)


def derive(df: DataFrame, name: str, sql_expr: str | Column) -> DataFrame:
    """Add (or replace) one column from a SQL expression or a Column."""
    e = F.expr(sql_expr) if isinstance(sql_expr, str) else sql_expr
    return df.withColumn(name, e)


def keep_non_empty(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose key has at least one character before any newline."""
    return df.filter(non_empty(F.col(quote(column))))

