"""Nested JSON building-model documents -> object tables.

A model document maps object class -> object name -> field -> value.  The
documents are parsed by Spark (``from_json`` into nested maps) and exploded
to one row per (document, class, object, field), the relational form every
scenario operator works on.  Field values keep their JSON text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL_MAP = "map<string, map<string, map<string, string>>>"


def explode_model(docs: DataFrame, doc_col: str = "doc", keys: list[str] | None = None) -> DataFrame:
    """``(keys..., object_class, object_name, field, value)`` per field."""
    keys = keys or []
    parsed = docs.select(*keys, F.from_json(F.col(doc_col), MODEL_MAP).alias("_m"))
    classes = parsed.select(*keys, F.explode("_m").alias("object_class", "_objs"))
    objects = classes.select(*keys, "object_class", F.explode("_objs").alias("object_name", "_fields"))
    return objects.select(*keys, "object_class", "object_name",
                          F.explode("_fields").alias("field", "value"))


def object_table(fields: DataFrame, object_class: str, columns: dict[str, str],
                 keys: list[str] | None = None) -> DataFrame:
    """Pivot the fields of one class to typed columns (known field list)."""
    keys = keys or []
    one = fields.where(F.col("object_class") == object_class)
    aggs = [F.max(F.when(F.col("field") == f, F.col("value"))).cast(t).alias(f)
            for f, t in columns.items()]
    return one.groupBy(*keys, "object_name").agg(*aggs)


def edit_fields(obj, set_fields: dict, drop_fields: list[str]):
    """P20: set and drop fields of a nested object column (struct)."""
    out = obj
    for name, value in set_fields.items():
        out = out.withField(name, value if hasattr(value, "alias") else F.lit(value))
    if drop_fields:
        out = out.dropFields(*drop_fields)
    return out
