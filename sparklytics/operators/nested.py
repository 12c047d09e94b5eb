"""F3 on VARIANT values: deep flatten of lists whose nesting depth is not known, with exact types.

A JSON text becomes a variant; arrays are exploded level by level (``variant_explode``), each element with its path of
positions, until no array is left.  A level is a written table that holds only what is still nested, so an element is
written once, whatever the depth, and a very long or unevenly nested list is many rows, not one large value.
Sorted by path, the elements are the flattened list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rounds import scratch, written

ARRAY = "ARRAY<"


def flatten_variant(df: DataFrame, id_col: str, json_text: Column | str) -> DataFrame:
    """(id_col, path array<int>, value variant): the elements of each row's nested list.

    Elements keep their JSON type; an object is an element (its inside is not flattened) and so is null.  A text
    that is null, no JSON or no list gives no rows, and so do empty lists.  Rows that share an id share their list, so ids
    should be unique."""
    spark = df.sparkSession
    text = F.col(json_text) if isinstance(json_text, str) else json_text
    is_list = F.schema_of_variant("value").startswith(ARRAY)
    level = df.select(F.col(id_col), F.array().cast("array<int>").alias("path"), F.try_parse_json(text).alias("value")).filter(is_list)
    found = None
    while True:
        level = written(level, scratch(spark, "nested"))
        if level.isEmpty():
            return level if found is None else found
        inside = level.select(id_col, "path", F.col("value").alias("_list")).lateralJoin(
            spark.tvf.variant_explode(F.col("_list").outer()))
        inside = written(inside.select(id_col, F.array_append("path", F.col("pos").cast("int")).alias("path"), "value", is_list.alias("_nested")),
                         scratch(spark, "elements"))
        flat = inside.filter("NOT _nested").drop("_nested")
        found = flat if found is None else found.unionByName(flat)
        level = inside.filter("_nested").drop("_nested")


def flattened(elements: DataFrame, id_col: str, as_type: str | None = None) -> DataFrame:
    """(id_col, result): each list as one array in path order, of JSON texts or of ``as_type`` (an element of another type is null).
    One list is gathered into one value here; the long form above has no such bound."""
    value = F.to_json("value") if as_type is None else F.try_variant_get("value", "$", as_type)
    return (elements.select(id_col, F.struct("path", value.alias("v")).alias("e")).groupBy(id_col)
            .agg(F.transform(F.sort_array(F.collect_list("e")), lambda e: e["v"]).alias("result")))
