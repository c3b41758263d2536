"""Key search in JSON documents, at any depth.

Documents are parsed once into VARIANT values and opened level by level: each
level explodes the objects and arrays that the level before found.  The levels
are staged, so the work of a level is one pass over what is still nested, and
the number of passes is the depth of the deepest document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def _opened(level: DataFrame) -> DataFrame:
    """The members of every object and array of ``level``: (id columns, _key,
    _v, _kind); the key of an array's member is null."""
    inside = level.sparkSession.sql(
        "SELECT t.*, e.key AS _key, e.value AS _member FROM {t} t, LATERAL variant_explode(t._v) e", t=level)
    return inside.drop("_v").withColumnRenamed("_member", "_v").withColumn("_kind", F.schema_of_variant("_v"))


def key_values(documents: DataFrame, ids: Sequence[str], column: str, keys: Sequence[str]) -> DataFrame:
    """(ids, key, value): every scalar that stands under one of ``keys`` in the
    JSON text ``column``, at any depth.

    A key that holds an object or an array gives no row of its own; its
    contents are searched.  Strings come back decoded, a JSON null as null,
    truth values as true / false, numbers by value: 1e2 is 100.0 and 1.50 is
    1.5, whole numbers keep their digits up to 38.  Text that is no JSON
    document, and null, hold nothing."""
    ids = list(ids)
    level = documents.select(*ids, F.try_parse_json(F.col(column)).alias("_v")).where(F.col("_v").isNotNull())
    level = staged(level, "json-level")
    found = None
    while found is None or not level.isEmpty():
        inside = _opened(level)
        nested = F.col("_kind").startswith("OBJECT") | F.col("_kind").startswith("ARRAY")
        inside = staged(inside.where(nested | F.col("_key").isin(list(keys))).withColumn("_nested", nested), "json-level")
        scalars = inside.where("not _nested").select(
            *ids, F.col("_key").alias("key"), F.when(F.col("_kind") != "VOID", F.expr("variant_get(_v, '$', 'string')")).alias("value"))
        found = scalars if found is None else found.unionByName(scalars)
        level = inside.where("_nested").select(*ids, "_v")
    return found
