"""How a column goes into an outbound document, by its type.

The plan follows the schema, not a list of columns: arrays, maps, structs and
variants (JSON text read with ``parse_json``) nest as JSON values, at any depth.
User attributes take arrays and maps; event attributes take maps only, so an
array there is its JSON text. Inside a value everything nests.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DayTimeIntervalType, MapType, NullType, StringType, StructType, VariantType, YearMonthIntervalType,
)

# What nests as a value at the top of each category.
NESTS = {"user_attributes": (ArrayType, MapType, StructType), "app_event_attributes": (MapType, StructType),
         "user_identities": ()}
TEXT_OPTIONS = {"ignoreNullFields": "false"}


def _plain(dt: DataType) -> bool:
    """Whether JSON takes values of this type as they are."""
    if isinstance(dt, ArrayType):
        return _plain(dt.elementType)
    if isinstance(dt, MapType):
        return isinstance(dt.keyType, StringType) and _plain(dt.valueType)
    if isinstance(dt, StructType):
        return all(_plain(f.dataType) for f in dt.fields)
    return not isinstance(dt, (NullType, DayTimeIntervalType, YearMonthIntervalType))


def _key(dt: DataType, key: Column) -> Column:
    return key if isinstance(dt, StringType) else \
        F.to_json(key, TEXT_OPTIONS) if isinstance(dt, (ArrayType, MapType, StructType)) else key.cast("string")


def json_value(dt: DataType, c: Column) -> Column:
    """``c`` as a value that JSON takes: map keys become text, types without a
    JSON form become text, nested values likewise."""
    if _plain(dt):
        return c
    if isinstance(dt, ArrayType):
        return F.transform(c, lambda x: json_value(dt.elementType, x))
    if isinstance(dt, MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            _key(dt.keyType, e["key"]).alias("key"), json_value(dt.valueType, e["value"]).alias("value")))
        return F.map_from_entries(entries)
    if isinstance(dt, StructType):
        fields = [json_value(f.dataType, c.getField(f.name)).alias(f.name) for f in dt.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c.cast("string")


def nested(dt: DataType, c: Column, category: str) -> Column:
    """``c`` as it goes into the given category of a document."""
    kinds = NESTS[category]
    if isinstance(dt, VariantType):
        if ArrayType in kinds:
            return c
        text = F.to_json(c).cast("variant")
        object_ = F.substring(F.schema_of_variant(c), 1, 6) == "OBJECT"
        scalar = ~F.substring(F.schema_of_variant(c), 1, 5).isin("OBJEC", "ARRAY")
        return F.when(scalar | object_, c).otherwise(text) if MapType in kinds else F.when(scalar, c).otherwise(text)
    if isinstance(dt, (ArrayType, MapType, StructType)) and not isinstance(dt, kinds):
        return F.to_json(json_value(dt, c), TEXT_OPTIONS)
    return json_value(dt, c)
