"""Schemas of extraction targets: leaves, envelopes, relaxed and narrowed forms."""

from __future__ import annotations

from pyspark.sql import types as T


def leaf(value: T.DataType) -> T.StructType:
    """An extracted value with its quote, page, box and confidence; value and quote are null together."""
    return T.StructType().add("value", value).add("quote", T.StringType()).add("page", T.IntegerType()).add("bbox", T.ArrayType(T.DoubleType())).add("confidence", T.StringType())


def envelope(owner: str, sub_owner: str | None = None) -> T.StructType:
    """The schema of one definition: owner, sub-owner, featureName, grantedAtLevel, effects as JSON text."""
    out = T.StructType().add(owner, leaf(T.StringType()), False)
    if sub_owner:
        out = out.add(sub_owner, leaf(T.StringType()))
    return out.add("featureName", leaf(T.StringType()), False).add("grantedAtLevel", leaf(T.IntegerType()), False).add("effects", leaf(T.StringType()), False)


def relax(t: T.DataType) -> T.DataType:
    """The type with everything nullable, at any depth."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, relax(f.dataType), True, f.metadata) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(relax(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(relax(t.keyType), relax(t.valueType), True)
    return t


def narrow(t: T.StructType, names: list[str]) -> T.StructType:
    """The fields a task asks for, all required, in the schema's order."""
    return T.StructType([T.StructField(f.name, f.dataType, False, f.metadata) for f in t.fields if f.name in names])


def leaf_paths(t: T.DataType, prefix: str = "") -> list[str]:
    """The paths of all leaves; list fields carry ``[]``."""
    if isinstance(t, T.ArrayType):
        return leaf_paths(t.elementType, prefix + "[]")
    if isinstance(t, T.StructType) and not {"value", "quote"} <= set(t.names):
        return [p for f in t.fields for p in leaf_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    return [prefix]
