"""JSON text to typed records, as column expressions.

* ``read_json(col, schema)`` - JSON text to a struct.
* ``read_encoded_json(col, schema)`` - URL-encoded JSON (``+`` is a space) to a struct.
* ``convert_record(col, schema)`` - any struct/map to another record type through
  a JSON round trip, so numbers, strings and dates convert the way a JSON
  mapper converts them.

Two behaviours on bad input:

* lenient (default): malformed text, a value of the wrong type or a bad URL
  escape gives a NULL struct (not a struct of NULLs); unknown fields are ignored.
* ``strict=True``: the query fails on malformed text and on top-level fields
  the schema does not declare - the behaviour of a default JSON object mapper
  (nested objects are checked for malformed text and types, not for extra
  fields).

Conversions follow a JSON object mapper: numbers become strings or decimals,
strings become dates/timestamps, and quoted numbers or booleans (``"7"``,
``"true"``) fill numeric and boolean fields (numeric and boolean leaves are
read as text, then cast). A value that does not convert invalidates the
record. ``coerce=False`` keeps Spark's JSON reader rules instead.

Everything stays in JVM-side expressions; no Python UDF. The lenient form
parses each value once (the repeated ``from_json`` is one common
subexpression); the strict form also lists the object's keys, a second pass
over the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_tidewater_corrupt"


def _schema(schema: str | T.StructType) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    parsed = T.DataType.fromDDL(schema)
    if isinstance(parsed, T.StructType):
        return parsed
    raise TypeError(f"schema must describe a struct, got {schema!r}")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_text(dt: T.DataType) -> T.DataType:
    """The same shape with numeric and boolean leaves read as text."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_as_text(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(dt.keyType, _as_text(dt.valueType), True)
    if isinstance(dt, (T.NumericType, T.BooleanType)):
        return T.StringType()
    return dt


def _typed(v: Column, dt: T.DataType) -> Column:
    """Text leaves of ``v`` as ``dt``, at any depth. An integer field takes any
    number, its fraction cut off (``7.9`` and ``7e0`` give 7); a number out of the
    type's range does not convert."""
    if isinstance(dt, T.StructType):
        return F.when(v.isNotNull(), F.struct(*[_typed(v[f.name], f.dataType).alias(f.name) for f in dt.fields]))
    if isinstance(dt, T.ArrayType):
        return F.transform(v, lambda x: _typed(x, dt.elementType))
    if isinstance(dt, T.MapType):
        return F.transform_values(v, lambda _, x: _typed(x, dt.valueType))
    if isinstance(dt, T.IntegralType):
        return F.coalesce(v.try_cast(dt), v.try_cast("decimal(38,18)").try_cast(dt))
    return v.try_cast(dt)


def _lost(src: Column, dst: Column, dt: T.DataType) -> Column:
    """True where a non-NULL value of ``src`` became NULL in ``dst`` (the
    converted copy), at any depth - a value that did not convert."""
    here = src.isNotNull() & dst.isNull()
    if isinstance(dt, T.StructType):
        for f in dt.fields:
            here = here | (src.isNotNull() & dst.isNotNull() & _lost(src[f.name], dst[f.name], f.dataType))
        return here
    if isinstance(dt, T.ArrayType):
        inner = F.exists(F.zip_with(src, dst, lambda a, b: _lost(a, b, dt.elementType)), lambda x: x)
        return here | (src.isNotNull() & dst.isNotNull() & inner)
    if isinstance(dt, T.MapType):
        inner = F.exists(
            F.zip_with(F.map_values(src), F.map_values(dst), lambda a, b: _lost(a, b, dt.valueType)), lambda x: x
        )
        return here | (src.isNotNull() & dst.isNotNull() & inner)
    return here


def _holds_struct(dt: T.DataType) -> bool:
    if isinstance(dt, T.ArrayType):
        return _holds_struct(dt.elementType)
    if isinstance(dt, T.MapType):
        return _holds_struct(dt.valueType)
    return isinstance(dt, T.StructType)


def _unknown_fields(text: Column, dt: T.DataType, path: str = "") -> Column:
    """Paths of the JSON text's fields that ``dt`` lacks, at any depth. Inner values
    are read as JSON text again; a value of another kind than ``dt`` says has none
    (it does not convert, which is found elsewhere)."""
    none = F.array().cast("array<string>")
    if isinstance(dt, T.ArrayType):
        items = F.coalesce(F.from_json(text, "array<string>"), none)
        return F.flatten(F.transform(items, lambda x: _unknown_fields(x, dt.elementType, path)))
    members = F.from_json(text, "map<string,string>")
    if isinstance(dt, T.MapType):
        values = F.coalesce(F.map_values(members), none)
        return F.flatten(F.transform(values, lambda x: _unknown_fields(x, dt.valueType, f"{path}*.")))
    allowed = F.array(*[F.lit(f.name) for f in dt.fields]).cast("array<string>")
    own = F.array_except(F.coalesce(F.json_object_keys(text), none), allowed)
    parts = [F.transform(own, lambda x: F.concat(F.lit(path), x)) if path else own]
    parts += [_unknown_fields(members[f.name], f.dataType, f"{path}{f.name}.") for f in dt.fields if _holds_struct(f.dataType)]
    return F.concat(*parts) if len(parts) > 1 else own if not path else parts[0]


def read_json(
    col: str | Column, schema: str | T.StructType, strict: bool = False, coerce: bool = True
) -> Column:
    """JSON text to a struct of ``schema``.

    ``coerce=True`` converts like a JSON object mapper: numeric and boolean
    fields accept quoted values (``"7"`` for an int). Values that do not
    convert make the record invalid - a NULL struct when lenient, an error
    when strict. ``strict`` also raises on a field that the schema lacks, within
    structs, arrays and maps too. ``coerce=False`` keeps Spark's JSON reader rules.
    """
    st = _schema(schema)
    c = _col(col)
    read_as = _as_text(st) if coerce else st
    converted = [f for f, g in zip(st.fields, read_as.fields) if f.dataType != g.dataType]
    if strict:
        parsed = F.from_json(c, read_as, {"mode": "FAILFAST"})
        unknown = _unknown_fields(c, st)
        typed = parsed
        if converted:
            fields = []
            for f in st.fields:
                v = parsed[f.name]
                if f in converted:
                    t = _typed(v, f.dataType)
                    v = F.when(_lost(v, t, f.dataType), F.raise_error(
                        F.concat(F.lit(f"JSON field {f.name} does not convert to {f.dataType.simpleString()}: "), c)
                    ).cast(f.dataType)).otherwise(t)
                fields.append(v.alias(f.name))
            typed = F.struct(*fields)
        return F.when(c.isNull(), F.lit(None).cast(st)).when(
            F.size(unknown) > 0,
            F.raise_error(F.concat(F.lit("unknown JSON fields "), F.to_json(unknown), F.lit(" in "), c)).cast(st),
        ).otherwise(typed)
    with_corrupt = T.StructType(read_as.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(c, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    bad = parsed.isNull() | parsed[_CORRUPT].isNotNull()
    if not converted:
        return F.when(bad, F.lit(None).cast(st)).otherwise(parsed.dropFields(_CORRUPT))
    fields = []
    for f in st.fields:
        v = parsed[f.name]
        if f in converted:
            t = _typed(v, f.dataType)
            bad = bad | _lost(v, t, f.dataType)
            v = t
        fields.append(v.alias(f.name))
    return F.when(bad, F.lit(None).cast(st)).otherwise(F.struct(*fields))


def decode_url(col: str | Column, strict: bool = False) -> Column:
    """``application/x-www-form-urlencoded`` decoding, UTF-8; ``+`` becomes a space."""
    c = _col(col)
    return F.url_decode(c) if strict else F.try_url_decode(c)


def read_encoded_json(
    col: str | Column, schema: str | T.StructType, strict: bool = False, coerce: bool = True
) -> Column:
    return read_json(decode_url(col, strict=strict), schema, strict=strict, coerce=coerce)


def convert_record(
    col: str | Column, schema: str | T.StructType, strict: bool = False, coerce: bool = True
) -> Column:
    """Re-type a struct or map column by writing and re-reading it as JSON."""
    return read_json(F.to_json(_col(col)), schema, strict=strict, coerce=coerce)
