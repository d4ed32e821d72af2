"""Value text for DML statements (F1-F11), as Spark expressions over one column spec.

A column spec is a struct with ``sp_col, sp_type, sp_is_array, src_col, src_type``; the
payloads are parsed maps (see ``functions.values``). Lookup order is keys, then new
values; JSON null renders as ``NULL``; an absent column renders as SQL NULL (left out).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riverbed.functions import bind
from riverbed.functions import values as V

# Source (MySQL / PostgreSQL) type names rendered as quoted, escaped text.
QUOTED_TYPES = (
    "varchar", "char", "text", "tinytext", "mediumtext", "longtext", "enum", "date", "time", "year",
    "set", "json", "geometry", "geometrycollection", "point", "multipoint", "linestring",
    "multilinestring", "polygon", "multipolygon", "tinyblob", "mediumblob", "blob", "longblob",
)
# Source types rendered as a time-zone conversion, and as a hex literal.
TIME_TYPES = ("timestamp", "datetime")
BINARY_TYPES = ("binary", "varbinary")

DIALECTS = ("mysql", "postgresql")

#: Stream types whose numbers are taken as they are written.
NUMBER_TYPES = (*V.FLOAT_TYPES, *V.NUMERIC_TYPES)


def escape(t: Column, escape_backslash: bool = False) -> Column:
    """drop NUL characters, double single quotes; optionally double backslashes."""
    out = F.replace(F.replace(t, F.lit("\u0000"), F.lit("")), F.lit("'"), F.lit("''"))
    if escape_backslash:
        out = F.replace(out, F.lit("\\"), F.lit("\\\\"))
    return out


def quote(t: Column, escape_backslash: bool = False) -> Column:
    return F.concat(F.lit("'"), escape(t, escape_backslash), F.lit("'"))


def hex_literal(t: Column, escape_backslash: bool = False) -> Column:
    """``X'<lower hex of the UTF-8 bytes of the escaped text>'``."""
    return F.concat(F.lit("X'"), F.lower(F.hex(escape(t, escape_backslash))), F.lit("'"))


def time_value(t: Column, tz: Column, dialect: str, escape_backslash: bool = False) -> Column:
    """Cut the trailing ``Z`` and convert from UTC to the source offset."""
    cut = F.substring(t, F.lit(1), F.length(t) - 1)
    q = quote(cut, escape_backslash)
    if dialect == "mysql":
        return F.concat(F.lit(" CONVERT_TZ("), q, F.lit(",'+00:00','"), tz, F.lit("')"))
    return F.concat(F.lit(" TO_CHAR((TIMESTAMP "), q, F.lit(" AT TIME ZONE '+00:00' AT TIME ZONE '"), tz,
                    F.lit("'), 'YYYY-MM-DD HH24:MI:SS')"))


def local_time(ts: Column, offset: str) -> Column:
    """Companion of F8/F9: the converted value itself (``from_utc_timestamp``)."""
    return F.from_utc_timestamp(ts, offset)


def bool_text(raw: Column) -> Column:
    return F.when(F.lower(raw).isin("true", "false"), F.lower(raw)).otherwise(raw)


def array_text(raw: Column) -> Column:
    return F.array_join(F.from_json(raw, "array<string>"), ",")


def hex_text(raw: Column) -> Column:
    """Text for a binary source column: what its hex digits spell, or the text itself where it isn't hex."""
    is_hex = (F.length(raw) % 2 == 0) & raw.rlike("^[0-9a-fA-F]*$")
    return F.coalesce(F.when(is_hex, F.unhex(raw).cast("string")), raw)


def bytes_text(raw: Column) -> Column:
    """Bytes that aren't text get replacement characters; what isn't base64 has no text at all (NULL)."""
    return F.make_valid_utf8(V.base64_bytes(raw).cast("string"))


def stream_text(raw: Column, spec: Column) -> Column:
    """Text of a present, non-null JSON value by stream type."""
    sp_type = spec["sp_type"]
    src_type = spec["src_type"]
    return (F.when(sp_type == "BOOL", bool_text(raw))
            .when((sp_type == "STRING") & F.coalesce(spec["sp_is_array"], F.lit(False)), array_text(raw))
            .when((sp_type == "STRING") & src_type.isin(*BINARY_TYPES), hex_text(raw))
            .when(sp_type == "BYTES", bytes_text(raw))
            .otherwise(raw))


def source_text(t: Column, src_type: Column, tz: Column, dialect: str, escape_backslash: bool = False) -> Column:
    """Quoting by source type; types outside the fixed lists are left bare."""
    return (F.when(src_type.isin(*QUOTED_TYPES), quote(t, escape_backslash))
            .when(src_type.isin(*TIME_TYPES), time_value(t, tz, dialect, escape_backslash))
            .when(src_type.isin(*BINARY_TYPES), hex_literal(t, escape_backslash))
            .otherwise(t))


def column_value(spec: Column, keys_m: Column, new_m: Column, tz: Column, dialect: str,
                 escape_backslash: bool = False, keys_names: Column | None = None,
                 new_names: Column | None = None, keys_exact: Column | None = None,
                 new_exact: Column | None = None) -> Column:
    """Struct ``(col, found, val)`` for one column spec: found = present in keys or new
    values; val = rendered text, ``NULL`` for JSON null, SQL NULL when absent or when the value can't be
    decoded (found tells them apart).
    ``keys_names`` / ``new_names``: the maps' key arrays computed once per row (saves a
    key-array copy per column test)."""
    name = spec["sp_col"]
    if keys_names is not None and new_names is not None:
        in_k = F.coalesce(F.array_contains(keys_names, name), F.lit(False))
        found = in_k | F.coalesce(F.array_contains(new_names, name), F.lit(False))
    else:
        in_k = V.has(keys_m, name)
        found = in_k | V.has(new_m, name)
    raw = F.when(in_k, V.text(keys_m, name)).otherwise(V.text(new_m, name))
    if keys_exact is not None and new_exact is not None:
        # numbers as written in the payload
        exact = F.when(in_k, V.text(keys_exact, name)).otherwise(V.text(new_exact, name))
        raw = F.when(spec["sp_type"].isin(*NUMBER_TYPES), exact).otherwise(raw)
    # Lambdas are interpreted without common-subexpression elimination: bind each value once
    # to a lambda variable instead of repeating its expression at every use.
    val = bind(raw, lambda r: F.when(r.isNull(), F.lit("NULL")).otherwise(
        bind(stream_text(r, spec), lambda t: source_text(t, spec["src_type"], tz, dialect, escape_backslash))))
    val = F.when(~found, F.lit(None).cast("string")).otherwise(val)
    return F.struct(spec["src_col"].alias("col"), found.alias("found"), val.alias("val"))


def value_text(raw: Column, sp_type: str | None, is_array: bool | None, src_type: str | None, tz: Column, dialect: str,
               escape_backslash: bool = False) -> Column:
    """F1-F11 of a present, non-null value whose types are known when the plan is made: the one branch of ``stream_text``
    and ``source_text`` that they choose."""
    if sp_type == "BOOL":
        t = bool_text(raw)
    elif sp_type == "STRING" and is_array:
        t = array_text(raw)
    elif sp_type == "STRING" and src_type in BINARY_TYPES:
        t = hex_text(raw)
    elif sp_type == "BYTES":
        t = bytes_text(raw)
    else:
        t = raw
    if src_type in QUOTED_TYPES:
        return quote(t, escape_backslash)
    if src_type in TIME_TYPES:
        return time_value(t, tz, dialect, escape_backslash)
    return hex_literal(t, escape_backslash) if src_type in BINARY_TYPES else t
