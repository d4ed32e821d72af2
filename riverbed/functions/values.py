"""Typed extraction from change payloads (keys / new-values JSON).

Payloads are parsed once per row into ``map<string,string>`` (``from_json`` with
``prefersDecimal``, which keeps every digit of large numbers and the ``12.0`` lexeme of
floats) and looked up by name. The map distinguishes the three states of a column:

* absent      -> ``has`` is false
* JSON null   -> key present, value NULL
* a value     -> the value's text (strings unquoted, objects/arrays as JSON text)

All functions are built-in Spark expressions (JVM side, no Python per row). Keys can be
literal names or Columns (e.g. a column name taken from a mapping frame).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riverbed.functions import bind

# Stream type names: GoogleSQL and PostgreSQL spellings of the nine families.
BOOL_TYPES = ("BOOL", "PG_BOOL")
INT_TYPES = ("INT64", "PG_INT8")
FLOAT_TYPES = ("FLOAT64", "PG_FLOAT8")
STRING_TYPES = ("STRING", "PG_VARCHAR", "PG_TEXT")
NUMERIC_TYPES = ("NUMERIC", "PG_NUMERIC")
JSON_TYPES = ("JSON", "PG_JSONB")
BYTES_TYPES = ("BYTES", "PG_BYTEA")
TIMESTAMP_TYPES = ("TIMESTAMP", "PG_TIMESTAMPTZ", "PG_COMMIT_TIMESTAMP")
DATE_TYPES = ("DATE", "PG_DATE")

SPARK_TYPE = {}
for _names, _t in ((BOOL_TYPES, "boolean"), (INT_TYPES, "bigint"), (FLOAT_TYPES, "double"),
                   (STRING_TYPES, "string"), (NUMERIC_TYPES, "decimal(38,9)"), (JSON_TYPES, "string"),
                   (BYTES_TYPES, "binary"), (TIMESTAMP_TYPES, "timestamp"), (DATE_TYPES, "date")):
    for _n in _names:
        SPARK_TYPE[_n] = _t

JSON_OPTIONS = {"prefersDecimal": "true"}


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def _key(k) -> Column:
    return k if isinstance(k, Column) else F.lit(k)


def parse(json_col) -> Column:
    """JSON object text -> map<string,string> (one parse per row and payload)."""
    return F.from_json(_c(json_col), "map<string,string>", JSON_OPTIONS)


def has(m: Column, key) -> Column:
    """X9 presence test: true for a value and for JSON null."""
    return F.coalesce(F.map_contains_key(m, _key(key)), F.lit(False))


def text(m: Column, key) -> Column:
    """Text of a field; NULL when absent or JSON null."""
    return F.try_element_at(m, _key(key))


# From the end of the last match: everything that isn't a number, string literals as a whole; then a number.
_NUMBERS = r'\G((?:[^"0-9-]++|"(?:[^"\\]++|\\.)*+")*+)(-?[0-9]++(?:\.[0-9]++)?(?:[eE][-+]?[0-9]++)?)'


def exact(json_col) -> Column:
    """Like ``parse``, with the numbers of the object as they are written: the parser behind ``parse`` reads a
    number with a fraction as a double. Every number is put in quotes first (numbers inside string literals
    are stepped over), so that its text is the value; nested objects are not for use in this form."""
    return parse(F.regexp_replace(_c(json_col), _NUMBERS, '$1"$2"'))


def number_text(m: Column, key, exact_m: Column | None) -> Column:
    """Text of a field with numbers as written: from the map that ``exact`` gives, if there is one."""
    return text(m if exact_m is None else exact_m, key)


def is_json_null(m: Column, key) -> Column:
    """X9 null test: present and JSON null."""
    return has(m, key) & text(m, key).isNull()


def _missing(m: Column, key) -> Column:
    return text(m, key).isNull()


def _required(value: Column, m: Column, required: bool, key, what: str) -> Column:
    if not required:
        return value
    missing = _missing(m, key)
    msg = F.concat(F.lit(f"required {what} field missing or null: "), _key(key))
    return F.when(missing, F.raise_error(msg)).otherwise(value)


def _checked(value: Column, m: Column, required: bool, key, what: str) -> Column:
    """As ``_required``, and a value that can't be read is an error as well."""
    if not required:
        return value
    bad = F.raise_error(F.concat(F.lit(f"required {what} field can't be read: "), _key(key)))
    return _required(F.when(value.isNull() & text(m, key).isNotNull(), bad).otherwise(value), m, required, key, what)


def to_boolean(m: Column, key, required: bool = False) -> Column:
    """Only the text ``true`` counts as true; any other value is false."""
    t = text(m, key)
    return _required(F.when(t.isNotNull(), t == "true"), m, required, key, "boolean")


def to_long(m: Column, key, required: bool = False) -> Column:
    """Numeric text parses, fractions truncate, unparsable text gives 0."""
    t = text(m, key)
    parsed = F.coalesce(t.try_cast("bigint"), t.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))
    return _required(F.when(t.isNotNull(), parsed), m, required, key, "long")


def to_double(m: Column, key, required: bool = False) -> Column:
    """Unparsable text gives 0.0."""
    t = text(m, key)
    parsed = F.coalesce(t.try_cast("double"), F.lit(0.0))
    return _required(F.when(t.isNotNull(), parsed), m, required, key, "double")


def to_string(m: Column, key, required: bool = False, exact_m: Column | None = None) -> Column:
    """Scalar text; numbers as written with ``exact_m``, the payload's ``exact`` map (nested
    objects and arrays are taken from ``m``)."""
    plain = text(m, key)
    value = plain if exact_m is None else F.when(plain.rlike(r"^\s*[\[{]"), plain).otherwise(number_text(m, key, exact_m))
    return _required(value, m, required, key, "string")


def to_bytes(m: Column, key, required: bool = False) -> Column:
    """base64 text (standard or URL-safe alphabet, padded or not) to binary; bad base64 gives NULL, and
    an error when ``required``."""
    return _checked(base64_bytes(text(m, key)), m, required, key, "bytes")


def base64_bytes(t: Column) -> Column:
    standard = F.rtrim(F.translate(t, "-_", "+/"), F.lit("="))
    padded = F.concat(standard, F.repeat(F.lit("="), F.pmod(-F.length(standard), F.lit(4))))
    return F.when(F.length(standard) % 4 != 1, F.try_to_binary(padded, F.lit("base64")))


_RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})?$"


def to_timestamp(m: Column, key, required: bool = False) -> Column:
    """RFC 3339 date-time, zone optional (UTC). A date alone, a number or a boolean is
    not a timestamp: NULL here, and an error when ``required``."""
    t = text(m, key)
    ok = t.rlike(_RFC3339)
    norm = F.regexp_replace(F.regexp_replace(t, "Z$", ""), r"(\.\d{6})\d+", "$1")
    val = F.when(ok, F.try_to_timestamp(norm))
    if required:
        val = F.when(t.isNull() | ~ok,
                     F.raise_error(F.concat(F.lit("not a timestamp: "), _key(key)))).otherwise(val)
    return val


def timestamp_nanos(m: Column, key) -> Column:
    """Nanosecond part of an RFC 3339 field (Spark timestamps stop at microseconds)."""
    frac = F.regexp_extract(text(m, key), r"\.(\d{1,9})", 1)
    return F.when(frac == "", F.lit(0)).otherwise(F.rpad(frac, 9, "0").cast("int"))


def to_date(m: Column, key, required: bool = False) -> Column:
    """``yyyy-MM-dd``. Impossible dates such as 02-30 give NULL, and an error when
    ``required`` (documented difference)."""
    t = text(m, key)
    ok = t.rlike(r"^\d{4}-\d{2}-\d{2}$")
    val = F.when(ok, F.try_to_date(t, "yyyy-MM-dd"))
    if required:
        val = F.when(val.isNull(), F.raise_error(F.concat(F.lit("not a date: "), _key(key)))).otherwise(val)
    return val


def to_numeric(m: Column, key, required: bool = False, exact_m: Column | None = None) -> Column:
    """decimal(38,9), rounded half up; numbers, numeric strings and exponent forms (with
    ``exact_m``, the payload's ``exact`` map, JSON numbers keep all their digits).
    A decimal holds 38 digits: wider values give NULL, and an error when ``required``; ``to_numeric_text`` has them."""
    t = number_text(m, key, exact_m)
    return _checked(t.try_cast("decimal(38,9)"), m, required, key, "numeric")


_NUMBER = r"^\s*([-+]?)([0-9]*)(?:\.([0-9]*))?(?:[eE]([-+]?[0-9]+))?\s*$"
#: Exponents beyond this give NULL: a few characters must not become a text of any length.
MOST_EXPONENT = 100_000
_SCALE = 9


def numeric_text(t: Column) -> Column:
    """A number's text, of any width, as plain text with nine digits after the point, rounded half up (away from zero); NULL for
    what is no number. Rounding works on the digits: the first ones that stay are counted up by one, nines at their end becoming zeros."""
    group = lambda i: F.regexp_extract(t, _NUMBER, i)
    read = F.struct(group(1).alias("sign"), group(2).alias("whole"), group(3).alias("part"),
                    F.when(group(4) == "", F.lit(0)).otherwise(group(4).try_cast("int")).alias("exp"))

    def shifted(r: Column) -> Column:
        digits, point = F.concat(r["whole"], r["part"]), F.length(r["whole"]) + r["exp"]
        whole = F.when(point > 0, F.rpad(F.substring(digits, F.lit(1), point), point, F.lit("0"))).otherwise("")
        # further than a place behind the last one that counts, zeros make no difference
        part = (F.when(point >= 0, F.substring(digits, point + 1, F.length(digits)))
                .otherwise(F.concat(F.repeat(F.lit("0"), F.least(-point, F.lit(_SCALE + 1))), digits)))
        ok = (F.length(digits) > 0) & (F.abs(r["exp"]) <= MOST_EXPONENT)
        return F.when(ok, F.struct(r["sign"].alias("sign"), whole.alias("whole"), part.alias("part")))

    def rounded(r: Column) -> Column:
        kept = F.concat(r["whole"], F.rpad(F.substring(r["part"], 1, _SCALE), _SCALE, "0"))
        up = F.substring(r["part"], _SCALE + 1, 1).isin(*"56789")
        return F.when(r.isNotNull(), F.struct(r["sign"].alias("sign"), kept.alias("kept"), F.when(up, F.rtrim(kept, F.lit("9"))).alias("head")))

    def counted(r: Column) -> Column:
        head, nines = r["head"], F.length(r["kept"]) - F.length(r["head"])
        last = F.substring(head, F.length(head), F.lit(1)).try_cast("int")
        up = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.coalesce(last, F.lit(0)) + 1, F.repeat(F.lit("0"), nines))
        return F.when(r.isNotNull(), F.struct(r["sign"].alias("sign"), F.when(head.isNull(), r["kept"]).otherwise(up).alias("digits")))

    def written(r: Column) -> Column:
        n = F.length(r["digits"]) - _SCALE
        whole = F.ltrim(F.substring(r["digits"], F.lit(1), n), F.lit("0"))
        text_ = F.concat(F.when(whole == "", F.lit("0")).otherwise(whole), F.lit("."), F.substring(r["digits"], n + 1, F.lit(_SCALE)))
        minus = (r["sign"] == "-") & (F.ltrim(r["digits"], F.lit("0")) != "")
        return F.concat(F.when(minus, F.lit("-")).otherwise(""), text_)

    wide = bind(bind(bind(bind(read, shifted), rounded), counted), written)
    return F.when(t.rlike(_NUMBER), wide)


def to_numeric_text(m: Column, key, required: bool = False, exact_m: Column | None = None) -> Column:
    """X8 for numbers of any width: the value of ``to_numeric`` as text, and what is too wide for a decimal as well. Digits are
    gone through only for the latter."""
    t = number_text(m, key, exact_m)
    value = bind(t, lambda s: F.coalesce(s.try_cast("decimal(38,9)").cast("string"), numeric_text(s)))
    return _checked(value, m, required, key, "numeric")


def to_json_text(m: Column, key, required: bool = False) -> Column:
    return _required(text(m, key), m, required, key, "json")


_DISPATCH = {}
for _n in BOOL_TYPES:
    _DISPATCH[_n] = to_boolean
for _n in INT_TYPES:
    _DISPATCH[_n] = to_long
for _n in FLOAT_TYPES:
    _DISPATCH[_n] = to_double
for _n in STRING_TYPES:
    _DISPATCH[_n] = to_string
for _n in NUMERIC_TYPES:
    _DISPATCH[_n] = to_numeric
for _n in JSON_TYPES:
    _DISPATCH[_n] = to_json_text
for _n in BYTES_TYPES:
    _DISPATCH[_n] = to_bytes
for _n in TIMESTAMP_TYPES:
    _DISPATCH[_n] = to_timestamp
for _n in DATE_TYPES:
    _DISPATCH[_n] = to_date


def extract(payload, key, stream_type: str, required: bool = False) -> Column:
    """Typed value of ``key`` by stream type name; unknown type names raise at plan time.
    ``payload`` is a parsed map Column or the name of a JSON text column."""
    fn = _DISPATCH.get(stream_type)
    if fn is None:
        raise ValueError(f"unsupported stream type: {stream_type}")
    if isinstance(payload, Column):
        return fn(payload, key, required)
    m = parse(payload)
    if fn in (to_numeric, to_string):
        return fn(m, key, required, exact(payload))
    return fn(m, key, required)


def row_image_text(keys_m: Column, new_m: Column, key) -> Column:
    """P5 lookup in the row image: new values override keys (presence-aware)."""
    return F.when(has(new_m, key), text(new_m, key)).otherwise(text(keys_m, key))


def row_image_has(keys_m: Column, new_m: Column, key) -> Column:
    return has(new_m, key) | has(keys_m, key)


def keys_first_text(keys_m: Column, new_m: Column, key) -> Column:
    """Lookup order used for DML values and column sharding: keys first, then new values."""
    return F.when(has(keys_m, key), text(keys_m, key)).otherwise(text(new_m, key))


def row_image(keys_m: Column, new_m: Column) -> Column:
    """P5: the whole row image as one map, new values overriding keys."""
    return F.map_concat(F.map_filter(keys_m, lambda k, _: ~F.map_contains_key(new_m, k)), new_m)


def row_payload(cols) -> Column:
    """A stored (typed) row as a payload JSON object, NULL values kept, so that rows
    read from a table feed the same extraction / shard functions as change payloads."""
    return F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols]), {"ignoreNullFields": "false"})
