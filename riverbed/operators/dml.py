"""Upsert / delete statements for MySQL and PostgreSQL.

``render_dml`` works on the whole change frame at once. A mapping of up to ``COMPILED_COLUMNS`` columns is read by the
driver (it is configuration) and becomes plain expressions, a branch per table with the types already told apart, so that
rows meet neither a join nor a lambda. A larger mapping is broadcast into the stream (J1) and each row's statement is built
with higher-order functions over the spec arrays; both forms give the same rows. Columns come out in source column order
(primary-key columns first, in PK order). Rows that cannot be replicated get a ``drop_reason`` and an empty statement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed.functions import pinned, pinned_apart
from riverbed.functions import values as V
from riverbed.functions.render import DIALECTS, NUMBER_TYPES, column_value, value_text
from riverbed.operators.mapping import collected_specs, map_tables, table_specs
from riverbed.operators.ordering import positions
from riverbed.operators.transforms import with_payloads

# Reasons a change yields no statement.
DROP_TABLE_NOT_MAPPED = "table not in session"
DROP_SOURCE_TABLE_MISSING = "source table missing"
DROP_SOURCE_NO_PK = "source table has no primary key"
DROP_UNSUPPORTED_MOD = "unsupported mod type"
DROP_PK_NOT_MAPPED = "primary key column has no stream column"
DROP_PK_ABSENT = "primary key value not in record"
DROP_NOT_DECODED = "value can't be decoded"

#: Mappings of more columns than this are not compiled: the size of a plan follows its expressions.
COMPILED_COLUMNS = 400


def _join(arr: Column, field: str, sep: str) -> Column:
    return F.array_join(F.transform(arr, lambda x: x[field]), sep)


def _upsert(table: Column, pkv: Column, cols: Column, dialect: str, if_absent: bool) -> Column:
    pk_names = _join(pkv, "col", ",")
    pk_vals = _join(pkv, "val", ",")
    only_pk = F.concat(F.lit("INSERT IGNORE INTO " if if_absent and dialect == "mysql" else "INSERT INTO "), table, F.lit("("), pk_names, F.lit(") VALUES ("), pk_vals,
                       F.lit(") ") if dialect == "mysql" else F.lit(") ON CONFLICT DO NOTHING" if if_absent else ")"))
    head = F.concat(F.lit("INSERT INTO "), table, F.lit("("), pk_names, F.lit(","), _join(cols, "col", ","),
                    F.lit(") VALUES ("), pk_vals, F.lit(","), _join(cols, "val", ","), F.lit(") "))
    if dialect == "mysql":
        sets = F.array_join(F.transform(cols, lambda x: F.concat(F.lit(" "), x["col"], F.lit(" = "), x["val"])), ",")
        full = F.concat(head, F.lit("ON DUPLICATE KEY UPDATE "), sets)
    else:
        sets = F.array_join(F.transform(cols, lambda x: F.concat(F.lit(" "), x["col"], F.lit(" = EXCLUDED."),
                                                                  x["col"])), ",")
        full = F.concat(head, F.lit("ON CONFLICT("), _join(pkv, "col", ", "), F.lit(") DO UPDATE SET"), sets)
    return F.when(F.size(cols) == 0, only_pk).otherwise(full)


def _delete(table: Column, pkv: Column, dialect: str) -> Column:
    if dialect == "mysql":
        preds = F.transform(pkv, lambda x: F.concat(F.lit(" "), x["col"], F.lit(" = "), x["val"]))
    else:
        preds = F.transform(pkv, lambda x: F.concat(x["col"], F.lit(" = "), x["val"]))
    return F.concat(F.lit("DELETE FROM "), table, F.lit(" WHERE "), F.array_join(preds, " AND "))


def render_dml(changes: DataFrame, table_map: DataFrame, column_map: DataFrame, dialect: str = "mysql",
               tz_offset: str | Column = "+00:00", escape_backslash: bool = False,
               specs: DataFrame | None = None, insert_if_absent: bool = False,
               compiled_columns: int = COMPILED_COLUMNS) -> DataFrame:
    """F12-F16 + P9: add ``dml`` (statement text, '' when dropped), ``drop_reason`` and
    ``pk_text`` (the rendered primary-key values joined by commas, e.g. for shadow keys).

    INSERT and UPDATE both render as upserts; DELETE renders a delete by primary key.
    ``insert_if_absent``: a row that has nothing but its key is inserted only if it isn't there, so that
    the statement can be executed twice. ``tz_offset`` is the source database offset (a string, or a per-row Column such as a
    shard's offset)."""
    if dialect not in DIALECTS:
        raise ValueError(f"unsupported dialect: {dialect}")
    tz = tz_offset if isinstance(tz_offset, Column) else F.lit(tz_offset)
    specs = specs if specs is not None else table_specs(table_map, column_map)
    tables = collected_specs(specs, compiled_columns)
    if tables is not None:
        return _render_compiled(changes, tables, dialect, tz, escape_backslash, insert_if_absent)
    d = with_payloads(map_tables(changes, specs))
    d = d.withColumn("_kn", pinned(F.map_keys("_k"))).withColumn("_nn", pinned(F.map_keys("_n")))
    k, n, kn, nn = F.col("_k"), F.col("_n"), F.col("_kn"), F.col("_nn")
    # numbers as written, parsed only for tables that have a column for them
    numbers = F.exists(F.concat("pk_specs_types", "col_specs_types"), lambda t: t.isin(*NUMBER_TYPES))
    d = (d.withColumn("pk_specs_types", F.transform("pk_specs", lambda c: c["sp_type"])).withColumn("col_specs_types", F.transform("col_specs", lambda c: c["sp_type"]))
         .withColumn("_kx", pinned(F.when(numbers, V.exact("keys_json")))).withColumn("_nx", pinned(F.when(numbers, V.exact("new_values_json")))))
    kj, nj = F.col("_kx"), F.col("_nx")
    pkv = F.transform("pk_specs", lambda c: column_value(c, k, n, tz, dialect, escape_backslash, kn, nn, kj, nj))
    cols = F.filter(F.transform("col_specs",
                                lambda c: column_value(c, k, n, tz, dialect, escape_backslash, kn, nn, kj, nj)),
                    lambda x: x["found"])
    d = d.withColumn("_pkv", pinned(pkv)).withColumn("_cols", pinned(cols))
    mod = F.col("mod_type")
    reason = (F.when(F.col("table_id").isNull(), F.lit(DROP_TABLE_NOT_MAPPED))
              .when(F.col("src_table").isNull(), F.lit(DROP_SOURCE_TABLE_MISSING))
              .when(F.coalesce(F.col("src_pk_count"), F.lit(0)) == 0, F.lit(DROP_SOURCE_NO_PK))
              .when(~mod.isin("INSERT", "UPDATE", "DELETE") | mod.isNull(), F.lit(DROP_UNSUPPORTED_MOD))
              .when(F.exists("pk_specs", lambda c: c["sp_col"].isNull()), F.lit(DROP_PK_NOT_MAPPED))
              .when(F.exists("_pkv", lambda x: ~x["found"]), F.lit(DROP_PK_ABSENT))
              .when(F.exists("_pkv", lambda x: x["val"].isNull()) | ((mod != "DELETE") & F.exists("_cols", lambda x: x["val"].isNull())), F.lit(DROP_NOT_DECODED)))
    table = F.col("src_table")
    keep = [c for c in changes.columns if c not in ("_k", "_n")]
    d = d.withColumn("_reason", pinned(reason))
    stmt = (F.when(F.col("_reason").isNotNull(), F.lit(""))
            .when(mod == "DELETE", _delete(table, F.col("_pkv"), dialect))
            .otherwise(_upsert(table, F.col("_pkv"), F.col("_cols"), dialect, insert_if_absent)))
    pk_text = F.when(F.col("_reason").isNull(), _join(F.col("_pkv"), "val", ","))
    return d.select(*keep, F.col("src_table"), pinned(stmt).alias("dml"), F.col("_reason").alias("drop_reason"),
                    pk_text.alias("pk_text"))


def _by_table(tables: list, expr) -> Column:
    """``expr(table)`` of the row's table: ``_t`` is its place in ``tables``; NULL for a row without one, and where
    ``expr`` gives None."""
    out = F.when(F.lit(False), F.lit(None))
    for i, t in enumerate(tables):
        e = expr(t)
        if e is not None:
            out = out.when(F.col("_t") == i, e)
    return out


def _compiled_statement(t, dialect: str, if_absent: bool) -> Column:
    """The statement of a row of table ``t`` from its values' texts ``_v`` (keys first). Columns that are not in the record
    are NULL there, and ``concat`` and ``concat_ws`` leave them out."""
    keys = [c["src_col"] for c in t["pk_specs"]]
    cols = [c["src_col"] for c in t["col_specs"]]
    v = [F.get("_v", F.lit(j)) for j in range(len(keys) + len(cols))]
    key_vals, col_vals = F.concat_ws(",", *v[:len(keys)]), v[len(keys):]
    table, key_names = t["src_table"], ",".join(keys)
    equal = " {} = " if dialect == "mysql" else "{} = "
    delete = F.concat(F.lit(f"DELETE FROM {table} WHERE "), F.concat_ws(" AND ", *[F.concat(F.lit(equal.format(k)), x) for k, x in zip(keys, v)]))
    if dialect == "mysql":
        verb, end = ("INSERT IGNORE INTO " if if_absent else "INSERT INTO "), ") "
    else:
        verb, end = "INSERT INTO ", (") ON CONFLICT DO NOTHING" if if_absent else ")")
    only_key = F.concat(F.lit(f"{verb}{table}({key_names}) VALUES ("), key_vals, F.lit(end))
    if not cols:
        return F.when(F.col("mod_type") == "DELETE", delete).otherwise(only_key)
    names = F.concat_ws(",", *[F.when(x.isNotNull(), F.lit(c)) for c, x in zip(cols, col_vals)])
    if dialect == "mysql":
        sets = F.concat_ws(",", *[F.concat(F.lit(f" {c} = "), x) for c, x in zip(cols, col_vals)])
        tail = F.concat(F.lit(") ON DUPLICATE KEY UPDATE "), sets)
    else:
        sets = F.concat_ws(",", *[F.when(x.isNotNull(), F.lit(f" {c} = EXCLUDED.{c}")) for c, x in zip(cols, col_vals)])
        tail = F.concat(F.lit(f") ON CONFLICT({', '.join(keys)}) DO UPDATE SET"), sets)
    full = F.concat(F.lit(f"INSERT INTO {table}({key_names},"), names, F.lit(") VALUES ("), key_vals, F.lit(","), F.concat_ws(",", *col_vals), tail)
    none = F.coalesce(*col_vals).isNull()
    return F.when(F.col("mod_type") == "DELETE", delete).when(none, only_key).otherwise(full)


def _render_compiled(changes: DataFrame, tables: list, dialect: str, tz: Column, escape_backslash: bool, if_absent: bool) -> DataFrame:
    """``render_dml`` with the mapping's rows ``tables`` as plain expressions. The steps (raw texts, values, statement) are
    arrays that are pinned, so that each value is made once whatever reads it."""
    specs = lambda t: [*t["pk_specs"], *t["col_specs"]]
    numeric = [i for i, t in enumerate(tables) if any(c["sp_type"] in NUMBER_TYPES for c in specs(t))]
    place = F.when(F.lit(False), F.lit(None).cast("int"))
    for i, t in enumerate(tables):
        place = place.when(F.col("table_name") == t["sp_table"], F.lit(i))
    d = with_payloads(changes.withColumn("_t", pinned(place)))
    d = d.withColumns({"_kn": pinned(F.map_keys("_k")), "_nn": pinned(F.map_keys("_n"))})
    if numeric:
        # numbers as written, parsed only for tables that have a column for them
        d = d.withColumns({f"_{x}x": pinned(F.when(F.col("_t").isin(*numeric), V.exact(j))) for x, j in (("k", "keys_json"), ("n", "new_values_json"))})

    def held(names: str, c) -> Column:
        return F.coalesce(F.array_contains(names, c["sp_col"]), F.lit(False))

    def found(c) -> Column:
        return F.lit(False) if c["sp_col"] is None else held("_kn", c) | held("_nn", c)

    def raw(c) -> Column:
        if c["sp_col"] is None:
            return F.lit(None).cast("string")
        k, n = ("_kx", "_nx") if c["sp_type"] in NUMBER_TYPES else ("_k", "_n")
        return F.when(held("_kn", c), V.text(F.col(k), c["sp_col"])).otherwise(V.text(F.col(n), c["sp_col"]))

    def value(j: int, c) -> Column:
        r = F.get("_r", F.lit(j))
        return F.when(F.get("_f", F.lit(j)), F.when(r.isNull(), F.lit("NULL")).otherwise(
            value_text(r, c["sp_type"], c["sp_is_array"], c["src_type"], tz, dialect, escape_backslash)))

    d = d.withColumns({"_f": pinned_apart(_by_table(tables, lambda t: F.array(*map(found, specs(t))) if specs(t) else None).cast("array<boolean>")),
                       "_r": pinned_apart(_by_table(tables, lambda t: F.array(*map(raw, specs(t))) if specs(t) else None).cast("array<string>"))})
    d = d.withColumn("_v", pinned_apart(_by_table(tables, lambda t: F.array(*[value(j, c) for j, c in enumerate(specs(t))]) if specs(t) else None).cast("array<string>")))

    def whole(t):
        if t["src_table"] is None:
            return F.lit(DROP_SOURCE_TABLE_MISSING)
        return None if t["src_pk_count"] else F.lit(DROP_SOURCE_NO_PK)

    def undecoded(t, places) -> Column:
        bad = F.lit(False)
        for j in places:
            bad = bad | (F.get("_f", F.lit(j)) & F.get("_v", F.lit(j)).isNull())
        return bad

    def record(t):
        p = len(t["pk_specs"])
        if any(c["sp_col"] is None for c in t["pk_specs"]):
            return F.lit(DROP_PK_NOT_MAPPED)
        absent = F.lit(False)
        for j in range(p):
            absent = absent | ~F.get("_f", F.lit(j))
        bad = undecoded(t, range(p)) | ((F.col("mod_type") != "DELETE") & undecoded(t, range(p, len(specs(t)))))
        return F.when(absent, F.lit(DROP_PK_ABSENT)).when(bad, F.lit(DROP_NOT_DECODED))

    mod = F.col("mod_type")
    reason = F.coalesce(F.when(F.col("_t").isNull(), F.lit(DROP_TABLE_NOT_MAPPED)), _by_table(tables, whole),
                        F.when(~mod.isin("INSERT", "UPDATE", "DELETE") | mod.isNull(), F.lit(DROP_UNSUPPORTED_MOD)), _by_table(tables, record))
    d = d.withColumn("_reason", pinned_apart(reason.cast("string")))
    stmt = F.when(F.col("_reason").isNotNull(), F.lit("")).otherwise(
        _by_table(tables, lambda t: _compiled_statement(t, dialect, if_absent) if t["src_table"] is not None and t["pk_specs"] else None))
    keys = _by_table(tables, lambda t: F.concat_ws(",", *[F.get("_v", F.lit(j)) for j in range(len(t["pk_specs"]))]) if t["pk_specs"] else None)
    keep = [c for c in changes.columns if c not in ("_k", "_n")]
    return d.select(*keep, _by_table(tables, lambda t: None if t["src_table"] is None else F.lit(t["src_table"])).cast("string").alias("src_table"),
                    pinned_apart(stmt.cast("string")).alias("dml"), F.col("_reason").alias("drop_reason"),
                    F.when(F.col("_reason").isNull(), keys).cast("string").alias("pk_text"))


def replicable(rendered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P9 split: (rows with a statement, dropped rows with their reason)."""
    return (rendered.where(F.col("drop_reason").isNull()),
            rendered.where(F.col("drop_reason").isNotNull()))


def statement_batches(rendered: DataFrame, order_cols, shard_col: str = "shard",
                      batch_size: int = 1000) -> DataFrame:
    """Ordered statement batches per shard, empty statements left out.

    Positions come from the skew-safe ``positions`` (a hot shard is split over many tasks);
    batches hold at most ``batch_size`` statements, so no group grows with the data."""
    stmts = rendered.where(F.col("dml") != "").select(shard_col, *order_cols, "dml")
    pos = positions(stmts, order_cols, [shard_col], materialize_input=True)
    pos = pos.withColumn("batch_no", F.floor((F.col("position") - 1) / F.lit(batch_size)))
    return (pos.groupBy(shard_col, "batch_no")
            .agg(F.array_sort(F.collect_list(F.struct("position", "dml"))).alias("_s"))
            .select(shard_col, "batch_no",
                    F.try_element_at(F.col("_s"), F.lit(1))["position"].alias("first_position"),
                    F.size("_s").cast("bigint").alias("n_statements"),
                    F.transform("_s", lambda x: x["dml"]).alias("statements")))


def connection_urls(shards: DataFrame, source_type: str = "mysql", tls: bool = False,
                    ca_path: str = "") -> DataFrame:
    """JDBC URL per shard; passwords are not carried into the output."""
    host = F.concat(F.col("host"), F.lit(":"), F.col("port"), F.lit("/"), F.col("dbName"))
    if source_type == "mysql":
        url = F.concat(F.lit("jdbc:mysql://"), host, F.lit("?rewriteBatchedStatements=true"))
        if tls:
            url = F.concat(url, F.lit("&useSSL=true&requireSSL=true&verifyServerCertificate=true"))
    elif source_type == "postgresql":
        url = F.concat(F.lit("jdbc:postgresql://"), host)
        if tls:
            url = F.concat(url, F.lit("?ssl=true&sslmode=verify-ca"),
                           F.lit(f"&sslrootcert={ca_path}") if ca_path else F.lit(""))
    else:
        raise ValueError(f"unsupported source type: {source_type}")
    return shards.select("logicalShardId", F.col("user").alias("user"), url.alias("jdbc_url"))
