"""Configuration sources: session file (schema mapping), shard file, message-cluster
profile, catalog, and per-shard processing contexts (S4-S8).

These are small documents read once per job. They are read with Spark (``wholetext`` /
multi-line JSON) and flattened with ``explode`` into frames that operators broadcast
(after a size check) into the change stream.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed import model

_PK = "array<struct<ColId:string,Desc:boolean,Order:int>>"
_SP_TABLE = ("struct<Name:string,ColIds:array<string>,ShardIdColumn:string,"
             "ColDefs:map<string,struct<Name:string,T:struct<Name:string,Len:bigint,IsArray:boolean>,NotNull:boolean>>,"
             f"PrimaryKeys:{_PK}>")
_SRC_TABLE = ("struct<Name:string,ColIds:array<string>,"
              "ColDefs:map<string,struct<Name:string,Type:struct<Name:string,Mods:array<bigint>>,NotNull:boolean>>,"
              f"PrimaryKeys:{_PK}>")
SESSION_DOC = f"struct<SpSchema:map<string,{_SP_TABLE}>,SrcSchema:map<string,{_SRC_TABLE}>>"

SOURCE_TYPES = ("mysql", "postgresql")
BUFFER_TYPES = ("pubsub", "kafka")


def _session_frames(doc: DataFrame) -> tuple[DataFrame, DataFrame]:
    # a document that can't be read must not pass for one without tables: every change would be dropped
    parsed = F.from_json("value", SESSION_DOC, {"mode": "FAILFAST"})
    empty = F.coalesce(F.size(parsed["SpSchema"]), F.lit(0)) == 0
    s = doc.select(F.when(empty, F.raise_error(F.lit("session document has no stream tables"))).otherwise(parsed).alias("s"))
    sp = s.select(F.explode("s.SpSchema").alias("table_id", "t"))
    src = s.select(F.explode("s.SrcSchema").alias("table_id", "t"))

    sp_cols = sp.select(
        "table_id", F.explode("t.ColDefs").alias("col_id", "d"),
        F.col("t.PrimaryKeys").alias("pks")).select(
        "table_id", "col_id",
        F.col("d.Name").alias("sp_col"), F.col("d.T.Name").alias("sp_type"),
        F.coalesce(F.col("d.T.IsArray"), F.lit(False)).alias("sp_is_array"),
        F.try_element_at(F.filter("pks", lambda p: p.ColId == F.col("col_id")), F.lit(1))["Order"].alias("sp_pk_ord"))
    src_cols = src.select(
        "table_id", F.explode("t.ColDefs").alias("col_id", "d"),
        F.col("t.PrimaryKeys").alias("pks"), F.col("t.ColIds").alias("ids")).select(
        "table_id", "col_id",
        F.col("d.Name").alias("src_col"), F.lower(F.col("d.Type.Name")).alias("src_type"),
        F.try_element_at(F.filter("pks", lambda p: p.ColId == F.col("col_id")), F.lit(1))["Order"].alias("src_pk_ord"),
        F.array_position("ids", F.col("col_id")).cast("int").alias("src_col_pos"))
    column_map = sp_cols.join(src_cols, ["table_id", "col_id"], "full").select(
        *[c.split()[0] for c in model.COLUMN_MAP.split(", ")])

    shard_id = F.nullif(F.col("t.ShardIdColumn"), F.lit(""))
    base = (sp.select("table_id", F.col("t.Name").alias("sp_table"), shard_id.alias("shard_col_id"),
                      # the shard column id resolves to a name inside the same table document
                      F.when(shard_id.isNotNull(), F.try_element_at(F.col("t.ColDefs"), shard_id)["Name"])
                      .alias("shard_col"))
            .join(src.select("table_id", F.col("t.Name").alias("src_table"),
                             F.size(F.coalesce(F.col("t.PrimaryKeys"), F.array())).cast("int").alias("src_pk_count")),
                  "table_id", "left"))
    table_map = base.select(*[c.split()[0] for c in model.TABLE_MAP.split(", ")])
    return table_map, column_map


def read_session(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Session file -> (table_map, column_map). Tables are looked up by the stream-side
    name (derived from ``SpSchema[*].Name``); columns pair up by column id."""
    doc = spark.read.text(path, wholetext=True)
    return _session_frames(doc)


def session_from_dict(spark: SparkSession, session: dict) -> tuple[DataFrame, DataFrame]:
    """Same as ``read_session`` for a session document already in memory (tests, fixtures)."""
    doc = spark.createDataFrame([(json.dumps(session),)], "value string")
    return _session_frames(doc)


def cached_session(spark: SparkSession, session: dict) -> tuple[DataFrame, DataFrame]:
    """``session_from_dict`` with the two (tiny) mapping frames cached, so the size checks
    and broadcasts of several operators reuse one computation."""
    key = json.dumps(session, sort_keys=True)
    hit = _SESSION_CACHE.get(key)
    if hit is not None and hit[0].sparkSession is spark:
        return hit
    tm, cm = session_from_dict(spark, session)
    out = (tm.cache(), cm.cache())
    _SESSION_CACHE[key] = out
    return out


_SESSION_CACHE: dict = {}


def read_shards(spark: SparkSession, path: str, source_type: str = "mysql") -> DataFrame:
    """Shard file (JSON array), sorted by logical shard id. A malformed file fails the
    read; a source type other than mysql/postgresql is an error."""
    if source_type not in SOURCE_TYPES:
        raise ValueError(f"unsupported source type: {source_type}")
    df = (spark.read.option("multiLine", True).option("mode", "FAILFAST")
          .schema(model.SHARD).json(path))
    return df.orderBy("logicalShardId")


def read_cluster_profile(spark: SparkSession, path: str) -> DataFrame:
    """Message-cluster profile (one JSON object)."""
    return (spark.read.option("multiLine", True).option("mode", "FAILFAST")
            .schema(model.CLUSTER_PROFILE).json(path))


def catalog_from_frames(spark: SparkSession, tables: dict) -> DataFrame:
    """Catalog frame from DataFrames (or schemas) plus declared primary keys.

    ``tables`` maps table name -> (DataFrame | StructType, [pk columns] or [(pk, desc)]).
    Only schemas are read (no data).
    """
    from pyspark.sql.types import StructType
    rows = []
    for name, (df_or_schema, pks) in tables.items():
        schema = df_or_schema if isinstance(df_or_schema, StructType) else df_or_schema.schema
        pk_list = [(p, False) if isinstance(p, str) else tuple(p) for p in pks]
        pk_pos = {p: (i + 1, d) for i, (p, d) in enumerate(pk_list)}
        for i, f in enumerate(schema.fields):
            o, d = pk_pos.get(f.name, (None, None))
            rows.append((name, f.name, f.dataType.simpleString(), i + 1, o, d))
    return spark.createDataFrame(rows, model.CATALOG)


def read_catalog_jdbc(spark: SparkSession, url: str, properties: dict, schema_name: str) -> DataFrame:
    """S7 from a live database: columns, types and primary-key positions from
    ``information_schema`` (MySQL / PostgreSQL), read with Spark's JDBC source."""
    query = f"""(SELECT c.table_name, c.column_name, c.data_type AS stream_type,
                        c.ordinal_position AS ordinal, k.ordinal_position AS pk_ordinal
                 FROM information_schema.columns c
                 LEFT JOIN information_schema.key_column_usage k
                   ON k.table_schema = c.table_schema AND k.table_name = c.table_name
                  AND k.column_name = c.column_name AND k.constraint_name IN (
                      SELECT constraint_name FROM information_schema.table_constraints t
                      WHERE t.table_schema = c.table_schema AND t.table_name = c.table_name
                        AND t.constraint_type = 'PRIMARY KEY')
                 WHERE c.table_schema = '{schema_name}') AS cat"""
    df = spark.read.jdbc(url, query, properties=properties)
    return df.select("table_name", "column_name", "stream_type", F.col("ordinal").cast("int"),
                     F.col("pk_ordinal").cast("int"), F.lit(False).alias("pk_desc"))


def catalog_from_session(column_map: DataFrame, table_map: DataFrame) -> DataFrame:
    """S7 from a session: stream-side tables, columns, types and PK order."""
    return (column_map.where(F.col("sp_col").isNotNull())
            .join(table_map.select("table_id", F.col("sp_table").alias("table_name")), "table_id")
            .select("table_name", F.col("sp_col").alias("column_name"),
                    F.col("sp_type").alias("stream_type"),
                    F.lit(None).cast("int").alias("ordinal"),
                    F.col("sp_pk_ord").alias("pk_ordinal"), F.lit(False).alias("pk_desc")))


def processing_contexts(shards: DataFrame, profile: DataFrame | None, buffer_type: str = "pubsub") -> DataFrame:
    """One row per shard with its buffer settings. For Kafka the partition number is the
    shard's position in shard-id order; for Pub/Sub the subscription id is the shard id.

    The profile is a one-row configuration frame; it is checked to be one row and attached
    as literals (no cross join).
    """
    if buffer_type not in BUFFER_TYPES:
        raise ValueError(f"unsupported buffer type: {buffer_type}")
    out = shards.select("logicalShardId", "host", "port", "user", "dbName")
    if buffer_type == "kafka":
        if profile is None:
            raise ValueError("kafka buffer needs a cluster profile")
        rows = profile.limit(2).collect()
        if len(rows) != 1:
            raise ValueError("cluster profile must hold exactly one object")
        p = rows[0]
        from riverbed.operators.ordering import positions
        out = positions(out, ["logicalShardId"], position_col="partition_id", start=0, method="window")
        out = out.select("*", F.lit(p["bootstrapServer"]).alias("bootstrap_server"),
                         F.lit(p["dataTopic"]).alias("topic"))
    else:
        out = out.select("*", F.col("logicalShardId").alias("subscription_id"))
    return out.withColumn("buffer_type", F.lit(buffer_type))
