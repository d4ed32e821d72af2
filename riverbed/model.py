"""Canonical schemas (DDL strings) of the change data model.

A change record is one commit's changes to one table and carries many mods; after
``explode_mods`` every row is one change. Commit time is kept as (seconds, nanos) because
Spark timestamps stop at microseconds; ``commit_ts`` is for watermarks and windows only.
"""

MOD = "struct<keys_json:string,old_values_json:string,new_values_json:string>"

CHANGE_RECORD = (
    "partition_token string, commit_ts timestamp, commit_seconds bigint, commit_nanos int, "
    "server_txn_id string, is_last_in_txn boolean, record_sequence string, table_name string, "
    f"mods array<{MOD}>, mod_type string, value_capture_type string, "
    "num_records_in_txn bigint, num_partitions_in_txn bigint, txn_tag string, is_system_txn boolean"
)

# Envelope fields kept on every exploded change (the trimmed record).
ENVELOPE = ["commit_ts", "commit_seconds", "commit_nanos", "server_txn_id", "record_sequence",
            "table_name", "mod_type", "num_records_in_txn", "txn_tag"]

CHANGE = (
    "commit_ts timestamp, commit_seconds bigint, commit_nanos int, server_txn_id string, "
    "record_sequence string, table_name string, keys_json string, old_values_json string, "
    "new_values_json string, mod_type string, num_records_in_txn bigint, txn_tag string"
)

# Total order of changes inside a shard: commit time, then server txn id, then record sequence,
# then the change's place among its record's mods (frames from ``explode_mods`` carry it).
ORDER_COLUMNS = ["commit_seconds", "commit_nanos", "server_txn_id", "record_sequence"]
MOD_POSITION = "mod_position"


def order_columns(df) -> list[str]:
    """The order columns that ``df`` has: the record order, and the place inside the record."""
    return ORDER_COLUMNS + ([MOD_POSITION] if MOD_POSITION in df.columns else [])


# Buffer message as published by the stream-to-buffer job (camelCase JSON).
BUFFER_MESSAGE = (
    "commitTimestamp struct<seconds:bigint,nanos:int>, serverTransactionId string, "
    "recordSequence string, tableName string, "
    "mods array<struct<keysJson:string,oldValuesJson:string,newValuesJson:string>>, "
    "modType string, numberOfRecordsInTransaction bigint, transactionTag string"
)

SHARD = "logicalShardId string, host string, port string, user string, password string, dbName string"

CLUSTER_PROFILE = "bootstrapServer string, dataTopic string, errorTopic string"

TABLE_MAP = ("table_id string, sp_table string, src_table string, shard_col_id string, "
             "shard_col string, src_pk_count int")

COLUMN_MAP = ("table_id string, col_id string, sp_col string, sp_type string, sp_is_array boolean, "
              "sp_pk_ord int, src_col string, src_type string, src_pk_ord int, src_col_pos int")

CATALOG = "table_name string, column_name string, stream_type string, ordinal int, pk_ordinal int, pk_desc boolean"

DEAD_LETTER = "stage string, error string, record string, failed_at timestamp"

MOD_TYPES = ("INSERT", "UPDATE", "DELETE")
