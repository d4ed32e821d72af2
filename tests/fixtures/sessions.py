"""Session documents for tests, put together from a short description of the tables.

The tables are a parcel depot's: ``stock`` (a two-column key, every kind of column, sharded by
region) and ``couriers`` (renamed on the source side)."""

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Column:
    stream: str | None      # name and type on the stream side, if it is there
    kind: str | None
    source: str | None      # name and type on the source side, if it is there
    type: str | None
    array: bool = False


@dataclass(frozen=True)
class Table:
    stream: str
    source: str
    columns: tuple[Column, ...]
    stream_key: tuple[str, ...]
    source_key: tuple[str, ...]
    shard: str | None = None
    ids: dict = field(default_factory=dict)


def session(*tables: Table) -> dict:
    doc = {"SpSchema": {}, "SrcSchema": {}}
    for n, t in enumerate(tables):
        cid = {c: f"k{n}_{i}" for i, c in enumerate(t.columns)}
        by_stream = {c.stream: cid[c] for c in t.columns if c.stream}
        by_source = {c.source: cid[c] for c in t.columns if c.source}
        doc["SpSchema"][f"tab{n}"] = {
            "Name": t.stream, "ColIds": list(by_stream.values()), "ShardIdColumn": by_stream.get(t.shard, ""),
            "ColDefs": {cid[c]: {"Name": c.stream, "T": {"Name": c.kind, "Len": 0, "IsArray": c.array}, "NotNull": False} for c in t.columns if c.stream},
            "PrimaryKeys": [{"ColId": by_stream[k], "Desc": False, "Order": i + 1} for i, k in enumerate(t.stream_key)]}
        doc["SrcSchema"][f"tab{n}"] = {
            "Name": t.source, "ColIds": list(by_source.values()),
            "ColDefs": {cid[c]: {"Name": c.source, "Type": {"Name": c.type, "Mods": None}, "NotNull": False} for c in t.columns if c.source},
            "PrimaryKeys": [{"ColId": by_source[k], "Desc": False, "Order": i + 1} for i, k in enumerate(t.source_key)]}
    return doc


STOCK = Table("stock", "depot_stock", (
    Column("depot", "STRING", "depot_code", "char"),
    Column("sku", "INT64", "sku", "bigint"),
    Column("qty", "INT64", "quantity", "int"),
    Column("weight", "NUMERIC", "weight_kg", "decimal"),
    Column("temp", "FLOAT64", "temp_c", "double"),
    Column("sealed", "BOOL", "sealed", "tinyint"),
    Column("labels", "STRING", "labels", "set", True),
    Column("digest", "STRING", "digest", "varbinary"),
    Column("photo", "BYTES", "photo", "mediumblob"),
    Column("counted", "TIMESTAMP", "counted_at", "datetime"),
    Column("due", "DATE", "due_on", "date"),
    Column("extra", "JSON", "extra", "json"),
    Column("region", "STRING", None, None),          # stream side only
    Column(None, None, "audited_by", "varchar"),     # source side only
), ("depot", "sku"), ("depot_code", "sku"), "region")

COURIERS = Table("couriers", "drivers", (
    Column("courier_no", "INT64", "driver_no", "int"),
    Column("nick", "STRING", "nickname", "varchar"),
), ("courier_no",), ("driver_no",))


def depot() -> dict:
    return session(STOCK, COURIERS)
