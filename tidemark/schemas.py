"""Schemas, keys and fixed vocabularies of the commerce data model.

Every operator takes names and thresholds as parameters; the values below are
the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)
LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
FLAG, TIME, DAY = T.BooleanType(), T.TimestampType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


@dataclass(frozen=True)
class Entity:
    """One source table: its name, its key column and its typed columns."""

    name: str
    key: str
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# Entity names, keys, columns and types of the source model.
CUSTOMERS = Entity("customers", "customer_id", _struct(
    ("customer_id", LONG), ("first_name", TEXT), ("last_name", TEXT), ("email", TEXT), ("city", TEXT),
    ("state_code", TEXT), ("customer_status", TEXT), ("created_at", TIME), ("updated_at", TIME)))
PRODUCTS = Entity("products", "product_id", _struct(
    ("product_id", LONG), ("sku", TEXT), ("product_name", TEXT), ("category", TEXT), ("unit_price", MONEY),
    ("active", FLAG), ("created_at", TIME), ("updated_at", TIME)))
ORDERS = Entity("orders", "order_id", _struct(
    ("order_id", LONG), ("customer_id", LONG), ("order_status", TEXT), ("order_total", MONEY), ("currency", TEXT),
    ("ordered_at", TIME), ("updated_at", TIME)))
ORDER_ITEMS = Entity("order_items", "order_item_id", _struct(
    ("order_item_id", LONG), ("order_id", LONG), ("product_id", LONG), ("quantity", INT), ("unit_price", MONEY),
    ("line_total", MONEY)))
PAYMENTS = Entity("payments", "payment_id", _struct(
    ("payment_id", LONG), ("order_id", LONG), ("payment_status", TEXT), ("payment_method", TEXT), ("amount", MONEY),
    ("paid_at", TIME), ("created_at", TIME), ("updated_at", TIME)))
SHIPMENTS = Entity("shipments", "shipment_id", _struct(
    ("shipment_id", LONG), ("order_id", LONG), ("shipment_status", TEXT), ("carrier", TEXT), ("tracking_code", TEXT),
    ("shipped_at", TIME), ("delivered_at", TIME), ("created_at", TIME), ("updated_at", TIME)))

ENTITIES: dict[str, Entity] = {
    e.name: e for e in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS, SHIPMENTS)
}
TABLES: tuple[str, ...] = tuple(ENTITIES)

# Change operation codes (snapshot read, create, update, delete).
OPERATIONS = ("r", "c", "u", "d")

# Status vocabularies accepted by the data tests.
ACCEPTED_VALUES = {
    ("orders", "order_status"): ("created", "confirmed", "processing", "shipped", "delivered", "cancelled"),
    ("payments", "payment_status"): ("pending", "authorized", "captured", "refunded"),
    ("shipments", "shipment_status"): ("packed", "shipped", "delivered"),
}

# Status vocabularies accepted by the source tables themselves.
SOURCE_VALUES = {
    ("customers", "customer_status"): ("active", "inactive", "suspended"),
    ("orders", "order_status"): ("created", "confirmed", "processing", "shipped", "delivered", "cancelled"),
    ("payments", "payment_status"): ("pending", "authorized", "captured", "failed", "refunded"),
    ("payments", "payment_method"): ("credit_card", "debit_card", "digital_wallet", "bank_transfer"),
    ("shipments", "shipment_status"): ("pending", "packed", "shipped", "in_transit", "delivered", "returned"),
}

# Thresholds and limits.
CUSTOMER_SEGMENTS = (("high_value", 7500), ("medium_value", 3500), ("standard_value", None))
PRODUCT_SEGMENTS = (("top_performer", 30000), ("core_performer", 15000), ("lower_performer", None))
ALLOWED_LATENESS_SECONDS = 300
FRESHNESS_SLO_SECONDS = 86_400
MAX_BACKFILL_DAYS = 31
MONEY_TOLERANCE = "0.01"

# One record as the Kafka source delivers it.
RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", TEXT),
    T.StructField("partition", INT),
    T.StructField("offset", LONG),
    T.StructField("timestamp", TIME),
])

# The columns of a bronze (or quarantined) event.
BRONZE_SCHEMA = _struct(
    ("event_id", TEXT), ("ingestion_run_id", TEXT), ("ingested_at", TIME), ("event_date", DAY),
    ("event_timestamp", TIME), ("source_table", TEXT), ("operation", TEXT), ("source_timestamp_ms", LONG),
    ("connector_timestamp_ms", LONG), ("source_lsn", LONG), ("source_transaction_id", LONG), ("kafka_topic", TEXT),
    ("kafka_partition", INT), ("kafka_offset", LONG), ("kafka_timestamp", TIME), ("key_json", TEXT),
    ("before_json", TEXT), ("after_json", TEXT), ("payload_json", TEXT), ("value_json", TEXT), ("schema_name", TEXT),
    ("invalid_reason", TEXT))
BRONZE_COLUMNS: list[str] = BRONZE_SCHEMA.fieldNames()
RAW_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + [T.StructField("warehouse_loaded_at", TIME)])

# Metadata a bronze event must carry.
REQUIRED_METADATA = (
    "event_id", "kafka_topic", "kafka_partition", "kafka_offset", "source_table", "operation", "event_timestamp",
    "ingestion_run_id", "ingested_at")

# Lineage columns that staging keeps behind the entity columns.
LINEAGE_COLUMNS = (
    "event_timestamp", "source_timestamp_ms", "connector_timestamp_ms", "kafka_topic", "kafka_partition",
    "kafka_offset", "kafka_timestamp", "ingestion_run_id", "ingested_at", "warehouse_loaded_at")


# Lineage columns that dimensions and facts keep.
STAR_TAIL = ("current_event_id", "latest_operation", "source_event_at", "warehouse_loaded_at")

LOAD_AUDIT_SCHEMA = _struct(
    ("run_id", TEXT), ("pipeline_name", TEXT), ("status", TEXT), ("started_at", TIME), ("completed_at", TIME),
    ("source_record_count", LONG), ("inserted_record_count", LONG), ("existing_record_count", LONG),
    ("failed_record_count", LONG))

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", TEXT), T.StructField("event", TEXT), T.StructField("event_at", TIME),
    T.StructField("dag_id", TEXT), T.StructField("run_mode", TEXT), T.StructField("backfill_start_date", DAY),
    T.StructField("backfill_end_date", DAY), T.StructField("failed_task_id", TEXT),
    T.StructField("error_message", TEXT), T.StructField("details", T.MapType(TEXT, TEXT))])
