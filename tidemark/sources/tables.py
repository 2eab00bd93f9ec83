"""The star-schema Parquet tables seen as commerce entities, as a log of
changes to them, and as a stream of change records with known faults.

Everything is a projection of the given tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.keys import event_id
from tidemark.schemas import ENTITIES, Entity

# a prime, so that keys spread over every divisor
LINES_PER_ORDER = 99_991
TOPIC_PREFIX = "shop.public"
LOG_EPOCH_MS = 1_704_067_200_000
DAY_MS = 86_400_000
LOADED_AT = "2024-03-01 00:00:00"
# tables in the order user_id % 6 picks them
STREAM_TABLES = ("customers", "products", "orders", "order_items", "payments", "shipments")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame, name: str) -> DataFrame:
    """Rows of an entity dealt out by key: a given table may be one file, and what
    follows is heavy per row. Lines are dealt out already, by the window that
    numbers them."""
    return frame if name == "order_items" else frame.repartition(ENTITIES[name].key)


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(14,2)")


def _first_seen(key: str) -> Column:
    return F.expr(f"timestamp'1994-01-01 00:00:00' + make_dt_interval(cast({key} % 365 as int))")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    named = table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    first, last = F.split_part("c_name", F.lit("#"), F.lit(1)), F.split_part("c_name", F.lit("#"), F.lit(2))
    key = F.col("c_custkey")
    return named.select(
        key.alias("customer_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(F.lower(first), F.lit("."), last, F.lit("@example.test")).alias("email"),
        F.col("n_name").alias("city"),
        F.upper(F.substring("n_name", 1, 2)).alias("state_code"),
        F.when(key % 50 == 0, "suspended").when(key % 20 == 0, "inactive").otherwise("active").alias(
            "customer_status"),
        _first_seen("c_custkey").alias("created_at"),
        _first_seen("c_custkey").alias("updated_at"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("SKU-"), F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        _money("p_retailprice").alias("unit_price"),
        (F.col("p_partkey") % 25 != 0).alias("active"),
        _first_seen("p_partkey").alias("created_at"),
        _first_seen("p_partkey").alias("updated_at"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.element_at(
            F.array(*[F.lit(s) for s in ("created", "confirmed", "processing", "shipped", "delivered", "cancelled")]),
            (F.col("o_orderkey") % 6 + 1).cast("int"),
        ).alias("order_status"),
        _money("o_totalprice").alias("order_total"),
        F.lit("USD").alias("currency"),
        placed.alias("ordered_at"),
        placed.alias("updated_at"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines have no key of their own: not even order and line number are unique.
    Order and place within the order, by the whole line, make one. The unit price
    is the line price split by the quantity, worked out behind the shuffle."""
    line = F.concat_ws(
        "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int"),
        _money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)"),
        "l_returnflag", "l_linestatus", F.to_date("l_shipdate"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _money("l_extendedprice").alias("line_total"),
        F.unhex(F.md5(line)).alias("_line"),
    )
    place = F.row_number().over(Window.partitionBy("order_id").orderBy("_line"))
    placed = lines.withColumn("_place", place)
    cents = (F.col("line_total") * 100).cast("long")
    unit = F.floor(cents / F.col("quantity")).cast("long")
    return placed.select(
        F.when(F.col("_place") < LINES_PER_ORDER, F.col("order_id") * LINES_PER_ORDER + F.col("_place"))
        .otherwise(F.raise_error(F.lit("an order has too many lines"))).cast("long").alias("order_item_id"),
        "order_id",
        "product_id",
        "quantity",
        (unit.cast("decimal(16,0)") / 100).cast("decimal(14,2)").alias("unit_price"),
        "line_total",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, key = F.col("order_status"), F.col("order_id")
    paid = F.when(status == "created", "pending").when(status == "confirmed", "authorized").when(
        status == "cancelled", "refunded").otherwise("captured")
    return orders(spark, sf_dir).select(
        key.alias("payment_id"),
        "order_id",
        paid.alias("payment_status"),
        F.element_at(
            F.array(*[F.lit(m) for m in ("credit_card", "debit_card", "digital_wallet", "bank_transfer")]),
            (key % 4 + 1).cast("int"),
        ).alias("payment_method"),
        F.col("order_total").alias("amount"),
        F.when(paid.isin("captured", "refunded"), F.col("ordered_at") + F.expr("interval 2 minutes")).alias("paid_at"),
        F.col("ordered_at").alias("created_at"),
        F.col("ordered_at").alias("updated_at"),
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, key, at = F.col("order_status"), F.col("order_id"), F.col("ordered_at")
    shipped = F.when(status.isin("shipped", "delivered"), at + F.expr("interval 1 day"))
    delivered = F.when(status == "delivered", at + F.expr("interval 4 days"))
    return orders(spark, sf_dir).filter(status.isin("processing", "shipped", "delivered")).select(
        key.alias("shipment_id"),
        "order_id",
        F.when(status == "processing", "packed").otherwise(status).alias("shipment_status"),
        F.element_at(
            F.array(*[F.lit(c) for c in ("North Freight", "Blue Parcel", "City Courier")]), (key % 3 + 1).cast("int")
        ).alias("carrier"),
        F.concat(F.lit("TRK-"), F.lpad(key.cast("string"), 12, "0")).alias("tracking_code"),
        shipped.alias("shipped_at"),
        delivered.alias("delivered_at"),
        (at + F.expr("interval 4 hours")).alias("created_at"),
        F.coalesce(delivered, shipped, at).alias("updated_at"),
    )


BUILDERS = {
    "customers": customers, "products": products, "orders": orders, "order_items": order_items,
    "payments": payments, "shipments": shipments,
}


def entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}


def current(spark: SparkSession, sf_dir: str, name: str, deal: bool = True) -> DataFrame:
    """An entity as current state: every row as its snapshot read (version 0).
    Without ``deal`` rows stay where they are read, for work that is light or
    shuffles anyway."""
    key = ENTITIES[name].key
    stamp = _source_ms(F.col(key), F.lit(0))
    position = (F.lit(f"{TOPIC_PREFIX}.{name}"), (F.col(key) % 3).cast("int"), F.col(key) * 4)
    rows = BUILDERS[name](spark, sf_dir)
    return (spread(rows, name) if deal else rows).select(
        "*",
        event_id(*position).alias("current_event_id"),
        F.lit("r").alias("latest_operation"),
        F.timestamp_millis(stamp + 5).alias("source_event_at"),
        position[1].alias("kafka_partition"),
        position[2].alias("kafka_offset"),
        F.lit(LOADED_AT).cast("timestamp").alias("warehouse_loaded_at"),
    )


# What version 1 changes in a row; tables with `updated_at` move it as well.
CHANGES = {
    "customers": ("city", lambda: F.concat(F.col("city"), F.lit(" East"))),
    "products": ("active", lambda: ~F.col("active")),
    "orders": ("order_status", lambda: F.lit("delivered")),
    "order_items": ("quantity", lambda: F.col("quantity") + 1),
    "payments": ("payment_method", lambda: F.lit("bank_transfer")),
    "shipments": ("carrier", lambda: F.lit("Local Courier")),
}
VERSION_OPERATIONS = ("r", "u", "d", "c")
# Days by which an update (1) and a re-creation (3) move `updated_at`: far
# enough to fall among the order dates, so that as-of lookups meet them.
VERSION_DAYS = {1: 700, 3: 2000}


def _source_ms(key: Column, version: Column) -> Column:
    return F.lit(LOG_EPOCH_MS) + version.cast("long") * DAY_MS + key % DAY_MS


def versions(spark: SparkSession, sf_dir: str, name: str, last: int = 3) -> DataFrame:
    """Rows of the change log with their ``version``: 0 reads every key, 1
    updates every 10th, 2 deletes every 25th, 3 re-creates every 100th."""
    entity, key = ENTITIES[name], F.col(ENTITIES[name].key)
    happens = {0: F.lit(True), 1: key % 10 == 0, 2: key % 25 == 0, 3: key % 100 == 0}
    rows = spread(BUILDERS[name](spark, sf_dir), name).withColumn(
        "version",
        F.explode(F.array_remove(F.array(*[F.when(happens[v], v).otherwise(-1) for v in range(last + 1)]), -1)))
    column, changed = CHANGES[name]
    first = F.col("version") == 1
    moved = rows.withColumn(column, F.when(first, changed()).otherwise(F.col(column)))
    if "updated_at" in entity.columns:
        days = F.when(first, VERSION_DAYS[1]).when(F.col("version") == 3, VERSION_DAYS[3]).otherwise(0)
        moved = moved.withColumn("updated_at", F.col("updated_at") + F.make_dt_interval(days))
    return moved.withColumn("operation", F.element_at(
        F.array(*[F.lit(o) for o in VERSION_OPERATIONS]), F.col("version") + 1))


def _json_text(frame: DataFrame, name: str) -> Column:
    kind = dict(frame.dtypes)[name]
    if kind == "timestamp":
        return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(name)
    if kind.startswith("decimal"):
        return F.col(name).cast("string").alias(name)
    return F.col(name)


_KEEP_NULLS = {"ignoreNullFields": "false"}


def _envelope(operation: Column, before: Column, after: Column, source_ms: Column, connector_ms: Column, table_name,
              number: Column) -> Column:
    return F.struct(
        operation.alias("op"), connector_ms.alias("ts_ms"), before.alias("before"), after.alias("after"),
        F.struct(
            table_name.alias("table"), source_ms.alias("ts_ms"), (number * 8).alias("lsn"), number.alias("txId")
        ).alias("source"))


def change_records(spark: SparkSession, sf_dir: str, name: str, last: int = 3) -> DataFrame:
    """The change log of an entity as stream records. A delete carries only the
    key, in ``before``."""
    entity: Entity = ENTITIES[name]
    log = versions(spark, sf_dir, name, last)
    key, version, deleted = F.col(entity.key), F.col("version"), F.col("operation") == "d"
    source_ms = _source_ms(key, version)
    image = F.struct(*[_json_text(log, c) for c in entity.columns])
    envelope = _envelope(
        F.col("operation"),
        F.when(deleted, F.struct(key.alias(entity.key))),
        F.when(~deleted, image),
        source_ms, source_ms + 5, F.lit(name), key % 1_000_000 * 4 + version)
    return log.select(
        F.to_json(F.struct(key.alias(entity.key))).cast("binary").alias("key"),
        F.to_json(envelope, _KEEP_NULLS).cast("binary").alias("value"),
        F.lit(f"{TOPIC_PREFIX}.{name}").alias("topic"),
        (key % 3).cast("int").alias("partition"),
        (key * 4 + version).alias("offset"),
        F.timestamp_millis(source_ms + 1000).alias("timestamp"),
    )


def stream_records(spark: SparkSession, sf_dir: str, replays: bool = False) -> DataFrame:
    """The events table as change records with faults at known ids: every 97th
    has no value, every 101st is not JSON, every 103rd has an unknown operation
    and every 107th an unknown topic. With ``replays`` every 50th is delivered
    twice."""
    events = table(spark, sf_dir, "events")
    if replays:
        events = events.withColumn("_copy", F.explode(F.sequence(
            F.lit(0), F.when(F.col("event_id") % 50 == 0, 1).otherwise(0)))).drop("_copy")
    number, user = F.col("event_id"), F.col("user_id")
    pick = (user % 6 + 1).cast("int")
    source_table = F.element_at(F.array(*[F.lit(t) for t in STREAM_TABLES]), pick)
    key_name = F.element_at(F.array(*[F.lit(ENTITIES[t].key) for t in STREAM_TABLES]), pick)
    topic = F.concat(
        F.lit(f"{TOPIC_PREFIX}."), F.when(number % 107 == 0, "unknown").otherwise(source_table))
    operation = F.when(number % 103 == 0, "x").otherwise(F.element_at(
        F.create_map(*[F.lit(x) for pair in (
            ("view", "r"), ("signup", "c"), ("click", "u"), ("purchase", "u"), ("error", "d")) for x in pair]),
        F.col("event_type")))
    source_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    connector_ms = source_ms + number * 37 % 500
    key_only = F.create_map(key_name, user)
    deleted = operation == "d"
    envelope = _envelope(
        operation, F.when(deleted, key_only), F.when(~deleted, key_only), source_ms, connector_ms, source_table,
        number)
    wrapped = F.struct(F.struct(F.concat(topic, F.lit(".Envelope")).alias("name")).alias("schema"),
                       envelope.alias("payload"))
    value = (
        F.when(number % 97 == 0, F.lit(None).cast("string"))
        .when(number % 101 == 0, F.lit("not json"))
        .when(number % 2 == 0, F.to_json(wrapped, _KEEP_NULLS))
        .otherwise(F.to_json(envelope, _KEEP_NULLS)))
    return events.select(
        F.to_json(key_only).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        topic.alias("topic"),
        (user % 3).cast("int").alias("partition"),
        number.alias("offset"),
        F.timestamp_millis(connector_ms + 20).alias("timestamp"),
    )


def gapped_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as one topic of three partitions with consecutive offsets, of which four in every 89 events are
    lost and every 50th came twice."""
    number = F.col("event_id")
    copies = F.sequence(F.lit(0), F.when(number % 50 == 0, 1).otherwise(0))
    return table(spark, sf_dir, "events").filter(number % 89 >= 4).select(
        F.lit(f"{TOPIC_PREFIX}.events").alias("kafka_topic"), (number % 3).cast("int").alias("kafka_partition"),
        F.floor(number / 3).alias("kafka_offset"), F.explode(copies).alias("_copy")).drop("_copy")


def faulty_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as bare envelopes with one structural fault per id
    modulo 13; 0, 11 and 12 are sound."""
    events = table(spark, sf_dir, "events")
    number, fault = F.col("event_id"), F.col("event_id") % 13
    source_table = F.element_at(F.array(*[F.lit(t) for t in STREAM_TABLES]), (F.col("user_id") % 6 + 1).cast("int"))
    operation = F.when(F.col("event_type") == "error", "d").otherwise("u")
    image = F.struct(number.alias("id"))
    envelope = F.struct(
        F.when(fault == 5, "x").when(fault != 4, operation).alias("op"),
        F.when((operation == "d") & (fault != 8), image).alias("before"),
        F.when((operation != "d") & (fault != 8), image).alias("after"),
        F.when(fault != 9, F.struct(
            F.when(fault == 7, "suppliers").when(fault != 6, source_table).alias("table"))).alias("source"),
    )
    value = (
        F.when(fault == 1, "[1]")
        .when(fault == 2, '{"payload":null}')
        .when(fault == 3, '{"payload":"text","op":"u"}')
        .when(fault == 10, "null")
        .otherwise(F.to_json(envelope)))
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.concat(F.lit(f"{TOPIC_PREFIX}."), source_table).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        number.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a log of run events, one run per user: signups and
    views start a run, errors fail it, the rest succeed."""
    kind, number, at = F.col("event_type"), F.col("event_id"), F.col("ts").cast("timestamp")
    started = kind.isin("signup", "view")
    event = F.when(started, "start").when(kind == "error", "failed").otherwise("success")
    backfill = started & (number % 3 == 0)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
        event.alias("event"),
        at.alias("event_at"),
        F.when(started, "daily").alias("dag_id"),
        F.when(backfill, "backfill").when(started, "incremental").alias("run_mode"),
        F.when(backfill, F.to_date(at)).alias("backfill_start_date"),
        F.when(backfill, F.date_add(F.to_date(at), (number % 5).cast("int"))).alias("backfill_end_date"),
        F.when(kind == "error", F.concat(F.lit("task-"), number % 4)).alias("failed_task_id"),
        F.when(kind == "error", F.concat(F.lit("error "), number)).alias("error_message"),
        F.create_map(kind, number.cast("string")).alias("details"),
    )


def audited_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as folded runs, one per event: views still run, errors
    failed, the rest succeeded; every 41st has lost its end, every 43rd failure
    its task."""
    kind, number, at = F.col("event_type"), F.col("event_id"), F.col("ts").cast("timestamp")
    status = F.when(kind == "view", "running").when(kind == "error", "failed").otherwise("success")
    seconds = (number % 600 + 1).cast("int")
    ended = (kind != "view") & (number % 41 != 0)
    backfill = number % 3 == 0
    start = F.date_add(F.lit("2024-01-01").cast("date"), (number % 20).cast("int"))
    failed = kind == "error"
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), number).alias("run_id"),
        F.when(backfill, "backfill").otherwise("incremental").alias("run_mode"),
        F.when(backfill, start).alias("backfill_start_date"),
        F.when(backfill, F.date_add(start, (number % 4).cast("int"))).alias("backfill_end_date"),
        status.alias("status"),
        at.alias("started_at"),
        F.when(ended, at + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("completed_at"),
        F.when(ended, seconds.cast("decimal(12,3)")).alias("duration_seconds"),
        F.when(failed & (number % 43 != 0), F.concat(F.lit("task-"), number % 4)).alias("failed_task_id"),
        F.when(failed, F.concat(F.lit("error "), number)).alias("error_message"),
    )


def drifting_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer and order records as JSON, with schema faults at known keys:
    every 29th of an unknown table, every 23rd not an object, every 13th without
    key, every 17th with a text key, every 19th with a column missing, every
    11th with a column more."""
    def records(name: str, lost: str) -> DataFrame:
        entity = ENTITIES[name]
        rows, key = spread(BUILDERS[name](spark, sf_dir), name), F.col(entity.key)
        # to_json leaves out NULL fields, which is how a field goes missing
        fields = [
            F.when((key % 19 != 0) if c == lost else F.lit(True), _json_text(rows, c)).alias(c)
            for c in entity.columns if c != entity.key
        ]
        extra = F.when(key % 11 == 0, "gold").alias("loyalty_tier")
        plain = F.to_json(F.struct(F.when(key % 13 != 0, key).alias(entity.key), *fields, extra))
        texted = F.to_json(F.struct(F.when(key % 13 != 0, key.cast("string")).alias(entity.key), *fields, extra))
        return rows.select(
            F.when(key % 29 == 0, "suppliers").otherwise(name).alias("source_table"),
            key.alias("row_id"),
            F.when(key % 23 == 0, "[1]").when(key % 17 == 0, texted).otherwise(plain).alias("record_json"))

    return records("customers", "city").unionByName(records("orders", "currency"))
