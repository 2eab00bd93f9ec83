"""The same results as plain SQL over the given tables, for another engine.

Each statement states the expected outcome from the source columns and the
known faults; none of it goes through JSON, history tables or streams. Money is
added up in whole cents.
"""

from __future__ import annotations

from tidemark.catalog.queries import BACKFILL, FIRST_LOAD_UNTIL, LOOKED_UP, SNAPSHOTS
from tidemark.schemas import ACCEPTED_VALUES, ENTITIES, PRODUCT_SEGMENTS, CUSTOMER_SEGMENTS, TABLES
from tidemark.sources.tables import DAY_MS, LOADED_AT, LOG_EPOCH_MS, STREAM_TABLES, TOPIC_PREFIX, VERSION_DAYS

TIME = "'%Y-%m-%d %H:%M:%S.%g'"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _text(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, {TIME}) AS {alias or column.split('.')[-1]}"


def _double(expression: str, alias: str | None = None) -> str:
    return f"CAST({expression} AS DOUBLE) AS {alias or expression.split('.')[-1]}"


def _cents(expression: str) -> str:
    return f"CAST(({expression}) * 100 AS BIGINT)"


def _mean(cents: str, count: str) -> str:
    """Mean of non-negative cents, half up, as a double."""
    return f"CAST((2 * CAST({cents} AS HUGEINT) + {count}) // (2 * {count}) AS DOUBLE) / 100"


# ---- entities ---------------------------------------------------------------

CTES: dict[str, str] = {}
CTES["customers"] = """
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         lower(split_part(c_name, '#', 1)) || '.' || split_part(c_name, '#', 2) || '@example.test' AS email,
         n_name AS city, upper(substr(n_name, 1, 2)) AS state_code,
         CASE WHEN c_custkey % 50 = 0 THEN 'suspended' WHEN c_custkey % 20 = 0 THEN 'inactive' ELSE 'active' END
           AS customer_status,
         TIMESTAMP '1994-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at,
         TIMESTAMP '1994-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS updated_at
  FROM customer JOIN nation ON n_nationkey = c_nationkey"""
CTES["products"] = """
  SELECT p_partkey AS product_id, 'SKU-' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS sku, p_name AS product_name,
         p_type AS category, CAST(p_retailprice AS DECIMAL(14,2)) AS unit_price, p_partkey % 25 <> 0 AS active,
         TIMESTAMP '1994-01-01' + to_days(CAST(p_partkey % 365 AS INTEGER)) AS created_at,
         TIMESTAMP '1994-01-01' + to_days(CAST(p_partkey % 365 AS INTEGER)) AS updated_at
  FROM part"""
CTES["shop_orders"] = """
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         ['created', 'confirmed', 'processing', 'shipped', 'delivered', 'cancelled'][o_orderkey % 6 + 1]
           AS order_status,
         CAST(o_totalprice AS DECIMAL(14,2)) AS order_total, 'USD' AS currency, o_orderdate AS ordered_at,
         o_orderdate AS updated_at
  FROM orders"""
CTES["order_items"] = """
  SELECT l_orderkey * 99991 + row_number() OVER (PARTITION BY l_orderkey ORDER BY md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CAST(l_quantity AS INTEGER), CAST(l_extendedprice AS DECIMAL(14,2)), CAST(l_discount AS DECIMAL(4,2)),
           CAST(l_tax AS DECIMAL(4,2)), l_returnflag, l_linestatus, CAST(l_shipdate AS DATE)))) AS order_item_id,
         l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST((CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 100 AS BIGINT) // CAST(l_quantity AS INTEGER))
           * 0.01 AS DECIMAL(14,2)) AS unit_price,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS line_total
  FROM lineitem"""
CTES["payments"] = """
  SELECT order_id AS payment_id, order_id,
         CASE order_status WHEN 'created' THEN 'pending' WHEN 'confirmed' THEN 'authorized'
           WHEN 'cancelled' THEN 'refunded' ELSE 'captured' END AS payment_status,
         ['credit_card', 'debit_card', 'digital_wallet', 'bank_transfer'][order_id % 4 + 1] AS payment_method,
         order_total AS amount,
         CASE WHEN order_status NOT IN ('created', 'confirmed') THEN ordered_at + INTERVAL 2 MINUTE END AS paid_at,
         ordered_at AS created_at, ordered_at AS updated_at
  FROM shop_orders"""
CTES["shipments"] = """
  SELECT order_id AS shipment_id, order_id,
         CASE order_status WHEN 'processing' THEN 'packed' ELSE order_status END AS shipment_status,
         ['North Freight', 'Blue Parcel', 'City Courier'][order_id % 3 + 1] AS carrier,
         'TRK-' || lpad(CAST(order_id AS VARCHAR), 12, '0') AS tracking_code,
         CASE WHEN order_status IN ('shipped', 'delivered') THEN ordered_at + INTERVAL 1 DAY END AS shipped_at,
         CASE WHEN order_status = 'delivered' THEN ordered_at + INTERVAL 4 DAY END AS delivered_at,
         ordered_at + INTERVAL 4 HOUR AS created_at,
         ordered_at + CASE order_status WHEN 'delivered' THEN INTERVAL 4 DAY WHEN 'shipped' THEN INTERVAL 1 DAY
           ELSE INTERVAL 0 DAY END AS updated_at
  FROM shop_orders WHERE order_status IN ('processing', 'shipped', 'delivered')"""
NEEDS = {"payments": ["shop_orders"], "shipments": ["shop_orders"]}

# Columns of every entity in comparable form.
SHAPES = {
    "customers": ["customer_id", "first_name", "last_name", "email", "city", "state_code", "customer_status",
                  _text("created_at"), _text("updated_at")],
    "products": ["product_id", "sku", "product_name", "category", _double("unit_price"), "active",
                 _text("created_at"), _text("updated_at")],
    "orders": ["order_id", "customer_id", "order_status", _double("order_total"), "currency", _text("ordered_at"),
               _text("updated_at")],
    "order_items": ["order_item_id", "order_id", "product_id", "CAST(quantity AS BIGINT) AS quantity",
                    _double("unit_price"), _double("line_total")],
    "payments": ["payment_id", "order_id", "payment_status", "payment_method", _double("amount"), _text("paid_at"),
                 _text("created_at"), _text("updated_at")],
    "shipments": ["shipment_id", "order_id", "shipment_status", "carrier", "tracking_code", _text("shipped_at"),
                  _text("delivered_at"), _text("created_at"), _text("updated_at")],
}
ENTITY_CTE = {name: "shop_orders" if name == "orders" else name for name in TABLES}


def _event_id(topic: str, partition: str, offset: str) -> str:
    return f"sha256({topic} || ':' || ({partition}) || ':' || ({offset}))"


# ---- change logs ------------------------------------------------------------

CHANGED = {
    "customers": "city || ' East' AS city", "products": "NOT active AS active",
    "orders": "'delivered' AS order_status", "order_items": "quantity + 1 AS quantity",
    "payments": "'bank_transfer' AS payment_method", "shipments": "'Local Courier' AS carrier",
}
for _name, _entity in ENTITIES.items():
    _key, _from = _entity.key, ENTITY_CTE[_name]
    _moves = "updated_at" in _entity.columns

    def _moved(version: int, change: str | None) -> str:
        parts = [change] if change else []
        if _moves:
            parts.append(f"updated_at + INTERVAL {VERSION_DAYS[version]} DAY AS updated_at")
        return f"* REPLACE ({', '.join(parts)})" if parts else "*"

    CTES[f"{_name}_log"] = f"""
  SELECT *, {_event_id(f"'{TOPIC_PREFIX}.{_name}'", f"{_key} % 3", f"{_key} * 4 + version")} AS event_id,
         {LOG_EPOCH_MS} + version * {DAY_MS} + {_key} % {DAY_MS} AS source_timestamp_ms,
         CAST({_key} % 3 AS BIGINT) AS kafka_partition, {_key} * 4 + version AS kafka_offset,
         ['r', 'u', 'd', 'c'][version + 1] AS operation
  FROM (SELECT *, 0 AS version FROM {_from}
        UNION ALL SELECT {_moved(1, CHANGED[_name])}, 1 FROM {_from} WHERE {_key} % 10 = 0
        UNION ALL SELECT *, 2 FROM {_from} WHERE {_key} % 25 = 0
        UNION ALL SELECT {_moved(3, None)}, 3 FROM {_from} WHERE {_key} % 100 = 0)"""
    NEEDS[f"{_name}_log"] = [_from]
    CTES[f"{_name}_now"] = f"""
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_key} ORDER BY source_timestamp_ms DESC) AS newest
                 FROM {_name}_log) WHERE newest = 1 AND operation <> 'd'"""
    NEEDS[f"{_name}_now"] = [f"{_name}_log"]

# ---- event stream -----------------------------------------------------------

KEYS = [ENTITIES[t].key for t in STREAM_TABLES]
CTES["stream"] = f"""
  SELECT event_id AS n, user_id AS u, event_type, {_list(STREAM_TABLES)}[u % 6 + 1] AS entity,
         {_list(KEYS)}[u % 6 + 1] AS key_name,
         CASE WHEN n % 107 = 0 THEN 'unknown' ELSE entity END AS source_table,
         '{TOPIC_PREFIX}.' || source_table AS kafka_topic, CAST(u % 3 AS BIGINT) AS kafka_partition,
         epoch_us(ts) // 1000 AS sent_ms, sent_ms + n * 37 % 500 AS connector_ms,
         n % 97 <> 0 AND n % 101 <> 0 AS readable,
         CASE WHEN n % 103 = 0 THEN 'x' ELSE CASE event_type WHEN 'view' THEN 'r' WHEN 'signup' THEN 'c'
           WHEN 'error' THEN 'd' ELSE 'u' END END AS op,
         '{{"' || key_name || '":' || u || '}}' AS image
  FROM events"""
CTES["bronze"] = f"""
  SELECT *, {_event_id('kafka_topic', 'kafka_partition', 'n')} AS event_id,
         CASE WHEN readable THEN op END AS operation, CASE WHEN readable THEN sent_ms END AS source_timestamp_ms,
         CASE WHEN readable THEN connector_ms END AS connector_timestamp_ms,
         CASE WHEN readable THEN connector_ms ELSE connector_ms + 20 END AS event_ms,
         strftime(make_timestamp(event_ms * 1000), '%Y-%m-%d') AS event_date,
         CASE WHEN n % 97 = 0 THEN 'null_kafka_value' WHEN n % 101 = 0 THEN 'missing_or_invalid_operation'
           WHEN n % 103 = 0 THEN 'unsupported_operation' WHEN n % 107 = 0 THEN 'unexpected_source_table' END
           AS invalid_reason
  FROM stream"""
NEEDS["bronze"] = ["stream"]
CTES["valid"] = "SELECT * FROM bronze WHERE invalid_reason IS NULL"
NEEDS["valid"] = ["bronze"]
CTES["replayed"] = "SELECT * FROM valid UNION ALL SELECT * FROM valid WHERE n % 50 = 0"
NEEDS["replayed"] = ["valid"]
CTES["first_load"] = f"SELECT * FROM valid WHERE event_date < '{FIRST_LOAD_UNTIL}'"
NEEDS["first_load"] = ["valid"]
CTES["timed"] = """
  SELECT *, (connector_ms + 20 + n % 7 * 1000) AS ingested_ms, ingested_ms + n % 5 * 2000 AS loaded_ms FROM valid"""
NEEDS["timed"] = ["valid"]
CTES["late"] = """
  SELECT *, source_timestamp_ms - CASE WHEN n % 53 = 0 THEN 7200000 WHEN n % 11 = 0 THEN 240000 ELSE 0 END AS t
  FROM valid"""
NEEDS["late"] = ["valid"]

# ---- customer history -------------------------------------------------------

_DEL, _UPD, _RET = "customer_id % 25 = 0", "customer_id % 10 = 0", "customer_id % 100 = 0"
_S2 = f"TIMESTAMP '{SNAPSHOTS[2]}'"
_NEVER = "CAST(NULL AS TIMESTAMP)"
CTES["history"] = f"""
  SELECT * EXCLUDE (version), version AS seen_version FROM (
    SELECT *, updated_at AS valid_from,
           CASE WHEN {_UPD} THEN updated_at + INTERVAL {VERSION_DAYS[1]} DAY WHEN {_DEL} THEN {_S2} END AS valid_to,
           FALSE AS is_deleted
    FROM customers_log WHERE version = 0
    UNION ALL
    SELECT *, updated_at, CASE WHEN {_DEL} THEN {_S2} END, FALSE FROM customers_log WHERE version = 1
    UNION ALL
    SELECT o.*, {_S2},
           CASE WHEN {_RET.replace('customer_id', 'o.customer_id')} THEN greatest(r.updated_at, {_S2}) END, TRUE
    FROM customers_log o LEFT JOIN customers_log r ON r.customer_id = o.customer_id AND r.version = 3
    WHERE o.customer_id % 25 = 0 AND o.version = CASE WHEN o.customer_id % 10 = 0 THEN 1 ELSE 0 END
    UNION ALL
    SELECT *, greatest(updated_at, {_S2}), {_NEVER}, FALSE FROM customers_log WHERE version = 3)"""
NEEDS["history"] = ["customers_log"]
# every customer as after the first snapshot
CTES["first_history"] = f"""
  SELECT *, updated_at AS valid_from, {_NEVER} AS valid_to, FALSE AS is_deleted FROM customers_log WHERE version = 0"""
NEEDS["first_history"] = ["customers_log"]


def _dim(source: str) -> str:
    return f"""
  SELECT *, md5(CAST(customer_id AS VARCHAR) || '|' || CAST(valid_from AS VARCHAR) || '+00') AS customer_key,
         first_name || ' ' || last_name AS full_name, valid_to IS NULL AND NOT is_deleted AS is_current
  FROM {source}"""


CTES["dim"] = _dim("history")
NEEDS["dim"] = ["history"]
CTES["first_dim"] = _dim("first_history")
NEEDS["first_dim"] = ["first_history"]


def _first(name: str) -> str:
    """Entity rows as first read, with their lineage."""
    return f"(SELECT * FROM {name}_log WHERE version = 0)"


def _asof(orders: str, dim: str) -> str:
    return f"""
  SELECT o.*, c.customer_key, order_status = 'cancelled' AS is_cancelled, order_status = 'delivered' AS is_delivered,
         CAST(ordered_at AS DATE) AS order_date
  FROM {orders} o LEFT JOIN {dim} c ON c.customer_id = o.customer_id AND NOT c.is_deleted
   AND o.ordered_at >= c.valid_from AND (c.valid_to IS NULL OR o.ordered_at < c.valid_to)"""


CTES["fact"] = _asof(_first("orders"), "first_dim")
NEEDS["fact"] = ["orders_log", "first_dim"]
CTES["fact_changed"] = _asof("orders_now", "first_dim")
NEEDS["fact_changed"] = ["orders_now", "first_dim"]
CTES["fact_last"] = _asof("orders_now", "first_dim")
NEEDS["fact_last"] = ["orders_now", "first_dim"]
for _ship, _shipments in (("ship", "shipments"), ("ship_now", "shipments_now")):
    CTES[_ship] = f"""
  SELECT *, (epoch_us(shipped_at) - epoch_us(created_at)) // 36000000 AS ship_h,
         (epoch_us(delivered_at) - epoch_us(created_at)) // 36000000 AS deliver_h
  FROM {_shipments}"""
    NEEDS[_ship] = [_shipments]


def _daily(orders: str, name: str, payments: str = "payments", ship: str = "ship") -> None:
    """The daily mart of a fact; hours are whole, so their hundredths are exact."""
    CTES[name] = f"""
  SELECT CAST(o.order_date AS VARCHAR) AS order_date, order_count, non_cancelled_order_count, cancelled_order_count,
         delivered_order_count, gross_order_value, non_cancelled_order_value, average_order_value,
         coalesce(payment_count, 0) AS payment_count, coalesce(captured_payment_count, 0) AS captured_payment_count,
         coalesce(refunded_payment_count, 0) AS refunded_payment_count,
         coalesce(total_payment_value, 0) AS total_payment_value,
         coalesce(captured_payment_value, 0) AS captured_payment_value,
         coalesce(refunded_payment_value, 0) AS refunded_payment_value,
         coalesce(shipment_count, 0) AS shipment_count, coalesce(packed_shipment_count, 0) AS packed_shipment_count,
         coalesce(shipped_shipment_count, 0) AS shipped_shipment_count,
         coalesce(delivered_shipment_count, 0) AS delivered_shipment_count, average_hours_to_ship,
         average_hours_to_deliver
  FROM (SELECT order_date, count(*) AS order_count, count(*) FILTER (NOT is_cancelled) AS non_cancelled_order_count,
               count(*) FILTER (is_cancelled) AS cancelled_order_count,
               count(*) FILTER (is_delivered) AS delivered_order_count,
               CAST(sum(order_total) AS DOUBLE) AS gross_order_value,
               CAST(sum(order_total) FILTER (NOT is_cancelled) AS DOUBLE) AS non_cancelled_order_value,
               {_mean('sum(' + _cents('order_total') + ')', 'count(*)')} AS average_order_value
        FROM {orders} GROUP BY order_date) o
  LEFT JOIN (SELECT order_date, count(*) AS payment_count,
                    count(*) FILTER (payment_status = 'captured') AS captured_payment_count,
                    count(*) FILTER (payment_status = 'refunded') AS refunded_payment_count,
                    CAST(sum(amount) AS DOUBLE) AS total_payment_value,
                    CAST(sum(amount) FILTER (payment_status = 'captured') AS DOUBLE) AS captured_payment_value,
                    CAST(sum(amount) FILTER (payment_status = 'refunded') AS DOUBLE) AS refunded_payment_value
             FROM {payments} p JOIN {orders} f ON f.order_id = p.order_id GROUP BY order_date) p
    ON p.order_date = o.order_date
  LEFT JOIN (SELECT order_date, count(*) AS shipment_count,
                    count(*) FILTER (shipment_status = 'packed') AS packed_shipment_count,
                    count(*) FILTER (shipment_status = 'shipped') AS shipped_shipment_count,
                    count(*) FILTER (shipment_status = 'delivered') AS delivered_shipment_count,
                    {_mean('sum(ship_h)', 'nullif(count(ship_h), 0)')} AS average_hours_to_ship,
                    {_mean('sum(deliver_h)', 'nullif(count(deliver_h), 0)')} AS average_hours_to_deliver
             FROM {ship} s JOIN {orders} f ON f.order_id = s.order_id GROUP BY order_date) s
    ON s.order_date = o.order_date"""
    NEEDS[name] = [orders, payments, ship]


_daily("fact", "daily")
_daily("fact_changed", "daily_changed")
_daily("fact_last", "daily_now", "payments_now", "ship_now")


def _segment(value: str, bands) -> str:
    cases = " ".join(f"WHEN {value} >= {floor} THEN '{name}'" for name, floor in bands if floor is not None)
    return f"CASE {cases} ELSE '{bands[-1][0]}' END"


def _customer_value(dim: str, fact: str) -> str:
    return f"""
  SELECT customer_key, c.customer_id, full_name, email, city, state_code, customer_status,
         coalesce(n, 0) AS lifetime_order_count, coalesce(kept, 0) AS non_cancelled_order_count,
         coalesce(cancelled, 0) AS cancelled_order_count, coalesce(delivered, 0) AS delivered_order_count,
         coalesce(total, 0) AS lifetime_order_value, coalesce(mean, 0) AS average_order_value,
         {_text('first_at', 'first_order_at')}, {_text('last_at', 'most_recent_order_at')},
         {_segment('coalesce(total, 0)', CUSTOMER_SEGMENTS)} AS customer_value_segment
  FROM {dim} c LEFT JOIN (
    SELECT customer_id, count(*) AS n, count(*) FILTER (NOT is_cancelled) AS kept,
           count(*) FILTER (is_cancelled) AS cancelled, count(*) FILTER (is_delivered) AS delivered,
           CAST(sum(order_total) AS DOUBLE) AS total,
           {_mean('sum(' + _cents('order_total') + ')', 'count(*)')} AS mean,
           min(ordered_at) AS first_at, max(ordered_at) AS last_at
    FROM {fact} GROUP BY customer_id) m ON m.customer_id = c.customer_id
  WHERE c.is_current"""


CTES["customer_value"] = _customer_value("first_dim", "fact")
NEEDS["customer_value"] = ["first_dim", "fact"]
CTES["fact_now"] = _asof("orders_now", "dim")
NEEDS["fact_now"] = ["orders_now", "dim"]


def _product_value(products: str, items: str) -> str:
    return f"""
  SELECT md5(CAST(p.product_id AS VARCHAR)) AS product_key, p.product_id, sku, product_name, category,
         {_double('p.unit_price', 'current_unit_price')}, active AS is_active,
         coalesce(order_count, 0) AS order_count, coalesce(order_line_count, 0) AS order_line_count,
         coalesce(units_sold, 0) AS units_sold, coalesce(revenue, 0) AS gross_product_revenue,
         coalesce(price, 0) AS average_selling_price,
         {_segment('coalesce(revenue, 0)', PRODUCT_SEGMENTS)} AS product_performance_segment
  FROM {products} p LEFT JOIN (
    SELECT product_id, count(DISTINCT order_id) AS order_count, count(*) AS order_line_count,
           CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(line_total) AS DOUBLE) AS revenue,
           {_mean('sum(' + _cents('unit_price') + ')', 'count(*)')} AS price
    FROM {items} GROUP BY product_id) m ON m.product_id = p.product_id"""


CTES["product_value"] = _product_value("products", "order_items")
NEEDS["product_value"] = ["products", "order_items"]

# ---- run audit --------------------------------------------------------------

CTES["runs"] = """
  SELECT 'run-' || event_id AS run_id, event_id AS n, CASE WHEN n % 3 = 0 THEN 'backfill' ELSE 'incremental' END AS run_mode,
         CASE WHEN n % 3 = 0 THEN DATE '2024-01-01' + CAST(n % 20 AS INTEGER) END AS backfill_start_date,
         CASE WHEN n % 3 = 0 THEN DATE '2024-01-01' + CAST(n % 20 + n % 4 AS INTEGER) END AS backfill_end_date,
         CASE event_type WHEN 'view' THEN 'running' WHEN 'error' THEN 'failed' ELSE 'success' END AS status,
         ts AS started_at, event_type <> 'view' AND n % 41 <> 0 AS ended,
         CASE WHEN ended THEN n % 600 + 1 END AS seconds,
         CASE WHEN status = 'failed' AND n % 43 <> 0 THEN 'task-' || (n % 4) END AS failed_task_id
  FROM events"""
CTES["recovered"] = """
  SELECT f.run_id, f.backfill_start_date, f.backfill_end_date, f.started_at AS failed_at, s.last_success_at
  FROM runs f JOIN (
    SELECT backfill_start_date, backfill_end_date, max(started_at) AS last_success_at
    FROM runs WHERE run_mode = 'backfill' AND status = 'success' GROUP BY ALL) s
   ON s.backfill_start_date = f.backfill_start_date AND s.backfill_end_date = f.backfill_end_date
  WHERE f.run_mode = 'backfill' AND f.status = 'failed' AND s.last_success_at > f.started_at"""
NEEDS["recovered"] = ["runs"]


def sql(body: str, *needs: str) -> str:
    """``body`` behind the CTEs it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in NEEDS.get(name, []):
            visit(other)
        ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered) + "\n" + body


EXPECTED: dict[str, str] = {}

# ---- events -----------------------------------------------------------------

EXPECTED["event_ids"] = sql(
    "SELECT kafka_topic, kafka_partition, n AS kafka_offset, event_id, source_table, event_ms, event_date FROM bronze",
    "bronze")
_ENVELOPE = (
    """'{"op":"' || op || '","ts_ms":' || connector_ms || ',"before":' || CASE WHEN op = 'd' THEN image ELSE 'null' END"""
    """ || ',"after":' || CASE WHEN op <> 'd' THEN image ELSE 'null' END || ',"source":{"table":"' || entity"""
    """ || '","ts_ms":' || sent_ms || ',"lsn":' || (n * 8) || ',"txId":' || n || '}}'""")
EXPECTED["event_validity"] = sql(f"""
  SELECT event_id, source_table, operation, source_timestamp_ms, connector_timestamp_ms,
         CASE WHEN readable THEN n * 8 END AS source_lsn, CASE WHEN readable THEN n END AS source_transaction_id,
         image AS key_json, CASE WHEN readable AND op = 'd' THEN image END AS before_json,
         CASE WHEN readable AND op <> 'd' THEN image END AS after_json,
         CASE WHEN n % 97 = 0 THEN NULL WHEN n % 101 = 0 THEN 'not json' ELSE {_ENVELOPE} END AS payload_json,
         CASE WHEN readable AND n % 2 = 0 THEN kafka_topic || '.Envelope' END AS schema_name, invalid_reason
  FROM bronze""", "bronze")
EXPECTED["quarantine_counts"] = sql(
    "SELECT invalid_reason, count(*) AS row_count FROM bronze WHERE invalid_reason IS NOT NULL GROUP BY 1", "bronze")
EXPECTED["strict_validity"] = f"""
  WITH e AS (SELECT event_id AS n, event_id % 13 AS fault, CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op,
                    {_list(STREAM_TABLES)}[user_id % 6 + 1] AS entity FROM events),
  r AS (SELECT *, CASE fault WHEN 1 THEN 'payload_not_object' WHEN 2 THEN 'missing_payload'
                 WHEN 3 THEN 'missing_payload' WHEN 4 THEN 'missing_operation' WHEN 5 THEN 'unsupported_operation'
                 WHEN 6 THEN 'missing_source_table' WHEN 7 THEN 'unexpected_source_table'
                 WHEN 8 THEN CASE op WHEN 'd' THEN 'missing_before_record' ELSE 'missing_after_record' END
                 WHEN 9 THEN 'missing_source_table' WHEN 10 THEN 'payload_not_object' END AS reason FROM e)
  SELECT n AS kafka_offset, reason IS NULL AS valid, reason AS strict_reason,
         CASE WHEN fault IN (1, 2, 3, 4, 10) THEN NULL WHEN fault = 5 THEN 'x' ELSE op END AS strict_operation,
         CASE WHEN fault IN (1, 2, 3, 6, 9, 10) THEN NULL WHEN fault = 7 THEN 'suppliers' ELSE entity END
           AS strict_table,
         CASE WHEN fault IN (1, 2, 4, 10) THEN 'missing_or_invalid_operation'
           WHEN fault = 5 THEN 'unsupported_operation' END AS lenient_reason
  FROM r"""
EXPECTED["record_keys"] = sql(
    'SELECT kafka_offset AS "offset", customer_id AS record_key FROM customers_log', "customers_log")
EXPECTED["topic_summary"] = sql(f"""
  SELECT coalesce(t.topic, s.topic) AS topic, coalesce(records, 0) AS records, coalesce(partitions, 0) AS partitions,
         t.topic IS NOT NULL AS expected, s.topic IS NULL AS missing
  FROM (SELECT '{TOPIC_PREFIX}.' || unnest({_list(TABLES)}) AS topic) t
  FULL JOIN (SELECT kafka_topic AS topic, count(*) AS records, count(DISTINCT kafka_partition) AS partitions
             FROM stream GROUP BY 1) s ON s.topic = t.topic""", "stream")
for _name, _entity in ENTITIES.items():
    _kept = []
    for _shape, _column in zip(SHAPES[_name], _entity.columns):
        _value = _shape.rsplit(" AS ", 1)[0]
        # a delete carries the key alone
        _kept.append(f"{_value} AS {_column}" if _column == _entity.key
                     else f"CASE WHEN operation <> 'd' THEN {_value} END AS {_column}")
    EXPECTED[f"typed_{_name}"] = sql(f"""
  SELECT event_id, operation, operation = 'd' AS is_deleted, {', '.join(_kept)}, '' AS cast_failed,
         source_timestamp_ms, kafka_partition, kafka_offset FROM {_name}_log""", f"{_name}_log")
    EXPECTED[f"current_{_name}"] = sql(f"""
  SELECT {', '.join(SHAPES[_name])}, event_id AS current_event_id, operation AS latest_operation,
         strftime(make_timestamp((source_timestamp_ms + 5) * 1000), {TIME}) AS source_event_at, kafka_partition,
         kafka_offset, '{LOADED_AT}.000' AS warehouse_loaded_at FROM {_name}_now""", f"{_name}_now")

# ---- dedup and load ---------------------------------------------------------

EXPECTED["dedup_events"] = sql(
    "SELECT event_id, kafka_topic, kafka_partition, n AS kafka_offset, operation FROM valid", "valid")
EXPECTED["stream_dedup"] = sql("SELECT event_id, source_table, operation, n AS kafka_offset FROM valid", "valid")
EXPECTED["duplicate_summary"] = sql("""
  SELECT count(*) AS row_count, count(DISTINCT event_id) AS distinct_count,
         count(*) - count(DISTINCT event_id) AS duplicate_count FROM replayed""", "replayed")
EXPECTED["incremental_new_events"] = sql("""
  SELECT event_id, source_table, event_date, n AS kafka_offset FROM valid
  WHERE event_id NOT IN (SELECT event_id FROM first_load)""", "first_load")
EXPECTED["load_verification"] = sql("""
  SELECT (SELECT count(*) FROM replayed) AS source_record_count,
         (SELECT count(*) - count(DISTINCT event_id) FROM replayed) AS source_duplicate_event_ids,
         (SELECT count(*) FROM first_load) AS target_record_count,
         (SELECT count(*) - count(DISTINCT event_id) FROM first_load) AS target_duplicate_event_ids,
         (SELECT count(*) FROM valid WHERE event_id NOT IN (SELECT event_id FROM first_load)) AS missing_target_records
""", "replayed", "first_load")

# ---- history, dimensions, facts ---------------------------------------------

_TAIL = f"""event_id AS current_event_id, operation AS latest_operation,
         strftime(make_timestamp((source_timestamp_ms + 5) * 1000), {TIME}) AS source_event_at,
         '{LOADED_AT}.000' AS warehouse_loaded_at"""
_VALIDITY = f"{_text('valid_from')}, {_text('valid_to')}, is_deleted"
EXPECTED["scd2_history"] = sql(f"""
  SELECT {', '.join(SHAPES['customers'])}, {_TAIL},
         md5(CAST(customer_id AS VARCHAR) || '|' || CAST(valid_from AS VARCHAR) || '+00'
           || CASE WHEN is_deleted THEN '|deleted' ELSE '' END) AS scd_id, {_VALIDITY} FROM history""", "history")
EXPECTED["dim_customers"] = sql(f"""
  SELECT customer_key, {', '.join(SHAPES['customers'])}, full_name, {_VALIDITY}, is_current, {_TAIL} FROM dim""",
  "dim")
_OVERLAPS = """
  SELECT customer_id, valid_from, valid_to, next_valid_from FROM (
    SELECT *, lead(valid_from) OVER (PARTITION BY customer_id
                                     ORDER BY valid_from, coalesce(valid_to, TIMESTAMP '9999-12-31')) AS next_valid_from
    FROM {history}) WHERE next_valid_from IS NOT NULL AND (valid_to IS NULL OR valid_to > next_valid_from)"""
EXPECTED["scd_checks"] = sql(f"""
  SELECT count(*) AS snapshot_versions, count(DISTINCT customer_id) AS snapshot_customers,
         count(*) FILTER (valid_to IS NULL) AS current_snapshot_versions,
         count(*) FILTER (valid_to IS NOT NULL) AS historical_snapshot_versions,
         count(*) FILTER (is_deleted) AS deleted_snapshot_versions,
         (SELECT count(*) FROM ({_OVERLAPS.format(history='history')})) AS overlaps,
         (SELECT count(*) FROM (SELECT customer_id FROM history GROUP BY 1
                                HAVING count(*) FILTER (valid_to IS NULL) <> 1)) AS keys_without_one_open_version
  FROM history""", "history")
_LATE = """(SELECT * REPLACE (CASE WHEN customer_id % 3 = 0 THEN valid_to + INTERVAL 2 DAY ELSE valid_to END AS valid_to)
            FROM history)"""
EXPECTED["scd_overlaps"] = sql(f"""
  SELECT customer_id, {_text('valid_from')}, {_text('valid_to')}, {_text('next_valid_from')}
  FROM ({_OVERLAPS.format(history=_LATE)})""", "history")
EXPECTED["scd_open_versions"] = sql("""
  SELECT customer_id, count(*) FILTER (valid_to IS NULL AND customer_id % 4 <> 0) AS latest_version_count
  FROM history GROUP BY 1 HAVING count(*) FILTER (valid_to IS NULL AND customer_id % 4 <> 0) <> 1""", "history")
EXPECTED["dim_products"] = sql(f"""
  SELECT md5(CAST(product_id AS VARCHAR)) AS product_key, product_id, sku, product_name, category,
         {_double('unit_price')}, active AS is_active, {_text('created_at')}, {_text('updated_at')}, {_TAIL}
  FROM products_log WHERE version = 0""", "products_log")
EXPECTED["fact_orders_asof"] = sql(f"""
  SELECT md5(CAST(order_id AS VARCHAR)) AS order_key, customer_key, order_id, o.customer_id, order_status,
         {_double('order_total')}, currency, {_text('ordered_at')}, CAST(order_date AS VARCHAR) AS order_date,
         CAST(CAST(date_trunc('month', order_date) AS DATE) AS VARCHAR) AS order_month, is_cancelled, is_delivered,
         {_TAIL}
  FROM ({_asof(_first('orders'), 'dim')}) o""", "orders_log", "dim")
EXPECTED["fact_order_items"] = sql(f"""
  SELECT md5(CAST(order_item_id AS VARCHAR)) AS order_item_key, md5(CAST(order_id AS VARCHAR)) AS order_key,
         md5(CAST(p.product_id AS VARCHAR)) AS product_key, order_item_id, order_id, i.product_id,
         CAST(quantity AS BIGINT) AS quantity, {_double('i.unit_price', 'unit_price')}, {_double('line_total')}, {_TAIL}
  FROM {_first('order_items')} i LEFT JOIN products p ON p.product_id = i.product_id""", "order_items_log", "products")
EXPECTED["fact_payments"] = sql(f"""
  SELECT md5(CAST(payment_id AS VARCHAR)) AS payment_key, md5(CAST(order_id AS VARCHAR)) AS order_key,
         {', '.join(SHAPES['payments'])}, payment_status = 'authorized' AS is_authorized,
         payment_status = 'captured' AS is_captured, payment_status = 'refunded' AS is_refunded,
         payment_status = 'pending' AS is_pending, {_TAIL} FROM payments_log WHERE version = 0""", "payments_log")
EXPECTED["fact_shipments"] = sql(f"""
  SELECT md5(CAST(shipment_id AS VARCHAR)) AS shipment_key, md5(CAST(order_id AS VARCHAR)) AS order_key,
         {', '.join(SHAPES['shipments'])}, shipment_status = 'packed' AS is_packed,
         shipment_status = 'shipped' AS is_shipped, shipment_status = 'delivered' AS is_delivered,
         CAST((epoch_us(shipped_at) - epoch_us(created_at)) // 36000000 AS DOUBLE) / 100 AS hours_to_ship,
         CAST((epoch_us(delivered_at) - epoch_us(created_at)) // 36000000 AS DOUBLE) / 100 AS hours_to_deliver,
         {_TAIL} FROM shipments_log WHERE version = 0""", "shipments_log")

# ---- marts ------------------------------------------------------------------

_WINDOW = f"order_date BETWEEN '{BACKFILL[0]}' AND '{BACKFILL[1]}'"
EXPECTED["mart_daily"] = sql("SELECT * FROM daily", "daily")
EXPECTED["mart_daily_scope"] = sql(f"SELECT * FROM daily WHERE {_WINDOW}", "daily")
EXPECTED["mart_daily_backfill"] = sql(f"""
  SELECT * FROM daily_changed WHERE {_WINDOW}
  UNION ALL SELECT * FROM daily
  WHERE order_date NOT IN (SELECT order_date FROM daily_changed WHERE {_WINDOW})""", "daily", "daily_changed")
EXPECTED["mart_customer_value"] = sql("SELECT * FROM customer_value", "customer_value")
EXPECTED["mart_customer_value_from_changes"] = sql(_customer_value("dim", "fact_now"), "dim", "fact_now")
EXPECTED["mart_daily_from_changes"] = sql("SELECT * FROM daily_now", "daily_now")
EXPECTED["mart_product_performance_from_changes"] = sql(
    _product_value("products_now", "order_items_now"), "products_now", "order_items_now")
EXPECTED["mart_product_performance"] = sql("SELECT * FROM product_value", "product_value")

# ---- data tests -------------------------------------------------------------

EXPECTED["check_unique"] = sql(
    "SELECT order_id, product_id, count(*) AS row_count FROM order_items GROUP BY ALL HAVING count(*) > 1",
    "order_items")
EXPECTED["check_not_null"] = sql(
    "SELECT shipment_id, shipment_status FROM shipments WHERE shipped_at IS NULL", "shipments")
EXPECTED["check_accepted"] = sql(f"""
  SELECT payment_status AS value, count(*) AS row_count FROM payments
  WHERE payment_status NOT IN {_in(v for v in ACCEPTED_VALUES[("payments", "payment_status")] if v != "refunded")}
  GROUP BY 1""", "payments")
EXPECTED["check_relationships"] = sql("""
  SELECT customer_id AS missing_key, count(*) AS row_count FROM shop_orders
  WHERE customer_id NOT IN (SELECT customer_id FROM customers_now) GROUP BY 1""", "shop_orders", "customers_now")
EXPECTED["check_item_totals"] = sql("""
  SELECT o.order_id, CAST(coalesce(total, 0) + 1 AS DOUBLE) AS order_total,
         CAST(coalesce(total, 0) AS DOUBLE) AS calculated_order_total
  FROM shop_orders o LEFT JOIN (SELECT order_id, sum(line_total) AS total FROM order_items GROUP BY 1) i
    ON i.order_id = o.order_id WHERE o.order_id % 13 = 0""", "shop_orders", "order_items")
EXPECTED["check_payment_totals"] = sql("""
  SELECT o.order_id, CAST(order_total AS DOUBLE) AS order_total, coalesce(n, 0) AS payment_count,
         CAST(coalesce(total, 0) AS DOUBLE) AS total_payment_amount
  FROM shop_orders o LEFT JOIN (
    SELECT order_id, count(*) AS n, sum(amount - CASE payment_method WHEN 'bank_transfer' THEN 1.00
             WHEN 'credit_card' THEN 0.01 ELSE 0.00 END) AS total
    FROM payments GROUP BY 1) p ON p.order_id = o.order_id
  WHERE coalesce(n, 0) <> 1 OR abs(order_total - coalesce(total, 0)) > 0.01""", "shop_orders", "payments")
_FACT_TOTALS = """
         (SELECT count(*) FROM shop_orders) AS fact_order_count,
         (SELECT CAST(sum(order_total) AS DOUBLE) FROM shop_orders) AS fact_order_value,
         (SELECT count(*) FROM payments) AS fact_payment_count,
         (SELECT CAST(sum(amount) AS DOUBLE) FROM payments) AS fact_payment_value,
         (SELECT count(*) FROM shipments) AS fact_shipment_count"""
EXPECTED["check_daily_reconcile"] = sql(f"""
  SELECT * FROM (
    SELECT {_FACT_TOTALS},
           CAST(sum(order_count + CASE WHEN {_WINDOW} THEN 1 ELSE 0 END) AS BIGINT) AS mart_order_count, CAST(sum(payment_count) AS BIGINT) AS mart_payment_count,
           CAST(sum(shipment_count) AS BIGINT) AS mart_shipment_count,
           CAST(sum(CAST(gross_order_value AS DECIMAL(18,2))) AS DOUBLE) AS mart_order_value,
           CAST(sum(CAST(total_payment_value AS DECIMAL(18,2))) AS DOUBLE) AS mart_payment_value
    FROM daily)
  WHERE fact_order_count <> mart_order_count""", "daily")
EXPECTED["check_rows"] = sql("""
  SELECT 'products' AS table_name, CAST(product_id AS VARCHAR) AS row_key, 'price' AS rule FROM products
  WHERE unit_price <= 950
  UNION ALL SELECT 'orders', CAST(order_id AS VARCHAR), 'currency' FROM shop_orders WHERE order_id % 31 = 0
  UNION ALL SELECT 'order_items', CAST(order_item_id AS VARCHAR), 'quantity' FROM order_items WHERE quantity <= 1
  UNION ALL SELECT 'shipments', CAST(shipment_id AS VARCHAR), 'dates' FROM shipments
  WHERE delivered_at < shipped_at + to_days(CAST(shipment_id % 7 AS INTEGER))
""", "products", "shop_orders", "order_items", "shipments")
EXPECTED["check_run_rules"] = sql(
    "SELECT run_id AS row_key, 'completion' AS rule FROM runs WHERE status <> 'running' AND NOT ended", "runs")


def _orphans(name: str, child: str, key: str, parent: str) -> str:
    return f"""SELECT '{name}' AS check_name, count(*) AS failures FROM {child} c
    WHERE c.{key} IS NULL OR c.{key} NOT IN (SELECT {key} FROM {parent})"""


def _integrity(customers: str, products: str) -> str:
    return "\n  UNION ALL ".join([
        _orphans("orders_without_customer", "shop_orders", "customer_id", customers),
        _orphans("items_without_order", "order_items", "order_id", "shop_orders"),
        _orphans("items_without_product", "order_items", "product_id", products),
        _orphans("payments_without_order", "payments", "order_id", "shop_orders"),
        _orphans("shipments_without_order", "shipments", "order_id", "shop_orders"),
        """SELECT 'order_total_mismatches', count(*) FROM shop_orders o
    LEFT JOIN (SELECT order_id, sum(line_total) AS t FROM order_items GROUP BY 1) i ON i.order_id = o.order_id
    WHERE t IS NULL OR t <> order_total""",
        """SELECT 'payment_total_mismatches', count(*) FROM shop_orders o
    LEFT JOIN (SELECT order_id, sum(amount) AS t FROM payments GROUP BY 1) p ON p.order_id = o.order_id
    WHERE t IS NULL OR t <> order_total""",
    ])


_SOURCE = ("customers", "products", "shop_orders", "order_items", "payments", "shipments")
EXPECTED["integrity_report"] = sql(
    _integrity("customers_now", "products_now"), *_SOURCE, "customers_now", "products_now")


def _lost(problem: str, child: str, key: str, parent: str) -> str:
    return f"""SELECT '{problem}' AS problem, CAST({key} AS VARCHAR) AS row_key, count(*) AS row_count FROM {child}
  WHERE {key} NOT IN (SELECT {key} FROM {parent}) GROUP BY {key}"""


EXPECTED["dataset_problems"] = sql("\n  UNION ALL ".join([
    _lost("order of unknown customer", "shop_orders", "customer_id", "customers_now"),
    _lost("item of unknown order", "order_items", "order_id", "shop_orders"),
    _lost("item of unknown product", "order_items", "product_id", "products_now"),
    _lost("payment of unknown order", "payments", "order_id", "shop_orders"),
    _lost("shipment of unknown order", "shipments", "order_id", "shop_orders"),
    """SELECT 'order repeats product', order_id || '/' || product_id, count(*) FROM order_items
  GROUP BY order_id, product_id HAVING count(*) > 1""",
    """SELECT 'order total differs from items', CAST(o.order_id AS VARCHAR), 1 FROM shop_orders o LEFT JOIN (
    SELECT order_id, sum(unit_price * quantity) AS t FROM order_items GROUP BY 1) i ON i.order_id = o.order_id
  WHERE order_total <> coalesce(t, 0)""",
]), *_SOURCE, "customers_now", "products_now")


def _plain_text(entity: str) -> str:
    """Text of a row as Spark prints its values."""
    parts = []
    for field in ENTITIES[entity].schema.fields:
        kind = field.dataType.simpleString()
        parts.append(f"coalesce(CAST({field.name} AS VARCHAR), '~')" if kind != "boolean"
                     else f"CASE WHEN {field.name} THEN 'true' ELSE 'false' END")
    return f"concat_ws('|', {', '.join(parts)})"


EXPECTED["table_fingerprint"] = sql("\n  UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, count(*) AS row_count,
         CAST(sum(CAST(CAST('0x' || substr(md5({_plain_text(name)}), 1, 16) AS UBIGINT) AS HUGEINT)) AS VARCHAR) AS content_sum,
         CAST(sum(CAST(CAST('0x' || substr(md5({_plain_text(name)}), 17, 16) AS UBIGINT) AS HUGEINT)) AS VARCHAR) AS content_sum_low
  FROM {ENTITY_CTE[name]}""" for name in TABLES), *_SOURCE)
EXPECTED["source_profile"] = sql(
    "\n  UNION ALL ".join(
        [f"SELECT 'rows.{n}' AS metric, CAST(count(*) AS VARCHAR) AS value FROM {ENTITY_CTE[n]}" for n in TABLES]
        + [f"SELECT 'failures.' || check_name, CAST(failures AS VARCHAR) FROM ({_integrity('customers', 'products')})"]
        + [f"SELECT '{t}.' || {c}, CAST(count(*) AS VARCHAR) FROM {ENTITY_CTE[t]} GROUP BY {c}" for t, c in (
            ("orders", "order_status"), ("payments", "payment_status"), ("shipments", "shipment_status"))]
        + ["SELECT 'total_order_value', CAST(sum(order_total) AS VARCHAR) FROM shop_orders",
           f"""SELECT 'average_order_value', CAST(CAST({_mean('sum(' + _cents('order_total') + ')', 'count(*)')}
           AS DECIMAL(24,2)) AS VARCHAR) FROM shop_orders"""]), *_SOURCE)

# ---- reliability ------------------------------------------------------------


def _drift(name: str, lost: str) -> str:
    entity = ENTITIES[name]
    fields = sorted(entity.columns)
    everything, key, source = ",".join(fields), entity.key, ENTITY_CTE[name]
    # the columns missing from a record: its key, the lost one, or both
    both = ",".join(f for f in fields if f in (key, lost))
    return f"""
  SELECT CASE WHEN k % 29 = 0 THEN 'suppliers' ELSE '{name}' END AS source_table, k AS row_id,
         reason IS NULL AS compatible,
         CASE WHEN reason IS NOT NULL THEN 'incompatible' WHEN k % 11 = 0 THEN 'additive' ELSE 'unchanged' END
           AS change_type, reason AS drift_reason,
         CASE WHEN k % 29 = 0 THEN '' WHEN k % 23 = 0 THEN '{everything}'
           WHEN k % 13 = 0 AND k % 19 = 0 THEN '{both}' WHEN k % 13 = 0 THEN '{key}' WHEN k % 19 = 0 THEN '{lost}'
           ELSE '' END AS missing_fields,
         CASE WHEN k % 29 = 0 OR k % 23 = 0 OR k % 11 <> 0 THEN '' ELSE 'loyalty_tier' END AS extra_fields
  FROM (SELECT {key} AS k, CASE WHEN k % 29 = 0 THEN 'unexpected_source_table' WHEN k % 23 = 0 THEN 'record_not_object'
          WHEN k % 13 = 0 THEN 'missing_primary_key' WHEN k % 17 = 0 THEN 'incompatible_primary_key_type'
          WHEN k % 19 = 0 THEN 'missing_expected_fields' END AS reason FROM {source})"""


EXPECTED["schema_drift"] = sql(
    _drift("customers", "city") + "\n  UNION ALL" + _drift("orders", "currency"), "customers", "shop_orders")
EXPECTED["event_order"] = sql("""
  SELECT n AS kafka_offset, CASE WHEN behind > 300000 THEN 'late' WHEN behind > 0 THEN 'out_of_order' ELSE 'on_time' END
           AS order_status, CAST(greatest(behind, 0) AS DOUBLE) / 1000 AS event_delay_seconds,
         behind > 0 AS is_out_of_order, behind > 300000 AS is_late, behind > 300000 AS requires_backfill
  FROM (SELECT n, coalesce(max(t) OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY n
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - t, 0) AS behind
        FROM late)""", "late")
EXPECTED["out_of_order"] = sql("""
  SELECT kafka_topic, kafka_partition, n AS kafka_offset, t AS source_timestamp_ms, before AS previous_timestamp_ms
  FROM (SELECT *, lag(t) OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY n) AS before FROM late)
  WHERE t < before""", "late")
_STAGES = {
    "connector": "connector_ms - sent_ms", "bronze_processing": "ingested_ms - connector_ms",
    "warehouse_load": "loaded_ms - ingested_ms", "end_to_end": "loaded_ms - sent_ms"}
EXPECTED["stage_latency"] = sql("SELECT count(*) AS measured_events, " + ", ".join(
    f"CAST((2000 * sum(greatest({gap}, 0)) + count(*)) // (2 * count(*)) AS DOUBLE) / 1000 AS {name}_average, "
    f"CAST(max(greatest({gap}, 0)) AS DOUBLE) AS {name}_maximum" for name, gap in _STAGES.items()) + " FROM timed",
    "timed")
_CHECKED_MS = "epoch_ms(TIMESTAMP '2024-03-02')"
EXPECTED["freshness"] = sql(f"""
  SELECT source_table, CAST(greatest({_CHECKED_MS} - max(loaded_ms), 0) AS DOUBLE) / 1000 AS age_seconds
  FROM timed GROUP BY 1""", "timed")
EXPECTED["latency_percentiles"] = sql("""
  SELECT count(*) AS measured_events, quantile_cont(connector_ms - sent_ms, 0.5) AS median_ms,
         quantile_cont(connector_ms - sent_ms, 0.95) AS p95_ms,
         CAST(max(connector_ms - sent_ms) AS DOUBLE) AS maximum_ms
  FROM valid WHERE op IN ('c', 'u', 'd')""", "valid")
EXPECTED["latency_percentiles_approx"] = sql("""
  SELECT count(*) AS measured_events, CAST(quantile_disc(connector_ms - sent_ms, 0.5) AS DOUBLE) AS median_ms,
         CAST(quantile_disc(connector_ms - sent_ms, 0.95) AS DOUBLE) AS p95_ms,
         CAST(max(connector_ms - sent_ms) AS DOUBLE) AS maximum_ms
  FROM valid WHERE op IN ('c', 'u', 'd')""", "valid")


def _reconciled(source: str, target: str) -> str:
    return f"""
  SELECT table_name, s AS source_count, t AS target_count, t - s AS difference, greatest(s - t, 0) AS missing_records,
         greatest(t - s, 0) AS unexpected_records, s = t AS reconciled
  FROM (SELECT coalesce(a.table_name, b.table_name) AS table_name, coalesce(a.n, 0) AS s, coalesce(b.n, 0) AS t
        FROM ({source}) a FULL JOIN ({target}) b ON a.table_name = b.table_name)"""


def _sizes(names: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {t}" for n, t in names.items())


EXPECTED["reconciliation"] = sql(
    _reconciled(_sizes(ENTITY_CTE), _sizes({n: f"{n}_now" for n in TABLES})), *_SOURCE, *[f"{n}_now" for n in TABLES])
_BY_TABLE = "SELECT source_table AS table_name, count(*) AS n FROM {} GROUP BY 1"
EXPECTED["event_reconciliation"] = sql(
    _reconciled(_BY_TABLE.format("valid"), _BY_TABLE.format("first_load")), "valid", "first_load")
EXPECTED["completeness"] = sql(f"""
  SELECT CAST(sum(s.n) AS BIGINT) AS total_source_rows, CAST(sum(t.n) AS BIGINT) AS total_topic_events,
         round(min(CAST(t.n AS DOUBLE) / s.n), 6) AS minimum_completeness_rate,
         bool_and(s.n = t.n) AS exact_initial_snapshot_match, bool_and(t.n >= s.n) AS complete
  FROM ({_sizes(ENTITY_CTE)}) s JOIN ({_sizes({n: f'{n}_log' for n in TABLES})}) t ON t.table_name = s.table_name""",
  *_SOURCE, *[f"{n}_log" for n in TABLES])
EXPECTED["change_sequence"] = sql("""
  SELECT k AS customer_id, event_count, array_to_string(operations[1:3], ',') AS first_operations, remaining_rows,
         operations = ['u', 'd', 'c'] AND remaining_rows = 0 AS verified
  FROM (SELECT l.customer_id AS k, list(l.operation ORDER BY l.kafka_offset) AS operations, count(*) AS event_count,
               CAST(any_value(CASE WHEN c.customer_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS remaining_rows
        FROM customers_log l LEFT JOIN customers_now c
          ON c.customer_id = l.customer_id
        WHERE l.operation <> 'r' GROUP BY l.customer_id)""", "customers_log", "customers_now")
_CHECKS = {
    "live_bronze_profile_is_valid": "TRUE",
    "source_to_bronze_current_state_reconciles": "(SELECT count(*) FROM valid) = (SELECT count(*) FROM first_load)",
    "bronze_to_warehouse_events_reconcile": "TRUE",
    "warehouse_event_ids_are_unique": "(SELECT count(*) = count(DISTINCT event_id) FROM valid)",
    "required_metadata_is_complete": "(SELECT bool_and(event_id IS NOT NULL AND operation IS NOT NULL) FROM valid)",
    "kafka_topics_are_healthy": f"(SELECT count(DISTINCT source_table) = {len(TABLES)} FROM stream "
                                "WHERE source_table <> 'unknown')",
    "successful_pipeline_run_exists": "(SELECT count(*) > 0 FROM runs WHERE status = 'success')",
    "warehouse_data_meets_freshness_slo": f"(SELECT {_CHECKED_MS} - max(loaded_ms) <= 86400000 FROM timed)",
    "pipeline_meets_freshness_slo": f"(SELECT {_CHECKED_MS} * 1000 - max(epoch_us(started_at) + seconds * 1000000) "
                                    "<= 86400000000 FROM runs WHERE status = 'success')",
    "latency_measurements_exist": "(SELECT count(*) > 0 FROM timed)",
}
_CHECK_ROWS = " UNION ALL ".join(f"SELECT '{n}' AS check_name, {c} AS passed" for n, c in _CHECKS.items())
_CHECK_NEEDS = ("valid", "first_load", "stream", "timed", "runs")
EXPECTED["slo_checks"] = sql(_CHECK_ROWS, *_CHECK_NEEDS)
EXPECTED["bronze_profile"] = sql("""
  SELECT *, missing_tables = '' AND unexpected_tables = '' AND duplicate_event_ids = 0 AND total_null_metadata = 0
            AND quarantine_duplicate_event_ids = 0 AS valid
  FROM (SELECT count(*) AS bronze_records, count(DISTINCT kafka_topic) AS topic_count,
               count(DISTINCT kafka_topic || kafka_partition) AS topic_partition_count,
               count(DISTINCT event_date) AS event_date_count,
               count(DISTINCT source_table || event_date) AS table_date_partition_count, 0 AS total_null_metadata,
               count(DISTINCT source_table) AS source_table_count, '' AS missing_tables, '' AS unexpected_tables,
               count(DISTINCT event_id) AS unique_event_ids, count(*) - count(DISTINCT event_id) AS duplicate_event_ids,
               (SELECT count(*) + count(*) FILTER (n % 50 = 0) FROM bronze WHERE invalid_reason IS NOT NULL)
                 AS quarantine_records,
               (SELECT count(*) FROM bronze WHERE invalid_reason IS NOT NULL) AS quarantine_unique_event_ids,
               (SELECT count(*) FILTER (n % 50 = 0) FROM bronze WHERE invalid_reason IS NOT NULL)
                 AS quarantine_duplicate_event_ids,
               count(*) FILTER (op <> 'r') AS measured_events,
               CAST(quantile_disc(connector_ms - sent_ms, 0.5) FILTER (op <> 'r') AS DOUBLE) AS median_ms,
               CAST(quantile_disc(connector_ms - sent_ms, 0.95) FILTER (op <> 'r') AS DOUBLE) AS p95_ms,
               CAST(max(connector_ms - sent_ms) FILTER (op <> 'r') AS DOUBLE) AS maximum_ms
        FROM replayed)""", "replayed")
EXPECTED["null_counts"] = sql("""
  SELECT 0 AS event_id, 0 AS kafka_topic, 0 AS kafka_partition, 0 AS kafka_offset, 0 AS source_table,
         count(*) FILTER (NOT readable) AS operation, 0 AS event_timestamp, 0 AS ingestion_run_id, 0 AS ingested_at
  FROM bronze""", "bronze")
EXPECTED["raw_quality"] = sql("""
  SELECT count(*) + count(*) FILTER (n % 50 = 0) AS raw_bronze_records, count(*) AS unique_raw_event_ids,
         count(*) FILTER (n % 50 = 0) AS duplicate_raw_event_ids,
         count(*) FILTER (NOT readable) + count(*) FILTER (NOT readable AND n % 50 = 0) AS null_required_metadata
  FROM bronze""", "bronze")
EXPECTED["metadata_counts"] = sql("""
  SELECT source_table, operation, kafka_topic, kafka_partition, event_date, count(*) AS n, 0 AS null_metadata
  FROM valid GROUP BY ALL""", "valid")
EXPECTED["distinct_counts"] = sql("""
  SELECT count(DISTINCT kafka_topic) AS topics, count(DISTINCT kafka_topic || kafka_partition) AS topic_partitions,
         count(DISTINCT event_date) AS days, count(DISTINCT source_table || event_date) AS table_days FROM valid""",
  "valid")
_DAILY_TOTALS = """count(*) AS reporting_days, count(*) - count(DISTINCT order_date) AS duplicate_reporting_days,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date,
         CAST(sum(order_count) AS BIGINT) AS daily_order_count, CAST(sum(payment_count) AS BIGINT) AS daily_payment_count,
         CAST(sum(shipment_count) AS BIGINT) AS daily_shipment_count,
         sum(CAST(gross_order_value AS DECIMAL(18,2))) AS daily_order_value,
         sum(CAST(total_payment_value AS DECIMAL(18,2))) AS daily_payment_value"""
_MONEY = """
  SELECT *, abs(total_order_value - total_line_value) AS order_item_difference,
         abs(total_order_value - total_payment_value) AS order_payment_difference
  FROM (SELECT (SELECT sum(order_total) FROM shop_orders) AS total_order_value,
               (SELECT sum(line_total) FROM order_items) AS total_line_value,
               (SELECT sum(amount) FROM payments) AS total_payment_value)"""
_VERSIONS = """
  SELECT count(*) AS snapshot_versions, count(DISTINCT customer_id) AS snapshot_customers,
         count(*) FILTER (valid_to IS NULL) AS current_snapshot_versions,
         count(*) FILTER (valid_to IS NOT NULL) AS historical_snapshot_versions,
         count(*) FILTER (is_deleted) AS deleted_snapshot_versions FROM history"""


def _unpivoted(select: str) -> str:
    return f"SELECT name AS metric, value FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({select})) ON COLUMNS(*))"


_STAR_SIZES = {
    "dim_customers": "customers", "dim_products": "products", "fact_orders": "shop_orders",
    "fact_order_items": "order_items", "fact_payments": "payments", "fact_shipments": "shipments",
    "mart_daily_commerce": "daily", "mart_customer_value": "customers", "mart_product_performance": "products",
    **{f"current.{n}": ENTITY_CTE[n] for n in TABLES}}
EXPECTED["warehouse_profile"] = sql(" UNION ALL ".join([
    _unpivoted(_VERSIONS), _unpivoted(_MONEY), _unpivoted(f"SELECT {_DAILY_TOTALS} FROM daily"),
    f"SELECT 'rows.' || table_name, CAST(n AS VARCHAR) FROM ({_sizes(_STAR_SIZES)})"]), "history", "daily", *_SOURCE)
_RUN_COUNTS = """count(*) AS total_runs, count(*) FILTER (status = 'success') AS successful_runs,
         count(*) FILTER (status = 'failed') AS failed_runs, count(*) FILTER (status = 'running') AS running_runs,
         count(*) FILTER (status = 'success' AND run_mode = 'incremental') AS successful_incremental_runs,
         count(*) FILTER (status = 'success' AND run_mode = 'backfill') AS successful_backfill_runs,
         count(*) FILTER (status = 'failed' AND run_mode = 'backfill') AS failed_backfill_runs,
         count(*) FILTER (status <> 'running' AND NOT ended) AS inconsistent_completed_runs,
         count(*) FILTER (status = 'failed' AND failed_task_id IS NULL) AS incomplete_failure_records"""


def _newest(column: str, condition: str) -> str:
    return f"(SELECT {column} FROM runs WHERE {condition} ORDER BY started_at DESC LIMIT 1)"


_INC, _BACK = "run_mode = 'incremental' AND status = 'success'", "run_mode = 'backfill' AND status = 'success'"
_AUDIT = f"""
  SELECT r.*, {_newest('run_id', _INC)} AS latest_incremental_run,
         CAST({_newest('seconds', _INC)} AS DOUBLE) AS latest_incremental_seconds,
         {_newest('run_id', _BACK)} AS latest_backfill_run,
         {_newest('backfill_end_date - backfill_start_date + 1', _BACK)} AS backfill_window_days,
         {_newest('run_id', "status = 'failed'")} AS latest_failed_run,
         {_newest('failed_task_id', "status = 'failed'")} AS latest_failed_task,
         (SELECT count(*) FROM recovered) AS recovered_backfill_failures,
         d.* REPLACE (CAST(daily_order_value AS DOUBLE) AS daily_order_value,
                      CAST(daily_payment_value AS DOUBLE) AS daily_payment_value),
         {_newest('backfill_end_date - backfill_start_date + 1 BETWEEN 1 AND 31', _BACK)} AS window_is_valid
  FROM (SELECT {_RUN_COUNTS} FROM runs) r, (SELECT {_DAILY_TOTALS} FROM daily) d"""
EXPECTED["audit_profile"] = sql(_AUDIT, "runs", "recovered", "daily")
CTES["audit"] = _AUDIT
NEEDS["audit"] = ["runs", "recovered", "daily"]
EXPECTED["audit_checks"] = sql(" UNION ALL ".join(
    f"SELECT '{name}' AS check_name, {condition} AS passed FROM audit" for name, condition in {
        "successful_incremental_exists": "successful_incremental_runs >= 1",
        "successful_backfill_exists": "successful_backfill_runs >= 1",
        "no_running_audit_records": "running_runs = 0",
        "completed_audit_records_are_consistent": "inconsistent_completed_runs = 0",
        "failure_records_identify_tasks": "incomplete_failure_records = 0",
        "backfill_window_is_valid": "window_is_valid",
        "reporting_dates_are_unique": "duplicate_reporting_days = 0",
        "reporting_day_count_reconciles":
            "reporting_days = (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders)",
        "order_count_reconciles": "daily_order_count = (SELECT count(*) FROM orders)",
        "order_value_reconciles": "daily_order_value = 0",
    }.items()), "audit")
EXPECTED["recovered_failures"] = sql(f"""
  SELECT run_id, CAST(backfill_start_date AS VARCHAR) AS backfill_start_date,
         CAST(backfill_end_date AS VARCHAR) AS backfill_end_date, {_text('failed_at')}, {_text('last_success_at')},
         CAST((2 * (epoch_us(last_success_at) - epoch_us(failed_at)) + 1000) // 2000 AS DOUBLE) / 1000
           AS recovery_seconds FROM recovered""", "recovered")
EXPECTED["run_audit"] = f"""
  WITH log AS (SELECT *, 'run-' || user_id AS run_id, event_type IN ('signup', 'view') AS starts FROM events),
  begun AS (SELECT run_id, arg_max(event_id, ts) AS n, max(ts) AS started_at FROM log WHERE starts GROUP BY 1),
  since AS (SELECT l.* FROM log l JOIN begun b ON b.run_id = l.run_id AND l.ts >= b.started_at),
  done AS (SELECT run_id, arg_max(event_id, ts) AS m, arg_max(event_type, ts) AS kind, max(ts) AS completed_at
           FROM since WHERE NOT starts GROUP BY 1),
  detail AS (SELECT run_id, string_agg(event_type || '=' || e, ',' ORDER BY event_type) AS details
             FROM (SELECT run_id, event_type, arg_max(event_id, ts) AS e FROM since GROUP BY ALL) GROUP BY 1)
  SELECT b.run_id, 'daily' AS dag_id, CASE WHEN n % 3 = 0 THEN 'backfill' ELSE 'incremental' END AS run_mode,
         CASE WHEN n % 3 = 0 THEN CAST(CAST(started_at AS DATE) AS VARCHAR) END AS backfill_start_date,
         CASE WHEN n % 3 = 0 THEN CAST(CAST(started_at AS DATE) + CAST(n % 5 AS INTEGER) AS VARCHAR) END
           AS backfill_end_date,
         CASE WHEN kind IS NULL THEN 'running' WHEN kind = 'error' THEN 'failed' ELSE 'success' END AS status,
         {_text('started_at')}, {_text('completed_at')},
         CAST((2 * (epoch_us(completed_at) - epoch_us(started_at)) + 1000) // 2000 AS DOUBLE) / 1000
           AS duration_seconds,
         CASE WHEN kind = 'error' THEN 'task-' || (m % 4) END AS failed_task_id,
         CASE WHEN kind = 'error' THEN 'error ' || m END AS error_message, details
  FROM begun b LEFT JOIN done d ON d.run_id = b.run_id LEFT JOIN detail t ON t.run_id = b.run_id"""
_AGE = f"(SELECT greatest({_CHECKED_MS} - max(loaded_ms), 0) / 1000.0 FROM timed)"
EXPECTED["dashboard_cards"] = sql(f"""
  SELECT CAST(position AS BIGINT) AS position, label, value, healthy, detail FROM (
    SELECT 1 AS position, 'Checks on data' AS label,
           (SELECT count(*) FILTER (passed) || '/' || count(*) FROM ({_CHECK_ROWS})) AS value,
           (SELECT bool_and(passed) FROM ({_CHECK_ROWS})) AS healthy, 'Passed of all checks on data and runs' AS detail
    UNION ALL SELECT 2, 'Checks on services', (SELECT count(*) || '/' || count(*) FROM region), TRUE,
           'Passed of all reported services'
    UNION ALL SELECT 3, 'Events in the lake', (SELECT format('{{:,}}', count(*)) FROM valid), TRUE, 'Valid events the stream has written'
    UNION ALL SELECT 4, 'Events loaded', (SELECT format('{{:,}}', count(*)) FROM first_load),
           (SELECT count(*) FROM valid) = (SELECT count(*) FROM first_load), 'Rows of the raw table'
    UNION ALL SELECT 5, 'Loaded minus streamed',
           format('{{:,}}', (SELECT count(*) FROM first_load) - (SELECT count(*) FROM valid)),
           (SELECT count(*) FROM valid) = (SELECT count(*) FROM first_load), 'Zero when every event arrived'
    UNION ALL SELECT 6, 'Repeated ids', '0', TRUE, 'Rows of the raw table beyond one for each id'
    UNION ALL SELECT 7, 'Age of the newest row', format('{{:,.3f}} seconds', CAST({_AGE} AS DOUBLE)), {_AGE} <= 86400,
           'At most 86,400.000 seconds'
    UNION ALL SELECT 8, 'Events set apart',
           (SELECT format('{{:,}}', count(*)) FROM bronze WHERE invalid_reason IS NOT NULL), TRUE,
           'Each with the reason it was not valid')""", *_CHECK_NEEDS, "bronze")

# ---- streaming --------------------------------------------------------------

EXPECTED["stream_bronze"] = sql("""
  SELECT event_id, source_table, operation, n AS kafka_offset, event_date, invalid_reason FROM bronze""", "bronze")
EXPECTED["stream_resume"] = sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT CAST({run} AS BIGINT) AS run, count(*) FILTER (n % 2 = {half}) AS input_rows, "
        f"count(*) FILTER (n % 2 = {half} AND invalid_reason IS NULL) AS new_bronze_events, "
        f"count(*) FILTER (n % 2 = {half} AND invalid_reason IS NOT NULL) AS new_quarantine_events, "
        f"0 AS duplicate_event_ids FROM bronze" for run, half in ((1, 0), (2, 2), (3, 1))) + ")", "bronze")

# ---- kept up over several loads ----------------------------------------------

for _name in TABLES:
    EXPECTED[f"current_{_name}_incremental"] = EXPECTED[f"current_{_name}"]
EXPECTED["incremental_build"] = sql(
    "SELECT 'during' AS seen, * FROM daily UNION ALL SELECT 'after' AS seen, * FROM daily_now", "daily", "daily_now")
EXPECTED["fact_orders_interleaved"] = EXPECTED["fact_orders_asof"]
EXPECTED["stream_event_order"] = EXPECTED["event_order"]
_PLAIN_CUSTOMER = ", ".join(ENTITIES["customers"].columns)
EXPECTED["customer_event_history"] = sql(f"""
  SELECT {', '.join(SHAPES['customers'])},
         md5(CAST(customer_id AS VARCHAR) || '|' || CAST(valid_from AS VARCHAR) || '+00'
           || CASE WHEN is_deleted THEN '|deleted' ELSE '' END) AS scd_id, {_VALIDITY}
  FROM (
    SELECT * REPLACE (make_timestamp(valid_from * 1000) AS valid_from, make_timestamp(valid_to * 1000) AS valid_to)
    FROM (
      SELECT o.*, e.source_timestamp_ms AS valid_from, lead(e.source_timestamp_ms) OVER (PARTITION BY e.customer_id ORDER BY e.source_timestamp_ms)
               AS valid_to, e.version = 2 AS is_deleted
      FROM customers_log e JOIN (SELECT {_PLAIN_CUSTOMER}, version FROM customers_log) o ON o.customer_id = e.customer_id
       AND o.version = CASE WHEN e.version <> 2 THEN e.version WHEN e.customer_id % 10 = 0 THEN 1 ELSE 0 END))""", "customers_log")
EXPECTED["offset_gaps"] = """
  SELECT kafka_topic, kafka_partition, previous + 1 AS first_missing, kafka_offset - 1 AS last_missing, kafka_offset - previous - 1 AS missing
  FROM (SELECT *, lag(kafka_offset) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset) AS previous
        FROM (SELECT 'TOPIC.events' AS kafka_topic, event_id % 3 AS kafka_partition, event_id // 3 AS kafka_offset
              FROM events WHERE event_id % 89 >= 4))
  WHERE kafka_offset - previous > 1""".replace("TOPIC", TOPIC_PREFIX)
EXPECTED["run_lookup"] = f"SELECT * FROM ({EXPECTED['run_audit']}) WHERE run_id = '{LOOKED_UP}'"
EXPECTED["position_problems"] = """
  SELECT event_id AS kafka_offset, CASE WHEN event_id % 31 = 0 THEN 'empty_topic' WHEN event_id % 37 = 0 THEN 'negative_partition'
           ELSE 'negative_offset' END AS problem
  FROM events WHERE event_id % 31 = 0 OR event_id % 37 = 0 OR event_id % 41 = 0"""
EXPECTED["load_audit"] = sql("""
  SELECT run_id, 'bronze_to_warehouse' AS pipeline_name, 'succeeded' AS status, n AS source_record_count,
         CASE WHEN run_id = 'first' THEN n ELSE 0 END AS inserted_record_count,
         CASE WHEN run_id = 'first' THEN 0 ELSE n END AS existing_record_count, 0 AS failed_record_count
  FROM (VALUES ('first'), ('again')) AS r(run_id), (SELECT count(DISTINCT event_id) AS n FROM replayed)""", "replayed")
