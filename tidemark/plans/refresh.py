"""Keeps every table up to date with what was loaded since the last build.

A build takes the raw rows that were loaded since the last published build merged
their entity, merges them into its state, and writes only what follows from
the keys that changed: their rows of the facts, in the months those lie in, and
of the daily mart the months of its window. A build is seen by nobody until it
is published, all tables at once.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import star
from tidemark.operators.current import live_rows
from tidemark.operators.staging import normalised_events, typed_events
from tidemark.plans import marts
from tidemark.schemas import CUSTOMERS, ENTITIES, LINEAGE_COLUMNS
from tidemark.sources.lake import HistoryTable, Lake, drop_stored, stored
from tidemark.sources.versions import PART, StateTable, VersionedTable

# What the customer history tracks: the customer and where its row came from.
HISTORY_SCHEMA = T.StructType(CUSTOMERS.schema.fields + [
    T.StructField("current_event_id", T.StringType()), T.StructField("latest_operation", T.StringType()),
    T.StructField("source_event_at", T.TimestampType()), T.StructField("warehouse_loaded_at", T.TimestampType())])
# what a build reads of a raw row
RAW_COLUMNS = ("event_id", "source_table", "operation", "key_json", "before_json", "after_json", *LINEAGE_COLUMNS)
STATE_PARTS = 16
DAILY = "mart_daily_commerce"
# what every dimension, fact and mart is made of
MADE_OF = {
    "dim_customers": ("customers",), "dim_products": ("products",), "fact_orders": ("orders", "customers"),
    "fact_order_items": ("order_items", "products"), "fact_payments": ("payments", "orders"),
    "fact_shipments": ("shipments", "orders"), "mart_customer_value": ("customers", "orders"),
    "mart_product_performance": ("products", "order_items"),
    DAILY: ("orders", "payments", "shipments", "customers")}
READ_FROM = {
    "fact_orders": ("dim_customers",), "fact_order_items": ("dim_products",), "fact_payments": ("fact_orders",),
    "fact_shipments": ("fact_orders",), "mart_customer_value": ("dim_customers", "fact_orders"),
    "mart_product_performance": ("dim_products", "fact_order_items"), DAILY: ("fact_orders", "fact_payments", "fact_shipments")}
WHOLE, NARROWED = "whole", "narrowed"


def customer_history(lake: Lake) -> HistoryTable:
    return lake.history("snap_customers", HISTORY_SCHEMA, CUSTOMERS.key)


def month_part(day: str) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none"))


def months(start: date, end: date) -> list[str]:
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [f"{n // 12:04d}-{n % 12 + 1:02d}" for n in range(first, last + 1)]


def ids(frame: DataFrame, name: str) -> DataFrame:
    return frame.select(F.col(name).alias(name.split(".")[-1])).distinct()


def only(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of some keys; a null key is a key like any other."""
    wanted = keys.select(F.col(key).alias("_wanted"))
    return rows.join(wanted, F.col(key).eqNullSafe(F.col("_wanted")), "left_semi")


def wanted_for(names: Collection[str]) -> set[str]:
    """The tables ``names`` and all they are read from."""
    found = set(names)
    for name in names:
        found |= wanted_for(READ_FROM.get(name, ()))
    return found


class Build:
    """One build on top of the last published one."""

    def __init__(self, lake: Lake, run_id: str, snapshot_at: datetime, start: date | None = None, end: date | None = None,
                 state_parts: int = STATE_PARTS, only: Collection[str] = tuple(MADE_OF)):
        """``only`` names the tables wanted; they and what they are made of are brought up to date, no others."""
        self.lake, self.run_id, self.start, self.end, self.state_parts = lake, run_id, start, end, state_parts
        self.wanted = wanted_for(only)
        self.entities = [name for name in ENTITIES if any(name in MADE_OF[table] for table in self.wanted)]
        self.now = F.lit(snapshot_at).cast("timestamp")
        self.publication = lake.publication()
        self.number = (self.publication.last() or 0) + 1
        self.before = self.publication.tables()
        self.after = dict(self.before)
        self.changes: dict[str, DataFrame] = {}

    # ---- tables -------------------------------------------------------------

    def base(self, name: str) -> int | None:
        return self.before[name][0] if name in self.before else None

    def table(self, name: str) -> VersionedTable:
        return self.lake.versioned(name)

    def read(self, name: str, parts=None) -> DataFrame:
        """A table as this build leaves it."""
        version = self.after[name][0]
        if name == "snap_customers":
            return customer_history(self.lake).read_at(version)
        return self.table(name).read(version, parts)

    def current(self, entity: str) -> DataFrame:
        return live_rows(self.read(f"state_{entity}"), entity)

    def put(self, name: str, version: int, note: str | None = None) -> None:
        self.after[name] = (version, note)

    def rewrite(self, name: str, rows: DataFrame, part: Column | None = None, note: str | None = None) -> None:
        self.put(name, self.table(name).write(self.number, rows, F.lit("all") if part is None else part), note)

    def replace(self, name: str, rows: DataFrame, keys: DataFrame, key: str, part: Column, note: str | None = None) -> None:
        self.put(name, self.table(name).replace_keys(self.base(name), self.number, rows, keys, key, part), note)

    # ---- steps --------------------------------------------------------------

    def run(self) -> dict[str, DataFrame]:
        for name, (rows, mark) in self.fresh().items():
            self.merge(name, rows, mark)
        if self.stale("dim_customers"):
            history = customer_history(self.lake)
            merged = history.merge(self.current("customers"), self.now, base=self.base("snap_customers") or 0)
            self.put("snap_customers", merged)
            self.rewrite("dim_customers", star.dim_customers(self.read("snap_customers")))
        if self.stale("dim_products"):
            self.rewrite("dim_products", star.dim_products(self.current("products")))
        self.orders()
        self.items()
        self.dated("payments", "payment_id", star.fact_payments)
        self.dated("shipments", "shipment_id", star.fact_shipments)
        if self.stale("mart_customer_value"):
            self.rewrite("mart_customer_value", marts.mart_customer_value(self.read("dim_customers"), self.read("fact_orders")))
        if self.stale("mart_product_performance"):
            self.rewrite("mart_product_performance", marts.mart_product_performance(
                self.read("dim_products"), self.read("fact_order_items")))
        if DAILY in self.wanted:
            self.daily()
        return self.tables()

    def fresh(self) -> dict[str, tuple[DataFrame, int | None]]:
        """Raw rows loaded since an entity was last merged, with the newest load time among them; entities without any are
        left out, but for those that have no state yet."""
        raw = self.lake.read("raw", "bronze_events")
        mine: dict[str, Column] = {}
        for name in self.entities:
            mark = self.before.get(f"state_{name}", (None, None))[1]
            own = F.col("source_table") == name
            mine[name] = own if mark is None else own & (F.col("warehouse_loaded_at") > F.timestamp_micros(F.lit(int(mark))))
        rows = raw.filter(reduce(lambda a, b: a | b, mine.values()))
        found = rows.groupBy("source_table").agg(F.max(F.unix_micros("warehouse_loaded_at")).alias("mark")).collect()
        marks = {row["source_table"]: row["mark"] for row in found}
        return {name: (raw.filter(own), marks.get(name)) for name, own in mine.items() if name in marks or f"state_{name}" not in self.before}

    def merge(self, name: str, rows: DataFrame, mark: int | None) -> None:
        """Merges fresh rows into the state of an entity, which remembers when they were loaded."""
        table = StateTable(self.table(f"state_{name}"), ENTITIES[name].key, self.state_parts)
        version, self.changes[name] = table.merge(self.base(f"state_{name}"), self.number, typed_events(normalised_events(rows), name))
        self.put(f"state_{name}", version, None if mark is None else str(mark))

    def stale(self, name: str) -> bool:
        """Whether a wanted table has to be looked at."""
        return name in self.wanted and (name not in self.before or any(entity in self.changes for entity in MADE_OF[name]))

    def anew(self, name: str) -> bool:
        """Whether all its rows are new."""
        return name not in self.before or any(entity in self.changes and self.changes[entity] is None for entity in MADE_OF[name])

    def changed(self, entity: str, column: str) -> DataFrame | None:
        return ids(self.changes[entity], f"new.{column}") if entity in self.changes else None

    def orders(self) -> None:
        """Orders that changed, and those of customers that did: another version may be valid for them."""
        if not self.stale("fact_orders"):
            return
        current, customers = self.current("orders"), self.read("dim_customers")
        part = month_part("order_month")
        if self.anew("fact_orders"):
            return self.rewrite("fact_orders", star.fact_orders_interleaved(current, customers), part)
        keys = self.changed("orders", "order_id")
        moved = self.changed("customers", "customer_id")
        if moved is not None:
            theirs = current.join(moved, "customer_id", "left_semi").select("order_id")
            keys = theirs if keys is None else keys.union(theirs).distinct()
        keys = stored(keys, "changed_orders")
        self.replace("fact_orders", star.fact_orders_interleaved(only(current, keys, "order_id"), customers), keys, "order_id", part)
        drop_stored(keys)

    def items(self) -> None:
        """Lines that changed, and those of products that came or went."""
        if not self.stale("fact_order_items"):
            return
        current, products = self.current("order_items"), self.read("dim_products")
        part = F.concat(F.lit("h"), F.pmod(F.xxhash64("order_item_id"), F.lit(self.state_parts)).cast("string"))
        if self.anew("fact_order_items"):
            return self.rewrite("fact_order_items", star.fact_order_items(current, products), part)
        keys = self.changed("order_items", "order_item_id")
        if "products" in self.changes:
            came = F.col("old").isNull() | (F.col("old.is_deleted") != F.col("new.is_deleted"))
            theirs = current.join(ids(self.changes["products"].filter(came), "new.product_id"), "product_id", "left_semi")
            theirs = theirs.select("order_item_id")
            keys = theirs if keys is None else keys.union(theirs).distinct()
        keys = stored(keys, "changed_items")
        self.replace("fact_order_items", star.fact_order_items(only(current, keys, "order_item_id"), products), keys, "order_item_id", part)
        drop_stored(keys)

    def dated(self, entity: str, key: str, fact) -> None:
        """Payments or shipments, which lie in the month of their order: those that changed and those whose order came,
        went or moved to another month."""
        name = f"fact_{entity}"
        if not self.stale(name):
            return
        month = month_part("order_month")
        placed = self.read("fact_orders").select(F.col("order_key").alias("_order"), month.alias(PART))

        def with_month(rows: DataFrame) -> DataFrame:
            joined = fact(rows).join(placed, F.col("order_key") == F.col("_order"), "left").drop("_order")
            return joined.withColumn(PART, F.coalesce(PART, F.lit("none")))

        current = self.current(entity)
        if self.anew(name):
            return self.rewrite(name, with_month(current), F.col(PART))
        keys = self.changed(entity, key)
        if "orders" in self.changes:
            month_of = lambda side: F.when(~F.col(f"{side}.is_deleted"), F.trunc(F.to_date(f"{side}.ordered_at"), "month"))
            there = F.col("old").isNotNull() & (F.col("old.is_deleted") == F.col("new.is_deleted"))
            moved = self.changes["orders"].filter(~there | ~month_of("old").eqNullSafe(month_of("new")))
            theirs = current.join(ids(moved, "new.order_id"), "order_id", "left_semi").select(key)
            keys = theirs if keys is None else keys.union(theirs).distinct()
        keys = stored(keys, f"changed_{entity}")
        self.replace(name, with_month(only(current, keys, key)), keys, key, F.col(PART))
        drop_stored(keys)

    def daily(self) -> None:
        """The daily mart: the days of the window from their months alone, or every day where a fact has changed since all
        were last rebuilt."""
        changed = self.stale(DAILY)
        if self.start is None:
            if changed or self.before[DAILY][1] == NARROWED:
                facts = [self.read(f"fact_{n}") for n in ("orders", "payments", "shipments")]
                self.rewrite(DAILY, marts.mart_daily(*facts, run_id=self.run_id), month_part("order_date"), WHOLE)
            return
        parts = months(self.start, self.end)
        facts = [self.read(f"fact_{n}", parts) for n in ("orders", "payments", "shipments")]
        days = stored(marts.mart_daily(*facts, self.start, self.end, self.run_id), "days")
        others_stale = self.anew(DAILY) or changed or self.before[DAILY][1] == NARROWED
        self.replace(DAILY, days, days, "order_date", month_part("order_date"), NARROWED if others_stale else WHOLE)
        drop_stored(days)

    # ---- results ------------------------------------------------------------

    def tables(self) -> dict[str, DataFrame]:
        """Every table as this build leaves it."""
        found = {f"current_{name}": self.current(name) for name in ENTITIES if f"state_{name}" in self.after}
        return found | {name: self.read(name) for name in ("snap_customers", *MADE_OF) if name in self.after}

    def changed_tables(self) -> set[str]:
        """Names, as in ``tables``, of what is not as in the last published build."""
        new = {name for name, (version, _) in self.after.items() if self.before.get(name, (None, None))[0] != version}
        return {name.replace("state_", "current_") for name in new} | ({"bronze_events", "stg_bronze_events"} if self.changes else set())

    def publish(self) -> None:
        """Makes this build what readers see."""
        if self.after != self.before:
            self.publication.commit(self.number, self.after)


def built_until(lake: Lake) -> int:
    """The newest load time, in microseconds, that a published build has taken in."""
    notes = [note for name, (_, note) in lake.publication().tables().items() if name.startswith("state_") and note]
    return max(map(int, notes), default=0)


def expire(lake: Lake, keep: int = 3) -> int:
    """Drops folders that only builds before the last ``keep`` needed; returns how many."""
    publication = lake.publication()
    names = [name for name in publication.tables() if name != "snap_customers"]
    return publication.expire({name: lake.versioned(name) for name in names}, keep)
