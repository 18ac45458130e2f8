"""Shop entities read from an order-processing star schema in parquet.

``Shop`` gives clean typed core tables; ``Shop.staged`` gives all-text landing
rows with the defects that promotion has to find.  Every frame covers the whole
source table.  The rules below are fixed values shared with the SQL checks.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlane.schemas import CORE, columns_of

FIRST_DAY = "1995-01-01"
REGISTRATION_DAYS = 1800
CATALOGUE_DAYS = 1500
CATEGORY_BASE = 101
CATEGORY_BUCKETS = 27  # two more than there are categories: those products have none
AGE_GROUPS = ["18-24", "25-34", "35-44", "45+"]
STATUS = {"F": "completed", "O": "returned", "P": "cancelled"}
PAYMENT_STATUS = {"completed": "succeeded", "returned": "refunded", "cancelled": "failed"}
UNPAID_PRIORITY = "5-LOW"  # cancelled orders of this priority never reach payment
EVENT_TYPE = {"click": "cart"}


def _mapped(column: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    case = None
    for value, text in mapping.items():
        case = F.when(column == value, text) if case is None else case.when(column == value, text)
    return case if default is None else case.otherwise(default)


def _money(c: Column) -> Column:
    return c.cast("decimal(12,2)")


class Shop:
    """Lazy frames over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- typed core ---------------------------------------------------------

    @cached_property
    def categories(self) -> DataFrame:
        roots = self.table("region").select(
            (F.col("r_regionkey") + 1).cast("int").alias("category_id"),
            F.col("r_name").alias("name"),
            F.lit(None).cast("int").alias("parent_id"),
        )
        leaves = self.table("nation").select(
            (F.col("n_nationkey") + CATEGORY_BASE).cast("int").alias("category_id"),
            F.col("n_name").alias("name"),
            (F.col("n_regionkey") + 1).cast("int").alias("parent_id"),
        )
        return roots.unionByName(leaves)

    @cached_property
    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        age = F.element_at(F.array(*map(F.lit, AGE_GROUPS)), (F.pmod(key, F.lit(4)) + 1).cast("int"))
        joined = self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        return joined.select(
            key.cast("string").alias("user_id"),
            F.concat(F.lit("user"), key.cast("string"), F.lit("@shop.example")).alias("email"),
            F.col("c_name").alias("full_name"),
            F.date_add(
                F.lit(FIRST_DAY).cast("date"), F.pmod(key, F.lit(REGISTRATION_DAYS)).cast("int")
            ).alias("registration_date"),
            F.col("c_mktsegment").alias("acquisition_channel"),
            F.col("n_name").alias("city"),
            age.alias("age_group"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
        )

    @cached_property
    def products(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        slot = F.pmod(size, F.lit(CATEGORY_BUCKETS))
        price = _money(F.col("p_retailprice"))
        added = F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(key, F.lit(CATALOGUE_DAYS)).cast("int"))
        rating = F.pmod(size, F.lit(5)).cast("decimal(2,0)") + F.lit("0.5").cast("decimal(2,1)")
        return self.table("part").select(
            key.cast("string").alias("product_id"),
            F.col("p_name").alias("name"),
            F.when(slot < 25, slot + CATEGORY_BASE).cast("int").alias("category_id"),
            price.alias("price"),
            (price * F.lit("0.6").cast("decimal(2,1)")).cast("decimal(12,2)").alias("cost_price"),
            F.when(F.pmod(size, F.lit(10)) != 0, rating).cast("decimal(3,2)").alias("rating"),
            (size != 13).alias("is_available"),
            added.cast("timestamp_ntz").alias("created_at"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        total = _money(F.col("o_totalprice"))
        discounted = F.pmod(key, F.lit(7)) == 0
        discount = F.when(discounted, F.round(total * F.lit("0.10").cast("decimal(3,2)"), 2)).otherwise(0)
        return self.table("orders").select(
            key.cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("user_id"),
            self._order_time().alias("created_at"),
            _mapped(F.col("o_orderstatus"), STATUS).alias("status"),
            F.col("o_orderpriority").alias("payment_method"),
            total.alias("total_amount"),
            _money(discount).alias("discount_amount"),
            F.when(discounted, "PROMO7").alias("promo_code"),
        )

    @staticmethod
    def _order_time() -> Column:
        seconds = F.pmod(F.col("o_orderkey"), F.lit(86400))
        return F.col("o_orderdate") + F.make_dt_interval(secs=seconds)

    @cached_property
    def order_items(self) -> DataFrame:
        """One row per source line; line ids repeat in the source."""
        return self.table("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            _money(F.col("l_extendedprice")).alias("unit_price"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        status = _mapped(F.col("o_orderstatus"), STATUS)
        delay = F.make_dt_interval(secs=F.pmod(F.col("o_orderkey"), F.lit(595)) + 5)
        paid = self.table("orders").where(
            (F.col("o_orderstatus") != "P") | (F.col("o_orderpriority") != UNPAID_PRIORITY)
        )
        return paid.select(
            F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("payment_id"),
            F.col("o_orderkey").cast("string").alias("order_id"),
            _money(F.col("o_totalprice")).alias("amount"),
            F.col("o_orderpriority").alias("method"),
            _mapped(status, PAYMENT_STATUS).alias("status"),
            (self._order_time() + delay).alias("processed_at"),
        )

    @cached_property
    def raw_events(self) -> DataFrame:
        """Events with their sub-second times; a session is one user's day."""
        user = F.col("user_id").cast("string")
        return self.table("events").select(
            user.alias("user_id"),
            F.concat_ws("/", user, F.to_date("ts").cast("string")).alias("session_id"),
            F.get_json_object("props", "$.k").alias("product_id"),
            _mapped(F.col("event_type"), EVENT_TYPE, F.col("event_type")).alias("event_type"),
            F.col("ts").alias("created_at"),
        )

    # ---- all-text landing rows ----------------------------------------------

    def staged(self, entity: str) -> DataFrame:
        """Landing rows of one entity with injected defects, stamped with their day."""
        return getattr(self, f"_staged_{entity}")()

    @staticmethod
    def _land(rows: DataFrame, entity: str, day: Column, **changed: Column) -> DataFrame:
        """Turn typed rows into text; ``changed`` replaces columns by defects."""
        columns = columns_of(CORE[entity])
        text = [changed.get(c, F.col(c)).cast("string").alias(c) for c in columns]
        landed = rows.select(*text, day.alias("_source_date"))
        return landed.select(
            *columns,
            "_source_date",
            F.col("_source_date").cast("timestamp_ntz").alias("_loaded_at"),
            F.lit("batch-1").alias("_batch_id"),
        )

    @staticmethod
    def _deliveries(rows: DataFrame, repeated: Column) -> DataFrame:
        """Add ``copy`` 0 for every row and a further row with 1 where ``repeated``."""
        copies = F.when(repeated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return rows.withColumn("copy", F.explode(copies))

    def _staged_categories(self) -> DataFrame:
        as_float = lambda c: F.concat(F.col(c).cast("string"), F.lit(".0"))
        return self._land(
            self.categories, "categories", F.lit(FIRST_DAY).cast("date"),
            category_id=as_float("category_id"),
            parent_id=F.coalesce(as_float("parent_id"), F.lit("")),
        )

    def _staged_users(self) -> DataFrame:
        key = F.col("user_id").cast("bigint")
        rows = self._deliveries(self.users, F.pmod(key, F.lit(5)) == 0)
        again = F.col("copy") == 1
        return self._land(
            rows, "users", F.date_add("registration_date", F.col("copy") * 400),
            email=F.when(again, F.concat(F.lit("new-"), F.col("email"))).otherwise(F.col("email")),
            city=F.when(again, F.lit("Elsewhere")).otherwise(F.col("city")),
            is_active=F.col("is_active") != again,
        )

    def _staged_products(self) -> DataFrame:
        key = F.col("product_id").cast("bigint")
        rows = self._deliveries(self.products, F.pmod(key, F.lit(4)) == 0)
        again = F.col("copy") == 1
        category = F.concat(F.col("category_id").cast("string"), F.lit(".0"))
        return self._land(
            rows, "products", F.date_add(F.to_date("created_at"), F.col("copy") * 300),
            category_id=F.coalesce(category, F.lit("")),
            name=F.when(again, F.concat(F.col("name"), F.lit(" II"))).otherwise(F.col("name")),
            price=_money(F.col("price") + F.col("copy") * 10),
        )

    def _staged_orders(self) -> DataFrame:
        key = F.col("order_id").cast("bigint")
        divides = lambda n: F.pmod(key, F.lit(n)) == 0
        rows = self._deliveries(self.orders, divides(50) | divides(111))
        again = F.col("copy") == 1
        later = again & divides(111)  # delivered again the next day
        retry = F.make_dt_interval(mins=F.when(again & ~later, 10).otherwise(0))
        user = (
            F.when(divides(97), F.lit(None).cast("string"))
            .when(divides(131), F.concat(F.lit("ghost-"), F.col("user_id")))
            .otherwise(F.col("user_id"))
        )
        return self._land(
            rows, "orders",
            F.date_add(F.to_date("created_at"), F.when(later, 1).otherwise(0)),
            user_id=user,
            created_at=F.col("created_at") + retry,
            discount_amount=F.when(F.col("discount_amount") > 0, F.col("discount_amount").cast("string")).otherwise(""),
            promo_code=F.coalesce("promo_code", F.lit("")),
        )

    def _staged_order_items(self) -> DataFrame:
        lines = self.table("lineitem")
        part, supplier = F.col("l_partkey"), F.col("l_suppkey")
        product = (
            F.when(F.pmod(part, F.lit(83)) == 0, F.lit(None).cast("string"))
            .when(F.pmod(part, F.lit(89)) == 0, F.concat(F.lit("ghost-"), part.cast("string")))
            .otherwise(part.cast("string"))
        )
        quantity = F.col("l_quantity").cast("int")
        rows = lines.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            product.alias("product_id"),
            F.when(F.pmod(supplier, F.lit(53)) == 0, -quantity).otherwise(quantity).alias("quantity"),
            _money(F.col("l_extendedprice")).alias("unit_price"),
            F.to_date("l_shipdate").alias("day"),
        )
        return self._land(rows, "order_items", F.col("day"))

    def _staged_payments(self) -> DataFrame:
        return self._land(self.payments, "payments", F.to_date("processed_at"))
