"""The test tables seen through the canonical model of the engine.

Every frame is a lazy view of the parquet tables. Equi-joins only: fitment pairs each
make with the parts of its residue class.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.asof import asof_join
from .bags import BAG_ENTRY

DAY = 86400


def _sku(key) -> F.Column:
    key = X.col(key)
    return F.concat(
        F.lit("P"), F.floor(key / 2).cast("string"),
        F.when(key % 2 == 0, F.lit("B")).otherwise(F.lit("")),
    )


def bag(*entries) -> F.Column:
    """Property bag literal from (name, type, Column) triples; type is s, l or d."""
    made = []
    for name, kind, value in entries:
        made.append(F.struct(
            (F.lit(name) if isinstance(name, str) else name).alias("property_name"),
            (value.cast("string") if kind == "s" else F.lit(None).cast("string")).alias("string_value"),
            (value.cast("long") if kind == "l" else F.lit(None).cast("long")).alias("long_value"),
            (value.cast("double") if kind == "d" else F.lit(None).cast("double")).alias("double_value"),
        ))
    return F.array(*made).cast(f"array<{BAG_ENTRY}>")


class Tables:
    """Canonical frames of one test directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._raw[name]

    # ---- recommendation side -------------------------------------------------
    @cached_property
    def users(self) -> DataFrame:
        c, n = self.raw("customer"), self.raw("nation")
        return c.join(n, c.c_nationkey == n.n_nationkey).select(
            F.col("c_custkey").alias("user_id"), F.lower("c_name").alias("email"),
            (F.lit(2000) + F.col("c_custkey") % 10).cast("int").alias("seg_year"),
            F.col("n_name").alias("seg_make"), F.col("c_mktsegment").alias("seg_model"),
            F.col("c_acctbal").alias("balance"),
        )

    @cached_property
    def catalog(self) -> DataFrame:
        sku = _sku("p_partkey")
        return self.raw("part").select(
            F.col("p_partkey").alias("part_id"), sku.alias("sku"), F.col("p_type").alias("category"),
            F.when(F.col("p_size") == 50, "Sale,REFURBISHED").otherwise(F.col("p_brand")).alias("tags"),
            F.col("p_retailprice").alias("price"),
            F.concat(
                F.when(F.col("p_size") == 49, "ftp://").when(F.col("p_partkey") % 3 == 0, "//").otherwise("http://"),
                F.lit("img.example/"), F.col("p_partkey").cast("string"),
            ).alias("image_raw"),
            F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"),
        )

    @cached_property
    def fitment(self) -> DataFrame:
        n = self.raw("nation").select(
            F.col("n_name").alias("make"), F.pmod(-F.col("n_nationkey"), F.lit(5)).cast("long").alias("cls"))
        # parts of size 5 and below carry no fitment: they are the universal ones
        p = self.raw("part").where("p_size > 5").select(
            _sku("p_partkey").alias("sku"), F.pmod(F.floor(F.col("p_partkey") / 2), F.lit(5)).cast("long").alias("cls"))
        return n.join(p, "cls").select("make", "sku")

    @cached_property
    def orders(self) -> DataFrame:
        o, li = self.raw("orders"), self.raw("lineitem")
        amount = F.col("l_extendedprice").cast("decimal(15,2)") * (1 - F.col("l_discount").cast("decimal(5,2)"))
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
            _sku("l_partkey").alias("sku"), F.col("o_orderdate").alias("order_ts"),
            F.col("o_orderdate").cast("date").alias("order_date"), amount.alias("amount"),
            F.col("l_linenumber").alias("line"),
        )

    @cached_property
    def imported(self) -> DataFrame:
        """Orders keyed by email, as the text-date order feed delivers them."""
        return self.orders.join(self.users.select("user_id", "email"), "user_id").select(
            "email", "sku", "order_date", "order_id")

    @cached_property
    def events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("long")
        return self.raw("events").select(
            "event_id", "user_id", F.col("ts").cast("timestamp").alias("event_ts"), "event_type",
            F.when(F.col("event_type") == "view", "VIEWED PRODUCT").when(F.col("event_type") == "click", "CART UPDATE")
            .when(F.col("event_type") == "purchase", "PLACED ORDER").alias("event_name"),
            k.alias("k"), _sku(k).alias("sku"), F.col("value").alias("price"),
        )

    @cached_property
    def staged(self) -> DataFrame:
        """Product events (view, cart, order) with a sku."""
        return self.events.where(F.col("event_name").isNotNull()).select(
            "user_id", "sku", "event_ts", "event_name", "price", "event_id")

    @cached_property
    def event_bags(self) -> DataFrame:
        """The product events packed back into property bags, one naming style per type."""
        e = self.events.where(F.col("event_name").isNotNull())
        idx = (F.col("k") % 3).cast("string")
        view = bag(("ProductID", "s", F.lower("sku")), ("Price", "d", F.col("price")),
                   ("ImageURL", "s", F.concat(F.lit("//img.example/"), F.col("sku"))))
        cart = bag((F.concat(F.lit("Items_"), idx, F.lit(".ProductId")), "s", F.concat(F.lit(" "), F.col("sku"))),
                   (F.concat(F.lit("Items_"), idx, F.lit(".ItemPrice")), "s", F.col("price")),
                   (F.concat(F.lit("Items_"), idx, F.lit(".ImageUrl")), "s", F.concat(F.lit("http://img.example/"), F.col("sku"))))
        order = bag((F.concat(F.lit("Items_"), idx, F.lit(".ProductId")), "s", F.col("sku")),
                    ("Subtotal", "d", F.col("price")), ("OrderNo", "l", F.col("event_id")))
        return e.select(
            "user_id", F.initcap("event_name").alias("event_name"), "event_ts",
            F.when(F.col("event_type") == "view", view).when(F.col("event_type") == "click", cart)
            .otherwise(order).alias("props"),
        )

    @cached_property
    def attributes(self) -> DataFrame:
        """Two attribute snapshots per user: an old one with another model, then the current one."""
        u = self.users
        base = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
        new = bag(("Email", "s", F.concat(F.lit(" "), F.upper("email"))), ("v1_year", "l", F.col("seg_year")),
                  ("v1_make", "s", F.lower("seg_make")),
                  ("v1_model", "s", F.when(F.col("balance") < 0, "").otherwise(F.col("seg_model"))),
                  ("email_marketing_consent", "s", F.when(F.col("balance") > 7500, "subscribed").otherwise("no")))
        old = bag(("email", "s", F.col("email")), ("v1_year", "s", F.lit("19x9")),
                  ("v1_model", "s", F.when(F.col("balance") < 0, "").otherwise("OLD")))
        snap = F.explode(F.array(F.struct(base.alias("t"), old.alias("props")),
                                 F.struct((base + F.expr("INTERVAL 1 DAY")).alias("t"), new.alias("props")))).alias("s")
        return u.select("user_id", snap).select(
            "user_id", F.col("s.t").alias("update_ts"), F.col("s.t").alias("ingest_ts"), F.col("s.props").alias("props"))

    @cached_property
    def generations(self) -> DataFrame:
        """Two generations per make, derived from the nation table."""
        rows = F.array(
            F.struct(F.lit(2000).alias("year_start"), F.lit(2004).alias("year_end"), F.lit("G1").alias("generation")),
            F.struct(F.lit(2005).alias("year_start"), F.lit(2008).alias("year_end"), F.lit("G2").alias("generation")))
        n = self.raw("nation").select(F.col("n_name").alias("make"), F.explode(rows).alias("g"))
        return n.select("make", "g.year_start", "g.year_end", "g.generation")

    # ---- campaign side -------------------------------------------------------
    @cached_property
    def sends(self) -> DataFrame:
        k = F.col("k")
        return self.events.where("event_type = 'view'").select(
            F.col("event_id").alias("tracking_id"), "user_id", (k % 10).alias("treatment_id"),
            F.col("event_ts").alias("sent_ts"), (F.col("user_id") % 2).alias("arm_id"),
            (k % 3).alias("model_id"),
            F.when(k == 13, F.lit(-1.0)).otherwise(F.col("price") / 1000).alias("score"),
            F.when(k % 25 == 7, "TEST").otherwise("LIVE").alias("source"),
            F.when(k % 10 < 5, "Personalized").otherwise("Static").alias("treatment_type"),
            F.when(F.col("event_ts") < "2024-01-15", "p1").otherwise("p2").alias("period"),
        )

    @cached_property
    def treatment_store(self) -> dict[str, str]:
        """Connection to another database (in memory, of the driver's JVM) that has the names of live and retired treatments."""
        self.spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
        store = {"url": f"jdbc:derby:memory:{self.spark.sparkContext.applicationId}{abs(hash(self.path))};create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
        live = self.sends.select("treatment_id").distinct().withColumn("status", F.lit("live"))
        rows = live.unionByName(live.select((F.col("treatment_id") + 1000).alias("treatment_id"), F.lit("retired").alias("status")))
        rows = rows.withColumn("name", F.when(F.col("treatment_id") % 2 == 0, "POST PURCHASE mail").otherwise("weekly mail"))
        rows.write.format("jdbc").options(**store, dbtable="treatments", createTableColumnTypes="status VARCHAR(16), name VARCHAR(64)").mode("overwrite").save()
        return store

    @cached_property
    def interactions(self) -> DataFrame:
        """Clicks and signups as opens and clicks of the user's last send within 7 days."""
        e = self.events.where("event_type in ('click', 'signup')").select(
            "user_id", F.col("event_id").alias("interaction_id"), F.col("event_ts").alias("ts"),
            F.when(F.col("event_type") == "click", "VIEWED").otherwise("CLICKED").alias("type"))
        s = self.sends.select("user_id", "tracking_id", "treatment_id", "sent_ts")
        return asof_join(e, s, ["user_id"], "ts", "sent_ts", "tracking_id", 7 * DAY).drop("sent_ts")

    @cached_property
    def purchases(self) -> DataFrame:
        """Campaign-side orders: one row per purchase event with its value."""
        return self.events.where("event_type = 'purchase'").select(
            "user_id", F.col("event_id").alias("order_id"), F.col("event_ts").alias("order_ts"),
            F.col("price").cast("decimal(12,2)").alias("order_value"), "sku")

    @cached_property
    def deliveries(self) -> DataFrame:
        bad = self.events.where("event_type = 'error'").select(
            "user_id", F.to_date("event_ts").alias("day")).distinct().withColumn("bad", F.lit(True))
        s = self.events.where("event_type = 'view'").withColumn("day", F.to_date("event_ts"))
        reason = (F.when(F.col("k") % 4 == 0, "event limit reached").when(F.col("k") % 4 == 1, "provider API error")
                  .when(F.col("k") % 4 == 2, "UNAVAILABLE: try later").otherwise("mailbox full"))
        return s.join(bad, ["user_id", "day"], "left").select(
            "user_id", F.col("event_id").alias("tracking_id"), F.col("event_ts").alias("ts"),
            F.when(F.col("bad"), "DELIVERY_FAILED").otherwise("DELIVERY_SUCCESSFUL").alias("status"),
            F.when(F.col("bad"), reason).alias("failure_reason"))

    # ---- vectors -------------------------------------------------------------
    @cached_property
    def user_vectors(self) -> DataFrame:
        return self.raw("embeddings").where("label = 0").select(
            F.col("vec_id").alias("user_id"), F.col("embedding").alias("vec"))

    @cached_property
    def product_vectors(self) -> DataFrame:
        return self.raw("embeddings").where("label > 0").select(
            F.col("vec_id").alias("product_id"), F.col("embedding").alias("vec"), F.col("label").alias("label"))
