"""Property bags to flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.keyed import latest_by

BAG_ENTRY = "struct<property_name:string,string_value:string,long_value:bigint,double_value:double>"

# ---- fixed values: event names and property-name patterns of the event feed ----
ORDER_EVENTS = ("PLACED ORDER", "ORDERED PRODUCT", "CONSUMER WEBSITE ORDER")
CART_EVENTS = ("CART UPDATE",)
VIEW_EVENTS = ("VIEWED PRODUCT",)
DIRECT_SKU_EVENTS = ("VIEWED PRODUCT", "ORDERED PRODUCT")
ITEM_SKU_EVENTS = ("CART UPDATE", "PLACED ORDER")
LIST_SKU_EVENTS = ("CONSUMER WEBSITE ORDER",)
DIRECT_SKU = "^prod(?:uct)?id$"
ITEM_SKU = r"^items_([0-9]+)\.productid$"
LIST_SKU = "^skus_([0-9]+)$"
ITEM_PRICE = r"^items_([0-9]+)\.itemprice$"
ITEM_IMAGE = r"^items_([0-9]+)\.imageurl$"
MAIN_PRICE = ("price", "itemprice")
MAIN_IMAGE = "imageurl"
CONSENT_YES = ("subscribed", "true", "1")
# ---------------------------------------------------------------------------------


def explode_props(df: DataFrame, bag: str = "props") -> DataFrame:
    """One row per bag entry, as struct column ``p``."""
    return df.withColumn("p", F.explode(bag)).drop(bag)


def latest_attributes(attrs: DataFrame, bag: str = "props") -> DataFrame:
    """Newest value per (user, property), pivoted; users lacking any key are dropped.

    One map-side combined aggregate picks the newest value of each property (by update
    time, then ingest time), so a user with very many snapshots costs no more than others.
    """
    flat = explode_props(attrs, bag).select(
        "user_id", F.lower("p.property_name").alias("name"), X.prop_text("p").alias("text"),
        F.col("p.string_value").alias("string_only"), F.struct("update_ts", "ingest_ts").alias("age"),
    ).where(F.col("name").isin("email", "v1_year", "v1_make", "v1_model"))

    def newest(key, value):
        return F.nullif(latest_by(value, F.col("age"), F.col("name") == key), F.lit(""))

    wide = flat.groupBy("user_id").agg(
        newest("email", X.norm_lower("string_only")).alias("email"),
        newest("v1_year", F.trim("text")).alias("year_text"),
        newest("v1_make", X.norm_upper("text")).alias("make"),
        newest("v1_model", X.norm_upper("text")).alias("model"),
    )
    return wide.withColumn("year", F.col("year_text").try_cast("int")).where(
        "email is not null and year is not null and make is not null and model is not null"
    ).drop("year_text")


def pivot_attributes(attrs: DataFrame, keys, bag: str = "props") -> DataFrame:
    """Largest text per property and user, whatever its age."""
    flat = explode_props(attrs, bag).select(
        "user_id", F.lower("p.property_name").alias("name"), X.norm_upper(X.prop_text("p")).alias("text"))
    return flat.where(F.col("name").isin(*keys)).groupBy("user_id").agg(
        *[F.max(F.when(F.col("name") == k, F.col("text"))).alias(k) for k in keys])


def stage_events(events: DataFrame, bag: str = "props") -> DataFrame:
    """Sku, price and image per item of each product event.

    Properties of the same numbered item belong together; a property without a number
    describes the event. The value of an item wins over the value of the event.
    """
    flat = explode_props(events, bag).select(
        "user_id", "event_ts", F.upper("event_name").alias("event_name"), "p",
        F.lower("p.property_name").alias("name"))
    flat = flat.where(F.col("event_name").isin(*ORDER_EVENTS, *CART_EVENTS, *VIEW_EVENTS))

    def index(pattern):
        return F.nullif(F.regexp_extract("name", pattern, 1), F.lit(""))

    is_sku = (
        (F.col("event_name").isin(*DIRECT_SKU_EVENTS) & F.col("name").rlike(DIRECT_SKU))
        | (F.col("event_name").isin(*ITEM_SKU_EVENTS) & F.col("name").rlike(ITEM_SKU))
        | (F.col("event_name").isin(*LIST_SKU_EVENTS) & F.col("name").rlike(LIST_SKU))
    )
    number = F.coalesce(F.col("p.double_value"), F.col("p.string_value").try_cast("double"))
    is_price = F.col("name").isin(*MAIN_PRICE) | F.col("price_idx").isNotNull()
    is_image = (F.col("name") == MAIN_IMAGE) | F.col("image_idx").isNotNull()
    flat = flat.withColumns({
        "sku_idx": F.coalesce(index(ITEM_SKU), index(LIST_SKU)),
        "price_idx": index(ITEM_PRICE), "image_idx": index(ITEM_IMAGE),
    }).select(
        "user_id", "event_ts", "event_name", "price_idx", "image_idx",
        F.coalesce("sku_idx", "price_idx", "image_idx").alias("item"),
        F.when(is_sku, X.norm_upper(X.prop_text("p"))).alias("sku"),
        F.when(is_price, number).alias("price"),
        F.when(is_image, F.col("p.string_value")).alias("image"),
    )

    def pick(value, idx):
        own = F.max(F.when(F.col(idx).isNotNull(), F.col(value)))
        return F.coalesce(own, F.max(F.when(F.col(idx).isNull(), F.col(value))))

    return flat.groupBy("user_id", "event_ts", "event_name", "item").agg(
        F.max("sku").alias("sku"), pick("price", "price_idx").alias("price"),
        pick("image", "image_idx").alias("image_raw"),
    ).where("sku is not null").select("user_id", "sku", "event_ts", "event_name", "price", "image_raw")


def stage_events_simple(events: DataFrame, bag: str = "props") -> DataFrame:
    """One row per (user, sku, time, event) with the largest price and image of the event."""
    flat = explode_props(events, bag).withColumn("name", F.lower("p.property_name"))
    text = X.norm_upper(X.prop_text("p"))
    is_sku = F.col("name").rlike(DIRECT_SKU) | F.col("name").rlike(ITEM_SKU) | F.col("name").rlike(LIST_SKU)
    is_price = F.col("name").isin(*MAIN_PRICE) | F.col("name").rlike(ITEM_PRICE)
    is_image = (F.col("name") == MAIN_IMAGE) | F.col("name").rlike(ITEM_IMAGE)
    per_event = flat.groupBy("user_id", "event_ts", F.upper("event_name").alias("event_name")).agg(
        F.collect_set(F.when(is_sku, text)).alias("skus"),
        F.max(F.when(is_price, F.coalesce(F.col("p.double_value"), F.col("p.string_value").try_cast("double")))).alias("price"),
        F.max(F.when(is_image, F.col("p.string_value"))).alias("image_raw"))
    return per_event.select("user_id", F.explode("skus").alias("sku"), "event_ts", "event_name", "price", "image_raw")
