"""Which products may be recommended for which vehicle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.indexing import durable
from ..functions.keyed import SMALL, global_top
from ..params import RecParams


def sku_prices(staged: DataFrame) -> DataFrame:
    """Largest price seen and number of observations per sku."""
    return staged.where("sku is not null").groupBy("sku").agg(
        F.max("price").alias("price"), F.count(F.lit(1)).alias("observations"))


def sku_images(staged: DataFrame) -> DataFrame:
    """Newest image link per sku as https; skus whose newest link is not https are dropped."""
    seen = staged.where("sku is not null and image_raw is not null")
    newest = seen.groupBy("sku").agg(F.max_by("image_raw", F.struct("event_ts", "image_raw")).alias("image_raw"))
    return newest.select("sku", X.https_image("image_raw").alias("image_url")).where(X.image_ok("image_url"))


def sellable_products(catalog: DataFrame, prices: DataFrame, images: DataFrame, p: RecParams) -> DataFrame:
    """P04-P08 on one row per sku: goods with image, price and an accepted category.

    The gates run on products, before the much larger fitment table is touched.
    """
    cat = catalog.where("sku is not null").groupBy(X.norm_upper("sku").alias("sku")).agg(
        F.max("category").alias("category"), F.max(X.is_refurbished("tags")).alias("refurbished"))
    rows = images.join(prices.select("sku", "price"), "sku", "left").join(cat, "sku", "left")
    rows = rows.withColumn("category", F.coalesce("category", F.lit("UNKNOWN")))
    return rows.where(
        ~F.coalesce("refurbished", F.lit(False)) & ~X.is_service_sku("sku") & X.image_ok("image_url")
        & X.price_ok("price", p.min_price, p.allow_price_fallback) & ~X.is_commodity("category")
        & X.unknown_category_ok("category", "price", p.min_price)
    ).select("sku", "category", F.coalesce("price", F.lit(p.min_price)).alias("price"), "image_url")


def eligible_parts(fitment: DataFrame, products: DataFrame, vehicle, p: RecParams) -> DataFrame:
    """Sellable parts per vehicle, one row per (vehicle, sku), vehicles with enough parts only."""
    vehicle = list(vehicle)
    rows = fitment.select(*vehicle, "sku").dropna().distinct().join(products, "sku")
    enough = rows.groupBy(*vehicle).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= p.min_parts_per_vehicle)
    return rows.join(enough.drop("_n"), vehicle, "left_semi")


def parts_of_vehicles(fitment: DataFrame, products: DataFrame, vehicle, make: str, driven: DataFrame, p: RecParams) -> DataFrame:
    """D05 with one row per (make, sku): ``eligible_parts`` of the ``driven`` vehicles, these as an array of structs (``vehicles``).

    A part's vehicles are put together before the shuffle, so what travels follows the parts, not parts x vehicles.
    """
    rest = [c for c in vehicle if c != make]
    fits = fitment.select(*vehicle, "sku").dropna().groupBy(make, "sku").agg(F.collect_set(F.struct(*rest)).alias("vehicles"))
    rows = durable(fits.join(products, "sku"))
    single = rows.withColumn("_v", F.explode("vehicles")).drop("vehicles").withColumns({c: F.col(f"_v.{c}") for c in rest})
    enough = single.groupBy(*vehicle).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= p.min_parts_per_vehicle)
    kept = durable(enough.select(*vehicle).join(driven.select(*vehicle).distinct(), list(vehicle), "left_semi"))
    if kept.count() <= SMALL:
        kept = F.broadcast(kept)
    single = single.join(kept, list(vehicle), "left_semi").drop(*rest)
    return single.groupBy(*[c for c in rows.columns if c != "vehicles"]).agg(F.collect_list("_v").alias("vehicles"))


def universal_parts(fitment: DataFrame, products: DataFrame, popularity: DataFrame, n: int) -> DataFrame:
    """The n most ordered sellable products that are tied to no vehicle."""
    free = products.join(fitment.select("sku").distinct(), "sku", "left_anti")
    scored = free.join(popularity.select("sku", "total_orders"), "sku", "left").fillna(0, ["total_orders"])
    return global_top(scored, [F.desc("total_orders"), F.asc("sku")], n, "pool_rank")


def vehicle_parts_list(eligible: DataFrame, vehicle) -> DataFrame:
    """One row per vehicle with its part count and sorted sku array.

    The array is the operator's output; it is bounded by the catalogue, since ``eligible``
    has a (vehicle, sku) once.
    """
    return eligible.groupBy(*vehicle).agg(
        F.count(F.lit(1)).alias("total_count"), F.sort_array(F.collect_list("sku")).alias("parts"))
