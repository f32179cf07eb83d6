"""How strongly a user has shown interest in a sku. One aggregate per operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..params import RecParams
from ..sources.bags import CART_EVENTS, ORDER_EVENTS, VIEW_EVENTS

KEYS = ("user_id", "sku")


def _is(kind) -> Column:
    names = {"order": ORDER_EVENTS, "cart": CART_EVENTS, "view": VIEW_EVENTS}[kind]
    return F.upper("event_name").isin(*names)


def _weight(order: float, cart: float, view: float) -> Column:
    return F.when(_is("order"), order).when(_is("cart"), cart).when(_is("view"), view).otherwise(0.0)


def intent_strongest(staged: DataFrame, p: RecParams, skus: DataFrame | None = None) -> DataFrame:
    """Score of the strongest signal only (order, else cart, else view), eligible skus only."""
    c = staged.groupBy(*KEYS).agg(
        F.count_if(_is("order")).alias("orders"), F.count_if(_is("cart")).alias("carts"),
        F.count_if(_is("view")).alias("views"))
    if skus is not None:
        c = c.join(skus.select("sku").distinct(), "sku", "left_semi")
    return c.withColumns({
        "intent": F.when(F.col("orders") > 0, X.log_score("orders", p.order_weight))
        .when(F.col("carts") > 0, X.log_score("carts", p.cart_weight))
        .when(F.col("views") > 0, X.log_score("views", p.view_weight)).otherwise(0.0),
        "intent_type": F.when(F.col("orders") > 0, "order").when(F.col("carts") > 0, "cart")
        .when(F.col("views") > 0, "view").otherwise("none"),
    })


def intent_level(users: DataFrame, intent: DataFrame) -> DataFrame:
    """Per user the strongest kind of signal: hot (order), warm (cart), cool (view), cold."""
    best = intent.groupBy("user_id").agg(
        F.max((F.col("intent_type") == "order").cast("int")).alias("o"),
        F.max((F.col("intent_type") == "cart").cast("int")).alias("c"),
        F.max((F.col("intent_type") == "view").cast("int")).alias("v"))
    return users.select("user_id").join(best, "user_id", "left").select(
        "user_id", F.when(F.col("o") == 1, "hot").when(F.col("c") == 1, "warm").when(F.col("v") == 1, "cool")
        .otherwise("cold").alias("level"))


def intent_sum(staged: DataFrame, p: RecParams) -> DataFrame:
    """Ln 2 times the weight of every event, summed."""
    w = _weight(p.order_weight, p.cart_weight, p.view_weight)
    return staged.groupBy(*KEYS).agg((F.sum(w) * F.log1p(F.lit(1.0))).alias("intent"))


def intent_decayed(staged: DataFrame, p: RecParams, as_of: str, halflife: float = 30.0,
                   order: float | None = None, cart: float | None = None, view: float | None = None,
                   floor: bool = False) -> DataFrame:
    """Event weights halved every ``halflife`` days; backtest weights may be negative, floored at 0."""
    w = _weight(p.order_weight if order is None else order, p.cart_weight if cart is None else cart,
                p.view_weight if view is None else view)
    days = F.datediff(F.lit(as_of).cast("date"), F.to_date("event_ts"))
    total = F.sum(w * F.pow(F.lit(0.5), days / F.lit(halflife)))
    return staged.groupBy(*KEYS).agg((F.greatest(total, F.lit(0.0)) if floor else total).alias("intent"))


def intent_strength(staged: DataFrame, p: RecParams) -> DataFrame:
    """Plain sum of event weights, positive only."""
    w = _weight(p.order_weight, p.cart_weight, p.view_weight)
    return staged.groupBy(*KEYS).agg(F.sum(w).alias("strength")).where("strength > 0")
