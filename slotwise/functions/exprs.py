"""Column -> Column helpers. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
SERVICE_PREFIXES = ("EXT", "GIFT", "WARRANTY", "SERVICE", "PREAUTH")
COLOUR_SUFFIX = "([0-9])[BRGP]$"
FINISH_SUFFIX = "(-KIT|-BLK|-POL|-CHR|-RAW|-[A-Z0-9]{1,2})$"
# part-type words that make a part a commodity, and the part types kept anyway
COMMODITY_WORDS = ("Gasket", "Decal", "Key", "Washer", "Clamp")
BOLT_KEPT = ("Engine Cylinder Head Bolt", "Engine Bolt Kit")
CAP_KEPT = ("Wheel Hub Cap", "Wheel Cap Set")
CAP_KEPT_WORD = "Distributor Cap"
WILSON_Z = 1.96
# -----------------------------------------------------------------------------


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_upper(c) -> Column:
    """Upper-cased, trimmed key text."""
    return F.upper(F.trim(col(c)))


def norm_lower(c) -> Column:
    """Lower-cased, trimmed key text."""
    return F.lower(F.trim(col(c)))


def normalize_variant(sku) -> Column:
    """Drop one colour letter after the final digit."""
    return F.regexp_replace(col(sku), COLOUR_SUFFIX, "$1")


def base_sku(sku) -> Column:
    """Drop the finish suffix, then the colour letter."""
    return normalize_variant(F.regexp_replace(col(sku), FINISH_SUFFIX, ""))


def base_sku_single(sku) -> Column:
    """D04, older form: one pattern that removes either suffix once."""
    return F.regexp_replace(
        F.regexp_replace(col(sku), "(-KIT|-BLK|-POL|-CHR|-RAW)$", ""), COLOUR_SUFFIX, "$1"
    )


def is_service_sku(sku) -> Column:
    """Skus that are not goods (extended warranty, gift card, ...)."""
    return col(sku).rlike("^(" + "|".join(SERVICE_PREFIXES) + ")-")


def is_commodity(category) -> Column:
    """Low-value categories, with the named exceptions."""
    c = col(category)
    out = F.lit(False)
    for word in COMMODITY_WORDS:
        out = out | c.contains(word)
    out = out | (c.contains("Bolt") & ~c.isin(*BOLT_KEPT))
    return out | (c.contains("Cap") & ~c.contains(CAP_KEPT_WORD) & ~c.isin(*CAP_KEPT))


def price_ok(price, floor: float, allow_fallback: bool = True) -> Column:
    """At or above the floor; a missing price counts as the floor if allowed."""
    p = col(price)
    ok = F.coalesce(p, F.lit(float(floor))) >= F.lit(float(floor))
    return ok if allow_fallback else ok & p.isNotNull()


def unknown_category_ok(category, price, floor: float, minimum: float = 3000.0) -> Column:
    """An UNKNOWN category is only kept at a high price."""
    return ~((col(category) == "UNKNOWN") & (F.coalesce(col(price), F.lit(float(floor))) < minimum))


def is_refurbished(tags) -> Column:
    """Tag text mentions refurbished, any case."""
    return F.lower(F.coalesce(col(tags), F.lit(""))).contains("refurbished")


def https_image(url) -> Column:
    """Protocol-relative and http image links become https."""
    u = col(url)
    return (
        F.when(u.startswith("//"), F.concat(F.lit("https:"), u))
        .when(F.lower(u).startswith("http://"), F.regexp_replace(u, "(?i)^http://", "https://"))
        .otherwise(u)
    )


def image_ok(url) -> Column:
    """Present and served over https."""
    return col(url).isNotNull() & col(url).startswith("https://")


def product_url(sku, root: str = "https://shop.example/products/") -> Column:
    """Product page link."""
    return F.concat(F.lit(root), col(sku))


# ---- property bags ----------------------------------------------------------
def prop_text(p="p") -> Column:
    """Text of a mixed-type property value."""
    p = col(p)
    return F.coalesce(p["string_value"], p["long_value"].cast("string"))


def prop_num(p="p") -> Column:
    """Number of a mixed-type property value."""
    p = col(p)
    return F.coalesce(
        p["double_value"], p["string_value"].try_cast("double"), p["long_value"].cast("double")
    )


def prop(bag, *keys: str) -> Column:
    """First entry with one of the names (earlier names win), without an explode."""
    def named(key):
        return lambda e: e["property_name"] == key

    found = [F.try_element_at(F.filter(col(bag), named(k)), F.lit(1)) for k in keys]
    return found[0] if len(found) == 1 else F.coalesce(*found)


# ---- numbers ----------------------------------------------------------------
def safe_div(a, b) -> Column:
    """NULL where the denominator is zero or missing."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def pct(a, b, digits: int = 2) -> Column:
    """Percentage with zero guard."""
    return F.round(safe_div(a, b) * 100, digits)


def log_score(n, weight: float) -> Column:
    """ln(1 + n) times a weight."""
    return F.log1p(col(n).cast("double")) * F.lit(float(weight))


def bucket(c, edges, labels) -> Column:
    """First label whose upper edge (exclusive) lies above the value; last label otherwise."""
    c = col(c)
    out = None
    for edge, label in zip(edges, labels):
        cond = c < F.lit(edge)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(labels[len(edges)])


def wilson(k, n, upper: bool) -> Column:
    """Wilson score bound for k successes out of n."""
    k, n = col(k).cast("double"), col(n).cast("double")
    z = F.lit(WILSON_Z)
    p = F.try_divide(k, n)
    z2n = F.try_divide(z * z, n)
    centre = p + z2n / 2
    margin = z * F.sqrt(F.try_divide(p * (1 - p), n) + z2n / n / 4)
    return (centre + margin if upper else centre - margin) / (1 + z2n)


def two_proportion_z(k1, n1, k2, n2) -> Column:
    """Z of the difference of two rates, unpooled standard error."""
    k1, n1, k2, n2 = (col(x).cast("double") for x in (k1, n1, k2, n2))
    p1, p2 = F.try_divide(k1, n1), F.try_divide(k2, n2)
    se = F.sqrt(F.try_divide(p1 * (1 - p1), n1) + F.try_divide(p2 * (1 - p2), n2))
    return F.try_divide(p2 - p1, se)


def significance(z) -> Column:
    """Two-sided label of a z value."""
    a = F.abs(col(z))
    return (
        F.when(a.isNull(), "n/a")
        .when(a >= 2.576, "99%")
        .when(a >= 1.96, "95%")
        .when(a >= 1.645, "90%")
        .otherwise("not significant")
    )


def beta_posterior(k, n, a0: float = 1.0, b0: float = 1.0) -> dict[str, Column]:
    """Beta posterior of a click rate."""
    k, n = col(k).cast("double"), col(n).cast("double")
    a, b = k + F.lit(a0), n - k + F.lit(b0)
    return {
        "alpha": a,
        "beta": b,
        "mean": a / (a + b),
        "stddev": F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))),
    }


def nig_posterior(k, n, ss=None, mu: float = 0.0, lam: float = 1.0, alpha: float = 1.0,
                  beta: float = 1.0, exact: bool = False) -> dict[str, Column]:
    """Normal-inverse-gamma posterior from the sufficient statistics of one arm.

    ``exact`` pairs the prior-mean term with the sample sum of squares (k*k/n),
    the textbook form; the default divides by the updated precision instead.
    """
    k, n = col(k).cast("double"), col(n).cast("double")
    ss = k if ss is None else col(ss).cast("double")
    lam_n = F.lit(lam) + n
    within = ss - F.coalesce(F.try_divide(k * k, n if exact else lam_n), F.lit(0.0))
    gap = F.coalesce(F.try_divide(k, n), F.lit(mu)) - F.lit(mu)
    alpha_n = F.lit(alpha) + n / 2
    beta_n = F.lit(beta) + within / 2 + F.lit(lam) * n * gap * gap / lam_n / 2
    var = beta_n / (lam_n * (alpha_n - 0.5))
    return {
        "mu": (F.lit(lam * mu) + k) / lam_n,
        "lam": lam_n,
        "alpha": alpha_n,
        "beta": beta_n,
        "stddev": F.when(alpha_n <= 0.5, F.lit(float("inf"))).otherwise(F.sqrt(F.greatest(var, F.lit(0.0)))),
    }


def hash_uniform(*cols, salt: int = 0) -> Column:
    """Uniform in (0, 1), a pure function of its inputs (stable under repartition and retry).

    The first 13 hex digits of an MD5, so that any engine can state the same draw.
    """
    text = F.concat_ws(":", *[col(c).cast("string") for c in cols], F.lit(str(salt)))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def hash_normal(*cols, salt: int = 0) -> Column:
    """Standard normal from two hash uniforms (Box-Muller)."""
    import math

    u, v = hash_uniform(*cols, salt=salt), hash_uniform(*cols, salt=salt + 1)
    return F.sqrt(-2 * F.log(u)) * F.cos(F.lit(2 * math.pi) * v)


def dot(a, b) -> Column:
    """Inner product of two float arrays, accumulated in double."""
    return F.aggregate(
        F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0), lambda s, x: s + x,
    )


def week_sunday(d) -> Column:
    """Sunday that starts the week."""
    return F.date_sub(F.next_day(col(d), "SUN"), 7)


def hours_between(a, b) -> Column:
    """Whole hours from a to b (truncated toward zero)."""
    return F.timestamp_diff("HOUR", col(a), col(b))


def minutes_between(a, b) -> Column:
    return F.timestamp_diff("MINUTE", col(a), col(b))


def order_year(text, first: int, last: int) -> Column:
    """Four-digit year of the centuries of first..last found in a date text, NULL if none."""
    centuries = "|".join(str(c) for c in range(first // 100, last // 100 + 1))
    return F.nullif(F.regexp_extract(col(text), rf"\b((?:{centuries})[0-9]{{2}})\b", 1), F.lit("")).try_cast("int")


def parse_long_date(text) -> Column:
    """S09: 'Friday, January 10, 2025' to a date; NULL when it does not parse."""
    return F.try_to_date(F.regexp_replace(col(text), "^[A-Za-z]+, ", ""), "MMMM d, yyyy")


def salted_id(c, salt: str) -> Column:
    """First 16 hex digits of the salted SHA-256 of a normalised id; NULL stays NULL."""
    return F.substring(F.sha2(F.concat(F.lit(salt + ":"), norm_lower(c)), 256), 1, 16)


def score_interaction(kind) -> Column:
    """Base weight of an interaction type."""
    k = col(kind)
    return F.when(k == "order", 5.0).when(k == "cart", 3.0).when(k == "view", 1.0)
