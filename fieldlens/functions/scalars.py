"""Small scalar rules shared by the loaders and the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlens.functions.projection import let

# Multipliers and modulus of the stable cell hash.
HASH_SEED_FACTOR = 73856093
HASH_I_FACTOR = 19349663
HASH_J_FACTOR = 83492791
HASH_MODULUS = 100000

# Words that mark agricultural land use, and the properties they are looked up in.
FARMLAND_WORDS = ("農", "agric", "farm", "paddy", "crop")
LANDUSE_PROPERTIES = ("landuse", "landuse_code", "編定", "use", "類別")

# Lower limits of the confidence classes.
HIGH_FROM = 0.66
MEDIUM_FROM = 0.4


def hash_unit(seed: Column, i: Column, j: Column) -> Column:
    """Stable value in [0, 1) for a grid cell."""
    mixed = (
        (seed.cast("long") * F.lit(HASH_SEED_FACTOR).cast("long"))
        .bitwiseXOR(i.cast("long") * F.lit(HASH_I_FACTOR).cast("long"))
        .bitwiseXOR(j.cast("long") * F.lit(HASH_J_FACTOR).cast("long"))
    )
    return F.pmod(mixed, F.lit(HASH_MODULUS).cast("long")) / F.lit(float(HASH_MODULUS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, r"^\s+|\s+$", ""), F.lit(""))


def first_truthy(*candidates: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def truthy(flag: Column, strict: bool = False) -> Column:
    """Truth value of a JSON property held as text.

    Any non-empty string counts as true (so does the string ``false``); ``strict`` reads the
    words for no as false.
    """
    text = F.lower(flag)
    no = ["false", "0", "0.0", "", "null", "[]", "{}"] + (["no", "n", "f", "off"] if strict else [])
    return F.coalesce(~text.isin(no), F.lit(False))


def farmland_by_words(*texts: Column) -> Column:
    joined = F.lower(F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts]))
    return joined.rlike("|".join(FARMLAND_WORDS))


def date_prefix(text: Column) -> Column:
    return F.substring(F.coalesce(text, F.lit("")), 1, 10)


def year_of(text: Column) -> Column:
    """First four characters when they are digits, else null."""
    return F.when(text.rlike(r"^[0-9]{4}"), F.substring(text, 1, 4))


def confidence_class(conf: Column) -> Column:
    value = F.coalesce(conf, F.lit(0.0))
    return (
        F.when(value >= F.lit(HIGH_FROM), "high").when(value >= F.lit(MEDIUM_FROM), "medium").otherwise("low")
    )


def corroborated(distance_m: Column, radius_m: float) -> Column:
    return distance_m.isNotNull() & (distance_m <= F.lit(radius_m))


def padded_id(prefix: Column, i: Column, j: Column) -> Column:
    """``prefix-iii-jjj``; numbers above 999 keep all their digits."""
    return F.format_string("%s-%03d-%03d", prefix, i, j)


def round_half_even(value: Column, digits: int) -> Column:
    """Decimal rounding of the exact binary value, halves to even.

    The scaled value is taken as product plus rounding error (Veltkamp/Dekker), so values next to a
    half go the right way; ``bround`` would look at the shortest decimal form instead.
    """
    scale = 10.0**digits
    big = 134217729.0 * scale
    s_hi = big - (big - scale)
    s_lo = scale - s_hi

    def product(x):
        def parts(h):
            lo, p = x - h, x * F.lit(scale)
            err = (h * F.lit(s_hi) - p) + h * F.lit(s_lo) + lo * F.lit(s_hi) + lo * F.lit(s_lo)
            return F.struct(p.alias("p"), err.alias("e"))

        c = x * F.lit(134217729.0)
        return let(c - (c - x), parts)

    def decide(v):
        down = F.floor(v["p"]).cast("double")
        over = (v["p"] - down) - F.lit(0.5)
        up = (over > 0) | ((over == 0) & ((v["e"] > 0) | ((v["e"] == 0) & (F.pmod(down, F.lit(2.0)) == 1))))
        return F.when(up, down + 1).otherwise(down) / F.lit(scale)

    return let(let(value.cast("double"), product), decide)


def fixed(value: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, rounded as :func:`round_half_even`."""
    return F.format_string(f"%.{digits}f", round_half_even(value, digits))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    half_dlat = F.radians(lat2 - lat1) / F.lit(2.0)
    half_dlon = F.radians(lon2 - lon1) / F.lit(2.0)
    a = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(
        half_dlon
    ) * F.sin(half_dlon)
    return F.lit(2.0 * 6371.0088) * F.asin(F.sqrt(a))


def f32(value: Column) -> Column:
    """Value as the REAL columns of the stored tables keep it."""
    return value.cast("float")
