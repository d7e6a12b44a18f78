"""Column expressions, all of built-in functions, so that they stay inside generated code.

Rounded figures go through decimals: a double that looks like a tie is rounded by its decimal rendering, the same in every
engine, and sums of money don't depend on the order in which partitions arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The limits and names that results must agree on.
EARTH_RADIUS_KM = 6371.0088
ID_PATTERN = "^[0-9a-f]{32}$"
MAX_AMOUNT = 30000.0
FRESH_SECONDS, STALE_SECONDS = 86_400, 259_200
REASONS = ("invalid_trans_num", "missing_timestamp", "non_positive_amount", "implausible_amount", "invalid_category", "invalid_is_fraud_flag", "invalid_merchant_coordinates")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact_round(x: Column | str, places: int) -> Column:
    """A double rounded half up by its decimal form."""
    return F.round(_c(x).cast("decimal(28,8)"), places).cast("double")


def exact_sum(x: Column | str, places: int = 2) -> Column:
    """An aggregate: the sum of amounts as a double, exact in ``places`` decimals whatever the order."""
    return F.sum(_c(x).cast(f"decimal(18,{places})")).cast("double")


def exact_avg(x: Column | str, places: int = 3) -> Column:
    """An aggregate: the mean of amounts, rounded."""
    return exact_round(F.sum(_c(x).cast("decimal(18,2)")).cast("double") / F.count(_c(x)), places)


def exact_ratio(part: Column, whole: Column, places: int = 6) -> Column:
    """part / whole as doubles, rounded; null where ``whole`` is 0."""
    return exact_round(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), places)


def exact_share(part: Column, whole: Column, places: int = 3) -> Column:
    """Per cent."""
    return exact_round(F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), places)


def hour_bucket(ts: Column | str) -> Column:
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def day(ts: Column | str) -> Column:
    return F.to_date(_c(ts))


def day_ordinal(d: Column | str) -> Column:
    return F.unix_date(_c(d)).cast("long")


def weekday_name(d: Column | str) -> Column:
    return F.date_format(_c(d), "EEEE")


def epoch_seconds(ts: Column | str) -> Column:
    return F.unix_timestamp(_c(ts).cast("timestamp"))


def seconds_between(a: Column | str, b: Column | str) -> Column:
    return F.timestamp_diff("SECOND", _c(a), _c(b))


def card_last4(pan: Column | str) -> Column:
    return F.substring(_c(pan).cast("string"), -4, 4)


def card_hash(pan: Column | str, salt: str) -> Column:
    """SHA-256 of salt and card number; the salt is the caller's secret and has no default."""
    if not salt:
        raise ValueError("a salt is needed to mask card numbers")
    return F.sha2(F.concat(F.lit(salt), _c(pan).cast("string")), 256)


def age_years(born: Column | str, at: Column | str) -> Column:
    """Whole years at a time; month ends count as a month's last day, as months_between has it."""
    return F.floor(F.months_between(_c(at), F.try_to_timestamp(_c(born).cast("string")).cast("date")) / 12.0).cast("int")


def haversine_km(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    a1, o1, a2, o2 = (F.radians(_c(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return exact_round(2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0)))), 3)


def first_match(rules: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, else null. Rules are data: order is precedence."""
    return F.coalesce(*(F.when(test, F.lit(name)) for name, test in rules))


def reject_reason(categories: Sequence[str]) -> Column:
    """Why a row of the transaction feed is rejected, or null. A null category is left to the contract."""
    lat, lon, amt = F.col("merch_lat"), F.col("merch_long"), F.col("amt")
    tests = (
        ~F.coalesce(F.col("trans_num").rlike(ID_PATTERN), F.lit(False)),
        F.col("trans_time").isNull(),
        amt.isNull() | (amt <= 0),
        amt > MAX_AMOUNT,
        ~F.col("category").isin(*categories),
        ~F.coalesce(F.col("is_fraud").isin(0, 1), F.lit(False)),
        ~F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False)),
    )
    return first_match(list(zip(REASONS, tests, strict=True)))


def present_tier(channel: Column | str) -> Column:
    c = _c(channel)
    return F.when(c == "online", "card_not_present").when(c == "in_person", "card_present").otherwise("general")


def freshness_status(lag_seconds: Column | str) -> Column:
    lag = _c(lag_seconds)
    return F.when(lag <= FRESH_SECONDS, "fresh").when(lag <= STALE_SECONDS, "stale").otherwise("breached")


def banding(p: Column | str, review: float | Column, decline: float | Column) -> Column:
    return F.when(_c(p) >= decline, "DECLINE").when(_c(p) >= review, "REVIEW").otherwise("APPROVE")


def strip_prefix(name: Column | str, prefix: str) -> Column:
    return F.when(_c(name).startswith(prefix), F.substr(_c(name), F.lit(len(prefix) + 1))).otherwise(_c(name))


def compact_number(x: Column | str) -> Column:
    """1234567 as 1.23M: two decimals at most of billions, millions or thousands; whole numbers with commas below."""
    v = _c(x).cast("double")

    def scaled(unit: float, name: str) -> Column:
        return F.concat(F.regexp_replace(F.format_string("%.2f", v / unit), r"\.?0+$", ""), F.lit(name))

    size = F.abs(v)
    return F.when(size >= 1e9, scaled(1e9, "B")).when(size >= 1e6, scaled(1e6, "M")).when(size >= 1e3, scaled(1e3, "K")).when(size.isNotNull(), F.format_string("%,.0f", v))


def fourier_terms(t: Column | str, orders: int, period: float = 365.25) -> list[Column]:
    """sin and cos of each order, named s1, c1, s2, ..."""
    out = []
    for k in range(1, orders + 1):
        angle = F.lit(2.0) * F.pi() * k * _c(t) / period
        out += [F.sin(angle).alias(f"s{k}"), F.cos(angle).alias(f"c{k}")]
    return out
