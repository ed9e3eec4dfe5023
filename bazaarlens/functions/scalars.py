"""Column helpers: each one is an expression over built-in functions, never a Python UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlens.functions import fixed

DAY_SECONDS = 86400


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers ----------------------------------------------------------------
def money(c: Column | str) -> Column:
    return col(c).cast("decimal(18,2)")


def ratio(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """num / den rounded half up in decimal arithmetic; NULL when den is 0."""
    q = F.try_divide(col(num).cast("decimal(24,4)"), col(den).cast("decimal(20,4)"))
    return F.round(q, digits).cast(f"decimal(18,{digits})")


def percent(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    return ratio(col(num).cast("decimal(22,4)") * 100, den, digits)


def mean(c: Column | str, digits: int = 2) -> Column:
    """Average of the non-null values as an aggregate, rounded half up."""
    return ratio(F.sum(col(c)), F.count(col(c)), digits)


def safe_int(c: Column | str) -> Column:
    """Text to integer: bad text is NULL, fractions round half away from zero."""
    return F.round(col(c).try_cast("double")).try_cast("int")


def safe_double(c: Column | str) -> Column:
    return col(c).try_cast("double")


def safe_decimal(c: Column | str, scale: int = 2) -> Column:
    return col(c).try_cast(f"decimal(12,{scale})")


def safe_timestamp(c: Column | str) -> Column:
    return col(c).try_cast("timestamp_ntz")


# --- dates ------------------------------------------------------------------
def epoch(c: Column | str) -> Column:
    """Seconds since 1970 of a zone-less timestamp (session zone is UTC)."""
    return F.unix_timestamp(col(c).cast("timestamp"))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Day boundaries crossed."""
    return F.datediff(col(end), col(start))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Hour boundaries crossed."""
    hour = lambda c: F.floor(epoch(c) / 3600)
    return (hour(end) - hour(start)).cast("bigint")


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    return (epoch(end) - epoch(start)) / F.lit(float(DAY_SECONDS))


def floor_days(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed days; negative differences round down."""
    return F.floor((epoch(end) - epoch(start)) / DAY_SECONDS).cast("bigint")


def hours_since(last: Column | str, as_of: Column | str) -> Column:
    return F.floor((epoch(as_of) - epoch(last)) / 3600).cast("bigint")


def date_key(c: Column | str) -> Column:
    """The day as the number yyyymmdd, by arithmetic; negative for years before 0."""
    year = F.year(col(c))
    number = F.abs(year) * 10000 + F.month(col(c)) * 100 + F.dayofmonth(col(c))
    return F.when(year < 0, -number).otherwise(number)


def month_start(c: Column | str) -> Column:
    return F.trunc(col(c), "month")


# --- text -------------------------------------------------------------------
def strip(c: Column | str) -> Column:
    """Remove all white space at both ends."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def zero_pad(c: Column | str, width: int = 5) -> Column:
    return F.lpad(col(c), width, "0")


def initcap_words(c: Column | str) -> Column:
    """Upper-case the first letter after white space or punctuation, lower-case the rest."""
    breaks = "[\\s" + re.escape(fixed.WORD_BREAKS).replace("/", "\\/") + "]"
    words = F.split(col(c), f"(?<={breaks})")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 2_000_000_000)))),
        "",
    )


def strip_accents(c: Column | str) -> Column:
    return F.translate(col(c), fixed.ACCENTED, fixed.UNACCENTED)


def normalize_city(c: Column | str) -> Column:
    return F.regexp_replace(strip(F.lower(strip_accents(c))), r"\s+", " ")


def contains_text(c: Column | str, needle: str) -> Column:
    return F.coalesce(F.contains(F.lower(col(c)), F.lit(needle.lower())), F.lit(False))


def slug(c: Column | str, size: int = 50) -> Column:
    """File-name form: lower case, separators to `_`, other signs dropped, first `size` characters."""
    joined = F.translate(F.lower(col(c)), " /\\", "___")
    return F.substring(F.regexp_replace(joined, r"[^\p{L}\p{N}_]", ""), 1, size)


def short_label(c: Column | str, size: int = 65) -> Column:
    return F.when(F.length(col(c)) > size, F.concat(F.substring(col(c), 1, size), F.lit("..."))).otherwise(col(c))


# --- look-ups and bands -----------------------------------------------------
def lookup(c: Column | str, mapping: dict, default: Column | None = None) -> Column:
    pairs = [F.lit(v) for kv in mapping.items() for v in kv]
    found = F.try_element_at(F.create_map(*pairs), col(c))
    return found if default is None else F.coalesce(found, default)


def state_to_region(c: Column | str, default: str) -> Column:
    mapping = {uf: region for region, ufs in fixed.REGION_STATES.items() for uf in ufs}
    return lookup(c, mapping, F.lit(default))


def ladder(c: Column | str, steps: list[tuple[float, str]], top: str, inclusive: bool) -> Column:
    """Label of the first step whose limit is not exceeded; `top` beyond the last (also for NULL)."""
    out = None
    for limit, label in steps:
        test = (col(c) <= limit) if inclusive else (col(c) < limit)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(top)


def weight_band(c: Column | str) -> Column:
    return ladder(c, fixed.WEIGHT_BANDS, fixed.WEIGHT_BAND_TOP, inclusive=True)


def price_tier(c: Column | str) -> Column:
    return ladder(c, fixed.PRICE_TIERS, fixed.PRICE_TIER_TOP, inclusive=False)


def sentiment_band(c: Column | str) -> Column:
    return F.when(col(c) >= 4, "POSITIVE").when(col(c) == 3, "NEUTRAL").otherwise("NEGATIVE")


def delivery_status(delivered: Column | str, estimated: Column | str) -> Column:
    return (
        F.when(col(delivered) <= col(estimated), "ON_TIME")
        .when(col(delivered) > col(estimated), "LATE")
        .otherwise("PENDING")
    )


def month_name_pt(c: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in fixed.MONTH_NAMES_PT]), F.month(col(c)))


def day_name_pt(c: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in fixed.DAY_NAMES_PT]), F.dayofweek(col(c)))


def share(pred: Column) -> Column:
    """Mean of a predicate as an aggregate; NULL counts as false."""
    return F.avg(F.coalesce(pred, F.lit(False)).cast("double"))


def bucket_of(c: Column | str, lo: float, hi: float, bins: int) -> Column:
    """Histogram bin 0..bins-1 of values in [lo, hi]; the last bin is closed. NULL outside."""
    x = col(c).cast("double")
    width = (hi - lo) / bins
    raw = F.floor((x - F.lit(float(lo))) / F.lit(float(width))).cast("int")
    return F.when((x >= lo) & (x <= hi), F.least(raw, F.lit(bins - 1)))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    return F.when(col(c).isNotNull(), F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi)))
