"""Standardised codes, flags, bands and keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casting import as_column

# Labels and limits every report relies on.
VOICE_TYPES = ["VOICE", "IDD VOICE", "VIDEO CALL"]
HIGH_VALUE_SEGMENTS = ["High Value", "VIP"]
SEGMENTS = ["Low Value", "Mid Value", "High Value", "VIP"]
DIGITAL_CHANNELS = ["Mobile App", "Web Portal", "IVR"]
DATA_EVENTS = ["data_session_start", "data_session_end"]
ALERT_EVENTS = ["call_dropped", "data_session_end", "recharge_completed"]
HOURS_OF_DAY = [("Morning", 6, 11), ("Afternoon", 12, 17), ("Evening", 18, 22)]
PEAK_HOURS = (8, 20)
AGE_BELOW = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
TENURE_BELOW = [(6, "0-6m"), (12, "6-12m"), (24, "1-2yr"), (36, "2-3yr")]
TENURE_BANDS = [label for _, label in TENURE_BELOW] + ["3yr+"]
AMOUNT_UP_TO = [(25, "Low (≤25)"), (75, "Mid (26-75)")]
SCORE_FROM = [("0.70", "High Risk"), ("0.40", "Medium Risk")]


def std_code(c) -> Column:
    return F.upper(F.trim(as_column(c)))


def std_label(c) -> Column:
    return F.trim(as_column(c))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def first_match(cases, otherwise) -> Column:
    """The label of the first true condition out of (condition, label) pairs."""
    (condition, label), *rest = cases
    out = F.when(condition, label)
    for condition, label in rest:
        out = out.when(condition, label)
    return out.otherwise(otherwise)


def time_of_day(hour) -> Column:
    h = as_column(hour)
    return first_match([(h.between(a, b), name) for name, a, b in HOURS_OF_DAY], "Night")


def is_peak(hour) -> Column:
    return flag(as_column(hour).between(*PEAK_HOURS))


def month_key(date) -> Column:
    d = as_column(date)
    year, month = F.year(d), F.month(d)
    # a formatter takes some microseconds a row
    key = F.concat(year.cast("string"), F.when(month < 10, "-0").otherwise("-"), month.cast("string"))
    return F.when(year.between(1000, 9999), key).otherwise(F.date_format(d, "yyyy-MM"))


def week_key(date) -> Column:
    """ISO year and week, ``yyyy-ww``; the week-based year can differ from the year."""
    d = as_column(date)
    year = F.date_part(F.lit("YEAROFWEEK"), d).cast("string")
    return F.concat(year, F.lit("-"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def age_band(age) -> Column:
    a = as_column(age)
    return first_match([(a < limit, label) for limit, label in AGE_BELOW], "55+")


def tenure_band(months) -> Column:
    m = as_column(months)
    return first_match([(m < limit, label) for limit, label in TENURE_BELOW], "3yr+")


def amount_band(amount) -> Column:
    a = as_column(amount)
    return first_match([(a <= limit, label) for limit, label in AMOUNT_UP_TO], "High (>75)")


def mask_msisdn(c) -> Column:
    return F.concat(F.substring(as_column(c), 1, 7), F.lit("****"))


def is_digital(channel) -> Column:
    return flag(as_column(channel).isin(DIGITAL_CHANNELS))


def segment_code(segment) -> Column:
    """0 to 2 for the first three segments, 3 for VIP and anything else."""
    s = as_column(segment)
    return first_match([(s == name, i) for i, name in enumerate(SEGMENTS[:3])], 3)


def score_band(probability) -> Column:
    p = as_column(probability)
    cases = [(p >= F.lit(limit).cast("decimal(3,2)"), label) for limit, label in SCORE_FROM]
    return first_match(cases, "Low Risk")


def is_high_score(probability) -> Column:
    return flag(as_column(probability) >= F.lit(SCORE_FROM[0][0]).cast("decimal(3,2)"))


def audit(source: str | None = None, load_column: str = "silver_load_dttm") -> list[Column]:
    """Load time and, where there is one, the source system."""
    out = [F.current_timestamp().alias(load_column)]
    if source is not None:
        out.append(F.lit(source).alias("source_system"))
    return out
