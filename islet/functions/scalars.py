"""Column-level functions (F*, P6-P8, P10, P12, P19-P21).

All return ``pyspark.sql.Column`` built from ``pyspark.sql.functions`` so they
stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source project's vocabulary exactly for
# the cleaned log to come out the same.  Stated plainly, in natural order.
# ---------------------------------------------------------------------------

# raw creation_category spelling -> canonical category (matched on the raw,
# untrimmed value; anything unmatched is only trimmed)
CATEGORY_FIXES: dict[str, str] = {
    "Recording Audip": "Recording Audio",
    "Uploading Video": "Uploading",
    "Writing Scriot": "Script",
    "Writing Script": "Script",
    "Writinng Script": "Script",
    "Witing Script": "Script",
    "Video Notes": "Script",
    "Video notes": "Script",
    "Outline": "Script",
    "Watching and Editing": "Editing",
    "Watching and Edits": "Editing",
    "Editing Video": "Editing",
    "Editing Audio": "Editing",
    "Recording Vide0": "Recording Video",
    "Recordinng Video": "Recording Video",
    "Recording  Video": "Recording Video",
    "Picture": "Thumbnail",
    "Pictures": "Thumbnail",
}

# media_type patterns (on trimmed, lower-cased text) -> canonical label
MEDIA_TYPE_PATTERNS: list[tuple[str, str]] = [
    ("%movie%", "Movies"),
    ("%video%game%", "Video Games"),
]

# rows with these values are out of scope for the log
EXCLUDED_TITLES = ["None", "Entire Channel"]
EXCLUDED_SUBTYPES = ["Multiple", "N/A"]
EXCLUDED_MEDIA_TYPE = "Channel"
EXCLUDED_CATEGORIES = ["Monetization", "Research Youtube", "Banner", "Promoting",
                       "Video Games", "Reporting", "SEO", "Stats"]

# canonical category -> phase of work; anything else is "Uncategorised"
PHASES: dict[str, list[str]] = {
    "Pre-Processing": ["Processing Raw Video", "Script"],
    "Processing": ["Editing", "Recording Audio", "Recording Video"],
    "Post-Processing": ["Thumbnail", "Subtitles", "Uploading"],
}
PHASE_DEFAULT = "Uncategorised"
CREATION_PHASES = ["Pre-Processing", "Processing"]

# the eight categories that get their own hours column in the roll-up
ROLLUP_CATEGORIES = ["Editing", "Processing Raw Video", "Recording Audio", "Recording Video",
                     "Script", "Subtitles", "Thumbnail", "Uploading"]

# expected length in minutes -> tier label, tier order and ordinal
LENGTH_TIERS: dict[str, list[int]] = {"Short": [7, 10], "Average": [15], "Long": [20, 25, 30]}
TIER_ORDER = ["Short", "Average", "Long"]
TIER_ORDINAL = {"Short": 0, "Average": 1, "Long": 2}

# quarter-of-day bins on hour (right-closed edges) and their labels
DAY_QUARTER_EDGES = [-1, 5, 11, 17, 23]
DAY_QUARTER_LABELS = ["Midnight–5:59 AM", "6:00–11:59 AM", "12:00–5:59 PM", "6:00–11:59 PM"]

# monitoring thresholds
DRIFT_WINDOW = 5
DRIFT_MIN_PERIODS = 3
DRIFT_THRESHOLD = 2.0
B1_RMSE = 5.45
HOLDOUT_RMSE = 4.68
SHIFT_THRESHOLD = 0.15

# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def canonical_media_type(col, patterns: Sequence[tuple[str, str]] = MEDIA_TYPE_PATTERNS) -> Column:
    """LIKE patterns on trimmed lower text, else the trimmed raw value."""
    c = _c(col)
    norm = trim_lower(c)
    out = None
    for pat, label in patterns:
        out = (F.when(like(norm, pat), F.lit(label)) if out is None
               else out.when(like(norm, pat), F.lit(label)))
    return out.otherwise(F.trim(c)) if out is not None else F.trim(c)


def canonical_category(col, fixes: Mapping[str, str] = CATEGORY_FIXES) -> Column:
    """Exact-match map on the *raw* value; unmatched values are trimmed."""
    c = _c(col)
    by_target: dict[str, list[str]] = {}
    for raw, target in fixes.items():
        by_target.setdefault(target, []).append(raw)
    out = None
    for target, raws in by_target.items():
        cond = c.isin(raws)
        out = F.when(cond, F.lit(target)) if out is None else out.when(cond, F.lit(target))
    return out.otherwise(F.trim(c)) if out is not None else F.trim(c)


def classify(col, mapping: Mapping[str, Iterable], default=None) -> Column:
    """Multi-branch CASE; ``default=None`` leaves unmatched values NULL."""
    c = _c(col)
    out = None
    for label, values in mapping.items():
        cond = c.isin(list(values))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out


def phase_of(col, phases: Mapping[str, list[str]] = PHASES, default: str = PHASE_DEFAULT) -> Column:
    return classify(col, phases, default)


def length_tier(col, tiers: Mapping[str, list[int]] = LENGTH_TIERS) -> Column:
    """CASE without ELSE -> unmapped lengths give NULL."""
    return classify(col, tiers, None)


def length_tier_ord(col, tiers: Mapping[str, list[int]] = LENGTH_TIERS,
                    ordinal: Mapping[str, int] = TIER_ORDINAL) -> Column:
    """Ordinal of the tier, NULL when unmapped."""
    c = _c(col)
    out = None
    for label, values in tiers.items():
        cond = c.isin(list(values))
        v = F.lit(ordinal[label])
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out


def category_rank(col, order: Sequence[str]) -> Column:
    """Position of a label in a custom order (1-based); labels outside the
    order come after all others, NULL stays NULL."""
    at = F.array_position(F.array(*[F.lit(v) for v in order]), _c(col))
    return F.when(at == 0, F.lit(len(order) + 1).cast("long")).otherwise(at)


def binary_flag(col, value) -> Column:
    """P10: (col == value) as 0/1."""
    return (_c(col) == F.lit(value)).cast("int")


def time_12h_to_24h(col) -> Column:
    """'9:05:00 PM' -> '21:05:00'; unparseable -> NULL."""
    return F.date_format(F.try_to_timestamp(_c(col), F.lit("h:mm:ss a")), "HH:mm:ss")


def time_24h_to_12h(col) -> Column:
    """Inverse of F6 on a timestamp: '21:05:00' style -> '9:05:00 PM'."""
    return F.date_format(_c(col), "h:mm:ss a")


def date_plus_time(date_col, time_col) -> Column:
    """DATE + 'HH:mm:ss' -> TIMESTAMP_NTZ; NULL if either side is NULL."""
    return F.to_timestamp_ntz(F.concat(_c(date_col).cast("string"), F.lit(" "), _c(time_col)))


def plus_minutes(ts_col, minutes_col) -> Column:
    """F8: timestamp + n minutes."""
    return _c(ts_col) + F.make_dt_interval(F.lit(0), F.lit(0), _c(minutes_col).cast("int"))


def minute_boundaries(a, b) -> Column:
    """number of minute boundaries crossed from a to b (DATEDIFF('minute'))."""
    a, b = _c(a), _c(b)
    clock = lambda t: F.hour(t) * 60 + F.minute(t)  # noqa: E731  no cast to the session zone, whose hours can be skipped
    return (F.datediff(b, a) * 1440 + clock(b) - clock(a)).cast("long")


def day_span(first, last) -> Column:
    """inclusive day span, NULL-safe: DATEDIFF('day', a, b) + 1."""
    return F.datediff(_c(last), _c(first)) + F.lit(1)


def concat_key(*cols, sep: str = "|") -> Column:
    """NULL-propagating concat with separator (not concat_ws)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_c(c))
    return F.concat(*parts)


def hash_key(*cols, sep: str = "|") -> Column:
    """md5 hex of the natural key; NULL if any part is NULL."""
    return F.md5(concat_key(*cols, sep=sep))


def repair_wrap(col, wrap: int = 1440) -> Column:
    """negative durations (sessions crossing midnight) get one day added."""
    c = _c(col)
    return F.when(c < 0, c + F.lit(wrap)).otherwise(c)


def month_period(col, fmt: str = "yyyy_MM") -> Column:
    """month period text."""
    return F.date_format(_c(col), fmt)


def right_closed_bins(col, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Pd.cut semantics, (e_i, e_{i+1}] -> labels[i]; outside -> NULL."""
    c = _c(col)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def day_quarter(hour_col) -> Column:
    return right_closed_bins(hour_col, DAY_QUARTER_EDGES, DAY_QUARTER_LABELS)


def pct(n, total, digits: int = 2) -> Column:
    """rounded percentage."""
    return F.round(_c(n) * F.lit(100.0) / _c(total), digits)


def hours(minutes_col, digits: int = 2) -> Column:
    return F.round(_c(minutes_col) / F.lit(60.0), digits)


def flag_abs(col, threshold: float) -> Column:
    """|x| > threshold."""
    return F.abs(_c(col)) > F.lit(threshold)


def verdict(rmse_col, holdout: float = HOLDOUT_RMSE, b1: float = B1_RMSE) -> Column:
    """P20: categorised comparison against the holdout and B1 benchmarks."""
    r = _c(rmse_col)
    return (F.when(r < F.lit(holdout), F.lit("BEATS HOLDOUT"))
            .when(r < F.lit(b1), F.lit("beats B1"))
            .otherwise(F.lit("below B1")))


def drift_direction(mean_col) -> Column:
    """Sign of the mean residual as a word."""
    return F.when(_c(mean_col) > 0, F.lit("underpredicting")).otherwise(F.lit("overpredicting"))


def log_grid(lo: float, hi: float, n: int) -> list[float]:
    """log-spaced grid of n values between lo and hi (parameter list)."""
    return [float(x) for x in np.logspace(np.log10(lo), np.log10(hi), n)]


def linear_score(coefficients: Mapping[str, float], intercept: float) -> Column:
    """ML15: a linear model as a column expression (stays in codegen)."""
    out = F.lit(float(intercept))
    for name, w in coefficients.items():
        out = out + F.col(name).cast("double") * F.lit(float(w))
    return out


# -- thin built-ins named for the inventory (F1, F2, F4, F12, F13, F15, F16, X11) --

def trim_lower(col) -> Column:
    """TRIM(LOWER(x))."""
    return F.trim(F.lower(_c(col)))


def like(col, pattern: str) -> Column:
    """SQL LIKE with % / _ wildcards."""
    return _c(col).like(pattern)


def starts_with(col, prefix: str) -> Column:
    """prefix test (e.g. picking dummy columns by name prefix)."""
    return _c(col).startswith(prefix)


def hour_of(col) -> Column:
    """hour of a timestamp, or of an 'HH:mm:ss' text."""
    return F.hour(_c(col))


def hour_at_most(col, h: int) -> Column:
    """X11: HOUR(x) <= h (the source's 'midnight to 4 AM' probe is h = 4)."""
    return F.hour(_c(col)) <= F.lit(h)


def round_half_up(col, digits: int) -> Column:
    """SQL ROUND (half away from zero)."""
    return F.round(_c(col), digits)


def round_half_even(col, digits: int) -> Column:
    """numpy's rounding (banker's), used when scoring."""
    return F.bround(_c(col), digits)


def log_target(col) -> Column:
    """natural log of a positive target (log-target models)."""
    return F.log(_c(col))


def exp_back(col) -> Column:
    """back-transform of a log-scale prediction."""
    return F.exp(_c(col))


def cast_to(col, type_name: str) -> Column:
    """F16: ::DATE, astype(int / float), to_datetime, ... as a cast."""
    return _c(col).cast(type_name)


def text_digest(col) -> Column:
    """A fixed-width key for a whole text: md5 and sha-256 of all of it, side
    by side (a collision would need both to collide at once).  Grouping or
    de-duplicating on it shuffles ~100 bytes per key instead of whole
    documents."""
    c = _c(col)
    return F.concat(F.md5(c), F.sha2(c, 256))
