"""Rule-based verdict text (X10-X13) as column expressions - no Python per row.

Numbers in text are rounded half-even at one decimal on the exact 2-decimal value (the
stored scores are decimals), then formatted, so ``40.25`` prints ``40.2`` as it does
when a decimal is formatted with ``.1f``.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metroscope.functions.columns import rnd

# Signal order, labels and neutral points used to pick the primary driver.
SIGNAL_ORDER = ("anomaly_score", "heat_score", "alert_score", "context_score")
SIGNAL_LABELS = {
    "anomaly_score": "311 service demand",
    "heat_score": "heat index",
    "alert_score": "NWS weather alerts",
    "context_score": "media and social context",
}
NEUTRAL = {"anomaly_score": 50, "heat_score": 50, "alert_score": 0, "context_score": 50}

# Band sentences, tested in this order per signal.
ANOMALY_TEXT = (
    "311 service demand is significantly above the 30-day baseline — unusually high citizen-reported activity.",
    "311 service demand is moderately above baseline — request volume trending upward.",
    "311 service demand is below baseline — quieter than usual for this period.",
    "311 service demand is within normal range.",
)
HEAT_TEXT = (
    "Heat index is significantly above seasonal average — population heat stress risk is elevated.",
    "Heat index is above seasonal average — warmer than typical for this period.",
    "Heat index is below seasonal average — cooler than typical, no heat stress risk.",
    "Heat index is within normal seasonal range.",
)
ALERT_TEXT = (
    "Active NWS extreme or severe weather alert in effect — declared emergency conditions.",
    "Active NWS moderate weather alert in effect — conditions exceed normal thresholds.",
    "Minor NWS advisory in effect — monitor conditions.",
    "No active NWS weather alerts for the {place} area.",
)
CONTEXT_TEXT = (
    "Media tone is strongly negative with elevated protest activity — significant social tension reported.",
    "Media tone is moderately negative — above-average tension in news coverage.",
    "Media tone is neutral to positive — no unusual social tension in coverage.",
    "Media tone and protest activity are within normal range.",
)
# The overall sentence by readiness mode, and the closing line.
OVERALL_HIGH = "Urban stress conditions are significantly elevated — composite index is {c} ({d} pts above the 30-day baseline of {b})."
OVERALL_ELEVATED = "Urban stress conditions are moderately above baseline — composite index is {c} ({d} pts above the 30-day baseline of {b})."
OVERALL_NORMAL = "Urban stress conditions are within normal range — composite index is {c} ({d} pts relative to the 30-day baseline of {b})."
CLOSING = "Operator judgment required before adjusting staffing or resource positioning."


def fmt1(c: Column, signed: bool = False) -> Column:
    """``{x:.1f}`` / ``{x:+.1f}`` of a 2-decimal value, half-even like decimal formatting."""
    r = F.bround(c.cast("decimal(18,2)"), 1).cast("double")
    return F.format_string("%+.1f" if signed else "%.1f", r)


def band_anomaly_heat(score: Column, texts) -> Column:
    return F.when(score >= 80, texts[0]).when(score >= 60, texts[1]).when(score <= 30, texts[2]).otherwise(texts[3])


def band_alert(score: Column, city: Column | None = None) -> Column:
    """The no-alert sentence names the city (Boston if none is given)."""
    t = ALERT_TEXT
    head, tail = t[3].split("{place}")
    none = F.concat(F.lit(head), F.initcap(F.lit("boston") if city is None else city), F.lit(tail))
    return F.when(score >= 75, t[0]).when(score >= 40, t[1]).when(score > 0, t[2]).otherwise(none)


def band_context(score: Column) -> Column:
    t = CONTEXT_TEXT
    return F.when(score >= 70, t[0]).when(score >= 50, t[1]).when(score <= 20, t[2]).otherwise(t[3])


def primary_driver() -> Column:
    """Signal with the largest |score - neutral|; the earlier signal wins ties.

    Deviations are rounded to 2 places so decimal ties stay ties in doubles."""
    items = [
        F.struct(
            rnd(F.abs(F.col(s) - F.lit(NEUTRAL[s])), 2).alias("dev"),
            F.lit(-i).alias("rank"),
            F.lit(s).alias("name"),
        )
        for i, s in enumerate(SIGNAL_ORDER)
    ]
    return F.array_max(F.array(*items))["name"]


def _label(driver: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in SIGNAL_LABELS.items() for x in kv])
    return F.element_at(m, driver)


def _overall(template: str) -> Column:
    c = fmt1(F.col("composite"))
    d = fmt1(F.col("composite") - F.col("composite_baseline_30d"), signed=True)
    b = fmt1(F.col("composite_baseline_30d"))
    head, rest = template.split("{c}")
    mid, rest = rest.split("{d}")
    mid2, tail = rest.split("{b}")
    return F.concat(F.lit(head), c, F.lit(mid), d, F.lit(mid2), b, F.lit(tail))


def verdict_text(city: Column | None = None) -> Column:
    """X11: overall sentence, driver sentence, four band sentences, closing line."""
    mode = F.col("readiness_mode")
    overall = F.when(mode == "High", _overall(OVERALL_HIGH)).when(
        mode == "Elevated", _overall(OVERALL_ELEVATED)
    ).otherwise(_overall(OVERALL_NORMAL))
    drv = primary_driver()
    drv_score = F.element_at(F.create_map(*[x for s in SIGNAL_ORDER for x in (F.lit(s), F.col(s))]), drv)
    driver_line = F.concat(
        F.lit("Primary driver: "), _label(drv), F.lit(" ("), F.replace(drv, F.lit("_"), F.lit(" ")),
        F.lit(": "), fmt1(drv_score), F.lit("/100)."),
    )
    return F.concat_ws(
        " ", overall, driver_line,
        band_anomaly_heat(F.col("anomaly_score"), ANOMALY_TEXT),
        band_anomaly_heat(F.col("heat_score"), HEAT_TEXT),
        band_alert(F.col("alert_score"), city),
        band_context(F.col("context_score")),
        F.lit(CLOSING),
    )


def delta_label(delta_pct: Column) -> Column:
    """``+x.x% vs 30d avg`` (no sign when negative; null -> null)."""
    sign = F.when(delta_pct >= 0, "+").otherwise("")
    return F.when(delta_pct.isNotNull(), F.concat(sign, fmt1(delta_pct), F.lit("% vs 30d avg")))


def delta_class(delta_pct: Column) -> Column:
    """Up / down / neutral style class."""
    return F.when(delta_pct > 0, "metric-delta-up").when(delta_pct < 0, "metric-delta-down").when(
        delta_pct.isNotNull(), "metric-delta-neu"
    )


def display_value(value_text: Column, value_num: Column) -> Column:
    """Text, else number (0 counts as missing), else 'N/A'."""
    num = F.nullif(value_num, F.lit(0.0)).cast("decimal(18,3)").cast("string")
    return F.coalesce(F.nullif(value_text, F.lit("")), num, F.lit("N/A"))
