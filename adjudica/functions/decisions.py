"""Rules that turn features and scores into labels and decisions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expressions import Cols, _c, flag

APPROVE, DENY, PEND = "APPROVE", "DENY", "PEND"


def stp_label(pre_auth: Cols, net: Cols, covered: Cols, approve_below: float = 500.0) -> Column:
    """Adjudication target; an unknown amount can not be approved."""
    approved = (_c(pre_auth) == 1) & (_c(net) < approve_below) & (_c(covered) == 1)
    return F.when(approved, APPROVE).when(_c(covered) == 0, DENY).otherwise(PEND)


def triage_decision(label: Cols, confidence: Cols, approve_at: float, deny_at: float) -> Column:
    sure_approve = (_c(label) == APPROVE) & (_c(confidence) >= approve_at)
    sure_deny = (_c(label) == DENY) & (_c(confidence) >= deny_at)
    return F.when(sure_approve, "AUTO_APPROVED").when(sure_deny, "AUTO_DENIED").otherwise("PEND_FOR_REVIEW")


def best_class(probabilities: Cols, classes: list[str]) -> tuple[Column, Column]:
    """``(label, confidence)`` of the most probable class; the first wins a tie."""
    probs = _c(probabilities)
    top = F.array_max(probs)
    names = F.array(*[F.lit(c) for c in classes])
    position = F.array_position(probs, top).cast("int") - 1
    return F.coalesce(F.get(names, position), F.lit("UNKNOWN")), top


def auto_pay_gate(financial: Cols, medical: Cols, fwa: Cols, pass_above: float = 0.99, risk_below: float = 0.01) -> Column:
    """First gate that fails names the outcome; all passed means payment without review."""
    return (
        F.when(~F.coalesce(_c(financial) > pass_above, F.lit(False)), "REJECT")
        .when(~F.coalesce(_c(medical) > pass_above, F.lit(False)), "DENY")
        .when(~F.coalesce(_c(fwa) < risk_below, F.lit(False)), "FLAG")
        .otherwise("AUTO-PAY")
    )


def financial_reject_label(utilization: Cols, tier: Cols, duplicate: Cols) -> Column:
    return flag((_c(utilization) > 0.9) | (_c(tier) > 1) | (_c(duplicate) == 1))


def medical_necessity_label(soc: Cols, gender: Cols) -> Column:
    return flag((_c(soc) == 1) & (_c(gender) == 1))


def churn_probability(out_of_pocket: Cols, denial: Cols, manual: Cols) -> Column:
    """Target rate of the churn label (fixed coefficients)."""
    return F.lit(0.05) + 0.5 * _c(out_of_pocket) + 0.3 * _c(denial) + 0.2 * _c(manual)


def within(metric: Cols, low: float | None = None, high: float | None = None) -> Column:
    """True when a metric lies within its limits; an unknown metric fails."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (_c(metric) >= low)
    if high is not None:
        ok = ok & (_c(metric) <= high)
    return F.coalesce(ok, F.lit(False))
