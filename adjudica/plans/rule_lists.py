"""Rule lists mined from the claims, for the queries that check items against them."""

from __future__ import annotations

from ..operators import association as A
from ..operators import claims as C
from ..registry import query
from ..sources import claims_model as M
from .common import r, stored
from .views import using

STANDARD_OF_CARE = {"min_support": 2, "min_confidence": 0.0, "min_lift": 1.0}
#: A drug or device is indicated by a diagnosis in at least one of fifty claims that bill it.
INDICATION = {"min_support": 2, "min_confidence": 0.02, "min_lift": 1.0}


def mined_sql(name: str, given: str, then: str, limits: dict) -> str:
    """CTEs that end in ``name``: the mined pairs over the view ``item``."""
    return f""", {name}_coded AS (SELECT DISTINCT claim_request_bundle_id AS c, {given} AS g, {then} AS t FROM item
    WHERE {given} IS NOT NULL AND {then} IS NOT NULL),
    {name} AS (SELECT {given}, {then}, n_claims, confidence, lift FROM (SELECT p.g AS {given}, p.t AS {then}, p.n AS n_claims,
    p.n / a.n AS confidence, p.n / a.n * (SELECT COUNT(DISTINCT c) FROM {name}_coded) / b.n AS lift
    FROM (SELECT g, t, COUNT(*) AS n FROM {name}_coded GROUP BY 1, 2) p
    JOIN (SELECT g, COUNT(DISTINCT c) AS n FROM {name}_coded GROUP BY 1) a ON a.g = p.g
    JOIN (SELECT t, COUNT(DISTINCT c) AS n FROM {name}_coded GROUP BY 1) b ON b.t = p.t)
    WHERE n_claims >= {limits['min_support']} AND confidence >= {limits['min_confidence']}::DOUBLE
    AND lift >= {limits['min_lift']}::DOUBLE)"""


def mined_pairs(spark, sf_dir, given, then, limits):
    """The list as a stored artefact, mined once for all that read it."""
    return stored(spark, A.mine_pairs(M.claim_item(spark, sf_dir), C.CLAIM, given, then, **limits), f"mined-{then}")


@query(
    "mined_standard_of_care",
    using(
        "item",
        mined_sql("mined", "principal_diagnosis_code", "procedure_code", STANDARD_OF_CARE)
        + """ SELECT principal_diagnosis_code, procedure_code, n_claims, ROUND(confidence, 9) AS confidence,
        ROUND(lift, 6) AS lift FROM mined""",
    ),
)
def mined_standard_of_care(spark, sf_dir):
    """Procedures that claims with a diagnosis hold at least as often as claims at large."""
    pairs = mined_pairs(spark, sf_dir, C.DIAGNOSIS, "procedure_code", STANDARD_OF_CARE)
    return pairs.withColumn("confidence", r("confidence", 9)).withColumn("lift", r("lift", 6))
