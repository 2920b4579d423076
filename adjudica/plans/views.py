"""The claims tables as SQL, for checking the registered queries elsewhere."""

from __future__ import annotations

from ..sources.claims_model import CONDITIONS

VIEWS = {
    "header": """SELECT o_orderkey AS claim_request_bundle_id, o_custkey AS patient_key,
        o_totalprice AS payer_share_amount, CAST(o_orderdate AS DATE) AS max_serviced_date,
        CASE o_orderstatus WHEN 'F' THEN 'rejected' WHEN 'P' THEN 'approved' END AS pre_auth_outcome,
        CASE WHEN o_orderstatus <> 'O' THEN 'PA-' || o_orderkey END AS pre_auth_ref,
        o_orderpriority AS adjudication_reason FROM orders""",
    "line": """SELECT l_orderkey AS claim_request_bundle_id, l_linenumber AS line_no,
        l_suppkey AS provider_license_key, l_partkey AS service_key, l_extendedprice AS payer_share_amount,
        l_quantity AS quantity, l_discount AS discount, l_tax AS tax,
        CAST(l_shipdate AS DATE) AS max_serviced_date FROM lineitem""",
    "service": """SELECT p_partkey AS service_key, p_type || '.' || p_size AS principal_diagnosis_code,
        p_brand AS procedure_code, p_type AS activity_type, p_size AS service_size,
        p_retailprice AS list_price FROM part""",
    "item": """SELECT l_orderkey AS claim_request_bundle_id, l_linenumber AS line_no,
        l_suppkey AS provider_license_key, l_partkey AS service_key, l_extendedprice AS payer_share_amount,
        l_quantity AS quantity, l_discount AS discount, l_tax AS tax,
        CAST(l_shipdate AS DATE) AS max_serviced_date, p_type || '.' || p_size AS principal_diagnosis_code,
        p_brand AS procedure_code, p_type AS activity_type, p_size AS service_size, p_retailprice AS list_price
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "patient": """SELECT c_custkey AS patient_key, CAST(20 + c_custkey % 60 AS INTEGER) AS age,
        CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender FROM customer""",
    "policy": """SELECT c_custkey AS patient_key, CAST(20 + c_custkey % 60 AS INTEGER) AS age,
        CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, n_name AS city, c_mktsegment AS classname,
        c_acctbal AS premium, DATE '1999-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS policyexpirydate
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "provider": """SELECT s_suppkey AS provider_license_key, n_name AS specialty,
        r_name || CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN ' Hospital' ELSE ' Clinic' END AS provider_type
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "careteam": """SELECT l_orderkey AS claim_request_bundle_id, l_suppkey AS practitioner_license,
        n_name AS practice_desc FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN nation ON s_nationkey = n_nationkey""",
}


def using(views: str, body: str) -> str:
    """``body`` after a WITH clause naming the given views; it may add CTEs of its own."""
    named = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in views.split())
    return f"WITH {named}\n{body}"


def prefix_sql(column: str, prefixes: list[str]) -> str:
    tests = " OR ".join(f"starts_with({column}, '{p}')" for p in prefixes)
    return f"COALESCE({tests}, FALSE)"


def condition_sql(name: str, column: str = "principal_diagnosis_code") -> str:
    return prefix_sql(column, CONDITIONS[name])
