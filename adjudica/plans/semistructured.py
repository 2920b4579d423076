"""Member JSON and wide claim dumps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import claims as C
from ..operators import semistructured as J
from ..registry import query
from ..sources import claims_model as M
from .features import GENDER_RULES
from .rule_lists import STANDARD_OF_CARE, mined_pairs, mined_sql
from .views import using

JSON_CTE = """, texts AS (SELECT patient_key, CASE WHEN patient_key % 11 = 0 THEN '{"name": broken'
    WHEN patient_key % 7 = 0 THEN '{"name":"EMP-' || patient_key || '","gender":"Male"}'
    WHEN patient_key % 5 = 0 THEN '{"name":"EMP-' || patient_key || '","gender":"Female","birth_date":"unknown"}'
    ELSE '{"name":"EMP-' || patient_key || '","gender":"Male","birth_date":"' || (2005 - age)
    || '-01-01","had_chronic_diseases":' || (patient_key % 2) || '}' END AS txt FROM patient),
    users AS (SELECT patient_key, ok ->> '$.name' AS user_id, ok ->> '$.gender' AS gender,
    ok ->> '$.birth_date' AS birth_date, COALESCE(TRY_CAST(ok ->> '$.had_chronic_diseases' AS INTEGER), 0)
    AS had_chronic_diseases FROM (SELECT *, CASE WHEN json_valid(txt) THEN txt::JSON END AS ok FROM texts))"""


def user_texts(spark, sf_dir):
    """One JSON text per member; some are broken, some lack the birth date or hold no date."""
    key = F.col(C.MEMBER)
    name = F.concat(F.lit('{"name":"EMP-'), key.cast("string"), F.lit('","gender":"'))
    year = (2005 - F.col("age")).cast("string")
    chronic = (key % 2).cast("string")
    text = (
        F.when(key % 11 == 0, '{"name": broken')
        .when(key % 7 == 0, F.concat(name, F.lit('Male"}')))
        .when(key % 5 == 0, F.concat(name, F.lit('Female","birth_date":"unknown"}')))
        .otherwise(
            F.concat(name, F.lit('Male","birth_date":"'), year, F.lit('-01-01","had_chronic_diseases":'), chronic,
                     F.lit("}"))
        )
    )
    return M.patient(spark, sf_dir).select(C.MEMBER, text.alias("user_json"))


@query(
    "user_json_features",
    using(
        "patient",
        JSON_CTE
        + """ SELECT patient_key, COALESCE(user_id, '-') AS user_id, COALESCE(gender, '-') AS gender,
        COALESCE(birth_date, '-') AS birth_date, had_chronic_diseases, CAST(CASE WHEN birth_date IS NULL THEN -1
        ELSE COALESCE(2025 - TRY_CAST(substr(birth_date, 1, 4) AS INTEGER), 30) END AS INTEGER) AS age FROM users""",
    ),
)
def user_json_features(spark, sf_dir):
    users = J.user_json_features(user_texts(spark, sf_dir), "user_json", 2025)
    dash = F.lit("-")
    return users.select(
        C.MEMBER, F.coalesce("user_id", dash).alias("user_id"), F.coalesce("gender", dash).alias("gender"),
        F.coalesce("birth_date", dash).alias("birth_date"), "had_chronic_diseases",
        F.coalesce("age", F.lit(-1)).alias("age"),
    )


DUMP_CTE = """, wide AS (SELECT CAST(claim_request_bundle_id AS VARCHAR) AS claim_id, line_no,
    CASE WHEN line_no % 3 <> 0 THEN procedure_code END AS s_code, CASE WHEN line_no % 2 = 0 THEN activity_type END
    AS m_code, principal_diagnosis_code AS diagnosis, CASE WHEN line_no = 5 THEN 'n/a' WHEN line_no = 4 THEN NULL
    ELSE CAST(CAST(quantity AS INTEGER) AS VARCHAR) END AS amount FROM item),
    flat AS (SELECT claim_id, line_no, 'Service' AS type, s_code AS code, diagnosis, amount FROM wide
    WHERE s_code IS NOT NULL UNION ALL SELECT claim_id, line_no, 'Medication', m_code, diagnosis, amount FROM wide
    WHERE m_code IS NOT NULL)"""


def claim_dump(spark, sf_dir):
    """Billed lines in the wide export layout: text only, a service and a medication section per row."""
    line = F.col("line_no")
    amount = F.when(line == 5, "n/a").when(line != 4, F.col("quantity").cast("int").cast("string"))
    return M.claim_item(spark, sf_dir).select(
        F.col(C.CLAIM).cast("string").alias("Name"),
        F.when(line % 3 != 0, F.col("procedure_code")).alias("Service Code (Service Items)"),
        F.col(C.DIAGNOSIS).alias("Diagnosis Code (Service Items)"),
        amount.alias("Billed Net Amount (Service Items)"),
        F.when(line % 2 == 0, F.col("activity_type")).alias("Product Code (Medications)"),
        F.col(C.DIAGNOSIS).alias("Diagnosis Code (Medications)"),
        amount.alias("Net Amount (Medications)"),
    )


@query(
    "flatten_claim_items",
    using(
        "item",
        DUMP_CTE
        + """ SELECT claim_id, type, code, diagnosis, COALESCE(CASE WHEN amount IS NULL THEN 0.0 ELSE
        TRY_CAST(amount AS DOUBLE) END, -1) AS amount FROM flat""",
    ),
)
def flatten_claim_items(spark, sf_dir):
    items = J.flatten_claim_items(claim_dump(spark, sf_dir))
    return items.withColumn("amount", F.coalesce("amount", F.lit(-1.0)))


@query(
    "real_claim_features",
    using(
        "header item patient",
        JSON_CTE
        + DUMP_CTE
        + mined_sql("mined", "principal_diagnosis_code", "procedure_code", STANDARD_OF_CARE)
        + """, pairs AS (SELECT principal_diagnosis_code AS d, procedure_code AS p FROM mined),
        x AS (SELECT f.claim_id, type, code, CASE gender WHEN 'Male' THEN 'M' WHEN 'Female' THEN 'F' END AS g,
        pairs.d IS NOT NULL AS allowed FROM flat f JOIN header h ON CAST(h.claim_request_bundle_id AS VARCHAR) = claim_id
        JOIN users USING (patient_key) LEFT JOIN pairs ON pairs.d = diagnosis AND pairs.p = code),
        s AS (SELECT *, CASE WHEN allowed THEN 1 ELSE 0 END AS soc, CASE WHEN g IS NULL THEN 1 WHEN code = 'Brand#3'
        THEN CASE WHEN g = 'F' THEN 1 ELSE 0 END WHEN code = 'Brand#7' THEN CASE WHEN g = 'M' THEN 1 ELSE 0 END
        ELSE 1 END AS gen FROM x)
        SELECT claim_id, type, code, CAST(soc AS INTEGER) AS is_soc_compliant, CAST(gen AS INTEGER)
        AS is_gender_compliant, (soc + gen) / 2.0::DOUBLE AS medical_score FROM s""",
    ),
)
def real_claim_features(spark, sf_dir):
    """Dump items with the member's JSON and both medical checks; the score is their mean."""
    items = J.flatten_claim_items(claim_dump(spark, sf_dir))
    users = J.user_json_features(user_texts(spark, sf_dir), "user_json").select(C.MEMBER, "gender")
    owner = M.claim_header(spark, sf_dir).select(F.col(C.CLAIM).cast("string").alias("claim_id"), C.MEMBER)
    pairs = mined_pairs(spark, sf_dir, C.DIAGNOSIS, "procedure_code", STANDARD_OF_CARE).select(
        F.col(C.DIAGNOSIS).alias("diagnosis"), F.col("procedure_code").alias("code"), F.lit(True).alias("_allowed")
    )
    rules = spark.createDataFrame(list(GENDER_RULES.items()), "code string, allowed_genders array<string>")
    joined = (
        items.join(owner, "claim_id").join(users, C.MEMBER)
        .join(pairs, ["diagnosis", "code"], "left").join(rules, "code", "left")
    )
    checked = joined.withColumn("is_soc_compliant", X.soc_compliant("diagnosis", "code", "_allowed")).withColumn(
        "is_gender_compliant", X.gender_compliant("code", "gender", "allowed_genders")
    )
    score = (F.col("is_soc_compliant") + F.col("is_gender_compliant")) / 2.0
    return checked.select(
        "claim_id", "type", "code", "is_soc_compliant", "is_gender_compliant", score.alias("medical_score")
    )
