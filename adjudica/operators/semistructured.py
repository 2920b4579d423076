"""Member JSON and wide claim dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

USER_SCHEMA = (
    "name string, gender string, birth_date string, salary string, had_chronic_diseases string, "
    "marital_status string, nationality string"
)
DEFAULT_AGE = 30


def user_json_features(df: DataFrame, text: str, as_of_year: int = 2025) -> DataFrame:
    """Member features from a JSON column; unusable JSON gives nulls and 0 for the chronic flag.

    Age is the as-of year minus the first four characters of the birth date, 30 when
    those are no number, null without a birth date.
    """
    user = F.from_json(F.col(text), USER_SCHEMA)
    born = F.col("_user.birth_date")
    year = F.substring(born, 1, 4).try_cast("int")
    age = F.when(F.coalesce(born, F.lit("")) != "", F.coalesce(F.lit(as_of_year) - year, F.lit(DEFAULT_AGE)))
    chronic = F.coalesce(F.col("_user.had_chronic_diseases").try_cast("int"), F.lit(0))
    return (
        df.withColumn("_user", user)
        .withColumns(
            {
                "user_id": F.col("_user.name"),
                "gender": F.col("_user.gender"),
                "birth_date": born,
                "salary_range": F.col("_user.salary"),
                "had_chronic_diseases": chronic,
                "marital_status": F.col("_user.marital_status"),
                "nationality": F.col("_user.nationality"),
                "age": age,
            }
        )
        .drop("_user")
    )


def flatten_claim_items(dump: DataFrame) -> DataFrame:
    """Wide dump rows as one row per billed item: a service, a medication, both or none.

    An amount that is no number becomes null for that item alone; a missing one is 0.
    """
    names = set(dump.columns)

    def field(name: str) -> Column:
        return F.col(f"`{name}`") if name in names else F.lit(None).cast("string")

    claim = field("Name") if "Name" in names else field("ID") if "ID" in names else F.lit("")

    def item(kind: str, code: str, diagnosis: str, amount: str) -> Column:
        raw = field(amount)
        number = F.when(F.coalesce(raw, F.lit("")) == "", F.lit(0.0)).otherwise(raw.try_cast("double"))
        return F.struct(
            F.lit(kind).alias("type"),
            field(code).alias("code"),
            field(diagnosis).alias("diagnosis"),
            number.alias("amount"),
        )

    items = F.array(
        item("Service", "Service Code (Service Items)", "Diagnosis Code (Service Items)",
             "Billed Net Amount (Service Items)"),
        item("Medication", "Product Code (Medications)", "Diagnosis Code (Medications)", "Net Amount (Medications)"),
    )
    # Filtering after the generator, not inside it, keeps both in generated code.
    return dump.select(claim.alias("claim_id"), F.inline(items)).filter(F.col("code").isNotNull())
