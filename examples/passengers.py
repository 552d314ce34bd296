"""Passenger pipeline (staging -> enriched -> marts) on library operators.

Dataset facts (column names, bucket edges, labels) live here, not in the
library. ``project(spark, raw)`` wires the models into a :class:`Project`
with the tests the staging and mart models declare.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import columns as C
from stratum.functions.numeric import mean_decimal, pct_decimal
from stratum.operators import aggregates as A
from stratum.operators import quality as Q
from stratum.plans.models import Project, column_tests

RAW_SCHEMA = T.StructType([
    T.StructField("PassengerId", T.IntegerType()), T.StructField("Survived", T.IntegerType()),
    T.StructField("Pclass", T.IntegerType()), T.StructField("Name", T.StringType()),
    T.StructField("Sex", T.StringType()), T.StructField("Age", T.DoubleType()),
    T.StructField("SibSp", T.IntegerType()), T.StructField("Parch", T.IntegerType()),
    T.StructField("Ticket", T.StringType()), T.StructField("Fare", T.DoubleType()),
    T.StructField("Cabin", T.StringType()), T.StructField("Embarked", T.StringType()),
])

# Fixed values of the passenger models.
RENAMES = {"PassengerId": "passenger_id", "Pclass": "passenger_class", "Name": "full_name",
           "Sex": "gender", "Age": "age", "Survived": "survived", "Ticket": "ticket_number",
           "Fare": "fare_gbp", "Embarked": "embarkation_code", "SibSp": "siblings_spouses",
           "Parch": "parents_children"}
DEFAULT_AGE = 28.0
DEFAULT_PORT = "S"
PORTS = {"C": "Cherbourg", "Q": "Queenstown", "S": "Southampton"}
AGE_GROUPS = [(13, "child"), (18, "teenager"), (60, "adult")]
AGE_TOP = "senior"
FARE_TIERS = [(7.9, "budget"), (14.5, "economy"), (31.0, "standard")]
FARE_TOP = "premium"
CLASS_LABELS = {1: "First", 2: "Second"}
CLASS_OTHER = "Third"


def stg_passengers(raw: DataFrame) -> DataFrame:
    r = C.rename(raw, RENAMES, drop=["Cabin"])
    code = C.fill_const("embarkation_code", DEFAULT_PORT)
    return r.select(
        "passenger_id", "passenger_class", "full_name",
        F.lower("gender").alias("gender"),
        C.fill_const("age", DEFAULT_AGE).alias("age"),
        "survived",
        F.when(F.col("survived") == 1, "survived").otherwise("died").alias("survival_status"),
        "ticket_number",
        C.money_round("fare_gbp", 2).alias("fare_gbp"),
        code.alias("embarkation_code"),
        # derived from the filled code (S6): NULL ports become Southampton
        C.code_map(code, PORTS, "Unknown").alias("embarkation_port"),
        "siblings_spouses", "parents_children",
        (F.col("siblings_spouses") + F.col("parents_children")).alias("family_size"))


def int_passengers_enriched(stg: DataFrame) -> DataFrame:
    return stg.select(
        "*",
        C.thresholds("age", AGE_GROUPS, AGE_TOP).alias("age_group"),
        C.thresholds("fare_gbp", FARE_TIERS, FARE_TOP).alias("fare_tier"),
        (F.col("family_size") == 0).alias("is_solo_traveller"),
        C.code_map("passenger_class", CLASS_LABELS, CLASS_OTHER).alias("class_label"))


def fct_survival_by_class(enriched: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return A.summarise(enriched, ["passenger_class", "class_label"], {
        "total_passengers": n,
        "total_survived": F.sum("survived").cast("long"),
        "total_died": F.sum(F.lit(1) - F.col("survived")).cast("long"),
        "survival_rate_pct": pct_decimal(F.sum("survived"), n),
        "avg_fare_gbp": mean_decimal("fare_gbp", 2),
        "avg_age": F.round(F.avg("age"), 1),
        "solo_travellers": F.count_if(F.col("is_solo_traveller")),
        "female_passengers": F.count_if(F.col("gender") == "female"),
        "male_passengers": F.count_if(F.col("gender") == "male"),
    })


def fct_survival_by_demographics(enriched: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return A.segment_rates(
        enriched, {"gender": "gender", "age_group": "age_group", "fare_tier": "fare_tier"},
        {"total": n, "survived": F.sum("survived").cast("long"),
         "survival_rate_pct": pct_decimal(F.sum("survived"), n)})


def dq_metrics(raw: DataFrame) -> DataFrame:
    return Q.metrics(raw, {
        "total_rows": F.count(F.lit(1)),
        "null_names": F.count_if(F.col("Name").isNull()),
        "negative_fares": F.count_if(F.col("Fare") < 0),
        "invalid_ages": F.count_if((F.col("Age") < 0) | (F.col("Age") > 120)),
        "unique_passengers": F.count_distinct("PassengerId"),
    })


CHECKS = [
    Q.Check("no_null_names", "null_names = 0", "concat(null_names, ' nulls found')"),
    Q.Check("no_negative_fares", "negative_fares = 0", "concat(negative_fares, ' negative fares')"),
    Q.Check("valid_ages", "invalid_ages = 0", "concat(invalid_ages, ' invalid ages')"),
    Q.Check("unique_passengers", "unique_passengers = total_rows",
            "concat(unique_passengers, ' unique of ', total_rows, ' total')"),
]


def project(spark, raw: DataFrame, target_dir: str | None = None) -> Project:
    p = Project(spark, target_dir)
    p.source("raw_passengers", lambda: raw)
    p.model("stg_passengers", ["raw_passengers"], tests=column_tests({
        "passenger_id": ["unique", "not_null"],
        "passenger_class": ["not_null", [1, 2, 3]],
        "survived": ["not_null", [0, 1]],
        "gender": ["not_null", ["male", "female"]],
        "fare_gbp": ["not_null"],
        "embarkation_code": [["C", "Q", "S"]],
    }))(lambda raw_passengers: stg_passengers(raw_passengers))
    p.model("int_passengers_enriched", ["stg_passengers"], tests=column_tests({
        "passenger_id": ["unique", "not_null"],
        "age_group": [[v for _, v in AGE_GROUPS] + [AGE_TOP]],
        "fare_tier": [[v for _, v in FARE_TIERS] + [FARE_TOP]],
    }))(lambda stg_passengers: int_passengers_enriched(stg_passengers))
    mat = "table" if target_dir else "view"
    p.model("fct_survival_by_class", ["int_passengers_enriched"], materialize=mat, tests={
        **column_tests({"passenger_class": ["unique", "not_null"], "survival_rate_pct": ["not_null"],
                        "total_passengers": ["not_null"]}),
        "rate_bounds": lambda d: Q.test_bounds(d, "survival_rate_pct", 0, 100),
    })(lambda int_passengers_enriched: fct_survival_by_class(int_passengers_enriched))
    p.model("fct_survival_by_demographics", ["int_passengers_enriched"], materialize=mat, tests=column_tests({
        "dimension": ["not_null", ["gender", "age_group", "fare_tier"]],
        **{c: ["not_null"] for c in ("segment", "total", "survived", "survival_rate_pct")},
    }))(
        lambda int_passengers_enriched: fct_survival_by_demographics(int_passengers_enriched))
    p.model("reconcile", ["raw_passengers", "fct_survival_by_class"])(
        lambda raw_passengers, fct_survival_by_class: Q.reconcile(
            raw_passengers, fct_survival_by_class, "total_passengers"))
    p.add_test("reconcile", "totals_match", lambda d: d.filter(~F.col("rows_match")))
    return p


def survival_counts(enriched: DataFrame) -> DataFrame:
    """Passengers by port x survival status (M-8)."""
    return (enriched.filter(F.col("embarkation_code").isNotNull())
            .groupBy("embarkation_port", "survival_status").agg(F.count(F.lit(1)).alias("n")))


def medallion(spark, csv_path: str, out: str, run_ts: str):
    """Bronze (CSV + lineage) -> silver (clean, dedup, by class) -> gold marts (M-7).

    The bronze checks are reported, not enforced (severity ``warn``), as in
    the original flow; returns (dq status, layer report frame).
    """
    from stratum.operators.windows import dedup
    from stratum.plans import layers
    from stratum.sources.files import read_csv_typed

    b, s, g = f"{out}/bronze", f"{out}/silver", f"{out}/gold"
    layers.write_checked(layers.bronze_stamp(read_csv_typed(spark, csv_path, RAW_SCHEMA), run_ts), b)
    raw = spark.read.parquet(b)
    warn = [Q.Check(c.name, c.rule, c.details, "warn") for c in CHECKS]
    status = Q.gate(Q.verdicts(dq_metrics(raw), warn, "passengers_bronze"))
    enriched = int_passengers_enriched(stg_passengers(raw.filter(F.col("PassengerId").isNotNull())))
    silver = dedup(enriched.withColumn("_processed_at", F.lit(run_ts).cast("timestamp_ntz")),
                   ["passenger_id"], ["fare_gbp", "full_name", "ticket_number"])
    layers.write_partitioned(silver, s, ["passenger_class"])
    silver_df = spark.read.parquet(s)
    layers.publish(fct_survival_by_class(silver_df), f"{g}/survival_by_class")
    layers.publish(fct_survival_by_demographics(silver_df), f"{g}/survival_by_demographics")
    return status, layers.layer_report(spark, {"bronze": b, "silver": s,
                                               "gold": f"{g}/survival_by_class"})
