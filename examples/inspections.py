"""Food-inspection pipeline (all-string raw -> staged -> enriched -> marts).

Built only from library operators; the rules below are this dataset's facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions import columns as C
from stratum.functions.numeric import flag_sum, pct_decimal
from stratum.operators import aggregates as A
from stratum.operators import quality as Q
from stratum.operators import windows as W
from stratum.plans.models import Project, column_tests

# Fixed values of the inspection models: first matching rule wins.
RISK_RULES = [(["1"], "High"), (["2"], "Medium"), (["3"], "Low")]
RISK_RANK = {"High": 1, "Medium": 2, "Low": 3}
RESULT_RULES = [(["pass"], "Pass"), (["fail"], "Fail"), (["no entry"], "No Entry"),
                (["out of business"], "Out of Business")]
FACILITY_RULES = [(["restaurant"], "Restaurant"), (["school"], "School"),
                  (["grocery", "store"], "Grocery/Store"), (["bakery"], "Bakery"),
                  (["daycare", "children"], "Childcare"), (["hospital", "care"], "Healthcare")]
ERAS = [((2010, 2014), "2010-2014"), ((2015, 2019), "2015-2019")]
RECENT_ERA = (2020, "2020+")
OLD_ERA = "Before 2010"
DEFAULT_FACILITY = "Unknown"
DEFAULT_CITY = "CHICAGO"
DEFAULT_STATE = "IL"
VIOLATION_SPLIT = "|"


def stg_inspections(raw: DataFrame) -> DataFrame:
    """``raw`` has normalised column names (see ``columns.normalise_names``)."""
    risk = C.categorise("risk", RISK_RULES, "Unknown")
    result = C.categorise("results", RESULT_RULES, "Other")
    date = C.parse_date(F.col("inspection_date"), "M/d/yyyy")
    facility = C.pg_initcap(F.trim(C.fill_const("facility_type", DEFAULT_FACILITY)))
    # ids that are missing or not integers are rejected before anything else (S11, S17)
    return (raw.filter(C.safe_cast("inspection_id", "int").isNotNull())
            .select(
                C.safe_cast("inspection_id", "int").alias("inspection_id"),
                C.clean_upper("dba_name").alias("business_name"),
                C.clean_upper(F.coalesce("aka_name", "dba_name")).alias("aka_name"),
                C.safe_cast("license", "bigint").alias("license_number"),
                facility.alias("facility_type"),
                risk.alias("risk_level"),
                C.code_map(risk, RISK_RANK, 99).cast("int").alias("risk_rank"),
                F.trim("address").alias("address"),
                F.trim(C.fill_const("city", DEFAULT_CITY)).alias("city"),
                F.trim(C.fill_const("state", DEFAULT_STATE)).alias("state"),
                F.trim("zip").alias("zip_code"),
                date.alias("inspection_date"),
                F.year(date).cast("int").alias("inspection_year"),
                F.month(date).cast("int").alias("inspection_month"),
                F.trim("inspection_type").alias("inspection_type"),
                result.alias("result"),
                F.coalesce(C.contains_any("results", ["pass"]), F.lit(False)).alias("passed"),
                F.col("violations").alias("violations_raw"),
                C.split_count("violations", VIOLATION_SPLIT).cast("int").alias("violation_count"),
                C.safe_cast("latitude", "double").alias("latitude"),
                C.safe_cast("longitude", "double").alias("longitude"),
                "_ingested_at", "_source_file"))


def int_inspections_enriched(stg: DataFrame) -> DataFrame:
    y = F.col("inspection_year")
    era_rules = [(y.between(lo, hi), label) for (lo, hi), label in ERAS]
    era_rules.append((y >= RECENT_ERA[0], RECENT_ERA[1]))
    return stg.select(
        "*",
        C.bucketise(era_rules, OLD_ERA).alias("era"),
        C.categorise("facility_type", FACILITY_RULES, "Other").alias("facility_category"),
        (F.col("risk_rank") == 1).alias("is_high_risk"),
        (F.col("violation_count") >= 3).alias("has_multiple_violations"))


def _graded(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("result").isin("Pass", "Fail"))


def _measures(extra=None):
    n = F.count(F.lit(1))
    m = {"total_inspections": n,
         "total_passed": flag_sum(F.col("passed")),
         "total_failed": flag_sum(~F.col("passed")),
         "pass_rate_pct": pct_decimal(flag_sum(F.col("passed")), n),
         "avg_violations": F.round(F.avg("violation_count"), 2)}
    m.update(extra or {})
    return m


def fct_inspection_summary(enriched: DataFrame) -> DataFrame:
    return A.summarise(_graded(enriched), ["facility_category", "risk_level", "risk_rank"],
                       _measures({"max_violations": F.max("violation_count")}))


def fct_yearly_trends(enriched: DataFrame) -> DataFrame:
    g = _graded(enriched).filter(F.col("inspection_year").between(2010, 2024))
    m = _measures({"unique_businesses": F.count_distinct("business_name"),
                   "high_risk_inspections": flag_sum(F.col("risk_rank") == 1)})
    m.pop("total_failed")
    return A.summarise(g, ["inspection_year"], m)


def fct_top_failing_businesses(enriched: DataFrame, n: int = 50) -> DataFrame:
    keys = ["business_name", "facility_category", "risk_level", "zip_code"]
    stats = A.summarise(_graded(enriched), keys,
                        _measures({"last_inspection_date": F.max("inspection_date")}),
                        having=F.col("total_inspections") >= 3)
    # keys as tie-breakers make the top-n deterministic (S18)
    return W.top_k(stats, [F.col("total_failed").desc(), F.col("pass_rate_pct").asc(), *keys], n)


def top_failing_by_risk(enriched: DataFrame, since_year: int = 2015, k: int = 3) -> DataFrame:
    g = _graded(enriched).filter(F.col("inspection_year") >= since_year)
    stats = A.summarise(g, ["business_name", "risk_level"], {
        "total": F.count(F.lit(1)),
        "failures": flag_sum(~F.col("passed")),
        "avg_violations": F.round(F.avg("violation_count"), 2)},
        having=F.col("total") >= 3)
    return W.top_n_per_group(stats, ["risk_level"], [F.col("failures").desc()], k,
                             rank_name="rank_in_risk")


def raw_metrics(raw: DataFrame) -> DataFrame:
    return Q.metrics(raw, {
        "total": F.count(F.lit(1)),
        "null_ids": F.count_if(F.col("inspection_id").isNull()),
        "rejected_ids": F.count_if(C.cast_rejected("inspection_id", "int")),
        "unique_ids": F.count_distinct("inspection_id"),
        "null_results": F.count_if(F.col("results").isNull()),
    })


CHECKS = [
    Q.Check("no_null_ids", "null_ids = 0", "concat(null_ids, ' null inspection IDs')"),
    Q.Check("unique_ids", "unique_ids = total", "concat(total - unique_ids, ' duplicate IDs')"),
    Q.Check("null_results_under_10pct", "null_results <= total * 0.1",
            "concat(null_results, ' null results')"),
]


def project(spark, raw: DataFrame, target_dir: str | None = None) -> Project:
    """The models with the tests that they declare."""
    p = Project(spark, target_dir)
    mat = "table" if target_dir else "view"
    p.source("raw_inspections", lambda: raw)
    p.model("stg_inspections", ["raw_inspections"], tests={
        **column_tests({
            "inspection_id": ["unique", "not_null"],
            "result": ["not_null", [label for _, label in RESULT_RULES] + ["Other"]],
            "risk_level": ["not_null", [label for _, label in RISK_RULES] + ["Unknown"]],
            "passed": ["not_null"],
        }),
        "violation_count_non_negative": lambda d: Q.test_non_negative(d, "violation_count"),
    })(lambda raw_inspections: stg_inspections(raw_inspections))
    p.model("int_inspections_enriched", ["stg_inspections"])(
        lambda stg_inspections: int_inspections_enriched(stg_inspections))
    for mart, fn, tests in [
            ("fct_inspection_summary", fct_inspection_summary,
             {"pass_rate_bounds": lambda d: Q.test_bounds(d, "pass_rate_pct", 0, 100)}),
            ("fct_yearly_trends", fct_yearly_trends, {}),
            ("fct_top_failing_businesses", fct_top_failing_businesses, {})]:
        p.model(mart, ["int_inspections_enriched"], materialize=mat, tests=tests)(
            lambda int_inspections_enriched, fn=fn: fn(int_inspections_enriched))
    return p


def pass_by_risk(enriched: DataFrame) -> DataFrame:
    """Gold pass rate per risk level (M-15)."""
    m = _measures()
    return A.summarise(_graded(enriched), ["risk_level"],
                       {k: m[k] for k in ("total_inspections", "total_passed", "pass_rate_pct",
                                          "avg_violations")})


def medallion(spark, csv_path: str, out: str, run_ts: str):
    """All-string bronze -> silver by inspection year -> gold marts (M-14)."""
    from stratum.functions.columns import normalise_names
    from stratum.operators.windows import dedup
    from stratum.plans import layers
    from stratum.sources.files import read_csv_header, read_csv_strings

    b, s, g = f"{out}/bronze", f"{out}/silver", f"{out}/gold"
    raw = normalise_names(read_csv_strings(spark, csv_path, read_csv_header(spark, csv_path)))
    layers.write_checked(layers.bronze_stamp(raw, run_ts), b)
    bronze = spark.read.parquet(b)
    warn = [Q.Check(c.name, c.rule, c.details, "warn") for c in CHECKS]
    status = Q.gate(Q.verdicts(raw_metrics(bronze), warn, "inspections_bronze"))
    staged = dedup(stg_inspections(bronze), ["inspection_id"],
                   [F.col("inspection_date").desc_nulls_last(), F.col("result"), F.col("business_name")])
    layers.write_partitioned(int_inspections_enriched(staged), s, ["inspection_year"])
    silver = spark.read.parquet(s)
    for name, mart in [("pass_by_risk", pass_by_risk(silver)),
                       ("yearly_trends", fct_yearly_trends(silver)),
                       ("top_failing_by_risk", top_failing_by_risk(silver))]:
        layers.publish(mart, f"{g}/{name}")
    return status, layers.layer_report(spark, {"bronze": b, "silver": s,
                                               "gold": f"{g}/pass_by_risk"})
