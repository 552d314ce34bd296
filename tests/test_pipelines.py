"""Passenger and inspection pipelines on synthetic rows (FIXTURES.md B1, B3)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from examples import inspections as I
from examples import passengers as TI
from stratum.functions import columns as C
from stratum.operators import quality as Q
from stratum.operators import windows as W
from stratum.plans.layers import bronze_stamp
from stratum.sources import files

PASSENGERS = '''PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked
1,0,3,"Braund, Mr. Owen",male,22,1,0,A/5 21171,7.25,,S
2,1,1,"Parker, Mrs. Susan ""Suzette""",female,38,1,0,PC 17599,71.2833,C85,C
3,1,3,"Heikkinen, Miss. Laina",FEMALE,,0,0,STON/O2,7.9,,
4,1,1,"Futrelle, Mrs. Lily",female,12.9,1,0,113803,53.1,C123,S
5,0,3,"Allen, Mr. William",Male,13,0,0,373450,8.05,,S
6,0,3,"Moran, Mr. James",male,17.9,0,0,330877,8.4583,,Q
7,0,1,"McCarthy, Mr. Tim",male,18,0,0,17463,51.8625,E46,S
8,0,3,"Palsson, Master. Gus",male,59.9,3,1,349909,21.075,,S
9,1,3,"Johnson, Mrs. Olga",female,60,0,2,347742,11.1333,,S
10,1,2,"Nasser, Mrs. Nora",female,14,1,0,237736,30.0708,,C
11,1,2,"Sand, Miss. Marguerite",female,4,1,1,PP 9549,14.49,G6,S
12,1,1,"Bonnell, Miss. Eliza",female,58,0,0,113783,14.5,C103,S
13,0,3,"Saunders, Mr. Will",male,20,0,0,A/5. 2151,30.99,,S
14,0,3,"Anders, Mr. Anders",male,39,1,5,347082,31.0,,S
15,0,3,"Vest, Miss. Hulda",female,14,0,0,350406,7.89,,S
16,1,2,"Hewitt, Mrs. Mary",female,55,0,0,248706,-16.0,,S
17,0,1,"Top, Mr. A",male,40,0,0,X1,263.0,,S
18,0,1,"Top, Mr. B",male,41,0,0,X2,263.0,,S
19,1,1,"Top, Mrs. C",female,42,0,0,X3,263.0,,S
16,1,2,"Hewitt, Mrs. Mary",female,55,0,0,248706,16.0,,S
'''

INSPECTIONS = """Inspection ID,DBA Name,AKA Name,License #,Facility Type,Risk,Address,City,State,Zip,Inspection Date,Inspection Type,Results,Violations,Latitude,Longitude
101,Joe's Grill,,123,Restaurant,Risk 1 (High),1 Main St,,,60601,01/05/2024,Canvass,Pass,a | b,41.88,-87.63
102, grocery co ,NA,456,GROCERY/STORE,Risk 2 (Medium),2 Main St,CHICAGO,IL,60602,1/5/2024,Canvass,Pass w/ Conditions,a|b|,41.89,-87.62
103,Kids Place,"",789,Daycare (2 - 6 Years),Risk 3 (Low),3 Main St,,,60603,13/45/2024,License,Fail,,x,-87.61
104,Care Home,,x12,Day Care,All,4 Main St,,,60604,,License,No Entry,"",41.9,-87.6
105,Kids Svc,,1,CHILDREN'S SERVICES FACILITY,,5 Main St,,,60605,02/29/2023,Canvass,Out of Business,a,41.91,-87.59
abc,Bad Id,,2,Restaurant,Risk 1 (High),6 Main St,,,60606,03/01/2020,Canvass,Not Ready,a,41.92,-87.58
101,Joe's Grill,,123,Restaurant,Risk 1 (High),1 Main St,,,60601,01/06/2024,Canvass,Fail,a|b|c,41.88,-87.63
,No Id,,3,Bakery,Risk 2 (Medium),7 Main St,,,60607,04/01/2019,Canvass,Fail,a,41.93,-87.57
109,Null Result,,4,School,Risk 1 (High),8 Main St,,,60608,05/01/2012,Canvass,,   ,41.94,-87.56
"""


def _write(tmp_dir, name, text):
    path = os.path.join(tmp_dir, name)
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.fixture(scope="module")
def passengers(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("pax"))
    return files.read_csv_typed(spark, _write(d, "passengers.csv", PASSENGERS), TI.RAW_SCHEMA)


@pytest.fixture(scope="module")
def raw_inspections(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("insp"))
    path = _write(d, "inspections.csv", INSPECTIONS)
    header = files.read_csv_header(spark, path)
    raw = C.normalise_names(files.read_csv_strings(spark, path, header))
    return bronze_stamp(raw, "2024-06-01 00:00:00")


def _by(df, key):
    return {r[key]: r for r in df.collect()}


# ------------------------------------------------------------------ passengers

def test_csv_quotes_and_nulls(passengers):
    rows = _by(passengers.filter(F.col("PassengerId") <= 3), "PassengerId")
    assert rows[2]["Name"] == 'Parker, Mrs. Susan "Suzette"'  # S14
    assert rows[1]["Name"] == "Braund, Mr. Owen"
    assert rows[3]["Age"] is None and rows[3]["Embarked"] is None


def test_staging_and_buckets(passengers):
    e = TI.int_passengers_enriched(TI.stg_passengers(passengers))
    rows = {r["passenger_id"]: r for r in e.filter(F.col("fare_gbp") >= 0).collect()}
    assert rows[3]["gender"] == "female" and rows[5]["gender"] == "male"  # S7
    assert rows[3]["age"] == 28.0  # S5
    assert (rows[3]["embarkation_code"], rows[3]["embarkation_port"]) == ("S", "Southampton")  # S6
    ages = {i: rows[i]["age_group"] for i in (4, 5, 6, 7, 8, 9)}
    assert ages == {4: "child", 5: "teenager", 6: "teenager", 7: "adult", 8: "adult", 9: "senior"}
    fares = {i: rows[i]["fare_tier"] for i in (15, 3, 11, 12, 13, 14)}
    assert fares == {15: "budget", 3: "economy", 11: "economy", 12: "standard",
                     13: "standard", 14: "premium"}
    assert str(rows[2]["fare_gbp"]) == "71.28"
    assert rows[1]["class_label"] == "Third" and rows[2]["class_label"] == "First"
    assert rows[3]["is_solo_traveller"] and not rows[1]["is_solo_traveller"]


def test_dq_gate_lists_failures(passengers):
    verdicts = Q.verdicts(TI.dq_metrics(passengers), TI.CHECKS, "passengers")
    got = {r["check_name"]: (r["passed"], r["details"]) for r in verdicts.collect()}
    assert got["no_negative_fares"] == (False, "1 negative fares")
    assert got["unique_passengers"] == (False, "19 unique of 20 total")
    assert got["valid_ages"] == (True, "0 invalid ages")
    with pytest.raises(Q.DataQualityError, match="no_negative_fares.*unique_passengers"):
        Q.gate(verdicts)


def test_warning_severity(spark):
    m = spark.createDataFrame([(3, 1)], "total bigint, bad bigint")
    v = Q.verdicts(m, [Q.Check("few_bad", "bad = 0", "bad", "warn")], "t")
    assert Q.gate(v) == "dq_warning"


def test_project_runs_models_and_tests(spark, passengers, tmp_dir):
    clean = W.dedup(passengers.filter(F.col("Fare") >= 0), ["PassengerId"], ["Fare"])
    p = TI.project(spark, clean, tmp_dir)
    frames = p.run()
    by_class = _by(frames["fct_survival_by_class"], "passenger_class")
    assert by_class[1]["total_passengers"] == 7
    assert by_class[1]["total_survived"] == 4
    assert str(by_class[1]["survival_rate_pct"]) == "57.1"
    assert by_class[2]["total_passengers"] == 3 and by_class[2]["total_died"] == 0
    assert sum(r["total_passengers"] for r in by_class.values()) == 19
    failures = {(r["model"], r["test_name"]): r["failures"] for r in p.test().collect()}
    assert all(v == 0 for v in failures.values()), failures
    assert len(failures) == 26
    demo = frames["fct_survival_by_demographics"].collect()
    dims = {(r["dimension"], r["segment"]): r["total"] for r in demo}
    assert dims[("gender", "female")] + dims[("gender", "male")] == 19
    assert sum(v for (d, _), v in dims.items() if d == "fare_tier") == 19
    # table models were published and re-read from Parquet
    assert os.path.isdir(os.path.join(tmp_dir, "fct_survival_by_class"))


def test_project_tests_name_what_is_dirty(spark, passengers):
    odd = passengers.withColumn("Survived", F.when(F.col("PassengerId") == 1, 2).when(
        F.col("PassengerId") > 2, F.col("Survived")))
    p = TI.project(spark, odd)
    p.run()
    failures = {(r["model"], r["test_name"]): r["failures"] for r in p.test().collect() if r["failures"]}
    assert failures[("stg_passengers", "unique_passenger_id")] == 1
    assert failures[("int_passengers_enriched", "unique_passenger_id")] == 1
    assert failures[("stg_passengers", "not_null_survived")] == 1
    assert failures[("stg_passengers", "accepted_survived")] == 1
    assert set(failures) <= {("stg_passengers", "unique_passenger_id"), ("stg_passengers", "not_null_survived"),
                             ("stg_passengers", "accepted_survived"), ("int_passengers_enriched", "unique_passenger_id")}


def test_inspection_project_tests(spark, raw_inspections):
    def failing(raw):
        p = I.project(spark, raw)
        p.run()
        rows = p.test().collect()
        assert len(rows) == 9
        return {r["test_name"]: r["failures"] for r in rows if r["failures"]}
    assert failing(W.dedup(raw_inspections, ["inspection_id"], ["inspection_date"])) == {}
    assert failing(raw_inspections) == {"unique_inspection_id": 1}


def test_rank_ties_keep_all(passengers):
    first = passengers.filter(F.col("Pclass") == 1)
    top = W.top_n_per_group(first, ["Pclass"], [F.col("Fare").desc()], 1, dense_name="dense")
    assert sorted(r["PassengerId"] for r in top.collect()) == [17, 18, 19]  # S19


def test_dedup_is_deterministic(passengers):
    a = W.dedup(passengers, ["PassengerId"], ["Fare"]).filter(F.col("PassengerId") == 16)
    assert [r["Fare"] for r in a.collect()] == [-16.0]
    b = W.keep_latest(passengers, ["PassengerId"], ["Fare"]).filter(F.col("PassengerId") == 16)
    assert [r["Fare"] for r in b.collect()] == [16.0]


def test_unique_test_returns_failing_keys(passengers):
    stg = TI.stg_passengers(passengers)
    bad = Q.test_unique(stg, ["passenger_id"]).collect()
    assert [(r["passenger_id"], r["n_rows"]) for r in bad] == [(16, 2)]


# ------------------------------------------------------------------ inspections

def test_header_normalisation(raw_inspections):
    assert raw_inspections.columns[:4] == ["inspection_id", "dba_name", "aka_name", "license"]
    assert C.normalise_name("  Weird -- Name #1 ") == "weird_name_1"
    with pytest.raises(ValueError):
        C.normalise_names(raw_inspections.select("license", F.col("license").alias("License #")))


def test_staging_rules(raw_inspections):
    stg = I.stg_inspections(raw_inspections)
    rows = stg.collect()
    assert sorted(r["inspection_id"] for r in rows) == [101, 101, 102, 103, 104, 105, 109]
    r = {(x["inspection_id"], x["result"]): x for x in rows}
    a = r[(101, "Pass")]
    assert a["inspection_date"] == dt.date(2024, 1, 5)
    assert (a["risk_level"], a["risk_rank"], a["violation_count"]) == ("High", 1, 2)
    assert (a["city"], a["state"], a["aka_name"]) == ("CHICAGO", "IL", "JOE'S GRILL")
    b = r[(102, "Pass")]
    assert b["inspection_date"] == dt.date(2024, 1, 5)  # S12: 1/5/2024
    assert b["business_name"] == "GROCERY CO" and b["aka_name"] == "NA"  # S10, S15
    assert b["facility_type"] == "Grocery/Store" and b["violation_count"] == 3  # S13, S9
    c = r[(103, "Fail")]
    assert c["inspection_date"] is None and c["violation_count"] == 0
    assert c["aka_name"] == "KIDS PLACE" and c["latitude"] is None  # S11
    d = r[(104, "No Entry")]
    assert (d["risk_level"], d["risk_rank"], d["license_number"]) == ("Unknown", 99, None)
    assert d["violation_count"] == 0 and not d["passed"]
    e = r[(105, "Out of Business")]
    assert e["facility_type"] == "Children'S Services Facility"
    assert e["inspection_date"] is None and e["risk_level"] == "Unknown"
    f = r[(109, "Other")]
    assert not f["passed"] and f["violation_count"] == 0
    assert a["_source_file"] == "inspections.csv"


def test_enrichment_and_marts(raw_inspections):
    enr = I.int_inspections_enriched(I.stg_inspections(raw_inspections))
    cat = {x["inspection_id"]: (x["facility_category"], x["era"]) for x in enr.collect()}
    assert cat[102] == ("Grocery/Store", "2020+")
    assert cat[103] == ("Childcare", "Before 2010")  # NULL year lands in ELSE (S20)
    assert cat[104][0] == "Healthcare"  # "Day Care" via %care% (S21)
    assert cat[105][0] == "Childcare"
    assert cat[109] == ("School", "2010-2014")
    summary = I.fct_inspection_summary(enr).collect()
    assert sum(x["total_inspections"] for x in summary) == 4
    bad = Q.test_bounds(I.fct_inspection_summary(enr), "pass_rate_pct", 0, 100)
    assert bad.isEmpty()
    yearly = {x["inspection_year"]: x for x in I.fct_yearly_trends(enr).collect()}
    assert yearly[2024]["total_inspections"] == 3 and str(yearly[2024]["pass_rate_pct"]) == "66.7"
    assert Q.test_non_negative(enr, "violation_count").isEmpty()


def test_raw_dq_metrics(raw_inspections):
    m = I.raw_metrics(raw_inspections).collect()[0]
    assert (m["total"], m["null_ids"], m["rejected_ids"], m["null_results"]) == (9, 1, 1, 1)
    v = {x["check_name"]: x["passed"] for x in
         Q.verdicts(I.raw_metrics(raw_inspections), I.CHECKS, "raw").collect()}
    assert v == {"no_null_ids": False, "unique_ids": False, "null_results_under_10pct": False}


def test_passenger_medallion(spark, tmp_dir):
    path = _write(tmp_dir, "passengers.csv", PASSENGERS)
    status, rep = TI.medallion(spark, path, os.path.join(tmp_dir, "lake"), "2024-06-01 00:00:00")
    assert status == "dq_warning"
    layers_ = {r["layer"]: r for r in rep.collect()}
    assert layers_["bronze"]["n_rows"] == 20 and layers_["silver"]["n_rows"] == 19
    assert layers_["gold"]["n_rows"] == 3
    silver = spark.read.parquet(os.path.join(tmp_dir, "lake", "silver"))
    assert sorted(r[0] for r in silver.select("passenger_class").distinct().collect()) == [1, 2, 3]
    kept = silver.filter(F.col("passenger_id") == 16).collect()
    assert [str(r["fare_gbp"]) for r in kept] == ["-16.00"]  # deterministic keep-first by fare
    # a re-run over the same lake replaces every layer instead of adding to it
    _, rep2 = TI.medallion(spark, path, os.path.join(tmp_dir, "lake"), "2024-06-02 00:00:00")
    assert {r["layer"]: r["n_rows"] for r in rep2.collect()} == {"bronze": 20, "silver": 19, "gold": 3}


def test_inspection_medallion(spark, tmp_dir):
    path = _write(tmp_dir, "inspections.csv", INSPECTIONS)
    status, rep = I.medallion(spark, path, os.path.join(tmp_dir, "lake"), "2024-06-01 00:00:00")
    assert status == "dq_warning"
    layers_ = {r["layer"]: r["n_rows"] for r in rep.collect()}
    assert layers_ == {"bronze": 9, "silver": 6, "gold": 3}
    silver = spark.read.parquet(os.path.join(tmp_dir, "lake", "silver"))
    kept = silver.filter(F.col("inspection_id") == 101).collect()
    assert [r["inspection_date"] for r in kept] == [dt.date(2024, 1, 6)]  # newest wins
    assert silver.filter(F.col("inspection_year").isNull()).count() == 3  # NULL partition (S22)
