import datetime as dt
import tempfile

from pyspark.sql import functions as F

from stratum.plans.insurance import claim_tables, complaint, run_silver, silver

TS1 = dt.datetime(2024, 1, 1)
TS2 = dt.datetime(2024, 2, 1)

INS_COLS = ("policy_number incident_date incident_type incident_severity total_claim_amount injury_claim "
            "property_claim vehicle_claim auto_make auto_model auto_year fraud_reported insured_zip "
            "incident_location age insured_sex policy_state insured_education_level insured_occupation").split()
CAR_COLS = "PolicyNumber Year Month FraudFound Make AccidentArea Age Sex Fault VehicleCategory".split()


def _frames(spark):
    ins = [
        ("P1", "2015-01-25", "Collision", "Major", "100.50", "10", "20", "70.5", "Audi", "A4", "2010", "Y",
         "111", "Main St", "40", "M", "OH", "MD", "sales"),
        ("P1", "2015-01-25", "Collision", "Major", "100.50", "10", "20", "70.5", "Audi", "A4", "2011", "N",
         "111", "Main St", "40", "M", "OH", "MD", "sales"),      # same claim key -> duplicate
        ("P2", "01/25/2015", None, "Minor", "abc", None, None, None, "BMW", "X5", "2012", " Y",
         "222", "Elm", "15", "F", "IN", "PhD", "tech"),          # bad amount, missing type, age < 16
        ("P3", "garbage", "Theft", "Total", "-5", None, None, None, "VW", "Golf", "20x9", "y",
         "333", "Oak", "50", "F", "IL", "JD", "law"),            # bad date, negative, bad year
    ]
    ins_df = spark.createDataFrame(ins, ", ".join(f"{c} string" for c in INS_COLS))
    ins_df = ins_df.withColumn("_ingest_ts", F.lit(TS1)).withColumn("_source_file", F.lit("f1.csv"))
    car = [("C1", "1994", "Jan", "Yes ", "Honda", "Urban", "30", "Male", "Policy Holder", "Sedan"),
           ("C2", "1994", "DEC", "0", "Ford", "Rural", "x", "Female", "Third Party", "Sport"),
           ("C3", "1995", "Foo", None, "Ford", "Rural", "25", "Female", "Third Party", "Sport")]
    car_df = spark.createDataFrame(car, ", ".join(f"{c} string" for c in CAR_COLS))
    car_df = car_df.withColumn("_ingest_ts", F.lit(TS1)).withColumn("_source_file", F.lit("f2.csv"))
    car2 = spark.createDataFrame([("C1", "1994", "Jan", "no", "Honda", "Urban", "31", "Male", "Policy Holder", "Sedan")],
                                 ", ".join(f"{c} string" for c in CAR_COLS)) \
        .withColumn("_ingest_ts", F.lit(TS2)).withColumn("_source_file", F.lit("f3.csv"))
    sev = spark.createDataFrame([("1", "995.20"), ("3", "x")], "IDpol string, ClaimAmount string")
    byt = spark.createDataFrame([("9", "10,5", "Glass", "100")], "ID string, Cost_claims_by_type string, "
                                "Claims_type string, Cost_claims_year string")
    return {"raw_insurance_claims": ins_df, "raw_carclaims": car_df.unionByName(car2),
            "raw_claim_severity": sev, "raw_claims_by_type": byt}


def test_silver_claims(spark):
    frames = _frames(spark)
    s = silver(frames.__getitem__)
    t = claim_tables(s["claim_enriched"])
    claim = {r["policy_number"]: r for r in t["claim"].collect()}
    quar = {r["policy_number"]: r["quarantine_reason"] for r in t["claim_quarantine"].collect()}
    # duplicate P1 rows collapse to one; the survivor is the smaller payload (auto_year 2010)
    assert claim["P1"]["auto_year"] == 2010 and claim["P1"]["fraud"] is True
    assert claim["P1"]["incident_date"] == dt.date(2015, 1, 25)
    assert quar["P2"] == "missing_claim_type; age_lt_16; bad_total_claim_amount"
    assert quar["P3"] == "amount_negative; bad_incident_date; bad_auto_year"
    assert claim["C1"]["incident_date"] == dt.date(1994, 1, 15) and claim["C1"]["incident_date_is_synthetic"]
    assert quar["C2"] == "bad_policyholder_age"
    # every failed cast is a reason, also one of several raw columns
    assert quar["C3"] == "bad_incident_date"
    n_in = sum(f.count() for k, f in frames.items() if k in ("raw_insurance_claims", "raw_carclaims"))
    assert t["claim"].count() + t["claim_quarantine"].count() + 1 == n_in   # one duplicate
    hist = t["claim_status_history"].groupBy("claim_id").count().collect()
    assert all(r["count"] in (2, 3) for r in hist) and len(hist) == t["claim"].count()


def test_silver_dims_and_severity(spark):
    s = silver(_frames(spark).__getitem__)
    ph = s["dim_policyholder"].where("policy_number = 'C1'").orderBy("effective_from").collect()
    assert [(r["age"], r["is_current"]) for r in ph] == [(30, False), (31, True)]
    cur = s["dim_policyholder"].where("is_current")
    assert cur.count() == cur.select("policy_number", "source_system").distinct().count()
    assert s["claim_severity"].count() == 3
    bad = s["claim_severity"].where("policy_id = '3'").first()
    assert bad["claim_amount"] is None and bad["bad_amounts"] == "bad_claim_amount"
    assert {r["policy_id"] for r in s["claim_severity"].where("bad_amounts IS NOT NULL").collect()} == {"3", "9"}
    assert s["dim_vehicle"].where("is_current").count() == s["dim_vehicle"].select("vehicle_key").distinct().count()


def test_run_silver_writes_all(spark):
    out_dir = tempfile.mkdtemp(prefix="stratum-silver-")
    written = {}

    def write(name, df):
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
        written[name] = spark.read.parquet(f"{out_dir}/{name}").count()

    run_silver(_frames(spark).__getitem__, write)
    assert set(written) == {"claim", "claim_quarantine", "claim_status_history", "claim_severity",
                            "claim_severity_quarantine", "dim_policyholder", "dim_vehicle"}
    assert written["claim_severity"] + written["claim_severity_quarantine"] == 3


def test_rows_with_different_bad_text_stay_apart(spark):
    frames = _frames(spark)
    one = frames["raw_insurance_claims"].where("policy_number = 'P2'")
    both = one.unionByName(one.withColumn("total_claim_amount", F.lit("xyz")))
    t = claim_tables(silver({**frames, "raw_insurance_claims": both}.__getitem__)["claim_enriched"])
    assert t["claim_quarantine"].where("policy_number = 'P2'").count() == 2


def test_complaints_are_typed(spark):
    cols = "MAKETXT MODELTXT YEARTXT CRASH FIRE INJURED DEATHS FAILDATE VIN CITY STATE CDESCR".split()
    rows = [("FORD", "F150", "2010", "Y", "N", "1", "0", "20100131", "v", "c", "s", "BRAKES FAILED"),
            ("FORD", "F150", "2010", "Y", "N", "1", "0", "20100131", "v", "c", "s", "BRAKES FAILED"),
            ("VW", None, "x", None, "n", "", "two", "2010-13-01", None, None, None, None)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    got = {r.make: r for r in complaint({"raw_complaints": df}.__getitem__).collect()}
    assert len(got) == 2
    ford = got["FORD"]
    assert (ford.model_year, ford.crash, ford.fire, ford.injured) == (2010, True, False, 1)
    assert ford.fail_date == dt.date(2010, 1, 31) and ford.bad_fields is None
    assert got["VW"].bad_fields == "bad_model_year; bad_deaths; bad_fail_date"
