from pyspark.sql import functions as F

from sparkcare.operators.claims import WIDE_COLUMNS, claims_demographics, medical_wide
from sparkcare.operators.conform import SPECS, conform, conform_rejects, data_dictionary
from sparkcare.sources.files import run_sql


def test_conform_casts_renames_and_documents(spark):
    raw = spark.createDataFrame([("12", "A", "7", "1"), ("12a", "", None, "x")],
                                "CLMNUM string, ACCEPTANCESTATUS string, ENCTRNUM string, FRPNUM string")
    out = conform(raw, SPECS["claims"])
    assert out.columns == ["claim_no", "accept_stat_cd", "enc_no", "frp_seq_no"]
    assert dict(out.dtypes) == {"claim_no": "bigint", "accept_stat_cd": "string", "enc_no": "bigint", "frp_seq_no": "bigint"}
    rows = [tuple(r) for r in out.collect()]
    assert rows == [(12, "A", 7, 1), (None, "", None, None)]
    assert out.schema["claim_no"].metadata["comment"] == "Claim number"


def test_data_dictionary(spark):
    out = conform(spark.createDataFrame([(1, 2)], "PersonNum long, DemographicsExternalIdNum long"), SPECS["person"])
    dd = {r.Name: (r.Type, r.Comments) for r in data_dictionary(spark, out).collect()}
    assert dd["person_no"][0] == "bigint" and dd["external_person_id"][0] == "bigint"
    assert dd["person_no"][1] == "Internal person identifier"


def test_person_numbers_do_not_collide(spark):
    """A 32-bit float key would join 16777216 to 16777217; BIGINT keeps them apart."""
    enc = conform(spark.createDataFrame([("F", 1, 1, 16777217)], "CLMVARCLMFORMTYPE string, ENCTRNUM int, FAC int, PERSONNUM long"),
                  SPECS["encounters"])
    per = conform(spark.createDataFrame([(5, 16777216)], "DemographicsExternalIdNum int, PersonNum long"), SPECS["person"])
    assert enc.join(per, "person_no").count() == 0


def _tiny_chain(spark):
    mk = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    return dict(
        claims=mk([(1, "A", 10, 1)], "claim_no int, accept_stat_cd string, enc_no int, frp_seq_no int"),
        adjudicatedsvcs=mk([(1, 1, 9, 5), (1, 2, 9, 6)], "claim_no int, enc_ser_no int, phy_id int, pre_paid_amt int"),
        encounters=mk([("F", 10, 3, 77)], "claim_form_tp_cd string, enc_no int, facil_id int, person_no long"),
        enctrfrppackages=mk([(10, 4, 2, 8)], "enc_no int, delivery_network_id int, package_no int, prod_id int"),
        enctrsvcs=mk([("X", 10), ("Y", 10)], "place_of_serv_cd string, enc_no int"),
        products=mk([("S", "T", 8)], "purch_sub_tp_nm string, purch_tp_nm string, prod_id int"),
        benefitpkg=mk([("B", 2)], "ben_pkg_cd string, package_no int"),
        person=mk([(555, 77)], "external_person_id int, person_no long"))


def test_medical_wide_fans_out_and_orders_keys_first(spark):
    c = _tiny_chain(spark)
    w = medical_wide(c["claims"], c["adjudicatedsvcs"], c["encounters"], c["enctrfrppackages"], c["enctrsvcs"],
                     c["products"], c["benefitpkg"], c["person"])
    assert w.columns == WIDE_COLUMNS
    assert w.count() == 4  # 2 service lines x 2 places of service


def test_claims_demographics_defaults(spark):
    enc = spark.createDataFrame([(1, 100), (2, 200)], "enctrnum long, personnum long")
    cl = spark.createDataFrame([(11, 1, None, None), (12, 2, None, 5.5)],
                               "clmnum long, enctrnum long, postingdate timestamp, totalcharges double")
    per = spark.createDataFrame([
        ("", "1980-13-01", "", "", "", "", "", 100, None),
        ("Hennepin", "1980-02-03", "F", "N", "Y", "N", "M", 200, 3)],
        "addrcountyofresidence string, demographicsbirthdate string, demographicssex string, disableddisabled string, "
        "fulltimestudent string, hearingimpaired string, maritalstatus string, personnum long, race int")
    got = {r.claim_no: r for r in claims_demographics(enc, cl, per).collect()}
    a = got[11]
    assert str(a.birthdate_dt) == "0001-01-01" and a.county_txt == "MISSING" and a.race_no == -1
    assert a.totalcharges_amt == 0.0 and a.gender_txt == "MISSING"
    b = got[12]
    assert str(b.birthdate_dt) == "1980-02-03" and b.county_txt == "Hennepin" and b.race_no == 3


def test_large_keys_survive_and_rejects_are_counted(spark):
    big = 3_000_000_000
    raw = spark.createDataFrame([(str(big), "A", str(big), "1"), ("x1", "B", "2", "1")],
                                "CLMNUM string, ACCEPTANCESTATUS string, ENCTRNUM string, FRPNUM string")
    out = conform(raw, SPECS["claims"]).collect()
    assert [r.claim_no for r in out] == [big, None] and out[0].enc_no == big
    bad = conform_rejects(raw, SPECS["claims"]).collect()
    assert [(r.CLMNUM, r.rejected_columns) for r in bad] == [("x1", ["claim_no"])]


def test_sql_source_runs_a_statement(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert run_sql(spark, "SELECT sum(id) AS s FROM three").first().s == 3
    assert spark.range(0).isEmpty() and not spark.range(1).isEmpty()  # A14


def test_wide_rows_are_not_shuffled(spark):
    """Nothing lies between the wide claims and the last encounter join but its sort."""
    from __spark_entry__ import queries
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = queries()["medical_wide"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    joins = [line for line in plan.split("\n") if "SortMergeJoin" in line]
    assert len(joins) == 7 and "enc_no" in joins[0] and "enc_no" in joins[1] and "enc_no" in joins[2]
    top = plan.split("\n")
    between = top[next(i for i, x in enumerate(top) if "SortMergeJoin" in x):[i for i, x in enumerate(top) if "SortMergeJoin" in x][2]]
    assert not any("Exchange" in x for x in between)
