"""Role mapping: the driver tables play the parts of the claim-system inputs.

Each function takes a ``sources.LazyTables`` and returns a
DataFrame with the column names the operators expect.  All mappings are plain
projections of the whole tables (no sampling, no key subsets); the SQL twin of
every mapping lives in ``plans.oracle`` and must stay in step with this file.

Fixed values of the mapping
---------------------------
* claims / encounters / packages / service lines / products / benefit packages /
  persons: orders, lineitem, part, nation, customer (see ``raw_*``).
* insurance rows: lineitem (charges = l_extendedprice, age = l_quantity,
  bmi = l_discount, children = l_linenumber, smoker from l_linestatus,
  gender from l_returnflag, region from l_suppkey % 5).
* job runs: events (job = event_type, start = ts, end = ts + floor(value*60) s,
  status Aborted when value < 5, project CDW0..CDW2 by user_id % 3).
* patient responses: documents; the three follow-up answers are lines 1-3.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.files import read_report_lines

from ..functions.timefmt import format_elapsed, micros_ntz

REGIONS = ["southwest", "southeast", "northwest", "northeast"]
START_JOB = "error"
WINDOW_DAYS = 5


# ---- W1: raw claim-system tables (source column names) -------------------------
def raw_adjudicatedsvcs(t: dict[str, DataFrame]) -> DataFrame:
    return t["lineitem"].select(F.col("l_orderkey").alias("CLMNUM"),
                                F.col("l_linenumber").alias("ENCTRSVCSVCNUM"),
                                F.col("l_suppkey").alias("PROF"),
                                F.col("l_extendedprice").alias("CGBEFOREADJAMTPREPAID"))


def raw_claims(t):
    o = t["orders"]
    return o.select(F.col("o_orderkey").alias("CLMNUM"), F.col("o_orderstatus").alias("ACCEPTANCESTATUS"),
                    F.col("o_orderkey").alias("ENCTRNUM"), (F.col("o_custkey") % 3).alias("FRPNUM"))


def raw_encounters(t):
    o = t["orders"]
    return o.select(F.col("o_orderpriority").alias("CLMVARCLMFORMTYPE"), F.col("o_orderkey").alias("ENCTRNUM"),
                    (F.col("o_custkey") % 97).alias("FAC"), F.col("o_custkey").alias("PERSONNUM"))


def raw_enctrfrppackages(t):
    li = t["lineitem"].groupBy("l_orderkey", "l_partkey").agg(F.min("l_suppkey").alias("l_suppkey"))
    return li.select(F.col("l_orderkey").alias("ENCTRNUM"), F.col("l_suppkey").alias("DeliveryNetwk"),
                     (F.col("l_suppkey") % 25).alias("PkgNum"), F.col("l_partkey").alias("Product"))


def raw_enctrsvcs(t):
    li = t["lineitem"].select("l_orderkey", "l_returnflag").distinct()
    return li.select(F.col("l_returnflag").alias("CPT4HCPCSGRPPLACEOFSVC"), F.col("l_orderkey").alias("ENCTRNUM"))


def raw_products(t):
    return t["part"].select(F.col("p_brand").alias("PurchaserSubtypePurchaserSubtype"),
                            F.col("p_type").alias("PurchaserType"), F.col("p_partkey").alias("ProductNum"))


def raw_benefitpkg(t):
    return t["nation"].select(F.col("n_name").alias("PkgCode"), F.col("n_nationkey").alias("PkgNum"))


def raw_person(t):
    return t["customer"].select(F.col("c_nationkey").alias("DemographicsExternalIdNum"),
                                F.col("c_custkey").alias("PersonNum"))


RAW = {
    "adjudicatedsvcs": raw_adjudicatedsvcs, "benefitpkg": raw_benefitpkg, "claims": raw_claims,
    "encounters": raw_encounters, "enctrfrppackages": raw_enctrfrppackages, "enctrsvcs": raw_enctrsvcs,
    "person": raw_person, "products": raw_products,
}


# ---- W2: demographic feed inputs -------------------------------------------------
def w2_claims(t):
    li = t["lineitem"]
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("clmnum"),
                     F.col("l_orderkey").alias("enctrnum"), F.col("l_shipdate").alias("postingdate"),
                     F.col("l_extendedprice").alias("totalcharges"))


def w2_encounters(t):
    return t["orders"].select(F.col("o_orderkey").alias("enctrnum"), F.col("o_custkey").alias("personnum"))


def w2_person(t):
    c = t["customer"]
    key = F.col("c_custkey")
    birth = F.date_add(F.to_date(F.lit("1940-01-01")), ((key * 37) % 20000).cast("int")).cast("string")
    return c.select(
        F.col("c_mktsegment").alias("addrcountyofresidence"),
        F.when(key % 11 == 0, F.lit(None).cast("string")).otherwise(birth).alias("demographicsbirthdate"),
        F.when(key % 3 == 0, "F").when(key % 3 == 1, "M").otherwise("").alias("demographicssex"),
        F.when(F.col("c_nationkey") % 4 == 0, "").otherwise("N").alias("disableddisabled"),
        F.when(F.col("c_acctbal") < 0, "Y").otherwise("").alias("fulltimestudent"),
        F.lit("N").alias("hearingimpaired"),
        F.when(F.col("c_nationkey") % 3 == 0, "S").when(F.col("c_nationkey") % 3 == 1, "M")
         .otherwise("").alias("maritalstatus"),
        key.alias("personnum"),
        F.col("c_nationkey").alias("race"))


# ---- W3: insurance rows ----------------------------------------------------------
def insurance(t):
    li = t["lineitem"]
    regions = F.array(*[F.lit(r) for r in REGIONS])
    return li.select(
        F.col("l_quantity").alias("age"),
        F.col("l_discount").alias("bmi"),
        F.col("l_linenumber").alias("children"),
        F.col("l_extendedprice").alias("charges"),
        F.when(F.col("l_linestatus") == "F", "yes").otherwise("no").alias("smoker"),
        F.when(F.col("l_returnflag") == "A", "female").otherwise("male").alias("gender"),
        F.element_at(regions, (F.col("l_suppkey") % len(REGIONS) + 1).cast("int")).alias("region"))


# ---- W7: job runs and the report lines a scheduler would print -------------------
def job_runs(t):
    e = t["events"]
    secs = F.floor(F.col("value") * 60).cast("bigint")
    # whole seconds, staying timestamp_ntz (date_trunc would turn it into a zoned timestamp)
    start = F.timestamp_add("MICROSECOND", -F.pmod(micros_ntz("ts"), F.lit(1_000_000)), F.col("ts"))
    return e.select(
        F.col("event_id"), F.col("user_id"), F.col("event_type").alias("job_name"),
        start.alias("start_ts"),
        F.timestamp_add("SECOND", secs, start).alias("end_ts"),
        secs.alias("elapsed_s"),
        F.concat(F.lit("CDW"), (F.col("user_id") % 3).cast("string")).alias("project"),
        F.when(F.col("value") < 5, "Aborted").otherwise("Finished").alias("status"))


def printed_reports(t) -> DataFrame:
    """report, place, value: the runs as a scheduler's report tool prints them, one report for each project
    and week, with runs of blanks between some fields.  The first line of a report (place 0)
    is its title, which has as many words as a run."""
    r = job_runs(t)

    def parts(ts):
        return [F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss"), F.date_format(ts, "EEE")]

    tail = F.when(F.col("status") == "Finished",
                  F.concat_ws(" ", F.lit("Finished"), F.lit("Sequence"), F.col("job_name"))) \
            .otherwise(F.concat(F.lit("(Status = "), F.col("status"), F.lit(")")))
    body = F.concat_ws(" ", *parts(F.col("start_ts")), *parts(F.col("end_ts")),
                       format_elapsed(F.col("elapsed_s") * 1_000_000), F.col("project"), tail)
    report = F.concat_ws("_", "project", F.weekofyear("start_ts").cast("string"))
    lines = r.select(report.alias("report"), F.lit(1).alias("place"),
                     F.concat(F.col("job_name"), F.lit("    "), body, F.lit("  ")).alias("value"))
    titles = r.select(report.alias("report")).distinct().select("report", F.lit(0).alias("place"), F.concat(
        F.lit("runs of all jobs as printed for report "), F.col("report"), F.lit(" at the end of week")).alias("value"))
    return lines.unionByName(titles)


def report_lines(t) -> DataFrame:
    """The printed reports written as text files, one folder with one file for each report (a report's
    lines meet in one task, which sorts the title to the top), and read back as numbered lines."""
    reports = printed_reports(t)
    path = f"{ensure_checkpoint_dir(reports.sparkSession).rstrip('/')}/reports/{uuid.uuid4().hex}"
    (reports.repartition("report").sortWithinPartitions("report", "place").select("report", "value")
     .write.partitionBy("report").text(path))
    return read_report_lines(reports.sparkSession, path, numbered=True)


# ---- W8: patient responses -------------------------------------------------------
def patient_responses(t):
    """One row per document: or_case_id, pat_id and three answers: the first,
    second and last third of the lines, which together are the whole text."""
    d = t["documents"]
    lines = F.split(F.col("text"), "\n", -1)
    third = F.ceil(F.size(lines) / 3).cast("int")
    return d.select(
        F.col("doc_id").alias("or_case_id"),
        F.col("source").alias("pat_id"),
        F.array_join(F.slice(lines, F.lit(1), third), "\n").alias("preop_surgery_outcome"),
        F.array_join(F.slice(lines, third + 1, third), "\n").alias("m3_imp_outcome"),
        F.array_join(F.slice(lines, third * 2 + 1, third), "\n").alias("y1_imp_outcome"))
