"""Claims model: the wide claims table (J1, J2) and the demographic/cost feed.

Both are plain joins; Spark picks the physical join.  Notes for scale:

* ``medical_wide`` joins what has another key first, while no table has met one that
  multiplies it: services to claims, persons to encounters, products and benefit packages to
  the packages of encounters.  The three ``enc_no`` joins come last and share one
  partitioning, so nothing larger than an input is shuffled, and the wide rows leave the
  task that made them.
* Dimension tables (products, benefit packages) are broadcast only when the
  planner's size estimate (``spark.sql.autoBroadcastJoinThreshold``) or AQE's
  runtime size says they are small; otherwise they sort-merge join.  No
  unconditional broadcast hint is used.
* Hot keys are split by AQE skew-join handling (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_default
from ..functions.timefmt import date_sentinel

# Key-first output order of the wide table (the order a USING-join chain gives).
WIDE_COLUMNS = [
    "person_no", "package_no", "prod_id", "enc_no", "claim_no", "accept_stat_cd", "frp_seq_no",
    "enc_ser_no", "phy_id", "pre_paid_amt", "claim_form_tp_cd", "facil_id", "delivery_network_id",
    "place_of_serv_cd", "purch_sub_tp_nm", "purch_tp_nm", "ben_pkg_cd", "external_person_id",
]


# Source column, cleaning rule and output name of the demographic feed (fixed values).
DEMOGRAPHIC_COLUMNS = [
    ("demographicsbirthdate", "date", "birthdate_dt"), ("clmnum", "key", "claim_no"),
    ("addrcountyofresidence", "blank", "county_txt"), ("disableddisabled", "blank", "disabled_txt"),
    ("enctrnum", "key", "encounter_no"), ("demographicssex", "blank", "gender_txt"),
    ("hearingimpaired", "blank", "hearingimpaired_txt"), ("maritalstatus", "blank", "maritalstatus_txt"),
    ("personnum", "key", "patient_id"), ("race", "code", "race_no"),
    ("fulltimestudent", "blank", "student_txt"), ("totalcharges", "money", "totalcharges_amt"),
]


def medical_wide(claims: DataFrame, adjudicatedsvcs: DataFrame, encounters: DataFrame,
                 enctrfrppackages: DataFrame, enctrsvcs: DataFrame, products: DataFrame,
                 benefitpkg: DataFrame, person: DataFrame) -> DataFrame:
    """Eight conformed tables -> one wide claims table (inner joins)."""
    billed = claims.join(adjudicatedsvcs, "claim_no")
    seen = encounters.join(person, "person_no")
    bought = enctrfrppackages.join(products, "prod_id").join(benefitpkg, "package_no")
    wide = (billed
            .join(seen, "enc_no")
            .join(enctrsvcs, "enc_no")
            .join(bought, "enc_no"))
    return wide.select(*WIDE_COLUMNS)


def claims_demographics(encounters: DataFrame, claims: DataFrame, person: DataFrame) -> DataFrame:
    """Claims + encounters + person -> cleaned demographic / cost feed.

    Inputs use the claim-system column names (``enctrnum``, ``personnum``,
    ``clmnum``, ``totalcharges``, ``demographics*`` ...).  Blank text becomes
    ``MISSING``, missing numbers ``-1`` (charges ``0``), a missing or malformed
    birth date the 0001-01-01 sentinel.  Keys are 64 bits wide; casts are ``try_cast`` so
    malformed values become defaults instead of failing the job.
    """
    columns = {"blank": lambda c: blank_to_default(c).cast("string"),
               "date": lambda c: F.coalesce(c.try_cast("date"), date_sentinel()),
               "key": lambda c: F.coalesce(c.try_cast("bigint"), F.lit(-1).cast("bigint")),
               "code": lambda c: F.coalesce(c.try_cast("int"), F.lit(-1)),
               "money": lambda c: F.coalesce(c.try_cast("float"), F.lit(0).cast("float"))}
    billed = claims.join(encounters.select("enctrnum", "personnum"), "enctrnum")
    return billed.join(person, "personnum").select(
        *(columns[kind](F.col(source)).alias(name) for source, kind, name in DEMOGRAPHIC_COLUMNS))
