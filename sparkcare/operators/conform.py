"""Conform source tables to documented, typed columns (P1, P1a-P1h, P2).

A table is described by a list of :class:`ColumnSpec` (source column, target
name, Spark SQL type, comment).  ``conform`` is one projection: every column is
``try_cast`` (bad text becomes null instead of failing the job under ANSI mode)
and carries its comment as field metadata, so it survives into saved tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnSpec:
    source: str
    name: str
    dtype: str
    comment: str = ""


def conform(df: DataFrame, specs: list[ColumnSpec]) -> DataFrame:
    """Select + try_cast + rename + comment, driven by ``specs``."""
    return df.select([
        F.col(s.source).try_cast(s.dtype).alias(s.name, metadata={"comment": s.comment})
        for s in specs])


def conform_rejects(df: DataFrame, specs: list[ColumnSpec]) -> DataFrame:
    """The rows of ``df`` with a value that its target type cannot hold, plus
    ``rejected_columns``: what ``conform`` would turn into null.  Count them before a join."""
    lost = [F.when(F.col(s.source).isNotNull() & F.col(s.source).try_cast(s.dtype).isNull(), F.lit(s.name))
            for s in specs]
    return df.withColumn("rejected_columns", F.array_compact(F.array(*lost))).where(F.size("rejected_columns") > 0)


def schema_of(specs: list[ColumnSpec]) -> str:
    """DDL text of the conformed schema (for empty frames and CSV readers)."""
    return ", ".join(f"{s.name} {s.dtype}" for s in specs)


def data_dictionary(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per column of ``df``: Name, Type, Comments (from field metadata).

    Built from the schema on the driver; its size is the column count."""
    rows = [(f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment"))
            for f in df.schema.fields]
    return spark.createDataFrame(rows, "Name STRING, Type STRING, Comments STRING")


# The eight claim-system entities.  Source column names and target names/types
# are fixed values of the claims model; keys are BIGINT, not INT or FLOAT, so that a
# large key neither turns null (and vanishes in a join) nor meets another one.
SPECS: dict[str, list[ColumnSpec]] = {
    "adjudicatedsvcs": [
        ColumnSpec("CLMNUM", "claim_no", "bigint", "Claim number"),
        ColumnSpec("ENCTRSVCSVCNUM", "enc_ser_no", "bigint", "Service line number within the encounter"),
        ColumnSpec("PROF", "phy_id", "bigint", "Internal physician identifier"),
        ColumnSpec("CGBEFOREADJAMTPREPAID", "pre_paid_amt", "bigint", "Pre-paid amount of the service line"),
    ],
    "benefitpkg": [
        ColumnSpec("PkgCode", "ben_pkg_cd", "string", "Benefit package code of the coverage"),
        ColumnSpec("PkgNum", "package_no", "bigint", "Benefit package number"),
    ],
    "claims": [
        ColumnSpec("CLMNUM", "claim_no", "bigint", "Claim number"),
        ColumnSpec("ACCEPTANCESTATUS", "accept_stat_cd", "string", "Claim acceptance status code"),
        ColumnSpec("ENCTRNUM", "enc_no", "bigint", "Encounter number (one billed healthcare event)"),
        ColumnSpec("FRPNUM", "frp_seq_no", "bigint", "Order of payer responsibility on the encounter"),
    ],
    "encounters": [
        ColumnSpec("CLMVARCLMFORMTYPE", "claim_form_tp_cd", "string", "Claim form type code"),
        ColumnSpec("ENCTRNUM", "enc_no", "bigint", "Encounter number (one billed healthcare event)"),
        ColumnSpec("FAC", "facil_id", "bigint", "Internal facility identifier of the billing entity"),
        ColumnSpec("PERSONNUM", "person_no", "bigint", "Internal person identifier"),
    ],
    "enctrfrppackages": [
        ColumnSpec("ENCTRNUM", "enc_no", "bigint", "Encounter number (one billed healthcare event)"),
        ColumnSpec("DeliveryNetwk", "delivery_network_id", "bigint", "Delivery network identifier of the coverage"),
        ColumnSpec("PkgNum", "package_no", "bigint", "Benefit package number"),
        ColumnSpec("Product", "prod_id", "bigint", "Internal product identifier"),
    ],
    "enctrsvcs": [
        ColumnSpec("CPT4HCPCSGRPPLACEOFSVC", "place_of_serv_cd", "string", "Type of place the service was performed at"),
        ColumnSpec("ENCTRNUM", "enc_no", "bigint", "Encounter number (one billed healthcare event)"),
    ],
    "person": [
        ColumnSpec("DemographicsExternalIdNum", "external_person_id", "bigint", "External member number"),
        ColumnSpec("PersonNum", "person_no", "bigint", "Internal person identifier"),
    ],
    "products": [
        ColumnSpec("PurchaserSubtypePurchaserSubtype", "purch_sub_tp_nm", "string", "Product purchaser subtype name"),
        ColumnSpec("PurchaserType", "purch_tp_nm", "string", "Product purchaser type name"),
        ColumnSpec("ProductNum", "prod_id", "bigint", "Internal product identifier"),
    ],
}
