"""Proof queries for the claims model (W1) and the demographic feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import blank_to_default
from ..operators.claims import DEMOGRAPHIC_COLUMNS, claims_demographics, medical_wide
from ..operators.conform import SPECS, conform, data_dictionary
from ..operators.profile import table_profile
from ..sources.files import run_sql
from ..sources.tables import read_table
from . import oracle_roles as R
from . import roles
from .registry import register

# ---- W2 ---------------------------------------------------------------------------
_TWIN = {
    "blank": "CASE WHEN {c} IS NULL OR {c} = '' THEN 'MISSING' ELSE {c} END",
    "date": "ifnull(TRY_CAST({c} AS DATE), DATE '0001-01-01')",
    "key": "ifnull(TRY_CAST({c} AS BIGINT), -1)", "code": "ifnull(TRY_CAST({c} AS INTEGER), -1)",
    "money": "ifnull(TRY_CAST({c} AS FLOAT), 0)"}
_W2_SQL = "SELECT " + ", ".join(
    f"{_TWIN[kind].format(c=source)} AS {name}" for source, kind, name in DEMOGRAPHIC_COLUMNS) + f"""
FROM ({R.W2_PERSON}) JOIN ({R.W2_ENCOUNTERS}) USING (personnum) JOIN ({R.W2_CLAIMS}) USING (enctrnum)"""


@register("claims_demographics", _W2_SQL)
def q_claims_demographics(t, spark):
    """Claims (lineitem) + encounters (orders) + person (customer) -> demographic feed."""
    return claims_demographics(roles.w2_encounters(t), roles.w2_claims(t), roles.w2_person(t))


@register("clean_blank", """
SELECT coalesce(nullif(o_orderstatus, 'P'), 'MISSING') AS status_txt, count(*) AS n
FROM orders GROUP BY 1""")
def q_clean_blank(t, spark):
    """A value treated as blank becomes MISSING; counted by the cleaned value."""
    o = t["orders"]
    cleaned = blank_to_default(F.nullif(F.col("o_orderstatus"), F.lit("P")))
    return o.groupBy(cleaned.alias("status_txt")).agg(F.count(F.lit(1)).alias("n"))


# ---- W1: conformed entities ---------------------------------------------------------
_CONFORM_SQL = {
    "adjudicatedsvcs": """SELECT TRY_CAST(l_orderkey AS BIGINT) AS claim_no,
        TRY_CAST(l_linenumber AS BIGINT) AS enc_ser_no, TRY_CAST(l_suppkey AS BIGINT) AS phy_id,
        TRY_CAST(trunc(l_extendedprice) AS BIGINT) AS pre_paid_amt FROM lineitem""",
    "benefitpkg": """SELECT n_name AS ben_pkg_cd, TRY_CAST(n_nationkey AS BIGINT) AS package_no FROM nation""",
    "claims": """SELECT TRY_CAST(o_orderkey AS BIGINT) AS claim_no, o_orderstatus AS accept_stat_cd,
        TRY_CAST(o_orderkey AS BIGINT) AS enc_no, TRY_CAST(o_custkey % 3 AS BIGINT) AS frp_seq_no FROM orders""",
    "encounters": """SELECT o_orderpriority AS claim_form_tp_cd, TRY_CAST(o_orderkey AS BIGINT) AS enc_no,
        TRY_CAST(o_custkey % 97 AS BIGINT) AS facil_id, CAST(o_custkey AS BIGINT) AS person_no FROM orders""",
    "enctrfrppackages": """SELECT l_orderkey AS enc_no, min(l_suppkey) AS delivery_network_id,
        min(l_suppkey) % 25 AS package_no, l_partkey AS prod_id FROM lineitem GROUP BY l_orderkey, l_partkey""",
    "enctrsvcs": """SELECT l_returnflag AS place_of_serv_cd, TRY_CAST(l_orderkey AS BIGINT) AS enc_no
        FROM lineitem GROUP BY l_orderkey, l_returnflag""",
    "person": """SELECT TRY_CAST(c_nationkey AS BIGINT) AS external_person_id, CAST(c_custkey AS BIGINT) AS person_no
        FROM customer""",
    "products": """SELECT p_brand AS purch_sub_tp_nm, p_type AS purch_tp_nm, TRY_CAST(p_partkey AS BIGINT) AS prod_id
        FROM part""",
}


def conformed(t, entity):
    return conform(roles.RAW[entity](t), SPECS[entity])


def _register_conform(entity):
    @register(f"conform_{entity}", _CONFORM_SQL[entity])
    def q(t, spark):
        return conformed(t, entity)
    q.__doc__ = f"P1: conform the {entity} entity (select, try_cast, rename, comment)."
    return q


for _e in SPECS:
    _register_conform(_e)


_WIDE_SQL = "WITH " + ",\n".join(f"{e} AS ({s})" for e, s in _CONFORM_SQL.items()) + """
SELECT pe.person_no, b.package_no, p.prod_id, c.enc_no, c.claim_no, c.accept_stat_cd, c.frp_seq_no,
  a.enc_ser_no, a.phy_id, a.pre_paid_amt, e.claim_form_tp_cd, e.facil_id, f.delivery_network_id,
  s.place_of_serv_cd, p.purch_sub_tp_nm, p.purch_tp_nm, b.ben_pkg_cd, pe.external_person_id
FROM claims c
JOIN adjudicatedsvcs a ON c.claim_no = a.claim_no
JOIN encounters e ON c.enc_no = e.enc_no
JOIN enctrfrppackages f ON c.enc_no = f.enc_no
JOIN enctrsvcs s ON c.enc_no = s.enc_no
JOIN products p ON f.prod_id = p.prod_id
JOIN benefitpkg b ON f.package_no = b.package_no
JOIN person pe ON e.person_no = pe.person_no
"""


@register("medical_wide", _WIDE_SQL)
def q_medical_wide(t, spark):
    """The eight conformed entities joined into the wide claims table."""
    c = {e: conformed(t, e) for e in SPECS}
    return medical_wide(c["claims"], c["adjudicatedsvcs"], c["encounters"], c["enctrfrppackages"],
                        c["enctrsvcs"], c["products"], c["benefitpkg"], c["person"])


def _dictionary_sql():
    rows = [f"('{s.name}', '{s.dtype}', '{s.comment}')" for specs in SPECS.values() for s in specs]
    return f'SELECT * FROM (VALUES {", ".join(rows)}) AS d("Name", "Type", "Comments")'


@register("data_dictionary", _dictionary_sql())
def q_data_dictionary(t, spark):
    """The data dictionary of all conformed entities, from the frames' schemas."""
    frames = [data_dictionary(spark, conformed(t, e)) for e in SPECS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out


@register("filter_like", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '%1%'""")
def q_filter_like(t, spark):
    """pattern filter, pushed to the parquet scan as StringContains."""
    return (t["orders"].where(F.col("o_orderpriority").like("%1%"))
            .select("o_orderkey", "o_custkey", "o_orderpriority"))


def _dictionary_profile_sql():
    parts = []
    for entity, specs in SPECS.items():
        for i, c in enumerate(specs):
            parts.append(f"""SELECT '{entity}' AS entity, {i} AS position, '{c.name}' AS "Name", '{c.dtype}' AS "Type",
  '{c.comment}' AS "Comments", count({c.name}) AS non_null, count(*) AS row_count FROM ({_CONFORM_SQL[entity]})""")
    return "\nUNION ALL ".join(parts)


@register("dictionary_profile", _dictionary_profile_sql())
def q_dictionary_profile(t, spark):
    """The data dictionary of the conformed entities with what their columns hold."""
    out = None
    for entity in SPECS:
        df = conformed(t, entity)
        part = (table_profile(df).join(F.broadcast(data_dictionary(spark, df)), F.col("column_name") == F.col("Name"))
                .select(F.lit(entity).alias("entity"), "position", "Name", "Type", "Comments", "non_null", "row_count"))
        out = part if out is None else out.unionByName(part)
    return out


@register("catalog_scan", """
SELECT n_name, r_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_catalog_scan(t, spark):
    """Two tables read from the catalog by name (blanks around the dots removed), here views."""
    for name in ("nation", "region"):
        t[name].createOrReplaceTempView(f"sparkcare_{name}")
    nation, region = read_table(spark, " sparkcare_nation "), read_table(spark, "sparkcare_region ")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name", "n_nationkey")


_SCAN_SQL = """WITH late AS (SELECT l_orderkey, count(*) AS n_lines FROM {lines}
              WHERE l_shipdate >= TIMESTAMP '1995-01-01 00:00:00' GROUP BY l_orderkey)
SELECT o_orderpriority, count(*) AS n_orders, sum(n_lines) AS n_lines
FROM {orders} JOIN late ON o_orderkey = l_orderkey GROUP BY o_orderpriority"""


@register("sql_scan", _SCAN_SQL.format(lines="lineitem", orders="orders").replace("sum(n_lines)", "sum(n_lines)::BIGINT"))
def q_sql_scan(t, spark):
    """SQL text with a common table expression over registered frames."""
    return run_sql(spark, _SCAN_SQL.format(lines="sparkcare_lines", orders="sparkcare_orders"),
                   sparkcare_lines=t["lineitem"], sparkcare_orders=t["orders"])
