"""DuckDB twins of ``plans.roles`` (SELECT text over the driver's views)."""

W2_CLAIMS = """SELECT l_orderkey * 8 + l_linenumber AS clmnum, l_orderkey AS enctrnum,
  l_shipdate AS postingdate, l_extendedprice AS totalcharges FROM lineitem"""

W2_ENCOUNTERS = "SELECT o_orderkey AS enctrnum, o_custkey AS personnum FROM orders"

W2_PERSON = """SELECT c_mktsegment AS addrcountyofresidence,
  CASE WHEN c_custkey % 11 = 0 THEN NULL
       ELSE CAST(DATE '1940-01-01' + CAST((c_custkey * 37) % 20000 AS INTEGER) AS VARCHAR) END AS demographicsbirthdate,
  CASE WHEN c_custkey % 3 = 0 THEN 'F' WHEN c_custkey % 3 = 1 THEN 'M' ELSE '' END AS demographicssex,
  CASE WHEN c_nationkey % 4 = 0 THEN '' ELSE 'N' END AS disableddisabled,
  CASE WHEN c_acctbal < 0 THEN 'Y' ELSE '' END AS fulltimestudent,
  'N' AS hearingimpaired,
  CASE WHEN c_nationkey % 3 = 0 THEN 'S' WHEN c_nationkey % 3 = 1 THEN 'M' ELSE '' END AS maritalstatus,
  c_custkey AS personnum, c_nationkey AS race
FROM customer"""

INSURANCE = """SELECT l_quantity AS age, l_discount AS bmi, l_linenumber AS children,
  l_extendedprice AS charges,
  CASE WHEN l_linestatus = 'F' THEN 'yes' ELSE 'no' END AS smoker,
  CASE WHEN l_returnflag = 'A' THEN 'female' ELSE 'male' END AS gender,
  ['southwest', 'southeast', 'northwest', 'northeast'][CAST(l_suppkey % 4 + 1 AS INTEGER)] AS region
FROM lineitem"""

JOB_RUNS = """SELECT event_id, user_id, event_type AS job_name,
  date_trunc('second', ts) AS start_ts,
  date_trunc('second', ts) + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS end_ts,
  CAST(floor(value * 60) AS BIGINT) AS elapsed_s,
  'CDW' || CAST(user_id % 3 AS VARCHAR) AS project,
  CASE WHEN value < 5 THEN 'Aborted' ELSE 'Finished' END AS status
FROM events"""


def elapsed_text(micros: str) -> str:
    """SQL twin of ``functions.timefmt.format_elapsed`` (argument: a BIGINT expression)."""
    s = f"CAST(floor(({micros}) / 1000000) AS BIGINT)"
    frac = f"(({micros}) - {s} * 1000000)"
    d = f"CAST(floor({s} / 86400) AS BIGINT)"
    r = f"({s} - {d} * 86400)"
    hms = (f"CAST({r} // 3600 AS VARCHAR) || ':' || lpad(CAST(({r} % 3600) // 60 AS VARCHAR), 2, '0')"
           f" || ':' || lpad(CAST({r} % 60 AS VARCHAR), 2, '0')"
           f" || CASE WHEN {frac} <> 0 THEN '.' || lpad(CAST({frac} AS VARCHAR), 6, '0') ELSE '' END")
    return (f"CASE WHEN ({micros}) IS NULL THEN NULL WHEN {d} = 0 THEN {hms} "
            f"ELSE CAST({d} AS VARCHAR) || CASE WHEN abs({d}) = 1 THEN ' day and ' ELSE ' days and ' END || {hms} END")
