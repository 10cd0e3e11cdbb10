"""Proof queries for profiling (W3 tables behind the charts, W6) and concatenation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators.combine import concat_by_name, concat_strict
from ..operators.cost import encode_categories
from . import oracle_roles as R
from . import roles
from ..sources.tables import TABLE_NAMES
from .registry import register

NUMERIC = ["age", "bmi", "children", "charges"]

# item category column: part.p_type with one value treated as missing
_CAT_SQL = "SELECT nullif(p_type, 'SMALL') AS category FROM part"


def _category(t):
    return t["part"].select(F.nullif(F.col("p_type"), F.lit("SMALL")).alias("category"))


@register("value_counts", f"""
SELECT category, count(*) AS "count" FROM ({_CAT_SQL}) WHERE category IS NOT NULL GROUP BY category""")
def q_value_counts(t, spark):
    """A1/L1: value counts, nulls dropped, count descending."""
    return P.value_counts(_category(t), "category")


@register("group_count", f"""SELECT category, count(*) AS "count" FROM ({_CAT_SQL}) GROUP BY category""")
def q_group_count(t, spark):
    """A2: group count with the null group kept."""
    return P.group_count(_category(t), "category")


@register("value_counts_struct", f"""
SELECT category AS category_value, count(*) AS instance_count FROM ({_CAT_SQL})
WHERE category IS NOT NULL GROUP BY category""")
def q_value_counts_struct(t, spark):
    """Counts as struct(value, count), renamed and unnested."""
    return P.value_counts_struct(_category(t), "category")


@register("top_values", """
SELECT l_partkey, count(*) AS "count" FROM lineitem GROUP BY l_partkey
ORDER BY "count" DESC, l_partkey LIMIT 5""")
def q_top_values(t, spark):
    """L2: the five most frequent parts on order lines (top-k report)."""
    return P.top_values(t["lineitem"].select("l_partkey"), "l_partkey", 5)


_GROUP_LIST_CHUNK = 50


@register("group_lists", f"""
WITH long AS (
  SELECT p_brand, 'p_type' AS column_name, CAST(p_type AS VARCHAR) AS v FROM part
  UNION ALL SELECT p_brand, 'p_size', CAST(p_size AS VARCHAR) FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, column_name ORDER BY v) - 1 AS pos
      FROM long WHERE v IS NOT NULL)
SELECT p_brand, column_name, CAST(pos // {_GROUP_LIST_CHUNK} AS BIGINT) AS chunk_no, count(*) AS n_values,
       array_to_string(list(v ORDER BY v), '|') AS "values"
FROM r GROUP BY ALL""")
def q_group_lists(t, spark):
    """A4: per brand, sorted lists of type and size, cut in chunks of 50 values."""
    return P.group_lists(t["part"], "p_brand", ["p_type", "p_size"], chunk_size=_GROUP_LIST_CHUNK)


_NULLY_SQL = """SELECT o_orderkey, nullif(o_orderstatus, 'O') AS o_orderstatus,
  CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
  nullif(o_orderpriority, '1-URGENT') AS o_orderpriority FROM orders"""


def _nully(t):
    o = t["orders"]
    return o.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("o_orderstatus"),
                    F.when(F.col("o_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice"))
                    .alias("o_totalprice"),
                    F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("o_orderpriority"))


_PARTS_SQL = """SELECT p_brand, nullif(p_type, 'ECONOMY BRASS') AS p_type, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS p_size
  FROM part"""


def _parts(t):
    return t["part"].select("p_brand", F.nullif(F.col("p_type"), F.lit("ECONOMY BRASS")).alias("p_type"),
                            F.when(F.col("p_partkey") % 5 == 0, F.lit(None)).otherwise(F.col("p_size")).alias("p_size"))


@register("group_arrays", f"""
WITH p AS ({_PARTS_SQL}),
t AS (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY p_type NULLS FIRST) - 1 AS pos FROM p),
s AS (SELECT p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_size NULLS FIRST) - 1 AS pos FROM p)
SELECT t.p_brand, CAST(t.pos // {_GROUP_LIST_CHUNK} AS BIGINT) AS chunk_no, any_value(n.group_count) AS group_count,
       list(t.p_type ORDER BY t.pos) AS p_type, list(s.p_size ORDER BY t.pos) AS p_size
FROM t JOIN s ON t.p_brand = s.p_brand AND t.pos = s.pos JOIN (SELECT p_brand, count(*) AS group_count FROM p GROUP BY p_brand) n
  ON n.p_brand = t.p_brand GROUP BY t.p_brand, chunk_no""")
def q_group_arrays(t, spark):
    """A4: per brand its number of parts and the sorted types and sizes as arrays of their own
    type, nulls kept, 50 values to a row."""
    return P.group_arrays(_parts(t), "p_brand", ["p_type", "p_size"], chunk_size=_GROUP_LIST_CHUNK)


@register("group_value_counts", f"""
WITH c AS (SELECT p_brand, p_size, count(*) AS n FROM ({_PARTS_SQL}) GROUP BY p_brand, p_size),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size NULLS FIRST) - 1 AS pos FROM c)
SELECT p_brand, CAST(pos // {_GROUP_LIST_CHUNK} AS BIGINT) AS chunk_no, list(p_size ORDER BY pos) AS size_values,
       list(n ORDER BY pos) AS size_counts FROM r GROUP BY ALL""")
def q_group_value_counts(t, spark):
    """A4: per brand the distinct sizes, a null among them, and their counts."""
    found = P.group_value_counts(_parts(t), "p_brand", "p_size", chunk_size=_GROUP_LIST_CHUNK)
    return found.select("p_brand", "chunk_no", F.col("value_counts.value").alias("size_values"),
                        F.col("value_counts.count").alias("size_counts"))


@register("empty_tables", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) = 0 AS is_empty FROM {n}{w}" for n, w in
    [(n, "") for n in TABLE_NAMES] + [("orders", " WHERE o_totalprice < 0")]).replace(
    "SELECT 'orders' AS table_name, count(*) = 0 AS is_empty FROM orders WHERE", "SELECT 'orders below 0', count(*) = 0 FROM orders WHERE"))
def q_empty_tables(t, spark):
    """Which tables have no row, and a filtered one that has none."""
    return P.empty_tables({**{n: t[n] for n in TABLE_NAMES}, "orders below 0": t["orders"].where("o_totalprice < 0")})


@register("null_counts", f"""
WITH t AS ({_NULLY_SQL})
SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_count FROM t
UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM t
UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM t
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM t""")
def q_null_counts(t, spark):
    """Null count of every column, one aggregate."""
    return P.null_counts(_nully(t))


@register("table_profile", f"""
WITH t AS ({_NULLY_SQL})
SELECT 0 AS position, 'o_orderkey' AS column_name, 'bigint' AS data_type, count(o_orderkey) AS non_null,
       count(*) AS row_count FROM t
UNION ALL SELECT 1, 'o_orderstatus', 'string', count(o_orderstatus), count(*) FROM t
UNION ALL SELECT 2, 'o_totalprice', 'double', count(o_totalprice), count(*) FROM t
UNION ALL SELECT 3, 'o_orderpriority', 'string', count(o_orderpriority), count(*) FROM t""")
def q_table_profile(t, spark):
    """Name, type, non-null count and row count per column."""
    return P.table_profile(_nully(t))


def _describe_sql():
    parts = []
    for c in NUMERIC:
        parts.append(f"""SELECT '{c}' AS column_name, count({c}) AS "count", round(avg({c}), 4) AS mean,
          round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS "min",
          round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
          round(quantile_cont({c}, 0.75), 4) AS p75, CAST(max({c}) AS DOUBLE) AS "max" FROM ins""")
    return f"WITH ins AS ({R.INSURANCE})\n" + "\nUNION ALL ".join(parts)


@register("describe", _describe_sql())
def q_describe(t, spark):
    """Count, mean, std, min, quartiles (exact), max of the numeric insurance columns."""
    return P.describe(roles.insurance(t), NUMERIC)


@register("category_counts", f"""
WITH ins AS ({R.INSURANCE})
SELECT 'gender' AS column_name, gender AS value, count(*) AS "count" FROM ins GROUP BY 2
UNION ALL SELECT 'smoker', smoker, count(*) FROM ins GROUP BY 2
UNION ALL SELECT 'region', region, count(*) FROM ins GROUP BY 2""")
def q_category_counts(t, spark):
    """Count per gender, smoker and region in one shuffle."""
    return P.category_counts(roles.insurance(t), ["gender", "smoker", "region"])


@register("group_mean", f"""
WITH ins AS ({R.INSURANCE})
SELECT region, round(avg(charges), 4) AS mean_charges FROM ins GROUP BY region""")
def q_group_mean(t, spark):
    """Mean charges per region."""
    return P.group_mean(roles.insurance(t), ["region"], "charges")


@register("group_mean2", f"""
WITH ins AS ({R.INSURANCE}),
g AS (SELECT gender, smoker, avg(charges) AS m, count(*) AS n, stddev_samp(charges) AS sd FROM ins GROUP BY ALL)
SELECT gender, smoker, round(m, 4) AS mean_charges, n, round(sd, 4) AS sd_charges,
  round(m - 1.96 * sd / sqrt(n), 4) AS ci_low, round(m + 1.96 * sd / sqrt(n), 4) AS ci_high FROM g""")
def q_group_mean2(t, spark):
    """Mean charges per (gender, smoker) with a normal 95 % interval."""
    return P.group_mean(roles.insurance(t), ["gender", "smoker"], "charges", ci=True)


_LV = "[0.0625, 0.125, 0.25, 0.5, 0.75, 0.875, 0.9375]"


@register("letter_values", f"""
WITH ins AS ({R.INSURANCE}),
q AS (SELECT smoker, count(charges) AS n, quantile_cont(charges, {_LV}::DOUBLE[]) AS qs FROM ins GROUP BY smoker)
SELECT smoker, round(unnest({_LV}::DOUBLE[]), 6) AS prob, n, round(unnest(qs), 6) AS value FROM q""")
def q_letter_values(t, spark):
    """A10: letter-value quantiles of charges per smoker group (exact)."""
    return P.letter_values(roles.insurance(t), "charges", "smoker")


def _hist_sql(bins=30):
    unions = "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM ins" for c in NUMERIC)
    return f"""
WITH ins AS ({R.INSURANCE}), long AS ({unions}),
st AS (SELECT column_name, min(value) AS lo, max(value) AS hi FROM long GROUP BY column_name),
c AS (SELECT l.column_name,
        CAST(CASE WHEN st.hi = st.lo THEN 1 ELSE least(floor((l.value - st.lo) / (st.hi - st.lo) * {bins}) + 1, {bins}) END AS INTEGER) AS bin,
        count(*) AS n
      FROM long l JOIN st USING (column_name) WHERE l.value IS NOT NULL GROUP BY ALL),
b AS (SELECT column_name, lo, hi, CAST(unnest(range(1, {bins} + 1)) AS INTEGER) AS bin FROM st)
SELECT b.column_name, b.bin, round(b.lo + (b.hi - b.lo) * (b.bin - 1) / {bins}, 6) AS bin_low,
       round(b.lo + (b.hi - b.lo) * b.bin / {bins}, 6) AS bin_high, coalesce(c.n, 0) AS "count"
FROM b LEFT JOIN c ON b.column_name = c.column_name AND b.bin = c.bin"""


@register("histogram", _hist_sql())
def q_histogram(t, spark):
    """30-bin equal-width histograms of age, bmi, children and charges."""
    return P.histogram(roles.insurance(t), NUMERIC, bins=30)


_ENC_SQL = f"""SELECT age, bmi, children, charges,
  CASE gender WHEN 'male' THEN 0 WHEN 'female' THEN 1 END AS gender,
  CASE smoker WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS smoker,
  CASE region WHEN 'southwest' THEN 1 WHEN 'southeast' THEN 2 WHEN 'northwest' THEN 3
              WHEN 'northeast' THEN 4 END AS region
FROM ({R.INSURANCE})"""

CORR_COLS = ["age", "bmi", "children", "charges", "gender", "smoker", "region"]


def _corr_sql():
    parts = [f"SELECT '{c}' AS col_a, '{c}' AS col_b, 1.0::DOUBLE AS corr" for c in CORR_COLS]
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i + 1:]:
            parts.append(f"SELECT '{a}', '{b}', round(corr({a}, {b}), 6) FROM enc")
            parts.append(f"SELECT '{b}', '{a}', round(corr({a}, {b}), 6) FROM enc")
    return f"WITH enc AS ({_ENC_SQL})\n" + "\nUNION ALL ".join(parts)


@register("correlation", _corr_sql())
def q_correlation(t, spark):
    """Pearson correlation matrix of the encoded insurance columns."""
    return P.correlation(encode_categories(roles.insurance(t)), CORR_COLS)


@register("encode_categories", f"SELECT * FROM ({_ENC_SQL})")
def q_encode_categories(t, spark):
    """gender/smoker/region to fixed codes; unmapped region -> null."""
    return encode_categories(roles.insurance(t))


# ---- concatenation ---------------------------------------------------------------
@register("concat_by_name", """
SELECT o_orderkey, o_custkey, o_totalprice, NULL::TIMESTAMP AS o_orderdate FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, NULL, o_orderdate FROM orders WHERE o_orderstatus <> 'F'""")
def q_concat_by_name(t, spark):
    """Two extracts with different columns, aligned by name (missing -> null)."""
    o = t["orders"]
    a = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    b = o.where(F.col("o_orderstatus") != "F").select("o_custkey", "o_orderkey", "o_orderdate")
    return concat_by_name(a, b)


@register("concat_strict", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem WHERE l_returnflag = 'R'
UNION ALL
SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem WHERE l_returnflag <> 'R'""")
def q_concat_strict(t, spark):
    """Two extracts with identical schemas; a schema difference raises."""
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    return concat_strict(li.where(F.col("l_returnflag") == "R"), li.where(F.col("l_returnflag") != "R"))
