"""Proof queries for patient free text (W8): sentiment ratings and the three periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as TX
from . import roles
from .registry import register


def _lex_sql():
    vals = ", ".join(f"('{w}', CAST({v} AS DECIMAL(6,3)))" for w, v in TX.DEFAULT_LEXICON)
    return f"lex(word, valence) AS (VALUES {vals})"


def _score_sql(base: str, key: str, text: str, extra: str = "") -> str:
    """DuckDB twin of ``text.response_ratings`` over ``base`` (a CTE name)."""
    return f"""
tok AS (SELECT {key}, unnest(list_filter(string_split_regex(lower(coalesce({text}, '')), '[^a-z'']+'), lambda x: x <> '')) AS w
        FROM {base}),
agg AS (SELECT {key}, sum(coalesce(l.valence, 0)) AS s, sum(CASE WHEN l.valence > 0 THEN l.valence + 1 END) AS pos,
          sum(CASE WHEN l.valence < 0 THEN l.valence - 1 END) AS neg,
          count(*) FILTER (WHERE coalesce(l.valence, 0) = 0) AS neu
        FROM tok LEFT JOIN lex l ON tok.w = l.word GROUP BY {key}),
sc AS (SELECT b.*, CAST(coalesce(a.s, 0) AS DOUBLE) AS sd, CAST(coalesce(a.pos, 0) AS DOUBLE) AS p,
          abs(CAST(coalesce(a.neg, 0) AS DOUBLE)) AS n, CAST(coalesce(a.neu, 0) AS DOUBLE) AS u
       FROM {base} b LEFT JOIN agg a USING ({key})),
r AS (SELECT *, p + n + u AS tot FROM sc),
f AS (SELECT *, CASE WHEN tot > 0 THEN round(abs(n / tot), 3) ELSE 0.0 END AS neg_s,
        CASE WHEN tot > 0 THEN round(abs(u / tot), 3) ELSE 0.0 END AS neu_s,
        CASE WHEN tot > 0 THEN round(abs(p / tot), 3) ELSE 0.0 END AS pos_s,
        round(sd / sqrt(sd * sd + 15.0), 4) AS compound FROM r)
SELECT {text} AS outcome_response, neg_s AS neg, neu_s AS neu, pos_s AS pos, compound,
  CAST(round(neg_s * 100.0, 2) AS VARCHAR) || '%' AS negative_rating,
  CAST(round(neu_s * 100.0, 2) AS VARCHAR) || '%' AS neutral_rating,
  CAST(round(pos_s * 100.0, 2) AS VARCHAR) || '%' AS positive_rating,
  CASE WHEN compound >= 0.05 THEN 'Positive' WHEN compound <= -0.05 THEN 'Negative' ELSE 'Neutral' END AS overall_rating,
  pat_id AS patient_id, or_case_id{extra}
FROM f"""


def _flat(df, extra=()):
    return df.select("outcome_response", "total_sentiment_data.*", "negative_rating", "neutral_rating",
                     "positive_rating", "overall_rating", "patient_id", "or_case_id", *extra)


@register("sentiment", "WITH " + _lex_sql() + """,
docs AS (SELECT doc_id AS or_case_id, source AS pat_id, text FROM documents),""" + _score_sql("docs", "or_case_id", "text"))
def q_sentiment(t, spark):
    """Lexicon sentiment of every whole document, with ratings."""
    d = t["documents"].select(F.col("doc_id").alias("or_case_id"), F.col("source").alias("pat_id"), "text")
    r = TX.response_ratings(d, "text", "pat_id", "or_case_id", TX.default_lexicon(spark))
    return _flat(r)


_PERIODS = {"preop": "preop_surgery_outcome", "m3": "m3_imp_outcome", "y1": "y1_imp_outcome"}


@register("sentiment_union", "WITH " + _lex_sql() + """,
sp AS (SELECT doc_id AS or_case_id, source AS pat_id, string_split(text, chr(10)) AS ls FROM documents),
pr AS (SELECT *, CAST(ceil(len(ls) / 3.0) AS INTEGER) AS k FROM sp),
long AS (SELECT or_case_id, pat_id, 'preop' AS period, array_to_string(ls[1:k], chr(10)) AS response FROM pr
         UNION ALL SELECT or_case_id, pat_id, 'm3', array_to_string(ls[k + 1:2 * k], chr(10)) FROM pr
         UNION ALL SELECT or_case_id, pat_id, 'y1', array_to_string(ls[2 * k + 1:3 * k], chr(10)) FROM pr),
keyed AS (SELECT *, or_case_id || '|' || period AS k FROM long),""" + _score_sql("keyed", "k", "response", ", period"))
def q_sentiment_union(t, spark):
    """Preop, month-3 and year-1 answers scored in one pass and stacked."""
    r = TX.all_period_ratings(roles.patient_responses(t), _PERIODS, "pat_id", "or_case_id",
                              TX.default_lexicon(spark))
    return _flat(r, ["period"])


def _rule_sql() -> str:
    """DuckDB twin of ``text.with_rule_sentiment`` over documents."""
    steer = {*TX.NEGATORS, *TX.BOOSTERS, *TX.DAMPERS}
    quoted = lambda xs: "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"
    words = [(w, round(v * 1000)) for w, v in TX.DEFAULT_LEXICON if w not in steer]
    listed, values = quoted(w for w, _ in words), "[" + ", ".join(str(v) for _, v in words) + "]"
    boost = " ".join(
        f"+ CASE WHEN list_contains({quoted(TX.BOOSTERS)}, p{d}) THEN {b} WHEN list_contains({quoted(TX.DAMPERS)}, p{d}) THEN -{b} ELSE 0 END"
        for d, b in enumerate(TX.BOOST_AT, start=1))
    turned = " OR ".join(f"coalesce(list_contains({quoted(TX.NEGATORS)}, p{d}), false)" for d in range(1, TX.REACH + 1))
    before = ", ".join(f"lag(w, {d}) OVER (PARTITION BY doc_id ORDER BY i) AS p{d}" for d in range(1, TX.REACH + 1))
    unit = TX.UNIT
    return f"""
WITH r AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[^A-Za-z'']+'), lambda x: x <> '') AS raw,
                  least({TX.MOST_EXCLAMATIONS}, length(coalesce(text, '')) - length(replace(coalesce(text, ''), '!', ''))) * {TX.EXCLAMATION * unit} AS marks
           FROM documents),
t AS (SELECT doc_id, unnest(raw) AS x, generate_subscripts(raw, 1) AS i FROM r),
w AS (SELECT *, lower(x) AS w FROM t),
c AS (SELECT *, {before}, max(CASE WHEN w = 'but' THEN i END) OVER (PARTITION BY doc_id) AS b,
             bool_or(x <> upper(x)) OVER (PARTITION BY doc_id) AS mixed,
             ({values})[list_position({listed}, w)] AS v0 FROM w),
h AS (SELECT doc_id, i, b, sign(v0) AS sg, v0
        + CASE WHEN mixed AND length(x) > 1 AND x = upper(x) THEN sign(v0) * {TX.CAPITALS} ELSE 0 END
        + sign(v0) * (0 {boost}) AS v, ({turned}) AS turned FROM c WHERE v0 IS NOT NULL),
f AS (SELECT doc_id, CAST(v * CASE WHEN turned THEN -{unit * 3 // 4} ELSE {unit} END
        * CASE WHEN b IS NULL THEN 1 WHEN i < b THEN 0.5 ELSE 1.5 END AS BIGINT) AS v FROM h),
a AS (SELECT doc_id, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + {1000 * unit} END) AS p,
             sum(CASE WHEN v < 0 THEN v - {1000 * unit} END) AS n, count(*) FILTER (v <> 0) AS hits, count(*) AS n_hits FROM f GROUP BY doc_id),
q AS (SELECT r.doc_id, (coalesce(s, 0) + sign(coalesce(s, 0)) * marks)::DOUBLE / {1000.0 * unit} AS s,
             coalesce(p, 0)::DOUBLE / {1000.0 * unit} AS p, abs(coalesce(n, 0)::DOUBLE) / {1000.0 * unit} AS n,
             (len(raw) - coalesce(hits, 0))::DOUBLE AS u, coalesce(n_hits, 0)::INTEGER AS n_hits FROM r LEFT JOIN a USING (doc_id)),
z AS (SELECT *, p + n + u AS tot FROM q)
SELECT doc_id, CASE WHEN tot > 0 THEN round(abs(n / tot), 3) ELSE 0.0 END AS neg,
  CASE WHEN tot > 0 THEN round(abs(u / tot), 3) ELSE 0.0 END AS neu, CASE WHEN tot > 0 THEN round(abs(p / tot), 3) ELSE 0.0 END AS pos,
  round(s / sqrt(s * s + 15.0), 4) AS compound, n_hits,
  CASE WHEN round(s / sqrt(s * s + 15.0), 4) >= 0.05 THEN 'Positive' WHEN round(s / sqrt(s * s + 15.0), 4) <= -0.05 THEN 'Negative' ELSE 'Neutral' END AS overall_rating
FROM z"""


@register("sentiment_rules", _rule_sql())
def q_sentiment_rules(t, spark):
    """M9/F8: every whole document scored with negation, boosters, capitals, "but" and exclamation marks."""
    scored = TX.with_rule_sentiment(t["documents"].select("doc_id", "text"), "text", TX.default_lexicon(spark))
    return scored.select("doc_id", "neg", "neu", "pos", "compound", "n_hits",
                         TX.overall_rating(F.col("compound")).alias("overall_rating"))


@register("word_vectors", """
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z'']+'), lambda x: x <> '') AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
n AS (SELECT w, count(*) AS n FROM t GROUP BY w),
p AS (SELECT t.w, d.ws[t.i + o] AS c, count(*) AS k FROM t JOIN d USING (doc_id), (VALUES (-2), (-1), (1), (2)) x(o)
      WHERE t.i + o >= 1 AND t.i + o <= len(d.ws) GROUP BY ALL),
g AS (SELECT w AS c, length(bin((SELECT sum(n) FROM n)::BIGINT // n)) AS weight, md5('7:' || w) AS h FROM n),
s AS (SELECT c, weight, ('0x' || substr(h, 1 + 4 * j, 4))::BIGINT AS x FROM g, (VALUES (0), (1), (2), (3)) y(j)),
v AS (SELECT w, (x % 64)::INTEGER AS dim, sum(k * weight * CASE WHEN (x // 64) % 2 = 0 THEN 1 ELSE -1 END)::BIGINT AS x
      FROM p JOIN s USING (c) GROUP BY ALL),
e AS (SELECT w, n, unnest(range(0, 64)) AS dim FROM n WHERE n >= 5)
SELECT e.w AS word, any_value(e.n) AS n, list(coalesce(v.x, 0)::BIGINT ORDER BY e.dim) AS vector
FROM e LEFT JOIN v ON v.w = e.w AND v.dim = e.dim GROUP BY e.w""")
def q_word_vectors(t, spark):
    """Vectors of every word with five occurrences, learned from the words around it."""
    return TX.learned_vectors(t["documents"], "text")
