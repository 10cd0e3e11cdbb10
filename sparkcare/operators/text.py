"""Free-text scoring and classification (W8: M9-M14, F8, X16, X17, X22, U3).

Sentiment is lexicon based (the published valence-sum method: compound =
s / sqrt(s^2 + 15); positive / negative / neutral shares from per-token
valences), plain (``with_sentiment``) or with rules over the words around a hit
(``with_rule_sentiment``).  Words, valences and rule weights are this library's own, set by hand for
patient answers; scores are not claimed equal to any package's.

Every text is scored whole.  A word list of at most MAX_INLINE words goes into the plan as a literal
and every row is scored where it stands: one hash lookup of its tokens against the list leaves
the few hits, so no text is shuffled.  A longer list is joined to the exploded tokens.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import percent_text
from ..session import stored_copy

TOKEN_SPLIT = r"[^a-z']+"
ALPHA = 15.0
POSITIVE_AT, NEGATIVE_AT = 0.05, -0.05

# A small English valence list of our own, set by hand (scale -4 .. +4).
DEFAULT_LEXICON = [
    ("abandon", -1.9), ("able", 1.0), ("accept", 1.5), ("ache", -1.6), ("awful", -2.0), ("bad", -2.5),
    ("best", 3.2), ("better", 1.9), ("broken", -1.8), ("calm", 1.3), ("comfort", 1.5), ("cure", 1.9),
    ("easy", 1.9), ("excellent", 2.7), ("fail", -2.3), ("fear", -2.2), ("fine", 0.8), ("free", 1.5),
    ("good", 1.9), ("great", 3.1), ("happy", 2.7), ("hate", -2.7), ("help", 1.7), ("hope", 1.9),
    ("hurt", -2.4), ("improve", 1.9), ("improved", 2.1), ("like", 1.5), ("love", 3.2), ("no", -1.2),
    ("not", -1.0), ("pain", -2.3), ("painful", -2.4), ("painfree", 2.0), ("poor", -2.1), ("relief", 2.1),
    ("sad", -2.1), ("safe", 1.9), ("stiff", -1.0), ("stiffness", -1.2), ("strong", 2.3), ("terrible", -2.5),
    ("weak", -1.9), ("well", 1.1), ("wonderful", 2.7), ("worse", -2.1), ("worst", -3.1),
]


def default_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_LEXICON, "word string, valence double") \
        .select("word", F.col("valence").cast("decimal(6,3)").alias("valence"))


def tokens(text: Column) -> Column:
    """Lower-case word tokens (letters and apostrophes) of the whole text."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT, -1), lambda w: w != F.lit(""))


def _finish_scores(s, pos, neg, neu, unit: int = 1) -> list[Column]:
    """neg, neu, pos shares (rounded to 3) and compound (rounded to 4) from the
    valence sum ``s``, positive sum, negative sum and neutral count (sums are exact integers,
    ``unit`` to a thousandth of a valence point)."""
    s = s.cast("double") / (1000.0 * unit)
    pos = pos.cast("double") / (1000.0 * unit)
    neg = F.abs(neg.cast("double")) / (1000.0 * unit)
    neu = neu.cast("double")
    total = pos + neg + neu
    share = lambda x: F.when(total > 0, F.round(F.abs(x / total), 3)).otherwise(F.lit(0.0))
    return [share(neg).alias("neg"), share(neu).alias("neu"), share(pos).alias("pos"),
            F.round(s / F.sqrt(s * s + F.lit(ALPHA)), 4).alias("compound")]


MAX_INLINE = 10_000


def _thousandths(lexicon: DataFrame) -> DataFrame:
    """_w, _mv: each word once, with its largest valence in thousandths."""
    return (lexicon.where(F.col("word").isNotNull()).groupBy(F.col("word").alias("_w"))
            .agg((F.max("valence").cast("decimal(12,3)") * 1000).cast("bigint").alias("_mv")))


def _inline_words(lexicon: DataFrame, limit: int) -> list[tuple[str, int]] | None:
    """The words with a valence, or None if there are more than ``limit``."""
    rows = _thousandths(lexicon).where("_mv <> 0").limit(limit + 1).collect()
    return sorted((r["_w"], r["_mv"]) for r in rows) if len(rows) <= limit else None


def _looked_up(words: list[tuple[str, int]]) -> tuple[Column, Column]:
    """Array literals of words and valences."""
    return (F.array(*(F.lit(w) for w, _ in words)).cast("array<string>"),
            F.array(*(F.lit(v) for _, v in words)).cast("array<bigint>"))


def with_sentiment(df: DataFrame, text_col: str, lexicon: DataFrame, max_inline: int = MAX_INLINE) -> DataFrame:
    """Adds neg, neu, pos and compound to every row of ``df``; null or
    empty text scores 0.  A word listed twice in the lexicon counts once (its largest
    valence)."""
    words = _inline_words(lexicon, max_inline)
    if words is None:
        return _sentiment_by_join(df, text_col, _thousandths(lexicon))
    listed, valences = _looked_up(words)
    rows = df.withColumn("_tokens", tokens(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    rows = rows.withColumn("_hits", F.array_intersect("_tokens", listed))  # distinct, by hash
    rows = rows.withColumn("_found", F.when(F.size("_hits") == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.filter("_tokens", lambda t: F.array_contains("_hits", t)),
        lambda t: F.element_at(valences, F.array_position(listed, t).cast("int")))))
    add = lambda keep, by: F.aggregate(F.filter("_found", keep), F.lit(0).cast("bigint"), lambda s, v: s + v + by)
    scores = _finish_scores(add(lambda v: v != 0, 0), add(lambda v: v > 0, 1000), add(lambda v: v < 0, -1000),
                            F.size("_tokens") - F.size("_found"))
    return rows.select(*df.columns, *scores)


def _sentiment_by_join(df: DataFrame, text_col: str, lex: DataFrame) -> DataFrame:
    """``with_sentiment`` for a word list of any size.  A score depends on the text alone, so
    texts are scored by their digest: tokens are exploded, joined to the words and summed per
    digest with map-side partial aggregation, then joined back to the rows.  Repeated
    texts add up to a whole multiple that the count of their first tokens divides out, so
    row ids, null or repeated, play no part."""
    rows = df.withColumn("_text_md5", F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    tok = rows.select("_text_md5", F.posexplode_outer(tokens(F.coalesce(F.col(text_col), F.lit("")))).alias("_at", "_w"))
    v = F.coalesce(F.col("_mv"), F.lit(0).cast("bigint"))
    total = lambda when: F.coalesce(F.sum(when), F.lit(0).cast("bigint"))
    sums = tok.join(lex, "_w", "left").groupBy("_text_md5").agg(
        total(F.when(F.col("_w").isNotNull(), v)).alias("_s"), total(F.when(v > 0, v + 1000)).alias("_pos"),
        total(F.when(v < 0, v - 1000)).alias("_neg"),
        F.count(F.when(F.col("_w").isNotNull() & (v == 0), 1)).alias("_neu"),
        F.count(F.when(F.coalesce(F.col("_at"), F.lit(0)) == 0, 1)).alias("_m"))
    once = [F.expr(f"{c} div _m") for c in ("_s", "_pos", "_neg", "_neu")]
    scores = sums.select("_text_md5", *_finish_scores(*once))
    return rows.join(scores, "_text_md5").select(*df.columns, "neg", "neu", "pos", "compound")


# Fixed values of the rules, our own.  Weights are thousandths of a valence point; a negation
# turns a valence and takes a quarter of it; of two clauses around the last "but" the first counts
# half and the second one and a half times.
NEGATORS = ["aint", "ain't", "can't", "cannot", "couldn't", "didn't", "doesn't", "don't", "hardly", "isn't", "never",
            "no", "none", "nor", "not", "nothing", "rarely", "wasn't", "without", "won't", "wouldn't"]
BOOSTERS = ["completely", "especially", "extremely", "highly", "much", "really", "so", "too", "totally", "very"]
DAMPERS = ["almost", "barely", "fairly", "partly", "slightly", "somewhat"]
BOOST_AT = (300, 200, 100)   # one, two and three words before the hit
CAPITALS, EXCLAMATION, MOST_EXCLAMATIONS = 700, 300, 4
REACH = 3
UNIT = 8  # values are eighths of a thousandth, so that every rule gives whole numbers


def with_rule_sentiment(df: DataFrame, text_col: str, lexicon: DataFrame, max_words: int = MAX_INLINE) -> DataFrame:
    """M9 with rules: adds neg, neu, pos, compound and n_hits, the number of words scored.

    For each word of the lexicon (words of NEGATORS, BOOSTERS and DAMPERS only steer), in order:

    1. capitals: a hit in capitals (two letters at least) in a text that has other words too gains
       CAPITALS in the direction of its valence;
    2. each of the REACH words before it that is a booster (damper) adds (takes) BOOST_AT by
       distance;
    3. a negator among those words turns the value and leaves three quarters of it;
    4. before the last "but" it counts half, behind it one and a half times.

    Up to MOST_EXCLAMATIONS exclamation marks each add EXCLAMATION to the sum, in its direction.
    Null or empty text scores 0.  The lexicon may have ``max_words`` words; more raise
    ValueError."""
    words = _inline_words(lexicon, max_words)
    if words is None:
        raise ValueError(f"the word list has more than {max_words} words")
    steering = {*NEGATORS, *BOOSTERS, *DAMPERS}
    listed, valences = _looked_up([(w, v) for w, v in words if w not in steering])
    literal = lambda xs: F.array(*map(F.lit, xs))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Boundaries are those of the lower-cased text, for both forms.
    rows = df.withColumn("_raw", F.filter(F.split(text, "[^A-Za-z']+", -1), lambda w: w != ""))
    rows = rows.withColumn("_tokens", F.transform("_raw", lambda w: F.lower(w)))
    rows = rows.withColumn("_hits", F.array_intersect("_tokens", listed))
    rows = rows.withColumn("_mixed", F.exists("_raw", lambda w: w != F.upper(w)))
    last = F.size("_tokens") - F.array_position(F.reverse("_tokens"), F.lit("but"))
    rows = rows.withColumn("_but", F.when(F.array_contains("_tokens", "but"), last).otherwise(F.lit(-1)).cast("int"))
    at = F.filter(F.sequence(F.lit(0), F.size("_tokens") - 1), lambda i: F.array_contains("_hits", F.get("_tokens", i)))
    rows = rows.withColumn("_at", F.when(F.size("_hits") == 0, F.array().cast("array<int>")).otherwise(at))

    def value(i: Column) -> Column:
        word, raw = F.get("_tokens", i), F.get("_raw", i)
        v = F.element_at(valences, F.array_position(listed, word).cast("int"))
        sign = F.signum(v).cast("bigint")
        v = v + F.when(F.col("_mixed") & (F.length(raw) > 1) & (raw == F.upper(raw)), sign * CAPITALS).otherwise(0)
        turned = F.lit(False)
        for d in range(1, REACH + 1):
            before = F.get("_tokens", i - d)
            v = v + sign * (F.when(F.array_contains(literal(BOOSTERS), before), BOOST_AT[d - 1])
                            .when(F.array_contains(literal(DAMPERS), before), -BOOST_AT[d - 1]).otherwise(0))
            turned = turned | F.coalesce(F.array_contains(literal(NEGATORS), before), F.lit(False))
        v = v * F.when(turned, -UNIT * 3 // 4).otherwise(UNIT)
        return F.when(F.col("_but") < 0, v).when(i < F.col("_but"), v / 2).otherwise(v * 3 / 2).cast("bigint")

    rows = rows.withColumn("_found", F.transform("_at", value))
    add = lambda keep, by: F.aggregate(F.filter("_found", keep), F.lit(0).cast("bigint"), lambda s, v: s + v + by)
    rows = rows.withColumn("_sum", add(lambda v: v != 0, 0)).withColumn(
        "_marks", F.least(F.lit(MOST_EXCLAMATIONS), F.regexp_count(text, F.lit("!"))) * EXCLAMATION * UNIT)
    total = F.col("_sum") + F.signum("_sum").cast("bigint") * F.col("_marks")
    scores = _finish_scores(total, add(lambda v: v > 0, 1000 * UNIT), add(lambda v: v < 0, -1000 * UNIT),
                            F.size("_tokens") - F.size(F.filter("_found", lambda v: v != 0)), unit=UNIT)
    return rows.select(*df.columns, *scores, F.size("_at").alias("n_hits"))


def overall_rating(compound: Column) -> Column:
    """F8: Positive at >= 0.05, Negative at <= -0.05, else Neutral."""
    return F.when(compound >= POSITIVE_AT, "Positive").when(compound <= NEGATIVE_AT, "Negative").otherwise("Neutral")


def response_ratings(df: DataFrame, text_col: str, patient_col: str, case_col: str,
                     lexicon: DataFrame,
                     keep_cols: list[str] | None = None) -> DataFrame:
    """outcome_response, total_sentiment_data (struct), negative/neutral/
    positive_rating ('47.3%'), overall_rating, patient_id, or_case_id."""
    j = with_sentiment(df, text_col, lexicon)
    return j.select(
        F.col(text_col).alias("outcome_response"),
        F.struct("neg", "neu", "pos", "compound").alias("total_sentiment_data"),
        percent_text(F.col("neg")).alias("negative_rating"),
        percent_text(F.col("neu")).alias("neutral_rating"),
        percent_text(F.col("pos")).alias("positive_rating"),
        overall_rating(F.col("compound")).alias("overall_rating"),
        F.col(patient_col).alias("patient_id"), F.col(case_col).alias("or_case_id"),
        *[F.col(c) for c in (keep_cols or [])])


def all_period_ratings(df: DataFrame, periods: dict[str, str], patient_col: str, case_col: str,
                       lexicon: DataFrame) -> DataFrame:
    """The answers of several follow-up periods scored in ONE pass (the
    period columns are unpivoted into (period, text) rows first)."""
    long = df.select(patient_col, case_col, F.explode(F.array(*[
        F.struct(F.lit(p).alias("period"), F.col(c).alias("response")) for p, c in periods.items()])).alias("_x")) \
        .select(patient_col, case_col, "_x.period", "_x.response")
    return response_ratings(long, "response", patient_col, case_col, lexicon, keep_cols=["period"])


BLOCK_CHARS = 1 << 25   # characters of text whose words are looked up together, about
LEAST_CHARS = 1 << 22   # blocks are not made smaller than this for the sake of more tasks
SLICE_WORDS = 1 << 16


def _vector_sums(docs: DataFrame, id_col: str, text_col: str, word_key: Callable[[Column], Column],
                 vectors: DataFrame, dims: int, kind: str) -> DataFrame:
    """(_key, _all, _d0, _d1, ...): per document id the number of words that have a vector, and the sum of
    their vectors by dimension.  ``vectors``: _w (bigint, ``word_key`` of a word), _v (array<``kind``>).

    A vector is wide and a word occurs in many texts, so vectors don't travel by text and word:
    texts are dealt by a hash into blocks of about BLOCK_CHARS, a block gets the vector of each
    of its distinct words once, and one task adds them up text by text."""
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0  # one number
    wanted = min(docs.sparkSession.sparkContext.defaultParallelism, -(-chars // LEAST_CHARS))
    blocks = max(1, wanted, -(-chars // BLOCK_CHARS))
    rows = docs.select(F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).alias("_block"), F.col(id_col).alias("_key"),
                       F.transform(tokens(F.col(text_col)), word_key).alias("_ws")).where(F.size("_ws") > 0)
    needed = (rows.select(F.col("_block").alias("_for"), F.explode("_ws").alias("_w")).distinct()
              .join(vectors, "_w").select("_for", "_w", "_v"))
    number = np.int64 if kind == "bigint" else np.float64

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        names, at, copies = np.unique(known.column("_w").to_numpy(), return_inverse=True, return_counts=True)
        each = known.column("_v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(number, copy=False).reshape(-1, dims)
        vecs = np.zeros((len(names), dims), number)
        np.add.at(vecs, at, each)  # a word may be listed twice
        lists = texts.column("_ws").combine_chunks()
        words = lists.flatten().to_numpy()
        text = np.repeat(np.arange(texts.num_rows), lists.value_lengths().to_numpy())
        place = np.searchsorted(names, words)
        hit = place < len(names)
        hit[hit] = names[place[hit]] == words[hit]
        text, place = text[hit], place[hit]
        sums = np.zeros((texts.num_rows, dims), number)
        for lo in range(0, len(text), SLICE_WORDS):
            mine = text[lo:lo + SLICE_WORDS]
            starts = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
            sums[mine[starts]] += np.add.reduceat(vecs[place[lo:lo + SLICE_WORDS]], starts)
        n = np.zeros(texts.num_rows, np.int64)
        np.add.at(n, text, copies[place])
        ends = pa.array(np.arange(texts.num_rows + 1, dtype=np.int32) * dims)
        return pa.table([texts.column("_key"), pa.array(n), pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))],
                        names=["_key", "_all", "_sums"])

    key = rows.schema["_key"].dataType.simpleString()
    found = rows.groupBy("_block").cogroup(needed.groupBy("_for")).applyInArrow(
        run, f"_key {key}, _all bigint, _sums array<{kind}>")
    return found.where("_all > 0").groupBy("_key").agg(
        F.sum("_all").alias("_all"), *(F.sum(F.get("_sums", F.lit(i))).alias(f"_d{i}") for i in range(dims)))


def _whole(vector: str, dims: int, item: Callable[[Column], Column]) -> Column:
    """``item`` of each of ``dims`` components, 0 for null ones; a vector of another length raises."""
    zero = F.array_repeat(F.lit(0), dims)
    of = F.transform(F.coalesce(F.col(vector), zero.cast("array<double>")), lambda x: F.coalesce(item(x), item(F.lit(0.0))))
    return F.when(F.size(vector) != dims, F.raise_error(F.lit(f"a word vector has not {dims} components")).cast(
        "array<bigint>")).otherwise(of)


WORD = re.compile("[a-z']+")  # of a lower-cased text: the words of ``tokens``
COMMON_WORDS = 1 << 16      # words whose vectors go to every task, at most
BLOCK_REST = 1 << 19        # other words of a block of texts, about
BLOCK_TEXTS = 1 << 16


def _lowered(text_col: str) -> Column:
    return F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def _least_count(words: DataFrame, count_col: str, most: int) -> int:
    """A count that at most ``most`` words reach: the smallest one of three binary digits before zeros."""
    cut = F.greatest(F.length(F.bin(count_col)) - 3, F.lit(0))
    steps = words.where(F.col(count_col) > 0).groupBy(F.call_function(
        "shiftleft", F.call_function("shiftright", F.col(count_col), cut), cut).alias("step")).count()
    least, held = 1, 0
    for step, n in sorted(((r["step"], r["count"]) for r in steps.collect()), reverse=True):  # at most 250 rows
        held += n
        if held > most:
            return least
        least = step
    return 1


def _add_words(sums: np.ndarray, counts: np.ndarray, text: np.ndarray, place: np.ndarray, vecs: np.ndarray, copies: np.ndarray) -> None:
    """Adds ``vecs[place]`` to the rows ``text`` (ascending) of ``sums``, and the copies to ``counts``."""
    for lo in range(0, len(text), SLICE_WORDS):
        mine = text[lo:lo + SLICE_WORDS]
        starts = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        sums[mine[starts]] += np.add.reduceat(vecs[place[lo:lo + SLICE_WORDS]], starts)
    np.add.at(counts, text, copies[place])


def _listed(words: list[str], vectors: np.ndarray, unit: bool) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Place of each word, vectors by place (of length 1 or 0 with ``unit``; those of a word listed twice are added),
    and how often it is listed."""
    x = vectors.astype(np.float64)
    if unit:
        x /= np.maximum(np.sqrt((x * x).sum(axis=1)), 1.0)[:, None]
    places: dict[str, int] = {}
    at = np.array([places.setdefault(w, len(places)) for w in words], np.int64)
    vecs, copies = np.zeros((len(places), x.shape[1])), np.zeros(len(places), np.int64)
    np.add.at(vecs, at, x)
    np.add.at(copies, at, 1)
    return places, vecs, copies


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _sums_by_frequency(docs: DataFrame, id_col: str, text_col: str, known: DataFrame, dims: int, unit: bool) -> DataFrame:
    """(_key, _all, _sums) as in ``_vector_sums``, a row for each text with such words.  ``known``: _w (the word),
    _v, _n.  The COMMON_WORDS commonest words go to every task and are added up where the texts lie; only the
    other words of a text travel, with its sum, to blocks as in ``_vector_sums``."""
    spark = docs.sparkSession
    least = _least_count(known, "_n", COMMON_WORDS)
    common = known.where(F.col("_n") >= least).toArrow()  # COMMON_WORDS rows
    table = spark.sparkContext.broadcast((common.column("_w").to_pylist(), _matrix(common.column("_v"), dims)))
    others = known.where(F.col("_n") < least)
    rest, texts = others.agg(F.sum("_n")).first()[0] or 0, docs.count()
    blocks = max(1, -(-rest // BLOCK_REST), -(-texts // BLOCK_TEXTS))
    rows = docs.select(F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).alias("_block"), F.col(id_col).alias("_key"),
                       _lowered(text_col).alias("_text"))
    key = rows.schema["_key"].dataType.simpleString()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, vecs, copies = _listed(*table.value, unit)
        get, rare = places.get, len(places)
        for batch in batches:
            sums, counts = np.zeros((batch.num_rows, dims)), np.zeros(batch.num_rows, np.int64)
            left = []
            for i, text in enumerate(batch.column("_text")):
                words = WORD.findall(text.as_py())
                at = np.fromiter((get(w, rare) for w in words), np.int64, len(words))
                left.append(" ".join([words[j] for j in np.flatnonzero(at == rare)]))
                at = at[at < rare]
                _add_words(sums, counts, np.full(len(at), i), at, vecs, copies)
            out = pa.RecordBatch.from_arrays(
                [batch.column("_block"), batch.column("_key"), pa.array(counts), _lists(sums), pa.array(left, pa.string())],
                names=["_block", "_key", "_all", "_sums", "_rest"])
            yield out.filter(pa.array((counts > 0) | np.array([r != "" for r in left], bool)))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, seen = set(table.value[0]), {}
        for batch in batches:
            for block, text in zip(batch.column("_block").to_pylist(), batch.column("_text")):
                seen.setdefault(block, set()).update(w for w in WORD.findall(text.as_py()) if w not in listed)
                if sum(map(len, seen.values())) > HELD_WORDS:
                    yield pairs(seen)
                    seen.clear()
        yield pairs(seen)

    def pairs(seen: dict[int, set[str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b for b, ws in seen.items() for _ in ws], pa.int64()),
                                           pa.array([w for ws in seen.values() for w in ws], pa.string())], names=["_for", "_w"])

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        places, vecs, copies = _listed(found.column("_w").to_pylist(), _matrix(found.column("_v"), dims), unit)
        sums, counts = _matrix(texts.column("_sums"), dims).copy(), texts.column("_all").to_numpy().copy()
        text, place = [], []
        for i, words in enumerate(texts.column("_rest")):
            mine = [places[w] for w in words.as_py().split(" ") if w in places]
            text += [i] * len(mine)
            place += mine
        _add_words(sums, counts, np.array(text, np.int64), np.array(place, np.int64), vecs, copies)
        return pa.table([texts.column("_key"), pa.array(counts), _lists(sums)], names=["_key", "_all", "_sums"])

    first = rows.mapInArrow(added, f"_block bigint, _key {key}, _all bigint, _sums array<double>, _rest string")
    needed = (rows.select("_block", "_text").mapInArrow(wanted, "_for bigint, _w string").distinct()
              .join(others.select("_w", "_v"), "_w").select("_for", "_w", "_v"))
    return first.groupBy("_block").cogroup(needed.groupBy("_for")).applyInArrow(run, f"_key {key}, _all bigint, _sums array<double>")


def document_vectors(docs: DataFrame, id_col: str, text_col: str, word_vectors: DataFrame,
                     word_col: str = "word", vector_col: str = "vector", count_col: str | None = None,
                     unit: bool = False, rows: DataFrame | None = None) -> DataFrame:
    """Document vector = mean of its word vectors (words without a vector are
    skipped; a document without any has the zero vector).  Words are looked up by their 64-bit
    hash, block by block (``_vector_sums``); blocks' sums are added by id, so no document's tokens
    need be in one place.  ``count_col``, how frequent a word is, lets the commonest words be added up where
    the texts lie (``_sums_by_frequency``, by the words themselves).  ``unit`` divides a word's vector by its length if that is over
    1.  ``rows`` (with the id) get the vectors, instead of the ids of ``docs``."""
    dims = max(word_vectors.agg(F.max(F.size(vector_col))).first()[0] or 0, 0)
    listed = word_vectors.where(F.col(word_col).isNotNull()).select(
        F.col(word_col).cast("string").alias("_w"), F.col(vector_col).cast("array<double>").alias("_v"),
        F.lit(0).alias("_n") if count_col is None else F.coalesce(F.col(count_col).cast("bigint"), F.lit(0)).alias("_n"))
    if count_col is None:
        known = listed.select(F.xxhash64("_w").alias("_w"), _whole("_v", dims, lambda x: x).alias("_v"))
        if unit:
            norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda s, x: s + x * x))
            known = known.select("_w", F.transform("_v", lambda x: x / F.greatest(norm, F.lit(1.0))).alias("_v"))
        sums = _vector_sums(docs, id_col, text_col, lambda w: F.xxhash64(w), known, dims, "double")
        same = F.col(id_col).eqNullSafe(F.col("_key"))
    else:
        whole = dict(word_vectors.dtypes)[vector_col] in ("array<int>", "array<bigint>")  # they are smaller compressed
        known = listed.select("_w", _whole("_v", dims, lambda x: x.cast("bigint") if whole else x).alias("_v"), "_n")
        # A struct of a null equals another: sums are dealt once, for their groups and for the join.
        sums = _sums_by_frequency(docs, id_col, text_col, known, dims, unit).where("_all > 0").groupBy(
            F.struct("_key").alias("_key")).agg(
            F.sum("_all").alias("_all"), *(F.sum(F.get("_sums", F.lit(i))).alias(f"_d{i}") for i in range(dims)))
        same = F.struct(F.col(id_col).alias("_key")) == F.col("_key")
    mean = F.array(*(F.coalesce(F.col(f"_d{i}") / F.col("_all"), F.lit(0.0)) for i in range(dims))).cast("array<double>")
    rows = docs.select(id_col) if rows is None else rows
    return rows.join(sums, same, "left").select(*rows.columns, array_to_vector(mean).alias("features"))


VECTOR_SCALE = 1 << 20


def hashed_document_vectors(docs: DataFrame, id_col: str, text_col: str, vectors: DataFrame,
                            vec_id_col: str, vector_col: str) -> DataFrame:
    """M12 with feature hashing: every word takes one vector of the table, the one whose
    rank among the ids is md5(word) mod (number of vectors); the document vector
    (``features``, array<double>) is the count-weighted mean.

    Vectors are scaled to whole numbers (2**-20 steps), so sums are exact in any order and
    the only rounding is the final division.  A text's words are hashed to ranks and looked up
    block by block (``_vector_sums``).  A document without words has the zero vector."""
    from .cost import hash_bucket
    ranked = with_rank(vectors.select(F.col(vec_id_col).alias("_id"), F.col(vector_col).alias("_v")), ["_id"], "_rank")
    size = ranked.agg(F.max("_rank").alias("n"), F.max(F.size("_v")).alias("dims")).first()
    n, dims = size["n"] or 0, max(size["dims"] or 0, 0)
    whole = ranked.select((F.col("_rank") - 1).alias("_w"), F.col("_v").cast("array<double>").alias("_v"))
    whole = whole.select("_w", _whole("_v", dims, lambda x: F.round(x * VECTOR_SCALE).cast("bigint")).alias("_v"))
    known = _vector_sums(docs, id_col, text_col, lambda w: hash_bucket(w, max(n, 1)), whole, dims, "bigint")
    mean = F.array(*(F.coalesce(F.col(f"_d{i}") / (F.col("_all") * VECTOR_SCALE), F.lit(0.0)) for i in range(dims)))
    return docs.select(id_col).join(known, F.col(id_col).eqNullSafe(F.col("_key")), "left").select(
        id_col, mean.alias("features"))


FREQUENT_WORDS = 1 << 18    # words whose weights go to every task, at most
HELD_WORDS = 1 << 17        # words whose sums a task holds at once


class _Sums:
    """Vectors of whole numbers added up by word."""

    def __init__(self, dims: int) -> None:
        self.places: dict[str, int] = {}
        self.sums = np.zeros((1 << 10, dims), np.int64)

    def add(self, words: list[str], vectors: np.ndarray) -> None:
        at = np.array([self.places.setdefault(w, len(self.places)) for w in words], np.int64)
        while len(self.places) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        if len(set(words)) == len(words):
            self.sums[at] += vectors
        else:
            np.add.at(self.sums, at, vectors)

    def flush(self, least: int = 0) -> Iterator[tuple[pa.Array, pa.Array]]:
        """Words and vectors, if there are more than ``least``; they are forgotten."""
        if len(self.places) > least:
            yield from _packed(np.array([*self.places], object), self.sums[:len(self.places)])
            self.places.clear()
            self.sums = np.zeros((1 << 10, self.sums.shape[1]), np.int64)


def _packed(words: np.ndarray, x: np.ndarray) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Words and vectors; a vector's numbers have the fewest bytes that hold them all, zero vectors are left out."""
    top, before = np.abs(x).max(axis=1, initial=0), 0
    for kind in (np.int8, np.int16, np.int32, np.int64):
        most = np.iinfo(kind).max
        mine = (top > before) & (top <= most)
        before = most
        if mine.any():
            data = x[mine].astype(kind)
            ends = pa.array(np.arange(len(data) + 1, dtype=np.int32) * (data.itemsize * data.shape[1]))
            yield (pa.array(words[mine], pa.string()),
                   pa.Array.from_buffers(pa.binary(), len(data), [None, ends.buffers()[1], pa.py_buffer(data.tobytes())]))


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    """What ``_packed`` made of vectors; nulls are zero vectors."""
    out = np.zeros((len(column), dims), np.int64)
    long = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for kind in (np.int8, np.int16, np.int32, np.int64):
        mine = np.flatnonzero(long == dims * np.dtype(kind).itemsize)
        if len(mine) and dims:
            out[mine] = np.frombuffer(b"".join(column.take(pa.array(mine)).to_pylist()), kind).reshape(-1, dims)
    return out


def _by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, list[str]]]:
    """Rows sorted by ``word``: batches of whole words, each with the row at which a word begins and the words."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if table.num_rows:
            table = table.combine_chunks()
            runs = pc.run_end_encode(table.column("word").chunk(0))
            ends = runs.run_ends.to_numpy()
            whole = int(ends[-2]) if len(ends) > 1 else 0
            if whole:
                yield table.slice(0, whole), np.concatenate([[0], ends[:-2]]), runs.values.to_pylist()[:-1]
            table = table.slice(whole)
        rest = table
    if rest is not None and rest.num_rows:
        yield rest, np.array([0]), [rest.column("word")[0].as_py()]


def _projected(words: list[str], counts: list[int], total: int, dims: int, nonzeros: int, seed: int) -> np.ndarray:
    """A row per word: its weight as ``nonzeros`` signs at places that its hash gives."""
    out = np.zeros((len(words), dims), np.int16)
    for i, (w, n) in enumerate(zip(words, counts)):
        digest, weight = hashlib.md5(f"{seed}:{w}".encode()).digest(), (total // n).bit_length()
        for j in range(0, 2 * nonzeros, 2):
            x = digest[j] << 8 | digest[j + 1]
            out[i, x % dims] += -weight if x // dims % 2 else weight
    return out


def learned_vectors(docs: DataFrame, text_col: str, dims: int = 64, window: int = 2, min_count: int = 5,
                    nonzeros: int = 4, seed: int = 7) -> DataFrame:
    """M12, vectors learned from the corpus: word, n, vector (array<bigint> of ``dims``).

    A word's vector is its row of the co-occurrence matrix (words at most ``window`` tokens apart in a
    text), each context weighted by how rare it is, projected to ``dims`` dimensions at random:
    a context word adds ``nonzeros`` signs at places that its hash gives.  Words used in the same
    contexts get close vectors.  Counts and weights are whole numbers, so sums are exact in any order.

    The vocabulary is every word with ``min_count`` occurrences over all texts; rarer words have no
    vector (``document_vectors`` skips them) but count as contexts.  The weight of a context
    is the number of binary digits of (tokens of the corpus div its occurrences).  The weights of the
    FREQUENT_WORDS most frequent words go to every task, which adds up the contexts of its texts by word: a
    word is a row per task.  Another word travels with its neighbours, once for each occurrence; where
    they meet, they are counted, which gives its weight, and added to the neighbours' vectors."""
    texts = docs.select(_lowered(text_col).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(WORD.findall(text.as_py()))
                if len(seen) > HELD_WORDS:
                    yield pa.RecordBatch.from_pydict({"word": [*seen], "n": [*seen.values()]})
                    seen.clear()
        if seen:
            yield pa.RecordBatch.from_pydict({"word": [*seen], "n": [*seen.values()]})

    counts = stored_copy(texts.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0  # one number
    least = _least_count(counts, "n", FREQUENT_WORDS)
    frequent = counts.where(F.col("n") >= least).toArrow()  # FREQUENT_WORDS rows
    table = docs.sparkSession.sparkContext.broadcast(("\n".join(frequent.column("word").to_pylist()), frequent.column("n").to_numpy()))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, n = table.value
        names = names.split("\n") if names else []
        places = {w: i for i, w in enumerate(names)}
        get, gap = places.get, len(names)
        known = np.append(n >= min_count, False)
        weights = np.concatenate([_projected(names, n.tolist(), total, dims, nonzeros, seed), np.zeros((1, dims), np.int16)])
        held, words, lone, near = _Sums(dims), [], [], []
        maybe = lambda w: w is not None and (known[i] if (i := get(w)) is not None else least > min_count)

        def added() -> None:
            """Adds up ``words``, whole texts with gaps of ``window`` Nones after them."""
            at = np.fromiter((get(w, gap) for w in words), np.int64, len(words))
            for lo in range(0, len(words), SLICE_WORDS):
                a, z = max(lo - window, 0), min(lo + SLICE_WORDS, len(words))
                ids = at[a:z + window]
                rows = weights[ids].astype(np.int32)
                sums = np.zeros_like(rows)
                for d in range(1, window + 1):
                    sums[:-d] += rows[d:]
                    sums[d:] += rows[:-d]
                ids, sums = ids[lo - a:z - a], sums[lo - a:z - a]
                mine = np.flatnonzero(known[ids])
                mine = mine[np.argsort(ids[mine], kind="stable")]
                if len(mine):
                    starts = np.flatnonzero(np.concatenate([[True], ids[mine[1:]] != ids[mine[:-1]]]))
                    held.add([names[i] for i in ids[mine[starts]].tolist()], np.add.reduceat(sums[mine], starts, dtype=np.int32))
                rare = [p for p in np.flatnonzero(ids == gap).tolist() if words[lo + p] is not None]
                if rare and least > min_count:
                    held.add([words[lo + p] for p in rare], sums[rare])
                for p in rare:
                    p += lo
                    lone.append(words[p])
                    near.append(" ".join([w for w in (*words[max(p - window, 0):p], *words[p + 1:p + 1 + window]) if maybe(w)]))
            words.clear()

        def out(least: int) -> Iterator[pa.RecordBatch]:
            for w, v in held.flush(least):
                yield pa.RecordBatch.from_arrays([w, v, pa.nulls(len(w), pa.string())], names=["word", "v", "near"])
            if len(lone) > least // 4:
                yield pa.RecordBatch.from_arrays([pa.array(lone, pa.string()), pa.nulls(len(lone), pa.binary()), pa.array(near, pa.string())],
                                                 names=["word", "v", "near"])
                lone.clear()
                near.clear()

        for batch in batches:
            for text in batch.column(0):
                words += WORD.findall(text.as_py())
                words += [None] * window
                if len(words) > SLICE_WORDS:
                    added()
                    yield from out(HELD_WORDS)
        added()
        yield from out(0)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Sums(dims)
        for rows, starts, words in _by_word(batches):
            near = rows.column("near").combine_chunks()
            n = np.add.reduceat(near.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), starts)
            sums = np.add.reduceat(_unpacked(rows.column("v").combine_chunks(), dims), starts)
            own = (n == 0) | (n >= min_count)
            for w, v in _packed(np.array(words, object)[own], sums[own]):
                yield pa.RecordBatch.from_arrays([w, v], names=["word", "v"])
            rare = np.flatnonzero(n)
            weights = _projected([words[i] for i in rare], n[rare].tolist(), total, dims, nonzeros, seed)
            spot = np.full(len(words), -1)
            spot[rare] = np.arange(len(rare))
            of = np.repeat(spot, np.diff(np.append(starts, rows.num_rows)))
            to, by = [], []
            for i, ws in enumerate(near):
                if ws.is_valid and (mine := ws.as_py().split()):
                    to += mine
                    by += [of[i]] * len(mine)
            if to:
                held.add(to, weights[by])
            for w, v in held.flush(HELD_WORDS):
                yield pa.RecordBatch.from_arrays([w, v], names=["word", "v"])
        for w, v in held.flush():
            yield pa.RecordBatch.from_arrays([w, v], names=["word", "v"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts, words in _by_word(batches):
            n = np.maximum.reduceat(rows.column("n").fill_null(0).to_numpy(), starts)
            sums = np.add.reduceat(_unpacked(rows.column("v").combine_chunks(), dims), starts)
            mine = n >= min_count
            yield pa.RecordBatch.from_arrays([pa.array(np.array(words, object)[mine], pa.string()), pa.array(n[mine]), _lists(sums[mine])],
                                             names=["word", "n", "vector"])

    def sorted_by_word(df: DataFrame) -> DataFrame:
        return df.repartition("word").sortWithinPartitions("word")

    found = texts.mapInArrow(contexts, "word string, v binary, near string")
    if least > 1:  # else every word is listed
        found = sorted_by_word(found).mapInArrow(weighed, "word string, v binary")
    found = found.select("word", "v", F.lit(None).cast("bigint").alias("n"))
    known = counts.where(F.col("n") >= min_count).select("word", F.lit(None).cast("binary").alias("v"), "n")
    return sorted_by_word(found.unionByName(known)).mapInArrow(vectors, "word string, n bigint, vector array<bigint>")


def with_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """1, 2, ... in ``order`` over the whole frame, without a single-task window."""
    from .ranking import with_sequence
    return with_sequence(df, order, name)


def train_classifier(train: DataFrame, features: str = "features", label: str = "label",
                     max_iter: int = 20, reg: float = 0.01, parallelism: int = 4):
    """Linear SVM, one-vs-rest over the classes.  Each binary model is fitted
    with distributed gradient passes; ``parallelism`` fits several classes at once
    so the small per-iteration jobs overlap instead of running one after another."""
    svc = LinearSVC(maxIter=max_iter, regParam=reg)
    return OneVsRest(classifier=svc, featuresCol=features, labelCol=label,
                     parallelism=parallelism).fit(train)


def classify(model, df: DataFrame) -> DataFrame:
    """Adds ``prediction``."""
    return model.transform(df)
