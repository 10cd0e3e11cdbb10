"""Language identification by mixture inference.

Learning counts hashed character trigrams per language over all training rows, in one
distributed pass; the model is languages x BUCKETS counts, a size that does not grow
with the rows.  A document is then a mixture: expectation-maximisation estimates the
proportions of the languages from the likelihoods of its trigrams, first over all
languages, then over the most probable one, two, ... of them as long as the penalised
likelihood (PENALTY * log(trigrams) for each further language, trigrams overlap and so
count for less than independent draws) still grows.  The prediction is the language
with the largest proportion in the set selected.

Defined cases: a null text and one without a letter are ``und`` with score 0, and so
is every text if there is nothing to learn from; rows with null text or null language
teach nothing; a null id is not held out and teaches nothing; repeated rows count as
often as they occur; ties go to the language that sorts first; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, small_batches

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
PENALTY = 4.0
ROUNDS = 25
MAX_LANGUAGES = 500


def trigrams(text: str) -> np.ndarray:
    """Buckets of the character trigrams of the lower-cased text; ASCII characters
    other than letters count as blanks."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_other = (points < 128) & ((points < 97) | (points > 122))
    points = np.where(ascii_other, np.uint32(32), points)
    if len(points) < 3:
        return np.zeros(0, np.int64)
    key = (points[:-2] * np.uint32(0x9E3779B1) ^ points[1:-1] * np.uint32(0x85EBCA77)
           ^ points[2:] * np.uint32(0xC2B2AE3D))
    key = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((key ^ (key >> np.uint32(12))) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def held_out(id_col: Column) -> Column:
    """Documents whose crc32 of the id's text is 2 modulo 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(rows: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities by language and bucket) from every row."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in totals:
                    totals[lang] = np.zeros(BUCKETS, np.int64)
                totals[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, counts in totals.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used),
                                              pa.array(counts[used])], ["lang", "bucket", "n"])

    small_batches(rows.sparkSession)
    known = rows.select(rows[lang_col].alias("lang"), rows[text_col].alias("text")).dropna()
    cells = (known.mapInArrow(count, "lang string, bucket long, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
             .groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells")))
    got = cells.orderBy("lang").limit(MAX_LANGUAGES + 1).toArrow().to_pylist()
    if len(got) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    model = np.full((len(got), BUCKETS), SMOOTHING)
    for i, row in enumerate(got):
        for cell in row["cells"]:
            model[i, cell["bucket"]] += cell["n"]
    return [r["lang"] for r in got], np.log(model / model.sum(axis=1, keepdims=True)) if got else model


def mixture(weights: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the languages (columns of ``logs``) that maximise the likelihood
    of buckets seen ``weights`` times, and that log likelihood."""
    top = logs.max(axis=1, keepdims=True)
    like = np.exp(logs - top)
    total = weights.sum()
    share = np.full(logs.shape[1], 1 / logs.shape[1])
    for _ in range(ROUNDS if logs.shape[1] > 1 else 0):
        joint = like * share
        new = (weights / joint.sum(axis=1)) @ joint / total
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return share, float(weights @ (np.log(like @ share) + top[:, 0]))


def infer(text: str | None, logs: np.ndarray) -> tuple[int, float, list[int]]:
    """(index of the language, its proportion, the set selected); index -1: und."""
    if not text or not len(logs) or not any(map(str.isalpha, text)):
        return -1, 0.0, []
    used, weights = np.unique(trigrams(text), return_counts=True)
    columns = logs[:, used].T
    shares, _ = mixture(weights, columns)
    order = np.argsort(-shares, kind="stable")
    chosen, share, best = order[:1], np.ones(1), float(weights @ columns[:, order[0]])
    price = PENALTY * np.log(weights.sum() + 1)
    for k in range(2, len(order) + 1):
        more, like = mixture(weights, columns[:, order[:k]])
        if like - (k - 1) * price <= best - (k - 2) * price:
            break
        chosen, share, best = order[:k], more, like
    at = int(np.argmax(share))
    return int(chosen[at]), float(min(1.0, max(0.0, shares[chosen[at]]))), sorted(int(c) for c in chosen)


def identify(docs: DataFrame, languages: list[str], logs: np.ndarray, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, langs (the language set of the mixture)."""
    share = docs.sparkSession.sparkContext.broadcast(logs.astype(np.float32))  # languages x BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = share.value.astype(np.float64)
        for batch in slices(batches):
            got = [infer(t, model) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array([languages[i] if i >= 0 else "und" for i, _, _ in got], pa.string()),
                 pa.array([s for _, s, _ in got], pa.float64()),
                 pa.array([[languages[i] for i in c] for _, _, c in got], pa.list_(pa.string()))],
                ["doc_id", "held_out", "lang_pred", "score", "langs"])

    rows = docs.select(docs[id_col].alias("doc_id"), held_out(docs[id_col]).alias("held_out"),
                       docs[text_col].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, "
                                "langs array<string>")


def identify_by_fold(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict every row."""
    teach = docs.where(docs[id_col].isNotNull() & ~held_out(docs[id_col]))
    return identify(docs, *learn(teach, lang_col, text_col), id_col, text_col)
