"""Packing into optimal length buckets.

A length is the number of tokens of the whole text, as ``tokens.count_tokens`` counts it.
A histogram of all lengths goes to the driver.  Its size is bounded: lengths up to EXACT
have a cell each, longer ones share cells of 1/CELLS_PER_OCTAVE of their power of two; a
cell stands for the largest length that occurs in it, so every bucket ends at the length
of a document.  Dynamic programming over the cells chooses, among the boundaries between
cells, those that minimise the padding of all documents (every document padded to its
bucket's length).  Inside a bucket documents form batches of ``token_budget // bucket length`` documents, one at
least, so that no padded batch is over the budget unless one document is.

A bucket may hold any share of the rows, so it is split into shards by a hash of the
row and of its place in the counted table (equal rows spread, too), as many as its count in the
histogram asks for; batches form inside (bucket, shard), and only the last batch of a shard can
be smaller.

Defined cases: a null or empty text has length 0 and is packed like any other row; a
document longer than the budget is a batch of its own, whole; repeated rows and null ids
each take a place; equal lengths never separate into two buckets; an empty table gives
an empty result; only id and text are read, so other columns and their names don't
matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, stored, two_columns
from .tokens import VOCABULARY, count_tokens

EXACT = 2048
CELLS_PER_OCTAVE = 64
SHARD_ROWS = 20_000


def cell_of(length: Column) -> Column:
    """Upper end of the length's histogram cell."""
    octave = F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double")))
    grain = F.pow(F.lit(2.0), octave) / CELLS_PER_OCTAVE
    return F.when(length <= EXACT, length).otherwise((F.ceil(length / grain) * grain).cast("long"))


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least total padding.

    ``lengths`` ascend; a bucket of cells i..j pads each of its rows to lengths[j].  The
    best split point grows with j, so each layer is filled by divide and conquer."""
    h = len(lengths)
    if not h:
        return []
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    total = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)

    def cost(i: np.ndarray, j: int) -> np.ndarray:
        return lengths[j - 1] * (rows[j] - rows[i]) - (total[j] - total[i])

    best = np.full(h + 1, np.inf)
    best[0] = 0.0
    cuts: list[np.ndarray] = []
    for _ in range(min(buckets, h)):
        layer, cut = np.full(h + 1, np.inf), np.zeros(h + 1, np.int64)
        layer[0] = 0.0
        todo = [(1, h, 0, h)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            values = best[i] + cost(i, j)
            at = int(np.argmin(values))
            layer[j], cut[j] = values[at], i[at]
            todo += [(lo, j - 1, first, int(i[at])), (j + 1, hi, int(i[at]), last)]
        cuts.append(cut)
        best = layer
    ends, j = [], h
    for cut in reversed(cuts):
        if j == 0:
            break
        ends.append(int(lengths[j - 1]))
        j = int(cut[j])
    return ends[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 16,
         token_budget: int = 16_384, shard_rows: int = SHARD_ROWS, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket_len (the padded length),
    shard, batch (its number within bucket and shard), slot (its place in the batch)
    and padding."""
    rows = two_columns(docs, id_col, text_col)
    # the key goes through the count as its id, next to the id proper
    keyed = rows.select(F.struct("doc_id", row_key("doc_id", "text").alias("row_key")).alias("doc_id"), "text")
    rows = stored(count_tokens(keyed, vocabulary).select("doc_id.doc_id", "n_tokens", "doc_id.row_key"))
    # the table is stored, so a place is the same when a lost task runs again
    rows = rows.withColumn("cell", cell_of(F.col("n_tokens"))).withColumn("at", F.monotonically_increasing_id())
    histogram = (rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("n_tokens").alias("longest"))
                 .orderBy("cell").collect())
    cells = np.array([r["longest"] for r in histogram], np.int64)
    counts = np.array([r["n"] for r in histogram], np.int64)
    ends = boundaries(cells, counts, buckets)
    held = [int(counts[(cells <= e) & (cells > b)].sum()) for b, e in zip([-1, *ends[:-1]], ends)]
    table = docs.sparkSession.createDataFrame(
        [(e, max(1, -(-n // shard_rows)), max(1, token_budget // max(e, 1))) for e, n in zip(ends, held)],
        "bucket_len long, shards int, per_batch int")  # one row per bucket
    bucket = F.lit(None).cast("long")
    for e in reversed(ends):
        bucket = F.when(F.col("n_tokens") <= e, F.lit(e).cast("long")).otherwise(bucket)
    placed = (rows.withColumn("bucket_len", bucket).join(F.broadcast(table), "bucket_len")
              .withColumn("shard", F.pmod(F.xxhash64("row_key", "n_tokens", "at"), F.col("shards")).cast("int")))
    place = F.row_number().over(Window.partitionBy("bucket_len", "shard").orderBy("doc_id", "row_key")) - 1
    return (placed.withColumn("place", place)
            .select("doc_id", "n_tokens", "bucket_len", "shard",
                    F.floor(F.col("place") / F.col("per_batch")).cast("long").alias("batch"),
                    (F.col("place") % F.col("per_batch")).cast("long").alias("slot"),
                    (F.col("bucket_len") - F.col("n_tokens")).alias("padding")))
