"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

Every document is cut into blocks by content: of the word 8-grams in each window of ``window``
words the one with the smallest hash is its anchor, and the words of all consecutive windows with
the same anchor are one block.  Equal windows have equal anchors, so the anchor is the index
under which a copy of any window must stand, and every block of the corpus is a reference block.

* Blocks whose anchor occurs once in the corpus match nothing.
* A block that occurs again as a whole is matched to one real occurrence, its reference: the first
  one by (row key, start), for the first one itself the last.
* Where a copy ends inside a block, the blocks under the same anchor differ; there one
  representative of each is looked at window by window, and a window that occurs again has a
  reference in the same way.

Touching matches at the same reference document and offset are one match, which runs as far as
that reference does.  A document is then parsed greedily from left to right (``parse``): a factor
goes from the first word not yet parsed as far as any match that holds this word; where none
does, the parse moves on to the next match.  Matches are at least a window long, and as every window
at a block's end has been asked for, no repeated window is lost where a factor ends.  The words of
the factors are removed; ``n_factors`` counts them.
Identity is that of two independent 64-bit hashes (anchor and block, or anchor and window).

Shuffled are one short row per block with a repeated anchor, the texts of documents with
boundaries, and the texts of documents that lose words.  Which rows take part is tested
against filters of bounded size, errors of which only add rows to the exact joins.

Defined cases: a null or empty text, or one shorter than a window, has no window and
stays; all occurrences of a repeated window are removed, the first included, also within
one document and between repeated rows; rows are told apart by id and text, so null and
repeated ids need no care; an empty table gives an empty result; other columns pass
through (``rest``) whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import KeyFilter, as_bytes, key_filter, mixed, row_key, slices, stored, two_columns, word_hashes

WINDOW = 35
GRAM = 8
PIECE = 1 << 18
_PLACE = np.uint64((1 << 24) - 1)


def _powers(factor: int) -> tuple[np.ndarray, np.ndarray]:
    """factor**i and factor**-i modulo 2**64."""
    inverse = pow(factor, -1, 1 << 64)
    steps = np.ones(PIECE + 4 * WINDOW + 1, np.uint64)
    steps[1:] = factor
    back = np.ones_like(steps)
    back[1:] = inverse
    return np.cumprod(steps), np.cumprod(back)


_ONE, _TWO = _powers(0x9E3779B97F4A7C15), _powers(0xD6E8FEB86659FD93)


def _sums(hashes: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers[0][:len(hashes)], out=out[1:])
    return out


def _span(sums: np.ndarray, start: np.ndarray, end: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Hash of the words [start, end), the same wherever they stand."""
    return (sums[end] - sums[start]) * powers[1][start]


def blocks_of(hashes: np.ndarray, window: int, gram: int) -> list[np.ndarray]:
    """anchor, block hash, first window, number of windows; of one piece of a text."""
    n = len(hashes) - window + 1
    if n <= 0:
        return [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 2
    at = np.arange(len(hashes) - gram + 1)
    grams = mixed(_span(_sums(hashes, _ONE), at, at + gram, _ONE))
    least = (grams & ~_PLACE) | (_PLACE - at.astype(np.uint64))  # of equal ones the last
    span, width = window - gram + 1, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[span - width:span - width + n])
    place = (_PLACE - (least & _PLACE)).astype(np.int64)
    start = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
    count = np.diff(np.concatenate([start, [n]]))
    body = _span(_sums(hashes, _TWO), start, start + count + window - 1, _TWO)
    body = mixed(body + count.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
                 + (place[start] - start).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    return [grams[place[start]], body, start, count]


def pieces(hashes: np.ndarray, window: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Runs of at most ``size`` windows; a block cut between two runs differs from uncut
    copies and is then compared window by window."""
    for at in range(0, max(len(hashes) - window + 1, 0), size):
        yield at, hashes[at:at + size + window - 1]


def block_table(rows: DataFrame, window: int, gram: int, piece: int = PIECE) -> DataFrame:
    """(anchor, body, row_key, start, count) of every block of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out, keys = [], []
            for key, text in zip(batch.column("row_key").to_pylist(), as_bytes(batch.column("text"))):
                for at, part in pieces(word_hashes((text or b"").split()), window, piece):
                    got = blocks_of(part, window, gram)
                    got[2] = got[2] + at
                    out.append(got)
                    keys.append(np.full(len(got[0]), key, np.int64))
            if out:
                anchor, body, start, count = (np.concatenate([o[i] for o in out]) for i in range(4))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(body.view(np.int64)), pa.array(np.concatenate(keys)),
                     pa.array(start, pa.int32()), pa.array(count, pa.int32())],
                    ["anchor", "body", "row_key", "start", "count"])

    return rows.select("row_key", "text").mapInArrow(run, "anchor long, body long, row_key long, start int, count int")


def filter_of(keys: DataFrame, bits_per_key: int = 16) -> Broadcast:
    return keys.sparkSession.sparkContext.broadcast(key_filter(keys, keys.count(), bits_per_key))


def passing(frame: DataFrame, column: str, known: Broadcast) -> DataFrame:
    """The rows of ``frame`` whose ``column`` may be among the keys of a broadcast filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = KeyFilter(*known.value)
        for batch in batches:
            hit = test.test(batch.column(column).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(hit))

    return frame.mapInArrow(run, frame.schema)


def boundary_windows(rows: DataFrame, blocks: DataFrame, window: int, piece: int = PIECE) -> DataFrame:
    """(anchor, hash, row_key, at, single) of every window of the given blocks."""
    todo = blocks.groupBy("row_key").agg(F.collect_set(F.struct("anchor", "start", "count", "single")).alias("blocks"))
    texts = passing(rows, "row_key", filter_of(todo.select("row_key"))).join(todo, "row_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for key, text, wanted in zip(batch.column("row_key").to_pylist(), as_bytes(batch.column("text")),
                                         batch.column("blocks").to_pylist()):
                hashes = word_hashes((text or b"").split())
                wanted.sort(key=lambda b: b["start"])
                low, sums = -1, None
                for b in wanted:
                    first = b["start"] // piece * piece
                    if first != low:
                        low, sums = first, _sums(hashes[first:first + piece + window - 1], _TWO)
                    at = np.arange(b["start"], b["start"] + b["count"])
                    hashed = mixed(_span(sums, at - low, at - low + window, _TWO))
                    out.append((np.full(len(at), b["anchor"]), hashed, np.full(len(at), key), at,
                                np.full(len(at), b["single"])))
            if out:
                anchor, hashed, keys, at, single = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(hashed.view(np.int64)), pa.array(keys), pa.array(at, pa.int32()),
                     pa.array(single)], ["anchor", "hash", "row_key", "at", "single"])

    return texts.select("row_key", "text", "blocks").mapInArrow(
        run, "anchor long, hash long, row_key long, at int, single boolean")


def _occurrences(start: str):
    """The first and the last of equal occurrences."""
    place = F.struct("row_key", F.col(start).alias("start"))
    return F.min(place).alias("first"), F.max(place).alias("last")


def _reference(start: str):
    """The first occurrence, for the first one itself the last."""
    here = F.struct(F.col("row_key"), F.col(start).alias("start"))
    return F.when(F.col("first") == here, F.col("last")).otherwise(F.col("first"))


def matches(rows: DataFrame, window: int = WINDOW, gram: int = GRAM, piece: int = PIECE) -> DataFrame:
    """(row_key, start, end, ref_key, shift): runs of words that also stand in the row ``ref_key``,
    from ``start`` - ``shift`` on; neighbouring windows of one reference are one run."""
    blocks = stored(block_table(rows, window, gram, piece))
    again = stored(blocks.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    blocks = passing(blocks, "anchor", filter_of(again))
    bodies = stored(blocks.groupBy("anchor", "body").agg(F.count("*").alias("n"), *_occurrences("start")))
    whole = bodies.where("n > 1").select("anchor", "body", "first", "last")
    found = (blocks.join(whole, ["anchor", "body"]).withColumn("ref", _reference("start"))
             .select("row_key", "start", (F.col("start") + F.col("count") + (window - 1)).alias("end"), "ref"))

    mixed_anchors = bodies.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor")
    edge = bodies.join(mixed_anchors, "anchor").select("anchor", "body", F.col("first.row_key").alias("row_key"), (F.col("n") == 1).alias("single"))
    edge = stored(blocks.join(edge, ["anchor", "body", "row_key"]).select("anchor", "row_key", "start", "count", "single"))
    windows = stored(boundary_windows(rows, edge, window, piece))
    twice = windows.groupBy("anchor", "hash").agg(F.count("*").alias("n"), *_occurrences("at")).where("n > 1")
    tails = (windows.where("single").join(twice.drop("n"), ["anchor", "hash"]).withColumn("ref", _reference("at"))
             .select("row_key", F.col("at").alias("start"), (F.col("at") + window).alias("end"), "ref"))
    every = (found.unionByName(tails)
             .select("row_key", "start", "end", F.col("ref.row_key").alias("ref_key"), (F.col("start") - F.col("ref.start")).alias("shift"))
             .repartition("row_key"))
    line = Window.partitionBy("row_key", "ref_key", "shift").orderBy("start", "end")
    reach = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= F.coalesce(reach, F.lit(-1)), 0).otherwise(1)
    runs = every.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("row_key", "ref_key", "shift", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def parse(found: list[dict]) -> list[tuple[int, int]]:
    """The factors (start, end) of a document: from the first word that no factor has yet and a
    match holds, to the furthest end of the matches that hold it."""
    here = sorted((m["start"], m["end"]) for m in found)
    factors: list[tuple[int, int]] = []
    at = furthest = i = 0
    while True:
        while i < len(here) and here[i][0] <= at:
            furthest = max(furthest, here[i][1])
            i += 1
        if furthest > at:
            factors.append((at, furthest))
            at = furthest
        elif i < len(here):
            at = here[i][0]
        else:
            return factors


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     gram: int = GRAM, piece: int = PIECE) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (the words kept, one space between),
    n_words, n_removed, n_factors and a struct ``rest`` of all other columns."""
    rest = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"),
                       F.struct(*(docs[c] for c in docs.columns if c != text_col)).alias("rest"))
    rest = rest.select(row_key("doc_id", "text").alias("row_key"), "doc_id", "text", "rest")
    rows = two_columns(docs, id_col, text_col).select(row_key("doc_id", "text").alias("row_key"), "text")
    spans = stored(matches(rows, window, gram, piece).groupBy("row_key").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")))

    known = filter_of(spans.select("row_key"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = KeyFilter(*known.value)
        for batch in slices(batches):
            if "spans" not in batch.schema.names:
                hit = test.test(batch.column("row_key").to_numpy().view(np.uint64))
                batch = batch.filter(pa.array(~hit))
            out = []
            marks = batch.column("spans").to_pylist() if "spans" in batch.schema.names else [None] * batch.num_rows
            for text, mark in zip(as_bytes(batch.column("text")), marks):
                words = (text or b"").split()
                if mark:
                    found = parse(mark)
                    kept, at, factors = [], 0, len(found)
                    for start, end in found:
                        kept += words[at:start]
                        at = end
                    kept += words[at:]
                else:
                    kept, factors = words, 0
                out.append((b" ".join(kept).decode(), len(words), len(words) - len(kept), factors))
            text, n, removed, factors = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(text, pa.string()), pa.array(n, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(factors, pa.int64()), batch.column("rest")],
                ["doc_id", "text", "n_words", "n_removed", "n_factors", "rest"])

    shape = (StructType().add(rest.schema["doc_id"]).add("text", "string").add("n_words", "long")
             .add("n_removed", "long").add("n_factors", "long").add(rest.schema["rest"]))
    touched = passing(rest, "row_key", known).join(spans, "row_key", "left")
    return rest.mapInArrow(finish, shape).unionByName(touched.mapInArrow(finish, shape))
