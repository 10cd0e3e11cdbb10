"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are short, documents long, so the Jaccard similarity of an item and a whole
document says nothing.  Items are therefore partitioned by size: the class of an item is
the power of two below its number of shingles, and for each class documents are read
through half-overlapping windows of four times that size, so that an occurrence lies in
one window and the containment threshold means a Jaccard similarity of at least
``threshold / (4 + 1 - threshold)`` there.  That bound sets the number of MinHash
coordinates at which a window with a hit shares none with probability MISS.  A window
that shares a coordinate value with an item makes (document, item) a candidate; the
candidates are verified by the exact containment of the item's shingles in the whole
document.

Documents are read once.  A task tests window values and shingles against two filters of
bounded size made from the items, and emits only what passes, so what is shuffled are
the likely hits; the items themselves are joined, not broadcast.

An item of fewer words than a shingle is one shingle, its whole word sequence, and is found
wherever a document holds that sequence.

Defined cases: words are lower-cased (A-Z); null and empty texts match nothing; rows that share a doc_id (or
item_id), null ids included, count as one document (item) whose best row counts; an
empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (KeyFilter, as_bytes, int64_lists, key_filter, mixed, row_digest, shingle_hashes, slices,
                     stored, two_columns, word_hashes)

WORDS = 5
THRESHOLD = 0.8
MISS = 1e-9


def coordinates(threshold: float, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - threshold / (5 - threshold)))


def size_class(n: int) -> int:
    return n.bit_length() - 1


def multipliers(n: int) -> np.ndarray:
    return (mixed(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def token(values: np.ndarray, coordinate: int, size: int) -> np.ndarray:
    """One 64-bit key for (size class, coordinate, value)."""
    return mixed(values.astype(np.uint64) + np.uint64((size << 16 | coordinate) << 32))


def item_table(items: DataFrame, id_col: str, text_col: str, words: int, count: int) -> DataFrame:
    """item_key, item_id, size (class; minus the words of a short item), shingles (distinct),
    tokens (one per coordinate; a short item's shingle)."""
    factors = multipliers(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes = [word_hashes((t or b"").lower().split()) for t in as_bytes(batch.column("text"))]
            keep = [i for i, h in enumerate(hashes) if len(h)]
            sets = [np.unique(shingle_hashes(hashes[i], words)) for i in keep]
            few = [len(hashes[i]) if len(hashes[i]) < words else 0 for i in keep]
            tokens = []
            for s, short in zip(sets, few):
                if short:  # found by itself
                    tokens.append(s)
                    continue
                low = (s >> np.uint64(32)).astype(np.uint32)
                tokens.append(np.concatenate([token((low * f).min(keepdims=True), k, size_class(len(s)))
                                              for k, f in enumerate(factors)]))
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column("item_key"), part.column("doc_id"),
                 pa.array([-short if short else size_class(len(s)) for s, short in zip(sets, few)], pa.int32()),
                 int64_lists(sets), int64_lists(tokens)], ["item_key", "item_id", "size", "shingles", "tokens"])

    rows = two_columns(items, id_col, text_col).select(row_digest(F.col("doc_id"), F.col("text")).alias("item_key"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"item_key binary, item_id {kind}, size int, shingles array<long>, "
                                "tokens array<long>").dropDuplicates(["item_key"])


def window_hits(lists: list[np.ndarray], sizes: list[int], factors: np.ndarray, known: KeyFilter) -> list[np.ndarray]:
    """For each shingle sequence the tokens of its windows that pass the filter.

    All sequences are laid end to end and cut into blocks that start anew with each; a
    window is a block and the next one of the same sequence."""
    found: list[list[np.ndarray]] = [[] for _ in lists]
    used = [i for i, s in enumerate(lists) if len(s)]
    if not used:
        return [np.zeros(0, np.uint64) for _ in lists]
    flat = (np.concatenate([lists[i] for i in used]) >> np.uint64(32)).astype(np.uint32)
    lengths = np.array([len(lists[i]) for i in used])
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    cuts = []
    for size in sizes:
        step = 2 << size  # the block of a class is twice its power, the window four times
        blocks = -(-lengths // step)
        owner = np.repeat(np.arange(len(used)), blocks)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        more = np.concatenate([owner[1:] == owner[:-1], [False]])
        cuts.append((size, begins[owner] + inner * step, owner, more))
    for k, factor in enumerate(factors):
        values = flat * factor
        for size, starts, owner, more in cuts:
            least = np.minimum.reduceat(values, starts)
            windows = np.where(more, np.minimum(least, np.concatenate([least[1:], least[-1:]])), least)
            tokens = token(windows, k, size)
            for at in np.flatnonzero(known.test(tokens)):
                found[used[owner[at]]].append(tokens[at:at + 1])
    return [np.unique(np.concatenate(f)) if f else np.zeros(0, np.uint64) for f in found]


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", words: int = WORDS,
               threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles (of the item), containment: each item of
    which at least ``threshold`` of the shingles stand in the document."""
    exact = leaking_rows(docs, items, id_col, text_col, item_id_col, item_text_col, words, threshold, miss)
    best = F.max(F.struct((F.col("n_shared") / F.col("n_shingles")).alias("containment"), "n_shared", "n_shingles"))
    return exact.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", "best.n_shared", "best.n_shingles", "best.containment")


def leaking_rows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", words: int = WORDS,
                 threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """row_key, doc_id, item_id, n_shared, n_shingles: the leaks of ``find_leaks`` by row."""
    count = coordinates(threshold, miss)
    table = stored(item_table(items, item_id_col, item_text_col, words, count))
    spread = table.agg(F.collect_set("size").alias("sizes"), F.sum(F.size("shingles")).alias("n"),
                       F.count("*").alias("items")).first()
    sizes = sorted(n for n in spread["sizes"] if n >= 0)  # at most one per power of two
    short = sorted(-n for n in spread["sizes"] if n < 0)  # below ``words``
    tokens = key_filter(table.select(F.explode("tokens")), (spread["items"] or 0) * count)
    parts = key_filter(table.select(F.explode("shingles")), spread["n"] or 0)
    shared = docs.sparkSession.sparkContext.broadcast((tokens, parts))
    factors = multipliers(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_token, by_part = (KeyFilter(*f) for f in shared.value)
        for batch in slices(batches):
            hashes = [word_hashes((t or b"").lower().split()) for t in as_bytes(batch.column("text"))]
            lists = [shingle_hashes(h, words) if len(h) >= words else h[:0] for h in hashes]
            hits = window_hits(lists, sizes, factors, by_token)
            for k in short:
                for i, h in enumerate(hashes):
                    if len(h) >= k:
                        own = shingle_hashes(h, k)
                        own = np.unique(own[by_part.test(own)])
                        hits[i], lists[i] = np.concatenate([hits[i], own]), np.concatenate([lists[i], own])
            keep = [i for i, h in enumerate(hits) if len(h)]
            inside = [np.unique(s[by_part.test(s)]) for s in (lists[i] for i in keep)]
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column("row_key"), part.column("doc_id"), int64_lists([hits[i] for i in keep]),
                 int64_lists(inside)], ["row_key", "doc_id", "tokens", "inside"])

    rows = two_columns(docs, id_col, text_col).select(row_digest(F.col("doc_id"), F.col("text")).alias("row_key"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    hit = stored(rows.mapInArrow(run, f"row_key binary, doc_id {kind}, tokens array<long>, inside array<long>"))
    pairs = (hit.select("row_key", F.explode("tokens").alias("token"))
             .join(table.select("item_key", F.explode("tokens").alias("token")), "token")
             .select("row_key", "item_key").distinct())
    return (pairs.join(hit.select("row_key", "doc_id", "inside"), "row_key")
            .join(table.select("item_key", "item_id", "shingles"), "item_key")
            .select("row_key", "doc_id", "item_id",
                    F.size(F.array_intersect("inside", "shingles")).cast("long").alias("n_shared"),
                    F.size("shingles").cast("long").alias("n_shingles"))
            .where(F.col("n_shared") * 1000 >= F.col("n_shingles") * round(threshold * 1000)))


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that hold an item, all columns as they are; another row
    with the same or a null id stays."""
    leaks = leaking_rows(docs, items, id_col, text_col, **how).select(F.col("row_key").alias("leaking")).distinct()
    keyed = docs.select(row_digest(docs[id_col], docs[text_col]).alias("key"),
                        F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    return keyed.join(leaks, keyed["key"] == leaks["leaking"], "left_anti").select("row.*")
