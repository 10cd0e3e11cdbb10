"""Helpers shared by the operators of this subpackage.

Words are runs of bytes other than space and \\t..\\r.  ``bytes.split()`` and
``bytes.lower()`` know exactly those six separators and A-Z, and an ASCII byte is
never part of a longer UTF-8 character, so both work on the encoded text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored_copy as stored  # noqa: F401  (written table in the shared folder)

SLICE_BYTES = 2 << 20


def row_key(id_col: str, text_col: str) -> Column:
    """64-bit key of a row's id and text.  Nulls count (a hash alone skips them).  Unlike a
    generated id it is the same when a lost task runs again."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col), F.col(id_col).isNull(), F.col(text_col).isNull())


def row_digest(id_: Column, text: Column) -> Column:
    """128-bit key of a row's id and text, nulls included, for decisions about rows: two rows
    share it only if both are the same.  A text's digest has 32 digits, an id follows its mark."""
    return F.unhex(F.md5(F.concat(
        F.when(text.isNull(), F.lit("-")).otherwise(F.md5(text.cast("string").cast("binary"))),
        F.when(id_.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), id_.cast("string"))))))


BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows at most: whole texts are long, and a batch is held
    by the JVM and by a Python worker for each running task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under fixed names, whatever else ``df`` holds."""
    small_batches(df.sparkSession)
    return df.select(df[id_col].alias("doc_id"), df[text_col].cast("string").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about SLICE_BYTES of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.frombuffer(batch.column(text).buffers()[1], np.int32)
        ends = sizes[batch.column(text).offset:][:batch.num_rows + 1].astype(np.int64)
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + SLICE_BYTES)) - 1)
            yield batch.slice(lo, min(hi, batch.num_rows) - lo)
            lo = min(hi, batch.num_rows)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_STEP = [pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(64)]


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; one of the whole sequence if it is shorter."""
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    total = np.zeros(len(hashes) - k + 1, np.uint64)
    for i in range(k):
        total += hashes[i:len(hashes) - k + 1 + i] * np.uint64(_STEP[i])
    return mixed(total + np.uint64(k))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def int64_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """list<int64> column from one uint64/int64 array per row."""
    ends = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=ends[1:])
    flat = np.concatenate([a.view(np.int64) for a in arrays]) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


FILTER_SEGMENT = 1 << 16


class KeyFilter:
    """A bit per hash value: False for a key means it is not in the set.  The number of
    bits is bounded, so it may be broadcast whatever the size of the set."""

    def __init__(self, size: int, segments: dict[int, bytes]):
        self.bits = np.zeros(size // 8, np.uint8)
        for number, packed in segments.items():
            at = number * (FILTER_SEGMENT // 8)
            self.bits[at:at + FILTER_SEGMENT // 8] = np.frombuffer(packed, np.uint8)
        self.shift = np.uint64(64 - (size.bit_length() - 1))

    def __contains__(self, key: int) -> bool:
        return bool(self.test(np.array([key & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])

    def test(self, keys: np.ndarray) -> np.ndarray:
        at = mixed(keys) >> self.shift
        hit = (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
        return hit.astype(bool)


def key_filter(keys: DataFrame, count: int, bits_per_key: int = 64, max_bits: int = 1 << 27) -> tuple[int, dict[int, bytes]]:
    """(size in bits, segments) of the filter of the long column ``keys``; its size follows
    ``count`` up to ``max_bits`` (16 MB by default).  Segments are packed on the executors."""
    size = FILTER_SEGMENT
    while size < min(max(count, 1) * bits_per_key, max_bits):
        size *= 2
    shift = np.uint64(64 - (size.bit_length() - 1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(mixed(batch.column(0).to_numpy().view(np.uint64)) >> shift).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 16), pa.array(at & 0xFFFF)], ["segment", "bit"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bits = None, None
        for batch in batches:
            segment, low = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero(np.diff(segment)) + 1
            for part, number in zip(np.split(low, cuts), segment[np.concatenate([[0], cuts]).astype(int)] if len(segment) else []):
                if number != now:
                    if now is not None:
                        yield packed(now, bits)
                    now, bits = int(number), np.zeros(FILTER_SEGMENT, bool)
                bits[part] = True
        if now is not None:
            yield packed(now, bits)

    def packed(number: int, bits: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()])],
            ["segment", "bits"])

    placed = keys.mapInArrow(place, "segment long, bit long").distinct()
    rows = (placed.repartition("segment").sortWithinPartitions("segment")
            .mapInArrow(pack, "segment long, bits binary"))
    return size, {r["segment"]: bytes(r["bits"]) for r in rows.toLocalIterator()}
