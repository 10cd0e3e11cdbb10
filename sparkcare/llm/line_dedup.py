"""Exact line dedup with two Bloom filters.

A line's key is the line without outer blanks, A-Z in lower case.  Pass 1 hashes every
key of MIN_CHARS code points or more and sets its bits in two Bloom filters: *once* (seen
in a document) and *twice* (seen in another one as well).  A task keeps both for its own
lines as sorted bit numbers by segment; merging segments sets *twice* where the bits of
either filter say so and where both *once* filters agree, which can only err towards a
repeat.  Pass 2 probes *twice*: only the digests of suspected repeats are shuffled, pre-
aggregated to smallest and largest document, and a key is confirmed if they differ.  The
last passes apply this: texts without a suspect are finished where they are, only the
others meet the keys they lose.

The filters hold BITS_PER_KEY bits per key, up to ``max_filter_bits`` in all (the part
that is broadcast has this bound).  Beyond it more lines become suspects and are shuffled
as digests: the result is exact at every size.  Keys are compared by 128-bit BLAKE2b.

Defined cases: a null or empty text is one empty line; the same line within one document
is no repeat by itself; rows with the same id count as one document, null ids as one that
sorts last; an empty table gives an empty result; other columns pass through
(``dedup_lines``) whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import as_bytes, slices, stored, two_columns

MIN_CHARS = 10
BLANKS = b" \t\n\x0b\x0c\r"
SEGMENT_BITS = 1 << 16
HASHES = 4
BITS_PER_KEY = 12
MAX_FILTER_BITS = 1 << 28


def keys_of(text: bytes | None, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text and the key of each (None: too short to be compared)."""
    lines = (text or b"").split(b"\n")
    keys: list[bytes | None] = []
    for line in lines:
        key = line.strip(BLANKS).lower()
        long = len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars)
        keys.append(key if long else None)
    return lines, keys


def bit_numbers(hashes: np.ndarray, segments: int) -> np.ndarray:
    """HASHES bit numbers per key, all in one segment: rows x HASHES."""
    segment = hashes % np.uint64(segments)
    step = (hashes >> np.uint64(48)) | np.uint64(1)
    inner = (hashes >> np.uint64(24))[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return (segment[:, None] * np.uint64(SEGMENT_BITS) + inner % np.uint64(SEGMENT_BITS)).astype(np.int64)


def _by_segment(bits: np.ndarray) -> dict[int, bytes]:
    if not len(bits):
        return {}
    segment = bits >> 16
    cuts = np.flatnonzero(np.diff(segment)) + 1
    low = (bits & 0xFFFF).astype(np.uint16)
    return {int(part_of): part.tobytes() for part_of, part in zip(segment[np.concatenate([[0], cuts])], np.split(low, cuts))}


def twice_filter(docs: DataFrame, min_chars: int = MIN_CHARS, max_filter_bits: int = MAX_FILTER_BITS) -> tuple[int, dict[int, bytes]]:
    """(segments, compressed bits of *twice* by segment) over the texts of ``docs``."""
    lines = docs.agg(F.sum(F.length("text") - F.length(F.translate("text", "\n", "")) + 1)).first()[0] or 0
    segments = max(1, -(-min(lines * BITS_PER_KEY, max_filter_bits) // SEGMENT_BITS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(hashes: list[np.ndarray]) -> pa.RecordBatch:
            every = np.concatenate(hashes)
            seen, n = np.unique(every, return_counts=True)
            once = _by_segment(np.unique(bit_numbers(seen, segments)))
            twice = _by_segment(np.unique(bit_numbers(seen[n > 1], segments)))
            order = sorted(once)
            return pa.RecordBatch.from_arrays(
                [pa.array(order, pa.int64()), pa.array([once[s] for s in order], pa.binary()),
                 pa.array([twice.get(s, b"") for s in order], pa.binary())], ["segment", "once", "twice"])

        held, size = [], 0
        for batch in slices(batches):
            for text in as_bytes(batch.column("text")):
                keys = {k for k in keys_of(text, min_chars)[1] if k is not None}
                if keys:
                    held.append(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)))
                    size += len(keys)
            if size > 2_000_000:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by segment; memory holds the two filters of one segment."""
        now, once, twice = None, None, None

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([zlib.compress(np.packbits(twice).tobytes(), 1)])], ["segment", "bits"])

        for batch in batches:
            for segment, ones, twos in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != now:
                    if now is not None and twice.any():
                        yield packed()
                    now, once, twice = segment, np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
                ones = np.frombuffer(ones, np.uint16)
                twice[ones[once[ones]]] = True
                once[ones] = True
                twice[np.frombuffer(twos, np.uint16)] = True
        if now is not None and twice.any():
            yield packed()

    merged = (docs.select("text").mapInArrow(build, "segment long, once binary, twice binary")
              .repartition("segment").sortWithinPartitions("segment")
              .mapInArrow(merge, "segment long, bits binary"))
    return segments, {r["segment"]: r["bits"] for r in merged.toLocalIterator()}


class Probe:
    """Tells suspected repeats; built once per task from the broadcast filter."""

    def __init__(self, segments: int, bits: dict[int, bytes]):
        self.segments = segments
        self.slot = np.full(segments, -1, np.int64)
        self.slot[list(bits)] = np.arange(len(bits))
        packed = [np.frombuffer(zlib.decompress(b), np.uint8) for b in bits.values()]
        self.bits = np.stack(packed) if packed else np.zeros((1, SEGMENT_BITS // 8), np.uint8)

    def suspects(self, keys: list[bytes | None]) -> list[bool]:
        at = [i for i, k in enumerate(keys) if k is not None]
        found = [False] * len(keys)
        if at:
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(keys[i]) for i in at), np.uint64, len(at))
            bits = bit_numbers(hashes, self.segments)
            slot = self.slot[bits[:, 0] >> 16][:, None]
            low = bits & 0xFFFF
            hit = ((self.bits[slot, low >> 3] >> (7 - (low & 7)).astype(np.uint8)) & 1).all(axis=1) & (slot[:, 0] >= 0)
            for i in np.flatnonzero(hit):
                found[at[i]] = True
        return found


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (the lines kept), n_lines, n_dropped and
    a struct ``rest`` of all columns of ``docs``."""
    rest = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"),
                       F.struct(*(docs[c] for c in docs.columns if c != text_col)).alias("rest"))
    texts = two_columns(docs, id_col, text_col)
    segments, bits = twice_filter(texts, min_chars, max_filter_bits)
    filter_ = docs.sparkSession.sparkContext.broadcast(bits)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = Probe(segments, filter_.value)
        for batch in slices(batches):
            rows, digests = [], []
            for i, text in enumerate(as_bytes(batch.column("text"))):
                keys = list(dict.fromkeys(keys_of(text, min_chars)[1]))
                found = [_digest(k) for k, s in zip(keys, probe.suspects(keys)) if s]
                rows += [i] * len(found)
                digests += found
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(digests, pa.binary())],
                ["doc_id", "key"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    doc = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"))
    seen = stored(texts.mapInArrow(suspects, f"doc_id {kind}, key binary"))
    # written, so that the join below deals both sides anew and a hot line's part can be split
    repeated = stored(seen.groupBy("key").agg(F.min(doc).alias("least"), F.max(doc).alias("most"))
                      .where(F.col("least") != F.col("most")).select("key", "least"))
    losses = (seen.join(repeated, "key").where(doc != F.col("least"))
              .groupBy("doc_id").agg(F.collect_set("key").alias("lost")))

    def finish(text: bytes | None, lost: set[bytes]) -> tuple[str, int, int]:
        lines, keys = keys_of(text, min_chars)
        kept = [line for line, k in zip(lines, keys) if k is None or not lost or _digest(k) not in lost]
        return b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)

    def result(batch: pa.RecordBatch, rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
        text, lines, dropped = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(text, pa.string()), pa.array(lines, pa.int64()),
             pa.array(dropped, pa.int64()), batch.column("rest")],
            ["doc_id", "text", "n_lines", "n_dropped", "rest"])

    def split(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            probe = Probe(segments, filter_.value)
            for batch in slices(batches):
                values = as_bytes(batch.column("text"))
                mine = [any(probe.suspects(keys_of(t, min_chars)[1])) == wanted for t in values]
                batch = batch.filter(pa.array(mine, pa.bool_()))
                if wanted:
                    yield batch
                else:
                    yield result(batch, [finish(t, set()) for t, m in zip(values, mine) if m])
        return run

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield result(batch, [finish(t, set(k or ())) for t, k in
                                 zip(as_bytes(batch.column("text")), batch.column("lost").to_pylist())])

    held = rest.schema["rest"]
    shape = (StructType().add(rest.schema["doc_id"]).add("text", "string").add("n_lines", "long")
             .add("n_dropped", "long").add(held))
    clean = rest.mapInArrow(split(False), shape)
    touched = rest.mapInArrow(split(True), rest.schema)
    losses = losses.withColumnRenamed("doc_id", "loser")
    touched = touched.join(losses, F.col("doc_id").eqNullSafe(F.col("loser")), "left").drop("loser")
    return clean.unionByName(touched.mapInArrow(apply, shape))
