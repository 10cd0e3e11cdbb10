"""WARC archives: write records, read them back by boundary-chain verification.

Writing: the text sink puts the end mark between records, so every part file is an
archive of whole records and no executor opens a file itself.  Plain archives can be split by
a reader; gzip ones are one gzip member a file and one split each.  Of records with equal
payloads of MIN_SHARED bytes or more the one with the smallest page id holds the payload
and the others are revisits (of the identical payload) that name it.

Reading: versions 1.0 and 1.1.  Spark splits the archives at every start of a magic line, also at
one that only stands inside a payload.  Each task numbers the pieces of its split and takes each as a
candidate record whose header names its successor: offset + header + declared length +
end mark.  The piece lengths give each split its place in the file, so candidates and
successors get file offsets.  Inside a split the tasks follow the links themselves (only
the exit of each candidate from its split is kept); pointer jumping over these exits
from the start of each file, in as many rounds as the logarithm of the splits of a file,
finds where the chain of true records enters each split.  Candidates off the chain are
text of a payload.  A record that lies in one piece is complete there.  A piece of another one
belongs to the last record on the chain before it, found inside its split or in the one row
that the splits before it hand over; those pieces are fetched and joined by their offsets.

Defined cases: a null payload is empty, and empty or short payloads are responses; rows
that share a page id are each written (the first of equal payloads is decided by page
id, so equal ids with equal payloads are all responses); a null page id sorts last and
is read back as null; a null URL is written as an empty one, white space and % in a URL
as percent codes; other columns are not written; an empty table gives no records; a file
with bytes but without a record raises ValueError.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import small_batches, stored

MAGIC = "WARC/1.1\r\n"
START, VERSIONS = "WARC/1.", (b"0\r\n", b"1\r\n")  # archives are split at START
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
END = "\r\n\r\n"
MIN_SHARED = 100
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def assign_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 payload_col: str = "html", min_shared: int = MIN_SHARED) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    payload = F.coalesce(pages[payload_col].cast("string"), F.lit(""))
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), payload.alias("payload"))
    rows = (rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("payload_digest", F.sha2(F.col("payload").cast("binary"), 256)))
    shared = (rows.where(F.col("payload_bytes") >= min_shared)
              .groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("payload_digest", "first"))
    rows = rows.join(stored(shared), "payload_digest", "left")
    later = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first")))
    return rows.select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                       F.when(later, "revisit").otherwise("response").alias("record_type"),
                       F.when(later, F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, path: str, compression: str = "gzip",
                   written: dt.datetime | None = None) -> None:
    """One archive per partition of ``records`` (as from ``assign_types``) under ``path``;
    ``written`` is the records' date (UTC; now if not given)."""
    date = (written or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    for mark in ("%", " ", "\t", "\n", "\x0b", "\x0c", "\r"):
        url = F.replace(url, F.lit(mark), F.lit(f"%{ord(mark):02X}"))

    def header(name: str, value) -> F.Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")

    full = F.col("record_type") == "response"
    text = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.col("record_type"), F.lit("\r\n"),
        header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        F.lit(f"WARC-Date: {date}\r\n"), header("WARC-Target-URI", url),
        header("WARC-Profile", F.when(~full, F.lit(PROFILE))),
        header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.lit("Content-Length: "), F.when(full, F.col("payload_bytes")).otherwise(0).cast("string"),
        F.lit(END), F.when(full, F.col("payload")).otherwise(""))
    (records.select(text.alias("value")).write.option("lineSep", END).option("compression", compression)
     .mode("errorifexists").text(path))


# ---------------------------------------------------------------------- reading


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block (start of the split), value: the bytes between starts of magic lines, in file
    order inside a split."""
    return (spark.read.option("lineSep", START).text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary")))


def parse_header(value: bytes) -> tuple[int, dict[str, str]] | None:
    """(length of the header behind START with its empty line, fields), or None if it isn't one."""
    end = value.find(END.encode())
    if end < 0 or value[:3] not in VERSIONS:
        return None
    fields = {}
    for line in value[3:end].split(b"\r\n"):
        name, colon, content = line.partition(b":")
        if not colon or b" " in name:
            return None
        fields[name.decode("latin-1").lower()] = content.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 19):
        return None
    return end + len(END), fields


def page_of(uri: str) -> str | None:
    return uri[len("<urn:page:"):-1] if uri.startswith("<urn:page:") and uri.endswith(">") else None


_CANDIDATE = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("at", pa.int64()),
    ("size", pa.int64()), ("head", pa.int64()), ("length", pa.int64()), ("whole", pa.bool_()),
    ("page", pa.string()), ("record_type", pa.string()), ("refers", pa.string()),
    ("declared_digest", pa.string()), ("declared_bytes", pa.int64()), ("digest", pa.string())])


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece: its number and place in the split, its size, and, if its start
    reads as a header, the record it would be.  ``whole``: the payload and the end mark
    fill the piece exactly, and ``digest`` is the payload's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seq, place = None, 0, 0
        for batch in batches:
            out = []
            for file, block, value in zip(*(c.to_pylist() for c in batch.columns)):
                if split != (file, block):
                    split, seq, place = (file, block), 0, 0
                first = seq == 0 and block == 0  # what precedes the first magic line of a file
                row = dict.fromkeys(_CANDIDATE.names)
                row |= {"file": file, "block": block, "seq": seq, "at": place,
                        "size": len(value) + (0 if first else len(START)), "whole": False}
                parsed = None if first else parse_header(value)
                if parsed:
                    head, fields = parsed
                    length = int(fields["content-length"])
                    row |= {"head": head, "length": length, "page": page_of(fields.get("warc-record-id", "")),
                            "record_type": fields.get("warc-type"),
                            "refers": page_of(fields.get("warc-refers-to", "")),
                            "declared_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:"),
                            "declared_bytes": int(n) if (n := fields.get("x-payload-length", "")).isdigit() else None,
                            "whole": len(value) == head + length + len(END)}
                    if row["whole"]:
                        row["digest"] = hashlib.sha256(value[head:head + length]).hexdigest()
                out.append(row)
                seq, place = seq + 1, place + row["size"]
            yield pa.RecordBatch.from_pylist(out, _CANDIDATE)

    kinds = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean"}
    small_batches(spark)
    return pieces(spark, path).mapInArrow(run, ", ".join(f"{f.name} {kinds[f.type]}" for f in _CANDIDATE))


def located(found: DataFrame) -> DataFrame:
    """Candidates with ``offset`` in the file and ``successor``.  A split's base is the sum
    of the sizes before it: one small row per split."""
    sizes = found.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    offset = F.col("base") + F.col("at")
    found = found.where("block > 0 or seq > 0")  # without the text before the first magic line
    return found.join(base, ["file", "block"]).withColumn("offset", offset).withColumn(
        "successor", offset + len(START) + F.col("head") + F.col("length") + len(END))


_EXIT = pa.schema([("file", pa.string()), ("block", pa.int64()), ("offset", pa.int64()), ("exit", pa.int64())])


def follow(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """Where the chain from each candidate leaves this split (-1: at something that is no
    candidate), by doubling the links."""
    at = np.searchsorted(offsets, successors)
    inside = (at < len(offsets)) & (offsets[np.minimum(at, len(offsets) - 1)] == successors)
    link = np.where(inside, at, np.arange(len(offsets)))
    while True:
        further = link[link]
        if (further == link).all():
            break
        link = further
    leaves = successors[link]
    return np.where((leaves <= offsets[-1]) & (leaves >= 0), -1, leaves)


def chain(records: DataFrame) -> DataFrame:
    """(file, offset) of the records on the chain from the start of each file."""
    links = records.where("length is not null").select("file", "block", "offset", "successor")

    def exits(group: pa.Table) -> pa.Table:
        group = group.sort_by("offset")
        offsets, successors = (group.column(n).to_numpy() for n in ("offset", "successor"))
        return pa.table([group.column("file"), group.column("block"), group.column("offset"),
                         pa.array(follow(offsets, successors))], schema=_EXIT)

    spans = records.groupBy("file", "block").agg(F.min("offset").alias("lo"))
    most = spans.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    # the chain starts at the first magic line, after the (empty) text before it
    entries = stored(records.groupBy("file").agg(F.min("offset").alias("offset")))
    if most > 1:
        jump = stored(links.groupBy("file", "block").applyInArrow(
            exits, "file string, block long, offset long, exit long").select("file", "offset", "exit"))
        reach = 1
        while reach <= most:  # after k rounds the entries of 2**k splits are known
            entries = stored(entries.union(
                entries.join(jump, ["file", "offset"]).select("file", F.col("exit").alias("offset"))).distinct())
            reach *= 2
            if reach <= most:
                onward = jump.select("file", F.col("offset").alias("exit"), F.col("exit").alias("next"))
                jump = stored(jump.join(onward, ["file", "exit"], "left")
                              .select("file", "offset", F.coalesce("next", "exit").alias("exit")))

    def walk(key, group: pa.Table, ins: pa.Table) -> pa.Table:
        group = group.sort_by("offset")
        offsets, successors = (group.column(n).to_numpy() for n in ("offset", "successor"))
        on = np.zeros(len(offsets), bool)
        for start in sorted(ins.column("offset").to_pylist()):
            while True:
                at = int(np.searchsorted(offsets, start)) if len(offsets) else 0
                if at >= len(offsets) or offsets[at] != start or on[at]:
                    break
                on[at], start = True, int(successors[at])
        keep = group.filter(pa.array(on))
        return pa.table([keep.column("file"), keep.column("offset")], names=["file", "offset"])

    entered = stored(entries.join(records.select("file", "block", "offset"), ["file", "offset"]))
    return links.groupBy("file", "block").cogroup(entered.groupBy("file", "block")).applyInArrow(
        walk, "file string, offset long")


def assembled(spark: SparkSession, path: str, records: DataFrame, true: DataFrame) -> DataFrame:
    """file, offset, digest of the ``true`` records whose payload lies in several pieces; only
    their pieces are read again and moved."""
    record = F.struct("offset", "successor", "head", "length", "whole")
    marked = records.select("file", "block", "seq", "offset").join(
        true.select("file", F.col("offset"), record.alias("record")), ["file", "offset"], "left")
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    handed = marked.groupBy("file", "block").agg(F.max_by("record", F.when(F.col("record").isNotNull(), F.col("seq"))).alias("last"))
    handed = handed.select("file", "block", F.last("last", ignorenulls=True).over(earlier).alias("handed"))  # a row a split
    owned = (marked.withColumn("own", F.last("record", ignorenulls=True).over(inside)).join(handed, ["file", "block"])
             .withColumn("own", F.coalesce("own", "handed")))
    needed = stored(owned.where(~F.col("own.whole") & (F.col("offset") < F.col("own.successor"))).select(
        "file", "block", "seq", "offset", F.col("own.offset").alias("record"), "own.head", "own.length"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seq = None, 0
        for batch in batches:
            numbers = []
            for key in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
                seq = seq + 1 if key == place else 0
                place = key
                numbers.append(seq)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())],
                                             [*batch.schema.names, "seq"])

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by("offset")
        whole = START.encode().join(group.column("value").to_pylist())
        head, length = group.column("head")[0].as_py(), group.column("length")[0].as_py()
        digest = hashlib.sha256(whole[head:head + length]).hexdigest()
        return pa.table([group.column("file").slice(0, 1), group.column("record").slice(0, 1),
                         pa.array([digest])], names=["file", "offset", "digest"])

    numbered = pieces(spark, path).mapInArrow(number, "file string, block long, value binary, seq long")
    return (numbered.join(needed, ["file", "block", "seq"]).groupBy("file", "record")
            .applyInArrow(join, "file string, offset long, digest string"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The true records under ``path``: file, offset, page (id as text), payload_bytes,
    payload_digest (computed from the payload where the record holds it), record_type,
    refers (id as text), declared_digest."""
    found = stored(candidates(spark, path))
    records = stored(located(found))
    true = stored(records.join(chain(records), ["file", "offset"]))
    silent = (found.groupBy("file").agg(F.sum("size").alias("size")).where("size > 0")
              .join(true.select("file").distinct(), "file", "left_anti").select("file").first())
    if silent:
        raise ValueError(f"no record is found in {silent[0]}")
    if not true.where("not whole").isEmpty():
        joined = assembled(spark, path, records, true).withColumnRenamed("digest", "joined")
        true = true.join(joined, ["file", "offset"], "left")
    else:
        true = true.withColumn("joined", F.lit(None).cast("string"))
    full = F.col("record_type") == "response"
    return true.select(
        "file", "offset", "page", F.when(full, F.col("length")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(full, F.coalesce("joined", "digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type", F.when(~full, F.col("refers")).alias("refers"), "declared_digest")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               compression: str = "none", min_shared: int = MIN_SHARED) -> DataFrame:
    """Write an archive of ``pages`` under the shared folder and read it back: page_id,
    payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    write_archives(assign_types(pages, id_col, url_col, payload_col, min_shared), path, compression)
    kind = pages.schema[id_col].dataType
    return read_archives(spark, path).select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers").cast(kind).alias("refers_to"))
