"""Personal data: base patterns and bootstrapped contextual extraction.

One pass over the texts finds the base entities (email, ip, card, phone) and, besides
them, candidates: strings with the characters of an identifier that no base pattern
takes.  Each entity and candidate is an edge between an instance (its text) and a
lexical pattern (its class and the two words before it).  The base entities are the
seeds.  Spark then scores this graph in rounds.

A pattern is asked for a kind if MIN_SUPPORT distinct instances claimed by that kind stand
in it and the kind's share of trust is ACCEPT / 2 or more, where the undecided part of a
candidate and a virtual foreign instance weigh a half each.  A pattern so accepted claims
its undecided candidates, which raise its confidence in turn: the confidence is the fixed
point of trust of the kind / (trust of all kinds + undecided / 2 + 1/2), the undecided
candidates trusted as much as the pattern itself.  So many candidates beside the seeds do
not speak against a pattern by themselves, but those claimed by another kind do.  An
instance's trust is the noisy-or of its accepted patterns; all of it goes into the next
round, where it supports further patterns.  After the last round, candidates at ACCEPT or
more become spans of that kind wherever they occur; base spans stay as they are.

Only hashes and offsets of entities and candidates leave the texts, so the graph and the
final join move no text.

Defined cases: a null or empty text has no spans; repeated rows each get the same spans
and count as one instance for a pattern; null ids are processed like any other row; an
empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, slices, stored, two_columns

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_SUPPORT = 5
ACCEPT = 0.9

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMERIC = re.compile(r"(?<![0-9A-Za-z])[0-9(](?:[\x20().-]?[0-9()])++(?![0-9A-Za-z])")
AT_SIGN = re.compile(r"(?:@|\(at\)|\[at\])", re.I)
SPACES = " \t\n\r\v\f"
EDGES = ".,;:!?\"'()<>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ outwards: the part before
    it is the whole run of its characters, so a long run is read once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def small_part(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def luhn(digits: list[int]) -> bool:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), ordered."""
    spans = [(a, 0, b) for a, b in emails(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(small_part, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = [int(c) for c in m[0] if c not in " -"]
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(class, start, end) of strings that look like identifiers and touch no base span;
    class 0 is written like an address, class 1 is a number of 7 digits or more."""
    starts, ends = [], []  # the spans merged, so that each test is one bisection
    for a, b in sorted((a, b) for a, _, b in taken):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def free(a: int, b: int) -> bool:
        i = bisect_right(ends, a)
        return i == len(ends) or starts[i] >= b

    last = 0  # the end of the run of the sign before: a run is one candidate, read once
    for m in AT_SIGN.finditer(text):
        if m.start() < last:
            continue
        a, b = m.start(), m.end()
        while a > last and text[a - 1] not in SPACES:
            a -= 1
        while b < len(text) and text[b] not in SPACES:
            b += 1
        last = b
        while a < m.start() and text[a] in EDGES:
            a += 1
        while b > m.end() and text[b - 1] in EDGES:
            b -= 1
        if a < m.start() and b > m.end() and free(a, b):
            yield 0, a, b
    for m in NUMERIC.finditer(text):
        if sum(c.isdigit() for c in m[0]) >= 7 and free(m.start(), m.end()):
            yield 1, m.start(), m.end()


def context(text: str, start: int) -> str:
    """The two words before a place, lower case, without outer punctuation."""
    before = text[max(0, start - 80):start].split()[-2:]
    return " ".join(w.strip(EDGES).lower() for w in before)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_EDGE = "struct<class:int,kind:int,context:bigint,instance:bigint,s:int,e:int>"
_EDGE_ARROW = pa.struct([("class", pa.int32()), ("kind", pa.int32()), ("context", pa.int64()),
                         ("instance", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])


def _h(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row_key, doc_id, counts by kind, base_sha256, and the edges
    of the graph (kind -1: candidate)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, shas, edges = [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                spans = base_spans(text)
                counts.append([sum(k == i for _, k, _ in spans) for i in range(len(KINDS))])
                shas.append(hashlib.sha256(joined(spans).encode()).hexdigest())
                found = [(min(k, 1), k, a, b) for a, k, b in spans]
                found += [(c, -1, a, b) for c, a, b in candidates(text, spans)]
                edges.append([{"class": c, "kind": k, "context": _h(context(text, a)),
                               "instance": _h(text[a:b].lower()), "s": a, "e": b} for c, k, a, b in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("doc_id"),
                 *(pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))),
                 pa.array(shas, pa.string()), pa.array(edges, pa.list_(_EDGE_ARROW))],
                ["row_key", "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "edges"])

    rows = two_columns(docs, id_col, text_col)
    rows = rows.select(row_key("doc_id", "text").alias("row_key"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_key long, doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
                           + f", base_sha256 string, edges array<{_EDGE}>")


def bootstrap(edges: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
              accept: float = ACCEPT) -> DataFrame:
    """(class, instance, kind) of the candidates that the graph of ``edges`` (class, kind,
    context, instance) identifies.  A pattern with fewer than ``min_support`` instances can
    never be accepted, so only the others stay in the graph."""
    graph = edges.groupBy("class", "context", "instance").agg(F.max("kind").alias("seed"))
    open_ = F.sum((F.col("seed") < 0).cast("int"))
    wide = (graph.groupBy("class", "context").agg(F.count("*").alias("n"), open_.alias("open"))
            .where((F.col("n") >= min_support) & (F.col("open") > 0)).drop("open"))
    graph = stored(graph.join(wide, ["class", "context"]))
    seeds = (graph.where("seed >= 0").select("class", "instance", F.col("seed").alias("kind"))
             .distinct().withColumn("trust", F.lit(1.0)))
    trusted, found = seeds, None
    for _ in range(rounds):
        claims = trusted.groupBy("class", "instance").agg(*(
            F.coalesce(F.max(F.when(F.col("kind") == k, F.col("trust"))), F.lit(0.0)).alias(f"t{k}")
            for k in range(len(KINDS))))
        total = sum((F.col(f"t{k}") for k in range(len(KINDS))), F.lit(0.0))
        sums = graph.join(claims, ["class", "instance"]).groupBy("class", "context", "n").agg(
            F.sum(F.least(total, F.lit(1.0))).alias("claimed"),
            F.array(*(F.struct(F.lit(k).alias("kind"), F.sum(f"t{k}").alias("own"),
                               F.sum((F.col(f"t{k}") > 0).cast("int")).alias("support"))
                      for k in range(len(KINDS)))).alias("kinds"))
        own, undecided = F.col("own"), F.greatest(F.col("n") - F.col("claimed"), F.lit(0.0))
        most = F.greatest(F.col("claimed"), own) + 0.5  # trust of all kinds, with the virtual one
        half = most - undecided / 2
        patterns = (sums.select("class", "context", "n", "claimed", F.inline("kinds"))
                    .where((F.col("support") >= min_support) & (own / (most + undecided / 2) >= accept / 2))
                    .withColumn("confidence", 2 * own / (half + F.sqrt(half * half + 2 * undecided * own))))
        found = (graph.where("seed < 0").join(patterns.select("class", "context", "kind", "confidence"),
                                              ["class", "context"])
                 .groupBy("class", "instance", "kind")
                 .agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))))).alias("trust")))
        found = stored(found)
        trusted = seeds.unionByName(found)
    best = found.where(F.col("trust") >= accept).groupBy("class", "instance").agg(
        F.max_by("kind", F.struct("trust", -F.col("kind"))).alias("kind"))
    return best


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
                       accept: float = ACCEPT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end of the
    base and the discovered spans), n_found (the discovered ones)."""
    rows = stored(scan(docs, id_col, text_col))
    edges = rows.select("row_key", F.explode("edges").alias("edge")).select("row_key", "edge.*")
    known = bootstrap(edges.drop("row_key"), rounds, min_support, accept)
    extra = (edges.where("kind < 0").drop("kind").join(known, ["class", "instance"])
             .groupBy("row_key").agg(F.collect_set(F.struct("s", "kind", "e")).alias("extra")))
    base = F.transform(F.filter("edges", lambda x: x["kind"] >= 0),
                       lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e")))
    both = F.array_sort(F.when(F.col("extra").isNull(), base).otherwise(F.concat(base, F.col("extra"))))
    names = F.array(*map(F.lit, KINDS))
    text = F.array_join(F.transform(both, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")
    return rows.join(extra, "row_key", "left").select(
        "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", text.alias("spans"),
        F.coalesce(F.size("extra"), F.lit(0)).cast("long").alias("n_found"))
