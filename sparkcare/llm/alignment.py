"""Cross-tokenizer alignment with external spill counting.

Both tokenizers encode every whole text; byte offsets where tokens of both end cut them into
groups, and every A token of a group is linked with every B token of it.

Encoding: a single space between two characters that are no white space is a boundary for both
tokenizers (checked for the pieces of B when they are loaded; a vocabulary that fails is
asked for whole texts), so a text is a sequence of segments, equal segments align alike, and each
is encoded once per worker while a memo of MEMO segments (MEMO_PAIRS pairs, MEMO_CHARS) holds it.  A
full memo keeps the half used most, and it outlives the task.

Counting: a task turns its documents into pair-document records and, whenever it holds SPILL of
them, partitions them by the radix of their A id, sorts each part by (A, B, document) and
spills it as a run: a zstd head (pairs and how many documents hold them) and a zstd body
(documents and links).  Runs go to a written table, never to a local folder.  The heads of a radix
part meet in a k-way heap merge with the A id as key, FAN of them at a time and in further
rounds while several are left; a merged head is in A-major order, so the highest count of an A id
is known as soon as its last pair has come.  Then each body streams past the merged head of
its part and sends every document its links' counts back; bodies of one part are dealt
out over as many tasks as their bytes ask for, so a token that stands in every document
is not bound to one task, and no pair-document record is shuffled by itself.

Defined cases: null and empty texts, and texts whose tokens don't give back their bytes, have
no tokens: zeros and an empty ``groups_sha256``; rows are counted as documents one by one,
repeated rows, null and repeated ids included; only id and text are read, so other columns and
their names don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, two_columns
from .tokens import vocabulary_path

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
MEMO, MEMO_PAIRS, MEMO_CHARS = 600_000, 6_000_000, 32_000_000
JOINED = 1 << 15
TROUBLE = re.compile(r"\A\s|\s\Z| \s|\s ")  # a blank next to white space or at an end
SPILL = 1 << 20
RADIX = 64
FAN = 64
GROUP_BYTES = 32 << 20
IDS = 1 << 16  # ids are below, so that a pair is a 32-bit key
SHIFT = np.uint64(32)
LOW = np.uint64(0xFFFFFFFF)


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    characters of Latin-1 are themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, a_name: str, b_name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(vocabulary_path(a_name))
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        byte = byte_of_char()
        self.a_bytes = [b""] * (1 + max(self.a.get_vocab().values()))
        for piece, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(b_name))
        self.b_bytes, self.cut = [], True
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
            self.cut &= "▁" not in piece.lstrip("▁")
        if max(len(self.a_bytes), len(self.b_bytes)) > IDS:
            raise ValueError(f"a vocabulary has more than {IDS} ids")
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_table, self.b_table = pa.array(self.a_bytes, pa.large_binary()), pa.array(self.b_bytes, pa.large_binary())

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        first = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return list(zip(first, self.b.encode(texts, num_threads=1)))

    def ends_at(self, a: np.ndarray, b: np.ndarray, sizes: list[int], text: str) -> bool:
        """Whether both give back the bytes of ``text``, with tokens that end after each size."""
        want, ends = pa.py_buffer(text.encode()), np.cumsum(sizes)
        for ids, table, length in ((a, self.a_table, self.a_length), (b, self.b_table, self.b_length)):
            stops = np.cumsum(length[ids])
            if not len(ids) or stops[-1] != want.size or not taken(table, ids)[0].equals(want):
                return False
            if (stops[np.searchsorted(stops, ends)] != ends).any():
                return False
        return True


def taken(table: pa.LargeBinaryArray, at: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """The entries at ``at`` one after the other, and where each begins and the last ends."""
    found = table.take(pa.array(at))
    ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset:][:len(at) + 1]
    return found.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])), ends - ends[0]


@lru_cache(maxsize=2)
def load(a_name: str, b_name: str) -> Pair:
    return Pair(a_name, b_name)


def plain(part: str) -> bool:
    """A part of a text without TROUBLE at it and without the character that B writes for a space."""
    return part != "" and part.strip() == part and "▁" not in part


def segments(text: str) -> tuple[list[str], bool]:
    """Parts of ``text`` whose encodings, each as a text of its own, follow one another, and
    whether the parts of this and other such texts may be encoded end to end in any order."""
    if "▁" in text:  # the character that B writes for a space
        return [text], False
    parts = text.split(" ")
    if not TROUBLE.search(text):
        return parts, True
    out = [parts[0]]
    for p in parts[1:]:
        if out[-1] and p and not (out[-1][-1].isspace() or p[0].isspace()):
            out.append(p)
        else:
            out[-1] += " " + p
    return out, False


class Column:
    """An array that grows at its end."""

    def __init__(self, first: np.ndarray):
        self.room, self.size = first, len(first)

    def add(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.room):
            room = np.empty((max(end, 2 * self.size), *self.room.shape[1:]), self.room.dtype)
            room[:self.size] = self.all()
            self.room = room
        self.room[self.size:end] = more
        self.size = end

    def all(self) -> np.ndarray:
        return self.room[:self.size]


class Aligner:
    """What each segment adds to its document, in columns, for a bounded number of segments.

    ``known`` numbers the segments as they come.  ``counts`` has n_a, n_b, n_groups and n_links,
    ``used`` how often a segment was met, ``good`` whether the tokens give back its bytes, ``plain``
    whether it is a plain part.  The text of a segment's groups and its distinct pairs with their
    links end at ``stops`` and ``ends``."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.known: dict[str, int] = {}
        self.chars = 0
        self.counts, self.used = Column(np.zeros((0, 4), np.int64)), Column(np.zeros(0, np.int64))
        self.good, self.plain = Column(np.zeros(0, bool)), Column(np.zeros(0, bool))
        self.text, self.stops = Column(np.zeros(0, np.uint8)), Column(np.zeros(1, np.int64))
        self.keys, self.links, self.ends = Column(np.zeros(0, np.uint32)), Column(np.zeros(0, np.int32)), Column(np.zeros(1, np.int64))

    def pairs_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many pairs each of the segments has, and the places of them all."""
        begin = self.ends.all()[numbers]
        n = self.ends.all()[numbers + 1] - begin
        return n, np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))

    def texts_of(self, numbers: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
        """The groups of all the segments as one text, and where each segment's begin."""
        table = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.known), [None, pa.py_buffer(self.stops.all()), pa.py_buffer(self.text.all())])
        return taken(table, numbers)

    def forget(self) -> None:
        """Keep the half used most."""
        names = list(self.known)
        chars = np.fromiter(map(len, names), np.int64, len(names))
        order = np.argsort(-self.used.all(), kind="stable")[:MEMO // 2]
        fits = np.cumsum(np.diff(self.ends.all())[order]) <= MEMO_PAIRS // 2
        kept = np.sort(order[fits & (np.cumsum(chars[order]) <= MEMO_CHARS // 2)])
        n, at = self.pairs_of(kept)
        text, stops = self.texts_of(kept)
        self.known, self.chars = {names[k]: i for i, k in enumerate(kept.tolist())}, int(chars[kept].sum())
        self.counts, self.used = Column(self.counts.all()[kept]), Column(self.used.all()[kept] // 2)
        self.good, self.plain = Column(self.good.all()[kept]), Column(self.plain.all()[kept])
        self.text, self.stops = Column(np.frombuffer(text, np.uint8).copy()), Column(stops)
        self.keys, self.links = Column(self.keys.all()[at]), Column(self.links.all()[at])
        self.ends = Column(np.concatenate([[0], np.cumsum(n)]))

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The segments of all texts one after the other, by number, and where each text's begin
        and the last one's end."""
        if len(self.known) > MEMO or self.keys.size > MEMO_PAIRS or self.chars > MEMO_CHARS:
            self.forget()
        lists = pc.split_pattern(texts.fill_null(""), " ")
        parts = lists.values.dictionary_encode()
        names = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        at, bounds = parts.indices.to_numpy(), lists.offsets.to_numpy()
        number = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        odd, new = number < 0, np.flatnonzero(number < 0)
        odd[~odd] = ~self.plain.all()[number[~odd]]
        odd[new] = [not plain(names[k]) for k in new.tolist()]
        apart = np.logical_or.reduceat(odd[at], bounds[:-1]) if self.pair.cut else np.ones(len(texts), bool)
        whole, alone = [names[k] for k in new.tolist()], []
        if apart.any():
            clean = np.bincount(at[np.repeat(~apart, np.diff(bounds))], minlength=len(names))[new] > 0
            whole = [names[k] for k in new[clean].tolist()]
            seen = set(whole)
            runs, place = np.split(at, bounds[1:-1]), {p: i for i, p in enumerate(names)}
            for k in np.flatnonzero(apart).tolist():
                text = texts[k].as_py() or ""
                cut = (segments(text)[0] if self.pair.cut else [text]) if text else []
                runs[k] = np.array([place.setdefault(p, len(place)) for p in cut], np.int64)
                alone += cut
            names, at, bounds = list(place), np.concatenate(runs), np.cumsum([0, *map(len, runs)])
            alone = [p for p in dict.fromkeys(alone) if p not in seen and p not in self.known]
        self.learn(whole, alone)
        number = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))  # -1: only in a text set apart
        flat = number[at]
        self.used.all()[:] += np.bincount(flat, minlength=len(self.known))
        return flat, bounds

    def learn(self, whole: list[str], alone: list[str]) -> None:
        """Encode segments: those that follow one another like words of a text as one text, the
        others, and where that fails, one by one."""
        held, a, b = [], [], []
        lo = size = 0
        for hi, t in enumerate(whole, start=1):
            size += len(t)
            if size < JOINED and hi < len(whole):
                continue
            some = whole[lo:hi]
            (x, y), = map(_arrays, self.pair.encode([" ".join(some)]))
            if self.pair.ends_at(x, y, [len(t.encode()) + 1 for t in some], " " + " ".join(some)):
                held += some
                a.append(x)
                b.append(y)
            else:
                alone += some
            lo, size = hi, 0
        for at in range(0, len(alone), 1024):
            some = alone[at:at + 1024]
            for t, (x, y) in zip(some, map(_arrays, self.pair.encode(some))):
                if self.pair.ends_at(x, y, [len(t.encode()) + 1], " " + t):
                    held.append(t)
                    a.append(x)
                    b.append(y)
                else:
                    self.keep([t], np.zeros((1, 4), np.int64), False, np.zeros(0, np.uint8), np.zeros(1, np.int64),
                              np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(1, np.int64))
        if held:
            self.align(held, np.concatenate(a), np.concatenate(b))

    def keep(self, held: list[str], counts: np.ndarray, good: bool, text: np.ndarray, stops: np.ndarray,
             keys: np.ndarray, links: np.ndarray, n: np.ndarray) -> None:
        """Segments into the memo, with the ends of their texts in ``text`` and their numbers of pairs."""
        self.stops.add(stops + self.text.size)
        self.ends.add(np.cumsum(n) + self.keys.size)
        self.known.update(zip(held, range(len(self.known), len(self.known) + len(held))))
        self.chars += sum(map(len, held))
        for column, more in ((self.counts, counts), (self.used, np.zeros(len(held), np.int64)), (self.good, np.full(len(held), good)),
                             (self.plain, np.fromiter(map(plain, held), bool, len(held))), (self.text, text), (self.keys, keys), (self.links, links)):
            column.add(more)

    def align(self, held: list[str], a: np.ndarray, b: np.ndarray) -> None:
        """Groups and links of segments that stand end to end."""
        ends = np.cumsum([len(t.encode()) + 1 for t in held])
        a_ends, b_ends = np.cumsum(self.pair.a_length[a]), np.cumsum(self.pair.b_length[b])
        i = np.searchsorted(a_ends, b_ends)
        j = np.flatnonzero(a_ends[i] == b_ends)  # both end with the last segment
        i, both = i[j], b_ends[j]
        of_group = np.searchsorted(ends, both)
        n_a, n_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        n = n_a * n_b
        group = np.repeat(np.arange(len(both)), n)
        place = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        mine = a[(i - n_a + 1)[group] + place // n_b[group]]
        theirs = b[(j - n_b + 1)[group] + place % n_b[group]]
        pairs, links = np.unique((of_group[group].astype(np.uint64) << SHIFT) | (mine.astype(np.uint64) << np.uint64(16))
                                 | theirs.astype(np.uint64), return_counts=True)
        m = len(held)
        count = lambda weights: np.bincount(of_group, weights, m).astype(np.int64)
        text, stops = written(a, b, n_a, n_b)
        last = np.searchsorted(of_group, np.arange(m), "right") - 1  # the last group of each segment
        self.keep(held, np.stack([count(n_a), count(n_b), count(None), count(n)], axis=1), True, text, stops[last],
                  (pairs & LOW).astype(np.uint32), links, np.bincount((pairs >> SHIFT).astype(np.int64), minlength=m))

    def measures(self, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """n_a, n_b, n_groups, n_links, groups_sha256 of each text."""
        upto = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(
            np.column_stack([self.counts.all()[flat], ~self.good.all()[flat]]), axis=0)])
        sums = np.diff(upto[bounds], axis=0)
        good = (np.diff(bounds) > 0) & (sums[:, 4] == 0)
        text, begin = self.texts_of(flat)
        view, begin = memoryview(text), begin[bounds].tolist()
        return np.where(good[:, None], sums[:, :4], 0), [
            hashlib.sha256(view[lo:hi - 1]).hexdigest() if g else "" for g, lo, hi in zip(good.tolist(), begin, begin[1:])]

    def records(self, flat: np.ndarray, bounds: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, links) of all good documents, each pair of a document once."""
        doc = np.repeat(np.arange(len(good), dtype=np.uint64), np.diff(bounds))
        there = np.repeat(good, np.diff(bounds))
        both, times = np.unique((doc[there] << SHIFT) | flat[there].astype(np.uint64), return_counts=True)
        n, at = self.pairs_of((both & LOW).astype(np.int64))
        key, links = _summed((np.repeat(both >> SHIFT, n) << SHIFT) | self.keys.all()[at].astype(np.uint64),
                             self.links.all()[at] * np.repeat(times, n))
        return (key >> SHIFT).astype(np.uint32), (key & LOW).astype(np.uint32), links


def _arrays(both: tuple[list[int], list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array(both[0], np.int64), np.array(both[1], np.int64)


@lru_cache(maxsize=2)
def aligner(a_name: str, b_name: str) -> Aligner:
    """Once per worker, so that a later task finds what an earlier one has encoded."""
    return Aligner(load(a_name, b_name))


@lru_cache(maxsize=1)
def decimals(below: int) -> pa.LargeBinaryArray:
    """The digits of each number with a comma behind it, then with a bar, then with a semicolon."""
    return pa.array([b"%d%s" % (k, mark) for mark in (b",", b"|", b";") for k in range(below)], pa.large_binary())


def written(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All groups as ``a1,a2|b1;`` one after the other, and where each ends."""
    start = np.cumsum(n_a + n_b) - (n_a + n_b)
    ids = np.empty(len(a) + len(b), np.int64)
    ids[np.repeat(start - (np.cumsum(n_a) - n_a), n_a) + np.arange(len(a))] = a
    ids[np.repeat(start + n_a - (np.cumsum(n_b) - n_b), n_b) + np.arange(len(b))] = b
    ids[start + n_a - 1] += IDS
    ids[start + n_a + n_b - 1] += 2 * IDS
    text, begin = taken(decimals(IDS), ids)
    return np.frombuffer(text, np.uint8), begin[start + n_a + n_b]


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sum of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values[order], first) if len(keys) else values


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def head_of(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Pairs in A-major order (as differences) and how many documents hold each."""
    return _packed(np.array([len(keys)], np.int64), np.diff(keys, prepend=np.uint32(0)).astype(np.uint32), counts.astype(np.int64))


def read_head(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    return np.cumsum(np.frombuffer(raw, np.uint32, n, 8), dtype=np.uint32), np.frombuffer(raw, np.int64, n, 8 + 4 * n)


def body_of(doc: np.ndarray, links: np.ndarray) -> bytes:
    return _packed(np.array([len(doc)], np.int64), np.diff(doc.astype(np.int64), prepend=0).astype(np.int32), links.astype(np.int64))


def read_body(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    return np.cumsum(np.frombuffer(raw, np.int32, n, 8).astype(np.int64)), np.frombuffer(raw, np.int64, n, 8 + 4 * n)


def spill(doc: np.ndarray, key: np.ndarray, links: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(part, records, head, body) for every radix of the A id that occurs."""
    part = (key >> np.uint32(16)) % np.uint32(RADIX)
    order = np.argsort((part.astype(np.uint64) << SHIFT) | key, kind="stable")
    doc, key, links, part = doc[order], key[order], links[order], part[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(part)]):
        keys, counts = np.unique(key[lo:hi], return_counts=True)
        yield int(part[lo]), int(hi - lo), head_of(keys, counts), body_of(doc[lo:hi], links[lo:hi])


SEEN = ("doc_key long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "part int, run long, head binary, body binary")


def encode_and_spill(docs: DataFrame, a_vocabulary: str, b_vocabulary: str, spill_records: int) -> DataFrame:
    """A row per document (part null), keyed by task and place, and a row per spilled run.
    ``run`` is the key of the task's first document: the places in a body count from it."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = aligner(a_vocabulary, b_vocabulary)
        base, place, held = TaskContext.get().partitionId() << 32, 0, []
        schema = None

        def spilled() -> Iterator[pa.RecordBatch]:
            rows = list(spill(*(np.concatenate(c) for c in zip(*held))))
            held.clear()
            for at in range(0, len(rows), 16):
                some = rows[at:at + 16]
                columns = {"part": pa.array([r[0] for r in some], pa.int32()), "run": pa.array([base] * len(some), pa.int64()),
                           "head": pa.array([r[2] for r in some], pa.binary()), "body": pa.array([r[3] for r in some], pa.binary())}
                yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(some), f.type)) for f in schema], schema=schema)

        for batch in slices(batches):
            if schema is None:
                schema = pa.schema([("doc_key", pa.int64()), ("doc_id", batch.schema.field("doc_id").type)]
                                   + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                                   + [("groups_sha256", pa.string()), ("part", pa.int32()), ("run", pa.int64()),
                                      ("head", pa.binary()), ("body", pa.binary())])
            flat, bounds = memo.numbers(batch.column("text"))
            measures, digests = memo.measures(flat, bounds)
            doc, key, links = memo.records(flat, bounds, measures[:, 0] > 0)
            if len(doc):
                held.append((doc + np.uint32(place), key, links))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(base + place, base + place + n)), batch.column("doc_id")]
                + [pa.array(measures[:, i]) for i in range(4)]
                + [pa.array(digests, pa.string())]
                + [pa.nulls(n, f.type) for f in list(schema)[7:]], schema=schema)
            place += n
            if sum(len(h[0]) for h in held) >= spill_records:
                yield from spilled()
        if held:
            yield from spilled()

    return docs.mapInArrow(run, SEEN.format(kind=kind))


def merge_heads(heads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """K-way heap merge: the runs that stand at the smallest A id give their pairs of it."""
    runs = [read_head(h) for h in heads]
    if len(runs) == 1:
        return runs[0]
    ends = []  # of each A id's pairs, by run
    for keys, _ in runs:
        side = keys >> np.uint32(16)
        ends.append(np.append(np.flatnonzero(np.diff(side)) + 1, len(keys)))
    heap = [(int(keys[0] >> np.uint32(16)), r) for r, (keys, _) in enumerate(runs) if len(keys)]
    heapq.heapify(heap)
    at, step = [0] * len(runs), [0] * len(runs)
    out_keys, out_counts = [], []
    while heap:
        a, some = heap[0][0], []
        while heap and heap[0][0] == a:
            r = heap[0][1]
            lo, hi = at[r], int(ends[r][step[r]])
            some.append((r, lo, hi))
            at[r], step[r] = hi, step[r] + 1
            keys = runs[r][0]
            if hi < len(keys):
                heapq.heapreplace(heap, (int(keys[hi] >> np.uint32(16)), r))
            else:
                heapq.heappop(heap)
        keys, counts = _summed(np.concatenate([runs[r][0][lo:hi] for r, lo, hi in some]),
                               np.concatenate([runs[r][1][lo:hi] for r, lo, hi in some]))
        out_keys.append(keys)
        out_counts.append(counts)
    return np.concatenate(out_keys), np.concatenate(out_counts)


def by_group(names: tuple[str, ...], of: Callable[[tuple, Iterator[dict]], Iterator[pa.RecordBatch]]):
    """Rows of a sorted partition, one group of equal ``names`` after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                columns = batch.schema.names
                for i in range(batch.num_rows):
                    yield {c: batch.column(c)[i].as_py() for c in columns}
        for key, group in groupby(rows(), lambda r: tuple(r[n] for n in names)):
            yield from of(key, group)
    return run


def count_pairs(runs: DataFrame, fan: int) -> DataFrame:
    """(part, head): one merged head for each part."""
    def merged(key: tuple, group: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        head = head_of(*merge_heads([r["head"] for r in group]))
        yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([head], pa.binary())],
                                         ["part", "place", "head"])

    heads = runs.select("part", F.hash("run", "head").cast("long").alias("place"), "head")
    while True:
        most = heads.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return heads.select("part", "head")
        ways = -(-most // fan)
        heads = stored(heads.withColumn("place", F.pmod("place", F.lit(ways)))
                       .repartition("part", "place").sortWithinPartitions("part", "place")
                       .mapInArrow(by_group(("part", "place"), merged), "part int, place long, head binary"))


def send_back(runs: DataFrame, merged: DataFrame, group_bytes: int) -> DataFrame:
    """(doc_key, n_best, count_sum) of every body against the merged head of its part."""
    ways = runs.groupBy("part").agg(F.ceil(F.sum(F.length("head") + F.length("body")) / group_bytes).cast("int").alias("ways"))
    ways = F.broadcast(ways)  # RADIX rows
    known = (merged.join(ways, "part").withColumn("way", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
             .select("part", "way", F.lit(None).cast("long").alias("run"), "head", F.lit(None).cast("binary").alias("body")))
    bodies = runs.join(ways, "part").select("part", F.pmod(F.hash("run", "head"), F.col("ways")).alias("way"), "run", "head", "body")

    def give(key: tuple, group: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        keys = counts = best = None
        for r in group:
            if r["run"] is None:
                keys, counts = read_head(r["head"])
                side = keys >> np.uint32(16)
                first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
                highest = np.maximum.reduceat(counts, first)
                best = counts == np.repeat(highest, np.diff(np.append(first, len(keys))))
                continue
            own, held = read_head(r["head"])
            doc, links = read_body(r["body"])
            at = np.repeat(np.searchsorted(keys, own), held)
            doc, both = _summed_two(doc, links * best[at], links * counts[at])
            yield pa.RecordBatch.from_arrays([pa.array(doc + r["run"]), pa.array(both[0]), pa.array(both[1])],
                                             ["doc_key", "n_best", "count_sum"])

    return (known.unionByName(bodies).repartition("part", "way").sortWithinPartitions("part", "way", F.asc_nulls_first("run"))
            .mapInArrow(by_group(("part", "way"), give), "doc_key long, n_best long, count_sum long"))


def _summed_two(doc: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    lo = int(doc.min())
    sums = np.zeros((2, int(doc.max()) - lo + 1), np.int64)
    np.add.at(sums[0], doc - lo, x)
    np.add.at(sums[1], doc - lo, y)
    there = np.unique(doc)
    return there, (sums[0][there - lo], sums[1][there - lo])


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_vocabulary: str = A_VOCABULARY,
          b_vocabulary: str = B_VOCABULARY, spill_records: int = SPILL, fan: int = FAN,
          group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256."""
    seen = stored(encode_and_spill(two_columns(docs, id_col, text_col), a_vocabulary, b_vocabulary, spill_records))
    runs = seen.where("part is not null").select("part", "run", "head", "body")
    back = send_back(runs, count_pairs(runs, fan), group_bytes)
    back = back.groupBy("doc_key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    rows = seen.where("part is null").drop("part", "run", "head", "body")
    return rows.join(back, "doc_key", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")


def pair_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_vocabulary: str = A_VOCABULARY,
                b_vocabulary: str = B_VOCABULARY, spill_records: int = SPILL, fan: int = FAN) -> DataFrame:
    """The alignment table itself: a_id, b_id, n_docs, and whether no pair of a_id has more."""
    seen = stored(encode_and_spill(two_columns(docs, id_col, text_col), a_vocabulary, b_vocabulary, spill_records))
    merged = count_pairs(seen.where("part is not null").select("part", "run", "head"), fan)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("head").to_pylist():
                keys, counts = read_head(blob)
                side = keys >> np.uint32(16)
                first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
                best = counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(keys))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(side.astype(np.int32)), pa.array((keys & np.uint32(0xFFFF)).astype(np.int32)),
                     pa.array(counts), pa.array(best)], ["a_id", "b_id", "n_docs", "best"])

    return merged.mapInArrow(rows, "a_id int, b_id int, n_docs long, best boolean")
