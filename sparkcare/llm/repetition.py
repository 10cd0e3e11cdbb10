"""Quality rules from suffix arrays (longest-common-prefix intervals).

Each text's words get a suffix array by prefix doubling; the rank tables of the
doublings also give the common prefix of neighbouring suffixes.  A position whose
longest common prefix with either neighbour is at least ``min_repeat`` words starts an
occurrence of a maximal repeated substring; the union of these spans is the repeated
part.  The method rejects a text whose repeated part covers more than ``max_covered``
percent of its words, or whose longest repeat is both longer than ``longest_words`` and
more than ``longest_percent`` percent of its words, or longer than ``longest_ever`` words
whatever its share.  The base rule rejects texts of
fewer than ``min_words`` words and those with more than 30 percent of their words in
repeated 8-word windows (the union of the repeats of 8 words or more).

Defined cases: a null or empty text has no words and fails the base rule; a text with
fewer words than a window has no repeats; repeated rows and null ids are judged like
any other row; an empty table gives an empty result; other columns pass through
(``judge``) or are not read (``quality_table``) whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_bytes, slices, small_batches, two_columns, word_hashes

WINDOW = 8
SYMBOLS = re.compile(rb"[#*$%&|<>]")
SPACES = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class Limits:
    min_words: int = 20
    base_repeat_percent: int = 30
    min_repeat: int = 13
    max_covered: int = 25
    longest_words: int = 50
    longest_percent: int = 10
    longest_ever: int = 500


def ranks(keys: np.ndarray) -> list[np.ndarray]:
    """Rank tables of the prefix doubling: table j orders the suffixes by their first
    2**j words (a shorter suffix first).  The last one holds no ties."""
    n = len(keys)
    rank = np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1
    tables, width, top = [rank], 1, int(rank.max(initial=0))
    while top < n:
        pair = rank * (n + 1)
        if width < n:
            pair[:-width] += rank[width:]
        order = np.argsort(pair, kind="stable")
        steps = np.empty(n, np.int64)
        steps[0] = 1
        ordered = pair[order]
        steps[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(steps)
        tables.append(rank)
        width, top = width * 2, int(rank.max())
    return tables


def repeat_lengths(keys: np.ndarray, least: int) -> np.ndarray:
    """For each position the length of the longest substring that starts there and
    occurs elsewhere too; 0 where that is under ``least``."""
    n = len(keys)
    found = np.zeros(n, np.int64)
    if n <= least:
        return found
    tables = ranks(keys)
    if 1 << (len(tables) - 1) <= least:  # no ties left: every common prefix is shorter
        return found
    suffixes = np.empty(n, np.int64)
    suffixes[tables[-1] - 1] = np.arange(n)
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for j in range(len(tables) - 1, -1, -1):
        table, width = tables[j], 1 << j
        room = np.flatnonzero((a + width <= n) & (b + width <= n))
        same = room[table[a[room]] == table[b[room]]]
        common[same] += width
        a[same] += width
        b[same] += width
        inside = (a < n) & (b < n)
        if not inside.all():
            a, b = np.where(inside, a, n), np.where(inside, b, n)
    common[common < least] = 0
    found[suffixes[:-1]] = common
    found[suffixes[1:]] = np.maximum(found[suffixes[1:]], common)
    return found


def covered(lengths: np.ndarray, least: int) -> int:
    """Words in the union of the spans [p, p + lengths[p]) of at least ``least`` words."""
    starts = np.flatnonzero(lengths >= least)
    if not len(starts):
        return 0
    edges = np.zeros(len(lengths) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths[starts], -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measure(text: bytes, limits: Limits) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, longest,
    base_failed, kept."""
    words = text.split()
    n = len(words)
    chars = len(text.decode()) - len(SPACES.findall(text))
    symbols = len(SYMBOLS.findall(text))
    lines = [line for line in text.split(b"\n") if line.strip()]
    lengths = repeat_lengths(word_hashes(words), min(WINDOW, limits.min_repeat))
    in_windows, in_repeats = covered(lengths, WINDOW), covered(lengths, limits.min_repeat)
    longest = int(lengths.max(initial=0))
    base_failed = n < limits.min_words or 100 * in_windows > limits.base_repeat_percent * n
    fails = 100 * in_repeats > limits.max_covered * n or (
        longest > limits.longest_words and 100 * longest > limits.longest_percent * n) or (
        longest > limits.longest_ever)
    return (n, chars, symbols, len(lines) - len(set(lines)), in_windows, in_repeats, longest,
            base_failed, not (base_failed or fails))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_covered_words", "longest_repeat", "base_failed", "kept")
KINDS = [pa.int64()] * 7 + [pa.bool_()] * 2


def quality_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  limits: Limits = Limits()) -> DataFrame:
    """One row per document: doc_id, the measures, base_failed and the verdict kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = zip(*(measure(t or b"", limits) for t in as_bytes(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(rows, KINDS))],
                ["doc_id", *NAMES])

    rows = two_columns(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(
        f"{n} {'boolean' if k == pa.bool_() else 'long'}" for n, k in zip(NAMES, KINDS)))


def keep_good(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows whose text passes, all columns as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            keep = [measure(t or b"", limits)[-1] for t in as_bytes(batch.column(text_col))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
