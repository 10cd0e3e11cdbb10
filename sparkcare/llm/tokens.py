"""Token counts of whole documents (overlap resynchronisation).

A text of at most ``chunk_chars`` is encoded word by word: white space is a boundary
no token of the vocabularies used crosses, so equal words have equal counts and the
library is asked once per word and worker (the memory of counts is bounded by
MEMO_WORDS and starts anew when full).  ASCII punctuation at the ends of a word is counted apart
where the vocabulary's own splitter cuts between the two characters, and many words are asked
for in one text, each followed by a mark that is a token of its own; a text with other marks is
asked for word by word.  A longer text is encoded in chunks that overlap, with offsets, so that memory is bounded by the chunk and not by
the text.  Two neighbouring chunks are spliced at a place of their overlap that both
encodings prove: it follows white space, which no token and no added token of the
vocabularies used crosses, and from there to the end of the overlap both chunks hold
the same tokens at the same offsets (the last ones before the left chunk's cut aside).
Where no such place exists (no white space, or the encodings disagree) the overlap is
doubled, at worst up to the rest of the text, so the count is always the library's.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows and null
ids are counted like any other row; only id and text are read, so other columns and
their names don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, slices, two_columns

VOCABULARY = "word_bpe_49k.json"
SPACE = frozenset(" \t\n\r")
AGREE = 8
MEMO_WORDS = 1_000_000
MARK = b"\x01"
JOINED = 32
OUTER = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'  # no apostrophe: it may belong to the letters behind it


def vocabulary_path(name: str) -> str:
    """A file path as given, else the place of a file of the installed vocabularies."""
    if os.path.exists(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(name: str):
    """A ``tokenizers`` tokenizer without truncation and padding, once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocabulary_path(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


@lru_cache(maxsize=4)
def memo(name: str) -> dict[bytes, int]:
    return {}


@lru_cache(maxsize=4)
def added(tok) -> tuple[bytes, ...]:
    """Texts of the added tokens, which the library finds before it splits anything."""
    return tuple(t.content.encode() for t in tok.get_added_tokens_decoder().values())


@lru_cache(maxsize=65_536)
def cut(tok, left: str, right: str) -> bool:
    """Whether the splitter cuts between a mark of punctuation and another character."""
    if tok.pre_tokenizer is None:
        return False
    text = tok.normalizer.normalize_str(left + right) if tok.normalizer else left + right
    parts = [p for p, _ in tok.pre_tokenizer.pre_tokenize_str(text)]
    return len(parts) > 1 and (parts[0] == left or parts[-1] == right)


def pieces(tok, word: bytes) -> list[bytes]:
    """The word, or its punctuation before, its core and its punctuation behind."""
    core = word.strip(OUTER)
    if not core or len(core) == len(word) or any(a in word for a in added(tok)):
        return [word]
    at = word.index(core)
    before, behind, chars = word[:at], word[at + len(core):], core.decode()
    if before and not cut(tok, chr(before[-1]), chars[0]) or behind and not cut(tok, chars[-1], chr(behind[0])):
        return [word]
    return [p for p in (before, core, behind) if p]


def count_words(tok, words: list[bytes]) -> list[int]:
    """Tokens of each word, JOINED of them in a text."""
    batch = getattr(tok, "encode_batch_fast", tok.encode_batch)
    encode = lambda texts: batch([t.decode() for t in texts], add_special_tokens=False)
    (alone,) = encode([MARK])
    mark = alone.ids[0] if len(alone) == 1 else -1
    counts = []
    for at in range(0, len(words), 4096):
        groups = [words[i:i + JOINED] for i in range(at, min(at + 4096, len(words)), JOINED)]
        for group, found in zip(groups, encode([b" ".join([x for w in g for x in (w, MARK)]) for g in groups])):
            ends = np.flatnonzero(np.array(found.ids) == mark)
            if len(ends) == len(group):
                counts += (np.diff(ends, prepend=-1) - 1).tolist()
            else:  # a word holds the mark itself, or the vocabulary has none
                counts += map(len, encode(group))
    return counts


def count_short(tok, known: dict[bytes, int], texts: list[bytes]) -> list[int]:
    """Tokens of each text, with words and pieces not seen before encoded in one call."""
    if len(known) > MEMO_WORDS:
        known.clear()
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
    words = lists.values.dictionary_encode()  # an empty one, at an end of a text, has no tokens
    distinct = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    new = set(distinct).difference(known)
    split = {w: parts for w in new if len(parts := pieces(tok, w)) > 1}
    ask = list(new.difference(split).union(*split.values()).difference(known))
    known.update(zip(ask, count_words(tok, ask)))
    known.update((w, sum(map(known.__getitem__, parts))) for w, parts in split.items())
    counts = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
    upto = np.concatenate([[0], np.cumsum(counts[words.indices.to_numpy()])])
    return np.diff(upto[lists.offsets.to_numpy()]).tolist()


def splice(text: str, left, lo: int, right, start: int, hi: int) -> int | None:
    """The place where two encodings may be joined, or None.

    ``left`` encodes text[lo:hi], ``right`` encodes text from ``start`` on.  Tokens are
    compared from each boundary that follows white space; the last AGREE tokens of
    ``left`` may have been changed by its cut and count as neither."""
    mine = [(i, a + lo, b + lo) for i, (a, b) in zip(left.ids, left.offsets) if a + lo >= start]
    theirs = [(i, a + start, b + start) for i, (a, b) in zip(right.ids, right.offsets) if a + start < hi]
    mine, known = mine[:-AGREE] if hi < len(text) else mine, set(theirs)
    place, same = None, 0
    for token in reversed(mine):
        if token not in known:
            break
        same += 1
        at = token[1]
        if same >= AGREE and at > start and text[at - 1] in SPACE:
            place = at
    return place


def count_long(tok, text: str, chunk: int, overlap: int) -> int:
    total, lo = 0, 0
    hi = min(len(text), lo + chunk)
    left = tok.encode(text[lo:hi], add_special_tokens=False)
    counted_from = 0
    while hi < len(text):
        width = overlap
        while True:
            start = max(lo, hi - width)
            end = min(len(text), hi + chunk)
            right = tok.encode(text[start:end], add_special_tokens=False)
            at = splice(text, left, lo, right, start, hi)
            if at is not None and at >= counted_from:
                break
            if start == lo:  # no proven place in the whole left chunk: widen to the right
                hi = min(len(text), hi + max(chunk, hi - lo))
                left = tok.encode(text[lo:hi], add_special_tokens=False)
                if hi == len(text):
                    right = None
                    break
            else:
                width *= 2
        if right is None:
            break
        total += sum(counted_from <= a + lo < at for a, _ in left.offsets)
        counted_from, lo, hi, left = at, start, end, right
    return total + sum(a + lo >= counted_from for a, _ in left.offsets)


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, chunk_chars: int = 65_536, overlap_chars: int = 1_024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``), n_chars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, known = load(vocabulary), memo(vocabulary)
        for batch in slices(batches):
            texts = [t or b"" for t in as_bytes(batch.column("text"))]
            chars = [len(t.decode()) for t in texts]
            short = [i for i, n in enumerate(chars) if n <= chunk_chars]
            counts = dict(zip(short, count_short(tok, known, [texts[i] for i in short])))
            for i, n in enumerate(chars):
                if n > chunk_chars:
                    counts[i] = count_long(tok, texts[i].decode(), chunk_chars, overlap_chars)
            counts = [counts[i] for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64()),
                 pa.array([c > limit for c in counts]), pa.array(chars, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chars"])

    rows = two_columns(docs, id_col, text_col).withColumn(
        "n_bytes", F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, n_chars long")
