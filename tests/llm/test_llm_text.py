"""Operators that work text by text: tokens, personal data, repetition, language, packing."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcare.llm import langid, packing, pii, queries, repetition, tokens

SF = "/root/testdata/sf0.001"
ODD = [(1, "", 0), (None, None, 1), (2, "one two", 2), (2, "one two", 3), (None, "x" * 5000, 4)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and repeated rows, one long word, and columns with clashing names."""
    return spark.createDataFrame(ODD, "doc_id long, text string, n_tokens long").withColumn("rest", F.lit("r")) \
        .withColumn("key", F.lit(1)).withColumn("n_words", F.lit(1)).withColumn("spans", F.lit("s"))


@pytest.mark.parametrize("chunk,overlap", [(200, 16), (50, 8)])
def test_chunked_token_counts_are_the_library_s(chunk, overlap):
    tok = tokens.load(queries.VOCABULARY)
    rnd = random.Random(1)
    texts = ["a" * 700, "<|endoftext|>" * 60, "it's 'S a b́ " * 60, ("x" * 90 + " ") * 9,
             " ".join(rnd.choice(["Über", "don't", "42", "?!", "naïve", "　"]) for _ in range(300))]
    for t in texts:
        want = len(tok.encode(t, add_special_tokens=False))
        assert tokens.count_long(tok, t, chunk, overlap) == want
        assert tokens.count_short(tok, {}, [t.encode()]) == [want]


def test_joined_words_and_their_punctuation_count_as_the_library_counts():
    tok, rnd = tokens.load(queries.VOCABULARY), random.Random(5)
    chars = [*"abAB09'’.,-!\"#()<>|", "é", "e\u0301", "İ", "\u0301", "\u0338", "漢", "한", "\u11a8", "²", "…", "\u200d", "\u3000",
             "\x01", "\x1c", "😀", "Å", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'S"]
    words = ["".join(rnd.choices(chars, k=rnd.randint(1, 7))) for _ in range(20_000)] + ["\x01", "a\x01", "(said:", "word,"]
    want = [len(e) for e in tok.encode_batch(words, add_special_tokens=False)]
    assert tokens.count_short(tok, {}, [w.encode() for w in words]) == want
    texts = [" ".join(words[i:i + 50]) + "\t\n" * (i % 100) for i in range(0, len(words), 50)]
    assert tokens.count_short(tok, {}, [t.encode() for t in texts]) == [sum(want[i:i + 50]) for i in range(0, len(words), 50)]


def test_words_are_asked_for_once_without_their_punctuation():
    class Counted:
        def __init__(self, tok):
            self.tok, self.texts = tok, []

        def __getattr__(self, name):
            return getattr(self.tok, name)

        def encode_batch_fast(self, texts, **kw):
            self.texts += texts
            return self.tok.encode_batch_fast(texts, **kw)

    tok = Counted(tokens.load(queries.VOCABULARY))
    text = " ".join(f"{a}longword{i}{b}" for i in range(300) for a in ("", "(", '"') for b in ("", ",", ").", "!?"))
    assert tokens.count_short(tok, {}, [text.encode()]) == [len(tok.tok.encode(text, add_special_tokens=False))]
    assert len(tok.texts) < 20 and sum(t.count("longword") for t in tok.texts) == 300


def test_token_counts(spark, odd):
    got = sorted(map(tuple, tokens.count_tokens(odd, queries.VOCABULARY, limit=1, chunk_chars=1000).collect()), key=str)
    tok = tokens.load(queries.VOCABULARY)
    want = []
    for i, t, _ in ODD:
        n = len(tok.encode(t or "", add_special_tokens=False))
        want.append((i, len(t or ""), n, n > 1, len(t or "")))
    assert got == sorted(want, key=str)
    assert tokens.count_tokens(odd.limit(0), queries.VOCABULARY).count() == 0


def _pii_brute(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        doubled = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d[::-1]))
        if 12 <= len(d) <= 19 and doubled % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_personal_data_equals_the_patterns():
    rnd = random.Random(5)
    for alphabet in ("a1.@-", "12.3 -+(", "1.25", "@a.b-%+ é", "0123456789 -+"):
        for _ in range(1500):
            t = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(45)))
            assert pii.base_spans(t) == _pii_brute(t), t


def test_contexts_discover_unseen_identifiers(spark, odd):
    rows = [(i, f"é call me at +1 (415) 555-{1000 + i} now") for i in range(12)]
    rows += [(100, "well call me at 555 010 9988 please"), (101, "chapter 5550109977 starts"), (102, None)]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100].spans == "phone:16:28" and got[100].n_phone == 0 and got[100].n_found == 1
    assert got[101].spans == "" and got[102].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[3].spans == "phone:13:30" and got[3].base_sha256 == hashlib.sha256(b"phone:13:30").hexdigest()
    assert pii.find_personal_data(odd).count() == len(ODD) and pii.find_personal_data(odd.limit(0)).count() == 0


@pytest.mark.parametrize("seeds,unseen", [(5, 1), (5, 5), (10, 10), (50, 11), (100, 100)])
def test_many_unseen_identifiers_beside_the_seeds(spark, seeds, unseen):
    rows = [(i, f"call me at +1 (415) 555-{1000 + i} now") for i in range(seeds)]
    rows += [(1000 + i, f"call me at 555 010 {2000 + i} now") for i in range(unseen)]
    rows += [(2000 + i, f"see chapter 5550{300000 + i} there") for i in range(20)]
    # as many addresses as numbers of their kind: no kind has the pattern
    rows += [(3000 + i, f"the number is +1 (415) 556-{1000 + i} now") for i in range(10)]
    rows += [(4000 + i, f"the number is 10.0.0.{i} now") for i in range(10)]
    rows += [(5000 + i, f"the number is 555 011 {2000 + i} now") for i in range(5)]
    rows += [(6000 + i, f"the total of +1 (415) 557-{1000 + i} now") for i in range(5)]
    rows += [(7000 + i, f"the total of 777 011 {2000 + i} now") for i in range(60)]
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r.n_found} == {1000 + i for i in range(unseen)}
    assert all(r.spans == "phone:11:23" for r in got if r.n_found)


def test_found_identifiers_support_further_patterns(spark):
    rows = [(i, f"call me at +1 (415) 555-{1000 + i} now") for i in range(10)]
    rows += [(100 + i, f"call me at 555 010 {2000 + i} or ring up 555 010 {2000 + i} today") for i in range(6)]
    rows += [(200, "or ring up 555 010 7777 today")]  # its pattern has no seed
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {k: {r.doc_id: r.n_found for r in pii.find_personal_data(docs, rounds=k).collect()} for k in (1, 2, 3)}
    assert found[1][200] == 0 and found[2][200] == 1 and found[3][200] == 1
    assert all(found[1][100 + i] == 2 for i in range(6))


def test_address_runs_are_whole():
    long = "x" * 100 + "(at)" + "y" * 100 + ".org"
    assert list(pii.candidates(f"to <{long}>, ok", [])) == [(0, 4, 4 + len(long))]
    assert list(pii.candidates("a[at]b(at)c.org " + "@" * 50_000, []))[0] == (0, 0, 15)


def _covered(words, m):
    n, seen, gone = len(words), Counter(tuple(words[i:i + m]) for i in range(len(words) - m + 1)), [False] * len(words)
    for i in range(n - m + 1):
        if seen[tuple(words[i:i + m])] > 1:
            gone[i:i + m] = [True] * m
    return sum(gone)


def _longest(words):
    for size in range(len(words) - 1, 0, -1):
        parts = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
        if len(set(parts)) < len(parts):
            return size
    return 0


def test_repetition_equals_brute_force():
    rnd = random.Random(3)
    for _ in range(400):
        words = [rnd.choice([b"a", b"b", b"c", b"d"][:rnd.randrange(1, 5)]) for _ in range(rnd.randrange(50))]
        words += words[2:2 + rnd.randrange(20)] if rnd.random() < 0.5 else []
        for m in (1, 3, 8, 9):
            lengths = repetition.repeat_lengths(repetition.word_hashes(words), m)
            assert repetition.covered(lengths, m) == _covered(words, m)
            longest = _longest(words)
            assert lengths.max(initial=0) == (longest if longest >= m else 0)


def test_quality_table(spark, odd):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(1, good), (2, "same line here\n" * 30), (3, "#$ <b> x\n\nx"), (4, None), (5, good + " " + good[:60])]
    got = {r.doc_id: r for r in repetition.quality_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and not got[1].base_failed and got[1].word_chars == len(good.replace(" ", ""))
    assert got[2].base_failed and not got[2].kept and got[2].n_dup_lines == 29 and got[2].n_repeat_words == 90
    assert (got[3].n_symbols, got[3].n_words, got[3].base_failed) == (4, 4, True)
    assert got[4].n_words == 0 and got[4].base_failed
    assert repetition.quality_table(odd).count() == len(ODD)
    assert repetition.keep_good(odd).columns == odd.columns and repetition.keep_good(odd.limit(0)).count() == 0


def test_long_repeats_in_long_texts_are_rejected():
    def text(n, passage):  # the passage stands twice among n words that are all different
        words = [b"w%d" % i for i in range(n - passage)]
        return b" ".join(words[:n // 2] + words[:passage] + words[n // 2:])
    assert not repetition.measure(text(20_000, 1_900), repetition.Limits())[-1]
    assert not repetition.measure(text(20_000, 501), repetition.Limits())[-1]
    assert repetition.measure(text(20_000, 500), repetition.Limits())[-1]


def test_language_of_held_out_documents(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op10_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in got if r.held_out]
    assert test and sum(r.lang == r.lang_pred for r in test) / len(test) > 0.9
    assert all(0 <= r.score <= 1 for r in got) and len(got) == docs.count()
    strange = spark.createDataFrame([(1, None, "en"), (2, "123 ?!", "en"), (3, "hello there friend", None), (None, "abc", "de")],
                                    "doc_id long, text string, lang string")
    out = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_by_fold(strange).collect()}
    assert out[1] == ("und", 0.0) and out[2] == ("und", 0.0)
    assert langid.identify_by_fold(strange.limit(0)).count() == 0
    mixed = langid.infer("ab ab " * 40 + "xy xy " * 40, np.log(np.stack([
        (np.bincount(langid.trigrams(t * 50), minlength=langid.BUCKETS) + 0.01) / 1e3 for t in ("ab ", "xy ")])))
    assert mixed[2] == [0, 1] and 0.3 < mixed[1] < 0.7


def test_packing(spark, odd):
    rnd = np.random.default_rng(1)
    for _ in range(60):
        lengths = np.sort(rnd.choice(50, rnd.integers(1, 8), replace=False))
        counts, k = rnd.integers(1, 9, len(lengths)), int(rnd.integers(1, 5))

        def cost(ends):
            return sum(int(c) * (min(e for e in ends if e >= n) - int(n)) for n, c in zip(lengths, counts))
        best = min(cost([*c, lengths[-1]]) for r in range(k) for c in itertools.combinations(lengths[:-1], min(r, len(lengths) - 1)))
        assert cost(packing.boundaries(lengths, counts, k)) == best
    docs = spark.createDataFrame([(i, "w " * (i % 40)) for i in range(300)] + [(None, None), (7, "w " * 5000)], "doc_id long, text string")
    rows = packing.pack(docs, buckets=4, token_budget=100, shard_rows=50).collect()
    assert len(rows) == 302 and all(r.padding == r.bucket_len - r.n_tokens >= 0 for r in rows)
    for (length, _, _), size in Counter((r.bucket_len, r.shard, r.batch) for r in rows).items():
        assert size == 1 or size * length <= 100
    assert packing.pack(odd).count() == len(ODD) and packing.pack(odd.limit(0)).count() == 0


def test_equal_rows_spread_over_shards(spark):
    docs = spark.createDataFrame([(None, "one two three")] * 3000 + [(1, None)], "doc_id long, text string").repartition(4)
    rows = packing.pack(docs, buckets=2, shard_rows=300, token_budget=10_000).collect()
    held = Counter((r.bucket_len, r.shard) for r in rows)
    assert len(rows) == 3001 and len(held) >= 10 and max(held.values()) < 2 * 300


def test_language_needs_a_letter(spark):
    rows = [(i, t, None) for i, t in enumerate(["5²", "½ 12", "①", "", None, " 42 !?", "ª", "٣"])]
    teach = [(100 + i, "the cat and the dog", "en") for i in range(20)] + [(200 + i, "der Hund und die Katze", "de") for i in range(20)]
    docs = spark.createDataFrame(rows + teach, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_by_fold(docs).collect()}
    assert [got[i][0] == "und" for i in range(8)] == [not any(c.isalpha() for c in t or "") for _, t, _ in rows]
    assert all(0 <= s <= 1 for _, s in got.values()) and all(got[i][1] == 0 for i in range(6))


def _plain_mixture(weights, likes, rounds):
    """Expectation-maximisation word for word, from equal shares."""
    share = [1 / len(likes[0])] * len(likes[0])
    for _ in range(rounds):
        new = [0.0] * len(share)
        for w, row in zip(weights, likes):
            total = sum(s * x for s, x in zip(share, row))
            for k in range(len(share)):
                new[k] += w * share[k] * row[k] / total
        new = [x / sum(new) for x in new]
        done = max(abs(x - y) for x, y in zip(new, share)) < 1e-4
        share = new
        if done:
            break
    return share


def test_mixture_is_plain_em():
    rnd = np.random.default_rng(4)
    for _ in range(5):
        weights, likes = rnd.integers(1, 9, 30), rnd.random((30, 3)) + 1e-3
        share, value = langid.mixture(weights, np.log(likes))
        want = _plain_mixture(weights.tolist(), likes.tolist(), langid.ROUNDS)
        assert share == pytest.approx(want, abs=1e-9)
        assert value == pytest.approx(sum(w * np.log(sum(s * x for s, x in zip(want, row))) for w, row in zip(weights, likes)))


def test_packing_counts_tokens_and_ends_at_real_lengths(spark):
    rnd = random.Random(2)
    texts = ["漢字" * 300, "日本語のテキスト" * 40, "x1Y" * 500, "don't unbelievableness", None, ""]
    texts += ["w " * n for n in (3001, 3002, 3003, 5001, 5555)] + ["漢" * rnd.randrange(1, 400) for _ in range(60)]
    tok = tokens.load(queries.VOCABULARY)
    want = [len(tok.encode(t or "", add_special_tokens=False)) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(docs, buckets=6, token_budget=500, shard_rows=20).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == dict(enumerate(want))
    assert {r.bucket_len for r in rows} <= set(want) and all(r.padding == r.bucket_len - r.n_tokens >= 0 for r in rows)
    sizes = Counter((r.bucket_len, r.shard, r.batch) for r in rows)
    assert all(size == 1 or size * length <= 500 for (length, _, _), size in sizes.items())
