"""Mixing sources, cross-tokenizer alignment, centroid clustering: against plain versions."""

import hashlib
import heapq
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkcare.llm import alignment, mixing, pivots, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- mixing -------------------------------------------------------------------------------

def fair_targets(sizes, weights=(5, 2, 1), most=3):
    """Shared by weight, round by round, until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = Fraction(sum(sizes.values())), set(names), {s: Fraction(0) for s in names}
    while open_ and left > 0:
        share = left / sum(w[s] for s in open_)
        for s in open_:
            target[s] += share * w[s]
        left = Fraction(0)
        for s in list(open_):
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = Fraction(most * sizes[s])
                open_.discard(s)
    return target


def highest_quotients(claims, seats):
    heap = [(-Fraction(c), i, 0) for i, c in enumerate(claims) if c]
    heapq.heapify(heap)
    got = [0] * len(claims)
    for _ in range(seats if heap else 0):
        _, i, k = heapq.heappop(heap)
        got[i] += 1
        heapq.heappush(heap, (-Fraction(claims[i]) / (2 * k + 3), i, k + 1))
    return got


def test_apportion_is_highest_quotients(spark):
    rnd = random.Random(4)
    cases = [([rnd.choice([0, 1, 7, rnd.randint(1, 10 ** 6)]) for _ in range(rnd.randint(1, 40))], rnd.randint(0, 300))
             for _ in range(60)] + [([5, 5, 5], 2), ([1], 9), ([0, 0], 3), ([53000, 24000, 23000], 7)]
    rows = [(g, i, c, s) for g, (claims, s) in enumerate(cases) for i, c in enumerate(claims)]
    df = spark.createDataFrame(rows, "g long, i long, claim long, seats long")
    got = defaultdict(dict)
    for r in mixing.apportion(df, "claim", "seats", ["g"], "i", "q").collect():
        got[r["g"]][r["i"]] = r["q"]
    for g, (claims, s) in enumerate(cases):
        assert [got[g][i] for i in range(len(claims))] == highest_quotients(claims, s), (claims, s)


def test_mix_meets_its_targets(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.mix_sources(docs).collect()
    texts = {r["doc_id"]: r for r in docs.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]]["text"] or "")) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == sum((x["end"] - x["first"]) * x["times"] for x in r["runs"])
        assert all(0 <= x["first"] < x["end"] <= r["size"] for x in r["runs"])
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    want = fair_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-12)
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] for s in sizes)
    again = mixing.mix_sources(docs.repartition(7)).collect()  # another layout, the same mix
    key = lambda r: (r["doc_id"], r["taken"], str(r["runs"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    other = mixing.mix_sources(docs, seed=5).collect()
    assert sorted(map(key, rows)) != sorted(map(key, other))


def test_mix_of_odd_rows(spark):
    rnd = random.Random(2)
    rows = [(None, "w " * 40, None), (1, None, "b"), (1, "", "b"), (2, "x y z " * 300, "a")]
    rows += [(7, "same text of six words here", "hot")] * 9000           # more than COPIES of one row
    rows += [(i, "k " * rnd.randint(1, 90), rnd.choice(["a", "c", "\U0001f600", "￮", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("key", F.lit(1)) \
        .withColumn("size", F.lit("s")).withColumn("number", F.lit(0)).withColumn("shard", F.lit("?"))
    got = mixing.mix_sources(df, shard_words=1000).collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter(
        (i, len(WORD.findall(t or "")), s) for i, t, s in rows)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    want = fair_targets(dict(sizes))
    for r in got:
        assert r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-12)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.03 * want[s] + 32, (s, taken[s], float(want[s]))
    assert want["hot"] < 3 * sizes["hot"] and len({r["taken"] for r in got if r["source"] == "hot"}) > 1
    assert mixing.mix_sources(df.limit(0)).count() == 0
    empty = mixing.mix_sources(spark.createDataFrame([(1, " ", "a"), (2, None, None)], df.schema["doc_id"].dataType
                                                     and "doc_id long, text string, source string")).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in empty] == [(0, 0, 0.0, 0)] * 2


# --- alignment ----------------------------------------------------------------------------

def plain_alignment(texts):
    pair = alignment.load(alignment.A_VOCABULARY, alignment.B_VOCABULARY)
    docs, count = [], Counter()
    for t in texts:
        a = pair.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = pair.b.encode(t) if t else []
        want = (" " + t).encode() if t else b""
        if b"".join(pair.a_bytes[i] for i in a) != want or b"".join(pair.b_bytes[i] for i in b) != want:
            a = b = []
        groups, i, j, x, y, lo, at = [], 0, 0, 0, 0, 0, 0
        while i < len(a):
            if x <= y:
                x += len(pair.a_bytes[a[i]])
                i += 1
            while y < x:
                y += len(pair.b_bytes[b[j]])
                j += 1
            if x == y:
                groups.append((a[lo:i], b[at:j]))
                lo, at = i, j
        links = [(p, q) for g in groups for p in g[0] for q in g[1]]
        count.update(set(links))
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        docs.append((a, b, groups, links, hashlib.sha256(text.encode()).hexdigest() if a else ""))
    best = Counter()
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    return [(len(a), len(b), len(g), len(ln), sum(count[x] == best[x[0]] for x in ln), sum(count[x] for x in ln), h)
            for a, b, g, ln, h in docs], count


def odd_texts():
    rnd = random.Random(9)
    bits = [" ", "  ", "\n", "\t", " \n", "a", "Zürich", "don't", "'s", "x" * 300, "日本語テキスト", "😀", "é", "▁", " ",
            "　", "<|endoftext|>", "<s>", "</s>", "1234567", "3.14", "===", "====" * 9, "\x00", "\x1c", "​", "﻿", "᠎", "ﬁ",
            "the", "of", "The", ",", ".", "—", "aaaaaaaaaaa", "\r\n", " ", "\u0085"]
    return ["".join(rnd.choice(bits) + (" " if rnd.random() < .6 else "") for _ in range(rnd.randint(1, 40))) for _ in range(400)]


def test_segments_encode_like_whole_texts():
    pair = alignment.load(alignment.A_VOCABULARY, alignment.B_VOCABULARY)
    assert pair.cut
    for t in odd_texts():
        parts, clean = alignment.segments(t)
        assert not clean or ("▁" not in t and not any(not p or p[0].isspace() or p[-1].isspace() for p in parts))
        assert " ".join(parts) == t
        both = pair.encode(parts)
        assert [x for a, _ in both for x in a] == pair.a.encode(" " + t, add_special_tokens=False).ids
        assert [x for _, b in both for x in b] == pair.b.encode(t)


@pytest.mark.parametrize("memo,pairs,chars", [(300, 1 << 20, 1 << 20), (1 << 20, 3000, 1 << 20), (1 << 20, 1 << 20, 4000), (0, 0, 0)])
def test_full_memo_keeps_what_is_used_most(monkeypatch, memo, pairs, chars):
    monkeypatch.setattr(alignment, "MEMO", memo)
    monkeypatch.setattr(alignment, "MEMO_PAIRS", pairs)
    monkeypatch.setattr(alignment, "MEMO_CHARS", chars)
    pair, asked = alignment.load(alignment.A_VOCABULARY, alignment.B_VOCABULARY), Counter()
    encode = pair.encode
    monkeypatch.setattr(pair, "encode", lambda texts: asked.update(" ".join(texts).split(" ")) or encode(texts))
    common, odd, kept = "Apfel Birne, Quitte's (Traube) Feige.".split(), odd_texts(), alignment.Aligner(pair)
    for i in range(30):
        texts = [" ".join([w for j in range(8) for w in (*common, f"once{i}x{k}x{j}")]) for k in range(8)]
        texts += [None, "", " ", *(odd[i * 5:i * 5 + 5] if i % 3 == 0 else [])]
        flat, bounds = kept.numbers(pa.array(["left out", *texts], pa.string())[1:])
        measures, digests = kept.measures(flat, bounds)
        want, count = plain_alignment(texts)
        assert [(*m, d) for m, d in zip(measures.tolist(), digests)] == [(*w[:4], w[6]) for w in want]
        doc, key, links = kept.records(flat, bounds, measures[:, 0] > 0)
        assert Counter((int(k) >> 16, int(k) & 0xFFFF) for k in key) == count
        assert np.bincount(doc, links, len(texts)).tolist() == measures[:, 3].tolist()
    if memo:  # before, a full memo was emptied and every word encoded anew
        assert sum(asked.values()) > 2000 and {asked[w] for w in common} == {1}


def test_memo_outlives_its_task():
    names = alignment.A_VOCABULARY, alignment.B_VOCABULARY
    assert alignment.aligner(*names) is alignment.aligner(*names)


@pytest.mark.parametrize("spill,fan,group", [(1 << 20, 64, 32 << 20), (200, 2, 500)])
def test_alignment_is_the_plain_one(spark, spill, fan, group):
    texts = [None, "", " ", *odd_texts()[:150], "the same text", "the same text"]
    ids = [None, 1, 1, *range(10, 160), 3, 3]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").withColumn("part", F.lit("p")) \
        .withColumn("run", F.lit(0)).withColumn("doc_key", F.lit(None).cast("string")).repartition(5)
    got = alignment.align(df, spill_records=spill, fan=fan, group_bytes=group).collect()
    want, count = plain_alignment(texts)
    cols = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(str, [(r["doc_id"], *(r[c] for c in cols)) for r in got])) == sorted(
        map(str, [(i, *w) for i, w in zip(ids, want)]))
    assert alignment.align(df.limit(0)).count() == 0
    pairs = {(r["a_id"], r["b_id"]): r["n_docs"] for r in alignment.pair_counts(df, spill_records=spill, fan=fan).collect()}
    assert pairs == dict(count)


def test_alignment_of_a_whole_table(spark):
    docs = queries.table(spark, SF, "documents")
    rows = docs.select("doc_id", "text").collect()
    want = {r["doc_id"]: w for r, w in zip(rows, plain_alignment([r["text"] for r in rows])[0])}
    got = queries.op12_token_alignment(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) == want[r["doc_id"]]


# --- clustering ---------------------------------------------------------------------------

def plain_clusters(rows, dims, k, rounds, scale=256, seed=2):
    kept = [(i, [int(np.floor(np.float64(scale) * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for j, g in groups.items():
            centres[j] = [sum(x) // len(g) for x in zip(*g)]
    out = [(i, *nearest(v)) for i, v in kept]
    whole, part = sum(d for _, d, _ in out), Counter()
    for _, d, j in out:
        part[j] += d
    return sorted((str(i), j, d, part[j], whole, hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
                  for i, d, j in out)


@pytest.mark.parametrize("spread", [1.0, 0.01, 3e5])
def test_clusters_are_the_plain_ones(spark, spread):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.choice([-1, 0, 1], 6) * 0.5 + rnd.normal(0, .1, 6) * spread]) for i in range(300)]
    rows += [(1000, [0.5] * 6)] * 200 + [(None, [0.25] * 6), (1000, [1.0] * 6), (5, None), (6, [1.0] * 5), (7, []),
                                         (8, [None] + [1.0] * 5), (9, [float("nan")] * 6), (10, [float("-inf")] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("x")) \
        .withColumn("p", F.lit(1)).withColumn("cluster", F.lit("c")).repartition(4)
    got = pivots.cluster_vectors(df, dims=6, clusters=12, rounds=4, pivots=4).collect()
    assert sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
                  for r in got) == plain_clusters(rows, 6, 12, 4)
    few = pivots.cluster_vectors(df.where("vec_id < 5"), dims=6, clusters=12, rounds=2).collect()
    assert {r["distance"] for r in few} == {0} and len(few) == 5
    assert pivots.cluster_vectors(df.limit(0), dims=6).count() == 0
    assert pivots.cluster_vectors(df.where("embedding is null"), dims=6).count() == 0


def test_pivots_spare_distances_and_lose_none():
    rnd = np.random.default_rng(1)
    homes = rnd.integers(-3000, 3000, (40, 64))
    points = homes[rnd.integers(0, 40, 2000)] + rnd.integers(-60, 60, (2000, 64))
    number, best, measured = pivots.assign(points, pivots.pivot_table(points, homes[:16]), homes, homes[:16])
    every = np.stack([pivots.squared(points, c) for c in homes], axis=1)
    assert (number == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert measured < 0.2 * every.size


def test_huge_components_have_a_defined_result(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in pivots.cluster_vectors(df, dims=2, clusters=1, rounds=1).collect()}
    assert got[1]["distance"] == got[2]["distance"] == got[1]["inertia"] == (1 << 63) - 1 and got[3]["distance"] == 0
