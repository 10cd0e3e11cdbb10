"""Operators over a whole corpus: line and substring dedup, near-dedup, leaks, archives, pipeline."""

import hashlib
import os
import random
import sys
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkcare.llm import decontam, line_dedup, minhash, queries, repetition, substring, tokens, warc

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
from check_oracle import digest  # noqa: E402

SF = "/root/testdata/sf0.001"
ODD = [(1, ""), (None, None), (2, "one two"), (2, "one two"), (None, "x" * 5000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("rest", F.lit("r")) \
        .withColumn("key", F.lit(1)).withColumn("node", F.lit(1)).withColumn("spans", F.lit("s"))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest([d[0] for d in cur.description], cur.fetchall())


def test_line_dedup_defined_cases(spark, odd):
    rows = [(None, "aaaaaaaaaaaaaaa\nb"), (2, "AAAAAAAAAAAAAAA \nc"), (2, "aaaaaaaaaaaaaaa"), (3, None),
            (4, ""), (5, "xxxxxxxxxxxx\nxxxxxxxxxxxx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for bits in (1 << 16, 1 << 28):  # a full filter only makes more lines suspects
        got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped)
                      for r in line_dedup.dedup_lines(docs, max_filter_bits=bits).collect()), key=str)
        assert got == sorted([(None, "b", 2, 1), (2, "AAAAAAAAAAAAAAA \nc", 2, 0), (2, "aaaaaaaaaaaaaaa", 1, 0),
                              (3, "", 1, 0), (4, "", 1, 0), (5, "xxxxxxxxxxxx\nxxxxxxxxxxxx", 2, 0)], key=str)
    assert line_dedup.dedup_lines(odd).count() == len(ODD) and line_dedup.dedup_lines(odd.limit(0)).count() == 0


def _groups(rows, k):
    """The set of each row, and a member that stands for its group."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in index[x]).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for x in s:
            index[x].append(i)
    return sets, [root(i) for i in range(len(rows))]


def _classes(rows, k):
    sets, of = _groups(rows, k)
    ids = defaultdict(list)
    for g, (d, _) in zip(of, rows):
        ids[g].append(d)
    return sorted((d, len(s), min(ids[g]), d == min(ids[g])) for s, g, (d, _) in zip(sets, of, rows))


def test_near_duplicates_equal_brute_force(spark, odd):
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(500)}" for _ in range(60)]
    rows = []
    for i in range(150):  # one large group of near copies at every similarity
        w = list(base)
        for _ in range(rnd.randrange(5)):
            w[rnd.randrange(60)] = f"v{rnd.randrange(9)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [(300 + i, " ".join(f"u{rnd.randrange(50)}" for _ in range(rnd.randrange(7)))) for i in range(40)]
    rows += [(400, None), (401, "")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id", "kept").collect())) == _classes(rows, 4)
    kept = minhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted(map(str, (r.text for r in kept.collect()))) == sorted(["", "None", "one two", "x" * 5000])
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def _components(sets):
    """Smallest member of each row's component, links by exact overlap of all pairs."""
    import numpy as np
    names = {x: i for i, x in enumerate(sorted(set().union(*sets)))}
    hold = np.zeros((len(sets), len(names)), np.float32)
    for r, s in enumerate(sets):
        hold[r, [names[x] for x in s]] = 1
    both, size = hold @ hold.T, hold.sum(axis=1)
    link = both * 100 >= 80 * (size[:, None] + size[None, :] - both)
    label = np.arange(len(sets))
    while True:
        new = np.where(link, label[None, :], len(sets)).min(axis=1)
        if (new == label).all():
            return label.tolist(), int(np.triu(link, 1).sum())
        label = new


def test_large_group_that_stays_apart(spark):
    """Thousands of near copies, most of them just too far from each other, some in chains."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(70)]
    rows = []
    for i in range(2500):
        w = list(base)
        for _ in range(rnd.choice([1, 4, 4, 5, 5, 5])):
            w[rnd.randrange(70)] = f"v{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[j:j + 4]) for j in range(67)} for _, t in rows]
    want, links = _components(sets)
    assert 1000 < len(set(want)) < 2400 < links
    before = minhash.BLOCK_NODES
    for block in (200,):  # a few blocks, so that pairs of blocks meet
        minhash.BLOCK_NODES = block
        try:
            got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
        finally:
            minhash.BLOCK_NODES = before
        assert [r.component_id for r in sorted(got)] == want


def test_whole_table_near_duplicates_equal_brute_force(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = queries.op2_minhash(spark, SF).collect()
    assert sorted(map(tuple, got)) == _classes(rows, 4)


def test_rows_that_only_look_alike_stay(spark):
    rows = [(None, "5"), (5, None), (None, None), (5, ""), (5, "5"), (None, "5")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, __row int")
    got = minhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect() if r.text == "5") == [(5, "5")]  # one of the class of "5"
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect() if r.text != "5") == [("5", ""), ("5", "None"), ("None", "None")]
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    kept = decontam.drop_leaks(docs.unionByName(spark.createDataFrame([(9, "x a b c d e f y", 6)], docs.schema)), items)
    assert kept.columns == docs.columns and sorted(r["__row"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5]


@pytest.mark.parametrize("dense", [True, False])
def test_overlaps_count_exactly(dense):
    import numpy as np
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, 900, rnd.integers(1, 300))).astype(np.uint64) for _ in range(40)]
    sets[3] = sets[4]
    pairs = np.array([(i, j) for i in range(40) for j in range(i + 1, 40) if rnd.random() < .7]).T
    before = minhash.PAIR_COST, minhash.CHUNK
    minhash.PAIR_COST, minhash.CHUNK = (1.0 if dense else 0.0), 100
    try:
        got = minhash.overlaps(sets, pairs)
    finally:
        minhash.PAIR_COST, minhash.CHUNK = before
    assert got.tolist() == [len(np.intersect1d(sets[i], sets[j])) for i, j in pairs.T]


def _windows(rows, m):
    split = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[j:j + m]) for w in split for j in range(len(w) - m + 1))
    out = []
    for (i, _), w in zip(rows, split):
        gone = [False] * len(w)
        for j in range(len(w) - m + 1):
            if seen[tuple(w[j:j + m])] > 1:
                gone[j:j + m] = [True] * m
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,gram,piece", [(10, 4, 1 << 18), (10, 4, 7), (9, 1, 20)])
def test_substring_dedup_equals_brute_force(spark, odd, window, gram, piece):
    rnd = random.Random(2)
    words = list("abcdefgh")
    shared = [[rnd.choice(words) for _ in range(rnd.randrange(8, 60))] for _ in range(6)]
    rows = []
    for i in range(100):
        w = [rnd.choice(words if i % 3 else words[:2]) for _ in range(rnd.randrange(50))]
        for _ in range(rnd.randrange(3)):
            s, a = rnd.choice(shared), rnd.randrange(8)
            w += s[a:a + rnd.randrange(1, 60)] + [rnd.choice(words)]
        rows.append((i if i % 10 else None, " ".join(w)))
    rows += rows[:3] + [(5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.dedup_substrings(docs, window=window, gram=gram, piece=piece).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in got), key=str) == _windows(rows, window)
    assert substring.dedup_substrings(odd).count() == len(ODD) and substring.dedup_substrings(odd.limit(0)).count() == 0


def test_factors_are_greedy():
    m = lambda *p: [{"start": a, "end": b} for a, b in p]
    assert substring.parse([]) == []
    assert substring.parse(m((5, 15), (5, 20), (12, 30), (25, 28), (40, 50), (50, 60))) == [(5, 20), (20, 30), (40, 50), (50, 60)]


def test_matches_name_a_real_occurrence(spark):
    rnd = random.Random(4)
    shared = [f"s{rnd.randrange(9)}" for _ in range(80)]
    rows = [(i, " ".join([f"u{i}.{j}" for j in range(rnd.randrange(20))] + shared[i % 7:50 + i % 5 * 7] + [f"v{i}.{j}" for j in range(5)]))
            for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        substring.row_key("doc_id", "text").alias("row_key"), "doc_id", "text")
    words = {r.row_key: r.text.split() for r in docs.collect()}
    found = substring.matches(docs.select("row_key", "text"), window=10, gram=4).collect()
    assert len(found) >= 30
    for r in found:
        there = words[r.ref_key][r.start - r["shift"]:r.end - r["shift"]]
        assert words[r.row_key][r.start:r.end] == there and len(there) >= 10
        assert (r.ref_key, r["shift"]) != (r.row_key, 0)


def test_whole_table_substrings_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in queries.op3_substring_dedup(spark, SF).collect()), key=str)
    assert got == sorted(((i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in _windows(rows, 35)), key=str)


def test_leaks_defined_cases(spark, odd):
    item = " ".join(f"q{i}" for i in range(30))
    long = " ".join(f"d{i}" for i in range(3000))
    docs = [(1, long + " " + item.upper() + " " + long), (2, long), (3, " ".join(item.split()[:20])), (None, item), (4, None)]
    items = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (1, item), (4, "D7 d8"), (5, " "), (6, "d2999")],
                                  "item_id long, text string")
    got = sorted(map(tuple, decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()), key=str)
    short = [(d, i, 1, 1, 1.0) for d in (1, 2) for i in (4, 6)]  # fewer words than a shingle: the whole sequence
    assert got == sorted([(1, 1, 26, 26, 1.0), (None, 1, 26, 26, 1.0), *short], key=str)
    assert decontam.find_leaks(odd, items).count() == 0 and decontam.find_leaks(odd, items.limit(0)).count() == 0
    assert decontam.drop_leaks(odd, items).columns == odd.columns


INNER = warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


@pytest.mark.parametrize("compression,split", [("none", "700"), ("gzip", "128m")])
def test_archives_round_trip(spark, compression, split):
    payloads = [None, "", INNER, "abc" + INNER * 3 + "def" * 20, INNER + INNER, warc.MAGIC, "x" + warc.MAGIC * 4,
                "é" * 60, "é" * 60, "\r\n\r\n" + warc.MAGIC + "y" * 3000 + warc.MAGIC + "Content-Length: 9\r\n\r\nz"]
    rows = [(i, None if i % 3 else "http://a b\r\n%", p) for i, p in enumerate(payloads)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2).withColumn("file", F.lit("f"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = sorted(map(tuple, warc.round_trip(pages, compression=compression).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = []
    for i, _, p in rows:
        data = (p or "").encode()
        first = next(j for j, _, q in rows if (q or "").encode() == data)
        later = len(data) >= 100 and first != i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if later else "response", first if later else None))
    assert got == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_of_others(spark, tmp_path):
    """Version 1.0, payloads over many splits beside whole ones, and files without a record."""
    def record(version, page, payload):
        return (f"WARC/{version}\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\n"
                f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload + b"\r\n\r\n"
    want, n = {}, 0
    for name in "ab":
        body = b""
        for k in range(40):
            payload = [b"x" * 10, b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc" * 60, b"WARC/1." * 300, b""][k % 4]
            body += record("1.0" if k % 3 else "1.1", n, payload)
            want[str(n)] = (len(payload), hashlib.sha256(payload).hexdigest())
            n += 1
        (tmp_path / name).write_bytes(body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        got = {r.page: (r.payload_bytes, r.payload_digest) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == want
    (tmp_path / "c").write_bytes(b"no archive")
    with pytest.raises(ValueError):
        warc.read_archives(spark, str(tmp_path))


def test_written_records_are_valid(spark, tmp_path):
    pages = spark.createDataFrame([(i, "http://a/b c", "same " * 40 if i < 2 else None) for i in range(3)], "page_id long, url string, html string")
    warc.write_archives(warc.assign_types(pages).coalesce(1), str(tmp_path / "w"), "none")
    (name,) = [f for f in os.listdir(tmp_path / "w") if f.startswith("part-")]
    data, at, heads = (tmp_path / "w" / name).read_bytes(), 0, []
    while at < len(data):  # by declared lengths
        assert data[at:].startswith(b"WARC/1.1\r\n")
        end = data.index(b"\r\n\r\n", at) + 4
        heads.append(dict(line.split(": ", 1) for line in data[at:end - 4].decode().split("\r\n")[1:]))
        at = end + int(heads[-1]["Content-Length"])
        assert data[at:at + 4] == b"\r\n\r\n"
        at += 4
    assert len(heads) == 3
    for h in heads:
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(h)
        assert ("WARC-Profile" in h and "WARC-Refers-To" in h) == (h["WARC-Type"] == "revisit")


def test_one_full_set_for_each_node(spark):
    texts = ["a b c d e f g"] * 300 + ["a b c d e f h"] * 300 + ["q r s t u v w"]
    docs = spark.createDataFrame([(i % 200, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = docs.select(minhash.row_digest(F.col("doc_id"), F.col("text")).alias("row_key"), "doc_id", "text")
    nodes = minhash.signatures(rows, 2, minhash.COORDINATES).groupBy("node").agg(F.min("row_key").alias("row_key"))
    spread = rows.groupBy("text").agg(F.min("row_key").alias("row_key"))
    keys = [r.h for r in rows.select(F.xxhash64("row_key").alias("h")).distinct().collect()]
    before = minhash.key_filter
    minhash.key_filter = lambda *a, **k: before(spark.createDataFrame([(k,) for k in keys], "h long"), len(keys))
    try:  # every copy passes the filter
        got = minhash.full_sets(rows, nodes.join(spread, "row_key", "left_semi"), 2).collect()
    finally:
        minhash.key_filter = before
    assert len(got) == 3 == len({bytes(r.node) for r in got}) and all(len(r.shingles) == 6 for r in got)


def test_only_leaking_rows_go(spark):
    item = "one two three four five six seven eight nine ten"
    texts = [(None, "x " + item + " y"), (None, "clean without id"), (5, item.upper()), (5, "clean with the same id"),
             (6, "one two three four five six only"), (None, None), (7, ""), (7, item), (7, item)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(texts)], "doc_id long, text string, n int")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[j:j + decontam.WORDS]) for j in range(len(w) - decontam.WORDS + 1)}
    want = {n for n, (_, t) in enumerate(texts)
            if len(shingles(t) & shingles(item)) < decontam.THRESHOLD * len(shingles(item))}
    got = decontam.drop_leaks(docs, items)
    assert got.columns == docs.columns and sorted(r.n for r in got.collect()) == sorted(want) == [1, 3, 4, 5, 6]


def _verdict(text):
    """The quality rules from their definition, with counters of word windows."""
    words = (text or "").encode().split()
    n, lim = len(words), repetition.Limits()

    def grams(m):
        return Counter(tuple(words[i:i + m]) for i in range(n - m + 1))

    def inside(m):
        seen, gone = grams(m), [False] * n
        for i in range(n - m + 1):
            if seen[tuple(words[i:i + m])] > 1:
                gone[i:i + m] = [True] * m
        return sum(gone)

    lo, hi = 0, n  # a repeat of m words holds one of m - 1
    while lo < hi:
        m = (lo + hi + 1) // 2
        lo, hi = (m, hi) if max(grams(m).values(), default=0) > 1 else (lo, m - 1)
    if n < lim.min_words or 100 * inside(8) > lim.base_repeat_percent * n or 100 * inside(lim.min_repeat) > lim.max_covered * n:
        return False
    return not (lo > lim.longest_words and 100 * lo > lim.longest_percent * n) and lo <= lim.longest_ever


def _lines_kept(rows):
    """(doc_id, text) with the lines that stay."""
    place = lambda d: (d is None, d or 0)
    split = [[(x, x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
              for x in (t or "").split("\n")] for _, t in rows]
    homes = defaultdict(set)
    for (d, _), lines in zip(rows, split):
        for _, k in lines:
            if len(k) >= 10:
                homes[k].add(place(d))
    return [(d, "\n".join(x for x, k in lines if len(k) < 10 or len(homes[k]) < 2 or min(homes[k]) == place(d)))
            for (d, _), lines in zip(rows, split)]


def test_pipeline_stages_equal_brute_force(spark):
    base = queries.table(spark, SF, "documents")
    some = [r for r in base.collect() if r.text and len(r.text) > 400][:6]
    leak = queries.table(spark, SF, "benchmark").first().text
    extra = [(None, some[0].text), (None, some[1].text + " one more word here"), (some[2].doc_id, " ".join(f"own{i}" for i in range(60))),
             (None, " ".join(f"clean{i}" for i in range(40))), (some[3].doc_id, None), (None, None), (9001, leak + " " + some[4].text),
             (None, "before " + leak.upper()), (9002, "again and again " * 40), (9003, "\n".join(["a line that is repeated"] * 3 + [f"w{i} v{i}" for i in range(30)]))]
    near = [f"near{i}" for i in range(90)]
    extra += [(9005, " ".join(near)), (9004, " ".join(near[:-1] + ["other"])), (None, " ".join(near[1:]))]
    docs = base.unionByName(spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in extra], base.schema))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontaminate", "pack"]
    stages = dict(corpus_pipeline.STAGES)
    pairs = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    def step(name):
        out = corpus_pipeline.stored(stages[name](spark, docs, SF))
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        return pairs(docs), pairs(out), out

    before, after, docs = step("quality")
    assert after == [r for r in before if _verdict(r[1])] and 100 < len(after) < len(before)

    before, after, docs = step("lines")
    assert after == sorted(_lines_kept(before), key=str) and after != before
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    before, after, docs = step("near_duplicates")
    first = {}
    for g, (d, t) in zip(_groups(before, 5)[1], before):
        first[g] = min(first.get(g, (True, 0)), (d is None, d or 0))
    assert Counter((d is None, d or 0) for d, _ in after) == Counter(first.values())  # one of each group, the smallest id
    home = dict(zip(before, _groups(before, 5)[1]))
    assert len({home[r] for r in after}) == len(after) < len(before)

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[j:j + 5]) for j in range(len(w) - 4)}
    items = [shingles(r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    before, after, docs = step("decontaminate")
    assert after == [r for r in before if not any(x and len(x & shingles(r[1])) >= 0.8 * len(x) for x in items)] and len(after) < len(before)

    got = stages["pack"](spark, docs, SF).collect()
    tok = tokens.load(queries.VOCABULARY)
    counts = Counter((d, len(tok.encode(t, add_special_tokens=False))) for d, t in after)
    assert Counter((r.doc_id, r.n_tokens) for r in got) == counts
    groups = defaultdict(list)
    for r in got:
        assert r.padding == r.bucket_len - r.n_tokens >= 0
        groups[r.bucket_len, r.shard, r.batch].append(r)
    assert all(len(g) == 1 or len(g) * g[0].bucket_len <= 16_384 for g in groups.values())
    assert all(max(r.n_tokens for g in groups.values() for r in g if r.bucket_len == b) == b for b in {r.bucket_len for r in got})


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_near_copies_with_words_of_their_own_need_no_comparison(spark):
    """Members of one long posting: every link between two labels keeps a common shingle, and near copies
    too far from all others leave the postings."""
    rng = random.Random(5)
    base = list(range(1, 101))
    sets, fresh = [], 1000
    for i in range(300):
        gone = set(rng.sample(base, rng.choice([0, 2, 5, 9, 12, 30, 40])))
        own = [fresh + j for j in range(len(gone))]
        fresh += len(gone)
        sets.append(sorted([x for x in base if x not in gone] + own))
    names = [i.to_bytes(4, "big") for i in range(300)]
    labels = [names[rng.randrange(3)] if rng.random() < 0.3 else n for n in names]
    now = spark.createDataFrame([(7, n, len(s), l, 300) for n, s, l in zip(names, sets, labels)],
                                "token bigint, node binary, n bigint, label binary, c bigint")
    full = spark.createDataFrame([(n, s) for n, s in zip(names, sets)], "node binary, shingles array<bigint>")
    got = {}
    for r in minhash.by_rare_shingles(now, full, 80).collect():
        got.setdefault(bytes(r.node), set()).add(r.token)
    linked = 0
    for i in range(300):
        for j in range(i):
            both = len(set(sets[i]) & set(sets[j]))
            if labels[i] != labels[j] and both * 100 >= 80 * (len(sets[i]) + len(sets[j]) - both):
                linked += 1
                assert got.get(names[i], set()) & got.get(names[j], set())
    assert linked > 50
    far = [n for n, s in zip(names, sets) if len(set(s) & set(base)) <= 70]
    assert far and not any(n in got for n in far)
