"""MinHash near-dedup by a signature-coordinate inverted join.

Equal shingle sets collapse to one node (a 128-bit digest).  A node's signature has
COORDINATES values and it is posted under its (coordinate, value) pairs.  A pair of
nodes is a candidate if at least MATCHES coordinates collide; two sets of similarity 0.8
miss that with a probability of about 1e-7.  The postings are merged with prefix and
skip:

* pairs that occur once in the corpus are dropped, and nodes left with fewer than
  MATCHES pairs with them;
* the rest of a node's pairs is ordered by frequency, and only the rarest of them, all but
  MATCHES - 1, are posted: two nodes that share MATCHES pairs share one of these;
* a posting with one label is skipped: what it holds is linked already;
* ROUNDS times, each node of an open posting goes to its longest one, where the members
  meet about PIVOTS of them.  Collisions are counted on the signatures, links confirmed on the
  full sets, and linked nodes get one label.  A posting of any length is dealt out over tasks
  with its pivots beside it, so a group that is linked costs its members, not their pairs;
* what remains is exact: members of postings that still hold several labels are posted anew
  under the rarest of their shingles that several labels have, one of which any link needs
  (``by_rare_shingles``); a near copy whose own words leave too few of those is done.  Members with
  different labels meet in every such posting.  Short postings give their pairs.  Of long ones, the members outside the
  most frequent label meet all members: nodes are cut into full blocks of BLOCK_NODES
  (and BLOCK_SHINGLES), and a pair of blocks is compared inside one task, which returns at most
  a tree of links.  Only texts that share MATCHES coordinates by the thousand and are
  no near-duplicates need many such pairs.

The result is the components of the graph of links: pairs inside one class need not be
looked at, but no link between two classes is left out.

Defined cases: a text with fewer words than a shingle has its whole word sequence as one;
a null or empty text has no set, is linked with nothing and is its own class; rows are
compared by their sets, so repeated rows and rows with the same id are members of one
class; the class id is the smallest id, null only if all ids are; an empty table gives
an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (KeyFilter, as_bytes, int64_lists, key_filter, mixed, row_digest, shingle_hashes, slices,
                     stored, two_columns, word_hashes)
from .graph import components

COORDINATES = 40
MATCHES = 18
SHORT = 32
ROUNDS = 2
PIVOTS = 24
GATHER = 2
BLOCK_NODES = 1024
BLOCK_SHINGLES = 1 << 21
CHUNK = 4096
PAIR_COST, CELL_COST = 60e-9, 5e-11  # seconds for a shingle looked up, and for a cell multiplied


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes((text or b"").lower().split()), words))


def signature(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One key per coordinate, made of the coordinate and its smallest hash."""
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        part = (shingles[at:at + CHUNK, None] ^ seeds) * np.uint64(0x9E3779B97F4A7C15)
        np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0), out=least)
    return mixed(least + seeds)


def node_of(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def signatures(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """row_key, doc_id, n_shingles, node, signature of every row."""
    seeds = mixed(np.arange(1, coordinates + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([node_of(s) for s in sets], pa.binary()),
                 int64_lists([signature(s, seeds) if len(s) else s for s in sets])],
                ["row_key", "doc_id", "n_shingles", "node", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"row_key binary, doc_id {kind}, n_shingles long, node binary, signature array<long>")


def postings(nodes: DataFrame, matches: int) -> DataFrame:
    """(token, node, n) of the prefix of every node that has ``matches`` shared tokens."""
    every = nodes.select("node", F.col("n_shingles").alias("n"), F.explode("signature").alias("token"))
    common = every.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    prefix = (every.join(common, "token").groupBy("node", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))  # COORDINATES at most
              .where(F.size("shared") >= matches)
              .select("node", "n", F.explode(F.slice("shared", F.lit(1), F.size("shared") - (matches - 1))).alias("p")))
    return prefix.select(F.col("p.token").alias("token"), "node", "n")


def _similar_size(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def confirm(pairs: DataFrame, full: DataFrame, matches: int, percent: int) -> DataFrame:
    """The (u, v) of ``pairs`` with enough collisions and, on full sets, enough overlap."""
    left, right = (full.select(F.col("node").alias(c), F.col("signature").alias(f"s{c}")) for c in "uv")
    pairs = (pairs.join(left, "u").join(right, "v")
             .where(F.size(F.array_intersect("su", "sv")) >= matches).select("u", "v"))
    left, right = (full.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "uv")
    both = F.size(F.array_intersect("su", "sv"))
    return (pairs.join(left, "u").join(right, "v")
            .where(both * 100 >= (F.size("su") + F.size("sv") - both) * percent).select("u", "v"))


def open_postings(posted: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(token, node, n, label, c): the postings of c members that hold several labels."""
    now = posted.withColumn("label", F.col("node")) if labels is None else (
        posted.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    several = (now.groupBy("token").agg(F.count("*").alias("c"), F.min("label").alias("a"), F.max("label").alias("b"))
               .where("a <> b").select("token", "c"))
    return now.join(several, "token")


def at_home(now: DataFrame, gather: int = 0) -> DataFrame:
    """(node, n, label, home, salts, members): each node in the longest of its postings, which is cut
    into ``salts`` parts of at most about BLOCK_NODES and BLOCK_SHINGLES.  ``gather`` times, a node
    moves to the longest home of those it shares a posting with: homes get fewer and fuller."""
    home = now.groupBy("node", "n", "label").agg(F.max(F.struct("c", "token")).alias("most"))
    for _ in range(gather):
        best = now.select("token", "node").join(home, "node").groupBy("token").agg(F.max("most").alias("most"))
        home = now.join(best, "token").groupBy("node", "n", "label").agg(F.max("most").alias("most"))
    home = home.select("node", "n", "label", F.col("most.token").alias("home"))
    parts = home.groupBy("home").agg(F.count("*").alias("members"), F.ceil(F.greatest(
        F.count("*") / BLOCK_NODES, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("salts"))
    return home.join(parts, "home")


def meet_pivots(now: DataFrame, full: DataFrame, matches: int, percent: int) -> DataFrame:
    """Links (u, v) between the members of each home and about PIVOTS of them."""
    home = at_home(now).where("members > 1")
    mark = F.xxhash64("node", "home")
    pivot = F.pmod(mark, F.ceil(F.col("members") / PIVOTS).cast("long")) == 0
    home = home.withColumn("pivot", pivot).withColumn("own", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
    everywhere = F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array("own"))
    dealt = home.withColumn("salt", F.explode(everywhere)).select(
        "home", "salt", "node", "label", "pivot", (F.col("salt") == F.col("own")).alias("member"))
    return (dealt.join(full.select("node", "signature", "shingles"), "node").groupBy("home", "salt")
            .applyInArrow(lambda group: _linked(group, "pivot", "member", matches, percent), "u binary, v binary"))


def meet_in_short(now: DataFrame, percent: int) -> DataFrame:
    """(u, v) with different labels in the same posting of at most SHORT members."""
    other = now.select("token", F.struct("node", "n").alias("other"), F.col("label").alias("other_label"))
    pairs = now.join(other, "token").where("label < other_label")
    return (pairs.where(_similar_size("n", "other.n", percent))
            .select(F.least("node", "other.node").alias("u"), F.greatest("node", "other.node").alias("v")).distinct())


def link_blocks(now: DataFrame, full: DataFrame, matches: int, percent: int) -> DataFrame:
    """The links (u, v) between different labels among the members of long postings."""
    home = stored(at_home(now, GATHER).select("node", "label", F.xxhash64(
        "home", F.pmod(F.xxhash64("node"), F.col("salts"))).alias("block")))
    most = (now.groupBy("token", "label").agg(F.count("*").alias("k"))
            .groupBy("token").agg(F.max(F.struct("k", "label")).alias("most")))
    spread = (now.join(most, "token").select("token", "node", (F.col("label") != F.col("most.label")).alias("minor"))
              .join(home.select("node", "block"), "node").groupBy("token", "block").agg(F.max("minor").alias("minor")))
    meet = (spread.where("minor").select("token", F.col("block").alias("x"))
            .join(spread.select("token", F.col("block").alias("y")), "token")
            .select(F.least("x", "y").alias("b1"), F.greatest("x", "y").alias("b2")).distinct())
    sides = meet.select("b1", "b2", F.explode(F.array_distinct(F.array("b1", "b2"))).alias("block"))
    nodes = home.join(full.select("node", "signature", "shingles"), "node")
    dealt = sides.join(nodes, "block").withColumn("left", F.col("block") == F.col("b1")).withColumn(
        "right", F.col("block") == F.col("b2"))
    return dealt.groupBy("b1", "b2").applyInArrow(
        lambda group: _linked(group, "left", "right", matches, percent), "u binary, v binary")


def by_rare_shingles(now: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The members of open postings posted anew, (token, node, n, label, c), under shingles that a link between
    two labels needs: one shingle of the overlap lies among the rarest of both sets.

    Only shingles found under several labels count, and with them a link between sets of n and m takes
    ``percent`` * (n + m) / (100 + ``percent``); m is at least the size of the smallest set that such a
    shingle has, and ``percent`` / 100 of n.  A node with fewer has no link left; of the others'
    shingles, ordered by frequency, the first (all but that number less one) hold one of every
    overlap.  No link is lost."""
    sets = now.select("node", "n", "label").distinct().join(full.select("node", "shingles"), "node")
    held = sets.select("node", "n", "label", F.explode("shingles").alias("token"))
    several = (held.groupBy("token").agg(F.count("*").alias("df"), F.min("n").alias("m"), F.min("label").alias("a"),
                                         F.max("label").alias("b"))
               .where("a <> b").select("token", "df", "m"))
    up = lambda x, by: F.floor((x + by - 1) / by).cast("int")
    least = up(percent * (F.col("n") + F.greatest("m", up(F.col("n") * percent, 100))), 100 + percent)
    rare = (held.join(several, "token").groupBy("node", "n", "label")
            .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"), F.min("m").alias("m"))  # a set's shingles at most
            .withColumn("least", least).where(F.size("shared") >= F.col("least"))
            .select("node", "n", "label", F.explode(F.slice("shared", F.lit(1), F.size("shared") - F.col("least") + 1)).alias("p")))
    rare = rare.select(F.col("p.token").alias("token"), "node", "n", "label")
    open_ = (rare.groupBy("token").agg(F.count("*").alias("c"), F.min("label").alias("a"), F.max("label").alias("b"))
             .where("a <> b").select("token", "c"))
    return rare.join(open_, "token")


def _linked(group: pa.Table, left: str, right: str, matches: int, percent: int) -> pa.Table:
    """A tree of links between rows marked ``left`` and rows marked ``right`` whose labels differ."""
    group = group.combine_chunks()
    empty = pa.table([pa.array([], pa.binary()), pa.array([], pa.binary())], names=["u", "v"])
    if not group.num_rows:
        return empty
    nodes = group.column("node").to_pylist()
    label = np.unique(group.column("label").to_pylist(), return_inverse=True)[1]
    name = np.unique(nodes, return_inverse=True)[1]
    sketch = group.column("signature").combine_chunks().flatten().to_numpy().reshape(len(nodes), -1)
    lists = group.column("shingles").combine_chunks()
    flat, size = lists.flatten().to_numpy().view(np.uint64), lists.value_lengths().to_numpy().astype(np.int64)
    ends = np.cumsum(size)
    sets = [flat[e - n:e] for e, n in zip(ends.tolist(), size.tolist())]
    at_left, at_right = (np.flatnonzero(group.column(c).to_numpy(zero_copy_only=False)) for c in (left, right))
    in_right = np.isin(np.arange(len(nodes)), at_right)
    twice = np.isin(at_right, at_left)
    found = []
    for i in at_left:
        others = at_right[~(twice & (at_right <= i))] if in_right[i] else at_right  # each pair once
        others = others[(label[others] != label[i]) & (name[others] != name[i])
                        & (np.minimum(size[others], size[i]) * 100 >= np.maximum(size[others], size[i]) * percent)]
        others = others[(sketch[others] == sketch[i]).sum(axis=1) >= matches] if len(others) else others
        if len(others):
            found.append((i, others))
    if not found:
        return empty
    pairs = np.concatenate([np.stack([np.full(len(o), i), o]) for i, o in found], axis=1)
    both = overlaps(sets, pairs)
    ok = both * 100 >= (size[pairs[0]] + size[pairs[1]] - both) * percent
    us, vs = tree(pairs[0][ok].tolist(), pairs[1][ok].tolist())
    return pa.table([pa.array([nodes[i] for i in us], pa.binary()), pa.array([nodes[i] for i in vs], pa.binary())],
                    names=["u", "v"])


def overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """How many shingles the two sets of each pair share: looked up pair by pair, or, where
    many pairs meet, as a product of incidence matrices.  Both count exactly."""
    lefts, i = np.unique(pairs[0], return_inverse=True)
    rights, j = np.unique(pairs[1], return_inverse=True)
    size = np.array([len(s) for s in sets])
    in_left, in_right = (np.unique(np.concatenate([sets[x] for x in side])) for side in (lefts, rights))
    shared = np.intersect1d(in_left, in_right, assume_unique=True)
    if size[pairs[1]].sum() * PAIR_COST <= len(lefts) * len(rights) * len(shared) * CELL_COST:
        out = np.zeros(pairs.shape[1], np.int64)
        starts = np.flatnonzero(np.concatenate([[True], pairs[0][1:] != pairs[0][:-1]]))
        for lo, hi in zip(starts, [*starts[1:], pairs.shape[1]]):
            mine, others = sets[pairs[0][lo]], pairs[1][lo:hi]
            theirs = np.concatenate([sets[x] for x in others])
            at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            begin = np.concatenate([[0], np.cumsum(size[others])[:-1]])
            out[lo:hi] = np.add.reduceat((mine[at] == theirs).astype(np.int64), begin)
        return out
    total = np.zeros((len(lefts), len(rights)), np.float32)  # whole numbers below 2**24 are exact

    def incidence(side: np.ndarray, part: np.ndarray) -> np.ndarray:
        out = np.zeros((len(side), len(part)), np.float32)
        for r, x in enumerate(side):
            mine = sets[x][np.searchsorted(sets[x], part[0]):np.searchsorted(sets[x], part[-1], "right")]
            at = np.searchsorted(part, mine)
            out[r, at[part[at] == mine]] = 1
        return out

    for at in range(0, len(shared), CHUNK):
        part = shared[at:at + CHUNK]
        total += incidence(lefts, part) @ incidence(rights, part).T
    return total[i, j].astype(np.int64)


def tree(us: list[int], vs: list[int]) -> tuple[list[int], list[int]]:
    """The pairs that join two parts of the graph so far."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while above.get(x, x) != x:
            above[x] = above.get(above[x], above[x])
            x = above[x]
        return x

    kept = ([], [])
    for u, v in zip(us, vs):
        a, b = root(u), root(v)
        if a != b:
            above[a] = b
            kept[0].append(u)
            kept[1].append(v)
    return kept


def relabelled(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, label) of the components of ``links`` and what ``labels`` joins already."""
    if labels is not None:
        links = links.select("u", "v").unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("v")))
    return stored(components(links))


def classes(posted: DataFrame, full: DataFrame, matches: int, percent: int) -> DataFrame:
    """(node, label) of every linked node of the postings."""
    labels = None
    for _ in range(ROUNDS):
        links = stored(meet_pivots(open_postings(posted, labels), full, matches, percent))
        if links.isEmpty():
            break
        labels = relabelled(labels, links)
    now = stored(by_rare_shingles(stored(open_postings(posted, labels)), full, percent))
    links = confirm(meet_in_short(now.where(F.col("c") <= SHORT), percent), full, matches, percent)
    links = stored(links.unionByName(link_blocks(now.where(F.col("c") > SHORT), full, matches, percent)))
    if labels is None or not links.isEmpty():
        labels = relabelled(labels, links)
    return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80, coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, row_key, class_key.
    Documents are linked at a similarity of ``percent`` / 100 of their sets of ``words`` words."""
    rows = two_columns(docs, id_col, text_col)
    rows = rows.select(row_digest(F.col("doc_id"), F.col("text")).alias("row_key"), "doc_id", "text")
    seen = stored(signatures(rows, words, coordinates))
    members = seen.where("node is not null")
    nodes = stored(members.groupBy("node").agg(F.min("row_key").alias("row_key"), F.first("n_shingles").alias("n_shingles"),
                                               F.first("signature").alias("signature")))
    posted = stored(postings(nodes, matches))
    wanted = stored(posted.select("node").distinct().join(nodes, "node"))
    full = stored(full_sets(rows, wanted, words).join(wanted.select("node", "signature"), "node"))
    labels = classes(posted, full, matches, percent)

    of_node = nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    least = (members.select("node", "doc_id").join(of_node, "node").groupBy("label")
             .agg(F.min("doc_id").alias("component_id")))
    class_of = of_node.join(least, "label").select("node", "label", "component_id")
    out = seen.select("row_key", "doc_id", "n_shingles", "node").join(class_of, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "row_key",
                      F.coalesce("label", F.concat(F.lit(b"-"), F.col("row_key"))).alias("class_key"))


def full_sets(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles), sorted, of the nodes in ``wanted``, from the one row that stands
    for each.  Rows are chosen by a filter of bounded size, so no text is shuffled, and of the
    sets that pass only those of wanted rows stay, one for each node: other copies of a
    wanted node pass the filter too, and a join by node would multiply them."""
    chosen = key_filter(wanted.select(F.xxhash64("row_key")), wanted.count(), bits_per_key=16)
    chosen = rows.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = KeyFilter(*chosen.value)
        for batch in slices(batches):
            keep = known.test(batch.column("hash").to_numpy().view(np.uint64))
            sets = [shingle_set(t, words) for t in as_bytes(batch.column("text").filter(pa.array(keep)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key").filter(pa.array(keep)), pa.array([node_of(s) for s in sets], pa.binary()),
                 int64_lists(sets)], ["row_key", "node", "shingles"])

    passed = rows.select("row_key", "text", F.xxhash64("row_key").alias("hash")).mapInArrow(
        run, "row_key binary, node binary, shingles array<long>")
    return (passed.join(wanted.select("row_key"), "row_key", "left_semi")
            .dropDuplicates(["row_key", "node"]).select("node", "shingles"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One document of each class, all columns as they are: the one with the smallest id,
    of rows that share it the one with the smallest digest, of rows with the same id and text
    the one with the smallest hash of the whole row."""
    found = near_duplicates(docs, id_col, text_col, **how)
    first = found.where("kept").groupBy("class_key").agg(F.min("row_key").alias("first")).select("first")
    hashed = [docs[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString()]  # maps have no hash
    keyed = docs.select(row_digest(docs[id_col], docs[text_col]).alias("key"), F.xxhash64(*hashed).alias("hash"),
                        F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    one = keyed.groupBy("key").agg(F.min_by("row", "hash").alias("row"))
    return one.join(first, one["key"] == first["first"], "left_semi").select("row.*")
