"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds its distinct ``words``-word shingles (A-Z lower-cased; a shorter text is
one shingle).  Documents with Jaccard similarity of at least ``percent`` hundredths are linked and a
class is what links connect; the smallest id stays.

Method:
1. Every set becomes a sketch: eight minwise tokens a tree (the shingle that is least under an own hash
   function), and ``BYTES`` minwise values cut to a byte.  Equal sets are one vertex from here on.
2. ``trees`` independent trees branch the vertices by selected minwise tokens: a node's vertices
   go to one child for each of two coordinates and each token found there.  Two sets with similarity J meet
   in a given child with probability J.  A level's two coordinates are the same in all branches, so a pair
   survives a level with 1 - (1 - J)**2 and meets four levels deep with the fourth power of that: at 0.85 four trees
   miss it with 6e-5, at 0.80 four trees with 5e-4 and eight with 3e-7.
3. Nodes of at most ``limit`` vertices are compared exhaustively by their byte sketches; larger ones
   branch on.  What is still larger after the last level is compared block by block, so nothing is dropped.
4. A node passes on a spanning forest of its likely pairs, best first.  These are confirmed on the full
   sets and joined to components.  Then the nodes are compared again: a vertex that has a likely partner in another
   component is sent with its full set to a group of its node's open vertices, and the group's task tests every
   likely pair between two components on the sets themselves.  Only links that join components leave the task, fewer
   than its vertices; pairs within one component need no test: they add nothing.

Sets are recomputed only for vertices with a likely partner: a bitmap of fixed size picks their
documents from the table, so the other texts are not shuffled.

Defined cases: no words or null text: empty set, own class, kept.  A row with a null id is not
linked (component_id null) and kept.  Repeated rows share a class; rows of the kept id are all kept.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_slices, discard, materialize, text_or_empty, tidy, utf8
from strata.llm.components import components

TREES, BYTES = 8, 512  # the most trees, and the byte values
LEVELS = 4  # two coordinates a level and tree
_RNG = np.random.default_rng(0xC0FFEE)
COORD_MUL = _RNG.integers(0, 1 << 63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
COORD_XOR = _RNG.integers(0, 1 << 63, 32, dtype=np.uint64)
BYTE_MUL = (_RNG.integers(0, 1 << 31, BYTES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))
BYTE_XOR = _RNG.integers(0, 1 << 32, BYTES, dtype=np.uint32)
_MORE = TREES * LEVELS * 2 - 32
COORD_MUL = np.concatenate([COORD_MUL, _RNG.integers(0, 1 << 63, _MORE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])
COORD_XOR = np.concatenate([COORD_XOR, _RNG.integers(0, 1 << 63, _MORE, dtype=np.uint64)])


def sketch(s: np.ndarray, trees: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Minwise tokens (int64) and minwise bytes of a non-empty set of 64-bit shingles."""
    low = (s >> np.uint64(32)).astype(np.uint32)
    coords = trees * LEVELS * 2
    best = np.full(coords, np.iinfo(np.uint64).max, np.uint64)
    bytes_ = np.full(BYTES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(s), 1024):
        part = (s[i:i + 1024, None] ^ COORD_XOR[:coords]) * COORD_MUL[:coords]
        np.minimum(best, part.min(0), out=best)
        few = (low[i:i + 1024, None] ^ BYTE_XOR) * BYTE_MUL
        np.minimum(bytes_, few.min(0), out=bytes_)
    # least bits decide nothing about the order of the hash: mixed before cutting to a byte
    cut = ((bytes_ * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
    return best.view(np.int64), cut


def sketcher(words: int, slice_bytes: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        from strata.llm.wordblocks import Words
        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                sets = Words(utf8(part, "text"), lower=True).shingles(words)
                made = [sketch(s, trees) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_md5"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets], pa.string()),
                     pa.array([m[0].tolist() if m else None for m in made], pa.list_(pa.int64())),
                     pa.array([m[1].tobytes() if m else None for m in made], pa.binary())],
                    names=["doc_id", "text_md5", "n", "digest", "coords", "bytes"])

    return tidy(run)


def set_reader(words: int, slice_bytes: int, bits):
    """(doc_id, digest, shingles) of the rows whose ``slot`` is marked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        from strata.llm.wordblocks import Words
        marked = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            wanted = batch.filter(pa.array((marked[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1))
            for part in byte_slices(wanted, "text", slice_bytes):
                sets = Words(utf8(part, "text"), lower=True).shingles(words)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets], pa.string()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "digest", "shingles"])

    return tidy(run)


def _likely(sk: np.ndarray, n: np.ndarray, rows: np.ndarray, percent: int, cut: float):
    """Likely pairs (i, j) of ``rows`` x all members with i < j, and their estimates."""
    out = []
    for i in range(0, len(rows), 32):
        at = rows[i:i + 32]
        same = np.stack([(sk[a] == sk).sum(1, dtype=np.int32) for a in at])
        est = (same / BYTES - 1 / 256) / (1 - 1 / 256)
        ok = (est >= cut) & (100 * np.minimum(n[at, None], n) >= percent * np.maximum(n[at, None], n))
        a, b = np.nonzero(ok)
        keep = at[a] < b
        out.append((at[a][keep], b[keep], est[a[keep], b[keep]]))
    if not out:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def forest(i: np.ndarray, j: np.ndarray, est: np.ndarray, size: int) -> list[int]:
    """Numbers of the pairs of a spanning forest, likeliest pairs first."""
    parent = list(range(size))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    taken = []
    for k in np.lexsort((j, i, -est)):
        a, b = root(int(i[k])), root(int(j[k]))
        if a != b:
            parent[b] = a
            taken.append(int(k))
    return taken


def _sketches(members: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(members.field("bytes").to_pylist()), np.uint8).reshape(-1, BYTES)


def comparer(percent: int, cut: float):
    """Groups of at most two blocks of vertices to a spanning forest of their likely pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for members in batch.column("members"):
                ms = members.values
                node, n = ms.field("node").to_numpy(), ms.field("n").to_numpy()
                i, j, est = _likely(_sketches(ms), n, np.arange(len(node)), percent, cut)
                pick = forest(i, j, est, len(node))
                left.append(np.minimum(node[i[pick]], node[j[pick]]))
                right.append(np.maximum(node[i[pick]], node[j[pick]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in (left, right)], names=["a", "b"])

    return tidy(run)


def open_vertices(percent: int, cut: float):
    """Groups with labels to (key, node) of the vertices that have a likely partner with another label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes = [], []
            for key, members in zip(batch.column("key").to_pylist(), batch.column("members")):
                ms = members.values
                node, n, label = (ms.field(c).to_numpy() for c in ("node", "n", "label"))
                i, j, _ = _likely(_sketches(ms), n, np.arange(len(node)), percent, cut)
                apart = label[i] != label[j]
                nodes.append(node[np.union1d(i[apart], j[apart])])
                keys.append(np.full(len(nodes[-1]), key, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in (keys, nodes)], names=["key", "node"])

    return tidy(run)


def _joining_links(sk: np.ndarray, n: np.ndarray, label: np.ndarray, sets: list[np.ndarray], percent: int,
                   cut: float) -> list[tuple[int, int]]:
    """Linked pairs that join the labels' components; every likely pair between two components is tested on the sets
    (as local numbers), so the links left out join nothing."""
    label, out = label.copy(), []
    mark = np.zeros(max(int(s.max()) for s in sets) + 1, bool)
    for a in range(len(sets) - 1):
        _, j, _ = _likely(sk[a:], n[a:], np.zeros(1, int), percent, cut)
        j = j + a
        j = j[label[j] != label[a]]
        if not len(j):
            continue
        mark[sets[a]] = True
        hits = mark[np.concatenate([sets[b] for b in j])]
        mark[sets[a]] = False
        common = np.add.reduceat(hits, np.concatenate([[0], np.cumsum(n[j])[:-1]]), dtype=np.int64)
        for b in j[100 * common >= percent * (n[a] + n[j] - common)]:
            if label[a] != label[b]:
                out.append((a, int(b)))
                label[label == label[b]] = label[a]
    return out


def verifier(percent: int, cut: float):
    """Groups of open vertices with labels and full sets to links (a, b) between components, fewer than the vertices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for members in batch.column("members"):
                ms = members.values
                node, n, label = (ms.field(c).to_numpy() for c in ("node", "n", "label"))
                local = np.unique(ms.field("shingles").flatten().to_numpy(), return_inverse=True)[1]
                sets = np.split(local, np.cumsum(n)[:-1])
                for a, b in _joining_links(_sketches(ms), n, label, sets, percent, cut):
                    left.append(min(node[a], node[b]))
                    right.append(max(node[a], node[b]))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (left, right)], names=["a", "b"])

    return tidy(run)


def in_blocks(rows: DataFrame, size, limit: int) -> DataFrame:
    """(key, node) with every key of more than ``limit`` of ``size`` dealt to blocks of its members, each of which
    meets every other block of the key: no pair is lost and no group holds more than about two blocks."""
    blocks = F.ceil(size / limit).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = (rows.withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return dealt.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "node")


def tree_nodes(vertices: DataFrame, trees: int, limit: int) -> DataFrame:
    """(key, node): the vertices of every node to compare; no key has more than 2 * ``limit`` rows."""
    def child(level: int, tree, parent=None):
        first = (tree * LEVELS + level) * 2
        two = F.array(*[F.struct(tree.alias("tree"), F.xxhash64(
            *([parent] if parent is not None else []), tree, F.lit(level), F.lit(k),
            F.element_at("coords", (first + k + 1).cast("int"))).alias("key")) for k in (0, 1)])
        return F.explode(two)

    roots = vertices.select("node", "coords", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    rows = roots.select("node", child(0, F.col("tree")).alias("c")).select("node", "c.tree", "c.key")
    done = []
    for level in range(LEVELS):
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = materialize(rows.join(sizes, "key"), f"near-level{level}")
        done.append(sized.where(F.col("size") <= limit).select("key", "node"))
        large = sized.where(F.col("size") > limit)
        if large.isEmpty():
            break
        if level + 1 < LEVELS:
            rows = (large.join(vertices.select("node", "coords"), "node")
                    .select("node", child(level + 1, F.col("tree"), F.col("key")).alias("c")).select("node", "c.tree", "c.key"))
        else:  # every block of members meets every other block
            done.append(in_blocks(large, F.col("size"), limit))
    return reduce(DataFrame.unionByName, done)


def marked_slots(ids: DataFrame, slot, log2_bits: int) -> bytes:
    """A bitmap of 2**log2_bits bits, one set for every id's slot; its size does not depend on the ids."""
    words = (ids.select(slot.alias("slot")).groupBy(F.floor(F.col("slot") / 32768).alias("word"))
             .agg(F.bitmap_construct_agg((F.col("slot") % 32768)).alias("bits")).collect())
    out = bytearray(1 << (log2_bits - 3))
    for r in words:
        out[r["word"] * 4096:(r["word"] + 1) * 4096] = r["bits"]
    return bytes(out)


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 85,
                 trees: int = 4, limit: int = 2048, margin: float = 0.06, slice_bytes: int = 1 << 20,
                 log2_bits: int = 26, set_limit: int = 1 << 20) -> DataFrame:
    """One row per document row: doc_id, text_md5, n_shingles, component_id, kept.  ``set_limit`` shingles make a block
    of the second pass."""
    if not 1 <= trees <= TREES:
        raise ValueError(f"trees: 1 to {TREES}")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.md5(text_or_empty(F.col(text_col))).alias("text_md5"))
    sketches = materialize(rows.mapInArrow(sketcher(words, slice_bytes, trees),
                                           "doc_id long, text_md5 string, n long, digest string, coords array<long>, bytes binary"), "near-sketch")
    linkable = F.col("digest").isNotNull() & F.col("doc_id").isNotNull()
    vertices = materialize(
        sketches.where(linkable).groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("coords").alias("coords"), F.first("bytes").alias("bytes"))
        .withColumn("node", F.monotonically_increasing_id()), "near-vertices")
    members_of = materialize(sketches.select("doc_id", "text_md5", "n", "digest"), "near-digests")
    discard(sketches)
    nodes = materialize(tree_nodes(vertices, trees, limit), "near-nodes")

    def groups(rows: DataFrame, fields: list[str]) -> DataFrame:
        return (rows.groupBy("key").agg(F.collect_list(F.struct(*fields)).alias("members"))
                .where(F.size("members") > 1))

    sketched = nodes.join(vertices.select("node", "n", "bytes"), "node")
    likely = percent / 100 - margin
    first = materialize(groups(sketched, ["node", "n", "bytes"]).select("members").mapInArrow(comparer(percent, likely), "a long, b long").distinct(), "near-first")
    touched = first.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialize(vertices.select("node", "rep", F.col("digest").alias("own")).join(touched, "node"), "near-touched")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << log2_bits))
    bits = spark.sparkContext.broadcast(marked_slots(wanted.select(F.col("rep").alias("doc_id")), slot, log2_bits))
    read = rows.select("doc_id", "text", slot.alias("slot")).mapInArrow(set_reader(words, slice_bytes, bits),
                                                   "doc_id long, digest string, shingles array<long>")
    sets = materialize(read.join(wanted, (F.col("doc_id") == F.col("rep")) & (F.col("digest") == F.col("own")))
                       .select("node", "shingles").dropDuplicates(["node"]), "near-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        one, two = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
        both = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
        return (both.where(100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b"))

    links = materialize(confirmed(first), "near-links")
    found = components(links)
    labels = materialize(wanted.select("node").join(found, "node", "left")
                         .select("node", F.coalesce("label", "node").alias("label")), "near-labels")
    # a vertex without links of any kind has no label and needs none
    several = sketched.join(labels, "node")
    apart = groups(several, ["node", "n", "bytes", "label"]).where(F.array_min("members.label") < F.array_max("members.label"))
    waiting = materialize(apart.mapInArrow(open_vertices(percent, likely), "key long, node long"), "near-open")
    shingles = waiting.join(vertices.select("node", "n"), "node").groupBy("key").agg(F.sum("n").alias("size"))
    dealt = (in_blocks(waiting.join(shingles, "key"), F.col("size"), set_limit).join(vertices.select("node", "n", "bytes"), "node")
             .join(labels, "node").join(sets, "node"))
    more = materialize(groups(dealt, ["node", "n", "bytes", "label", "shingles"]).select("members")
                       .mapInArrow(verifier(percent, likely), "a long, b long").distinct(), "near-more")
    if not more.isEmpty():
        found = components(links.unionByName(more))
    named = materialize(vertices.select("node", "digest", "rep"), "near-names")
    discard(vertices, nodes, sets)
    classes = named.join(found, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    smallest = classes.groupBy("label").agg(F.min("rep").alias("component"))
    by_digest = classes.join(smallest, "label").select(F.col("digest").alias("own"), "component")
    out = members_of.join(by_digest, F.col("digest") == F.col("own"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "text_md5", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
