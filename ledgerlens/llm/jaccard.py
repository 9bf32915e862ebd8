"""N-gram Jaccard join by chosen paths.

Sets are the distinct five-word shingles of whole texts (words: runs of
non-space characters, A-Z folded). A text of one to four words is one shingle;
a text without words, or a null text, has no set and links to nothing.

1. Equal sets are one class (exact copies are never paired with each other).
2. Each class has a signature of 64 minhashes: sampled tokens of its set, two
   classes sharing each with probability J. A run is a random tree: at every
   node the class goes down each coordinate with probability 1.25 / 64, to the
   child named by its minhash there (chosen path). Nodes with one class end;
   small ones are compared by brute force; large ones split again. A node that
   is still large at the last level holds classes that no token tells apart,
   or a very common token: it is compared in blocks, block against block.
3. Runs repeat until a pair at the threshold itself is found with probability
   ``recall`` (more similar pairs sooner).
4. Classes joined by likely pairs form candidate components (those of the first
   runs are found first, later runs tell only what joins them); in each, all pairs
   are checked exactly, by the sizes of intersections of whole sets. A
   component is checked in blocks of bounded rows and bytes, and only counts
   and a spanning forest leave a block, between two blocks only what joins
   different trees of theirs; never all pairs.
5. Links at or over the threshold make the groups (connected components).

Result: one row per document (repeated rows each get one): n_shingles, class_id
(smallest id of its group; its own where it links to nothing; null if the group
has no id), set_id (smallest id with an equal set), n_copies (documents of an
equal set, itself included), n_links (other documents at or over the threshold,
copies included), n_set_links (other classes), group_key (names the group: one
value for each, also where its documents have no id; null without a set).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm._spark import text_key, written
from ledgerlens.llm._text import NON_SPACE, chunks, column, mix, sums, windows, word_hashes, words
from ledgerlens.llm.components import components

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.99
COORDS = 64
SMALL = 64  # classes compared at once at a leaf
LEVELS = 4
FIRST_RUNS = 2  # runs whose components the others start from
BLOCK_ROWS, BLOCK_BYTES = 1024, 16 << 20  # of an exact check
SKETCH_SLACK = 0.2  # four standard deviations of 64 agreements at 0.8

_rng = np.random.default_rng(77)
_MUL = _rng.integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1, 1 << 63, COORDS, dtype=np.uint64)


def shingle_sets(data, off, k: int = SHINGLE):
    """The distinct shingle hashes of each row, sorted: (hashes, bounds)."""
    starts, ends, bounds = words(data, off, NON_SPACE)
    h = word_hashes(data, starts, ends)
    n = np.diff(bounds)
    w, _, row = windows(h, bounds, k)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.array([_whole(h[bounds[r]:bounds[r + 1]]) for r in short], np.uint64)
        w, row = np.concatenate([w, whole]), np.concatenate([row, short])
    order = np.lexsort((w, row))
    w, row = w[order], row[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (row[1:] != row[:-1])
    w, row = w[new], row[new]
    return w, np.searchsorted(row, np.arange(len(off)))


def _whole(h: np.ndarray) -> int:
    """Of a text shorter than a shingle: the hash of all its words."""
    place = np.arange(1, len(h) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(np.array([np.bitwise_xor.reduce(mix(h + place))], np.uint64))[0]


def set_keys(w: np.ndarray, bounds: np.ndarray):
    """Two 64-bit sums that name a set."""
    def total(x):
        c = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x, out=c[1:])
        return (c[bounds[1:]] - c[bounds[:-1]]).view(np.int64)
    return total(mix(w)), total(mix(w ^ np.uint64(0xA0761D6478BD642F)))


def signatures(w: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """rows with a set x COORDS minhashes (int32)."""
    at = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(at), COORDS), np.int32)
    for c in range(COORDS if len(at) else 0):
        v = ((w * _MUL[c] + _ADD[c]) >> np.uint64(32)).astype(np.uint32)
        out[:, c] = np.minimum.reduceat(v, at).view(np.int32)
    return out


def sign(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """(doc, key, k1, k2, n, sig): key tells texts of one id apart; k1, k2 name the set (null: none)."""
    part = docs.select(F.col(doc_id).alias("doc"), text_key(text).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc", docs.schema[doc_id].dataType),
                           *(T.StructField(c, T.LongType()) for c in ("key", "k1", "k2", "n")),
                           T.StructField("sig", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch, data, off in chunks(batches):
            w, b = shingle_sets(data, off, k)
            n = np.diff(b)
            k1, k2 = set_keys(w, b)
            none = n == 0
            ends = np.append(0, np.cumsum(~none)).astype(np.int32) * COORDS
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc"), column(batch, "key"), pa.array(k1, pa.int64(), mask=none),
                 pa.array(k2, pa.int64(), mask=none), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(signatures(w, b).ravel()))],
                names=schema.names)

    return part.mapInArrow(run, schema)


def survival(levels: int, threshold: float, width: float) -> float:
    """How likely a pair at the threshold still shares a node after so many levels."""
    p = 1.0
    for _ in range(levels):
        p = 1 - math.exp(-width * threshold * p)
    return p


def _children(node, salt: int, width: float):
    """Of a row with (node, sig): the children it goes to, by chosen coordinates."""
    pick = F.transform("sig", lambda v, i: F.struct(
        F.xxhash64(node, F.lit(salt), i).alias("at"), F.xxhash64(node, F.lit(salt), i, v).alias("child")))
    limit = int(width / COORDS * (1 << 53))
    return F.transform(F.filter(pick, lambda s: F.shiftrightunsigned(s["at"], 11) < limit), lambda s: s["child"])


def leaf_pairs(keys: np.ndarray, sketch: np.ndarray, need: int):
    """Index pairs of rows with equal keys (rows sorted by key) whose sketches
    agree in at least ``need`` coordinates; by distance, so no pair list of more
    than one distance is held."""
    d, here = 1, np.flatnonzero(keys[1:] == keys[:-1])
    while len(here):
        for a in range(0, len(here), 65536):
            i = here[a:a + 65536]
            ok = (sketch[i] == sketch[i + d]).sum(1) >= need
            yield i[ok], i[ok] + d
        d += 1
        here = here[here + d < len(keys)]
        here = here[keys[here] == keys[here + d]]


def _trees(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest vertex of each vertex's tree in a spanning forest of the pairs."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _forest(n: int, a: np.ndarray, b: np.ndarray):
    """Edges of a spanning forest of the pairs, as (vertex, smallest vertex of its tree)."""
    label = _trees(n, a, b)
    v = np.flatnonzero(label != np.arange(n))
    return v, label[v]


def _between(n: int, inner, outer, told: np.ndarray):
    """Edges of a unit of two blocks. The forest of pairs within a block (inner)
    is that of the block's own unit, told there only (``told``); of the pairs
    across (outer) only what joins different trees is told, so that a dense
    group leaves one edge a pair of blocks, not a forest of both."""
    tree = _trees(n, *inner)
    v, root = _forest(n, tree[outer[0]], tree[outer[1]])
    own = np.flatnonzero((tree != np.arange(n)) & told)
    return np.append(own, v), np.append(tree[own], root)


def _stream(batches, key: list[str]):
    """Tables of whole runs of equal keys (rows arrive sorted by key); several
    small runs come together."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        cols = [t.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in key]
        last = np.ones(t.num_rows, bool)
        for c in cols:
            last &= c == c[-1]
        cut = int(np.argmax(last))  # the last run may go on
        if cut:
            yield t.slice(0, cut)
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def _first_of(keys: np.ndarray, label: np.ndarray) -> np.ndarray:
    """For each row the first row of its key (rows sorted by key) with its label."""
    order = np.lexsort((label, keys))  # stable: the first row of a run is the smallest
    k, x = keys[order], label[order]
    new = np.append(True, (k[1:] != k[:-1]) | (x[1:] != x[:-1]))
    out = np.empty(len(keys), np.int64)
    out[order] = order[new][np.cumsum(new) - 1]
    return out


def _leaf_links(leaves: DataFrame, need: int) -> DataFrame:
    """Edges (a, b) between labels, from leaves (label, node, own, two, sk): of
    the likely pairs of a leaf what joins different labels, as a spanning forest."""
    def run(batches):
        for t in _stream(batches, ["node"]):
            label = t.column("label").to_numpy()
            keys = t.column("node").to_numpy()
            own, two = (t.column(c).to_numpy() for c in ("own", "two"))
            sk = t.column("sk").combine_chunks().flatten().to_numpy().reshape(-1, COORDS)
            first = _first_of(keys, label)
            none = np.zeros((2, 0), np.int64)
            inner, outer = [none], [none]
            for i, j in leaf_pairs(keys, sk, need):
                apart = first[i] != first[j]
                i, j = i[apart], j[apart]
                same = own[i] == own[j]
                i, j = first[i], first[j]
                inner.append(np.stack(_forest_of(len(label), i[same], j[same])))
                outer.append(np.stack(_forest_of(len(label), i[~same], j[~same])))
            v, root = _between(len(label), np.concatenate(inner, axis=1), np.concatenate(outer, axis=1), ~two)
            if len(v):
                yield pa.RecordBatch.from_arrays([pa.array(label[v]), pa.array(label[root])], names=["a", "b"])

    leaves = leaves.repartition("node").sortWithinPartitions("node")
    return leaves.mapInArrow(run, "a long, b long").distinct()


def _likely(classes: DataFrame, threshold: float, recall: float):
    """(edges of the first runs, their components, edges of the other runs), spanning
    the likely pairs of every leaf: classes that agree in enough minhashes. The
    other runs tell only what joins different components of the first ones, so
    that a dense group, which falls together in every run, leaves the edges of a
    few runs and not of all."""
    width = 1 / threshold
    runs = math.ceil(math.log(1 - recall) / math.log(1 - survival(LEVELS, threshold, width)))
    need = math.ceil((threshold - SKETCH_SLACK) * COORDS)
    small = classes.select("id", F.expr("transform(sig, x -> cast((x & 255) - 128 as tinyint))").alias("sk"))
    roots = F.transform(F.sequence(F.lit(1), F.lit(runs)), lambda r: F.struct(
        F.xxhash64(F.lit("run"), r).alias("node"), (r <= FIRST_RUNS).alias("early")))
    rows = classes.select("id", "sig", F.explode(roots).alias("r")).select("id", "sig", "r.node", "r.early")
    leaves = None
    for level in range(LEVELS):
        child = written(rows.select("id", "early", F.explode(_children(F.col("node"), level, width)).alias("node")),
                        f"jaccard-level{level}")
        # written, so that a node with very many rows can be split in the join
        size = written(child.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1"), f"jaccard-size{level}")
        child = child.join(size, "node")
        large = F.lit(level < LEVELS - 1) & (F.col("size") > SMALL)
        leaf = child.filter(~large)
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        rows = child.filter(large).select("id", "early", "node").join(classes.select("id", "sig"), "id")
    # a large node of the last level: block against block
    nb = F.ceil(F.col("size") / float(BLOCK_ROWS)).cast("int")
    own = F.pmod(F.xxhash64("id"), nb).cast("int")
    blocks = F.when(F.col("size") <= BLOCK_ROWS, F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi")))).otherwise(
        F.transform(F.sequence(F.lit(0), nb - 1), lambda j: F.struct(
            F.least(own, j).alias("lo"), F.greatest(own, j).alias("hi"))))
    own = F.when(F.col("size") <= BLOCK_ROWS, F.lit(0)).otherwise(own)
    leaves = (leaves.select("id", "early", "node", own.alias("own"), F.explode(blocks).alias("b"))
              .select("id", "early", "own", (F.col("b.lo") != F.col("b.hi")).alias("two"),
                      F.xxhash64("node", "b.lo", "b.hi").alias("node")))
    early = leaves.filter("early").join(small.withColumn("label", F.col("id")), "id")
    first = _leaf_links(early.select("label", "node", "own", "two", "sk"), need)
    prior = components(first, "jaccard-early")
    named = small.join(prior, F.col("id") == F.col("v"), "left").select("id", "sk", F.coalesce("label", "id").alias("label"))
    late = leaves.filter("not early").join(named, "id")
    return first, prior, _leaf_links(late.select("label", "node", "own", "two", "sk"), need)


def likely_links(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Edges (a, b) between class ids, spanning the likely pairs of every leaf."""
    first, _, late = _likely(classes, threshold, recall)
    return first.unionByName(late)


def likely_groups(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(v, label): the components of :func:`likely_links`."""
    _, prior, late = _likely(classes, threshold, recall)
    top = components(late, "jaccard-likely")
    of = top.select(F.col("v").alias("label"), F.col("label").alias("__top"))
    return (prior.join(of, "label", "left").select("v", F.coalesce("__top", "label").alias("label"))
            .unionByName(top.join(prior, "v", "left_anti")))


def _forest_of(n, i, j):
    return (i, j) if len(i) < 4096 else _forest(n, i, j)


def _intersections(w: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Sizes of the intersections of all pairs of n sets, from (hash, row)."""
    order = np.argsort(w, kind="stable")
    w, row = w[order], row[order]
    new = np.append(True, w[1:] != w[:-1])
    group = np.cumsum(new) - 1
    shared = np.bincount(group) > 1
    keep = shared[group]
    group, row = (np.cumsum(shared) - 1)[group[keep]], row[keep]
    out = np.zeros((n, n), np.float32)
    width = max(256, (8 << 20) // max(n, 1))
    for a in range(0, int(group[-1]) + 1 if len(group) else 0, width):
        x, y = np.searchsorted(group, [a, a + width])
        m = np.zeros((n, min(width, int(group[-1]) + 1 - a)), np.float32)
        m[row[x:y], group[x:y] - a] = 1
        out += m @ m.T
    return out


def exact_links(members: DataFrame, threshold: float) -> DataFrame:
    """members: (comp, id, copies, hashes), one row a class, hashes the sorted
    set as 8-byte words. Result: (id, partner, links, sets): rows with a partner
    are edges of spanning forests; rows without one are counts of links."""
    size = members.groupBy("comp").agg(F.count("*").alias("size"), F.sum(F.length("hashes")).alias("bytes"))
    m = members.join(size, "comp")
    nb = F.greatest(F.ceil(F.col("size") / float(BLOCK_ROWS)), F.ceil(F.col("bytes") / float(BLOCK_BYTES))).cast("int")
    own = F.pmod(F.xxhash64("id"), nb).cast("int")
    m = m.select("comp", "id", "copies", "hashes", own.alias("own"), F.explode(F.sequence(F.lit(0), nb - 1)).alias("j"))
    m = (m.select("comp", "id", "copies", "hashes", "own", F.least("own", "j").alias("lo"), F.greatest("own", "j").alias("hi"))
         .withColumn("unit", F.xxhash64("comp", "lo", "hi")))
    m = m.drop("comp").repartition("unit").sortWithinPartitions("unit")

    def pairs(t: pa.Table):
        ids, copies, own = (t.column(c).to_numpy() for c in ("id", "copies", "own"))
        sets = [np.frombuffer(x, np.uint64) for x in t.column("hashes").to_pylist()]
        n = np.array([len(s) for s in sets])
        both = _intersections(np.concatenate(sets), np.repeat(np.arange(len(n)), n), len(n))
        linked = both >= threshold * (n[:, None] + n[None, :] - both) - 1e-6
        np.fill_diagonal(linked, False)
        across = own[:, None] != own[None, :]
        two = t.column("lo")[0].as_py() != t.column("hi")[0].as_py()
        v, root = _between(len(n), np.nonzero(np.triu(linked & ~across)), np.nonzero(np.triu(linked & across)),
                           np.full(len(n), not two))
        if two:
            linked &= across  # pairs of one block have a unit of their own
        hit = np.flatnonzero(linked.any(1))
        return (np.concatenate([ids[hit], ids[v]]), np.concatenate([np.zeros(len(hit), np.int64), ids[root]]),
                np.concatenate([np.zeros(len(hit), bool), np.ones(len(v), bool)]),
                np.concatenate([linked[hit] @ copies, np.zeros(len(v), np.int64)]),
                np.concatenate([linked[hit].sum(1), np.zeros(len(v), np.int64)]))

    def run(batches):
        for t in _stream(batches, ["unit"]):
            unit = t.column("unit").to_numpy()
            cut = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            got = [pairs(t.slice(a, b - a)) for a, b in zip(cut, np.append(cut[1:], len(unit))) if b - a > 1]
            if got:
                ids, partner, edge, links, sets = (np.concatenate(x) for x in zip(*got))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(partner, pa.int64(), mask=~edge), pa.array(links, pa.int64()),
                     pa.array(sets, pa.int64())], names=["id", "partner", "links", "sets"])

    return m.mapInArrow(run, "id long, partner long, links long, sets long")


def whole_sets(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """(k1, k2, hashes) of each row: its whole set, sorted, as 8-byte words."""
    def run(batches):
        for _, data, off in chunks(batches):
            w, b = shingle_sets(data, off, k)
            k1, k2 = set_keys(w, b)
            buf = pa.py_buffer(w.tobytes())
            hashes = pa.Array.from_buffers(pa.binary(), len(k1), [None, pa.py_buffer((b * 8).astype(np.int32).tobytes()), buf])
            yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), hashes], names=["k1", "k2", "hashes"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "k1 long, k2 long, hashes binary")


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE,
                 threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, text_key, n_shingles, class_id, set_id, n_copies, n_links, n_set_links, group_key) per document."""
    signed = written(sign(docs, doc_id, text, k), "jaccard-signed")
    classes = written(
        signed.filter("k1 is not null").groupBy("k1", "k2")
        .agg(F.min(F.struct("doc", "key")).alias("rep"), F.min("doc").alias("set_id"), F.count("*").alias("copies"),
             F.first("sig").alias("sig"))
        .withColumn("id", F.xxhash64("k1", "k2")), "jaccard-classes")
    groups = likely_groups(classes, threshold, recall)
    chosen = groups.join(classes, F.col("v") == F.col("id")).select(
        F.col("label").alias("comp"), "id", "k1", "k2", "copies", "rep")
    reps = chosen.select(F.col("rep.doc").alias("__doc"), F.col("rep.key").alias("__key")).distinct()
    d = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"), text_key(text).alias("key"))
    d = d.join(reps, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("key") == F.col("__key")), "left_semi")
    sets = whole_sets(d, "doc", "text", k).dropDuplicates(["k1", "k2"])
    found = written(exact_links(chosen.join(sets, ["k1", "k2"]).select("comp", "id", "copies", "hashes"), threshold),
                    "jaccard-links")
    counts = (found.filter("partner is null").groupBy("id")
              .agg(F.sum("links").alias("links"), F.sum("sets").alias("sets")))
    linked = components(found.filter("partner is not null").select(F.col("id").alias("a"), F.col("partner").alias("b")),
                        "jaccard-groups")
    named = classes.join(counts, "id", "left").join(linked, F.col("id") == F.col("v"), "left").select(
        "id", "k1", "k2", "set_id", "copies", "links", "sets", F.coalesce("label", "id").alias("label"))
    first = named.groupBy("label").agg(F.min("set_id").alias("class_id"))
    named = named.join(first, "label").drop("id")
    out = signed.select("doc", "key", "k1", "k2", "n").join(named, ["k1", "k2"], "left")
    alone = F.col("k1").isNull()
    return out.select(
        F.col("doc").alias(doc_id), F.col("key").alias("text_key"), F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc")).otherwise(F.col("set_id")).alias("set_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        F.coalesce("sets", F.lit(0)).alias("n_set_links"), F.col("label").alias("group_key"))
