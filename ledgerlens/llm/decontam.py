"""Benchmark decontamination by a distributed positional inverted index.

Index: documents are read in segments of a few MB. Of each segment every term
(words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are folded, known by 64
hash bits) is stored with its posting list: its word positions in the segment,
ascending, as variable-length byte differences. A frequent term is spread over
all segments, so no list grows with the corpus. The index is a table in the
shared folder; the search reads nothing else.

Search: a benchmark item's windows are its runs of ``WORDS`` consecutive words
(an item of fewer, but not none, is one window). Every window is anchored at
its ``misses + 1`` terms that are rarest in the whole corpus (a term that occurs
nowhere is a miss and needs no anchor; a short window has one), and goes only to
segments that hold one of them: any match with at most ``misses`` misses holds
one. There the offset-adjusted posting lists are intersected from the rarest
term on. A place of a document where all lists meet is an exact phrase; one
where at most ``misses`` terms lie further than ``slop`` words from their place
(or outside the document) is a proximity match, reported apart.

Result: a row per document (repeated rows each get one): n_words, n_hit (words
inside any occurrence of a window), n_items and item_ids of exact matches,
n_near_items of items met by proximity only. Null and empty texts have no
words. An item without words matches nothing; items of equal text all match;
null item ids are left out of item_ids but hit words count. An empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm._spark import text_key, written
from ledgerlens.llm._text import ALNUM, CHUNK_BYTES, chunks, column, mix, word_hashes, words

WORDS = 10
SEGMENT_BYTES = 2 * CHUNK_BYTES
MISSES, SLOP = 2, 2
CANDIDATES = 1 << 19  # places looked at together within a segment


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned integers as 7-bit groups, low first, the last with its high bit
    set: (bytes, number of bytes of each)."""
    v = values.astype(np.uint64)
    size = 1 + (v >= 1 << 7).astype(np.int64) + (v >= 1 << 14) + (v >= 1 << 21) + (v >= 1 << 28)
    end = np.cumsum(size)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    at, todo, left = end - size, np.arange(len(v)), size.copy()
    while len(todo):
        last = left[todo] == 1
        out[at[todo]] = (v[todo] & np.uint64(127)).astype(np.uint8) | (last.astype(np.uint8) << 7)
        todo = todo[~last]
        v[todo] >>= np.uint64(7)
        left[todo] -= 1
        at[todo] += 1
    return out, size


def decode(data: np.ndarray) -> np.ndarray:
    stop = np.flatnonzero(data >= 128)
    size = np.diff(stop, prepend=-1)
    start = stop - size + 1
    v = np.zeros(len(stop), np.int64)
    for k in range(int(size.max()) if len(size) else 0):
        on = size > k
        v[on] |= (data[start[on] + k] & 127).astype(np.int64) << (7 * k)
    return v


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A written table. Rows with a term: (segment, term, n, post); rows without:
    documents, (segment, at, doc, key, n: words, first: position of the first)."""
    part = docs.select(F.col(doc_id).alias("doc"), text_key(text).alias("key"), F.col(text).alias("text"),
                       F.spark_partition_id().alias("part"))
    doc_type = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("segment", T.LongType()), T.StructField("term", T.LongType()),
                           T.StructField("n", T.LongType()), T.StructField("post", T.BinaryType()),
                           T.StructField("at", T.LongType()), T.StructField("doc", doc_type),
                           T.StructField("key", T.LongType()), T.StructField("first", T.LongType())])

    def run(batches):
        seen = 0
        for batch, data, off in chunks(batches, limit=SEGMENT_BYTES):
            segment = (column(batch, "part")[0].as_py() << 32) + seen
            seen += 1
            starts, ends, bounds = words(data, off, ALNUM)
            h = word_hashes(data, starts, ends).view(np.int64)
            order = np.argsort(h, kind="stable")
            h = h[order]
            cut = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
            gaps = np.diff(order, prepend=0)
            gaps[cut] = order[cut]
            post, size = encode(gaps)
            ptr = np.append(0, np.cumsum(size))[np.append(cut, len(h))].astype(np.int32)
            t, d = len(cut), batch.num_rows
            lists = pa.Array.from_buffers(pa.binary(), t, [None, pa.py_buffer(ptr.tobytes()), pa.py_buffer(post.tobytes())])
            no = lambda k, kind: pa.nulls(k, kind)
            at = np.arange(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(t, segment)), pa.array(h[cut]), pa.array(np.diff(np.append(cut, len(h)))), lists,
                 no(t, pa.int64()), no(t, column(batch, "doc").type), no(t, pa.int64()), no(t, pa.int64())], names=schema.names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, segment)), no(d, pa.int64()), pa.array(np.diff(bounds)), no(d, pa.binary()),
                 pa.array(at), column(batch, "doc"), column(batch, "key"), pa.array(bounds[:-1])], names=schema.names)

    return written(part.mapInArrow(run, schema), "decontam-index")


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WORDS) -> DataFrame:
    """(item, w, terms): a row for each item and window; terms: 8-byte words; w names the window."""
    part = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))

    def run(batches):
        for batch, data, off in chunks(batches):
            starts, ends, bounds = words(data, off, ALNUM)
            h = word_hashes(data, starts, ends)
            n = np.diff(bounds)
            row = np.repeat(np.arange(len(n)), np.where(n < size, np.minimum(n, 1), n - size + 1))
            if not len(row):
                continue
            first = bounds[row] + np.arange(len(row)) - np.searchsorted(row, row)
            length = np.minimum(n[row], size)
            terms = [h[a:a + k] for a, k in zip(first, length)]
            names = [int(mix(np.array([np.bitwise_xor.reduce(mix(t + np.arange(1, len(t) + 1, dtype=np.uint64)
                                                               * np.uint64(0x9E3779B97F4A7C15)))], np.uint64)).view(np.int64)[0])
                     for t in terms]
            yield pa.RecordBatch.from_arrays([column(batch, "item").take(pa.array(row)), pa.array(names, pa.int64()),
                                              pa.array([t.tobytes() for t in terms], pa.binary())],
                                             names=["item", "w", "terms"])

    return part.mapInArrow(run, "item string, w long, terms binary")


def anchored(windows: DataFrame, index: DataFrame, misses: int = MISSES) -> DataFrame:
    """(w, terms, off, term): a row for each anchor of the windows that can match, and its place."""
    w = windows.select("w", "terms").dropDuplicates(["w"])

    def run(batches):
        for batch in batches:
            terms = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            n = [len(t) for t in terms]
            if n:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(np.concatenate(terms)),
                     pa.array(np.concatenate([np.arange(k) for k in n])), pa.array(np.repeat(n, n))],
                    names=["w", "term", "off", "size"])

    terms = written(w.mapInArrow(run, "w long, term long, off long, size long"), "decontam-terms")
    df = (index.filter("term is not null").join(terms.select("term").distinct(), "term", "left_semi")
          .groupBy("term").agg(F.sum("n").alias("df")))
    # at most WORDS terms a window; a short one must match as a phrase
    best = (terms.join(df, "term").groupBy("w", "size")
            .agg(F.sort_array(F.collect_list(F.struct("df", "off", "term"))).alias("there"))
            .withColumn("spare", F.when(F.col("size") == WORDS, misses).otherwise(0) - F.col("size") + F.size("there"))
            .filter("spare >= 0").select("w", F.explode(F.slice("there", F.lit(1), (F.col("spare") + 1).cast("int"))).alias("a"))
            .select("w", F.col("a.off").alias("off"), F.col("a.term").alias("term")))
    return written(w.join(best, "w"), "decontam-windows")


def _search(postings: pa.Table, wins: pa.Table, misses: int, slop: int, first: np.ndarray, last: np.ndarray):
    """Matches within a segment: (row of wins, position, document, exact).
    first, last: where the documents with words begin and end."""
    lists = postings.filter(pc.is_valid(postings.column("term"))).sort_by("term")
    term = lists.column("term").to_numpy()
    size = lists.column("n").to_numpy()
    ptr = np.append(0, np.cumsum(size))
    gaps = decode(np.frombuffer(b"".join(lists.column("post").to_pylist()), np.uint8))
    total = np.cumsum(gaps)
    base = total[ptr[:-1]] - gaps[ptr[:-1]]
    pos = total - np.repeat(base, size)
    keyed = (np.repeat(np.arange(len(term)), size) << 32) + pos
    terms = [np.frombuffer(x, np.int64) for x in wins.column("terms").to_pylist()]
    length = np.array([len(t) for t in terms])
    wide = int(length.max())
    ids = np.full((len(terms), wide), -1, np.int64)
    flat = np.concatenate(terms)
    at = np.minimum(np.searchsorted(term, flat), len(term) - 1)
    ids[np.arange(wide)[None, :] < length[:, None]] = np.where(term[at] == flat, at, -1)
    here = ids >= 0
    anchor = wins.column("off").to_numpy()
    cost = np.where(here, size[ids], 0)  # an absent term is a miss at once
    cost[np.arange(wide)[None, :] >= length[:, None]] = 1 << 40
    cost[np.arange(len(terms)), anchor] = -1
    order = np.argsort(cost, axis=1, kind="stable")
    anchors = ids[np.arange(len(terms)), anchor]
    spare = np.where(length == WORDS, misses, 0)  # a short window must match as a phrase
    absent = ((ids < 0) & (np.arange(wide)[None, :] < length[:, None])).sum(1)
    many = np.where(absent <= spare, size[anchors], 0)
    ends = np.cumsum(many)

    def away(win, start, doc, o):
        """How far the nearest place of each window's term o in the document is from where it should be."""
        t = ids[win, o]
        lo, hi = first[doc], last[doc]
        goal = np.clip(start + o, lo, hi - 1)
        base = np.maximum(t, 0) << 32
        x = np.searchsorted(keyed, base + goal)
        up = keyed[np.minimum(x, len(keyed) - 1)] - base
        down = keyed[np.maximum(x - 1, 0)] - base
        up = np.where((t >= 0) & (up >= lo) & (up < hi), np.abs(up - goal), 1 << 30)
        return np.minimum(up, np.where((t >= 0) & (down >= lo) & (down < hi), np.abs(goal - down), 1 << 30))

    a = 0
    while a < len(terms):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CANDIDATES, "right")))
        win = np.repeat(np.arange(a, b), many[a:b])
        k = np.arange(len(win)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
        start = pos[ptr[anchors[win]] + k] - anchor[win]
        doc = np.searchsorted(first, start + anchor[win], "right") - 1
        # the anchor may lie off its place itself, so its place is found up to slop and the others up to twice that
        exact = (start >= first[doc]) & (start + length[win] <= last[doc])
        missed = np.zeros(len(win), np.int8)
        for j in range(1, wide):
            far = away(win, start, doc, order[win, j])
            on = j < length[win]
            exact &= (far == 0) | ~on
            missed += ((far > 2 * slop) & on).astype(np.int8)
            keep = exact | ((missed <= misses) & (length[win] == WORDS))
            win, start, doc, missed, exact = win[keep], start[keep], doc[keep], missed[keep], exact[keep]
        keep = exact | (length[win] == WORDS)
        win, start, doc, exact = win[keep], start[keep], doc[keep], exact[keep]
        yield win[exact], start[exact], doc[exact], exact[exact]
        win, start, doc = win[~exact], start[~exact], doc[~exact]
        for shift in range(-slop, slop + 1):
            ok = (start + shift >= first[doc]) & (start + shift + length[win] <= last[doc])
            w, at, d = win[ok], start[ok] + shift, doc[ok]
            missed = np.zeros(len(w), np.int8)
            for j in range(wide):
                missed += ((away(w, at, d, order[w, j]) > slop) & (j < length[w])).astype(np.int8)
                keep = missed <= misses
                w, at, d, missed = w[keep], at[keep], d[keep], missed[keep]
            yield w, at, d, np.zeros(len(w), bool)
        a = b


def find(index: DataFrame, windows: DataFrame, misses: int = MISSES, slop: int = SLOP) -> DataFrame:
    """(segment, at, n_hit, w, exact): a row without w for each document hit, and
    a row for each document and window it matches."""
    wins = anchored(windows, index, misses)
    placed = written(index.filter("term is not null").select("segment", "term").join(wins, "term")
                     .select("segment", "w", "terms", "off"), "decontam-placed")
    there = placed.select("segment").distinct()
    needed = written(wins.mapInArrow(_all_terms, "term long").distinct(), "decontam-needed")
    lists = index.filter("term is not null").select("segment", "term", "n", "post").join(needed, "term", "left_semi")
    rows = index.filter("term is null").select("segment", "at", "n", "first")
    both = (lists.select("segment", "term", "n", "post", F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("first"))
            .unionByName(rows.select("segment", F.lit(None).cast("long").alias("term"), "n", F.lit(None).cast("binary").alias("post"),
                                     "at", "first")).join(there, "segment", "left_semi"))

    def run(postings: pa.Table, wins: pa.Table) -> pa.Table:
        rows = postings.filter(pc.is_null(postings.column("term"))).sort_by("at")
        first, n, at = (rows.column(c).to_numpy() for c in ("first", "n", "at"))
        total = int((first + n).max()) if len(n) else 0
        covered, found = np.zeros(total + 1, np.int32), []
        names = wins.column("w").to_numpy()
        length = np.array([len(x) // 8 for x in wins.column("terms").to_pylist()])
        if postings.num_rows > rows.num_rows and wins.num_rows:
            full = np.flatnonzero(n > 0)
            for win, start, doc, exact in _search(postings, wins, misses, slop, first[full], (first + n)[full]):
                row = full[doc]
                np.add.at(covered, start[exact], 1)
                np.add.at(covered, (start + length[win])[exact], -1)
                found.append(np.unique(np.stack([row, win, exact]), axis=1))
        row, win, exact = (np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((3, 0))).astype(np.int64)
        hit = np.append(0, np.cumsum(np.cumsum(covered[:-1]) > 0))
        n_hit = hit[first + n] - hit[first]
        docs = np.flatnonzero(n_hit)
        segment = postings.column("segment")[0].as_py()
        return pa.table({
            "segment": pa.array(np.full(len(docs) + len(row), segment), pa.int64()),
            "at": pa.array(np.concatenate([at[docs], at[row]]), pa.int64()),
            "n_hit": pa.array(np.concatenate([n_hit[docs], np.zeros(len(row), np.int64)]), pa.int64()),
            "w": pa.array(np.concatenate([np.zeros(len(docs), np.int64), names[win]]), pa.int64(),
                          mask=np.arange(len(docs) + len(row)) < len(docs)),
            "exact": pa.array(np.concatenate([np.ones(len(docs), np.int64), exact]).astype(bool))})

    return both.groupBy("segment").cogroup(placed.groupBy("segment")).applyInArrow(
        run, "segment long, at long, n_hit long, w long, exact boolean")


def _all_terms(batches):
    for batch in batches:
        t = batch.column(batch.schema.get_field_index("terms")).to_pylist()
        if t:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.frombuffer(b"".join(t), np.int64)))], names=["term"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", size: int = WORDS,
                  misses: int = MISSES, slop: int = SLOP) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, item_ids, n_near_items) per document."""
    index = build_index(docs, doc_id, text)
    windows = written(item_windows(benchmark, item_id, item_text, size), "decontam-items")
    found = written(find(index, windows, misses, slop), "decontam-found")
    hits = found.filter("w is null").select("segment", "at", "n_hit")
    items = (found.filter("w is not null").join(windows.select("w", "item"), "w")
             .groupBy("segment", "at", "item").agg(F.max("exact").alias("exact"))
             .groupBy("segment", "at").agg(
                 F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("item_ids"),
                 F.sum(F.col("exact").cast("long")).alias("n_items"),
                 F.sum((~F.col("exact")).cast("long")).alias("n_near_items")))
    out = index.filter("term is null").select("segment", "at", "doc", "key", F.col("n").alias("n_words"))
    out = out.join(hits, ["segment", "at"], "left").join(items, ["segment", "at"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select(F.col("doc").alias(doc_id), F.col("key").alias("text_key"), "n_words", zero("n_hit"), zero("n_items"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), zero("n_near_items"))
