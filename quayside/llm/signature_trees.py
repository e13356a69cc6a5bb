"""Near duplicates by word shingles: an exact Jaccard join with signature trees.

A document is the set of its runs of five words, A-Z taken as a-z; two link when the sets' Jaccard similarity is
0.8 or more. Equal sets form one class, so copies are compared once.

*Which classes may link.* If two sets link, the first ``n - ceil(0.8 n) + 1`` members of each, in
one order for all, share one. The order puts frequent shingles last; which are frequent is taken
from the counts within slices of the corpus, at most ``FREQUENT`` of them (any order gives the same
result). Members travel to buckets by their hash; the classes that share one form a list, and equal
lists are kept once. Shingles known to be very frequent need no bucket: they name their list.

*Which are alike.* The classes of a list are the leaves of a tree. Its nodes hold the OR of the
classes' token bitmaps and the range of their sizes. Two nodes are traversed together, and left as soon
as the largest overlap that bitmaps and sizes allow is too small, or when all their classes are known to
be connected. A class has about one bit per shingle in its bitmap, so no sets travel for this. Lists too
big for one task are cut into blocks of bounded size, by sizes and hash; pairs of blocks of compatible size
are traversed, in two rounds, of which the second leaves out blocks that the first has connected.

*Which do link.* Classes left together make clusters of near duplicates. The same traversal runs over each
cluster with the sets themselves. Nothing is capped or sampled.

Members are compared as 64-bit hashes, which could mix up two of them only within one pair of
documents; a class is named by 64 bits too.

Results by case: NULL and blank texts have no shingles and link with nothing; a text of one to
four words has one shingle, the whole; equal documents and repeated rows are one class, each row
with a result of its own; rows without doc_id take part, but no component is named by them (one
of such rows only gets NULL); an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.base import WORD, query, stored, table
from quayside.llm.components import components
from quayside.llm.packed import pack, unpack
from quayside.llm.words import Words, mix, run_hashes, shingles, spans, text_slices

WIDTH = 5
#: Similarity as a fraction: 100 * intersection >= 80 * union.
NUMERATOR, DENOMINATOR = 80, 100
FREQUENT = 1 << 16
BUCKET_ROWS = 2_000_000
LEAF = 64
#: Documents and shingles of a block; a task holds two blocks.
BLOCK_DOCS = 4096
BLOCK_SHINGLES = 4_000_000
BITMAP_BITS = 8192
#: Sizes of linked sets differ by a factor of 1.25 at most, so by one such band.
BAND = 1.26
#: Occurrences from which a shingle's list is made without a bucket.
HOT_TIMES = 50_000


# A-Z as a-z; no byte of a longer character lies there.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all texts of a slice, per text in order and once, and where each text begins."""
    words = Words(_FOLD[data], offsets)
    values, starts = shingles(words, width)
    text = np.searchsorted(words.first, starts, "right") - 1
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        values = np.concatenate((values, run_hashes(words.hash, words.first[short], words.first[short] + counts[short])))
        text = np.concatenate((text, short))
    order = np.argsort(values)
    n = len(offsets) - 1
    order = order[np.argsort(text[order].astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")]
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[new], text[new]
    return values, np.searchsorted(text, np.arange(n + 1))


def _digest(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for each set: equal sets have the same."""
    return run_hashes(mix(values ^ np.uint64(0x8EBC6AF09C88C6E3)), first[:-1], first[1:]).view(np.int64)


def _profile(width: int):
    """One row per document with size and digest of its set, and rows of shingles that are frequent in a slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                values, first = _sets(data, offsets, width)
                node, n = _digest(values, first), np.diff(first)
                found, counts = np.unique(values, return_counts=True)
                found, counts = found[counts > 2], counts[counts > 2]
                bitmaps = [_bitmap(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
                of_docs = [
                    part.column("doc_id"), part.column("tie"), pa.array(n, pa.int64()), pa.array(node), pa.array(bitmaps, pa.binary())]
                of_shingles = [pa.array(found.view(np.int64)), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays([
                    *(pa.concat_arrays([x, pa.nulls(len(found), x.type)]) for x in of_docs),
                    *(pa.concat_arrays([pa.nulls(len(n), x.type), x]) for x in of_shingles),
                ], ["doc_id", "tie", "n", "node", "bits", "shingle", "times"])
    return run


PROFILE = "doc_id long, tie long, n long, node long, bits binary, shingle long, times long"


def _bitmap(values: np.ndarray) -> bytes:
    """A bit for each member, at its hash modulo a power of two of about the size of the set."""
    width = max(64, 1 << max(0, len(values) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[values % np.uint64(width)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bitmaps: list[bytes], width: int) -> np.ndarray:
    """Bitmaps brought to one width, the least of theirs."""
    out = np.empty((len(bitmaps), width // 64), np.uint64)
    for row, bits in zip(out, bitmaps, strict=True):
        row[:] = np.bitwise_or.reduce(np.frombuffer(bits, np.uint64).reshape(-1, width // 64), axis=0)
    return out


def _prefixes(width: int, frequent: np.ndarray, rank: np.ndarray):
    """Per slice: prefix members of the set of each class, and the class of each."""
    def of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values, first = _sets(data, offsets, width)
        node = _digest(values, first)
        _, once = np.unique(node, return_index=True)
        n = np.diff(first)
        once = once[n[once] > 0]
        values, n, node = values[spans(first[:-1][once], n[once])], n[once], node[once]
        text = np.repeat(np.arange(len(n)), n)
        last = np.zeros(len(values), np.int64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
            last = np.where(frequent[at] == values, rank[at], 0)
        order = np.lexsort((last, text))  # stable, so ties stay in the order of hashes
        need = -(-NUMERATOR * n // DENOMINATOR)
        keep = spans(np.concatenate(([0], np.cumsum(n)[:-1])), n - need + 1) if len(n) else np.zeros(0, np.int64)
        return values[order][keep], node[text[keep]]
    return of


def _by_bucket(prefixes, hot: np.ndarray, buckets: int):
    """Prefix members that are not hot, packed by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_slices(batch):
                values, owner = prefixes(data, offsets)
                cool = ~np.isin(values, hot)
                values, owner = values[cool], owner[cool]
                bucket = values % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                bucket, owner = bucket[order], owner[order]
                # Within a bucket 32 more bits tell shingles apart; a mix-up only adds a candidate.
                short = (values[order] >> np.uint64(32)).astype(np.uint32)
                ids = np.unique(bucket)
                cuts = np.searchsorted(bucket, ids).tolist() + [len(bucket)]
                blobs = [pack([short[i:j], owner[i:j]], compress=False) for i, j in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.astype(np.int64)), pa.array(blobs, pa.binary())], ["bucket", "blob"])
    return run


def _hot_lists(prefixes, hot: np.ndarray):
    """Classes with a hot shingle in their prefix; the shingle names the list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_slices(batch):
                values, owner = prefixes(data, offsets)
                found = np.isin(values, hot)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[found].view(np.int64)), pa.array(owner[found])], ["list", "node"])
    return run


def _lists(group: pa.Table) -> pa.Table:
    """The lists of a bucket: classes that share a shingle. A list is named by its members."""
    shorts, owners = [], []
    for blob in group.column("blob"):
        a, b = unpack(blob.as_py(), compress=False)
        shorts.append(np.frombuffer(a, np.uint32))
        owners.append(np.frombuffer(b, np.int64))
    short, owner = np.concatenate(shorts), np.concatenate(owners)
    order = np.lexsort((owner, short))
    short, owner = short[order], owner[order]
    new = np.ones(len(short), bool)
    new[1:] = (short[1:] != short[:-1]) | (owner[1:] != owner[:-1])
    short, owner = short[new], owner[new]
    first = np.flatnonzero(np.append(True, short[1:] != short[:-1])) if len(short) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(short)))
    first, counts = first[counts > 1], counts[counts > 1]
    rows = spans(first, counts)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(owner[rows].view(np.uint64)), dtype=np.uint64)))
    ends = np.cumsum(counts)
    name = mix(sums[ends] - sums[ends - counts] + counts.astype(np.uint64))
    _, once = np.unique(name, return_index=True)
    rows = spans(first[once], counts[once])
    return pa.table({"list": pa.array(np.repeat(name[once], counts[once]).view(np.int64)), "node": pa.array(owner[rows])})


def _with_sets(width: int):
    """Adds the set of each text, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                values, first = _sets(data, offsets, width)
                raw = values.tobytes()
                sets = pa.array([raw[8 * a: 8 * b] for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("cluster"), sets], ["node", "cluster", "shingles"])
    return run


class Tree:
    """Classes as leaves, in the given order; nodes of ``LEAF`` classes, then pairs of nodes.

    Level k has ``bits[k]`` (OR of the bitmaps), least and greatest sizes, and ``spare[k]``: how
    many more members than bits a class may have, as members can share a bit.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, spare: np.ndarray) -> None:
        cuts = np.arange(0, len(sizes), LEAF)
        self.levels = [(
            np.bitwise_or.reduceat(bits, cuts, axis=0), np.minimum.reduceat(sizes, cuts),
            np.maximum.reduceat(sizes, cuts), np.maximum.reduceat(spare, cuts))]
        while len(self.levels[-1][1]) > 1:
            b, low, high, extra = self.levels[-1]
            pairs = np.arange(0, len(low), 2)
            self.levels.append((
                np.bitwise_or.reduceat(b, pairs, axis=0), np.minimum.reduceat(low, pairs),
                np.maximum.reduceat(high, pairs), np.maximum.reduceat(extra, pairs)))

    def may_link(self, level: int, i: int, other: Tree, j: int) -> bool:
        bits, low, high, spare = (x[i] for x in self.levels[level])
        bits2, low2, high2, spare2 = (x[j] for x in other.levels[level])
        # The smaller set holds the overlap, and that must be the given share of the larger.
        if DENOMINATOR * min(high, high2) < NUMERATOR * max(low, low2):
            return False
        most = int(np.bitwise_count(bits & bits2).sum()) + min(spare, spare2)
        return (NUMERATOR + DENOMINATOR) * most >= NUMERATOR * (low + low2)


def _exact(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray] | None]:
    """Of sets: bitmaps over the members that several of them have, sizes, how many members share
    a bit, and (unless every such member has a bit of its own) the members as numbers."""
    n = len(rows)
    sizes = np.array([len(r) for r in rows], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, code, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    # What only one set has can be in no overlap.
    shared = times[code] > 1
    number = np.cumsum(times > 1) - 1
    code, owner = number[code[shared]], owner[shared]
    several = int((times > 1).sum())
    width = max(64, min(BITMAP_BITS, -(-several // 64) * 64))
    spot = code % width
    bits = np.zeros((n, width // 64), np.uint64)
    np.bitwise_or.at(bits, (owner, spot // 64), np.uint64(1) << (spot % 64).astype(np.uint64))
    held = np.bincount(owner, minlength=n)
    spare = held - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    return bits, sizes, spare, None if several <= width else np.split(code, np.cumsum(held)[:-1])


def _links(
    bits: np.ndarray, sizes: np.ndarray, spare: np.ndarray, codes: list[np.ndarray] | None, block: np.ndarray, label: np.ndarray,
) -> np.ndarray:
    """Labels after linking classes; only pairs of the first block with the second (or, with one
    block, all pairs) are compared. ``label`` may hold earlier connections; the least row wins.
    Without ``codes`` the bound by bitmaps decides."""
    parts = [np.flatnonzero(block == b) for b in np.unique(block)]
    # Like next to like: by size, then by bitmap.
    orders = [p[np.lexsort((*bits[p].T[:4], sizes[p]))] for p in parts]
    trees = [Tree(bits[o], sizes[o], spare[o]) for o in orders]
    first, second = orders[0], orders[-1]
    one, two = trees[0], trees[-1]
    same = len(orders) == 1
    top = max(len(one.levels), len(two.levels)) - 1
    for tree in (one, two):
        while len(tree.levels) <= top:
            tree.levels.append(tree.levels[-1])
    stack = [(top, 0, 0)]
    while stack:
        level, i, j = stack.pop()
        span = LEAF << level
        mine, theirs = first[i * span: (i + 1) * span], second[j * span: (j + 1) * span]
        if not len(mine) or not len(theirs):
            continue
        known = label[mine[0]]
        if (label[mine] == known).all() and (label[theirs] == known).all():
            continue
        if not one.may_link(level, i, two, j):
            continue
        if level:
            kids = [(level - 1, 2 * i + p, 2 * j + q) for p in (0, 1) for q in (0, 1)]
            counts = len(one.levels[level - 1][1]), len(two.levels[level - 1][1])
            kids = [k for k in kids if k[1] < counts[0] and k[2] < counts[1] and (not same or k[1] <= k[2])]
            # The children on the diagonal come first: they connect most.
            stack += sorted(kids, key=lambda k: k[1] != k[2], reverse=True)
            continue
        overlap = np.zeros((len(mine), len(theirs)), np.int64)
        for w in range(0, bits.shape[1], 16):
            overlap += np.bitwise_count(bits[mine, None, w: w + 16] & bits[None, theirs, w: w + 16]).sum(axis=2, dtype=np.int64)
        overlap += np.minimum(spare[mine][:, None], spare[theirs][None, :])
        hit = (NUMERATOR + DENOMINATOR) * overlap >= NUMERATOR * (sizes[mine][:, None] + sizes[theirs][None, :])
        for a, b in zip(*np.nonzero(hit), strict=True):
            x, y = mine[a], theirs[b]
            if label[x] == label[y]:
                continue
            if codes is not None:
                common = len(np.intersect1d(codes[x], codes[y], assume_unique=True))
                if (NUMERATOR + DENOMINATOR) * common < NUMERATOR * (sizes[x] + sizes[y]):
                    continue
            low, high = sorted((label[x], label[y]))
            label[label == high] = low
    return label


def _units(group: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Rows of each unit (cluster, pair of blocks) in ``group``, and its columns."""
    cluster, pair, node, block, known = (
        group.column(c).to_numpy() for c in ("cluster", "pair", "node", "block", "known"))
    order = np.lexsort((node, block, pair, cluster))
    cut = (cluster[order][1:] != cluster[order][:-1]) | (pair[order][1:] != pair[order][:-1])
    return np.split(order, np.flatnonzero(cut) + 1), node, block, known, group.column("payload").to_pylist()


def _edges(a: list[np.ndarray], b: list[np.ndarray]) -> pa.Table:
    x, y = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (a, b))
    return pa.table({"a": pa.array(x[x != y], pa.int64()), "b": pa.array(y[x != y], pa.int64())})


def _labels(known: np.ndarray) -> np.ndarray:
    _, start, label = np.unique(known, return_index=True, return_inverse=True)
    return start[label]


def _link_sets(group: pa.Table) -> pa.Table:
    """Edges that connect what links in each unit; the payload is the set."""
    units, node, block, known, payload = _units(group)
    a, b = [], []
    for rows in units:
        label = _links(*_exact([np.frombuffer(payload[i], np.uint64) for i in rows]), block[rows], _labels(known[rows]))
        a.append(node[rows])
        b.append(node[rows][label])
    return _edges(a, b)


def _link_bitmaps(group: pa.Table) -> pa.Table:
    """Edges that connect what bitmaps do not keep apart; the payload is the bitmap."""
    units, node, block, known, payload = _units(group)
    sizes = group.column("n").to_numpy()
    a, b = [], []
    leaves = [rows for rows in units if len(rows) <= LEAF and (block[rows] == 0).all()]
    if leaves:
        x, y = _alike_in_leaves(leaves, sizes, payload)
        a.append(node[x])
        b.append(node[y])
    for rows in units:
        if len(rows) <= LEAF and (block[rows] == 0).all():
            continue
        label = _labels(known[rows])
        bands = _band(sizes[rows])
        for band in np.unique(bands):
            near = np.flatnonzero((bands == band) | (bands == band + 1))
            width = 8 * min(len(payload[i]) for i in rows[near])
            bits = _folded([payload[i] for i in rows[near]], width)
            spare = sizes[rows[near]] - np.bitwise_count(bits).sum(axis=1)
            part = _labels(label[near])
            part = _links(bits, sizes[rows[near]], spare.astype(np.int64), None, block[rows[near]], part)
            a.append(node[rows[near]])
            b.append(node[rows[near]][part])
    return _edges(a, b)


def _alike_in_leaves(units: list[np.ndarray], sizes: np.ndarray, payload: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Units of one leaf, all at once: each row with the first of its unit that it may link with."""
    rows, counts = np.concatenate(units), np.array([len(u) for u in units])
    place = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    following = np.repeat(counts, counts) - 1 - place
    x, y = np.repeat(np.arange(len(rows)), following), spans(np.arange(1, len(rows) + 1), following)
    n = sizes[rows]
    fits = DENOMINATOR * np.minimum(n[x], n[y]) >= NUMERATOR * np.maximum(n[x], n[y])
    x, y = x[fits], y[fits]
    widths = np.array([8 * len(payload[i]) for i in rows])
    width = np.minimum(widths[x], widths[y])
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for w in np.unique(width):
        here = np.flatnonzero(width == w)
        used, at = np.unique(np.concatenate((x[here], y[here])), return_inverse=True)
        bits = _folded([payload[i] for i in rows[used]], int(w))
        spare = n[used] - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        left, right = at[: len(here)], at[len(here):]
        step = max(1, (1 << 20) // bits.shape[1])
        for low in range(0, len(here), step):
            i, j = left[low: low + step], right[low: low + step]
            most = np.bitwise_count(bits[i] & bits[j]).sum(axis=1).astype(np.int64) + np.minimum(spare[i], spare[j])
            hit = (NUMERATOR + DENOMINATOR) * most >= NUMERATOR * (n[used[i]] + n[used[j]])
            for p, q in zip(used[i[hit]].tolist(), used[j[hit]].tolist(), strict=True):
                p, q = find(p), find(q)
                root[max(p, q)] = min(p, q)
    return rows, rows[[find(i) for i in range(len(rows))]]


def _band(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / np.log(BAND)).astype(np.int64)


def _blocks(members: DataFrame, block_docs: int, block_shingles: int) -> tuple[DataFrame, DataFrame]:
    """``(node, cluster, at)``, the block of each class of ``members(node, n, cluster)``; and
    ``(cluster, first, second)``, the pairs of blocks to traverse."""
    weight = F.greatest(F.lit(1.0 / block_docs), F.col("n") / F.lit(float(block_shingles)))
    small = members.groupBy("cluster").agg((F.sum(weight) <= 1).alias("small"))
    band = F.floor(F.log("n") / F.log(F.lit(BAND)))
    banded = members.join(small, "cluster").withColumn("band", F.when(F.col("small"), F.lit(0)).otherwise(band).cast("long"))
    bands = banded.groupBy("cluster", "band").agg(F.ceil(F.sum(weight)).cast("long").alias("salts"))
    placed = banded.join(bands, ["cluster", "band"]).select(
        "node", "n", "cluster", F.struct("band", F.pmod(F.xxhash64("node"), F.col("salts")).cast("long").alias("salt")).alias("at"))
    blocks = bands.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).select(
        "cluster", F.struct("band", "salt").alias("at"))
    pairs = blocks.alias("l").join(
        blocks.alias("r"), F.expr("l.cluster = r.cluster AND l.at <= r.at AND r.at.band - l.at.band <= 1"),
    ).selectExpr("l.cluster AS cluster", "l.at AS first", "r.at AS second")
    return stored(placed, "blocks"), stored(pairs, "block-pairs")


def _connected(members: DataFrame, payload: DataFrame, link, block_docs: int, block_shingles: int) -> DataFrame:
    """Edges that connect what ``link`` finds among the classes of each cluster. ``members`` has
    cluster, node and n, ``payload`` has node and payload."""
    placed, pairs = _blocks(members, block_docs, block_shingles)
    bins = int(max(16, members.count() // 1000))

    def traverse(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
        side = F.explode(F.array(
            F.struct(F.lit(0).alias("block"), F.col("first").alias("at")), F.struct(F.lit(1).alias("block"), F.col("second").alias("at"))))
        sides = pairs.select("cluster", F.xxhash64("first", "second").alias("pair"), "first", "second", side.alias("side")).filter(
            "side.block = 0 OR first <> second").select("cluster", "pair", "side.block", "side.at")
        rows = placed.join(sides, ["cluster", "at"])
        rows = rows.withColumn("known", F.col("node")) if known is None else rows.join(known, "node", "left").withColumn(
            "known", F.coalesce("component", "node"))
        rows = rows.select("node", "n", "cluster", "pair", "block", "known").join(payload, "node")
        units = rows.groupBy(F.pmod(F.xxhash64("cluster", "pair"), F.lit(bins)).alias("bin"))
        return stored(units.applyInArrow(link, "a long, b long").distinct(), "links")

    # First each block by itself and with the next of its band; then what is not connected yet.
    near = F.expr("first = second OR (first.band = second.band AND second.salt = first.salt + 1)")
    edges = traverse(pairs.filter(near), None)
    rest = pairs.filter(~near)
    if not rest.isEmpty():
        known = components(edges)
        label = F.coalesce("component", "node")
        labels = placed.join(known, "node", "left").groupBy("cluster", "at").agg(
            F.min(label).alias("low"), F.max(label).alias("high"))
        rest = rest.join(labels.selectExpr("cluster", "at AS first", "low AS low1", "high AS high1"), ["cluster", "first"]).join(
            labels.selectExpr("cluster", "at AS second", "low AS low2", "high AS high2"), ["cluster", "second"])
        rest = rest.filter("least(low1, low2) <> greatest(high1, high2)").select("cluster", "first", "second")
        edges = edges.union(traverse(rest, known))
    return edges


def document_components(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH,
    block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES, hot_times: int = HOT_TIMES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``tie`` (hash of the text), ``n_shingles``,
    ``node`` (the set's class), ``component`` (the least class of its component)."""
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).cast("binary").alias("text"))
    profile = stored(texts.mapInArrow(_profile(width), PROFILE), "shingle-profile")
    documents = profile.filter("n IS NOT NULL").select("doc_id", "tie", "n", "node", "bits")
    often = profile.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times"))
    often = np.array(
        [tuple(r) for r in often.orderBy(F.desc("times"), "shingle").limit(FREQUENT).collect()], np.int64).reshape(-1, 2)
    often = often[np.argsort(often[:, 0].view(np.uint64))]
    frequent, rank = often[:, 0].copy().view(np.uint64), often[:, 1].copy()
    hot = frequent[rank >= hot_times]

    total = documents.agg(F.sum("n")).first()[0] or 0
    buckets = int(max(16, total // 5 // BUCKET_ROWS))
    prefixes = _prefixes(width, frequent, rank)
    found = texts.select("text").mapInArrow(_by_bucket(prefixes, hot, buckets), "bucket long, blob binary")
    lists = found.groupBy("bucket").applyInArrow(_lists, "list long, node long")
    if len(hot):
        lists = lists.union(texts.select("text").mapInArrow(_hot_lists(prefixes, hot), "list long, node long"))
    lists = stored(lists.distinct(), "candidate-lists")
    # Of each class one document stands for all.
    classes = stored(documents.filter("n > 0").join(lists.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.first("n").alias("n"), F.first("bits").alias("bits"),
        F.min(F.struct(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "tie")).alias("one")), "candidate-classes")
    alike = components(_connected(
        lists.withColumnRenamed("list", "cluster").join(classes.select("node", "n"), "node"),
        classes.select("node", F.col("bits").alias("payload")), _link_bitmaps, block_docs, 64 * block_shingles))

    members = stored(alike.join(classes, "node").select(
        "node", "n", F.col("component").alias("cluster"), "one.doc_id", "one.tie"), "near-duplicates")
    ours = texts.withColumn("doc_id", F.coalesce("doc_id", F.lit(0))).join(
        members.drop("n").hint("merge"), ["doc_id", "tie"]).select("node", "cluster", "text")
    sets = stored(ours.dropDuplicates(["node"]).mapInArrow(
        _with_sets(width), "node long, cluster long, shingles binary").select("node", F.col("shingles").alias("payload")), "near-sets")
    edges = _connected(members.select("cluster", "node", "n"), sets, _link_sets, block_docs, block_shingles)
    return documents.join(components(edges), "node", "left").select(
        "doc_id", "tie", F.col("n").alias("n_shingles"), "node",
        F.when(F.col("n") > 0, F.coalesce("component", "node")).alias("component"))


def linked(rows: DataFrame) -> DataFrame:
    """``document_components`` with ``component_id``, the least doc_id of the component."""
    least = rows.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "component", "left").withColumn(
        "component_id", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the least doc_id stays, once, and
    every document without shingles."""
    rows = document_components(docs)
    first = rows.filter("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull(), F.col("doc_id"), F.col("tie"))).alias("one"))
    kept = first.select(F.col("one.doc_id").alias("id"), F.col("one.tie").alias("tie"))
    whole = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_tie"),
        F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("has_words"))
    ours = whole.filter("has_words").join(kept, F.expr("own_id <=> id AND own_tie = tie"), "left_semi").dropDuplicates(["own_id", "own_tie"])
    return ours.union(whole.filter("NOT has_words")).select("row.*")


_ORACLE = f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WIDTH} THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - {WIDTH} + 2), lambda i: array_to_string(w[i:i + {WIDTH} - 1], ' ')) END) AS shingle
        FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS common
        FROM shingles l JOIN shingles r ON l.shingle = r.shingle AND l.doc_id <> r.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE {DENOMINATOR} * common >= {NUMERATOR} * (x.n + y.n - common)),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION
        SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)"""


@query("op3_signature_trees", _ORACLE)
def op3_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return linked(rows).select("doc_id", "n_shingles", "component_id")
