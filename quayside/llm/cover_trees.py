"""Exact top-k inner products by dual-tree search over cover trees.

Queries and candidates are cut into blocks that lie close together: around pivots from a bounded
sample, by nearest pivot, large regions further by hash. Of each block a cover tree is built once and
stored with it as one row: a node has a point as its centre and a covering radius, its children have
centres more than half that radius apart and cover it at half the radius. A node whose points lie so far
apart that this would take over a quarter of them as centres is a leaf, as are nodes of few points.

Block pairs are searched by descending both trees together. For a query node around q (radius r) and a
candidate node around c (radius s), no inner product is above ``q.c + |q| s + |c| r + r s``; if that is
below the worst k-th score of the queries in the node, the pair of nodes is left. Centres of the upper
levels are points themselves: their scores raise the k-th scores before anything is opened.

The same bound between regions gives the order in which a query block meets candidate blocks. Rounds of
one, then eight times as many blocks and so on go through that order; after each the k best so far are kept
for each query, and pairs whose bound is below the worst k-th score of the query block are left. So a
round finds little more than what enters the k best.

The pivots only shape the blocks. Every vector is in a block, and the result is exact.

Results by case: vectors that are NULL, empty, or hold a NULL or a component that is not finite,
and rows without id, take no part; equal scores go to the smaller id, and repeated rows count as
often as they occur; vectors of different length do not meet; a query with fewer than k candidates
gets them all; an empty table gives no rows; extra columns are not looked at. Scores are exact as
long as they stay below 2**53.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.base import query, stored, table
from quayside.session import scratch_folder

K = 20
LEAF = 16
# Centres of the upper levels whose scores are taken before the descent.
FIRST_CENTRES = 256
# Pivots over all vector lengths, and how many lengths, the most frequent ones, have any.
MOST_PIVOTS = 1024
MOST_LENGTHS = 64
CANDIDATES_PER_BLOCK = 2048
QUERIES_PER_BLOCK = 1024
# A round goes through this many times the blocks of those before it.
ROUND_GROWTH = 8
# Pairs that share one copy of their query block on the way.
PAIRS_PER_COPY = 16


def _whole_numbers(scale: float):
    """Vectors that take part, as floor(scale * x), packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            valid = np.zeros(len(lists), bool)
            packed: list[bytes | None] = [None] * len(lists)
            dims = np.zeros(len(lists), np.int64)
            for i, x in enumerate(lists):
                if not x.is_valid or not len(x.values) or x.values.null_count:
                    continue
                v = np.floor(scale * x.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(v).all():
                    valid[i], packed[i], dims[i] = True, v.tobytes(), len(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(dims), pa.array(packed, pa.binary())], ["id", "dim", "v"]).filter(pa.array(valid))
    return run


def _near(pivots: dict[int, np.ndarray], few: dict[int, np.ndarray]):
    """Adds the nearest pivot, its distance, and the same for the fewer pivots of queries. Vectors of a length
    without pivots are one region around the origin."""
    def nearest(x: np.ndarray, to: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        region = np.zeros(len(x), np.int64)
        if to is None:
            return region, np.sqrt((x ** 2).sum(1)) * (1 + 1e-9)
        for low in range(0, len(x), 512):
            part = x[low: low + 512]
            region[low: low + 512] = ((to * to).sum(1) - 2 * part @ to.T).argmin(1)
        # Measured once more, so that the covering radius is not short by rounding.
        return region, np.sqrt(((x - to[region]) ** 2).sum(1)) * (1 + 1e-9)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = _matrix(part.column(2), int(dim))
                columns = [*part.columns]
                for to in (pivots, few):
                    columns += [pa.array(c) for c in nearest(x, to.get(int(dim)))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "dim", "v", "copy", "region", "reach", "q_region", "q_reach"])
    return run


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


class CoverTree:
    """Points in tree order, and nodes in arrays, the children of a node one after the other.

    Node i covers the points ``low[i]:high[i]`` within ``radius[i]`` of the point ``centre[i]``; its children
    are the nodes from ``first[i]`` on, ``kids[i]`` of them, none for a leaf.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, nodes: np.ndarray) -> None:
        self.ids, self.x, self.nodes = ids, x, nodes
        self.centre, self.low, self.high, self.first, self.kids = (nodes[:, i].astype(np.int64) for i in range(5))
        self.radius = nodes[:, 5]
        self.norm = np.sqrt((x[self.centre] ** 2).sum(1))
        self.leaf = self.kids == 0

    @classmethod
    def of(cls, ids: np.ndarray, x: np.ndarray) -> CoverTree:
        order = np.arange(len(x))
        nodes: list[list[float]] = []
        waiting = deque([(0, len(x), 0)])
        given = 1  # nodes numbered so far, those that wait included
        while waiting:
            low, high, start = waiting.popleft()
            points = order[low:high]
            mine = x[points]
            far = np.sqrt(((mine - x[start]) ** 2).sum(1))
            reach = float(far.max()) * (1 + 1e-9)
            node = [start, low, high, given, 0, reach]
            nodes.append(node)
            if high - low <= LEAF or reach == 0:
                continue
            group, best, centres = np.zeros(len(points), np.int64), far, [start]
            while best.max() > reach / 2 and 4 * len(centres) <= len(points):
                # The next centre is the point farthest from those there are, so over half the radius from all.
                new = int(best.argmax())
                d = np.sqrt(((mine - mine[new]) ** 2).sum(1))
                group = np.where(d < best, len(centres), group)
                best = np.minimum(best, d)
                centres.append(int(points[new]))
            if best.max() > reach / 2:
                continue
            sort = np.argsort(group, kind="stable")
            order[low:high] = points[sort]
            cuts = low + np.searchsorted(group[sort], np.arange(len(centres) + 1))
            waiting += [(int(a), int(b), s) for a, b, s in zip(cuts[:-1], cuts[1:], centres, strict=True)]
            node[4] = len(centres)
            given += len(centres)
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        table = np.array(nodes)
        table[:, 0] = place[table[:, 0].astype(np.int64)]
        return cls(ids[order], x[order], table)

    def opened(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of ``nodes``, and for each the place of its parent in ``nodes``."""
        n = self.kids[nodes]
        parent = np.repeat(np.arange(len(nodes)), n)
        within = np.arange(len(parent)) - np.repeat(np.cumsum(n) - n, n)
        return self.first[nodes][parent] + within, parent


def _bound(qc: np.ndarray, qn: np.ndarray, qr: np.ndarray, cc: np.ndarray, cn: np.ndarray, cr: np.ndarray) -> np.ndarray:
    value = (qc * cc).sum(-1) + qn * cr + cn * qr + qr * cr
    return value + 1e-6 * (1 + np.abs(value))


def _bounds(one: CoverTree, a: np.ndarray, two: CoverTree, b: np.ndarray) -> np.ndarray:
    """``_bound`` of many node pairs, some at a time."""
    some = max(1, (1 << 21) // max(1, one.x.shape[1]))
    parts = [np.zeros(0)]
    for low in range(0, len(a), some):
        i, j = a[low: low + some], b[low: low + some]
        parts.append(_bound(one.x[one.centre[i]], one.norm[i], one.radius[i], two.x[two.centre[j]], two.norm[j], two.radius[j]))
    return np.concatenate(parts)


def _scores(one: CoverTree, mine: np.ndarray, two: CoverTree, theirs: np.ndarray) -> np.ndarray:
    scores = one.x[mine] @ two.x[theirs].T
    scores[one.ids[mine][:, None] == two.ids[theirs][None, :]] = -np.inf
    return scores


def _reached(scores: np.ndarray, k: int) -> np.ndarray:
    return -np.partition(-scores, k - 1, axis=1)[:, k - 1]


def search_trees(one: CoverTree, kth: np.ndarray, two: CoverTree, k: int) -> tuple[np.ndarray, ...]:
    """(query, candidate, score) of the k best candidates of each query, without itself and without
    scores below ``kth`` (in tree order), a score that k candidates are known to reach."""
    kth = kth.copy()
    seen = np.unique(two.centre[:FIRST_CENTRES])
    if len(seen) >= k:
        kth = np.maximum(kth, _reached(_scores(one, np.arange(len(kth)), two, seen), k))
    worst = np.array([kth[low:high].min() for low, high in zip(one.low, one.high, strict=True)])
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)  # the two roots
    leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(a):
        bound = _bounds(one, a, two, b)
        keep = bound >= worst[a]
        a, b, bound = a[keep], b[keep], bound[keep]
        done = one.leaf[a] & two.leaf[b]
        leaves.append((a[done], b[done], bound[done]))
        a, b = a[~done], b[~done]
        # The wider node is opened.
        left = two.leaf[b] | (~one.leaf[a] & (one.radius[a] > two.radius[b]))
        kids, parent = one.opened(a[left])
        others, above = two.opened(b[~left])
        a, b = np.concatenate((kids, a[~left][above])), np.concatenate((b[left][parent], others))
    a, b, bound = (np.concatenate(x) for x in zip(*leaves, strict=True))
    order = np.lexsort((-bound, a))
    a, b, bound = a[order], b[order], bound[order]
    out = [np.zeros((0, 3), np.int64)]
    for rows in np.split(np.arange(len(a)), np.flatnonzero(np.diff(a)) + 1):
        if not len(rows):
            continue
        mine = np.arange(one.low[a[rows[0]]], one.high[a[rows[0]]])
        scores, found = np.zeros((len(mine), 0)), np.zeros(0, np.int64)
        low, step = 0, 2
        while low < len(rows):
            # Best bounds first; after the first that is too low none follows.
            some = rows[low: low + step]
            low, step = low + step, 2 * step
            some = some[bound[some] >= kth[mine].min()]
            if not len(some):
                break
            theirs = np.concatenate([np.arange(two.low[j], two.high[j]) for j in b[some]])
            scores, found = np.concatenate((scores, _scores(one, mine, two, theirs)), 1), np.concatenate((found, theirs))
            if scores.shape[1] >= k:
                kth[mine] = np.maximum(kth[mine], _reached(scores, k))
                use = (scores >= kth[mine][:, None]).any(axis=0)
                scores, found = scores[:, use], found[use]
        for row, i in enumerate(mine):
            good = np.flatnonzero((scores[row] >= kth[i]) & (scores[row] > -np.inf))
            good = good[np.lexsort((two.ids[found[good]], -scores[row][good]))][:k]
            out.append(np.stack([np.full(len(good), one.ids[i]), two.ids[found[good]], scores[row][good].astype(np.int64)], 1))
    return tuple(np.concatenate(out).T)


def search(q_ids: np.ndarray, q: np.ndarray, kth: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """``search_trees`` of plain matrices; ``kth`` belongs to the rows of ``q``."""
    one = CoverTree.of(np.arange(len(q)), q)
    kth, one.ids = kth[one.ids], q_ids[one.ids]
    return search_trees(one, kth, CoverTree.of(c_ids, c), k)


FOUND = "query_id long, vec_id long, score long"
BLOCK = "block string, dim long, region long, salt long, radius double, ids binary, x binary, nodes binary"


def _grown(rows: pa.Table) -> pa.Table:
    """One block with its tree, as one row."""
    dim, region, salt = (rows.column(n)[0].as_py() for n in ("dim", "region", "salt"))
    tree = CoverTree.of(rows.column("id").to_numpy(), _matrix(rows.column("v"), dim))
    return pa.table({
        "block": [f"{dim}.{region}.{salt}"], "dim": [dim], "region": [region], "salt": [salt],
        "radius": [float(rows.column("reach").to_numpy().max())],
        "ids": [tree.ids.tobytes()], "x": [tree.x.tobytes()], "nodes": [tree.nodes.tobytes()]})


def _tree(ids: bytes, x: bytes, nodes: bytes) -> CoverTree:
    numbers = np.frombuffer(ids, np.int64)
    return CoverTree(numbers, np.frombuffer(x, np.float64).reshape(len(numbers), -1), np.frombuffer(nodes, np.float64).reshape(-1, 6))


def _search_pairs(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                one = _tree(row["q_ids"], row["q_x"], row["q_nodes"])
                known = np.array([(r["id"], r["kth"]) for r in row["reached"]], [("id", np.int64), ("kth", np.float64)])
                known.sort(order="id")
                # Every query of the block has an entry.
                kth = known["kth"][np.searchsorted(known["id"], one.ids)]
                found = search_trees(one, kth, _tree(row["ids"], row["x"], row["nodes"]), k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])
    return run


def _blocks(rows: DataFrame, per_block: int, name: str) -> DataFrame:
    """Blocks of the rows of each region, by a hash that tells copies apart, each with its tree."""
    counts = rows.groupBy("dim", "region").agg(F.ceil(F.count("*") / per_block).alias("_salts"))
    cut = rows.join(counts, ["dim", "region"]).withColumn("salt", F.pmod(F.xxhash64("id", "v", "copy"), F.col("_salts")))
    grown = cut.select("id", "dim", "v", "region", "salt", "reach").groupBy("dim", "region", "salt").applyInArrow(_grown, BLOCK)
    path = scratch_folder(rows.sparkSession, name)
    # A block is one long row, so a reader is to meet few of them at once.
    grown.write.option("parquet.block.size", str(16 << 20)).parquet(path)
    return rows.sparkSession.read.schema(grown.schema).parquet(path)


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _pivots(packed: DataFrame, is_query: Column) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """Pivots of candidates and of queries for the most frequent lengths, no more than ``MOST_PIVOTS`` in all."""
    counts = packed.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query).alias("nq")).orderBy(
        F.desc("n"), "dim").limit(MOST_LENGTHS).collect()
    total = sum(r["n"] for r in counts)
    pivots, few = {}, {}
    for r in counts:
        share = MOST_PIVOTS * r["n"] // total
        wanted, fewer = min(share, r["n"] // CANDIDATES_PER_BLOCK), min(share, r["nq"] // QUERIES_PER_BLOCK)
        if max(wanted, fewer) > 1:
            first = packed.filter(F.col("dim") == r["dim"]).orderBy(F.xxhash64("id", "v", "copy"), "id").limit(max(wanted, fewer))
            x = np.stack([np.frombuffer(s["v"]) for s in first.collect()])
            pivots[r["dim"]], few[r["dim"]] = x[: max(1, wanted)], x[: max(1, fewer)]
    return pivots, few


def _meetings(q_blocks: DataFrame, c_blocks: DataFrame, pivots: dict[int, np.ndarray], few: dict[int, np.ndarray]) -> DataFrame:
    """Pairs of regions with their bound, in the order of a query region, and how many candidate blocks come before.
    There are at most as many as ``MOST_PIVOTS`` squared, and one more for each length without pivots."""
    spark = q_blocks.sparkSession

    def regions(blocks: DataFrame, of: dict[int, np.ndarray], prefix: str) -> DataFrame:
        centres = spark.createDataFrame(
            [(d, i, x.tolist(), float(np.sqrt((x * x).sum()))) for d, xs in of.items() for i, x in enumerate(xs)],
            "dim long, region long, centre array<double>, norm double")
        found = blocks.groupBy("dim", "region").agg(F.max("radius").alias("radius"), (F.max("salt") + 1).alias("salts"))
        placed = found.join(centres, ["dim", "region"], "left").withColumn("norm", F.coalesce("norm", F.lit(0.0)))
        return placed.select("dim", *(F.col(c).alias(prefix + c) for c in ("region", "radius", "salts", "centre", "norm")))

    pairs = regions(q_blocks, few, "q_").join(regions(c_blocks, pivots, ""), "dim")
    product = F.coalesce(_dot("q_centre", "centre"), F.lit(0.0))
    bound = product + F.col("q_norm") * F.col("radius") + F.col("norm") * F.col("q_radius") + F.col("q_radius") * F.col("radius")
    before = Window.partitionBy("dim", "q_region").orderBy(F.desc("bound"), "region").rowsBetween(Window.unboundedPreceding, -1)
    return stored(
        pairs.select("dim", "q_region", "region", "salts", (bound + 1e-6 * (1 + F.abs(bound))).alias("bound"))
        .withColumn("before", F.coalesce(F.sum("salts").over(before), F.lit(0))), "region-bounds")


def top_k(queries: Column, vectors: DataFrame, k: int = K, scale: float = 64.0, ids: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``; ``queries`` says which rows of ``vectors`` are queries."""
    spark = vectors.sparkSession
    rows = vectors.filter(F.col(ids).isNotNull()).select(F.col(ids).cast("long").alias("id"), F.col(embedding).alias("e"))
    whole = rows.mapInArrow(_whole_numbers(scale), "id long, dim long, v binary")
    # Of equal rows no more than k can be among the k best of a query.
    copies = whole.groupBy("id", "dim", "v").agg(F.least(F.count("*"), F.lit(k)).alias("n"))
    packed = stored(copies.select("id", "dim", "v", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")), "vectors")

    def flagged(df: DataFrame) -> DataFrame:
        chosen = F.lit(True) if queries is None else queries
        return df.withColumnRenamed("id", ids).withColumn("q", chosen & (F.col("copy") == 1)).withColumnRenamed(ids, "id")

    pivots, few = _pivots(flagged(packed), F.col("q"))
    placed = stored(flagged(packed.mapInArrow(
        _near(pivots, few), "id long, dim long, v binary, copy long, region long, reach double, q_region long, q_reach double")), "placed-vectors")
    asked = placed.filter("q").select("id", "dim", "v", "copy", F.col("q_region").alias("region"), F.col("q_reach").alias("reach"))
    c, q = _blocks(placed, CANDIDATES_PER_BLOCK, "candidate-blocks"), _blocks(asked, QUERIES_PER_BLOCK, "query-blocks")
    members = stored(q.mapInArrow(_member_ids, "id long, qb string, dim long, q_region long"), "query-members")
    meetings = _meetings(q, c, pivots, few)
    blocks = meetings.agg(F.max(F.col("before") + F.col("salts"))).first()[0] or 0

    q = q.select(F.col("block").alias("qb"), F.col("ids").alias("q_ids"), F.col("x").alias("q_x"), F.col("nodes").alias("q_nodes"))
    c = c.select(F.col("block").alias("cb"), "ids", "x", "nodes")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = spark.createDataFrame([], f"{FOUND}, rank int")
    low, high = 0, 1
    while low < blocks:
        kth = best.groupBy(F.col("query_id").alias("id")).agg(F.min("score").cast("double").alias("kth"), F.count("*").alias("n")).filter(
            F.col("n") >= k).select("id", "kth")
        reached = members.join(kth, "id", "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
        state = reached.groupBy("qb", "dim", "q_region").agg(
            F.min("kth").alias("worst"), F.collect_list(F.struct("id", "kth")).alias("reached"))
        start, end = F.greatest(F.lit(low) - F.col("before"), F.lit(0)), F.least(F.lit(high) - F.col("before"), F.col("salts"))
        due = meetings.filter((F.col("before") < high) & (F.col("before") + F.col("salts") > low)).withColumn(
            "salt", F.explode(F.sequence(start, end - 1)))
        pairs = due.join(state, ["dim", "q_region"]).filter("bound >= worst").select(
            "qb", F.concat_ws(".", "dim", "region", "salt").alias("cb"), "reached",
            F.floor((F.col("before") + F.col("salt")) / PAIRS_PER_COPY).alias("share"))
        pairs = stored(pairs, "block-pairs").repartition(4 * spark.sparkContext.defaultParallelism, "qb", "cb")
        copies = pairs.select("qb", "share").distinct().join(q, "qb")
        found = stored(pairs.join(c, "cb").join(copies, ["qb", "share"]).mapInArrow(_search_pairs(k), FOUND), "found")
        best = stored(best.drop("rank").union(found).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k), "best")
        low, high = high, high * ROUND_GROWTH
    return best.select("query_id", "rank", "vec_id", "score")


def _member_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of the queries of each block."""
    for batch in batches:
        for block, dim, region, ids in zip(*(batch.column(n).to_pylist() for n in ("block", "dim", "region", "ids")), strict=True):
            numbers = np.unique(np.frombuffer(ids, np.int64))
            columns = [numbers, [block] * len(numbers), np.full(len(numbers), dim), np.full(len(numbers), region)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["id", "qb", "dim", "q_region"])


_ORACLE = f"""
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
    WHERE rank <= {K}"""


@query("op1_cover_trees", _ORACLE)
def op1_cover_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(F.col("vec_id") % 20 == 0, vectors)
