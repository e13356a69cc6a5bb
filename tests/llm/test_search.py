"""Top-k search, archives and the quality classifier."""

from __future__ import annotations

import gzip
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.llm import cover_trees, pu_classifier, warc


def brute_top_k(rows, k):
    vectors = [(i, np.floor(64 * np.array(v, np.float64))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in vectors if i % 3 == 0}):
        q = next(v for j, v in vectors if j == i)
        found = sorted((-int(q @ v), j) for j, v in vectors if j != i and len(v) == len(q))[:k]
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(found)]
    return out


def test_top_k(session, monkeypatch):
    monkeypatch.setattr(cover_trees, "CANDIDATES_PER_BLOCK", 40)
    monkeypatch.setattr(cover_trees, "QUERIES_PER_BLOCK", 20)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(5, 6))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + 0.1 * rng.normal(size=6)]) for i in range(230)]
    rows += [(300 + i, [0.5] * 6) for i in range(90)]  # one very common vector
    rows += [(500, None), (501, []), (502, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (503, [float("nan")] * 6), (504, [float("inf")] + [0.0] * 5),
             (None, [1.0] * 6), (600, [1.0, 2.0]), (603, [2.0, 1.0])]
    vectors = session.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "v": F.lit("x"), "q": F.lit(0)})
    got = cover_trees.top_k(F.col("vec_id") % 3 == 0, vectors, k=7)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute_top_k(rows, 7)
    nothing = session.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_trees.top_k(F.col("vec_id") % 3 == 0, nothing).count() == 0


def test_pruning_leaves_work_out(monkeypatch):
    """Clustered vectors: far fewer pairs of vectors are compared than there are."""
    rng = np.random.default_rng(1)
    centres = 10 * rng.normal(size=(20, 8))
    x = np.repeat(centres, 100, 0) + 0.1 * rng.normal(size=(2000, 8))
    ids = np.arange(2000)
    compared = []
    original = cover_trees._bound
    monkeypatch.setattr(cover_trees, "_bound", lambda *a: compared.append(len(a[0])) or original(*a))
    found = cover_trees.search(ids[:400], x[:400], np.full(400, -np.inf), ids, x, 5)
    kth = np.full(400, np.inf)
    np.minimum.at(kth, found[0], found[2])
    compared.clear()
    again = cover_trees.search(ids[:400], x[:400], kth, ids, x, 5)
    assert sum(compared) < 400 * 2000 / 50 and len(again[0]) <= len(found[0])


def clustered(rng, n, dim):
    """Whole-number vectors in clusters of clusters."""
    top, sub = 4000 * rng.normal(size=(5, dim)), 300 * rng.normal(size=(25, dim))
    pick = rng.integers(0, 25, n)
    return np.floor(top[pick // 5] + sub[pick] + 20 * rng.normal(size=(n, dim)))


def test_levels_of_trees():
    """Children cover their node at half its radius and have their centres further apart than that."""
    x = clustered(np.random.default_rng(2), 1500, 3)
    tree = cover_trees.CoverTree.of(np.arange(1500), x)
    assert sorted(tree.ids) == list(range(1500)) and (tree.x == x[tree.ids]).all()
    depth, level = 0, np.zeros(1, np.int64)
    while len(level):
        for i in level:
            mine = tree.x[tree.low[i]: tree.high[i]]
            assert np.sqrt(((mine - tree.x[tree.centre[i]]) ** 2).sum(1)).max() <= tree.radius[i]
            kids = np.arange(tree.first[i], tree.first[i] + tree.kids[i])
            if not len(kids):
                continue
            assert tree.radius[kids].max() <= tree.radius[i] / 2 * (1 + 1e-6)
            assert tree.low[kids[0]] == tree.low[i] and tree.high[kids[-1]] == tree.high[i]
            assert (tree.high[kids[:-1]] == tree.low[kids[1:]]).all()
            c = tree.x[tree.centre[kids]]
            apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(-1)) + np.diag(np.full(len(c), np.inf))
            assert apart.min() > tree.radius[i] / 2 * (1 - 1e-6)
        depth, level = depth + 1, tree.opened(level)[0]
    assert depth > 3


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.booleans())
def test_dual_descent(seed, k, known):
    """Trees of several levels on both sides, with and without k-th scores from elsewhere."""
    rng = np.random.default_rng(seed)
    x = clustered(rng, 600, int(rng.integers(1, 5)))
    x[rng.integers(0, 600, 100)] = x[0]  # ties
    q_ids, c_ids = np.arange(200), np.arange(600)
    scores = x[:200] @ x.T
    scores[q_ids, q_ids] = -np.inf
    ranked = np.lexsort((np.broadcast_to(c_ids, scores.shape), -scores), axis=1)[:, :k]
    kth = np.take_along_axis(scores, ranked, 1)[:, -1] if known else np.full(200, -np.inf)
    found = {(a, b, c) for a, b, c in zip(*cover_trees.search(q_ids, x[:200], kth, c_ids, x, k), strict=True)}
    assert found == {(i, int(j), int(scores[i, j])) for i in range(200) for j in ranked[i]}


def test_top_k_in_rounds(session, monkeypatch):
    """Many blocks and rounds, more lengths than have pivots, one row that stands very often, ids with two vectors."""
    monkeypatch.setattr(cover_trees, "CANDIDATES_PER_BLOCK", 30)
    monkeypatch.setattr(cover_trees, "QUERIES_PER_BLOCK", 25)
    monkeypatch.setattr(cover_trees, "MOST_LENGTHS", 2)
    monkeypatch.setattr(cover_trees, "ROUND_GROWTH", 3)
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) / 64 for v in x]) for i, x in enumerate(clustered(rng, 500, 4))]
    rows += [(1001, rows[7][1])] * 60 + [(3000, rows[9][1])] * 3
    rows += [(2000 + 10 * n + i, [float(v) for v in rng.integers(-9, 9, n)]) for n in range(5, 12) for i in range(9)]
    vectors = session.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = cover_trees.top_k(F.col("vec_id") % 3 == 0, vectors, k=5)
    # A repeated query is asked once.
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute_top_k(rows, 5)


def test_rows_found_grow_with_the_input(monkeypatch):
    """Block after block with the k-th scores so far: what is put out is little more than what enters the k best."""
    rng = np.random.default_rng(4)
    q, out = rng.integers(-64, 64, (100, 32)).astype(float), []
    for blocks in (4, 32):
        kth, best, total, at = np.full(100, -np.inf), [[] for _ in range(100)], 0, 0
        for size in (1, 7, 56):
            x = rng.integers(-64, 64, (200 * min(size, blocks - at), 32)).astype(float) if at < blocks else np.zeros((0, 32))
            for low in range(0, len(x), 200):
                found = cover_trees.search(np.arange(100), q, kth, 1000 + np.arange(200), x[low: low + 200], 10)
                total += len(found[0])
                for i, s in zip(found[0], found[2], strict=True):
                    best[i].append(s)
            at = min(at + size, blocks)
            best = [sorted(b)[-10:] for b in best]
            kth = np.array([b[0] for b in best], float)
        out.append(total)
    assert out[1] < 8 * out[0] / 2


def page_rows():
    big = "<p>" + "é" * 600 + "</p>"
    return [
        (1, "http://a/", big), (2, "http://b/\r\nX: 1", big), (3, None, big), (3, None, big), (4, "u", "short"), (5, "u", "short"),
        (6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", "x" * 200_000), (9, "u", "WARC/1.1\r\nnot: a record\r\n\r\n" * 40)]


def test_archives_round_trip(session, tmp_path):
    pages = session.createDataFrame(page_rows(), "page_id long, url string, html string").withColumns({"digest": F.lit(1), "payload": F.lit(2)})
    warc.write_archives(pages, str(tmp_path / "a"), records_per_file=4)
    records, gaps = warc.read_archives(session, str(tmp_path / "a"))
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, bytes(r.payload)) for r in records.collect()), key=repr)
    want = []
    for page_id, _, html in page_rows():
        payload = (html or "").encode()
        revisit = html is not None and len(payload) >= 1000 and html == page_rows()[0][2] and page_id != 3
        want.append((page_id, "revisit" if revisit else "response", 3 if revisit else None, len(payload), b"" if revisit else payload))
    assert got == sorted(want, key=repr)
    assert gaps.count() == 0
    for path in (tmp_path / "a").glob("part-*"):
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\n")
    none = session.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(none, str(tmp_path / "b"))
    assert warc.read_archives(session, str(tmp_path / "b"))[0].count() == 0


@settings(max_examples=60, deadline=None)
@given(st.booleans(), st.lists(st.tuples(st.integers(0, 3000), st.integers(1, 40), st.binary(max_size=30)), max_size=3), st.binary(max_size=20))
def test_salvage(packed, damage, junk):
    payloads = [f"page {i} ".encode() * 20 for i in range(12)]
    parts = [warc.record(i, "u", p, None, False) for i, p in enumerate(payloads)]
    parts = [warc.member(p) for p in parts] if packed else parts
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    content = bytearray(b"".join(parts))
    hit = set()
    for at, n, new in damage:
        at %= len(content)
        end = min(at + n, len(content))
        content[at:end] = new.ljust(end - at, b"?")[: end - at]
        hit |= {i for i in range(12) if starts[i] < end and starts[i + 1] > at}
    rows = list(warc.salvage(bytes(content) + junk))
    found = [(r.fields["warc-record-id"], r.payload) for r in rows if r.problem is None]
    whole = [(f"<urn:x-page:{i}>", p) for i, p in enumerate(payloads)]
    assert all(r in found for i, r in enumerate(whole) if i not in hit)
    # A plain header has no checksum, so damage to it may pass; what is compressed is right or a gap.
    assert not packed or all(r in whole for r in found)
    # Records and gaps cover the archive, in order.
    at = 0
    for r in rows:
        assert r.start == at
        at = r.end
    assert at == len(content) + len(junk)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 9), max_size=4), st.integers(0, 200))
def test_salvage_inside_members(bad, lost):
    """One member with ten records, some of them bad; then the same member cut off."""
    payloads = [bytes(random.Random(i).choices(range(256), k=400)) for i in range(10)]
    parts = [warc.record(i, "u", p, None, False) for i, p in enumerate(payloads)]
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    broken = [p.replace(b"\r\n\r\n", b"\r\n--", 1) if i in bad else p for i, p in enumerate(parts)]
    content = warc.member(b"".join(broken))
    rows = list(warc.salvage(content))
    assert [r.payload for r in rows if r.problem is None] == [p for i, p in enumerate(payloads) if i not in bad]
    gaps = [r.inner for r in rows if r.problem is not None]
    ends = np.concatenate(([0], np.cumsum([len(p) for p in broken])))
    want: list[list[int]] = []
    for i in sorted(bad):
        if want and want[-1][1] == ends[i]:
            want[-1][1] = ends[i + 1]
        else:
            want.append([ends[i], ends[i + 1]])
    assert gaps == [tuple(w) for w in want] and all((r.start, r.end) == (0, len(content)) for r in rows)

    cut = warc.member(b"".join(parts))[: -(20 + lost * 15)]
    (row,) = warc.salvage(cut)
    assert row.problem == "cut off member" and (row.start, row.end) == (0, len(cut))
    assert [r.payload for r in row.recovered] == payloads[: len(row.recovered)]
    # Random bytes do not shrink: what comes back is all that was unpacked whole.
    assert starts[len(row.recovered)] >= len(cut) * 0.9 - 2 * len(parts[0]) or lost > 190


def test_fields_of_other_writers(session, tmp_path):
    import hashlib

    block = b"HTTP/1.1 200 OK\r\nContent-Length: 99999999999999999999\r\n\r\n"
    digest = hashlib.sha1(b"x").hexdigest()

    def foreign(number, digest, block_digest):
        head = (f"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:x-page:{number}>\r\nWARC-Date: d\r\nWARC-Payload-Digest: {digest}\r\n"
                f"WARC-Block-Digest: {block_digest}\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n")
        return head.encode() + block + b"\r\n\r\n"

    right = "sha1:" + hashlib.sha1(block).hexdigest().upper()
    parts = [
        foreign(9999999999999999999, f"sha1:{digest}", right), foreign("x", "sha1:0189", right), foreign(-5, "md5:77", right),
        foreign(7, f"sha1:{digest}", "sha1:" + "0" * 40), foreign(8, "sha1:" + "A" * 32, "md5:1")]
    (tmp_path / "a.warc").write_bytes(b"".join(parts))
    (tmp_path / "b.warc.gz").write_bytes(warc.member(b"".join(parts))[:-4])
    records, gaps = warc.read_archives(session, str(tmp_path))
    got = sorted(((r.archive[-1], r.page_id, r.payload_digest, r.payload_bytes, r.checked) for r in records.collect()), key=repr)
    want = [(None, digest, None), (None, None, None), (-5, None, None), (8, "00" * 20, None)]
    assert got == sorted([(a, *w, a == "c") for a in "cz" for w in want], key=repr)
    assert sorted(r.problem for r in gaps.collect()) == ["bad digest", "cut off member"]


def test_archives_are_bounded_by_bytes(session, tmp_path):
    pages = session.createDataFrame([(i, "u", "".join(random.Random(i).choices("abcdefghij", k=20_000))) for i in range(30)], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "a"), file_bytes=70_000)
    files = list((tmp_path / "a").glob("part-*"))
    assert len(files) == 10 and all(f.stat().st_size <= 70_000 for f in files)
    assert warc.read_archives(session, str(tmp_path / "a"))[0].count() == 30


def test_classifier(session, odd, empty):
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(1500):
        good = i % 5 > 0
        w = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(int(rng.integers(5, 80)))]
        rows.append((i, " ".join(x if good else x.upper() + "!!" for x in w)))
        if i % 2:
            labels.append((i, int(good)))
    docs = session.createDataFrame(rows, "doc_id long, text string")
    marked = session.createDataFrame(labels, "doc_id long, quality int")
    model = pu_classifier.trained(docs, marked)
    assert 0.7 < model.prior < 0.92
    got = pu_classifier.scored(docs, model).withColumn("out", pu_classifier.held_out()).filter("out").collect()
    right = [(r.score >= 0.5) == (r.doc_id % 5 > 0) for r in got]
    assert len(right) > 300 and np.mean(right) > 0.93
    scores = pu_classifier.scored(odd, model).collect()
    assert len(scores) == odd.count() and all(0 <= r.score <= 1 for r in scores)
    assert pu_classifier.scored(empty, pu_classifier.trained(empty, marked.limit(0))).count() == 0
    same = pu_classifier.trained(docs.repartition(7), marked)
    assert np.allclose(same.weights, model.weights)
