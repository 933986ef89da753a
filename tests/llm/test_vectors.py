"""Operators on whole-number vectors (op11, op12, op13) against brute force and their SQL."""

import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lifemart.llm import codes, queries, topk, whitening

FOLDER = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    """rows of (vec_id, embedding, label), with columns whose names the operators use themselves."""
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    for name in ("x", "key", "code", "error", "norm", "block", "component", "n", "score", "rank"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


def drawn(seed, n, length=8, spread=None):
    draw = np.random.default_rng(seed)
    return np.float32(draw.normal(size=(n, length)) * (np.ones(length) if spread is None else spread))


def edge_rows(length=8):
    x = drawn(3, 150, length, np.linspace(3, 0.1, length))
    rows = [(i, x[i].tolist(), "ab"[i % 2] if i % 3 else None) for i in range(150)]
    rows += [(7, x[7].tolist(), "a")] * 3 + [(7, x[8].tolist(), None), (None, x[9].tolist(), "b"), (None, x[9].tolist(), "b"), (-20, (x[3] * 4).tolist(), "c")]
    rows += [(1000 + i, x[5].tolist(), "copies") for i in range(60)] + [(2000, [0.0] * length, "zero"), (2020, [0.0] * length, "zero")]
    odd = [(500, None, "a"), (520, [NAN] + [1.0] * (length - 1), "a"), (540, [INF] * length, "a"), (560, [None] + [1.0] * (length - 1), "b")]
    return rows, odd


def key(value):
    return (value is None, value)


# op11


def whitened_by_hand(rows, k=16):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v, _ in rows], object)
    fit = np.array(sorted({tuple(r) for r in x}), object)
    n, s = len(fit), fit.sum(0)
    d = n * fit - s
    v = (d.T @ d).astype(float) / float(n) ** 3
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    k = min(k, int((e > 1e-12 * e[0]).sum()))
    w = (n * x - s).astype(float) / n @ axes[:, :k] / np.sqrt(e[:k])
    return n, [int(((n * r - s) ** 2).sum()) for r in x], w, e[:k] / np.trace(v)


def check_whitening(frame, rows):
    n, deviation, w, explained = whitened_by_hand(rows)
    found = frame.collect()
    assert len(found) == w.size
    assert {r["n"] for r in found} == {n} and len({r["identity_error"] for r in found}) == 1 and 0 <= found[0]["identity_error"] < 1e-9
    assert Counter((r["vec_id"], r["component"], int(r["deviation"])) for r in found) == Counter((rows[i][0], c + 1, deviation[i]) for i in range(len(rows)) for c in range(w.shape[1]))
    for c in range(w.shape[1]):
        assert all(r["explained"] == pytest.approx(explained[c], rel=1e-9) for r in found if r["component"] == c + 1)
        mine = sorted(((key(r["vec_id"]), r["whitened"]) for r in found if r["component"] == c + 1))
        ways = [sorted((key(rows[i][0]), sign * w[i, c]) for i in range(len(rows))) for sign in (1, -1)]
        assert any(all(a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-7) for a, b in zip(mine, way, strict=True)) for way in ways)


def test_whitening_edges(spark):
    rows, odd = edge_rows()
    check_whitening(whitening.whiten(table(spark, rows + odd)), rows)


def test_whitening_large_numbers(spark):
    turned = np.float32(drawn(5, 40, 5, [1e7, 1, 1e5, 100, 1e6]).astype(float) @ np.linalg.qr(drawn(6, 5, 5).astype(float))[0])
    for x in (turned, drawn(5, 40, 5, [1e7, 1, 1e5, 100, 1e6])):  # squares leave 64 bits, variances lie 1e14 apart
        rows = [(i, v.tolist(), None) for i, v in enumerate(x)]
        found = whitening.whiten(table(spark, rows)).collect()
        n, deviation, _, _ = whitened_by_hand(rows)
        assert Counter((r["vec_id"], r["component"], int(r["deviation"])) for r in found) == Counter((i, c, deviation[i]) for i in range(40) for c in range(1, 6))
        w = np.array([[r["whitened"] for r in sorted(found, key=lambda r: r["vec_id"]) if r["component"] == c] for c in range(1, 6)])
        assert np.abs(w @ w.T / n - np.eye(5)).max() < 1e-6 and found[0]["identity_error"] < 1e-6
        assert sum({r["component"]: r["explained"] for r in found}.values()) == pytest.approx(1, rel=1e-12)
        exact = np.array([[math.floor(64 * float(c)) for c in v] for v in x], object)
        d = (n * exact - exact.sum(0)).astype(float) / n
        for c in range(5):  # each component is a straight line through the centre: its slope times the covariance is its eigenvalue
            slope = np.linalg.lstsq(d, w[c], rcond=None)[0]
            share = 1 / (slope @ slope) / float((d**2).sum() / n)
            assert {r["explained"] for r in found if r["component"] == c + 1}.pop() == pytest.approx(share, rel=1e-4)


def test_whitening_without_variance(spark):
    copies = [(i, [1.0, 2.0], None) for i in range(5)]
    assert whitening.whiten(table(spark, copies)).count() == 0
    flat = [(i, [float(i % 3), 2.0], None) for i in range(9)]
    assert {r["component"] for r in whitening.whiten(table(spark, flat)).collect()} == {1}
    assert whitening.whiten(table(spark, [])).columns == "vec_id component n deviation whitened explained identity_error".split()
    assert whitening.whiten(table(spark, [(1, None, None), (2, [], None)])).count() == 0


def test_whitening_lengths_apart(spark):
    short, long = ([(i + 100 * n, v.tolist(), None) for i, v in enumerate(drawn(n, 30, n))] for n in (2, 20))
    found = whitening.whiten(table(spark, short + long))
    check_whitening(found.where("vec_id < 1000"), short)
    check_whitening(found.where("vec_id >= 1000"), long)
    assert found.where("vec_id >= 1000").agg(F.max("component")).first()[0] == 16


# op12


def coded_by_hand(rows, parts, entries, rounds):
    q = [[math.floor(256 * float(c)) for c in v] for _, v, _ in rows]
    width = -(-len(q[0]) // parts)
    cut = [[tuple((v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width]) for p in range(parts)] for v in q]
    first = sorted(range(len(rows)), key=lambda i: (key(rows[i][0]), q[i]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]
    nearest = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))
    for turn in range(rounds + 1):
        found = [[nearest(own[p], books[p]) for p in range(parts)] for own in cut]
        if turn == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut[i][p] for i in range(len(rows)) if found[i][p][1] == e]
                if own:
                    books[p][e] = tuple(sum(c) // len(own) for c in zip(*own, strict=True))
    error = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(rows, error, strict=True):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return Counter((rows[i][0], "".join(f"{e:02x}" for _, e in found[i]), error[i], by_label[rows[i][2]], digest) for i in range(len(rows)))


@pytest.mark.parametrize(("length", "parts", "entries", "rounds"), [(8, 4, 16, 2), (8, 4, 5, 6), (7, 3, 300, 1), (3, 4, 2, 0)])
def test_codes_edges(spark, length, parts, entries, rounds):
    rows, odd = edge_rows(length)
    found = codes.compress(table(spark, rows + odd), parts=parts, entries=min(entries, 256), rounds=rounds)
    assert Counter(map(tuple, found.collect())) == coded_by_hand(rows, parts, min(entries, 256), rounds)


def test_codes_large_numbers(spark):
    rows = [(i, v.tolist(), "l") for i, v in enumerate(drawn(5, 40, 4, 1e5))]  # products leave the whole numbers of a double
    assert Counter(map(tuple, codes.compress(table(spark, rows), parts=2, entries=8).collect())) == coded_by_hand(rows, 2, 8, 2)
    with pytest.raises(Exception, match="too large"):
        codes.compress(table(spark, [(1, [1e30, 0.0], None)])).collect()


def test_codes_of_few_rows(spark):
    assert codes.compress(table(spark, [])).count() == 0
    assert codes.compress(table(spark, [(1, None, "a")])).count() == 0
    assert [(r["code"], r["error"]) for r in codes.compress(table(spark, [(1, [], "a")])).collect()] == [("00" * 16, 0)]


def test_active_entries_equal_a_full_scan():
    draw = np.random.default_rng(1)
    for _ in range(200):
        part = draw.integers(-4, 5, (50, 2))
        before, moved = draw.integers(-4, 5, (12, 2)), draw.random(12) < draw.random()
        after = before.copy()
        after[moved] = draw.integers(-4, 5, (moved.sum(), 2))
        code, stored = codes._again(part, *codes._nearest(part, before), after, (after != before).any(1))
        full = codes._nearest(part, after)
        assert (code == full[0]).all() and (stored == full[1]).all()


# op13


def top_by_hand(rows, k, step):
    q = [[math.floor(64 * float(c)) for c in v] for _, v, _ in rows]
    out = Counter()
    for i, (query, _, _) in enumerate(rows):
        if query is not None and query % step == 0:
            found = sorted((-sum(a * b for a, b in zip(q[i], q[j], strict=True)), key(rows[j][0]), j) for j in range(len(rows)) if j != i and len(q[i]) == len(q[j]))[:k]
            out.update((query, r + 1, rows[j][0], -s) for r, (s, _, j) in enumerate(found))
    return out


@pytest.mark.parametrize("sizes", [(4096, 1024, 512), (16, 8, 25), (7, 3, 1)])
def test_top_products_edges(spark, monkeypatch, sizes):
    for name, size in zip(("BLOCK", "CHUNK", "SEEDS"), sizes, strict=True):
        monkeypatch.setattr(topk, name, size)
    rows, odd = edge_rows()
    found = topk.top_products(table(spark, rows + odd), k=5, query_step=20)
    assert Counter(map(tuple, found.collect())) == top_by_hand(rows, 5, 20)


def test_top_products_small_and_large(spark):
    assert topk.top_products(table(spark, [])).count() == 0
    assert topk.top_products(table(spark, [(1, [1.0], None)])).count() == 0  # no query
    few = [(0, [1.0, 2.0], None), (3, [1.0, -2.0], None), (20, [0.0, 0.0], None), (40, [], None), (60, [], None), (80, [1.0], None)]
    found = topk.top_products(table(spark, few))
    assert Counter(map(tuple, found.collect())) == Counter({(0, 1, 20, 0): 1, (0, 2, 3, -64 * 64 * 3): 1, (20, 1, 0, 0): 1, (20, 2, 3, 0): 1, (40, 1, 60, 0): 1, (60, 1, 40, 0): 1})
    big = [(i, v.tolist(), None) for i, v in enumerate(drawn(8, 50, 3, 1e6))]
    assert Counter(map(tuple, topk.top_products(table(spark, big), k=3).collect())) == top_by_hand(big, 3, 20)


@pytest.mark.parametrize("spread", [np.ones(12), np.geomspace(8, 0.01, 12)])
def test_search_drops_only_what_cannot_reach(monkeypatch, spread):
    monkeypatch.setattr(topk, "SLICE", 32)
    x = np.floor(64 * drawn(9, 400, 12, spread).astype(float)).astype(np.int64) * np.random.default_rng(2).integers(0, 4, (400, 1))
    x = x[np.argsort(-(x**2).sum(1), kind="stable")]
    turn = np.linalg.svd((x.T @ x).astype(float))[2].T
    side, k = topk.Side(np.arange(400), np.arange(400) // 3, x, turn), 10
    at_q, at_r, score = topk.search(side[np.arange(0, 400, 7)], side, np.full(58, -np.inf), k)
    whole = x[::7] @ x.T
    for place, i in enumerate(range(0, 400, 7)):
        others = sorted((-whole[place, j], j // 3, j) for j in range(400) if j != i)[:k]
        assert sorted((-s, j // 3, j) for j, s in zip(at_r[at_q == place].tolist(), score[at_q == place].tolist(), strict=True)) == others


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_topk"])
def test_vector_queries_equal_their_sql(spark, name):
    with duckdb.connect() as duck:
        duck.execute(f"create view embeddings as select * from '{FOLDER}/embeddings.parquet'")
        result = duck.execute(queries.ORACLE_SQL[name])
        names = [d[0] for d in result.description]
        frame = queries.QUERIES[name](spark, FOLDER)
        assert sorted(frame.columns) == sorted(names)
        assert Counter(map(tuple, frame.select(names).collect())) == Counter(result.fetchall())


def test_whitening_query(spark):
    frame = queries.QUERIES["op11_whitening"](spark, FOLDER)
    rows = [(r["vec_id"], r["embedding"], None) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    assert dict(frame.dtypes)["deviation"] == "bigint"
    check_whitening(frame, rows)
