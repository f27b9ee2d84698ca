"""Top-k search, spelling variants and whitening against brute force, with nulls,
empty values, ties, repeated rows, hot groups and clashing extra columns."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtgrid.llm import bidiagonal, spelling, topk, whitening

VECTORS = "vec_id long, embedding array<float>, label int, score string, n string, component int, x string"


def usable(row):
    return row[1] is not None and all(c is not None and np.isfinite(c) for c in row[1])


def whole(row, dim):
    x = np.floor(np.array(row[1], np.float32).astype(np.float64) * 256).astype(np.int64)
    return np.pad(x, (0, dim - len(x)))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    middle = rng.standard_normal((6, 20))
    rows = [(i, (middle[i % 6] + 0.4 * rng.standard_normal(20)).astype(np.float32).tolist()) for i in range(400)]
    hot = rows[10][1]
    rows += [(i, hot) for i in range(400, 640)]  # over a third of the rows are one vector
    rows += [(700, None), (750, [float("nan")] * 20), (751, [None, *hot[1:]]), (752, [float("inf"), *hot[1:]]),
             (800, [0.0] * 20), (801, []), (850, hot[:7]), (None, hot), rows[50], rows[51], (50, rows[3][1])]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", "n", 2, "x") for r in rows], VECTORS).repartition(5)


def search(rows, every, k):
    dim = max([len(r[1]) for r in rows if usable(r)], default=0)
    own = sorted({(r[0], tuple(whole(r, dim).tolist())) for r in rows if usable(r)}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for q, x in own:
        if q is not None and q % every == 0:
            near = [(-sum(a * b for a, b in zip(x, y, strict=True)), c is None, c) for c, y in own if c != q]
            out += [(q, i + 1, c, -s) for i, (s, _, c) in enumerate(sorted(near, key=lambda t: (t[0], t[1], t[2] or 0))[:k])]
    return Counter(out)


def test_top_k_is_brute_force(spark, vectors):
    got = Counter(map(tuple, topk.top_k(table(spark, vectors)).collect()))
    assert got == search(vectors, 50, 5)


def test_top_k_over_many_blocks_and_parts(spark, vectors, monkeypatch):
    for name, value in (("QUERY_BYTES", 800), ("PART", 40), ("TILE", 8), ("WIDE", 32), ("PAIRS", 16)):
        monkeypatch.setattr(topk, name, value)
    got = Counter(map(tuple, topk.top_k(table(spark, vectors), every=7, k=3).collect()))
    assert got == search(vectors, 7, 3)


def test_top_k_few_rows_none_and_scores_past_double(spark):
    assert topk.top_k(table(spark, [])).collect() == []
    assert topk.top_k(table(spark, [(50, [1.0])])).collect() == []
    rows = [(0, [1e7, 1.0]), (1, [1e7, 1 / 256]), (2, [1e7, 2 / 256]), (3, [1e30, 1.0])]
    got = {(r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(table(spark, rows)).collect()}
    base = int(np.float32(1e7)) * 256
    assert got == {(1, 3, (1 << 63) - 1), (2, 2, base * base + 512), (3, 1, base * base + 256)}


def test_segment_bounds_hold():
    rng = np.random.default_rng(4)
    a, b = (rng.integers(-300, 300, (40, 37)).astype(np.float64) for _ in range(2))
    for length in topk.LENGTHS:
        assert (topk.statistics(a, length) @ topk.statistics(b, length).T >= a @ b.T - 1e-6).all()


def test_coarse_levels_prune():
    """Far clusters go by their bounds: few exact products of all pairs are taken."""
    rng = np.random.default_rng(6)
    middle = np.repeat(rng.standard_normal((8, 16)) * 300, 4, axis=1)
    x = (middle[rng.integers(0, 8, 6000)] + rng.standard_normal((6000, 64)) * 5).astype(np.int64)
    best = topk.Best(np.arange(20) * 50, x[np.arange(20) * 50], np.zeros(20, np.int64), 5)
    seen = []
    merge = best._merge
    best._merge = lambda q, *a: (seen.append(len(q)), merge(q, *a))
    best.offer(np.arange(6000), np.zeros(6000, bool), x)
    score = x[best.ids] @ x.T
    score[np.arange(20), best.ids] = -(1 << 60)
    assert (best.score == -np.sort(-score, axis=1)[:, :5]).all()
    assert sum(seen) < 20 * 6000 / 20


DOCS = "doc_id long, text string, n string, word string, form int, root string"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_vocabulary(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_variants(count, ratio=10):
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= ratio * count[w] else None
    def last(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], last(w), n, len(near[w]), count[form[w]] if form[w] else None) for w, n in count.items()}


@pytest.fixture(scope="module")
def prose():
    rng = np.random.default_rng(8)
    stems = ["abababab", "recommend", "conscience", "Ünïversität", "aaaaaaaa", "necessary", "separation", "straße×÷ÿÀx"]
    letters = list("abcdeÀÿß")
    rows = []
    for i in range(260):
        words = []
        for stem in stems:
            for _ in range(rng.integers(0, 9)):
                w = stem
                if rng.random() < 0.25:
                    for _ in range(rng.integers(1, 3)):
                        at, kind = rng.integers(0, len(w)), rng.integers(0, 3)
                        w = w[:at] + ("" if kind == 0 else str(rng.choice(letters))) + w[at + (kind < 2):]
                words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, " ".join(words) + rng.choice([".", "\n", "7", "_x"])))
    long = "".join(rng.choice(list("abcdef"), 3000))
    return [*rows, (900, long), (901, long[:1500] + "z" + long[1500:] + " " + long), (902, None), (903, ""), (904, "...!"),
            rows[7], rows[7], (None, "recommend recommend"), (905, "shorts shorts six letters"), (906, long[:-1] + " " + long[:-1])]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "n", "w", 1, "r") for r in rows], DOCS).repartition(4)


def test_vocabulary_is_brute_force(spark, prose):
    got = {r["word"]: r["n"] for r in spelling.vocabulary(docs_of(spark, prose)).collect()}
    assert got == brute_vocabulary(prose)


def test_spelling_variants_are_brute_force(spark, prose):
    got = set(map(tuple, spelling.spelling_variants(docs_of(spark, prose)).select("word", "form", "root", "n", "n_near", "form_n").collect()))
    want = brute_variants(brute_vocabulary(prose))
    assert got == want
    assert sum(r[1] is not None for r in want) > 50


def test_spelling_variants_of_hot_groups_in_blocks(spark):
    """A third of the words share one half; groups are split into pairs of small blocks."""
    rng = np.random.default_rng(9)
    words = {"prefixed" + "".join(rng.choice(list("abc"), rng.integers(6, 9))) for _ in range(300)}
    words |= {"".join(rng.choice(list("ab"), rng.integers(7, 9))) for _ in range(300)}
    count = {w: int(n) for w, n in zip(sorted(words), rng.integers(2, 400, len(words)), strict=True)}
    frame = spark.createDataFrame(list(count.items()), "word string, n long").repartition(3)
    got = spelling.variants(frame, block=16).select("word", "form", "root", "n", "n_near", "form_n")
    assert set(map(tuple, got.collect())) == brute_variants(count)


def test_long_chains_of_forms(spark):
    chain = ["chained" + "ab" * i + "a" * j for i in range(6) for j in range(2)]
    count = {w: 3 * 10 ** i for i, w in enumerate(chain)}
    got = spelling.variants(spark.createDataFrame(list(count.items()), "word string, n long"))
    want = brute_variants(count)
    assert set(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect())) == want
    assert any(r[1] != r[2] for r in want if r[1])


def test_spelling_of_nothing(spark):
    assert spelling.spelling_variants(docs_of(spark, [(1, None)]).limit(0)).collect() == []
    assert spelling.spelling_variants(docs_of(spark, [(1, None), (2, "")])).collect() == []


def whitened(rows):
    dim = max(len(r[1]) for r in rows if usable(r))
    own = [(r[0], whole(r, dim)) for r in rows if usable(r)]
    fit = np.array(sorted({tuple(x.tolist()) for _, x in own}), np.float64)
    n, total = len(fit), fit.sum(0)
    middle = fit - total / n
    e, u = np.linalg.eigh(middle.T @ middle / n)
    return own, n, total, e[::-1], u[:, ::-1]


def test_whitening_is_brute_force(spark, vectors):
    own, n, total, e, u = whitened(vectors)
    got = whitening.whiten(table(spark, vectors)).collect()
    assert Counter((r["vec_id"], r["component"]) for r in got) == Counter((i, c) for i, _ in own for c in range(1, 5))
    want = {}
    for i, x in own:
        far = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, total, strict=True))
        want.setdefault(i, []).append((far, np.abs((x - total / n) @ u[:, :4] / np.sqrt(e[:4]))))
    for r in got:
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
        assert any(far == r["deviation"] and abs(abs(r["whitened"]) - w[r["component"] - 1]) < 1e-8 for far, w in want[r["vec_id"]])


def test_whitening_joins_triangles_in_rounds(spark, vectors, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    _, _, _, e, _ = whitened(vectors)
    got = whitening.whiten(table(spark, vectors).repartition(7)).where("vec_id = 3").orderBy("component").collect()
    assert [r["explained"] for r in got] == pytest.approx((e[:4] / e.sum()).tolist(), rel=1e-9)


def test_whitening_of_flat_and_empty_tables(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    got = whitening.whiten(table(spark, [(1, [0.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0])])).collect()
    assert {r["component"] for r in got} == {1, 2} and all(r["identity_error"] < 1e-9 for r in got)
    far = whitening.whiten(table(spark, [(1, [1e9]), (2, [-1e9]), (3, [0.0])])).collect()
    assert {r["vec_id"]: r["deviation"] for r in far} == {1: None, 2: None, 3: 0}


def test_deviation_past_a_double_is_exact(spark):
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(table(spark, [(1, [4e6]), (2, [0.0]), (3, [1 / 256])])).collect()}
    x = {1: 4_000_000 * 256, 2: 0, 3: 1}
    total = sum(x.values())
    assert got == {i: (3 * v - total) ** 2 for i, v in x.items()}


@pytest.mark.parametrize("made", ["plain", "graded", "ties", "rank", "zero column", "one"])
def test_bidiagonal_solver(made):
    rng = np.random.default_rng(11)
    a = rng.standard_normal((90, 30))
    if made == "graded":
        a = a * np.exp(-np.arange(30))
    elif made == "ties":
        a = np.linalg.qr(rng.standard_normal((90, 30)))[0] * np.repeat([5.0, 4.0, 1.0], 10)
        a = a @ np.linalg.qr(rng.standard_normal((30, 30)))[0]
    elif made == "rank":
        a = a[:, :3] @ rng.standard_normal((3, 30))
    elif made == "zero column":
        a[:, 4] = 0
    elif made == "one":
        a = a[:, :1]
    r = np.linalg.qr(a, mode="r")
    values, z = bidiagonal.leading(r, 4)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert z.shape[1] == {"rank": 3, "one": 1}.get(made, 4)
    assert np.abs(z.T @ z - np.eye(z.shape[1])).max() < 1e-12
    assert np.abs(a.T @ (a @ z) - z * values[:z.shape[1]]).max() <= 1e-12 * want[0]


@pytest.mark.parametrize("seed", [11, 12, 49, 171, 264])
def test_all_vectors_of_tied_values(seed):
    rng = np.random.default_rng(seed)
    rng.standard_normal((90, 30))
    a = np.linalg.qr(rng.standard_normal((90, 30)))[0] * np.repeat([5.0, 4.0, 1.0], 10)
    a = a @ np.linalg.qr(rng.standard_normal((30, 30)))[0]
    for k in (4, 30):
        values, z = bidiagonal.leading(np.linalg.qr(a, mode="r"), k)
        assert np.abs(z.T @ z - np.eye(k)).max() < 1e-12
        assert np.abs(a.T @ (a @ z) - z * values[:k]).max() <= 1e-12 * values[0]


def test_small_singular_values_keep_their_digits():
    """dqds finds values of a bidiagonal to high relative accuracy, however small."""
    diag, upper = 10.0 ** -np.arange(0, 16, 2.0), 0.3 * 10.0 ** -np.arange(1, 15, 2.0)
    import decimal

    decimal.getcontext().prec = 60
    values = bidiagonal.dqds(diag, upper)
    b = [[decimal.Decimal(0)] * 8 for _ in range(8)]
    for i in range(8):
        b[i][i] = decimal.Decimal(float(diag[i]))
        if i < 7:
            b[i][i + 1] = decimal.Decimal(float(upper[i]))
    # The product of the squared values is the squared product of the diagonal, exactly.
    exact = decimal.Decimal(1)
    for i in range(8):
        exact *= b[i][i] ** 2
    found = decimal.Decimal(1)
    for v in values:
        found *= decimal.Decimal(float(v))
    assert abs(found / exact - 1) < decimal.Decimal("1e-12")


def test_queries_cover_their_tables(spark):
    from courtgrid.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    table_ = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert QUERIES["op13_whitening"](spark, sf).select("vec_id").distinct().count() == table_.select("vec_id").distinct().count()
    assert QUERIES["op11_topk_search"](spark, sf).select("query_id").distinct().count() == table_.where(F.col("vec_id") % 50 == 0).count()
    words = QUERIES["op12_spelling_variants"](spark, sf)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert {r["word"]: r["n"] for r in words.collect()} == brute_vocabulary(rows)
