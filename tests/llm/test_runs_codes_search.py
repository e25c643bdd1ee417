"""Periodic runs, vector codes and top-k search against brute force, with nulls, ties, repeated rows and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyglossa.llm import periodic_runs, queries, top_k, vector_codes

SF = "/root/testdata/sf0.001"


def runs_of(w, least=6, periods=4):
    """All runs by comparing every word with that a period on."""
    found = {}
    for p in range(1, len(w) // periods + 1):
        i = 0
        while i < len(w) - p:
            j = i
            while j < len(w) - p and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, periods * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def rows_of_words(seed, n):
    r = random.Random(seed)
    for _ in range(n):
        letters = r.choice([1, 2, 2, 3, 5])
        w = [r.randrange(letters) for _ in range(r.randint(0, 60))]
        if r.random() < 0.6:
            base, at = [r.randrange(letters + 1) for _ in range(r.randint(1, 7))], r.randint(0, len(w))
            w[at:at] = base * r.randint(2, 9) + base[: r.randrange(len(base))]
        yield w


def test_runs_equal_brute_force():
    texts = list(rows_of_words(1, 1500))
    got = periodic_runs.runs(np.array(sum(texts, []), np.int32), np.array([len(t) for t in texts]))
    want = {i: own for i, t in enumerate(texts) if (own := runs_of(t))}
    assert got == want and sum(map(len, want.values())) > 1000
    with pytest.raises(ValueError, match="four periods"):
        periodic_runs.runs(np.zeros(9, np.int32), np.array([9]), 6, 3)


def test_runs_of_highly_periodic_texts():
    for w in ([0] * 5000, [0, 1] * 3000, ([0] * 40 + [1]) * 60, [0] * 999 + [1] + [0] * 999, list(map(int, "".join(["0" if i % 7 else "1" for i in range(3000)])))):
        assert periodic_runs.runs(np.array(w, np.int32), np.array([len(w)])).get(0, []) == runs_of(w)


def test_z_function():
    for w in rows_of_words(2, 300):
        if w:
            v, z = np.array(w), periodic_runs.z_function(np.array(w), len(w) - 1)
            assert [z.get(i, 0) for i in range(1, len(w))] == [periodic_runs._same(v[i:], v) for i in range(1, len(w))]


def test_periodic_runs(docs):
    texts = [None, "", " \n", "a a a a a", "a a a a a a", "x " + "a b " * 5 + "y", "\ta\x0bb\ra b a b a b", "é \x1f é \x1f é \x1f é \x1f", "one two", "one two", "w " * 2_000]
    texts += [" ".join("abcdef"[k] for k in w) for w in rows_of_words(3, 60)]
    df = docs(texts).withColumn("runs", F.lit("own"))
    got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(df).collect()}
    for i, t in enumerate(texts):
        w = [x.decode() for x in (t or "").encode().split()]
        want = runs_of(w)
        gone = {k for s, n, p in want for k in range(s + p, s + n)}
        assert [tuple(r) for r in got[i]["runs"]] == want
        assert got[i]["collapsed_text"] == " ".join(x for k, x in enumerate(w) if k not in gone) and got[i]["kept"] == "x"
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_planted_repetitions(docs):
    texts = [None if i % 17 == 0 else " ".join(f"w{k}" for k in range(i % 40)) for i in range(300)]
    got = {r["doc_id"]: r["t"] for r in docs(texts).select("doc_id", periodic_runs.repeating(F.col("doc_id"), F.col("text")).alias("t")).collect()}
    changed = 0
    for i, t in enumerate(texts):
        w, h = (t or "").split(), zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            changed += 1
        assert (got[i] or "").split() == w
    assert changed > 10


def lloyd(x, parts, entries, rounds):
    """(codes, errors, codebooks) by all distances in each round."""
    x = x.reshape(len(x), parts, -1)
    books = [x[:entries, i].copy() for i in range(parts)]
    for k in range(rounds + 1):
        d = [((x[:, i, None, :] - books[i][None]) ** 2).sum(axis=2) for i in range(parts)]
        own = [e.argmin(axis=1) for e in d]
        if k < rounds:
            books = [np.array([x[own[i] == j, i].sum(axis=0) // (own[i] == j).sum() if (own[i] == j).any() else books[i][j] for j in range(len(books[i]))]) for i in range(parts)]
    return np.array(own).T, sum(e.min(axis=1) for e in d), books


@pytest.mark.parametrize("seed", range(3))
def test_vector_codes(spark, seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(400, 8)).round(1 if seed else 6) / (1, 4, 40)[seed]  # few different numbers give many ties
    v[50:90] = v[10:50]
    ids = rng.permutation(1000)[: len(v)]
    odd = [None, [], [0.0] * 7, [float("nan")] * 8, [None] * 8, [float("inf")] * 8, [0.5] * 16]
    rows = [(int(i), e.tolist(), int(i) % 3 if i % 5 else None) for i, e in zip(ids, v, strict=True)] + [(2000 + i, e, 1) for i, e in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("own", F.lit("x")).withColumn("ints", F.lit("x")).repartition(7)
    out, books = vector_codes.vector_codes(df, parts=4, entries=12, rounds=3, carry=("label", "own"))
    got = {r["vec_id"]: r for r in vector_codes.with_totals(out, "label", "error", "label_error").collect()}
    order = np.argsort(ids)
    x = np.floor(v[order] * 256).astype(np.int64)
    codes, errors, want = lloyd(x, 4, 12, 3)
    assert (books.entries == np.array(want)).all() and len(got) == len(v)
    totals = {}
    for k, e in zip(ids[order].tolist(), errors.tolist(), strict=True):
        totals[got[k]["label"]] = totals.get(got[k]["label"], 0) + e
    for k, c, e in zip(ids[order].tolist(), codes, errors.tolist(), strict=True):
        assert (got[k]["code"], got[k]["error"], got[k]["label_error"], got[k]["own"]) == ("".join(f"{j:02x}" for j in c), e, totals[got[k]["label"]], "x")


def test_bounds_hold_and_prune():
    """Bounds never pass the true distances; few distances are computed in later rounds; the result is that of all distances."""
    rng = np.random.default_rng(7)
    x = rng.integers(-300, 300, size=(3000, 4))
    books = vector_codes.Codebooks(x[None, :64].copy())
    own, upper, lower = vector_codes.first_assignment(x, books.entries[0])
    for _ in range(8):
        new = np.array([x[own == j].sum(axis=0) // max((own == j).sum(), 1) if (own == j).any() else books.entries[0][j] for j in range(64)])
        after = vector_codes.Codebooks(new[None])
        moved = books.moved(after)[0]
        own, upper, lower, n = vector_codes.next_assignment(x, own, upper + moved[own], np.maximum(lower - moved, 0), after, 0)
        d = np.sqrt(((x[:, None] - new[None]) ** 2).sum(axis=2).astype(float))
        assert (own == d.argmin(axis=1)).all() and (upper >= d.min(axis=1)).all() and (lower <= d).all()
        books = after
    assert n < 0.25 * d.size


def test_vector_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    out, books = vector_codes.vector_codes(spark.createDataFrame([(1, None, 1)], schema))
    assert out.count() == 0 and books is None
    few = spark.createDataFrame([(None, [0.1] * 16, 1), (3, [0.2] * 16, None), (3, [0.1] * 16, None)], schema)
    got, books = vector_codes.vector_codes(few)
    assert {(r["vec_id"], r["code"]) for r in got.collect()} == {(3, "00" * 16), (3, "01" * 16), (None, "00" * 16)} and books.entries.shape == (16, 3, 1)
    with pytest.raises(Exception, match="exceeds"):
        vector_codes.vector_codes(spark.createDataFrame([(1, [3e38] * 16, 1)], schema))[0].count()


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_vector_codes", "op13_top_k"])
def test_queries_of_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.queries()[name](spark, str(tmp_path)).count() == 0


def nearest(rows, k):
    """(query, rank, id, score) by sorting all candidates."""
    out = []
    for i, (a, x) in enumerate(rows):
        if a is not None and a % 100 == 0:
            scores = sorted((-int(sum(int(p) * int(q) for p, q in zip(x, y, strict=True))), b) for j, (b, y) in enumerate(rows) if j != i and b is not None and len(x) == len(y))
            out += [(a, r, b, -s) for r, (s, b) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(5)
    v = rng.integers(-4, 5, size=(900, 6))  # small numbers give many ties
    v[300:600] = v[0]
    rows = [(int(i), e.tolist()) for i, e in enumerate(v)] + [(100, v[3].tolist()), (100, v[3].tolist()), (200, [1, 2, 3]), (2001, [3, 2, 1]), (None, [1] * 6), (300, [2**30] * 2), (-100, [-(2**29)] * 2)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "key long, vec_id long, ints array<long>").withColumn("tile", F.lit("x")).withColumn("role", F.lit("x")).repartition(5)
    for block, shard in ((4096, 1 << 18), (3, 50)):
        got = sorted(tuple(r) for r in top_k.top_k(df, "vec_id % 100 = 0", 7, block, shard).collect())
        assert got == nearest(rows, 7)
    assert top_k.top_k(df.limit(0), "vec_id % 100 = 0").count() == 0
    assert sorted(tuple(r) for r in top_k.top_k(df.where("key < 3"), "vec_id % 100 = 0", 7).collect()) == nearest(rows[:3], 7)


def test_products_are_exact():
    big = np.array([[2**28 + 1, -(2**28) + 3]])
    assert top_k.products(big, big)[0, 0] == sum(int(x) ** 2 for x in big[0])
    with pytest.raises(ValueError, match="64 bits"):
        top_k.products(np.array([[2**40]]), np.array([[2**40]]))


def test_select_takes_the_first_of_equal_scores():
    rng = np.random.default_rng(6)
    s = rng.integers(0, 4, size=(200, 30))
    want = [sorted(sorted(range(30), key=lambda j: (-r[j], j))[:7]) for r in s]
    assert top_k.select(s, 7).tolist() == want


def test_whole_numbers(spark):
    odd = [None, [], [float("nan")], [None], [float("inf")], [-0.0001, 1.5]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(odd)] + [(5, [2.0])], "vec_id long, embedding array<float>")
    got = top_k.whole_numbers(df).collect()
    assert sorted((r["vec_id"], r["ints"]) for r in got) == [(5, [-1, 1536]), (5, [2048])] and len({r["key"] for r in got}) == 2
    with pytest.raises(Exception, match="64 bits"):
        top_k.whole_numbers(spark.createDataFrame([(1, [1e38])], "vec_id long, embedding array<float>")).collect()


def test_codebooks_digest(spark):
    out = queries.queries()["op12_vector_codes"](spark, SF)
    _, books = vector_codes.vector_codes(spark.read.parquet(f"{SF}/embeddings.parquet"))
    text = ",".join(str(int(x)) for part in books.entries for entry in part for x in entry)
    assert out.select("codebooks_sha256").distinct().collect()[0][0] == hashlib.sha256(text.encode()).hexdigest()
