import duckdb
import numpy as np
import pytest

from enrollspark.llm import orchard as O
from enrollspark.llm import queries
from llm_data import SF, clashing

E = "vec_id long, embedding array<double>, label int"


def brute(rows):
    """rows of (id, vector, label), all of one length and in the order of their ids."""
    x = np.array([[int(np.floor(1024 * c)) for c in v] for _, v, _ in rows], object)
    n, length = x.shape
    codes, errors, books = [[] for _ in rows], [0] * n, []
    for a, b in [(length * k // 4, length * (k + 1) // 4) for k in range(4)]:
        part = x[:, a:b]
        book = part[:256].copy()
        for turn in range(5):
            d = [[sum((p - q) ** 2 for p, q in zip(v, e)) for e in book] for v in part]
            near = [min(range(len(book)), key=lambda e, row=row: (row[e], e)) for row in d]
            if turn < 4:
                for e in set(near):
                    own = part[[k for k in range(n) if near[k] == e]]
                    book[e] = [sum(c) // len(own) for c in own.T]
        for k in range(n):
            codes[k].append(f"{near[k]:02x}")
            errors[k] += d[k][near[k]]
        books += book.ravel().tolist()
    total = {}
    for (_, _, label), e in zip(rows, errors):
        total[label] = total.get(label, 0) + e
    import hashlib

    sha = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    most = (1 << 63) - 1
    return sorted([(i, "".join(c), min(most, e), min(most, total[label]), sha) for (i, _, label), c, e in zip(rows, codes, errors)], key=str)


def run(spark, rows):
    return sorted((tuple(r) for r in O.compress(spark.createDataFrame(rows, E)).collect()), key=str)


def rows_of(seed, n, dims, scale=1.0):
    g = np.random.default_rng(seed)
    x = g.normal(size=(n, dims)) * 0.02 * scale
    return [(k, [float(c) for c in v], [None, 0, 1][k % 3]) for k, v in enumerate(x)]


@pytest.mark.parametrize("n,dims", [(330, 8), (40, 8), (300, 6), (270, 3)])
def test_equals_brute_force(spark, n, dims):
    rows = rows_of(n, n, dims)
    assert run(spark, rows) == brute(rows)


def test_ties_and_repeated_rows(spark):
    rows = [(k, [0.5, 0.25, -0.125 * (k % 4), 1.0], 1) for k in range(30)] + [(30, [0.5, 0.25, 0.0, 1.0], 2)] * 3
    assert run(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rows = [(k, [c * s for c, s in zip(v, (1e9, 1e12, 1, 1e7))], label) for k, v, label in rows_of(5, 300, 4)]
    assert run(spark, rows) == brute(rows)
    end = [(1, [3e300, 0.0, 0.0, 0.0], None), (2, [-3e300, 0.0, 0.0, 0.0], None)]
    assert [r[2] for r in run(spark, end)] == [0, 0]  # components end at a long's limits


def test_odd_rows(spark):
    good = rows_of(6, 20, 8)
    odd = [(None, good[3][1], 0), (50, None, 1), (51, [float("nan")] * 8, 1), (52, [None] * 8, 1), (53, [1.0], 1), (54, [], 1)]
    d = clashing(spark.createDataFrame(good + odd, E), "vec", "of", "code", "error", "part")
    got = sorted((tuple(r) for r in O.compress(d).collect()), key=str)
    assert got == brute(good + [odd[0]])  # the null id comes last
    assert O.compress(d.limit(0)).count() == 0
    assert run(spark, [(1, [], 3)]) == [(1, "00000000", 0, 0, O.book_digest([np.zeros((1, 0), int)] * 4))]


@pytest.mark.parametrize("kind", [np.float64, np.int64, object])
def test_orchard_finds_the_nearest_and_skips_entries(kind):
    g = np.random.default_rng(2)
    middles = g.integers(-3000, 3000, (64, 4))
    book = (middles[:, None, :] + g.integers(-20, 21, (64, 4, 4))).reshape(-1, 4)
    book[200] = book[17]  # equal entries: the lower index wins
    x = book[g.integers(0, 256, 500)] + g.integers(-30, 31, (500, 4))
    made = O.Orchard(book.astype(kind))
    entry, d = made.nearest(x.astype(kind))
    every = ((x[:, None, :] - book[None]) ** 2).sum(2)
    assert entry.tolist() == every.argmin(1).tolist() and d.tolist() == every.min(1).tolist()
    assert made.compared < every.size / 2


def test_exact_types():
    assert O.exact_type(1000, 16) is np.float64 and O.exact_type(1 << 27, 16) is np.int64 and O.exact_type(1 << 62, 16) is object


def test_query_equals_sql(spark):
    d = SF.replace("0.001", "0.01")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    want = con.execute(O.ORACLE).fetchall()
    q = queries.op13_vector_codes(spark, d)
    assert q.columns == [c[0] for c in con.description]
    assert sorted((tuple(r) for r in q.collect()), key=str) == sorted(want, key=str)
