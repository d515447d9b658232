import random
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from enrollspark.llm import packing as P
from enrollspark.llm.common import read_table
from enrollspark.llm.tokens import encoder
from llm_data import SF, clashing, documents, edge_rows

PATH = P.vocabulary()


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(PATH)


def ids(exact, text):
    return exact.encode(text or "", add_special_tokens=False).ids + [0]


def brute_pieces(exact, rows, limit=2048):
    out = []
    for doc, text in rows:
        x = ids(exact, text)
        first = len(x) % limit or limit
        cuts = [0] + list(range(first, len(x) + 1, limit)) if len(x) > limit else [0, len(x)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((doc, k, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


def check(got, want, limit=2048):
    assert sorted(((*r[:5],) for r in got), key=str) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= limit
    return len(by)


def test_pieces_and_places(spark, exact):
    rows = [*edge_rows(), *((100 + k, "word " * (300 * k)) for k in range(12))]
    want = brute_pieces(exact, rows)
    d = clashing(documents(spark, rows), "cell", "island", "place", "bin", "piece", "length")
    n = check(P.pack_documents(d).collect(), want)
    assert n == max(-(-sum(w[3] for w in want) // 2048), n - 1)
    assert P.pack_documents(documents(spark, [])).count() == 0


def test_whole_table(spark, exact):
    docs = read_table(spark, SF.replace("0.001", "0.01"), "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute_pieces(exact, rows)
    assert check(P.pack_documents(docs).collect(), want) <= -(-sum(w[3] for w in want) // 2048) + 1


def test_many_cells_and_two_rounds(spark, monkeypatch):
    monkeypatch.setattr(P, "CELL", 100)
    r = random.Random(4)
    rows = [(k // 3, k % 3, 0, r.choice([700, 690, 660, 1100, 400, 2048]), k) for k in range(900)] + [(7, 0, 0, 5, 1)] * 50
    out = P.pack_pieces(spark.createDataFrame(rows, P.PIECES)).collect()
    check(out, sorted(rows, key=str))


def planted(seed, limit=100, slack=0):
    """Pieces of 20 sequences that are full but for ``slack``, of three pieces each."""
    g = np.random.default_rng(seed)
    lengths = []
    for _ in range(20):
        cuts = sorted(g.choice(np.arange(15, limit - 14 - slack), 2, replace=False).tolist())
        lengths += [b - a for a, b in zip([0, *cuts], [*cuts, limit - slack])]
    return lengths


@pytest.mark.parametrize("slack,least", [(0, 2), (1, 2)])
def test_evolution_needs_fewer_sequences_than_best_fit(slack, least):
    """With the shipped settings: two islands, two rounds, elites migrate."""
    wins = 0
    for seed in range(6):
        lengths, limit = planted(seed, slack=slack), 100
        first = P.Packing(lengths, limit).best_fit(list(range(len(lengths))))
        elites = []
        for at in range(P.ROUNDS):
            elites = [P.evolve(lengths, limit, elites, np.random.default_rng([P.SEED, 0, i, at])).bins for i in range(P.ISLANDS)]
        best = min(elites, key=len)
        assert sorted(i for b in best for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= limit for b in best)
        assert len(best) <= len(first.bins)
        wins += len(best) < len(first.bins)
    assert wins >= least


def test_equal_rows_are_dealt_to_cells(spark, monkeypatch):
    monkeypatch.setattr(P, "CELL", 500)
    rows = [(None, 0, 0, 300, 7)] * 6000 + [(k, 0, 0, 100 + k % 900, k) for k in range(2000)]
    out = P.pack_pieces(spark.createDataFrame(rows, P.PIECES)).collect()
    check(out, sorted(rows, key=str))
    by = Counter(r["sequence_id"] >> 32 for r in out)
    assert max(by.values()) <= 2 * 500 and sum(by.values()) == 8000


def test_exchange_fills_sequences():
    lengths = [50, 30, 35, 45, 20, 22]
    bins, free = [[0, 1], [2, 3]], [20, 20]
    loose = P.exchange(bins, free, [4, 5], lengths)
    assert sorted([*loose, *bins[0], *bins[1]]) == list(range(6))
    assert sum(lengths[i] for i in loose) < 42 and all(sum(lengths[i] for i in b) == 100 - f <= 100 for b, f in zip(bins, free))


def test_crossover_injects_whole_sequences():
    g = np.random.default_rng(3)
    lengths = [60, 50, 50, 40, 30, 30, 20, 20]
    a = P.Packing(lengths, 100, [[0, 4], [1, 3], [2, 5, 6], [7]])
    b = P.Packing(lengths, 100, [[0, 3], [1, 2], [4, 5, 6, 7]])
    c = P.crossover(a, b, g)
    assert sorted(i for x in c.bins for i in x) == list(range(8))
    assert any(sorted(x) in ([0, 3], [1, 2], [4, 5, 6, 7]) for x in c.bins)


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(max_size=60))
def test_random_texts_have_the_ids_of_the_tokenizer(exact, text):
    text = text.encode("utf-8", "ignore").decode()
    assert encoder(PATH).ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_every_code_point_has_the_ids_of_the_tokenizer(exact):
    made = encoder(PATH)
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    for lo in range(0, len(points), 4096):
        # next to a letter, a digit, a mark and spaces, so that its class shows
        texts = [f"a{chr(c)}1{chr(c)} {chr(c)}. {chr(c)}{chr(c)}\n" for c in points[lo : lo + 4096]]
        joined = "".join(texts)
        assert made.ids(joined).tolist() == exact.encode(joined, add_special_tokens=False).ids


def test_special_strings(exact):
    for t in ("a<|endoftext|> b", "<|endoftext|>", "<|endoftext|"):
        assert encoder(PATH).ids(t).tolist() == ids(exact, t)[:-1]


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 9000))
def test_cut(n):
    c = P.cut(n)
    assert sum(x for _, x in c) == n and all(0 < x <= 2048 for _, x in c)
    assert [s for s, _ in c] == list(np.cumsum([0] + [x for _, x in c[:-1]])) and all(x == 2048 for _, x in c[1:])
