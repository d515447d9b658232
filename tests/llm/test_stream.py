"""The pipeline's packing follows the order that mixing gave."""

from collections import Counter

import corpus_pipeline as C
import pytest
from enrollspark.llm import packing as P
from enrollspark.llm.common import stage
from llm_data import SF, documents, prose
from pyspark.sql import functions as F


@pytest.fixture()
def small_cells(monkeypatch):
    monkeypatch.setattr(P, "CELL", 64)
    monkeypatch.setattr(P, "ROWS", 50)


def sequences(df):
    by = {}
    for r in df.collect():
        by.setdefault(r["sequence_id"], []).append(r)
    return [sorted(by[k], key=lambda r: r["offset"]) for k in sorted(by)]


def test_order_of_the_rows_decides_cells_and_sequences(spark, small_cells):
    docs = stage(documents(spark, [(k, prose(k, 300 + 97 * k % 900)) for k in range(400)] + [(None, "no id"), (7, "again")]), "t")
    got = {}
    for name, order in (("up", F.asc_nulls_last("doc_id")), ("down", F.desc_nulls_last("doc_id"))):
        ordered = stage(docs.repartitionByRange(3, order).sortWithinPartitions(order), "t")
        got[name] = sequences(C.pack(spark, ordered, SF))
        pieces = [r["doc_id"] for s in got[name] for r in s if r["doc_id"] is not None]
        assert len(pieces) == len(P.token_pieces(docs).collect()) - 1
        rank = {d: k for k, d in enumerate(sorted(set(pieces), reverse=name == "down"))}
        # a cell is the next pieces of the stream, whatever its sequences
        at = [rank[d] for d in pieces]
        for k in range(0, len(at) - 64, 64):
            assert max(at[k : k + 64]) <= min(at[k + 64 :])
    key = lambda ss: {frozenset((r["doc_id"], r["piece"]) for r in s) for s in ss}
    assert key(got["up"]) != key(got["down"])


def test_windows_of_the_packed_rows_keep_the_source_weights(spark, small_cells):
    docs = documents(spark, [(k, prose(k, 400), "a" if k < 1280 else "b") for k in range(1600)])
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    mixed = stage(C.mix(spark, docs, SF), "t")
    stream = [source[r["doc_id"]] for r in sorted(mixed.select("doc_id", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("k")).collect(), key=lambda r: (r["f"], r["k"]))]
    rows = [source[r["doc_id"]] for s in sequences(C.pack(spark, mixed, SF)) for r in s]
    for k in range(0, len(rows), 64):  # a piece for each document
        assert Counter(rows[k : k + 64]) == Counter(stream[k : k + 64])
