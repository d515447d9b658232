"""Very long runs of one kind of character have the ids of the tokenizer."""

import pytest
from enrollspark.llm import packing as P
from enrollspark.llm import tokens
from enrollspark.llm.tokens import encoder
from llm_data import documents
from tokenizers import Tokenizer


@pytest.mark.parametrize("unit", [" ", "\n", " \u3000\x85", "x", "7", "!"])
def test_long_runs(unit):
    exact = Tokenizer.from_file(P.vocabulary())
    for n in (tokens.LONG_RUN - 1, tokens.LONG_RUN, 2_000_000):
        text = "a" + (unit * n)[:n] + "b c"
        assert encoder(P.vocabulary()).ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_packing_of_a_document_of_spaces(spark):
    out = P.pack_documents(documents(spark, [(1, " " * 2_000_000), (2, "a text")])).collect()
    exact = Tokenizer.from_file(P.vocabulary())
    assert sum(r["length"] for r in out if r["doc_id"] == 1) == len(exact.encode(" " * 2_000_000, add_special_tokens=False).ids) + 1
    assert any(r["doc_id"] == 2 for r in out)
