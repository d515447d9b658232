import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from enrollspark.llm.textstats import COUNTS, STATS, free_prefix, stat_columns, with_counts
from llm_data import clashing, documents, edge_rows, prose


def counts(text):
    """Brute force of the counts that a contract fixes."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def check(spark, rows):
    got = with_counts(documents(spark, rows), "q_").select("text", *[f"q_{c}" for c in COUNTS[:5]]).collect()
    assert sorted((r[0] or "", *r[1:]) for r in got) == sorted((t or "", *counts(t)) for _, t, *_ in rows)


def test_counts_equal_brute_force(spark):
    again = "a b c d a b c d\nx\nx\n  \n  \nx #*$ a b c"
    check(spark, [*edge_rows(), (20, again), (21, "w w w w"), (22, "a\x0bb\x0cc\x1cd\x85e"), (23, prose(1, 400))])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab#|\n \t\x0b é", max_size=60), min_size=1, max_size=20))
def test_counts_of_random_texts(spark, texts):
    check(spark, list(enumerate(texts)))


def test_names_do_not_clash_and_empty_tables_stay_empty(spark):
    d = clashing(documents(spark, edge_rows()), "st_w", "ST__x", "words")
    p = free_prefix(d)
    out = with_counts(d, p).select(*d.columns, *stat_columns(p))
    assert out.columns == d.columns + STATS
    assert out.count() == d.count()
    assert with_counts(documents(spark, []), "q_").count() == 0
