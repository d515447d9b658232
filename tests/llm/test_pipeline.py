import corpus_pipeline as C
from enrollspark.llm import decisions, mixing, packing, rules, secrets, simhash, toxicity
from enrollspark.llm.common import crc_bucket, read_table, stage
from llm_data import SF, documents, edge_rows
from pyspark.sql import functions as F
from test_simhash import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
assert decisions and toxicity  # the pipeline leaves them out


def test_stages_one_by_one(spark):
    docs = read_table(spark, SF, "documents")
    assert [n for n, _ in C.STAGES] == ["quality", "near_dedup", "secret_scan", "mix", "pack"]
    good = stage(C.quality(spark, docs, SF), "t")
    assert good.columns == COLUMNS
    m = rules.learn_quality(docs, read_table(spark, SF, "labels"), crc_bucket(F.col("doc_id"), 5) != 0)
    want = {r["doc_id"] for r in rules.score_quality(docs, m).collect() if r["score"] >= rules.POINT}
    rows = good.collect()
    assert {r["doc_id"] for r in rows} == want and len(want) < docs.count()

    one = stage(C.near_dedup(spark, good, SF), "t")
    keep = {c for _, _, c in brute_components([(r["doc_id"], r["text"]) for r in rows])}
    assert one.columns == COLUMNS and sorted(r["doc_id"] for r in one.collect()) == sorted(keep)

    safe = stage(C.secret_scan(spark, one, SF), "t")
    text = {r["doc_id"]: r["text"] for r in one.collect()}
    assert safe.columns == COLUMNS
    for r in safe.collect():
        assert r["text"] == secrets.mask(text[r["doc_id"]]) and r["n_chars"] == len(r["text"])

    mixed = stage(C.mix(spark, safe, SF), "t")
    assert mixed.columns == COLUMNS and sorted(map(tuple, mixed.collect()), key=str) == sorted(map(tuple, safe.collect()), key=str)
    place = {r["doc_id"]: r["position"] for r in mixing.mix_sources(safe).collect()}
    got = mixed.select("doc_id", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("m")).collect()
    order = [place[r["doc_id"]] for r in sorted(got, key=lambda r: (r["f"], r["m"]))]
    assert order == sorted(order)

    packed = C.pack(spark, mixed, SF).collect()
    pieces = packing.token_pieces(mixed).collect()
    assert sorted(map(tuple, pieces)) == sorted(tuple(r)[:5] for r in packed)


def test_run_equals_its_stages(spark):
    out = C.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    docs = read_table(spark, SF, "documents")
    for _, f in C.STAGES:
        docs = stage(f(spark, docs, SF), "t")
    key = lambda r: tuple(r)[:5]
    assert sorted(map(key, out.collect())) == sorted(map(key, docs.collect()))


def test_edge_rows_and_empty_tables_pass_every_stage(spark):
    for rows in (edge_rows(), []):
        docs = documents(spark, rows)
        for name, f in C.STAGES:
            docs = stage(f(spark, docs, SF), "t")
            assert name == "pack" or docs.columns == COLUMNS
        docs.collect()
    assert simhash.BITS == 4 and simhash.SHINGLE == 4
