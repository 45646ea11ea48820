"""The five stages against the brute-force versions of their operators, and the SQL of the licence scan."""



import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import public_tokenizers
import corpus_pipeline
from tabspark.llm import quality, queries
from tests import oracle_check
from tests.llm import test_decontaminate, test_neardup, test_secrets
from tests.llm.fixtures import rows

JUNK = ["BUY!!", "xx$$", "click***", "now###"]


def tables(spark, path):
    """documents with junk and contaminated texts and secrets, labels that tell the junk, and a benchmark."""
    import random

    rng = random.Random(9)
    data, items = test_decontaminate.planted()
    data = [r for r in data if r[0] is not None] + [r for r in test_secrets.planted() if r[0] is not None and r[0] >= 500]
    data = list({r[0]: r for r in data}.values())
    data += [(1000 + i, " ".join(rng.choice(JUNK) for _ in range(30 + i))) for i in range(40)]
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in data],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 1000), 0) for i, t in data], "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return data, items


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    return path, *tables(spark, path)


def test_stages(spark, corpus, tmp_path):
    path, data, items = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    model = quality.train(docs, spark.read.parquet(f"{path}/labels.parquet"))
    kept = [(i, t) for i, t in data if quality.text_scores(pa.array([t or ""]), *model.shares())[0] >= 0.7]
    assert all(i < 1000 for i, _ in kept) and len(kept) > 0.9 * sum(i < 1000 for i, _ in data)
    groups = test_neardup.brute(kept)
    text_of = dict(kept)
    one_each = [(min(map(int, g)), text_of[min(map(int, g))]) for g in groups]
    bad = {r[0] for r in test_decontaminate.brute(one_each, items)}
    clean = [(i, t) for i, t in one_each if i not in bad]
    want = [kept, one_each, clean]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if k < 3:
            assert docs.columns == columns
            assert sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["text"] is not None) == sorted(
                r for r in want[k] if r[1] is not None), name
        elif k == 3:
            assert docs.columns == columns and docs.count() == len(clean)
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect() if r["text"] is not None)
            for i, t in clean:
                assert (texts[i] == t) == (not test_secrets.base(t or "")) or i == 600
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = docs.collect()
    assert sum(r["length"] for r in pieces) == sum(len(t.encode(x or "", add_special_tokens=False).ids) + 1
                                                    for x in texts.values())
    assert {r["doc_id"] for r in pieces} == {i for i, _ in clean}


def test_run_equals_the_stages(spark, corpus):
    path, _, _ = corpus
    assert corpus_pipeline.run(spark, path).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_licence_sql(spark):
    con = oracle_check.duck("/root/testdata/sf0.001")
    for name, sql in queries.SQL.items():
        message, same = oracle_check.compare(spark, con, name, queries.QUERIES[name], sql, "/root/testdata/sf0.001")
        assert same, message
