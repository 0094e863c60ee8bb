import hashlib
import tracemalloc

import corpus_pipeline
import numpy as np
import pandas as pd

from hilvan.llm import bpe, decontaminate, groups, jaccard_join, quality_rules, secret_scan
from hilvan.llm.catalog import QUERIES, SQL, vocabulary

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in quality_rules.quality_counts(docs).filter("kept").collect()}
    first = docs.filter(docs.doc_id.isin(*good))
    leaders = {r.component_id for r in jaccard_join.jaccard_components(first).collect()}
    second = first.filter(first.doc_id.isin(*leaders))
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    dirty = {r.doc_id for r in decontaminate.contamination(second, benchmark).filter("contaminated").collect()}
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = {}
    for r in second.collect():
        if r.doc_id not in dirty:
            text = secret_scan.masked(r.text, secret_scan.scan(r.text)[1], "[SECRET]")
            want[r.doc_id] = np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(want)
    assert all(bytes(got[k].ids) == v and got[k].ids_sha256 == hashlib.sha256(v).hexdigest() for k, v in want.items())
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_stages_keep_the_columns_and_take_nulls(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(1).union(spark.createDataFrame([(None, None, None, None, None)] * 2, docs.schema))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert dict(out.dtypes) == dict(docs.dtypes) and out.columns == docs.columns
        out.collect()


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


def test_jobs_of_the_join_hand_small_batches_to_python(spark, docs, monkeypatch):
    seen, links = [], jaccard_join.class_links

    def spied(*args):
        seen.append(spark.conf.get(groups.BATCH_BYTES))
        return links(*args)

    monkeypatch.setattr(jaccard_join, "class_links", spied)
    rows = docs(["a b c d e f", "a b c d e f", "g h"])
    before = spark.conf.get(groups.BATCH_BYTES, None)
    spark.conf.unset(groups.BATCH_BYTES)
    try:
        assert jaccard_join.keep_one(rows).count() == 2 and spark.conf.get(groups.BATCH_BYTES, None) is None
        spark.conf.set(groups.BATCH_BYTES, "1m")  # a limit of the session stays
        assert jaccard_join.keep_one(rows).count() == 2 and spark.conf.get(groups.BATCH_BYTES) == "1m"
    finally:
        spark.conf.unset(groups.BATCH_BYTES) if before is None else spark.conf.set(groups.BATCH_BYTES, before)
    assert [int(s.rstrip("bm")) for s in seen] in ([2, 1], [2 << 20, 1 << 20])


def test_workers_keep_no_words_after_encoding(spark, docs):
    texts = [" ".join(f"word{i * 100 + j}" for j in range(100)) for i in range(40)]
    rows = docs(texts).repartition(8)
    encoded = bpe.encode_column(rows, vocabulary("byte_bpe_50k.json")).collect()

    def held(batches):
        for _ in batches:
            pass
        yield pd.DataFrame({"n": [len(e.known) + len(e.pieces) for e in bpe._encoders.values()]}, dtype="int64")

    left = [r.n for r in spark.range(0, 64, 1, 16).mapInPandas(held, "n long").collect()]
    assert left and set(left) == {0}
    assert len(encoded) == 40 and all(r.n_tokens > 100 for r in encoded)


def test_sets_of_many_texts_take_little_memory():
    texts = [" ".join(f"w{(i * 7919 + j * 31) % 5003}" for j in range(400)) for i in range(1500)]
    jaccard_join.shingle_sets([texts[0].encode()])
    tracemalloc.start()
    sizes = [len(s) for _, s in jaccard_join.batch_sets(range(len(texts)), texts, 5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(sizes) == 1500 and min(sizes) > 300
    assert peak < 16 << 20, peak
