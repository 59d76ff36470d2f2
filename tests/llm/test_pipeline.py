"""The pipeline against a brute-force version of its five stages."""

import collections

import duckdb
import pandas as pd

import corpus_pipeline
from voltspan.llm import decontamination, language, mixing, near


def brute_classes(docs):
    """First document of each class of documents connected by similarity 0.8 or more."""
    sets = {i: set(near.shingles(t).tolist()) for i, t in docs}
    lead = {i: i for i in sets}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and both * 10 >= (len(sets[a]) + len(sets[b]) - both) * 8:
                x, y = find(a), find(b)
                lead[max(x, y)] = min(x, y)
    return {i for i in ids if find(i) == i}


def brute_hit(text, items):
    own = decontamination.words(text)
    return any(
        own[i : i + n] == item[j : j + n]
        for item in items if item
        for n in [min(10, len(item))]
        for j in range(len(item) - n + 1)
        for i in range(len(own) - n + 1)
        if own[i] == item[j]
    )


def test_run_matches_brute_force(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert set(docs.columns) | {"size", "text_crc32", "shard", "slot"} == set(got.columns)
    judge = language.Classifier(language.learn(docs.filter(~language.held_out(docs["doc_id"])).select("text", "lang"))).judge
    rows = [r for r in docs.collect() if not judge(r.text)[2]]
    stay = brute_classes([(r.doc_id, r.text) for r in rows])
    items = [decontamination.words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = [r for r in rows if r.doc_id in stay and not brute_hit(r.text, items)]
    assert 0.7 * docs.count() < len(left) < docs.count()
    documents = pd.DataFrame([(r.doc_id, r.text, r.source) for r in left], columns=["doc_id", "text", "source"])  # noqa: F841  (read by name)
    want = {i: taken // size for i, size, _, _, taken in duckdb.sql(mixing.ORACLE).fetchall() if taken}
    found = got.select("doc_id", "shard", "slot").collect()
    assert collections.Counter(r.doc_id for r in found) == want
    for shard in range(8):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_stages_keep_the_columns_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, docs, sf_dir)
        assert out.count() == 0 and set(docs.columns) <= set(out.columns)
        assert name == "sharding" or out.columns == docs.columns


def test_filters_hand_on_columns_named_like_their_own(spark, sf_dir):
    names = "score lang_pred rejected n_words n_hit items hit_starts hit_ends Contaminated size copies taken target source_size _size _upto _id _key _own _src _place "
    names = (names + "shard slot text_crc32 _point _order _piece node label class_id text_key stays _in0 _own_size").split()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id % 5 = 0")
    docs = docs.selectExpr("*", *[f"concat('{name} ', doc_id) as {name}" for name in names])
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, docs, sf_dir)
        if name == "sharding":
            own = {"size": "own_size", "shard": "own_shard", "slot": "own_slot", "text_crc32": "own_text_crc32"}
            out = out.drop(*own).withColumnsRenamed({v: k for k, v in own.items()})
        assert sorted(out.columns) == sorted(docs.columns)
        rows = out.select("doc_id", *names).collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names), name
