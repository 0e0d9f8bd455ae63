"""Each stage on what the one before it kept, against the operators' own brute force."""

import collections

import corpus_pipeline
from tests.llm.test_dedup import brute_links, brute_removed


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        before, after = {r.doc_id: r for r in docs.collect()}, out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        if name == "exact_dedup":
            assert {r.doc_id for r in after} == set({r.text: k for k, r in sorted(before.items())}.values())
        if name == "near_dedup":
            ids = sorted(before)
            links = brute_links([before[k].text for k in ids])
            assert {r.doc_id for r in after} == {ids[k] for k, root, _ in links if root == k}
        if name == "suffix_dedup":
            ids = sorted(before)
            want = {k: x[0].decode("utf-8", "ignore") for k, x in zip(ids, brute_removed([before[k].text for k in ids], 200))}
            assert {r.doc_id: r.text for r in after} == want
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "packing":
            assert {r.doc_id for r in after} == set(before)
        kept[name] = len(after)
        docs = out
    assert collections.Counter(len(r.ids) // 4 == r.length for r in after)[False] == 0
    assert kept["toxicity"] > 0.8 * spark.read.parquet(f"{sf}/documents.parquet").count()
    assert corpus_pipeline.run(spark, sf).count() == kept["packing"]
