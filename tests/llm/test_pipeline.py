"""The stages of the pipeline on a small corpus, each against a brute-force version of itself."""

import random

import numpy as np

import corpus_pipeline
from ledgerloom.llm import mixing, packing


def test_stages(spark, corpus, clash, tmp_path):
    ran = random.Random(11)
    words = [f"word{i}" for i in range(2000)]
    prose = lambda n: [ran.choice(words) for _ in range(n)]
    passage = " ".join(prose(60))
    texts = [" ".join(prose(ran.randint(40, 120))) for _ in range(500)]
    toxic = [int(i % 4 == 1) for i in range(500)]
    for i in range(500):
        if toxic[i]:
            texts[i] += " vile rotten"
        elif i % 25 == 0:
            texts[i] += " " + passage
    near = texts[2].split()
    near[len(near) // 2] = "changed"
    texts += [texts[0], texts[2].upper(), " ".join(near), None, ""]
    toxic += [0] * 5
    docs = clash(corpus(texts, sources=[ran.choice("abc") for _ in texts]))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    after = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, at, str(tmp_path))
        made.write.parquet(f"{tmp_path}/{k}")
        at = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert at.columns == docs.columns
        after.append(at)

    kept = {r.doc_id: r.text for r in after[0].collect()}
    assert np.mean([(i not in kept) == bool(y) for i, y in enumerate(toxic)]) > 0.97
    unique = {r.doc_id: r.text for r in after[1].collect()}
    assert 500 not in unique and 501 not in unique and 502 not in unique and 2 in unique
    assert set(kept) - set(unique) <= {500, 501, 502, 503, 504}
    single = {r.doc_id: r.text for r in after[2].collect()}
    holders = [i for i, t in unique.items() if t and passage in t]
    assert len(holders) > 5 and sum(passage in (t or "") for t in single.values()) == 1
    assert all(single[i] == unique[i] for i in single if i not in holders)
    taken = {r.doc_id: r.copies for r in mixing.mix(after[2]).collect()}
    assert {r.doc_id: r["count"] for r in after[3].groupBy("doc_id").count().collect()} == {i: n for i, n in taken.items() if n}
    pieces = after[4].collect()
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)
    sizes = {}
    for r in pieces:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    assert all(sizes[s] == packing.LENGTH for s in range(len(sizes) - 1))


def test_run_is_registered(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in __spark_entry__.oracle_sql()
    assert sorted(n for n in __spark_entry__.queries() if n.startswith("op")) == sorted(
        ["op1_token_counts", "op2_mixed_sources", "op3_imatch_fingerprints", "op4_pseudo_likelihood", "op5_suffix_array_removals",
         "op6_debruijn_removals", "op7_learned_partition_search", "op8_toxicity", "op9_simhash_components", "op10_packed_pieces", "op11_token_alignment", "op12_parity_components", "op13_spelling_variants"])
