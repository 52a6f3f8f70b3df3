"""The pipeline: each stage against brute force over what the stage before kept."""

import re

from helpers import edge_docs, no_docs
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline as pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixing", "packing"]
    kept = [docs]
    for name, stage in pipeline.STAGES:
        kept.append(spark.createDataFrame(stage(spark, kept[-1], SF).collect(), schema=stage(spark, kept[-1], SF).schema))
    columns = docs.columns
    assert all(k.columns == columns for k in kept[:-1])
    rows = [{r.doc_id: r for r in k.collect()} for k in kept[:-1]]
    assert set(rows[1]) == set(rows[0])  # every document here has a known language
    order = sorted(rows[1])
    firsts = brute_components([(i, brute_fingerprint(rows[1][i].text)) for i in order])
    assert set(rows[2]) == set(firsts)
    assert all(rows[2][i] == rows[1][i] for i in rows[2])
    assert set(rows[3]) == set(rows[2])
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert any(email.search(r.text) for r in rows[2].values()) and not any(email.search(r.text) for r in rows[3].values())
    assert all(r.n_chars == len(r.text) for r in rows[3].values())
    assert set(rows[4]) < set(rows[3]) and all(rows[4][i] == rows[3][i] for i in rows[4])
    pieces = kept[-1].collect()
    assert {r.doc_id for r in pieces} == set(rows[4])
    whole = pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, pieces)) or whole.count() > 0


def test_stages_bear_edges_and_emptiness(spark):
    import corpus_pipeline as pipeline
    for docs in (edge_docs(spark, clash=True), no_docs(spark)):
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.dtypes == docs.dtypes
            out.collect()
