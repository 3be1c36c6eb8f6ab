"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from civicmill.llm.queries import ORACLES, QUERIES
from tests.llm.test_operators import brute_components, brute_fingerprint, brute_hits
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    equal, message = compare(QUERIES[name](spark, SF), duck(SF), ORACLES[name])
    assert equal, message


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(f"{tmp_path}/{i}")
        seen.append(spark.read.parquet(f"{tmp_path}/{i}"))
        if i < 4:
            assert seen[-1].columns == docs.columns and seen[-1].count() <= seen[-2].count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    assert seen[0].join(labels, "doc_id").count() - seen[1].join(labels, "doc_id").count() <= 2
    lines = {r["doc_id"]: r["text"] for r in seen[2].collect()}
    texts = sorted(lines)
    prints = {i: brute_fingerprint(lines[i]) for i in texts}
    groups = brute_components(texts, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert sorted(r["doc_id"] for r in seen[3].collect()) == sorted(set(groups.values()))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r["doc_id"] for r in seen[3].collect() if not brute_hits(r["text"], items)[0]]
    assert sorted(r["doc_id"] for r in seen[4].collect()) == sorted(clean)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    one, two = (sorted(map(tuple, d.select(*key).collect())) for d in (seen[5], corpus_pipeline.run(spark, SF)))
    assert one == two and {r[0] for r in one} == set(clean)
