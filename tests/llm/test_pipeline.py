import re
from collections import Counter, defaultdict

import corpus_pipeline as P
from skyledger.sources.tables import stage
from test_near_dedup import brute

KEY = re.compile(r'token = "[0-9a-f]{40}"')


def test_every_stage_against_plain_python(spark, docs_of):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = docs_of([(90_001, None), (90_002, "12 345 !!"), (90_003, ""), (90_004, "mot unique ici", "fr", "src1")]).select(table.columns)
    docs, outs = table.union(extra), []
    for name, step in P.STAGES:
        docs = stage(step(spark, docs, "/root/testdata/sf0.001"), name)
        outs.append(docs.collect())
        if name != "packing":
            assert docs.columns == table.columns
    start = table.union(extra).collect()
    spoken, single, masked, mixed, packed = outs
    assert sorted(r.doc_id for r in spoken) == sorted(r.doc_id for r in start if r.text and re.search(r"[^\W\d_]", r.text))
    kept = {d for d, _, c, k in brute([(r.doc_id, r.text) for r in spoken], width=5) if k}
    assert sorted(r.doc_id for r in single) == sorted(kept)
    texts = {r.doc_id: r.text for r in single}
    assert {r.doc_id: r.text for r in masked} == {i: KEY.sub('token = "[SECRET]"', t) for i, t in texts.items()}
    assert all(r.n_chars == len(r.text) for r in masked)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in masked} and max(Counter(r.doc_id for r in mixed).values()) <= 2
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in mixed)
    fills = defaultdict(int)
    for r in packed:
        fills[r.sequence_id] += r.length
    assert max(fills.values()) <= 4096 and len(fills) <= -(-sum(fills.values()) // 4096) + 1


def test_empty_table(spark, docs_of):
    docs = docs_of([(1, "a")]).where("doc_id > 1")
    for name, step in P.STAGES:
        docs = stage(step(spark, docs, ""), name)
    assert docs.count() == 0


def test_run(spark):
    assert P.run(spark, "/root/testdata/sf0.001").where("piece = 0").count() > 100
