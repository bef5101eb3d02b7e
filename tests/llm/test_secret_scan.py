import hashlib
import random
import re

import regex
from pyspark.sql import functions as F

from skyledger.llm import queries, secret_scan as S

KEY = re.compile(r'token = "([0-9a-f]{40})"')


def test_whole_table(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    found = queries.op3_secret_scan(spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(rows)
    planted = 0
    for r in found:
        text, want = rows[r.doc_id], [m.span(1) for m in KEY.finditer(rows[r.doc_id])]
        planted += len(want)
        assert [(s.start, s.start + s.length) for s in r.secrets] == want
        assert r.n_candidates == len(regex.findall(S.CANDIDATE, text)) and r.n_secrets == len(want)
        assert r.redacted_sha256 == hashlib.sha256(KEY.sub(f'token = "{S.MASK}"', text).encode()).hexdigest()
    assert planted > 5


def sentence(rng):
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9))) for _ in range(20))


def corpus(rng):
    rows = []
    for i in range(120):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        rows.append((i, f'{sentence(rng)}\napi_key = "{key}" {sentence(rng)} {"".join(rng.choice("aeilnrst") for _ in range(22))} {rng.randrange(10**15, 10**16)}'))
    return rows


def test_forest_knows_secrets_without_their_words(docs_of):
    rng = random.Random(4)
    secret = "9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c"
    rows = corpus(rng) + [(500, f"see {secret} there"), (501, "internationalisation of thesoftwarepackage"), (502, f"{secret}, {secret}"), (503, "1234567890123456")]
    found = {r.doc_id: r.scan for r in S.scan(docs_of(rows)).collect()}
    assert [(s.start, s.length) for s in found[500].secrets] == [(4, 40)]
    assert [(s.start, s.length) for s in found[502].secrets] == [(0, 40), (42, 40)]
    assert found[502].redacted == f"{S.MASK}, {S.MASK}"
    assert not found[501].secrets and found[501].n_candidates == 2 and not found[503].secrets
    held = [r.scan for r in S.scan(docs_of(rows)).where("doc_id < 120").collect()]
    assert all(len(s.secrets) == 1 and s.n_candidates == 3 for s in held)


def test_labelled_findings_can_be_given(spark, docs_of):
    docs = docs_of(corpus(random.Random(5)))
    findings = S.labelled_findings(docs, []).withColumn("label", F.lit(1.0) - F.col("label"))
    found = S.scan(docs, findings=findings).collect()
    assert all(s.length != 40 for r in found for s in r.scan.secrets)


def test_defined_cases(docs_of):
    rows = [(1, None), (2, ""), (3, "short"), (4, "x" * 300_000), (None, "k = 'a1b2c3d4e5f6a7b8c9d0'"), (5, "é汉\U0001f642 token: 'a1b2c3d4e5f6a7b8c9d0' é"), (5, "é汉\U0001f642 token: 'a1b2c3d4e5f6a7b8c9d0' é")]
    docs = docs_of(rows)
    out = S.scan(docs).collect()
    by = {r.doc_id: r.scan for r in out}
    assert len(out) == len(rows) and by[1].redacted is None and by[1].n_candidates == 0 and by[2].redacted == ""
    assert [(s.start, s.length) for s in by[5].secrets] == [(12, 20)]
    clean = S.redact(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert texts[1] == (None, None) and texts[3] == ("short", 5) and texts[5][0] == f"é汉\U0001f642 token: '{S.MASK}' é" and texts[5][1] == len(texts[5][0])
    assert S.redact(docs.where("doc_id > 99")).collect() == []


def test_a_repeated_finding_is_one_example(docs_of):
    rows = corpus(random.Random(6)) + [(1000 + i, "the same internationalisation " * 2) for i in range(2500)]
    found = S.labelled_findings(docs_of(rows), [], training=50).where("label = 0").collect()
    assert len(found) == 100  # with and without neighbouring words
    rows = [(i, "same internationalisation word") for i in range(5000)] + corpus(random.Random(7))
    plain = S.labelled_findings(docs_of(rows), []).where("label = 0").count()
    assert plain == 2 * 241  # 120 words, 120 numbers and the repeated word


PROBES = [  # text, the secret in it or None
    ('AWS_SECRET_ACCESS_KEY = "wJalrXUtnFEMIK7MDENGbPxRfiCYzzEXKEYq4w9T"', "wJalrXUtnFEMIK7MDENGbPxRfiCYzzEXKEYq4w9T"),
    ("api_key=0123456789abcdef0123 ", "0123456789abcdef0123"),
    ('db_password = "hunter2!Tr0ub4"', "hunter2!Tr0ub4"),
    ('password: "Xk9q2Lm4"', "Xk9q2Lm4"),
    ("src/main/java/org/example/service/Reader is a file", None),
    ("fixed by commit 9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c yesterday", None),
    ("at https://example.org/assets/9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c there", None),
    ("id: 550e8400-e29b-41d4-a716-446655440000", None),
    ("password: required", None),
]


def probed(docs_of, rows):
    found = S.scan(docs_of(rows + [(9000 + i, text) for i, (text, _) in enumerate(PROBES)])).where("doc_id >= 9000").collect()
    spans = {r.doc_id - 9000: [r.text[s.start:s.start + s.length] for s in r.scan.secrets] for r in found}
    return {PROBES[i][0]: spans[i] for i in range(len(PROBES))}


def test_names_paths_and_hashes_are_no_secrets(docs_of):
    want = {text: [secret] if secret else [] for text, secret in PROBES}
    assert probed(docs_of, corpus(random.Random(8))) == want
    assert probed(docs_of, []) == want  # nothing to learn from but the made examples


def test_the_vote_recomputed(docs_of):
    docs = docs_of(corpus(random.Random(9))[:40] + [(9000 + i, text) for i, (text, _) in enumerate(PROBES)])
    known = S.dictionary(docs)
    model = S.forest(S.labelled_findings(docs, known).union(S.examples(docs.sparkSession, known)))
    rows = S.scanned(docs, known, "_s").select(F.explode("_s.found").alias("c")).select(F.col("c.of").alias("of"), S.probability(model, F.col("c.of")).alias("p")).collect()

    def tree(node, values):
        while node.subtreeDepth() > 0:
            split = node.split()
            node = node.leftChild() if values[split.featureIndex()] <= split.threshold() else node.rightChild()
        return node.prediction()

    assert len(rows) > 100
    for r in rows[::7]:
        values = [r.of[f] for f in S.FEATURES]
        assert abs(r.p - sum(tree(t._java_obj.rootNode(), values) for t in model.trees) / len(model.trees)) < 1e-12
