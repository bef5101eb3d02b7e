import hashlib
import zlib

import pytest

from skyledger.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx string, size string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def climb(nodes, children):
    """The root and, for each node, its siblings before and after on each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            begin = place - place % children
            run = nodes[begin: begin + children]
            paths[i].append(("".join(run[: place - begin]), "".join(run[place - begin + 1:])))
            at[i] = place // children
        nodes = [h(*nodes[i: i + children]) for i in range(0, len(nodes), children)]
    return nodes[0], paths


def brute(rows, children=3):
    """Rows of (leaf, subroot, root, proof, path) as a sorted list."""
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf_of(*r), r))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: climb([x[2] for x in sorted(trees[s], key=lambda x: x[:3])], children) for s in names}
    root, upper = climb([built[s][0] for s in names], children)
    out = []
    for place, s in enumerate(names):
        for x, path in zip(sorted(trees[s], key=lambda x: x[:3]), built[s][1]):
            whole = path + upper[place]
            out.append((x[2], built[s][0], root, h(*(b + a for b, a in whole)), tuple(whole)))
    return sorted(out)


def plain(frame):
    found = frame.select("leaf", "subroot", "root", merkle.proof(merkle.F.col("path")).alias("proof"), "path").collect()
    return sorted((r.leaf, r.subroot, r.root, r.proof, tuple((s.before, s.after) for s in r.path)) for r in found)


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(partitions)


def rows_of(n, sources):
    return [(i * 7 % 1000, f"text {i}\nß", "en" if i % 2 else None, sources[i % len(sources)], i) for i in range(n)]


@pytest.mark.parametrize("children", [2, 3, 5])
def test_trees_against_a_direct_version(spark, children):
    rows = rows_of(83, ["a", "a", "a", "b", None, "Z", "é"]) + [(1, "one", None, "alone", 3)]
    assert plain(merkle.manifest(table(spark, rows), children)) == brute(rows, children)


def test_defined_cases(spark):
    long = "word\n" * 400_000
    rows = [(None, None, None, None, None), (None, "", "", "", 0), (5, "same", "en", "s", 4), (5, "same", "en", "s", 4), (5, "other", "en", "s", 4),
            (6, long, "en", "s", len(long)), (-3, "-", "-", "-", 1), (7, "4:text", None, "s", None)]
    assert plain(merkle.manifest(table(spark, rows))) == brute(rows)
    assert plain(merkle.manifest(table(spark, rows[:1]))) == brute(rows[:1]) == [(leaf_of(*rows[0]),) * 3 + (h(), ())]
    assert merkle.manifest(table(spark, rows).where("doc_id > 99")).collect() == []
    copies = [(1, "copy", None, "s", 4)] * 30 + rows_of(10, ["s", "t"])
    assert plain(merkle.manifest(table(spark, copies, 8))) == brute(copies)


def test_tampered_documents_do_not_verify(spark):
    folder = "/root/testdata/sf0.001"
    documents = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op13_merkle(spark, folder).collect()
    assert len(found) == len(documents)
    touched = {i for i, r in documents.items() if zlib.crc32(str(i).encode()) % 2 == 0 and r.text and "\n" in r.text}
    assert {r.doc_id for r in found if not r.verified} == touched and 0 < len(touched) < len(found)
    assert all(r.verified == (r.folded_root == r.root) for r in found)
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in documents.values()]
    assert sorted((r.leaf, r.subroot, r.root, r.proof_sha256) for r in found) == [b[:4] for b in brute(rows)]


def test_plan_does_not_grow_with_the_levels(spark):
    """The proofs of all levels used to be joined in one plan."""
    joins = []
    for rows in (30, 300):
        docs = spark.createDataFrame([(i, f"text {i}", "en", "web", 6) for i in range(rows)], "doc_id long, text string, lang string, source string, n_chars long")
        plan = merkle.manifest(docs)._jdf.queryExecution().optimizedPlan().toString()
        joins.append(plan.count("Join "))
    assert joins[0] == joins[1] <= 4
