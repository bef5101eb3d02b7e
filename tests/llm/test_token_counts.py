import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import queries, token_counts

PATH = public_tokenizers.path(token_counts.TOKENIZER)
HARD = [
    None, "", " ", "a b", "  two  spaces \n\n x", "it's we'll a'b ' s", "x<|endoftext|>y <|endoftext|> z", "no break  x y z",
    "line\nnext\r\nthird\tcol", "é à\nü ñ", "汉字 混 排 x", "🙂 🙂 a", "tail ", " head", "1 2 33 a1 b", "x" * 70_000, "ab " * 30_000, "a 　b \u0085c",
    "é\u0085 x", "\x1c a \x1f b", "ж д и ж",
]


def expected(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(tokenizer.encode(t or "", add_special_tokens=False)) for t in texts]


def test_hard_texts(docs_of):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(1, ""), (4, HARD[4]), (None, "a b")]
    got = token_counts.token_counts(docs_of(rows), PATH).collect()
    want = sorted(zip([r[0] for r in rows], expected([r[1] for r in rows])), key=str)
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == want
    assert {r.n_bytes for r in got if r.doc_id == 9} == {len(HARD[9].encode())}
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_small_chunks_agree(docs_of, monkeypatch):
    monkeypatch.setattr(token_counts.B, "CHUNK", 10)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs_of(list(enumerate(HARD)), 1), PATH).collect()}
    assert [got[i] for i in range(len(HARD))] == expected(HARD)


def test_empty_table(docs_of):
    assert token_counts.token_counts(docs_of([(1, "a")]).where("doc_id > 1"), PATH).collect() == []


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_whole_table(spark, documents, folder):
    got = {r.doc_id: r.n_tokens for r in queries.op2_token_counts(spark, f"/root/testdata/{folder}").collect()}
    assert got == dict(zip([d[0] for d in documents], expected([d[1] for d in documents])))
