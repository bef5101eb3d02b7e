import duckdb
import pytest

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples, plus an extra column that clashes."""

    def build(rows, partitions=3):
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1]), "extra") for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, size string"
        return spark.createDataFrame(full, schema).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def sql():
    """Run DuckDB SQL over the tables of a test folder."""

    def run(statement, sf_dir=f"{TESTDATA}/sf0.01"):
        con = duckdb.connect()
        for name in ("documents", "conversations", "labels", "embeddings", "pages"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
        return con.execute(statement).df()

    return run


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text, lang, source) of the small documents table, in Python."""
    con = duckdb.connect()
    return con.execute(f"SELECT doc_id, text, lang, source FROM '{TESTDATA}/sf0.001/documents.parquet'").fetchall()
