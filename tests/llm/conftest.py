import duckdb
import pytest

SF = "/root/testdata/sf0.001"
ODD_TEXTS = [None, "", " \t\n", "one", "one two", "One  TWO three", "a " * 40, "word " * 30_000, "x" * 200_000, "é ß 日本語 \U0001f600 a\u0085b\x1cc\xa0d", "same text of some words here", "same text of some words here"]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in any column, empty and very long texts, ties and repeated rows, and columns that operators add themselves."""
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None if t is None else len(t), "x", 1, "y", True, 2.0) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (3, "another text with the id three", "en", "s1", 5, "x", 1, "y", True, 2.0), (None, "no id at all", "en", "s1", 5, "x", 1, "y", True, 2.0), (None, None, None, None, None, None, None, None, None, None)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, shard string, copies int, kept_text string, removed boolean, target double"
    return spark.createDataFrame(rows, kinds)


@pytest.fixture(scope="session")
def documents():
    return sorted(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
