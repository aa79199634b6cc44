"""Queries of the text operators against their SQL, and all of them on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest
from compare import differences

from shotmarts.llm import queries as text

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(text.oracle_sql()))
def test_like_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    expected = con.execute(text.oracle_sql()[name]).to_arrow_table()
    assert differences(text.queries()[name](spark, FOLDER).toArrow(), expected) is None


def test_line_rules_like_sql_with_every_space(spark, tmp_path):
    """Lines of only CR, VT or FF hold no word, in both engines."""
    body = " ".join(f"w{i}" for i in range(60))
    texts = [
        f"{body}\n\r\n{body}\n\x0b\n\x0c\nend", f"{body}\r\n{body}\r\nx\x0by", "\r\n\x0b\x0c", None,
        f"{body}\n{body}\n{body}",
    ]
    rows = [(i, t, "en", f"s{i % 2}", None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    name = "op8_line_frequency_rules"
    expected = con.execute(text.oracle_sql()[name]).to_arrow_table()
    assert differences(text.queries()[name](spark, str(tmp_path)).toArrow(), expected) is None
