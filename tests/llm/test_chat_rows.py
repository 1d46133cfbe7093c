"""op5 on rows that the given tables do not have: null roles, null turns, turns that repeat."""

from __future__ import annotations

import hashlib

import pytest

from tidemark.llm.catalogue import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_each_row_is_a_message(spark, tmp_path):
    unique = [(1, 0, None, "said by nobody\nin two lines"), (1, 1, "assistant", "a\nb\n"), (1, None, "user", "last, turn is null"),
              (2, 0, None, None), (2, 1, "assistant", None), (None, 3, "user", "no conversation"), (-1, 2, "user", "after the forged turns")]
    copies = [(3, 5, "assistant", "x\ny\nz")] * 3 + [(4, None, "assistant", "p\nq")] * 2
    ties = [(5, 7, "user", "second"), (5, 7, "assistant", "one\ntwo"), (5, 7, "assistant", "four\nfive"), (5, 7, None, "first"), (5, 2, "system", "s")]
    rows = unique + copies + ties
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    df = QUERIES["op5_format_chats"](spark, str(tmp_path))
    database = duckdb.connect()
    database.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    result = database.execute(SQL["op5_format_chats"])
    columns = [c[0] for c in result.description]
    expected = {r[0]: dict(zip(columns, r)) for r in result.fetchall()}
    found = {r.conv_id: r.asDict() for r in df.collect()}
    tied, by_sql = found.pop(5), expected.pop(5)
    assert found == expected
    assert tied["n_turns"] == 5
    # The order of equal turns is open in the SQL; here it is by role and text.
    for column in ("n_turns", "loss_chars", "formatted_chars"):
        assert tied[column] == by_sql[column]
    order = sorted(((t, r or "", x or "") for c, t, r, x in ties))
    assert tied["turns_sha256"] == sha("".join(f"{r}\n{x}\n" for _, r, x in order))
    assert tied["loss_sha256"] == sha("".join(x for _, r, x in order if r == "assistant"))
