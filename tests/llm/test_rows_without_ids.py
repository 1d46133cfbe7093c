"""op4 on many rows without an id."""

from __future__ import annotations

from collections import Counter

from tidemark.llm.jaccard_join import ngram_jaccard_join, one_of_each


def test_a_set_is_fetched_from_its_own_row(spark, monkeypatch):
    pairs = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(20)]
    rows = [(None, text + more) for text in pairs for more in ("", " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    fetched = []
    plain = type(df).mapInArrow

    def counted(self, func, *args, **more):
        if func.__name__ == "fetch":
            fetched.append(self.count())
        return plain(self, func, *args, **more)

    monkeypatch.setattr(type(df), "mapInArrow", counted)
    found = ngram_jaccard_join(df).collect()
    assert fetched == [len(rows)]
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter({(None, 38, None): 20, (None, 39, None): 20})
    assert len(one_of_each(df).collect()) == len(pairs)
