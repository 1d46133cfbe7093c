"""Landing, raw, snapshot and history tables."""

from __future__ import annotations

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import spines
from tidemark.sources import catalog, files, kept_schema
from tidemark.sources import lifecycle as life
from tidemark.streaming.landing import land_new_files

MONDAY, TUESDAY = dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2, 5)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_json_lines_tolerate_some_bad_ones(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"id": "x", "object": "o"}\nbroken\n\n{"id": "y"}\n')
    rejects = str(tmp_path / "rejects")
    assert files.load_json_lines(spark, path, max_bad=files.MAX_BAD_RECORDS, rejects=rejects).count() == 2
    assert spark.read.parquet(rejects).count() > 0
    with pytest.raises(files.TooManyBadRecords):
        files.load_json_lines(spark, path)
    with pytest.raises(ValueError, match="rejects"):
        files.load_json_lines(spark, path, max_bad=1)


def test_csv_with_line_breaks_and_bad_records(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", 'id,text,n\n1,"two\nlines ""quoted""",5\n2,plain,6\n3,too,many,fields\n')
    rejects = str(tmp_path / "rejects")
    found = files.load_csv(spark, path, schema="id int, text string, n int", max_bad=1, multi_line=True, rejects=rejects)
    assert rows(found) == [(1, 'two\nlines "quoted"', 5), (2, "plain", 6)]
    assert [r.record for r in spark.read.parquet(rejects).collect()] == ["3,too,many,fields"]
    with pytest.raises(files.TooManyBadRecords):
        files.load_csv(spark, path, schema="id int, text string, n int", multi_line=True)
    inferred = files.load_csv(spark, write(tmp_path / "b.csv", "id,at\n1,2024-01-01\n"))
    assert inferred.dtypes[0] == ("id", "int")


PIECES = ["plain", "two\nlines \"\"quoted\"\"", "a,b,c", '""', 'x""\n""y', "", "\n\n\n", '""""\n', "é\n日本", "long " * 40 + "\n"]


def csv_text(seed):
    """Quoted line breaks, doubled and stray quotes, blank lines, records of the wrong shape."""
    pick = random.Random(seed)
    end = pick.choice(["\n", "\r\n"])
    lines = ["id,text,n"]
    for i in range(200):
        field = '"' + pick.choice(PIECES).replace("\n", pick.choice(["\n", end])) + '"'
        field = pick.choice([field, field, field, "bare", '5" pipe', '"closed"and more'])
        lines.append(pick.choice([f"{i},{field},{i}"] * 15 + [f"{i},too,many,fields", "x,bad,1", "", f"{i}"]))
    return end.join(lines) + pick.choice([end, ""])


@pytest.mark.parametrize("block", [64, 700, 1 << 27])
def test_csv_in_blocks_equals_one_task(spark, tmp_path, block):
    for name in ("a", "b", "c"):
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            f.write(csv_text(f"{name}{block}"))
    schema = "id int, text string, n int"
    whole = spark.read.options(header=True, quote='"', escape='"', multiLine=True, columnNameOfCorruptRecord="bad", columnPruning=False)
    whole = whole.schema(schema + ", bad string").csv(str(tmp_path)).collect()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        if block < 1000:
            assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 5
        found, rejected = files.split_csv(spark, str(tmp_path), schema, multi_line=True)
        assert Counter(map(tuple, found.collect())) == Counter(tuple(r)[:3] for r in whole if r.bad is None)
        assert Counter(r.record for r in rejected.collect()) == Counter(r.bad for r in whole if r.bad is not None)
        assert {r.file.rsplit("/", 1)[1] for r in rejected.collect()} == {"a.csv", "b.csv", "c.csv"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("block,batch", [(700, 1), (700, 4), (1 << 27, 3)])
def test_csv_blocks_are_streamed_in_batches(spark, tmp_path, block, batch):
    for name in ("a", "b"):
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            f.write(csv_text(f"{name}{block}{batch}"))
    schema = "id int, text string, n int"
    whole = spark.read.options(header=True, quote='"', escape='"', multiLine=True, columnNameOfCorruptRecord="bad", columnPruning=False)
    whole = whole.schema(schema + ", bad string").csv(str(tmp_path)).collect()
    settings = {"spark.sql.files.maxPartitionBytes": block, "spark.sql.execution.arrow.maxRecordsPerBatch": batch}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found, rejected = files.split_csv(spark, str(tmp_path), schema, multi_line=True)
        assert Counter(map(tuple, found.collect())) == Counter(tuple(r)[:3] for r in whole if r.bad is None)
        assert Counter(r.record for r in rejected.collect()) == Counter(r.bad for r in whole if r.bad is not None)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan  # no task sorts the lines of a block


def test_a_csv_block_needs_no_more_than_a_batch_and_a_record():
    import numpy as np
    import pyarrow as pa

    from tidemark.sources.csv_blocks import _blocks, _pieces

    given, rng = [0], random.Random(4)
    texts = ['1,"two', 'lines"', "2,plain", "", '3,"', "", '"']
    flags = {'1,"two': (True, True), 'lines"': (False, False), '3,"': (True, False), '"': (True, False)}
    lines = texts * 600

    def batches(*columns):
        begin = 0
        while begin < len(lines):
            part = lines[begin:begin + rng.randint(1, 9)]
            n, outside, inside = len(part), *zip(*(flags.get(x, (False, True)) for x in part))
            data = {"file": ["f"] * n, "block": [70] * n, "place": np.arange(begin, begin + n), "line": part, "outside": outside, "inside": inside,
                    "cr": [False] * n, "begins_inside": [False] * n, "crlf": [False] * n, "owner_block": [0] * n, "owner_record": [5] * n}
            begin += n
            given[0] = begin
            yield pa.RecordBatch.from_pydict({c: data[c] for c in columns})

    found, lag = [], 0
    for batch in _pieces(batches("file", "block", "place", "line", "outside", "inside", "begins_inside", "crlf", "owner_block", "owner_record")):
        found += batch.to_pylist()
        lag = max(lag, given[0] - sum(x["text"].count("\n") + 1 for x in found))
    assert [x["text"] for x in found] == ['1,"two\nlines"', "2,plain", "", '3,"\n\n"'] * 600
    assert [x["record"] for x in found] == list(range(1, 2401)) and [x["open"] for x in found] == [False] * 2399 + [True]
    assert lag < 20  # of 4,200 lines of the block
    rows = [row for batch in _blocks(batches("file", "block", "place", "outside", "inside", "cr")) for row in batch.to_pylist()]
    assert rows == [{"file": "f", "block": 70, "outside": False, "inside": False, "begun_outside": 2400, "begun_inside": 2399, "crlf": False}]
    with pytest.raises(ValueError, match="order"):
        list(_blocks(reversed(list(batches("file", "block", "place", "outside", "inside", "cr")))))


def test_csv_types_are_inferred_in_blocks(spark, tmp_path):
    head = 'a,"b ""x""",c,d,e,f,g\n'
    path = write(tmp_path / "t.csv", head + '1,5000000000,1.5,2024-01-02,2024-01-02 03:04:05,true,"two\nlines"\n-2,,3,2024-01-03,2024-01-03T00:00:00,FALSE,\n')
    found, rejected = files.split_csv(spark, path, multi_line=True)
    assert found.dtypes == [("a", "int"), ('b "x"', "bigint"), ("c", "double"), ("d", "date"), ("e", "timestamp"), ("f", "boolean"), ("g", "string")]
    assert found.count() == 2 and rejected.count() == 0
    empty, _ = files.split_csv(spark, write(tmp_path / "h.csv", "a,b\n"), multi_line=True)
    assert empty.columns == ["a", "b"] and empty.count() == 0


def test_inference_puts_records_together_once(spark, tmp_path):
    for name in ("a", "b"):
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            f.write(csv_text(f"inferred {name}"))
    typed, typed_bad = files.split_csv(spark, str(tmp_path), "id string, text string, n string", multi_line=True)
    found, rejected = files.split_csv(spark, str(tmp_path), multi_line=True)
    assert found.columns == ["id", "text", "n"] and found.count() > 100
    assert Counter(map(tuple, found.select(*[F.col(c).cast("string") for c in found.columns]).collect())) == Counter(map(tuple, typed.collect()))
    assert Counter(map(tuple, rejected.collect())) == Counter(map(tuple, typed_bad.collect()))
    read = {file.rsplit(".", 1)[1] for df in (found, rejected) for file in df.inputFiles()}
    assert read == {"parquet"}  # not the files again


def test_dated_copies_are_passed_over(spark, tmp_path):
    for name in ("users.csv", "users-2024.csv"):
        write(tmp_path / name, "id\n1\n")
    loaded = files.load_many(spark, {"users.csv": "users", "users-2024.csv": "old"}, str(tmp_path))
    assert list(loaded) == ["users"] and loaded["users"].count() == 1


def test_pulls_are_all_kept(spark, rows):
    pulls = [spark.createDataFrame([("open", 1)], "status string, id int"), spark.createDataFrame([(2, "paid")], "id int, status string")]
    assert rows(files.load_union(pulls)) == [("open", 1), ("paid", 2)]


def test_flatten_and_explode(spark):
    docs = [{"id": 1, "items": {"data": [{"q": 2, "tags": ["a", "b"]}, {"q": 3, "tags": []}]}, "meta": {"x": None}},
            {"id": 2, "items": {"data": []}, "meta": {"x": "y"}}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "json_data string")
    flat = files.flatten_json(df, "json_data")
    assert set(flat.columns) == {"id", "items_data_0_q", "items_data_0_tags_0", "items_data_0_tags_1", "items_data_1_q",
                                 "items_data_1_tags_0", "items_data_1_tags_1", "meta_x"}
    first, second = flat.orderBy("id").collect()
    assert (first["items_data_0_tags_1"], first["items_data_1_q"], first["meta_x"]) == ("b", 3, None)
    assert second["items_data_0_q"] is None and second["meta_x"] == "y"
    assert "items_data_1_q" not in files.flatten_json(df, "json_data", max_items=1).columns
    children = files.explode_child(df, "items.data").collect()
    assert [json.loads(r[0])["q"] for r in children] == [2, 3]


def test_flatten_odd_names_and_mixed_types(spark):
    docs = [{"VOIDED": 1, "a b": {"OBJECT": [[1, 2], [3]]}, "mixed": 1, "none": None, "e": []}, {"mixed": {"x": 1}, "VARIANT": "v", "e": {}}]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, json_data string")
    first, second = files.flatten_json(df, "json_data").orderBy("i").collect()
    assert (first["VOIDED"], first["a b_OBJECT_0_1"], first["a b_OBJECT_1_0"], first["mixed"]) == (1, 2, 3, "1")
    assert second["VARIANT"] == "v" and json.loads(second["mixed"]) == {"x": 1} and first["none"] is None


def test_flatten_with_a_known_schema(spark):
    df = spark.createDataFrame([('{"a": 1, "b": [5, 6, 7]}',)], "json_data string")
    kind = files.merged_schema(df, "json_data")
    assert [tuple(r) for r in files.flatten_json(df, "json_data", max_items=2, schema=kind).collect()] == [(1, 5, 6, "[7]")]


def test_raw_table_takes_one_copy_per_day(spark, tmp_path, rows):
    docs = spark.createDataFrame([('{"id": "a", "object": "sub"}',)], "json_data string")
    more = spark.createDataFrame([('{"id": "b", "object": "sub"}',), ('{"id": "c"}',)], "json_data string")
    place = str(tmp_path / "bronze")
    assert life.last_run_day(spark, place) == life.FIRST_DAY
    assert life.append_bronze(docs, place, MONDAY) is True
    assert life.append_bronze(more, place, MONDAY) is False
    assert life.append_bronze(more, place, TUESDAY) is True
    table = spark.read.parquet(place)
    assert rows(table.select("id", "object", "run_date")) == [("a", "sub", "20240101120000"), ("b", "sub", "20240102050000"),
                                                              ("c", None, "20240102050000")]
    newest = life.latest_snapshot(table)
    assert rows(newest.select("id")) == [("b",), ("c",)]
    assert "PartitionFilters: [isnotnull(run_day" in newest._jdf.queryExecution().toString()


def test_snapshot_and_history(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a", 2)], "id int, name string, extra int")
    snapshot, history = str(tmp_path / "snap"), str(tmp_path / "hist")
    for as_of in (MONDAY, TUESDAY):
        life.write_snapshot(df, snapshot, ["id", "name"], as_of)
        life.append_history(df, history, ["id"], as_of)
        life.append_history(df, history, ["id"], as_of)
    assert rows(life.read_snapshot(spark, snapshot)) == [(1, "a", "20240102050000")]
    assert spark.read.parquet(history).count() == 2


def test_a_run_that_fails_leaves_the_snapshot(spark, tmp_path, rows):
    table = str(tmp_path / "snap")
    with pytest.raises(FileNotFoundError):
        life.read_snapshot(spark, table)
    life.write_snapshot(spark.createDataFrame([(1,)], "id int"), table, ["id"], MONDAY)
    reading = life.read_snapshot(spark, table)
    broken = spark.range(1000).repartition(4).withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        life.write_snapshot(broken, table, ["id"], TUESDAY)
    assert rows(life.read_snapshot(spark, table)) == rows(reading) == [(1, "20240101120000")]
    life.write_snapshot(spark.createDataFrame([(2,)], "id int"), table, ["id"], TUESDAY)
    assert rows(life.read_snapshot(spark, table)) == [(2, "20240102050000")]
    assert rows(reading) == [(1, "20240101120000")]  # who began to read before still can
    life.write_snapshot(life.read_snapshot(spark, table).select("id"), table, ["id"], TUESDAY)  # out of itself
    assert rows(life.read_snapshot(spark, table)) == [(2, "20240102050000")]
    assert len(list((tmp_path / "snap").glob("version-*"))) == 2


def test_first_of_month_copies(spark, rows):
    df = spark.createDataFrame([(d,) for d in ("20231201010101", "20240101000000", "20240102000000", "20240201000000")], "run_date string")
    assert rows(life.month_start_snapshots(df, "2024-01-31", 1)) == [("20231201010101",), ("20240101000000",)]
    days = spines.month_starts(spark, "2024-02-10", 1)
    assert rows(life.snapshots_on(df, days)) == [("20240101000000",), ("20240201000000",)]


def test_freshness(spark):
    df = spark.createDataFrame([("20240101120000.5",)], "run_date string")
    assert life.freshness(df, "2024-01-02 11:00:00").first()["status"] == "pass"
    assert life.freshness(df, "2024-01-02 13:00:00").first()["status"] == "error"
    assert life.freshness(df.limit(0), "2024-01-02 13:00:00").first()["status"] == "error"


def test_tables_by_name(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shards_test LOCATION '{tmp_path}/db'")
    for day, data in (("20180101", [(1, "play"), (2, "pause")]), ("20180102", [(3, "play"), (4, "pause")])):
        life.materialize(spark.createDataFrame(data, "user_id int, event string"), f"shards_test.data_events_{day}", "table")
    found = catalog.tables_like(spark, "shards_%", "DATA_events_%")
    assert found == catalog.tables_with_prefix(spark, "shards_test", "data_events_") and len(found) == 2
    assert catalog.tables_like(spark, "shards_test", "%", exclude="%0102") == ["shards_test.data_events_20180101"]
    assert catalog.union_tables(spark, found).count() == 4
    with pytest.raises(ValueError):
        life.materialize(spark.range(1), "x", "cube")


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS buckets_test LOCATION '{tmp_path}/buckets'")
    left = life.materialize(spark.range(100).selectExpr("id", "id % 7 as v"), "buckets_test.l", "table", bucket_by=(4, "id"))
    right = life.materialize(spark.range(50).selectExpr("id", "id % 5 as w"), "buckets_test.r", "table", ["w"], (4, "id"))
    joined = left.hint("merge").join(right, "id")
    assert joined.count() == 50
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_status_feed_holds_only_changes(spark, rows):
    wanted = spark.createDataFrame([(1, "active", ""), (2, "canceled", "2024-01-01"), (3, None, "")], "id int, status string, until string")
    current = spark.createDataFrame([(1, "active", ""), (2, "active", ""), (3, None, "")], "id int, status string, until string")
    assert rows(life.changed_rows(wanted, current, wanted.columns)) == [(2, "canceled", "2024-01-01")]


def test_stream_takes_each_file_once(spark, tmp_path):
    source, place, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    write(source / "1.json", '{"id": "a"}\nbroken\n')
    land_new_files(spark, str(source), place, MONDAY, "t", progress=progress).awaitTermination()
    land_new_files(spark, str(source), place, TUESDAY, "t", progress=progress).awaitTermination()
    assert spark.read.parquet(place).count() == 1
    write(source / "2.json", '{"id": "b"}\n')
    land_new_files(spark, str(source), place, TUESDAY, "t", progress=progress).awaitTermination()
    assert {(r["id"], str(r["run_day"])) for r in spark.read.parquet(place).collect()} == {("a", "20240101"), ("b", "20240102")}
    assert spark.read.parquet(place).filter(F.col("object").isNotNull()).count() == 0


DAYS = [
    [{"id": 1, "a": None, "items": []}, {"id": 2, "a": None, "items": [{"q": 1}], "odd.name": {"x y": 1}}],
    [{"id": 3, "a": 5, "items": [{"q": 2.5, "tags": ["u"]}, {"q": 1}], "more": True}],
    [{"id": "4", "a": 1.25, "items": None, "more": {"deep": [1, 2, 3]}}, {"id": 5, "a": 12345678901}],
    [{"id": 6, "items": [{"q": 1, "tags": []}], "only": "text"}],
]


def test_schema_kept_day_by_day_is_that_of_a_full_read(spark, tmp_path, rows):
    location, seen = str(tmp_path / "schema.json"), []
    for day in DAYS:
        new = spark.createDataFrame([(json.dumps(d),) for d in day], "json_data string")
        seen += day
        kept = kept_schema.keep_schema(new, "json_data", location)
        assert kept == kept_schema.read_schema(spark, location) == kept_schema.keep_schema(new, "json_data", location)
        whole = spark.createDataFrame([(json.dumps(d),) for d in seen], "json_data string")
        assert kept.schema == files.merged_schema(whole, "json_data")
        full = files.flatten_json(whole, "json_data")
        found = files.flatten_json(whole, "json_data", schema=kept.schema, widths=kept.widths)
        assert found.columns == full.columns and rows(found) == rows(full)
        assert files.flatten_json(new, "json_data", schema=kept.schema, widths=kept.widths).columns == full.columns
    assert kept_schema.read_schema(spark, str(tmp_path / "none")).schema.simpleString() == "string"
