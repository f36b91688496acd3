"""Readers, writers, refresh and stream."""

import pathlib
import sqlite3
import time

import pytest
from pyspark.sql import functions as F

from verification.tables import Tables
from wayfare.operators import changes
from wayfare.plans import refresh, update
from wayfare.session import FILE_CLEANUP
from wayfare.sinks import tables as sinks
from wayfare.sources import catalogues, database, files
from wayfare.sources import tables as sources
from wayfare.sources.spec import TableSpec
from wayfare.streaming import ingest

SPEC = TableSpec("t", ints=("n",), floats=("x",), texts=("s",), required=True)


def test_csv_tokens_and_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('n,x,s,extra\n1,2.5,"a, ""b""",q\nNULL,,NA,\n3.0,abc,nan,z\n')
    got = files.read_csv(spark, str(tmp_path / "t.csv"), SPEC).collect()
    assert [tuple(r) for r in got] == [(1, 2.5, 'a, "b"', "q"), (None, None, None, None), (3, None, None, "z")]
    text = files.read_text_columns(spark, str(tmp_path / "t.csv")).collect()
    assert tuple(text[1]) == ("NULL", "", "NA", "")


def test_fields_with_line_feeds_come_back(spark, tmp_path):
    rows = [(1, 1.5, 'two\nlines, a "quote"\n'), (2, 2.5, "\n"), (3, None, '""'), (4, 0.0, "plain")]
    sinks.write_csv(spark.createDataFrame(rows, "n long, x double, s string").repartition(2), str(tmp_path / "t"))
    spec = TableSpec("t", ints=("n",), floats=("x",), texts=("s",))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "t"), spec).collect())) == rows
    assert {r.s for r in files.read_text_columns(spark, str(tmp_path / "t")).collect()} == {r[2] for r in rows}
    assert files.read_typed_csv(spark, str(tmp_path / "t"), "n long, x double, s string").filter("s like '%lines%'").first().n == 1


def test_compressed_csv_comes_back(spark, tmp_path):
    rows = [(k, None if k % 7 == 0 else k / 4, f'Guest#{k:09d}, "of"\nCity Hotel') for k in range(4000)]
    df = spark.createDataFrame(rows, "n long, x double, s string").repartition(2)
    sinks.write_csv(df, str(tmp_path / "plain"))
    sinks.write_csv(df, str(tmp_path / "small"), "gzip")
    size = {name: sum(f.stat().st_size for f in (tmp_path / name).glob("part-*")) for name in ("plain", "small")}
    assert size["small"] < size["plain"] / 3
    spec = TableSpec("t", ints=("n",), floats=("x",), texts=("s",))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "small"), spec).collect())) == rows


def test_corrupt_records_are_shown(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n,x\n1,2.5\nmany,3\n")
    got = files.read_typed_csv(spark, str(tmp_path / "t.csv"), "n int, x double", corrupt="bad").cache()
    assert [tuple(r) for r in got.collect()] == [(1, 2.5, None), (None, 3.0, "many,3")]


def test_required_columns(spark):
    df = spark.createDataFrame([("1",)], "n string")
    with pytest.raises(ValueError, match="missing columns"):
        SPEC.coerce(df)
    assert TableSpec("t", ("n",), ("x",), ()).coerce(df).first().n == 1


def test_sqlite_file_in_ranges(spark, tmp_path):
    path = str(tmp_path / "guests.db")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE guests (guest_id TEXT, total_stays INTEGER, spend REAL)")
        con.executemany("INSERT INTO guests VALUES (?, ?, ?)", [(f"G{i}", i, i / 2) for i in range(25_000)])
        con.execute("INSERT INTO guests VALUES (7, 'many', NULL)")
    df = database.read_sqlite(spark, path, "guests")
    assert df.dtypes == [("guest_id", "string"), ("total_stays", "bigint"), ("spend", "double")]
    assert df.rdd.getNumPartitions() == 3
    assert tuple(df.agg(F.count("guest_id"), F.sum("total_stays"), F.sum("spend")).first()) == (25_001, 312487500, 156243750.0)
    assert df.filter("guest_id = '7'").first().total_stays is None
    assert database.count_sqlite(spark, path, "guests").first().n == 25_001


def test_sqlite_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "db")
    database.write_sqlite(spark.range(100).repartition(3), path, "t")
    database.write_sqlite(spark.range(10).repartition(2), path, "t")
    assert database.read_sqlite(spark, path, "t").count() == 10


def test_overwrite_counts_and_replaces_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.overwrite_path(spark.range(7), path) == 7
    assert sinks.overwrite_path(spark.range(3).withColumn("x", F.lit("a")), path) == 3
    assert spark.read.parquet(path).columns == ["id", "x"]


def test_snapshots_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "s")
    day = spark.range(5).withColumn("snapshot_date", F.lit("2024-01-01").cast("date"))
    sinks.replace_snapshot(day, path)
    sinks.replace_snapshot(day.withColumn("snapshot_date", F.lit("2024-01-02").cast("date")), path)
    sinks.replace_snapshot(day, path)
    assert spark.read.parquet(path).count() == 10


def test_namespace_and_tables(spark, tmp_path):
    sources.use_namespace(spark, "wayfare_test", str(tmp_path / "ns"))
    try:
        assert sinks.overwrite_table(spark.range(4), "numbers") == 4
        assert sources.read_table(spark, "wayfare_test.numbers").count() == 4
    finally:
        spark.sql("DROP DATABASE wayfare_test CASCADE")
        spark.catalog.setCurrentDatabase("default")


def test_audit_and_listing(spark, tmp_path):
    sinks.write_csv(spark.range(3), str(tmp_path / "f"))
    df = files.audit(spark.read.csv(str(tmp_path / "f"), header=True))
    assert all(r._source_file.endswith(".csv") and r._ingested_at for r in df.collect())
    listed = files.list_files(spark, str(tmp_path / "f")).filter(F.col("file").endswith(".csv")).collect()
    assert listed and all(r.size_mb > 0 for r in listed)


def files_of(path):
    return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_stream_updates_inserts_and_then_rests(spark, tmp_path):
    root, landing, log = (str(tmp_path / n) for n in ("table", "landing", "log"))
    schema = "k string, o int, v int"
    first = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], schema)
    update.load(root, first.withColumn(ingest.BATCH, F.lit("load")))

    def run():
        return ingest.ingest(spark.readStream.schema(schema).parquet(landing), root, log, ["k"], ["o"])

    spark.createDataFrame([("a", 2, 10), ("c", 1, 3)], schema).write.parquet(landing)
    assert sorted(map(tuple, run().collect())) == [("a", 2, 10), ("b", 1, 2), ("c", 1, 3)]
    before = files_of(tmp_path / "table")
    assert sorted(map(tuple, run().collect())) == [("a", 2, 10), ("b", 1, 2), ("c", 1, 3)]
    assert files_of(tmp_path / "table") == before
    spark.createDataFrame([("b", 5, 20)], schema).write.mode("append").parquet(landing)
    assert sorted(map(tuple, run().collect())) == [("a", 2, 10), ("b", 5, 20), ("c", 1, 3)]


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    schema = "y int, k string, o int, v int"
    batch = spark.createDataFrame([(1, "a", 2, 5), (1, None, 1, 1), (None, "b", 1, 1), (None, "b", 1, 1)], schema)
    for parts in ([], ["y"]):
        root = str(tmp_path / f"table{len(parts)}")
        apply = ingest.merge_batch(root, ["y", "k"], ["o"], parts)
        for _ in range(2):
            apply(batch, 0)
            assert sorted(map(tuple, ingest.current(batch, root).collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)
        apply(batch, 1)  # the same rows as news: those without a key come again
        assert ingest.current(batch, root).count() == 7


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    root, schema = str(tmp_path / "table"), "k string, o int, v int"
    for name in ("first", "second"):
        landing = str(tmp_path / name)
        spark.createDataFrame([(name, 1, 1)], schema).write.parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        got = ingest.ingest(stream, root, str(tmp_path / f"{name}-log"), ["k"], ["o"])
    assert sorted(r.k for r in got.collect()) == ["first", "second"]


def test_an_update_rewrites_only_its_parts(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "y int, k string, o int, v int"
    update.load(path, spark.createDataFrame([(1, "a", 1, 1), (2, "a", 1, 2), (2, "z", 1, 7), (2, "z", 1, 8), (None, "c", 1, 3)], schema), ["y"])
    before = files_of(tmp_path / "table")
    new = spark.createDataFrame([(2, "a", 1, 0), (2, "a", 2, 20), (2, "z", 3, 9), (3, "d", 1, 4), (2, None, 1, 5)], schema)
    assert update.update(path, new, ["y", "k"], ["o"], ["y"]) == {"kept": 0, "updated": 3, "inserted": 2}
    after = files_of(tmp_path / "table")
    assert {f.parent.name for f in before.keys() & after.keys()} == {"y=1", "y=__HIVE_DEFAULT_PARTITION__"}
    assert {f.parent.name for f in after.keys() - before.keys()} == {"y=2", "y=3"}
    want = [(1, "a", 1, 1), (2, "a", 2, 20), (2, "z", 3, 9), (2, "z", 3, 9), (3, "d", 1, 4), (2, None, 1, 5), (None, "c", 1, 3)]
    assert sorted(map(tuple, update.stored_table(new, path).collect()), key=repr) == sorted(want, key=repr)


def test_an_update_reads_only_its_parts(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "y int, k string, o int"
    update.load(path, spark.createDataFrame([(y, "a", 1) for y in range(20)], schema), ["y"])
    new = spark.createDataFrame([(7, "a", 2)], schema)
    new.write.parquet(str(tmp_path / "new"))
    new = spark.read.parquet(str(tmp_path / "new"))
    read = update.touched(update.stored_table(new, path), new, ["y"])
    assert read.count() == 1 and len(read.inputFiles()) == 20
    assert "PartitionFilters: [isnotnull(y" in read._jdf.queryExecution().executedPlan().toString()


def test_a_failed_update_leaves_the_table(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "y int, k string, o int"
    update.load(path, spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema), ["y"])
    bad = spark.createDataFrame([(1, "a", 2)], schema).withColumn("o", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        update.update(path, bad, ["y", "k"], ["o"], ["y"])
    assert sorted(map(tuple, update.stored_table(bad, path).collect())) == [(1, "a", 1), (2, "b", 1)]
    with pytest.raises(ValueError, match="key"):
        update.update(path, bad, ["k"], ["o"], ["y"])


def test_bookings_and_guests_are_updated_in_place(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp")
    path = str(tmp_path / "bookings")
    first = update.update_bookings(path, t.bookings.filter("src_key % 2 = 0"), moment=moment)
    again = update.update_bookings(path, t.bookings.filter("src_key % 2 = 0"), moment=moment)
    known = " AND ".join(f"{k} IS NOT NULL" for k in changes.BOOKING_KEY)
    assert first["updated"] == 0 and first["inserted"] > 0
    assert again["updated"] == t.bookings.filter(f"src_key % 2 = 0 AND {known}").select(*changes.BOOKING_KEY).distinct().count()
    guests = str(tmp_path / "guests")
    n = update.update_guests(guests, t.guests, moment=moment)["inserted"]
    done = update.update_guests(guests, t.guests.withColumn("phone", F.lit("1")), moment=moment)
    assert n == t.guests.count() and done == {"kept": n - done["updated"], "updated": done["updated"], "inserted": n - done["updated"]}


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    bad = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    store, path = sinks.Store(spark, str(tmp_path / "store")), str(tmp_path / "folder")
    store.write(spark.range(3), "t")
    sinks.overwrite_path(spark.range(3), path)
    sinks.overwrite_table(spark.range(3), "kept_table")
    try:
        for again in (lambda: store.write(bad, "t"), lambda: sinks.overwrite_path(bad, path), lambda: sinks.overwrite_table(bad, "kept_table")):
            with pytest.raises(Exception, match="no"):
                again()
        assert store.read("t").count() == spark.read.parquet(path).count() == spark.table("kept_table").count() == 3
    finally:
        spark.sql("DROP TABLE kept_table")


def test_refreshes(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp")
    store = sinks.Store(spark, str(tmp_path / "hotel"))
    hotel_sources = {"bookings": t.bookings, "guests": t.guests, "packages": catalogues.packages(spark)}
    run = refresh.refresh_hotel(spark, hotel_sources, store, moment)
    assert run["bronze_bookings"] == run["silver_bookings"] == t.bookings.count()
    assert [d["in_bronze"] for d in run.detected] == [None, None, None]
    again = refresh.refresh_hotel(spark, hotel_sources, store, moment, compare_content=True)
    assert again.rows == run.rows and all(d["new_rows"] == 0 and d["only_in_source"] == 0 for d in again.detected)
    gold, silver = store.read("gold_premium_conversion"), store.read("silver_bookings").filter("is_canceled = 0")
    assert gold.agg(F.sum("total_bookings")).first()[0] == silver.count()
    assert {n: df.count() > 0 for n, df in refresh.hotel_boards(store).items()} == dict.fromkeys(refresh.hotel_boards(store), True)


def test_report_refresh_twice(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    store = sinks.Store(spark, str(tmp_path / "reports"))
    day, now = F.lit("2024-01-31").cast("date"), F.lit("2024-01-31 12:00:00").cast("timestamp")
    first = refresh.refresh_reports(spark, t.bookings, t.feedback, store, day, now)
    second = refresh.refresh_reports(spark, t.bookings, t.feedback, store, day, now)
    assert first.rows == second.rows
    assert spark.read.parquet(f"{store.root}/premium_revenue").count() == first["premium_revenue"]
    keys = store.read("curated_bookings")
    assert keys.select("booking_id").distinct().count() == keys.count()


def test_guests_made_of_the_stored_bookings(spark, sf_dir, tmp_path):
    from wayfare.operators import profiles

    t = Tables(spark, sf_dir)
    now, seen = F.lit("2024-01-31 12:00:00").cast("timestamp"), []

    def guests(stored):
        seen.append((sorted(stored), stored["bookings"].columns, len(stored["bookings"].inputFiles())))
        return profiles.guests(stored["bookings"])

    tables = []
    for name, given in (("apart", t.guests), ("stored", guests)):
        store = sinks.Store(spark, str(tmp_path / name))
        run = refresh.refresh_hotel(spark, {"bookings": t.bookings, "guests": given, "packages": t.packages}, store, now)
        tables.append((run.rows, sorted(map(str, store.read("silver_bookings").collect())), sorted(map(str, store.read("gold_upsell_opportunity").collect()))))
    assert tables[0] == tables[1]
    assert seen[0][:2] == (["bookings"], t.bookings.columns) and seen[0][2] > 0


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for folder in folders for p in pathlib.Path(folder).rglob("shuffle_*")}


def test_a_write_gives_its_shuffles_back(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 7 AS k", "id AS n", "cast(current_date() AS date) AS snapshot_date")
    one = str(tmp_path / "one")
    for write in (
        lambda df: sinks.overwrite_path(df, one),
        lambda df: sinks.replace_snapshot(df, str(tmp_path / "two")),
        lambda df: sinks.replace_parts(df, str(tmp_path / "three"), ("k",)),
        lambda df: update.update(str(tmp_path / "four"), df, ["k"], ["n"]),
        lambda df: update.load(str(tmp_path / "five"), df, ["k"]),
    ):
        before = shuffle_files(spark)
        write(rows.repartition(3, "n"))
        for _ in range(100):
            if shuffle_files(spark) <= before:
                break
            time.sleep(0.1)
        assert shuffle_files(spark) <= before
    assert spark.conf.get(FILE_CLEANUP, "false") != "true"
    kept = spark.read.parquet(one).groupBy("k").count()
    sinks.overwrite_path(kept, str(tmp_path / "six"))
    assert kept.count() == 7 and spark.read.parquet(str(tmp_path / "six")).count() == 7


def test_a_load_moves_rows_as_texts_and_keeps_them(spark, tmp_path):
    rows = [("a\x1f", -0.0, 1), ("\x00", None, 1), (None, 2.5, None), ("", float("nan"), 2), ("", float("nan"), 2)]
    df = spark.createDataFrame(rows, "s string, v double, y int")
    assert update.load(str(tmp_path / "t"), df, ["y"]) == 5
    assert sorted(map(str, update.stored_table(df, str(tmp_path / "t")).collect())) == sorted(map(str, df.collect()))


def test_bookings_that_are_read_twice_are_stored_once(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        stored = t.stored_bookings
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert Tables(spark, sf_dir).stored_bookings.inputFiles() != stored.inputFiles()
    assert stored.schema.simpleString() == t.bookings.schema.simpleString() and t.stored_bookings is stored
    assert "Join" not in stored._jdf.queryExecution().executedPlan().toString()
    assert stored.exceptAll(t.bookings).count() == 0 == t.bookings.exceptAll(stored).count()
