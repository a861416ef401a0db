import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import EVENTS, event, rows, write_documents
from shopmill import schemas
from shopmill.operators.setops import unify
from shopmill.sources import files, sinks


def test_csv_with_crlf_and_bad_values(spark, tmp_path):
    (tmp_path / "orders.csv").write_bytes(
        b"OrderID,CustomerID,OrderDate,Status\r\n1,2,2024-01-31, Pending \r\nx,3,2024-02-30,\r\n"
    )
    df = files.read_entity(spark, str(tmp_path), "orders")
    assert rows(df) == [(1, 2, date(2024, 1, 31), " Pending "), (None, 3, None, None)]
    with pytest.raises(Exception):
        files.read_entity(spark, str(tmp_path), "orders", strict=True).collect()


def test_csv_multiline(spark, tmp_path):
    (tmp_path / "c.csv").write_text('CategoryID,CategoryName\n1,"two\nlines"\n')
    df = files.read_csv(spark, str(tmp_path / "c.csv"), schemas.schema("categories"), multiline=True)
    assert rows(df) == [(1, "two\nlines")]


def test_schemas_parse(spark):
    for name in schemas.RAW:
        assert set(schemas.KEYS[name]) <= set(schemas.schema(name).fieldNames())
        assert all(f.dataType.simpleString() == "string" for f in schemas.text_schema(name).fields)
    assert schemas.schema("event").fieldNames()[1] == "order"


def test_list_inputs(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.txt").write_text("x" * 5)
    got = files.list_inputs(files.read_documents(spark, str(tmp_path))).collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["bytes"]) for r in got) == [("a.txt", 5), ("b.txt", 5)]


def test_read_since_bounds(spark):
    ids = spark.range(1, 50).withColumnRenamed("id", "orderid")
    assert rows(files.read_since(ids, 10, 3)) == [(10,), (11,), (12,)]
    assert files.next_id(files.read_since(ids, 10, 3), 10).first()[0] == 13
    assert files.next_id(files.read_since(ids, 99, 3), 99).first()[0] == 99
    for start, limit in ((0, 5), (1, 0), (1, 1001)):
        with pytest.raises(ValueError):
            files.read_since(ids, start, limit)
    assert rows(files.get_event(ids, 7)) == [(7,)]


def test_partitioned_write_keeps_null_partition(spark, tmp_path):
    df = spark.createDataFrame([(1, 2024, 1), (2, None, None)], "k int, year int, month int")
    path = str(tmp_path / "t")
    sinks.write_table(df, path, ["year", "month"])
    back = spark.read.parquet(path)
    assert back.columns == ["k", "year", "month"] and rows(back) == rows(df)
    sinks.append_table(df, path, ["year", "month"])
    assert spark.read.parquet(path).count() == 4
    plan = spark.read.parquet(path).filter("year = 2024")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(year" in plan.toString()


def test_a_shelf_is_one_of_few_and_never_below_its_ranges(spark):
    numbers = [-1000, -1, 0, 1, 127, 128, 129, 255, 256, 259, 260, 140_624, 10**12, 2**62, None]
    got = dict(spark.createDataFrame([(n,) for n in numbers], "n long").select("n", sinks.shelf(F.col("n"))).collect())
    assert {n: got[n] for n in numbers[2:11]} == {0: 0, 1: 1, 127: 127, 128: 129, 129: 129, 255: 255, 256: 259, 259: 259, 260: 263}
    assert got[None] is None and all(got[n] >= n for n in numbers if n is not None)
    many = spark.range(140_625).select(sinks.shelf(F.col("id")).alias("s"), "id").groupBy("s").agg(F.min("id"), F.max("id")).orderBy("s")
    found = [tuple(r) for r in many.collect()]
    assert len(found) < 900 and all(a[2] + 1 == b[1] for a, b in zip(found, found[1:]))


def test_a_pull_of_landed_events_stops_at_the_last_folder_it_needs(spark, tmp_path):
    """Ids 3, 6, ... 3000 in ranges of one id: they share folders, and a pull reads the few that hold its ids."""
    path = tmp_path / "out"
    events = files.parse_events(spark.createDataFrame([(json.dumps(event(i, [])),) for i in range(3, 3001, 3)], "value string"))
    sinks.write_events(events.unionAll(events.filter("order.OrderID = 1500")), str(path), ids_per_folder=1)
    assert len(list(path.glob("id_bucket=*"))) < 400
    for start, limit in ((1, 4), (1498, 3), (2999, 5), (1, 1000), (3001, 2)):
        pulled = files.read_events_since(spark, str(path), start, limit, ids_per_folder=1)
        wanted = [i for i in range(3, 3001, 3) if i >= start][:limit]
        assert sorted(r[0] for r in pulled.select("order.OrderID").collect()) == sorted(wanted + [1500] * (1500 in wanted))
    plan = files.read_events_since(spark, str(path), 1498, 3, ids_per_folder=1)._jdf.queryExecution().executedPlan().toString()
    assert "(id_bucket" in plan and "<= 1535)" in plan
    with pytest.raises(ValueError):
        files.read_events_since(spark, str(path), 0, 3)


def test_views(spark, tmp_path):
    df = spark.createDataFrame([(1, Decimal("2.00"))], "k int, v decimal(12,2)")
    sinks.write_table(df, str(tmp_path / "v"))
    sinks.register_views(spark, {"from_frame": df, "from_path": str(tmp_path / "v")})
    joined = spark.sql("SELECT * FROM from_frame JOIN from_path USING (k)")
    assert rows(joined) == [(1, Decimal("2.00"), Decimal("2.00"))]


def test_csv_rejects_are_kept_with_their_file(spark, tmp_path):
    for i, name in enumerate("ab"):
        lines = ["PaymentID,Amount", f"{i},1.50", "x,2.00", f"{i + 5},", "7", '9,"many"', f"{i + 8},3.00,4"]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    checked = files.read_csv_checked(spark, str(tmp_path), "paymentid long, amount decimal(12,2)")
    good, bad = files.split_rejects(checked)
    assert rows(good) == [(0, Decimal("1.50")), (1, Decimal("1.50")), (5, None), (6, None)]
    found = [(r["file"].rsplit("/", 1)[1], r["record"]) for r in bad.collect()]
    assert sorted(found) == sorted((f"{n}.csv", t) for i, n in enumerate("ab") for t in ("x,2.00", "7", '9,"many"', f"{i + 8},3.00,4"))
    assert good.count() + bad.count() == 12


def test_event_rejects_are_kept_with_their_file(spark, tmp_path):
    documents = [*EVENTS, "{broken", " \n", '{"order": {"OrderID": "x"}}', "[1, 2]", "null", json.dumps(EVENTS[0])[:-1]]
    folder = write_documents(tmp_path / "in", documents)
    good, bad = files.split_rejects(files.read_events_checked(spark, folder))
    assert [r[0] for r in rows(good.select("order.OrderID"))] == [2000001, 2000002, 2000003, 2000004]
    assert good.columns == schemas.schema("event").fieldNames()
    assert len({r["file"] for r in bad.collect()}) == 6
    assert rows(good) == rows(files.read_events(spark, write_documents(tmp_path / "good", EVENTS)))


def test_texts_written_compressed_are_read_line_by_line(spark, tmp_path):
    path = tmp_path / "out"
    texts = [*map(json.dumps, EVENTS), "{broken", "", "[1, 2]"]
    sinks.write_texts(spark.createDataFrame([(t,) for t in texts], "value string"), str(path))
    written = [f.name for f in path.glob("part-*")]
    assert written and all(name.endswith(".txt.gz") for name in written)
    assert sorted(r["value"] for r in spark.read.text(str(path)).collect()) == sorted(texts)
    good, bad = files.split_rejects(files.read_events_checked(spark, str(path), whole_files=False))
    assert good.count() == len(EVENTS) and sorted(r["record"] for r in bad.collect()) == ["", "[1, 2]", "{broken"]


def test_a_document_is_read_whole(spark, tmp_path):
    folder = write_documents(tmp_path / "in", EVENTS)
    assert files.read_documents(spark, folder).count() == len(EVENTS)
    assert [r[0] for r in rows(files.parse_events(files.read_documents(spark, folder)).select("order.OrderID"))] == [
        2000001, 2000002, 2000003, 2000004
    ]


@pytest.fixture
def database(spark, tmp_path):
    name = f"shop_{tmp_path.name}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def test_catalog_tables_with_partitions_and_statistics(spark, tmp_path, database):
    orders = spark.range(2000).selectExpr("id", "id % 50 AS customer", "2020 + id % 3 AS year", "1 + id % 2 AS month")
    sinks.write_table(orders.selectExpr("id", "customer", "int(year)", "int(month)"), str(tmp_path / "o"), ["year", "month"])
    sinks.write_table(spark.range(50).selectExpr("id AS customer", "concat('n', id) AS name"), str(tmp_path / "c"))
    tables = {"orders": str(tmp_path / "o"), "customers": str(tmp_path / "c")}
    for _ in range(2):  # made anew, files stay
        sinks.register_tables(spark, tables, database, {"orders": ["year", "month"]})
    assert spark.sql(f"SHOW PARTITIONS `{database}`.orders").count() == 6
    found = spark.sql(f"SELECT year, count(*) AS n FROM `{database}`.orders JOIN `{database}`.customers USING (customer) GROUP BY year")
    assert rows(found) == [(2020, 667), (2021, 667), (2022, 666)]
    stats = spark.sql(f"DESCRIBE EXTENDED `{database}`.orders").filter("col_name = 'Statistics'").first()["data_type"]
    assert "2000 rows" in stats
    pruned = spark.table(f"{database}.orders").filter("year = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in pruned


def test_statistics_turn_a_join_to_a_broadcast(spark, tmp_path, database):
    """A rare value of the dimension: from counted values the optimizer knows that few rows are left."""
    sinks.write_table(spark.range(40_000).selectExpr("id", "id % 5000 AS k"), str(tmp_path / "f"))
    sinks.write_table(spark.range(5000).selectExpr("id AS k", "id AS kind", "uuid() AS note"), str(tmp_path / "d"))
    tables = {"facts": str(tmp_path / "f"), "dims": str(tmp_path / "d")}
    query = f"SELECT count(*) FROM `{database}`.facts JOIN `{database}`.dims USING (k) WHERE kind = 17"
    conf = {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "20k", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plans = []
        for analyze in (False, True):
            sinks.register_tables(spark, tables, database, analyze=analyze)
            plans.append(spark.sql(query)._jdf.queryExecution().executedPlan().toString())
            assert spark.sql(query).first()[0] == 8
        assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" in plans[1]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_write_counts_rows_and_nulls_by_the_way(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a long, `b c` string")
    counted = sinks.write_observed(df.mapInPandas(seen, df.schema), str(tmp_path / "t"))
    assert counted == {"rows": 3, "a": 1, "b c": 2} and reads.value == 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert sinks.write_observed(df.filter("false"), str(tmp_path / "e")) == {"rows": 0, "a": 0, "b c": 0}


def test_a_bucketed_history_is_not_shuffled(spark, tmp_path, database):
    spark.sql(f"CREATE DATABASE `{database}`")
    history = spark.range(1000).selectExpr("id AS orderid", "'old' AS status")
    stored = sinks.write_bucketed(history, f"{database}.orders", "orderid", 8, str(tmp_path / "h"))
    incoming = spark.createDataFrame([(5, "new"), (2000, "new"), (5, "new")], "orderid long, status string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = unify(stored, incoming, ["orderid"], ["orderid", "status"], historical_is_unique=True)
        plan = merged._jdf.queryExecution().sparkPlan().toString()
        executed = merged._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in executed
        scan = executed.index("Bucketed: true")
        above = executed[:scan].rsplit("SortMergeJoin", 1)[1]
        assert "Exchange" not in above, plan
        assert merged.count() == 1001 and merged.filter("status = 'new'").count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
