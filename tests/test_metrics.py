import math
import random

import pytest
from pyspark.sql import functions as F

from gridloom import jobs
from gridloom.functions.rates import approx_mb_per_second, guarded_ratio
from gridloom.operators import batches, numbers, rollup
from gridloom.operators.contents import listed_sheets
from gridloom.operators.latency import latency_summary
from gridloom.operators.ordinal import with_ordinal
from gridloom.plans import workloads
from gridloom.sources import sinks, tables


def seconds():
    return F.variant_get("payload", "$.total_seconds", "double")


def test_tables_are_created_and_evolved_once(spark, schema):
    for name, wanted in tables.SCHEMAS.items():
        assert spark.table(f"{schema}.{name}").schema.names == wanted.names
    tables.create_tables(spark, schema)
    spark.sql(f"CREATE TABLE {schema}.old (int_id bigint) USING parquet")
    spark.sql(f"INSERT INTO {schema}.old VALUES (1)")
    assert tables.add_missing_columns(spark, f"{schema}.old", tables.SCHEMAS[tables.SCRATCH]) == ["stuff"]
    assert tables.add_missing_columns(spark, f"{schema}.old", tables.SCHEMAS[tables.SCRATCH]) == []
    assert spark.table(f"{schema}.old").first().asDict() == {"int_id": 1, "stuff": None}


def test_register_folders(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/moved.db/t1")
    spark.range(2).write.parquet(f"{root}/moved.db/t2")
    (tmp_path / "moved.db" / "empty").mkdir()
    try:
        assert tables.register_folders(spark, "moved", root) == ["t1", "t2"]
        assert tables.register_folders(spark, "moved", root) == ["t1", "t2"]
        assert spark.table("moved.t1").count() == 3
        with pytest.raises(FileNotFoundError, match="no table folders under"):
            tables.register_folders(spark, "nothing", root)
    finally:
        spark.sql("DROP TABLE IF EXISTS moved.t1")
        spark.sql("DROP TABLE IF EXISTS moved.t2")
        spark.sql("DROP SCHEMA IF EXISTS moved")


def test_register_default_schema_is_the_root(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/at_root")
    try:
        assert tables.register_folders(spark, "default", str(tmp_path)) == ["at_root"]
    finally:
        spark.sql("DROP TABLE IF EXISTS default.at_root")


def test_append_by_name(spark, schema):
    table = f"{schema}.{tables.SCRATCH}"
    sinks.append_by_name(spark.sql("SELECT 'x' AS stuff, 1 AS int_id"), table)
    sinks.insert_row(spark, table, {"int_id": 2})
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError, match="has no column other"):
        sinks.append_by_name(spark.sql("SELECT 1 AS other"), table)
    assert batches.latest_row(spark.table(table)).first()["int_id"] == 2


def test_save_metric(spark, schema):
    sinks.save_metric(spark, schema, "It's", {"total_seconds": 1.5, "note": "a 'b' \"c\"", "n": 2, "none": None}, "b1")
    sinks.save_metric(spark, schema, "Inf", {"total_seconds": float("inf")}, "b1")
    sinks.save_metric(spark, schema, "Other", {"rows": 1}, "b1")
    metrics = spark.table(f"{schema}.{tables.METRICS}")
    found = {r[0]: r[1] for r in metrics.select("metric_name", seconds()).collect()}
    assert found == {"It's": 1.5, "Inf": math.inf, "Other": None}
    note = metrics.where(F.col("metric_name") == "It's").select(F.variant_get("payload", "$.note", "string")).first()[0]
    assert note == "a 'b' \"c\""
    assert metrics.select("id").distinct().count() == 3


def test_rollup(spark):
    rows = [
        ("a", '{"total_seconds": 1}', "2024-01-01 10:05:00"),
        ("a", '{"total_seconds": 3.0}', "2024-01-01 10:55:00"),
        ("a", '{}', "2024-01-01 11:00:00"),
        ("b", '{"total_seconds": 7}', "2024-01-02 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "metric_name string, p string, t string").select(
        "metric_name", F.parse_json("p").alias("payload"), F.to_timestamp("t").alias("last_updated")
    )
    assert rollup.total_records(df).first()["record_count"] == 4
    assert sorted(map(tuple, rollup.average_by_metric(df).collect())) == [("a", 2.0), ("b", 7.0)]
    detail = {(r[0], r[1].hour): tuple(r)[2:] for r in rollup.metrics_detail(df).collect()}
    assert detail == {("a", 10): (4.0, 2.0, 3.0, 1.0), ("a", 11): (None,) * 4, ("b", 0): (7.0,) * 4}
    assert rollup.metrics_line(df).columns == ["metric_name", "date_trunc_hour", "total_seconds"]
    days = rollup.rollup(df, ["date_trunc_day"], ["record_count", "total_seconds"]).collect()
    assert sorted((r[0].day, r[1], r[2]) for r in days) == [(1, 3, 4.0), (2, 1, 7.0)]
    bad = df.withColumn("payload", F.parse_json(F.lit('{"total_seconds": "x"}')))
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        rollup.average_by_metric(bad).collect()


def expected_latency(values):
    values = sorted(values)
    n = len(values)
    ms = [values[0], values[n // 2], values[min(n - 1, int(n * 0.95))], values[-1]]
    return (n, sum(values), sum(values) / n * 1000, *(v * 1000 for v in ms))


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_latency_summary(spark, partitions):
    rng = random.Random(5)
    groups = {f"k{n}": [rng.choice([0.5, rng.random()]) for _ in range(n)] for n in (1, 2, 19, 20, 21, 1000)}
    groups["hot"] = [0.25] * 3000 + [rng.random() for _ in range(2000)]
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, s double")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = {r[0]: tuple(r)[1:] for r in latency_summary(df, ["k"], "s").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert set(found) == set(groups)
    for key, values in groups.items():
        assert found[key] == pytest.approx(expected_latency(values))


def test_latency_ranks_are_found_without_a_job_or_a_sort_of_all(spark, tmp_path):
    from gridloom.sources.staging import shared_folder

    import os

    base = f"{shared_folder(spark)}/gridloom"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    rng = random.Random(9)
    values = [rng.choice([1, 1e-7, 1e5]) * rng.random() ** 9 for _ in range(5000)] + [0.0] * 50 + [3.5] * 40
    rows = [("a", v) for v in values] + [(None, 1.0), (None, 2.0), ("b", float("nan")), ("b", -1.5), ("b", -0.5)]
    found = {r[0]: tuple(r)[1:] for r in latency_summary(spark.createDataFrame(rows, "k string, s double"), ["k"], "s").collect()}
    assert found["a"] == pytest.approx(expected_latency(values), rel=1e-12)
    assert found[None] == pytest.approx(expected_latency([1.0, 2.0])) and found["b"] == pytest.approx(expected_latency([-1.5, -0.5]))
    assert (set(os.listdir(base)) if os.path.isdir(base) else set()) == before


def test_rows_are_counted_by_the_sink(spark):
    assert workloads.rows_sent(spark.range(1000).where("id % 3 = 0"))[0] == 334
    assert workloads.payload_bandwidth(spark, 70)["rows_collected"] == 70


def test_a_row_is_inserted_by_name(spark, schema):
    sinks.insert_row(spark, f"{schema}.{tables.SCRATCH}", {"stuff": "it's; -- \"x\" :v0"})
    assert [tuple(r) for r in spark.table(f"{schema}.{tables.SCRATCH}").collect()] == [(None, "it's; -- \"x\" :v0")]


def test_latency_summary_without_key(spark):
    df = spark.createDataFrame([(0.3,), (0.1,), (0.2,), (None,)], "s double")
    assert tuple(latency_summary(df, [], "s").first()) == pytest.approx(expected_latency([0.3, 0.1, 0.2]))


@pytest.mark.parametrize("chunk_rows", [1, 3, 1000])
def test_ordinal(spark, chunk_rows):
    rng = random.Random(1)
    rows = [(k, p) for k in "ab" for p in rng.sample(range(100), 30)]
    df = with_ordinal(spark.createDataFrame(rows, "k string, p long"), ["k"], "p", "i", chunk_rows)
    expected = {(k, p): sorted(q for j, q in rows if j == k).index(p) for k, p in rows}
    assert {(r["k"], r["p"]): r["i"] for r in df.collect()} == expected


def test_listed_sheets(spark):
    cells = [
        ["Workbook title"],
        ["Table Name", "Description"],
        ["SHEET_A", "Description A"],
        ["SHEET_B", "Description B", "extra"],
        ["only a description"],
        ["SHEET_C", "Description C"],
        ["SHEET_A", "Description A2"],
    ]
    df = spark.createDataFrame([("f", i, c) for i, c in enumerate(cells)], "book string, row_idx int, cells array<string>")
    found = sorted((r["sheet_index"], r["sheet_name"], r["description"]) for r in listed_sheets(df, ["book"]).collect())
    assert found == [(0, "SHEET_A", "Description A2"), (1, "SHEET_B", "Description B"), (2, "SHEET_C", "Description C")]


def test_rates(spark):
    df = spark.createDataFrame([(10, 2.0), (10, 0.0)], "n long, s double")
    rows = df.select(guarded_ratio(F.col("n"), F.col("s")), approx_mb_per_second(F.col("n"), F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [(5.0, 10 * 40 / 1e6 / 2.0), (math.inf, math.inf)]


def test_numbers(spark):
    ids = spark.range(100)
    assert numbers.total_of(ids, F.col("id")).first()[0] == 4950
    groups = {r["bucket"]: (r["members"], r["bucket_sum"]) for r in numbers.totals_by(ids, F.col("id") % 3, F.col("id")).collect()}
    assert groups == {g: (len(range(g, 100, 3)), sum(range(g, 100, 3))) for g in range(3)}
    squares = sum(i * i for i in range(100))
    assert numbers.total_of_squares(ids, "id").first()[0] == numbers.total_of_squares(ids, "id", numbers.times_itself_in_python).first()[0] == squares
    assert numbers.with_digest(spark.range(1), "id").first()["payload"] == "cfcd208495d565ef66e7dff9f98764da"


def test_workloads_leave_one_batch(spark, schema):
    sinks.save_metric(spark, schema, "Old", {"total_seconds": 1.0}, "00000000_0000_AAAA_x")
    batch = workloads.run_workloads(spark, schema)
    metrics = spark.table(f"{schema}.{tables.METRICS}")
    assert batches.latest_batch(metrics).first()[0] == batch
    members = batches.batch_members(metrics).select("metric_name", seconds().alias("s")).collect()
    assert sorted(r["metric_name"] for r in members) == [
        "ClusterRoundtripLatency",
        "CollectBandwidth",
        "PythonUdfOverhead",
        "RangeAggregation",
        "ShuffleGroupBy",
        "SingleRowInsert",
    ]
    assert all(r["s"] > 0 for r in members)
    payload = {r[0]: r[1] for r in metrics.select("metric_name", F.to_json("payload")).collect()}
    assert '"checksum":12497500' in payload["RangeAggregation"]
    assert '"groups_returned":2' in payload["ShuffleGroupBy"]
    assert '"iterations":5' in payload["ClusterRoundtripLatency"]
    assert batches.latest_row(spark.table(f"{schema}.{tables.SCRATCH}")).first()["stuff"].startswith("inserted ")


def test_jobs(spark, tmp_path, capsys):
    name = "job_schema"
    try:
        jobs.main(["create", "--schema", name], spark)
        jobs.main(["workloads", "--schema", name], spark)
        (tmp_path / "in").mkdir()
        (tmp_path / "in" / "a.csv").write_text("Y,A\n1,x\n")
        jobs.main(["ingest-file", "--schema", name, "--prefix", str(tmp_path / "in")], spark)
        jobs.main(["ingest", "--schema", name, "--prefix", str(tmp_path / "in")], spark)
        jobs.main(["report", "--schema", name, "--kind", "average"], spark)
        out = capsys.readouterr().out
        assert "LoadReport(loaded=1, failed=0, rows=1)" in out
        assert "LoadReport(loaded=0, failed=0, rows=0)" in out
        assert "RangeAggregation" in out
        with pytest.raises(SystemExit):
            jobs.main(["workloads"], spark)
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
