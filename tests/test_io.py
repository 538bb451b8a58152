from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from adloom import schemas
from adloom.operators import quality
from adloom.operators.cleaning import truncate_measures
from adloom.schemas import INT, STRING, struct
from adloom.session import materialize, scratch_path, shared_dir
from adloom.sinks import tables as sinks
from adloom.sources import tables as sources
from adloom.sources.delimited import file_headers, open_lines, read_delimited
from adloom.sources.tables import TableSource
from adloom.streaming.ingest import ingest_folder

SCHEMA = struct({"name": STRING, "n": INT})


def test_jdbc_options_split_the_read():
    source = TableSource(
        url="jdbc:x://h/d", query="select 1", driver="d.D", partition_column="id", lower_bound=0, upper_bound=9,
        num_partitions=4, options={"user": "u"},
    )
    read = source.read_options()
    assert read["dbtable"] == "(select 1) src" and read["numPartitions"] == "4" and read["partitionColumn"] == "id"
    assert read["user"] == "u" and read["driver"] == "d.D" and int(read["fetchsize"]) > 0
    target = TableSource(url="jdbc:x://h/d", table="t")
    assert target.write_options("overwrite")["truncate"] == "true"
    assert "truncate" not in target.write_options("append")
    for bad in ({}, {"path": "p", "url": "u"}, {"url": "u"}, {"url": "u", "table": "t", "partition_column": "id"}):
        with pytest.raises(ValueError):
            TableSource(**bad)


def test_read_csv_declared_schema(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("name,n\na,1\nb,x\n")
    assert [tuple(r) for r in sources.read_csv(spark, str(path), SCHEMA).collect()] == [("a", 1), ("b", None)]


def test_only_lines_with_too_many_fields_are_set_aside(spark, tmp_path, rows):
    path = tmp_path / "a.tsv"
    path.write_text("Report,of today\nname\tn\na\t1\nb\tx\nc\t3\textra\nd\n\ne\t\n\t5\nf\t6\t\n")
    found = read_delimited(spark, str(path), SCHEMA, sep="\t", skip_rows=1)
    assert rows(found.rows.drop("file_path")) == [("a", 1), ("b", None), ("d", None), ("e", None), ("f", 6), (None, 5)]
    assert rows(found.rejects.select("line", "reason")) == [("c\t3\textra", "too many fields")]
    assert [r.lines for r in found.reject_counts().collect()] == [1]
    texts = struct({"name": STRING, "n": STRING})
    found = read_delimited(spark, str(path), texts, sep="\t", skip_rows=1)
    assert rows(found.rows.drop("file_path")) == [("a", "1"), ("b", "x"), ("d", None), ("e", None), ("f", "6"), (None, "5")]


def test_preamble_of_every_file_and_split(spark, tmp_path, rows):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for f in range(3):
        body = "".join(f"name {f},{i}\n" for i in range(500))
        (tmp_path / f"{f}.csv").write_text('of,today\nname,n\n' + body + 'of,today\n')
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
        found = read_delimited(spark, str(tmp_path), SCHEMA, skip_rows=1)
        assert found.rows.count() == 1503
        assert found.rows.filter("n is null").count() == 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_folder_of_two_layouts_is_read_by_name(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('name,n\n"x,1",1\n')
    (tmp_path / "b.csv").write_text("n,note,name\n7,hi,y\n8,,z\n9\n1,2,3,4\n")
    (tmp_path / "c.csv").write_text("name\nw\n")
    (tmp_path / "d.csv").write_text("")
    checked = quality.check_columns(spark, [str(tmp_path)], ["name", "n"])
    got = {r.path.rsplit("/")[-1]: (r.status, r.missing, r.extra) for r in checked.collect()}
    assert got == {"a.csv": ("valid", [], []), "b.csv": ("valid", [], ["note"]), "c.csv": ("rejected", ["n"], [])}
    found = quality.read_valid_files(spark, [str(tmp_path)], SCHEMA)
    assert rows(found.rows.drop("file_path")) == [("x,1", 1, None), ("y", 7, "note=hi"), ("z", 8, "note="), (None, 9, "note=")]
    assert rows(found.rejects.select("line")) == [("1,2,3,4",)]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.csv").write_text("nothing\n")
    assert quality.read_valid(spark, [str(tmp_path / "e")], SCHEMA).collect() == []


def test_files_are_scanned_once(spark, tmp_path, rows):
    """Headers, check and rows come from the stored lines, whatever happens to the files after the scan."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")  # files of several blocks
        for f in range(4):
            body = "".join(f"{i},name {f}\n" for i in range(400))
            (tmp_path / f"{f}.csv").write_text("of,today\n" + "n,name\n" + body)
        lines = open_lines(spark, str(tmp_path))
        for f in range(4):
            (tmp_path / f"{f}.csv").write_text("gone\n" * (f + 1))
        assert {tuple(r.header) for r in file_headers(spark, lines, skip_rows=1).collect()} == {("n", "name")}
        assert lines.numbered().filter("line_no is null").count() > 0
        assert lines.first_block().filter("line_no = 0").count() == 4
        found = quality.read_valid_files(spark, lines, SCHEMA, skip_rows=1).rows
        assert found.count() == 1600 and found.filter("n is null or name is null").isEmpty()
        sizes = {r.file_path.rsplit("/")[-1]: r["size"] for r in lines.files.collect()}
        assert len(sizes) == 4 and min(sizes.values()) > 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_only_first_blocks_are_searched_for_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,name\n1,x\n")
    plan = file_headers(spark, open_lines(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(head,true)" in plan


def test_a_typed_write_evaluates_its_rows_once(spark, tmp_path):
    evaluated = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(n):
        evaluated.add(1)
        return n

    df = spark.range(0, 500, 1, 4).select(F.lit("a").alias("name"), seen(F.col("id").cast("int")).alias("n"))
    sinks.write_table(df, TableSource(path=str(tmp_path / "t")), schema=SCHEMA, sort=["n"])
    assert evaluated.value == 500 and spark.read.parquet(str(tmp_path / "t")).count() == 500


def test_nothing_is_written_if_values_do_not_fit(spark, tmp_path):
    target = TableSource(path=str(tmp_path / "t"))
    sinks.write_table(spark.createDataFrame([("a", 1.0)], "name string, n double"), target, schema=SCHEMA)
    with pytest.raises(ValueError, match="'n': 1"):
        sinks.write_table(spark.createDataFrame([("b", 3e9)], "name string, n double"), target, schema=SCHEMA)
    assert [r.name for r in spark.read.parquet(target.path).collect()] == ["a"]


def test_only_named_days_are_replaced(spark, tmp_path):
    target = TableSource(path=str(tmp_path / "t"))
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    rows = [(f"old {d}", d) for d in days for _ in range(3)] + [("none", None)]
    df = spark.createDataFrame(rows, "name string, updated_date date")
    sinks.write_table(df, target, partition_by=["updated_date"])

    def files(of):
        return {p for p in (tmp_path / "t").rglob("*.parquet") if of in str(p)}

    before = files("")
    new = spark.createDataFrame([("new", days[1]), ("not asked", days[0])], "name string, updated_date date")
    sinks.refresh_days(new, target, [days[1], days[2]])
    read = sorted((r.name, str(r.updated_date)) for r in sources.read_table(spark, target).collect())
    assert read == [("new", "2024-01-02"), ("none", "None"), *[("old 2024-01-01", "2024-01-01")] * 3]
    assert files("2024-01-01") <= before and files("HIVE_DEFAULT") <= before and not files("2024-01-02") & before
    for wrong in ({}, {"partition_by": ["name"], "mode": "append"}):
        with pytest.raises(ValueError):
            sinks.write_table(new, target, replace_partitions=True, **wrong)


def test_audit_rows_of_a_run_are_added_once(spark, tmp_path):
    target = TableSource(path=str(tmp_path / "audit"))
    for run, errors in (("r1", "ab"), ("r2", "abc"), ("r2", "c"), ("r3", "")):
        quality.append_audit(spark.createDataFrame([("t", e) for e in errors], "table_name string, error string").repartition(2), target, run)
    assert sorted((r.run, r.error) for r in spark.read.parquet(target.path).collect()) == [("r1", "a"), ("r1", "b"), ("r2", "c")]
    with pytest.raises(ValueError):
        quality.append_audit(spark.range(1), target, "a/b")


def test_misfits_stop_a_typed_write(spark, tmp_path):
    target = TableSource(path=str(tmp_path / "t"))
    df = spark.createDataFrame([("a", 3e9), ("b", 1.0)], "name string, n double")
    with pytest.raises(ValueError, match="'n': 1"):
        sinks.write_table(df, target, schema=SCHEMA)
    sinks.write_table(df, target, schema=SCHEMA, allow_misfits=True)
    assert [r.n for r in sources.read_table(spark, target).orderBy("name").collect()] == [None, 1]
    none = spark.createDataFrame([(None, 1)], "name string, n int")
    with pytest.raises(ValueError, match="'name': 1"):
        sinks.write_table(none, target, schema=struct({"name": STRING, "n": INT}, required=("name",)))
    assert [tuple(r) for r in truncate_measures(df, ["n"]).select("n").orderBy("n").collect()] == [(1,), (3_000_000_000,)]


def test_newest_date_is_asked_of_the_database():
    target = TableSource(url="jdbc:x://h/d", table="t", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=4)
    read = sinks.newest_source(target, "updated_date").read_options()
    assert read["dbtable"] == "(select max(updated_date) as updated_date from t) src" and "partitionColumn" not in read
    assert int(target.write_options("append")["numPartitions"]) == 4
    assert int(TableSource(url="jdbc:x://h/d", table="t").write_options("append")["numPartitions"]) > 0


def test_gather_skips_missing_and_empty_files(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("name,n\na,1\na,1\n")
    (tmp_path / "b.csv").write_text("name,n\na,1\nb,2\n")
    (tmp_path / "empty.csv").write_text("")
    paths = [str(tmp_path / f) for f in ("a.csv", "b.csv", "empty.csv", "gone.csv")]
    assert rows(sources.gather(spark, paths, SCHEMA)) == [("a", 1), ("b", 2)]
    assert len(rows(sources.gather(spark, paths, SCHEMA, distinct=False))) == 4
    named = sources.gather(spark, paths, SCHEMA, columns=["name"], with_file=True)
    assert {(r.name, r.file_path.rsplit("/")[-1]) for r in named.collect()} == {("a", "a.csv"), ("a", "b.csv"), ("b", "b.csv")}
    assert sources.gather(spark, [str(tmp_path / "gone.csv")], SCHEMA).count() == 0


def test_concat_fills_absent_columns(spark, rows):
    a = spark.createDataFrame([("a", 1)], "name string, n int")
    b = spark.createDataFrame([("b",)], "name string")
    assert rows(sources.concat(a, b)) == [("a", 1), ("b", None)]


def test_parquet_table_round_trip_prunes_and_pushes_down(spark, tmp_path):
    target = TableSource(path=str(tmp_path / "t"))
    df = spark.range(100).selectExpr("id", "cast(id % 5 as string) as account_name", "id * 2 as v", "id * 3 as w")
    sinks.write_table(df, target, sort=["account_name", "id"])
    read = sources.read_table(spark, target, ["v"], "account_name = '3'")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(account_name,3)" in plan
    assert "w" not in plan.split("ReadSchema: ")[1]
    assert read.count() == 20
    assert sources.only_account(df, "3").count() == 20
    assert sinks.row_count(df) == 100


def test_typed_target(spark, tmp_path):
    df = spark.createDataFrame([("1", "x")], "n string, extra string").selectExpr("extra as name", "n")
    target = TableSource(path=str(tmp_path / "t"))
    sinks.write_table(df, target, schema=SCHEMA)
    assert [tuple(r) for r in sources.read_table(spark, target, schema=SCHEMA).collect()] == [("x", 1)]
    assert len(schemas.CAMPAIGN_INFO.fields) == 27


def test_append_and_partitions(spark, tmp_path):
    target = TableSource(path=str(tmp_path / "t"))
    df = spark.createDataFrame([("a", 1)], "name string, n int")
    sinks.write_table(df, target, "append", partition_by=["name"])
    sinks.write_table(df, target, "append", partition_by=["name"])
    assert sources.read_table(spark, target).count() == 2


def test_stamped_csv_and_staging(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "name string, n int")
    out = sinks.write_stamped_csv(df, str(tmp_path), "report", datetime(2024, 3, 9, 7, 5))
    assert out.endswith("/report_09_03_2024_07_05.csv")
    assert sources.read_csv(spark, out, SCHEMA).count() == 1
    staged = sinks.stage_load(df, str(tmp_path / "stage"), "csv")
    assert sources.read_csv(spark, staged, SCHEMA).count() == 1
    assert spark.read.parquet(sinks.stage_load(df, str(tmp_path / "stage2"))).count() == 1


def test_refresh_replaces_only_stale_targets(spark, tmp_path):
    target = TableSource(path=str(tmp_path / "t"))
    today = date(2024, 1, 2)
    old = spark.createDataFrame([("old", date(2024, 1, 1))], "name string, updated_date date")
    new = spark.createDataFrame([("new", today)], "name string, updated_date date")
    assert sinks.refresh_if_stale(old, target, today)
    assert sinks.refresh_if_stale(new, target, today)
    assert not sinks.refresh_if_stale(new, target, today)
    assert [r.name for r in sources.read_table(spark, target).collect()] == ["new", "new"]


def test_drop_folder_takes_each_file_once(spark, tmp_path, rows):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    archive = tmp_path / "done"
    src.mkdir()

    def run():
        return ingest_folder(spark, str(src), SCHEMA, out, state, archive=str(archive))

    (src / "a.csv").write_text("name,n\na,1\n")
    assert run().exception() is None
    (src / "b.csv").write_text("name,n\nb,2\nc,3\n")
    run()
    run()
    assert rows(spark.read.parquet(out).drop("batch")) == [("a", 1), ("b", 2), ("c", 3)]


def test_drop_folder_keeps_short_lines_and_sets_long_ones_aside(spark, tmp_path, rows):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.tsv").write_text("Report\nname\tn\na\t1\nb\tx\nc\t3\textra\nd\n")
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    ingest_folder(spark, str(src), SCHEMA, out, str(tmp_path / "state"), sep="\t", skip_rows=1, rejects=bad)
    assert rows(spark.read.parquet(out).drop("batch")) == [("a", 1), ("b", None), ("d", None)]
    assert [r.line for r in spark.read.parquet(bad).collect()] == ["c\t3\textra"]


ODD_NAMES = ["daily sales.csv", "50%20 off.csv", "a+b #1.csv", "x=y&z;(1).csv", "tab\tname.csv"]


def test_drop_folder_takes_odd_names_and_reads_each_file_once(spark, tmp_path, rows, monkeypatch):
    from adloom.streaming import ingest

    src, out, bad = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "bad")
    src.mkdir()
    names = list(ODD_NAMES)
    if "UTF" in spark._jvm.System.getProperty("sun.jnu.encoding").upper():
        names.append("täglich ☂.csv")
    for i, name in enumerate(names):
        (src / name).write_text(f"name,n\n{i},{i}\nx,1,too many\n")

    def once(lines):
        stored = ingest_lines(lines)
        for name in list(names):
            (src / name).write_text("changed,while,read\n")
        return stored

    ingest_lines = ingest.store_lines
    monkeypatch.setattr(ingest, "store_lines", once)
    ingest_folder(spark, str(src), SCHEMA, out, str(tmp_path / "state"), rejects=bad)
    assert rows(spark.read.parquet(out).drop("batch")) == [(str(i), i) for i in range(len(names))]
    assert {r.file_path.rsplit("/")[-1] for r in spark.read.parquet(bad).collect()} == set(names)


def test_a_name_that_is_a_pattern_is_an_error(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for name in ("a?.csv", "b.csv"):
        (src / name).write_text("name,n\na,1\n")
    with pytest.raises(Exception, match="rename the file"):
        ingest_folder(spark, str(src), SCHEMA, str(tmp_path / "out"), str(tmp_path / "state"))
    assert not (tmp_path / "out").exists()


def test_a_batch_with_wrong_lines_shows_no_rows(spark, tmp_path):
    src, out, state = tmp_path / "in", tmp_path / "out", str(tmp_path / "state")
    src.mkdir()
    (src / "a b.csv").write_text("name,n\na,1\nb,2,more\n")
    with pytest.raises(Exception, match="a b.csv: too many fields"):
        ingest_folder(spark, str(src), SCHEMA, str(out), state)
    assert not list(out.glob("batch=*"))
    ingest_folder(spark, str(src), SCHEMA, str(out), state, rejects=str(tmp_path / "bad"))
    assert [r.name for r in spark.read.parquet(str(out)).collect()] == ["a"]


def test_batches_are_bounded(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    for i in range(5):
        (src / f"{i}.csv").write_text(f"name,n\n{i},{i}\n")
    ingest_folder(spark, str(src), SCHEMA, str(out), str(tmp_path / "state"), max_files=2)
    assert len(list(out.glob("batch=*"))) == 3 and spark.read.parquet(str(out)).count() == 5


def test_intermediates_go_to_the_named_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    mark = scratch_path(spark, "x").rpartition("/")[0]
    assert mark.startswith(shared_dir(spark)) and spark.sparkContext.applicationId in mark
    stored = materialize(spark.range(3).toDF("AD GRP"), "t")
    assert stored.inputFiles()[0].startswith("file:" + shared_dir(spark)) or shared_dir(spark) in stored.inputFiles()[0]
    assert stored.count() == 3
