import pytest
from pyspark.sql import functions as F

from partnerscope.operators import tables
from partnerscope.session import drop_database, kept, new_database, new_folder, passing_database, shared_folder, work_database
from partnerscope.sources import feeds


@pytest.fixture
def database(spark):
    name = new_database(spark, "test")
    yield name
    drop_database(spark, name)


def load(spark, df, database, name="t", **options):
    layout = feeds.frame_layout(df, **options)
    return tables.load_frame(spark, feeds.frame_to_load(df, layout), layout, database, name)


def test_create_append_and_ids(spark, database):
    df = spark.range(0, 1000, 1, 7).select(F.col("id").alias("key"), F.lit("x").alias("v"))
    assert load(spark, df, database) == 1000
    assert load(spark, df.repartition(3), database) == 1000
    table = spark.table(f"{database}.t")
    assert table.columns == ["id", "key", "v"]
    ids = [r.id for r in table.orderBy("id").collect()]
    assert ids == list(range(1, 2001))
    assert tables.last_id(spark, database, "t") == 2000
    assert table.where("id <= 1000").select(F.count_distinct("key")).first()[0] == 1000


def test_types_in_the_table(spark, database):
    load(spark, spark.createDataFrame([(1, 1.5, "x")], "a long, b double, c string"), database)
    found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE {database}.t").collect()}
    assert found == {"id": "bigint", "a": "int", "b": "float", "c": "varchar(255)"}


def test_existing_table_wins(spark, database):
    load(spark, spark.createDataFrame([(1, "x")], "a long, b string"), database)
    load(spark, spark.createDataFrame([("y",)], "b string"), database)
    assert sorted(tuple(r) for r in spark.table(f"{database}.t").collect()) == [(1, 1, "x"), (2, None, "y")]
    with pytest.raises(ValueError, match="no column z"):
        load(spark, spark.createDataFrame([(1,)], "z long"), database)


def test_text_too_long(spark, database):
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        load(spark, spark.createDataFrame([("x" * 256,)], "a string"), database)
    assert spark.table(f"{database}.t").count() == 0


def test_number_too_large(spark, database):
    df = spark.createDataFrame([(2**31,)], "a long")
    with pytest.raises(Exception, match="OVERFLOW"):
        load(spark, df, database)
    assert load(spark, df, database, "wide", wide=True) == 1


def test_ids_by_sheet(spark, database):
    rows = [("b", 1), ("a", 2), ("a", 1), ("b", 2), ("c", 1), (None, 1)]
    df = spark.createDataFrame([(p, n, f"{p}{n}") for p, n in rows if p], "path string, row_no long, v string")
    spark.sql(f"CREATE TABLE {database}.t (id bigint, v string) USING parquet")
    spark.sql(f"INSERT INTO {database}.t VALUES (10, 'first')")
    assert tables.append_numbered(spark, df, "path", "row_no", database, "t") == 5
    found = {r.v: r.id for r in spark.table(f"{database}.t").collect()}
    assert found == {"first": 10, "a1": 11, "a2": 12, "b1": 13, "b2": 14, "c1": 15}


def test_offsets_of_many_sources(spark):
    sources = [(f"f{i:03d}", i % 7) for i in range(300)]
    ranged = spark.createDataFrame(sources, "source string, _rows long").repartitionByRange(5, "source")
    counts = ranged.withColumn("_range", F.spark_partition_id()).checkpoint()
    found = {r["source"]: r["_offset"] for r in tables.row_offsets(counts).collect()}
    assert found == {s: sum(n for t, n in sources if t < s) for s, _ in sources}


def test_files_are_loaded_without_a_copy(spark, database, folder):
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    assert tables.load_files(spark, customers, feeds.frame_layout(customers, wide=True), database, "c") == customers.count()
    ids = sorted(r.id for r in spark.table(f"{database}.c").collect())
    assert ids == list(range(1, len(ids) + 1))
    with pytest.raises(Exception, match="_metadata|UNRESOLVED"):
        tables.load_files(spark, spark.range(3), feeds.frame_layout(spark.range(3)), database, "r")


def test_drop_goes_on(spark, database):
    load(spark, spark.createDataFrame([(1,)], "a long"), database, "one")
    results = tables.drop_tables(spark, database, ["one", "two", "bad` name"])
    assert [r[:2] for r in results] == [("one", True), ("two", False), ("bad` name", False)]
    assert results[2][2] and not spark.catalog.tableExists(f"{database}.one")


def test_folders(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "a") != new_folder(spark, "a")
    assert kept(spark.range(3)).count() == 3
    place = spark.sql(f"DESCRIBE DATABASE {work_database(spark)}").where("info_name = 'Location'").first()["info_value"]
    assert shared_folder(spark) in place


def test_nothing_stays(spark, folder):
    from partnerscope.plans import queries

    def there():
        return {d.name: len(spark.catalog.listTables(d.name)) for d in spark.catalog.listDatabases()}

    work_database(spark)
    before = there()
    for name in ("typed_load_append", "surrogate_id", "loaded_report", "query_then_drop", "drop_tables", "catalog_columns", "incremental_ingest", "union_total_last"):
        queries.REGISTRY[name](spark, folder).collect()
        assert there() == before, name


def test_a_failed_block_frees_its_database(spark):
    with pytest.raises(RuntimeError), passing_database(spark, "failed") as name:
        spark.range(3).write.saveAsTable(f"{name}.t")
        raise RuntimeError
    assert not spark.catalog.databaseExists(name)


def test_show_rows(spark, capsys):
    tables.show_rows(spark.range(3), 2)
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_the_journal_spares_the_ids(spark, database, monkeypatch):
    """No load reads the rows of the loads before it."""
    df = spark.range(5).select(F.col("id").alias("key"))
    load(spark, df, database)
    monkeypatch.setattr(tables, "last_id", lambda *a: pytest.fail("ids were looked at"))
    load(spark, df, database)
    assert tables.journal(spark, database, "t")[tables.HIGH] == "10"


def test_a_failed_load_after_others(spark, database):
    """Nothing of it stays, and ids go on without a gap."""
    good, bad = (spark.createDataFrame([(k * "x",) for k in sizes], "a string") for sizes in ([1, 2], [3, 300, 4]))
    load(spark, good, database)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        load(spark, bad, database)
    assert tables.journal(spark, database, "t")[tables.OPEN]
    load(spark, good, database)
    assert not tables.journal(spark, database, "t")[tables.OPEN]
    assert sorted((r.id, len(r.a)) for r in spark.table(f"{database}.t").collect()) == [(1, 1), (2, 2), (3, 1), (4, 2)]


def test_a_table_without_journal(spark, database):
    spark.sql(f"CREATE TABLE {database}.old (id bigint, a string) USING parquet")
    spark.sql(f"INSERT INTO {database}.old VALUES (7, 'x')")
    load(spark, spark.createDataFrame([("y",)], "a string"), database, "old")
    assert sorted(tuple(r) for r in spark.table(f"{database}.old").collect()) == [(7, "x"), (8, "y")]


def test_a_batch_that_runs_again_starts_where_it_did(spark, database):
    tables.create_table(spark, database, "t", [feeds.LoadColumn(0, "a", "bigint")])
    assert tables.batch_start(spark, database, "t", "f", 0, "true") == 0
    tables.note(spark, database, "t", **{tables.HIGH: 5})
    assert tables.batch_start(spark, database, "t", "f", 0, "true") == 0
    assert tables.batch_start(spark, database, "t", "f", 1, "true") == 5
