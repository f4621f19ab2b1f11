import json

import pytest
from writer import make_workbook

from partnerscope.functions.values import blank_fill
from partnerscope.session import passing_database
from partnerscope.sources import feeds
from partnerscope.streaming import ingest

SCHEMA = "k long, v string"


@pytest.fixture
def database(spark):
    with passing_database(spark, "ingest") as name:
        ingest.create_target(spark, name, "t", [("k", "string"), ("v", "string")])
        yield name


@pytest.fixture
def take(spark, tmp_path, database):
    def run(checkpoint="checkpoint", clean=blank_fill, **options):
        stream = ingest.landed_rows(spark, str(tmp_path / "landing"), SCHEMA, **options)
        return ingest.ingest_new(stream, clean, database, "t", str(tmp_path / checkpoint))

    return run


def land(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))


def added(spark, database):
    return sorted(tuple(r) for r in ingest.ingested(spark, database, "t").collect())


def test_each_landed_file_once(spark, tmp_path, database, take):
    land(spark, tmp_path, [(1, "a"), (2, None)])
    assert take() == 2 and take() == 0
    assert added(spark, database) == [(1, "1", "a"), (2, "2", "")]
    land(spark, tmp_path, [(3, "c")])
    assert take() == 1
    assert added(spark, database)[2:] == [(3, "3", "c")]


def test_a_new_checkpoint_takes_the_feed_anew_and_loses_nothing(spark, tmp_path, database, take):
    land(spark, tmp_path, [(1, "a"), (2, "b")])
    assert take("one") == 2 and take("two") == 2 and take("one") == 0
    assert [r[0] for r in added(spark, database)] == [1, 2, 3, 4]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path, database, take):
    land(spark, tmp_path, [(1, "a"), (2, "b")])
    assert take() == 2
    land(spark, tmp_path, [(3, "c")])

    def fail(batch):
        raise RuntimeError("the batch is planned but not done")

    with pytest.raises(Exception, match="not done"):
        take(clean=fail)
    assert take() == 1
    # As after a crash between the batch's rows and the note that it is done.
    commits = tmp_path / "checkpoint" / "commits"
    for name in ("1", ".1.crc"):
        (commits / name).unlink()
    assert take() == 1
    assert added(spark, database) == [(1, "1", "a"), (2, "2", "b"), (3, "3", "c")]


def test_more_batches_than_are_remembered(spark, tmp_path, database, take):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for k in range(5):
            land(spark, tmp_path, [(k, "x"), (k, "y")])
        assert take(maxFilesPerTrigger=1) == 10
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    rows = spark.table(f"{database}.t")
    assert rows.select("batch_no").distinct().count() == 5
    assert [r[0] for r in added(spark, database)] == list(range(1, 11))


def test_identity_is_the_checkpoints(spark, tmp_path, database, take):
    land(spark, tmp_path, [(1, "a")])
    take()
    metadata = json.loads((tmp_path / "checkpoint" / "metadata").read_text())
    assert spark.table(f"{database}.t").first()["feed"] == metadata["id"]


def test_landed_workbooks(spark, tmp_path, database):
    landing = tmp_path / "books"
    landing.mkdir()
    layout = [feeds.LoadColumn(0, "code", feeds.TEXT_TYPE), feeds.LoadColumn(1, "n", "bigint")]

    def upload():
        return ingest.ingest_sheets(spark, str(landing), layout, database, "books", str(tmp_path / "checkpoint"))

    (landing / "1.xlsx").write_bytes(make_workbook(["Mã", "Số"], [("A", 1), ("B", 2)]))
    assert upload() == 2
    (landing / "2.XLSX").write_bytes(make_workbook(["Mã", "Số"], [("C", None)]))
    assert upload() == 1 and upload() == 0
    found = sorted(tuple(r) for r in ingest.ingested(spark, database, "books").collect())
    assert found == [(1, "A", 1), (2, "B", 2), (3, "C", None)]


@pytest.fixture
def take_distinct(spark, tmp_path, database):
    def run(clean=blank_fill):
        stream = ingest.landed_rows(spark, str(tmp_path / "landing"), SCHEMA)
        return ingest.ingest_distinct(stream, clean, database, "t", str(tmp_path / "distinct"))

    return run


def test_content_that_lands_again_adds_nothing(spark, tmp_path, database, take_distinct):
    land(spark, tmp_path, [(1, "a"), (2, None), (2, None), (None, None)])
    assert take_distinct() == 3
    land(spark, tmp_path, [(1, "a"), (2, None), (2, None), (None, None)])
    assert take_distinct() == 0
    land(spark, tmp_path, [(2, ""), (1, "a"), (1, None)])
    assert take_distinct() == 2 and take_distinct() == 0
    rows = added(spark, database)
    assert [r[0] for r in rows] == [1, 2, 3, 4, 5]
    assert sorted(r[1:] for r in rows) == [("", ""), ("1", ""), ("1", "a"), ("2", ""), ("2", "")]


def test_a_distinct_batch_that_runs_again_adds_the_same(spark, tmp_path, database, take_distinct):
    land(spark, tmp_path, [(1, "a")])
    assert take_distinct() == 1
    land(spark, tmp_path, [(1, "a"), (2, "b")])

    def fail(batch):
        raise RuntimeError("the batch is planned but not done")

    with pytest.raises(Exception, match="not done"):
        take_distinct(clean=fail)
    assert take_distinct() == 1
    # As after a crash between the batch's rows and the note that it is done.
    commits = tmp_path / "distinct" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink()
    assert take_distinct() == 1
    assert added(spark, database) == [(1, "1", "a"), (2, "2", "b")]


def test_an_empty_landing_and_the_session_stays_as_it_was(spark, tmp_path, database, take_distinct):
    before = spark.conf.get(ingest.STATE_STORE, None)
    land(spark, tmp_path, [])
    assert take_distinct() == 0 and added(spark, database) == []
    assert spark.conf.get(ingest.STATE_STORE, None) == before


def test_a_workbook_under_another_name(spark, tmp_path, database):
    landing = tmp_path / "books"
    landing.mkdir()
    layout = [feeds.LoadColumn(0, "code", feeds.TEXT_TYPE), feeds.LoadColumn(1, "n", "bigint")]

    def upload():
        return ingest.ingest_sheets(spark, str(landing), layout, database, "books", str(tmp_path / "books_checkpoint"), distinct=True)

    book = make_workbook(["Mã", "Số"], [("A", 1), ("A", 1), ("B", 2)])
    (landing / "1.xlsx").write_bytes(book)
    assert upload() == 3  # rows that repeat within a workbook stay
    (landing / "copy.xlsx").write_bytes(book)
    (landing / "2.xlsx").write_bytes(make_workbook(["Mã", "Số"], [("C", None)]))
    assert upload() == 1 and upload() == 0
    found = sorted(tuple(r) for r in ingest.ingested(spark, database, "books").collect())
    assert found == [(1, "A", 1), (2, "A", 1), (3, "B", 2), (4, "C", None)]
