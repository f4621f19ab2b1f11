"""The pipeline's stages, each on its own input, against plain versions."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
import plain  # noqa: E402

from partnerscope.llm.common import Work  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark, folder):
    """Input and output of every stage."""
    work = Work(spark, "test")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        made = work.keep(stage(spark, docs, folder), "stage")
        found[name] = docs, made
        docs = made
    return found


def rows(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_order_and_columns(steps, folder):
    assert list(steps) == ["toxicity", "near copies", "repeated passages", "benchmark leaks", "packing"]
    for name in list(steps)[:-1]:
        assert steps[name][1].columns == steps[name][0].columns


def test_near_copies(steps):
    before, after = map(rows, steps["near copies"])
    expected = plain.near_copies(list(before.items()), 5, 80)
    assert after == {i: t for i, t in before.items() if expected[i][1] == i}


def test_repeats(steps):
    before, after = map(rows, steps["repeated passages"])
    expected = plain.repeats(list(before.items()), 50)
    assert {i: " ".join(plain.WORD.findall(t)) for i, t in after.items()} == {
        i: x[3] for i, x in zip(before, expected, strict=True)
    }
    assert steps["repeated passages"][1].where("n_chars <> length(text)").count() == 0


def test_leaks(steps, spark, folder):
    before, after = map(rows, steps["benchmark leaks"])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    expected = plain.leaks(before.items(), items)
    assert after == {i: t for i, t in before.items() if not expected[i]}


def test_toxic_documents_go(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    after = rows(corpus_pipeline.drop_toxic(spark, docs, folder))
    before = rows(docs)
    terms = {"idiot", "moron", "scum", "loser", "clown", "pathetic", "worthless", "disgusting", "stupid", "trash"}
    used = {i for i, t in before.items() if len(terms & set((t or "").lower().split())) >= 2}
    assert used and not used & set(after)
    assert len(before) - len(after) < 0.15 * len(before)


def test_packed(steps):
    before, made = steps["packing"]
    assert made.select("doc_id").distinct().count() == before.count()


def test_run_is_its_stages(steps, spark, folder):
    made = corpus_pipeline.run(spark, folder)
    last = steps["packing"][1]
    assert made.columns == last.columns
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(made.select(key).collect()) == sorted(last.select(key).collect())


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_near_copies_by_row(spark, folder):
    """Ids that repeat: each text is judged, none is lost with another of its id."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    given = [(3, b), (7, a), (7, b), (9, c), (9, c), (None, a), (4, None), (5, ""), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in given], COLUMNS)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, folder).collect()]
    assert sorted(kept, key=str) == sorted([x for x in given if x != (7, b)], key=str)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_documents(spark, folder, name, stage):
    """Nulls in every column, empty and very long texts, repeated rows; and no rows at all."""
    long = " ".join(f"w{k}" for k in range(20_000))
    given = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", len(long)), (None, "few words", None, "s", 9), (4, "x", "en", "s", 1), (4, "x", "en", "s", 1)]
    docs = spark.createDataFrame(given, COLUMNS)
    found = stage(spark, docs, folder)
    ids = {r["doc_id"] for r in found.collect()}
    assert {1, 2, 3, 4} <= ids
    if name != "packing":
        assert found.columns == docs.columns and found.count() == len(given)
    assert stage(spark, docs.limit(0), folder).count() == 0
