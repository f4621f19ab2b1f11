"""Profiles from the footers of parquet files."""

import datetime as dt
import math

import pyarrow as pa
import pyarrow.parquet as pq

from partnerscope.operators import profile


def figures(spark, path):
    rows = profile.metadata_profile(spark, str(path), "t").collect()
    return {r["column_name"]: tuple(r)[4:] for r in rows}


def test_no_column_is_scanned(spark, folder):
    for name in ("customer", "lineitem", "documents"):
        files = profile.footer_session(spark).read.parquet(f"{folder}/{name}.parquet")
        plan = profile.metadata_row(files)._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)" in plan


def test_the_session_stays_as_it_was(spark, folder):
    before = {k: spark.conf.get(k) for k in profile.FROM_FOOTERS}
    profile.metadata_profile(spark, f"{folder}/region.parquet", "region").collect()
    assert {k: spark.conf.get(k) for k in profile.FROM_FOOTERS} == before


def test_figures_over_several_files(spark, tmp_path):
    schema = "n int, v double, t string, d date, a array<int>"
    for rows in ([(1, 0.5, "x", dt.date(2025, 1, 2), [1]), (None, None, None, None, None)], [(-7, 2.0, "", dt.date(2024, 1, 2), [])]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    assert figures(spark, tmp_path / "t") == {
        "n": (3, 1, -7.0, 1.0, None, None),
        "v": (3, 1, 0.5, 2.0, None, None),
        "t": (3, 1, None, None, None, None),
        "d": (3, 1, None, None, dt.date(2024, 1, 2), dt.date(2025, 1, 2)),
        "a": (3, None, None, None, None, None),
    }


def test_footers_and_data_agree(spark, folder):
    for name in ("orders", "lineitem", "part"):
        path = f"{folder}/{name}.parquet"
        from_footers = profile.metadata_row(profile.footer_session(spark).read.parquet(path)).first()
        assert from_footers == profile.metadata_row(spark.read.parquet(path)).first()


def test_nan_and_files_without_statistics(spark, tmp_path):
    (tmp_path / "t").mkdir()
    columns = pa.table({"v": [1.5, math.nan, None], "n": pa.array([3, 4, None], pa.int64())})
    pq.write_table(columns, tmp_path / "t" / "a.parquet", write_statistics=False)
    assert figures(spark, tmp_path / "t") == {"v": (3, 1, 1.5, 1.5, None, None), "n": (3, 1, 3.0, 4.0, None, None)}
    spark.createDataFrame([(math.nan, 9), (0.5, 1)], "v double, n long").write.mode("append").parquet(str(tmp_path / "t"))
    assert figures(spark, tmp_path / "t") == {"v": (5, 1, 0.5, 1.5, None, None), "n": (5, 1, 1.0, 9.0, None, None)}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "n int, t string").write.parquet(str(tmp_path / "t"))
    assert figures(spark, tmp_path / "t") == {"n": (0, 0, None, None, None, None), "t": (0, 0, None, None, None, None)}
