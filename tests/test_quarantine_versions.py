"""Bad lines of CSV files in a quarantine table; versioned model folders; the entry without the llm folders."""

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from recengine import schemas as S
from recengine.sources import readers, sinks

LINES = ["userId,movieId,rating,timestamp", "1,2,3.5,4", "1,2,x,4", "1,2,3.5,y", "1,2,x,y", "1,2,3.5", "1,2,3.5,4,5", "", "1,3,4.0,9", ",,,",
         "1,2,NaN,4"]


def test_bad_lines_go_to_the_quarantine(spark):
    path, bad = sinks.scratch_path(spark, "lines"), sinks.scratch_path(spark, "bad")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(path)
    rows, counts = readers.read_quarantined(spark, path, S.RATINGS, bad)
    assert rows.schema == S.RATINGS
    assert sorted(map(str, (tuple(r) for r in rows.collect()))) == sorted(map(str, [
        (1, 2, 3.5, 4), (1, 3, 4.0, 9), (None, None, None, None), (1, 2, float("nan"), 4)]))
    found = {r["line"]: r["reason"] for r in spark.read.parquet(bad).collect()}
    assert found == {"1,2,x,4": "not a value: rating", "1,2,3.5,y": "not a value: timestamp", "1,2,x,y": "not a value: rating, timestamp",
                     "1,2,3.5": "number of cells", "1,2,3.5,4,5": "number of cells"}
    assert {r["reason"]: r["lines"] for r in counts.collect()} == {
        None: 4, "not a value: rating": 1, "not a value: timestamp": 1, "not a value: rating, timestamp": 1, "number of cells": 2}
    assert spark.read.parquet(bad).where(F.col("file").contains("lines-")).count() == 5
    checked = readers.checked_csv(spark, path, S.RATINGS)
    assert checked.count() == 9 and checked.where("_reason is null").count() == 4


def test_quoted_texts_and_empty_files(spark):
    path = sinks.scratch_path(spark, "movies")
    movies = spark.createDataFrame([(1, 'A, "the" B (1990)', "X|Y"), (2, None, "")], S.MOVIES)
    sinks.write_csv(movies, path)
    rows, _ = readers.read_quarantined(spark, path, S.MOVIES, sinks.scratch_path(spark, "bad"))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, readers.read_movies(spark, path).collect()))
    none = sinks.scratch_path(spark, "none")
    sinks.write_csv(movies.limit(0), none)
    rows, counts = readers.read_quarantined(spark, none, S.MOVIES, sinks.scratch_path(spark, "bad"))
    assert rows.count() == 0 and counts.count() == 0


def test_a_failure_between_parts_leaves_the_older_version(spark):
    path = sinks.scratch_path(spark, "versions")
    with pytest.raises(FileNotFoundError):
        sinks.current_version(spark, path)

    def write(n, fail=False):
        def parts(folder):
            spark.range(n).write.parquet(f"{folder}/one")
            if fail:
                raise RuntimeError("lost between parts")
            spark.range(10 * n).write.parquet(f"{folder}/two")
        return parts

    def read():
        at = sinks.current_version(spark, path)
        return spark.read.parquet(f"{at}/one").count(), spark.read.parquet(f"{at}/two").count()

    sinks.save_versioned(spark, path, write(1))
    assert read() == (1, 10)
    with pytest.raises(RuntimeError):
        sinks.save_versioned(spark, path, write(2, fail=True))
    assert read() == (1, 10) and sinks.versions(spark, path) == [1]
    assert not [f for f in os.listdir(path.replace("file:", "")) if "unfinished" in f]
    for n in (3, 4, 5):
        sinks.save_versioned(spark, path, write(n))
    assert read() == (5, 50) and sinks.versions(spark, path) == [3, 4]


def test_entry_without_the_llm_folders(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    own = shutil.copytree(repo, tmp_path / "repo", ignore=lambda d, names: [n for n in names if n in ("llm", ".git", "__pycache__")])
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'user_features' in q and set(s) <= set(q), 1; "
            "assert 'pipeline' not in q and not [x for x in q if x.startswith('op')], 2")
    subprocess.run([sys.executable, "-c", code], cwd=own, check=True, env=os.environ | {"PYTHONPATH": str(own)})
    if os.path.exists(f"{repo}/recengine/llm"):
        os.remove(own / "corpus_pipeline.py") if (own / "corpus_pipeline.py").exists() else None
        subprocess.run([sys.executable, "-c", code], cwd=own, check=True, env=os.environ | {"PYTHONPATH": str(own)})
