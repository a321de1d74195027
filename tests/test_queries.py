"""Every named query against its SQL on DuckDB."""

import os
import shutil
import subprocess
import sys

import pytest
from conftest import SF_DIR

import __spark_entry__ as driver
from check import check, compare, duck
from tripweave.oracle import ORACLE
from tripweave.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("left", ["nothing", "empty folder", "pipeline"])
def test_without_the_operators_for_training_text(tmp_path, left):
    """All other queries are there, whether or not the pipeline or an empty folder is left."""
    root = os.path.dirname(os.path.abspath(driver.__file__))
    shutil.copytree(f"{root}/tripweave", tmp_path / "tripweave", ignore=lambda _, names: {"llm"} & set(names))
    kept = ["__spark_entry__.py"] + (["corpus_pipeline.py"] if left != "nothing" else [])
    for name in kept:
        if os.path.exists(f"{root}/{name}"):
            shutil.copy(f"{root}/{name}", tmp_path)
    if left == "empty folder":
        (tmp_path / "tripweave" / "llm" / "__pycache__").mkdir(parents=True)
    names = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    run = subprocess.run(
        [sys.executable, "-c", names], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    asked, sql = (line.split() for line in run.stdout.splitlines())
    assert asked == sorted(QUERIES) and sql == sorted(ORACLE)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert check(spark, con, SF_DIR, name) is None


def test_the_test_tables_show_every_case(spark):
    """Each reason to drop a trip, and the unknown hour, occur."""
    dropped = QUERIES["dropped_trips"](spark, SF_DIR).collect()
    for reason in ("no_time", "no_distance", "zero_distance", "bad_distance"):
        assert sum(r[reason] for r in dropped) > 0
    assert QUERIES["taxi_time_cells"](spark, SF_DIR).where("hour = '-1'").count() > 0
    zeros = {r.key: r["count"] for r in QUERIES["golden_counts"](spark, SF_DIR).collect()}
    plain = {r.key: r["count"] for r in QUERIES["golden_counts"].func(spark, SF_DIR).collect()}
    assert any(zeros[k] > plain.get(k, 0) and k.startswith("00000") for k in zeros)


def test_compare_sees_differences():
    assert compare([(1, "a")], [(1, "a")]) is None
    assert compare([(1, "a")], [(1, "b")])
    assert compare([(1,)], [(1,), (1,)])
    assert compare([(1,)], [(1.0,)])
