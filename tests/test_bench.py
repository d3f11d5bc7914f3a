"""Every step of the bench runs once on the smallest tables."""

import os

import pytest

import bench

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")


def test_steps_run(spark):
    todo = bench.steps(spark, SF_DIR)
    assert {"csv_to_bronze", "bronze_to_silver", "silver_to_gold"} <= set(todo)
    for run in todo.values():
        run()
