"""The layout of the fits: a forest's counters are sent once a task and pass."""

import pytest

from keepwell import contract as C
from keepwell.operators import models as ML


@pytest.mark.parametrize("rows, tasks", [(0, 1), (1, 1), (2_000, 1), (2_001, 2), (15_000, 8), (24_000, 12)])
def test_small_bases_have_a_task_for_2000_rows(rows, tasks):
    assert ML.FOREST_LAYOUT.parts(rows) == tasks


@pytest.mark.parametrize("rows", [24_001, 90_000, 900_000, 5_400_000])
def test_larger_bases_send_no_more_counters(rows):
    assert ML.FOREST_LAYOUT.parts(rows) == 12


def test_a_task_has_a_largest_number_of_rows():
    for rows in (6_000_001, 50_000_000, 1_000_000_000):
        assert rows / ML.FOREST_LAYOUT.parts(rows) <= 500_000
        assert rows / ML.KMEANS_LAYOUT.parts(rows) <= 100_000


def test_a_fit_sees_few_partitions_and_all_rows(spark):
    base = spark.range(30_000).selectExpr(f"concat('C', id) AS {C.ID}")
    with ML.fixed_layout(base) as rows:
        assert rows.rdd.getNumPartitions() == 12
        assert rows.distinct().count() == 30_000
