"""Versions of the scoring bundle."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from keepwell.operators import models as ML
from keepwell.operators import priority as PR
from keepwell.operators import score as S
from keepwell.operators import segments as SG
from keepwell.operators import versions as VS
from keepwell.operators.prepare import build_features
from keepwell.session import materialise
from keepwell.sources.star_schema import accounts as account_view
from keepwell.streaming.scoring import account_stream, score_stream

TINY = ML.ForestSettings(trees=3, depth=3)


@pytest.fixture(scope="module")
def bundle(spark, sf):
    f = materialise(build_features(account_view(spark, sf)))
    churn = ML.fit_churn_models(ML.churn_training_set(f), settings=TINY)[ML.LOGISTIC]
    value = ML.fit_value_model(ML.value_training_set(f), settings=TINY)
    segments = SG.fit_segments(f, restarts=1)
    scores = ML.score_base(f, churn, value)
    return S.Bundle(churn, value, segments, {k: f"S{k}" for k in range(4)}, PR.median_thresholds(scores))


def test_versions_follow_each_other(spark, bundle, tmp_path):
    root = str(tmp_path)
    current = VS.CurrentBundle(root)
    with pytest.raises(FileNotFoundError):
        current.get()
    assert VS.publish(bundle, root).number == 1
    assert current.get()[0] == 1 and current.get()[1] is current.get()[1]
    moved = dataclasses.replace(bundle, thresholds=PR.Thresholds(0.25, 7.0))
    assert VS.publish(moved, root).number == 2
    number, held = current.get()
    assert (number, held.thresholds, held.names) == (2, PR.Thresholds(0.25, 7.0), bundle.names)
    assert held.segments.centroids == bundle.segments.centroids


def test_half_written_and_damaged_versions_are_passed_over(spark, bundle, tmp_path):
    root = str(tmp_path)
    first = VS.publish(bundle, root)
    bundle.save(f"{root}/versions/begun")                      # no manifest yet
    assert VS.newest(spark, root) == first
    second = VS.publish(bundle, root)
    assert VS.newest(spark, root) == second
    part = next((tmp_path / "versions" / second.folder / "thresholds").glob("*.parquet"))
    part.write_bytes(part.read_bytes()[:-1])
    for crc in part.parent.glob(".*.crc"):
        crc.rename(crc.with_suffix(".old"))
    assert VS.newest(spark, root) == first and VS.CurrentBundle(root).get()[0] == 1
    part.rename(part.with_name("gone"))
    assert VS.newest(spark, root) == first


def test_numbers_are_never_taken_twice(spark, bundle, tmp_path, monkeypatch):
    root = str(tmp_path)
    VS.publish(bundle, root)
    monkeypatch.setattr(VS, "_numbers", lambda *_: [])         # a writer that has not seen the first
    assert VS.publish(bundle, root).number == 2
    monkeypatch.undo()
    assert VS._numbers(spark, root) == [2, 1]


def test_stream_takes_a_version_between_batches(spark, sf, bundle, tmp_path):
    root, data = str(tmp_path), account_view(spark, sf)
    VS.publish(bundle, root)
    for k in range(3):
        data.where(F.pmod(F.hash("Customer_ID"), F.lit(3)) == k).coalesce(1).write.mode("append").parquet(f"{root}/in")

    class Swapping(VS.CurrentBundle):
        asked = 0

        def get(self):
            Swapping.asked += 1
            if Swapping.asked == 2:
                VS.publish(dataclasses.replace(bundle, thresholds=PR.Thresholds(-1.0, float("-inf"))), root)
            return super().get()

    score_stream(account_stream(spark, f"{root}/in", files_per_trigger=1), Swapping(root), f"{root}/out", f"{root}/bad",
                 f"{root}/state").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    versions = {r.batch: r.v for r in out.groupBy("batch").agg(F.collect_set("bundle_version").alias("v")).collect()}
    assert versions == {0: [1], 1: [2], 2: [2]}
    assert out.where("bundle_version = 2 AND priority_label <> 'Immediate Save'").count() == 0
    assert out.count() + spark.read.parquet(f"{root}/bad").count() == data.count()
