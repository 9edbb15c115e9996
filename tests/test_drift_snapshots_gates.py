"""Contract drift, results kept until files change, gates in the write job."""

import os
import time

import pytest
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.operators import drift as D
from keepwell.operators import gates as G
from keepwell.operators import validate as V
from keepwell.plans import fitted
from keepwell.plans import pipeline as PL
from keepwell.sources import snapshots as S
from keepwell.sources import tables as T
from keepwell.sources.star_schema import SOURCE_TABLES


def kinds(found):
    return {(d.column, d.drift) for d in found}


def test_no_drift_runs_no_job(spark, table):
    df = table()
    assert D.differences(df, D.account_reader()) == []
    assert D.drift_table(df, [D.account_reader()]).count() == 0


def test_every_kind_of_drift(spark):
    reader = D.Reader("model", ("a", "b", "c", "d"), frozenset("abcd"))
    df = spark.createDataFrame([("1", 2, "x", 1.0), (None, 2, "y", None)], "c string, a int, extra string, b double")
    assert kinds(D.differences(df, reader)) == {
        ("d", D.MISSING), ("extra", D.UNEXPECTED), ("c", D.NO_NUMBER), ("c", D.MOVED)}
    loose = D.Reader("model", reader.columns, reader.numbers, exact=False)
    assert kinds(D.differences(df, loose)) == {("d", D.MISSING), ("c", D.NO_NUMBER)}
    assert kinds(D.differences(df, loose, texts_are_typed=False)) == {("d", D.MISSING)}
    rows = {(r.column, r.drift): (r["values"], r.unusable) for r in D.drift_table(df, [reader]).collect()}
    assert rows[("c", D.NO_NUMBER)] == (1, 0) and rows[("extra", D.UNEXPECTED)] == (2, 0)
    assert rows[("d", D.MISSING)] == (0, 0)


@pytest.mark.parametrize("places,moved", [([0, 1, 2], 0), ([2, 0, 1], 1), ([3, 2, 1, 0], 3), ([], 0), ([1, 0, 3, 2], 2)])
def test_fewest_columns_count_as_moved(places, moved):
    rest = [p for i, p in enumerate(places) if i not in D._out_of_order(places)]
    assert len(places) - len(rest) == moved and rest == sorted(rest)


def test_class_presence(spark):
    df = spark.createDataFrame([(1,), (1,), (7,), (None,)], "label int")
    rows = {r["class"]: (r.expected, r.members, r.present) for r in D.class_presence(df).collect()}
    assert rows == {"0": (True, 0, False), "1": (True, 2, True), "7": (False, 1, True), None: (False, 1, True)}


def test_cached_table_follows_the_files(spark, tmp_path):
    root = str(tmp_path)
    T.write_table(spark.range(3), root, "t")
    first = S.cached_table(spark, root, "t")
    assert S.cached_table(spark, root, "t") is first and first.is_cached
    T.write_table(spark.range(5), root, "t")
    second = S.cached_table(spark, root, "t")
    assert (second.count(), second.is_cached, first.is_cached) == (5, True, False)
    assert S.fingerprint(spark, [f"{root}/none"]) == S.fingerprint(spark, [f"{root}/none"])


def test_a_touched_file_is_another_snapshot(spark, tmp_path):
    (tmp_path / "a.parquet").write_text("x")
    (tmp_path / "_SUCCESS").write_text("")
    before = S.fingerprint(spark, [str(tmp_path)])
    (tmp_path / "_SUCCESS").write_text("changed")
    assert S.fingerprint(spark, [str(tmp_path)]) == before
    os.utime(tmp_path / "a.parquet", (time.time(), time.time() + 10))
    assert S.fingerprint(spark, [str(tmp_path)]) != before


def test_changed_data_is_fitted_again(spark, sf, tmp_path):
    for t in SOURCE_TABLES:
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    before = fitted.segments(spark, str(tmp_path))
    assert fitted.segments(spark, str(tmp_path)) is before
    few = spark.read.parquet(f"{sf}/customer.parquet").where("c_custkey % 2 = 0")
    few.write.mode("overwrite").parquet(f"{tmp_path}/customer.parquet")
    after = fitted.segments(spark, str(tmp_path))
    assert after is not before and after.centroids != before.centroids
    assert fitted.features(spark, str(tmp_path)).count() == few.count()


def test_gates_are_counted_by_the_write(spark, tmp_path):
    root = str(tmp_path)
    good = spark.range(10).select("id", F.col("id").cast("double").alias("x"))
    gates = G.rows_gate(10) | G.blanks_gate(good) | G.finite_gates(["x"])
    assert G.write_gated(good, root, "t", gates).count() == 10
    bad = good.withColumn("x", F.when(F.col("id") > 2, F.col("x")))
    with pytest.raises(V.AccountTableError, match="blanks"):
        G.write_gated(bad, root, "t", G.rows_gate(10) | G.blanks_gate(bad) | G.finite_gates(["x"]))
    assert spark.read.parquet(f"{root}/t").where("x IS NULL").count() == 0      # the former table stays
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    with pytest.raises(V.AccountTableError, match="row_count"):
        G.write_gated(good.limit(0), root, "u", G.rows_gate(None))
    counts = G.write_counted(bad.repartition(3), root, G.blanks_gate(bad) | G.finite_gates(["x"])).counts
    assert counts == {"blanks": 3, "x_not_finite": 3}


def test_feature_stage_reads_the_raw_file_once(spark, table, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch
    rows = table(*[{} for _ in range(4)])
    raw = rows.mapInArrow(count, rows.schema)
    assert PL.features_stage(raw, str(tmp_path), expected_rows=4).count() == 4 and reads.value == 4


@pytest.mark.parametrize("change,message", [
    ({"Age": None}, "unexpected_blank"), ({"Contract": "Weekly"}, "vocabulary"), ({"Customer_ID": "A0"}, "duplicate_id"),
    ({"Tenure_in_Months": 0}, "blanks left")])
def test_feature_stage_keeps_the_former_table(spark, table, tmp_path, change, message):
    root = str(tmp_path)
    PL.features_stage(table({}, {}), root)
    with pytest.raises(V.AccountTableError, match=message):
        PL.features_stage(table({}, change), root)
    assert T.read_table(spark, root, "features").count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["features"]
    with pytest.raises(V.AccountTableError, match="row_count"):
        PL.features_stage(table({}), root, expected_rows=7)
    with pytest.raises(V.AccountTableError, match="missing_column"):
        PL.features_stage(table({}).drop("Offer"), root)
    assert C.FEATURE_COLUMNS == tuple(T.read_table(spark, root, "features").columns)


def test_models_work_in_a_session_that_wrote_with_gates(spark, sf, tmp_path):
    f = fitted.features(spark, sf)
    G.write_gated(f.select(C.ID), str(tmp_path), "t", G.rows_gate(None))
    assert fitted.segments(spark, sf).assign(f).groupBy("cluster").count().count() == 4
    assert spark.conf.get("spark.sql.shuffle.partitions") == G.observable(f).sparkSession.conf.get("spark.sql.shuffle.partitions")
