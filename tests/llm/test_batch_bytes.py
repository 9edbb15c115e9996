"""The suffix-array query hands texts to Python in batches of bounded size."""

import pyarrow as pa

from keepwell.llm.queries import BATCH_BYTES, op11_lyndon_suffix_groups

_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_suffix_query_bounds_its_batches(spark, tmp_path):
    rows = [(k, chr(97 + k % 26) * 100_000) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.unset(_SETTING)
    try:
        found = op11_lyndon_suffix_groups(spark, str(tmp_path)).collect()
        sizes = docs.mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"]) for b in batches),
            "size long").collect()
    finally:
        spark.conf.unset(_SETTING)
    assert sum(r["size"] for r in sizes) > 20_000_000
    assert all(r["size"] <= BATCH_BYTES + 200_000 for r in sizes)
    assert len(found) == 200 and all(r["n_removed"] == 100_000 for r in found)
