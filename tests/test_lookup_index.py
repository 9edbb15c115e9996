"""Look-ups by files: same rows as a scan, few files opened."""

import pytest

from keepwell.operators import lookup as LK
from keepwell.operators.lookup_index import open_index, write_index

SCHEMA = "Customer_ID string, rank long, City string"
IDS = [f"C{k:05d}" for k in range(1000)] + ["x%_y", "Ünï-7", "ab", "ZZZ", "zzz", None, "", "c00017"]


@pytest.fixture(scope="module")
def ranked(spark):
    return spark.createDataFrame([(i, k, None) for k, i in enumerate(IDS, 1)], SCHEMA).cache()


@pytest.fixture(scope="module")
def index(spark, ranked, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lookup"))
    write_index(ranked, root, rows_per_file=100)
    return open_index(spark, root, ranked.schema)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("text", ["", " ", "7", "01", "c00017", " C0001 ", "000", "999", "%_y", "ünï", "zzz",
                                  "no such", "c00017x", "17c", "00c"])
def test_search_equals_the_scan(ranked, index, text):
    assert rows(index.search(text)) == rows(LK.search_accounts(ranked, text))


@pytest.mark.parametrize("text,row", [("c0001", 3), ("c0001", 99), ("zzz", 1), ("no such", 0)])
def test_pick_equals_the_scan(ranked, index, text, row):
    assert rows(LK.pick_hit(index.search(text), row)) == rows(LK.pick_account(ranked, text, row))


@pytest.mark.parametrize("account,hits", [("C00500", 1), (" c00017", 2), ("Zzz", 2), ("C0050", 0), ("", 1)])
def test_exact_account(index, account, hits):
    found = index.account(account)
    assert found.count() == hits and found.columns == SCHEMA.replace(" string", "").replace(" long", "").split(", ")


def test_few_files_are_opened(spark, index):
    everything = len(spark.read.parquet(f"{index.root}/accounts").inputFiles())
    assert everything >= 10
    assert len(index.account("C00500").inputFiles()) == 1
    assert len(index.search("c00500").inputFiles()) == 1
    assert len(index.search("no such").inputFiles()) == 0
    assert len(index._files("postings", spark.read.parquet(f"{index.root}/postings").schema,
                            index._parts("postings", "500")).inputFiles()) <= 2


def test_an_id_on_many_rows_goes_on_over_files(spark, tmp_path):
    many = spark.createDataFrame([("hot1", k, None) for k in range(300)] + [("cold", 300, None)], SCHEMA)
    index = write_index(many, str(tmp_path), rows_per_file=50)
    assert index.account("HOT1").count() == 300 and index.search("hot").count() == 300
    assert index.account("cold").count() == 1


def test_empty_matrix(spark, tmp_path):
    index = write_index(spark.createDataFrame([], SCHEMA), str(tmp_path))
    assert index.account("a").isEmpty() and index.search("abc").isEmpty() and index.search("").isEmpty()
