"""Account look-ups that read few files of a large matrix.

``write_index`` stores three tables below a folder, each in files of about
``rows_per_file`` rows cut by a range sort, so a key shared by many rows goes on
over as many files as it needs:

* ``accounts``: the matrix by lower-case id, with a Parquet bloom filter on it;
* ``postings``: (trigram, id) for every run of three characters of an id;
* ``counts``: how many ids hold each trigram.

``ranges`` of the first two have one row per file: its least and greatest key. A
search asks them which files may hold its key and opens these by name; the other
files are neither listed nor read.

Ids are searched without case. A row with a null id is found by blank text alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keepwell import contract as C

ROWS_PER_FILE = 1_000_000
#: Added to the stored rows; the first is what files are cut by.
KEY, PART = "_id_key", "_part"
GRAM = 3


@dataclass(frozen=True)
class LookupIndex:
    spark: SparkSession
    root: str
    schema: StructType          # of the matrix

    def _stored(self) -> StructType:
        return StructType([*self.schema.fields]).add(KEY, "string").add(PART, "integer")

    def _files(self, name: str, schema: StructType, parts: list[int]) -> DataFrame:
        """The named files of a table, and no others."""
        if not parts:
            return self.spark.createDataFrame([], schema)
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).option("basePath", path).parquet(
            *[f"{path}/{PART}={p}" for p in sorted(parts)])

    def _parts(self, name: str, key: str) -> list[int]:
        """Files of a table whose range holds ``key``."""
        ranges = self.spark.read.schema("least string, greatest string, part int").parquet(
            f"{self.root}/{name}-ranges")
        return [r.part for r in ranges.where(F.lit(key).between(F.col("least"), F.col("greatest"))).collect()]

    def account(self, account: str) -> DataFrame:
        """Rows of one id. The bloom filter spares row groups of the file."""
        key = account.strip().lower()
        rows = self._files("accounts", self._stored(), self._parts("accounts", key))
        return rows.where(F.col(KEY) == key).select(*self.schema.names)

    def search(self, text: str) -> DataFrame:
        """Literal substring of the id. The rarest trigram of the text names the
        ids that may hold it; text of one or two characters has none and is looked
        for in all rows, blank text finds all."""
        needle = text.strip().lower()
        stored = self._stored()
        grams = {needle[k:k + GRAM] for k in range(len(needle) - GRAM + 1)}
        if not grams:
            rows = self.spark.read.schema(stored).parquet(f"{self.root}/accounts")
            rows = rows.where(F.contains(KEY, F.lit(needle))) if needle else rows
            return rows.select(*self.schema.names)
        return self._files("accounts", stored, self._parts_with(needle, grams)).where(
            F.contains(KEY, F.lit(needle))).select(*self.schema.names)

    def _parts_with(self, needle: str, grams: set[str]) -> list[int]:
        """Account files with a hit: one number per file at most."""
        counts = {r.gram: r.ids for r in self.spark.read.schema("gram string, ids long").parquet(
            f"{self.root}/counts").where(F.col("gram").isin(*sorted(grams))).collect()}
        if len(counts) < len(grams):
            return []           # a trigram no id holds
        gram = min(grams, key=lambda g: (counts[g], g))
        schema = StructType().add("gram", "string").add("id", "string").add("at", "integer").add(PART, "integer")
        postings = self._files("postings", schema, self._parts("postings", gram))
        hits = postings.where((F.col("gram") == gram) & F.contains("id", F.lit(needle)))
        return [r["at"] for r in hits.select("at").distinct().collect()]


def _grams(key: Column) -> Column:
    """Distinct trigrams of a text; none of a null or shorter one."""
    last = F.length(key) - (GRAM - 1)
    runs = F.transform(F.sequence(F.lit(1), last), lambda k: F.substr(key, k, F.lit(GRAM)))
    return F.when(last >= 1, F.array_distinct(runs))


def _write_ranges(df: DataFrame, path: str, key: str, *more: str, rows_per_file: int, bloom: bool = False) -> None:
    """``df`` in range order, one folder per range, and its table of ranges. The
    number is stored with the rows, so it is the same for whoever reads them."""
    files = max(1, -(-df.count() // rows_per_file))
    ordered = df.repartitionByRange(files, key, *more).sortWithinPartitions(key, *more)
    writer = ordered.withColumn(PART, F.spark_partition_id()).write.mode("overwrite").partitionBy(PART)
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(path)
    # An empty table has no folder to take the columns from, so they are named.
    stored = df.sparkSession.read.schema(StructType([*df.schema.fields]).add(PART, "integer")).parquet(path)
    stored.groupBy(F.col(PART).alias("part")).agg(
        F.min(key).alias("least"), F.max(key).alias("greatest")).select(
        "least", "greatest", "part").coalesce(1).write.mode("overwrite").parquet(f"{path}-ranges")


def write_index(matrix: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> LookupIndex:
    """Stores ``matrix`` for look-ups; :func:`open_index` finds it again."""
    root = root.rstrip("/")
    _write_ranges(matrix.withColumn(KEY, F.lower(F.col(C.ID))), f"{root}/accounts", KEY,
                  rows_per_file=rows_per_file, bloom=True)
    index = open_index(matrix.sparkSession, root, matrix.schema)
    stored = matrix.sparkSession.read.schema(index._stored()).parquet(f"{root}/accounts")
    postings = stored.select(F.col(KEY).alias("id"), F.col(PART).alias("at"), F.explode(
        _grams(F.col(KEY))).alias("gram")).select("gram", "id", "at")
    _write_ranges(postings, f"{root}/postings", "gram", "id", rows_per_file=rows_per_file)
    matrix.sparkSession.read.schema(postings.schema).parquet(f"{root}/postings").groupBy("gram").agg(
        F.count("*").alias("ids")).write.mode("overwrite").parquet(f"{root}/counts")
    return index


def open_index(spark: SparkSession, root: str, schema: StructType) -> LookupIndex:
    return LookupIndex(spark, root.rstrip("/"), schema)
