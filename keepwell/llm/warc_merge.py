"""WARC archives and their merged capture index.

Writing: every page is a WARC/1.1 record of its own. Payloads of ``least_bytes``
or more that are equal are stored once, by the largest page id (response); the
other pages of the group are revisit records that refer to it. The archives are
written by Spark's text writer, whose separator is the blank lines that end a
record, so any store Spark writes to will do and a lost task is written again.

Reading: every archive is parsed by its lengths and becomes one capture run,
sorted by URL key, time and page. Runs are dealt by key range, and the slices of
one range are merged by a loser tree: a k-way merge with log k comparisons for a
row, however many runs there are. The merged ranges in order are the capture
histories. No task sees more than one archive or one key range.

Nulls: a null html is an empty payload, a null url an empty URL key, a null
page_id a record without a number (never referred to). Rows that share a page id
and payload count as the same page. Equal keys and times are ordered by page,
then archive. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keepwell.llm.sides import checked
from keepwell.session import checkpoint_dir, materialise, shuffle_partitions

LEAST_BYTES = 1_000
RECORDS_PER_ARCHIVE = 2_000
FIRST_CAPTURE = "2024-01-01 00:00:00"
#: Seconds from there to the first and the last whole day of the years 1 to 9999.
MOMENTS = (-738_885 * 86_400, 2_913_173 * 86_400)
# --- fixed values of the format ---
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"
# --- end of fixed values ---
RECORD_NAME = "urn:x-page:"

INDEX = ("page_id long, url_key string, captured_at string, archive string, record long, offset long, "
         "payload_bytes long, payload_digest string, record_type string, refers_to long")


def classify(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
             least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to): only
    digests that occur twice are joined, and the payloads are shuffled only
    where that table is too large to broadcast."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("payload_digest"))
    stored = materialise(
        rows.where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("payload_digest").agg(F.max("page_id").alias("_stored"), F.min("page_id").alias("_least"))
        .where("_least < _stored").select("payload_digest", "_stored"))
    joined = rows.join(checked(stored), "payload_digest", "left")
    refers = F.when(F.col("page_id") != F.col("_stored"), F.col("_stored"))
    return joined.withColumn("refers_to", refers).drop("_stored")


def record_text(captured_at: Column) -> Column:
    """A record without the blank lines that end it."""
    def line(name: str, *value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), *value, F.lit(END))

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
        line("Content-Length", F.col("payload_bytes").cast("string")), F.lit(END))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    name = F.concat(F.lit(f"<{RECORD_NAME}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    return F.concat(
        F.lit(f"{VERSION}{END}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name),
        line("WARC-Date", captured_at),
        line("WARC-Target-URI", F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        line("WARC-Payload-Digest", F.lit("sha1:"), F.col("payload_digest")),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit(PROFILE)),
            line("WARC-Refers-To", F.lit(f"<{RECORD_NAME}"), F.col("refers_to").cast("string"), F.lit(">")),
        )).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(body).cast("string")), F.lit(END), body)


def write_archives(classified: DataFrame, path: str) -> None:
    """Archives of at most ``RECORDS_PER_ARCHIVE`` records below ``path``. Pages
    carry no time of capture; they were captured a second apart by page id, those
    with ids beyond the years 1 to 9999 at the ends of that span."""
    start = F.lit(FIRST_CAPTURE).cast("timestamp_ntz")
    seconds = F.greatest(F.least(F.coalesce("page_id", F.lit(0)), F.lit(MOMENTS[1])), F.lit(MOMENTS[0]))
    moment = F.dateadd(F.to_date(start), F.floor(seconds / 86_400).cast("int"))
    second = F.pmod(seconds, F.lit(86_400))
    clock = F.concat_ws(":", *[F.lpad(F.pmod(F.floor(second / unit), F.lit(size)).cast("string"), 2, "0")
                               for unit, size in ((3_600, 24), (60, 60), (1, 60))])
    captured = F.concat(moment.cast("string"), F.lit("T"), clock, F.lit("Z"))
    classified.select(record_text(captured).alias("value")).write.option("lineSep", END + END).option(
        "compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path)


def records(file) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, content) of every record of an open archive."""
    offset = 0
    while first := file.readline():
        begin, offset = offset, offset + len(first)
        if first.rstrip() != VERSION.encode():
            raise ValueError(f"no record starts at {begin}")
        fields = {}
        while (line := file.readline()).rstrip():
            offset += len(line)
            name, _, value = line.decode().rstrip(END).partition(": ")
            fields[name] = value
        content = file.read(int(fields["Content-Length"]))
        file.readline(), file.readline()
        offset += len(line) + len(content) + 2 * len(END)
        yield begin, fields, content


def url_key(url: str) -> str:
    """The sort key of a URL: host reversed and lower-case, then the rest."""
    rest = url.partition("#")[0].partition("://")[2] or url.partition("#")[0]
    host, slash, path = rest.partition("/")
    host = host.lower().removeprefix("www.").removesuffix(":80").removesuffix(":443")
    return ",".join(reversed(host.split("."))) + ")" + (slash + path or "/")


def _page(name: str | None) -> int | None:
    number = (name or "").strip("<>").removeprefix(RECORD_NAME)
    return int(number) if number else None


def capture_run(archive: str, content: bytes) -> list[tuple]:
    """The index rows of one archive, sorted; digests and sizes of responses
    are taken anew from the payload read, those of revisits from their fields."""
    found = []
    for k, (offset, fields, body) in enumerate(records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))))):
        head, _, payload = body.partition(b"\r\n\r\n")
        kind = fields["WARC-Type"]
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        size = int(head.rpartition(b"Content-Length: ")[2].split()[0])
        if kind == "response":
            if (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, size):
                raise ValueError(f"record {k} of {archive} is damaged")
        found.append((_page(fields["WARC-Record-ID"]), url_key(fields["WARC-Target-URI"]),
                      fields["WARC-Date"], archive, k, offset, size, digest, kind,
                      _page(fields.get("WARC-Refers-To"))))
    return sorted(found, key=_order)


def _order(row: tuple) -> tuple:
    return row[1], row[2], -1 if row[0] is None else row[0], row[3], row[4]


class LoserTree:
    """Merges sorted runs: each inner node holds the loser of the match played
    there, so the next row costs one match per level."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads: list[tuple | None] = [next(r, None) for r in runs]
        self.keys = [None if h is None else _order(h) for h in self.heads]
        size = 1
        while size < max(1, len(runs)):
            size *= 2
        self.size = size
        self.loser = [-1] * size
        winner = [*[-1] * size, *[k if k < len(runs) else -1 for k in range(size)]]
        for node in range(size - 1, 0, -1):
            winner[node], self.loser[node] = self._match(winner[2 * node], winner[2 * node + 1])
        self.winner = winner[1]

    def _match(self, a: int, b: int) -> tuple[int, int]:
        if a < 0 or self.keys[a] is None:
            return b, a
        if b < 0 or self.keys[b] is None or self.keys[a] <= self.keys[b]:
            return a, b
        return b, a

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.heads[self.winner] is not None:
            at = self.winner
            yield self.heads[at]
            self.heads[at] = head = next(self.runs[at], None)
            self.keys[at] = None if head is None else _order(head)
            node = (at + self.size) // 2
            while node:
                at, self.loser[node] = self._match(at, self.loser[node])
                node //= 2
            self.winner = at


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The sorted runs of all archives below ``path``; ``place`` is the place in
    the run."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                run = capture_run(name.as_py().rpartition("/")[2], content.as_py())
                yield _batch([(*row, k) for k, row in enumerate(run)], place=True)

    return files.mapInArrow(parse, INDEX + ", place long")


def _batch(rows: list[tuple], place: bool) -> pa.RecordBatch:
    kinds = [(c.split()[0], pa.string() if c.split()[1] == "string" else pa.int64()) for c in INDEX.split(", ")]
    schema = pa.schema(kinds + [("place", pa.int64())] * place)
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def merge_runs(runs: DataFrame) -> DataFrame:
    """The rows of all runs in one global order with their ``position`` in it."""
    key = ["url_key", "captured_at", "page_id", "archive", "record"]
    dealt = runs.repartitionByRange(shuffle_partitions(runs.sparkSession), *key)
    slices = dealt.sortWithinPartitions("archive", "place").drop("place")

    def merge(batches):
        held: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                held.setdefault(row[3], []).append(row)
        out = []
        for row in LoserTree([iter(rows) for rows in held.values()]):
            out.append(row)
            if len(out) == 10_000:
                yield _batch(out, place=False)
                out = []
        if out:
            yield _batch(out, place=False)

    merged = materialise(slices.mapInArrow(merge, INDEX).withColumn("_row", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_row", 33), F.col("_row").bitwiseAND((1 << 33) - 1)
    sizes = merged.groupBy(part.alias("_range")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return merged.join(F.broadcast(starts), part == F.col("_range")).withColumn(
        "position", F.col("_before") + inside).drop("_row", "_range", "_before", "_n")


def archive_pages(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Writes ``pages`` as archives below ``path`` (a new folder in the shared
    checkpoint folder if none is given) and returns the merged index of what was
    read back."""
    spark = pages.sparkSession
    path = path or f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(classify(pages, **columns), path)
    return merge_runs(read_runs(spark, path))
