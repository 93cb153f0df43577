"""WARC archives of web pages and their merged capture index (operator 7).

``write_archives`` writes a WARC/1.1 record for every page with Spark's text writer (the blank
lines that end a record are its line separator), gzip-compressed, at most
``records`` records a file.  Of the pages with equal payloads (of at least ``least``
bytes), that with the smallest page_id is a ``response``; the others are
``revisit`` records that refer to it.  Each file holds its captures sorted by URL key and time.

``read_archives`` reads the files back: every file is parsed in one task by the lengths in the
headers, its payloads are measured and hashed again, and its captures form one sorted run.
``merge_runs`` cuts all runs at the same URL keys and times, so that each task gets a
fragment of every run, and merges the fragments with a loser tree: the partitions, one after
the other, are the globally ordered capture histories.

Defined results: a null html is an empty payload; a null URL leaves the target out and sorts
first; line breaks in URLs are percent-encoded; rows with a null page_id keep it and are
responses only where no numbered page has the payload; rows that repeat the smallest
page_id of a payload are responses too; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import materialise, partitions

_CRLF = "\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: time of page 0; page n was captured n seconds later unless the table says when
EPOCH = 1704067200
#: index rows of one merge task, about
MERGE_ROWS = 200_000


def base32(hexed: Column) -> Column:
    """Upper-case base32 of 40 hex digits."""
    letters = []
    for i in range(8):  # 20 bits: 5 hex digits, 4 letters
        bits = F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*letters)


def url_key(url: Column) -> Column:
    """Host labels reversed, then path and query; scheme, user, port and fragment go."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)),
                            r"^www[0-9]*\.", "")
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.when(url.isNull(), F.lit("")).when(host == "", url).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"),
                 F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))))


def _captures(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, html, captured, hashed, first (page_id of the response)."""
    zone = F.current_timezone()
    captured = F.to_utc_timestamp(F.timestamp_seconds(F.lit(EPOCH) + F.coalesce("page_id", F.lit(0))), zone)
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    made = pages.select("page_id", url.alias("url"), F.coalesce("html", F.lit("")).alias("html"),
                        F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"))
    made = made.withColumn("hashed", F.sha1("html"))
    # only payloads that occur again: one narrow row each
    again = (made.where(F.octet_length("html") >= least).groupBy("hashed")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return made.join(materialise(again, "again"), "hashed", "left")


def write_archives(pages: DataFrame, path: str, least: int = 0, records: int = 2000) -> None:
    """Write the WARC files of ``pages`` below ``path``."""
    rows = _captures(pages, least)
    digest = F.concat(F.lit("sha1:"), base32(F.col("hashed")))
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first")))
    block = F.when(revisit, F.lit(_HTTP)).otherwise(F.concat(F.lit(_HTTP), F.col("html")))

    def name(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))

    def line(key: str, value: Column) -> Column:
        return F.concat(F.lit(f"{key}: "), value, F.lit(_CRLF))

    empty = F.lit("")
    record = F.concat(
        F.lit("WARC/1.1" + _CRLF),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Date", F.col("captured")),
        F.coalesce(line("WARC-Target-URI", F.col("url")), empty),
        line("WARC-Payload-Digest", digest),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", name(F.col("first"))))).otherwise(empty),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_CRLF), block)
    (rows.sortWithinPartitions(url_key(F.col("url")), "captured", "page_id").select(record.alias("value"))
     .write.option("lineSep", _CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", records)
     .text(path))


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed WARC stream."""
    while True:
        version = stream.readline()
        if not version:
            return
        if version.strip() == b"":
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            key, _, value = line.decode("utf-8").partition(":")
            headers[key.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is cut short")
        yield headers, block


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "null") else int(number)


_INDEX = ("archive string, place bigint, page_id bigint, url string, captured string, record_type string, "
          "payload_bytes bigint, payload_digest string, refers_to bigint")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One index row for each record, with its archive and place in it."""
    def run(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    for place, (h, block) in enumerate(parse_records(stream)):
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        full = h["warc-type"] == "response"
                        if full and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"the payload of {h['warc-record-id']} doesn't match its digest")
                        rows.append((archive, place, _page(h["warc-record-id"]), h.get("warc-target-uri"),
                                     h["warc-date"], h["warc-type"], len(payload) if full else None, digest,
                                     _page(h.get("warc-refers-to"))))
                names = ["archive", "place", "page_id", "url", "captured", "record_type", "payload_bytes",
                         "payload_digest", "refers_to"]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(),
                         pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)] if rows
                    else [pa.array([], k) for k in kinds], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    rows = files.mapInArrow(run, _INDEX)
    index = materialise(rows.withColumn("url_key", url_key(F.col("url"))), "captures")
    # a revisit has the payload of the response with its digest
    whole = (index.where("record_type = 'response'").groupBy("payload_digest")
             .agg(F.max("payload_bytes").alias("whole")))
    revisits = (index.where("record_type = 'revisit'").join(whole, "payload_digest")
                .withColumn("payload_bytes", F.col("whole")).select(*index.columns))
    return index.where("record_type = 'response'").unionAll(revisits)


class LoserTree:
    """Merges sorted runs: every inner node keeps the loser of its match, the root the winner."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.tree = [-1] * self.k  # tree[0]: winner
        for leaf in range(self.k):
            self._enter(leaf)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x, a) <= (y, b)

    def _enter(self, leaf: int) -> None:
        """First round: wait at the first empty node, or play on from a taken one."""
        node, winner = (leaf + self.k) // 2, leaf
        while node:
            if self.tree[node] < 0:
                self.tree[node] = winner
                return
            if not self._beats(winner, self.tree[node]):
                winner, self.tree[node] = self.tree[node], winner
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        while self.heads[leaf := self.tree[0]] is not None:
            yield self.heads[leaf]
            self.heads[leaf] = next(self.runs[leaf], None)
            node, winner = (leaf + self.k) // 2, leaf
            while node:
                if not self._beats(winner, self.tree[node]):
                    winner, self.tree[node] = self.tree[node], winner
                node //= 2
            self.tree[0] = winner


_ORDER = ["url_key", "captured", "page_id"]


def merge_runs(index: DataFrame) -> DataFrame:
    """All captures in the order of URL key, time and page_id: partition after partition, row after row."""
    spark = index.sparkSession
    index = materialise(index, "runs")  # range bounds are sampled: the rows must stay as they are
    n = max(partitions(spark), 1 + index.count() // MERGE_ROWS)
    names = index.columns
    cut = index.repartitionByRange(n, *_ORDER)

    def run(batches):
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.concat_tables(tables).combine_chunks()
        by_run: dict[str, list[int]] = {}
        for i, archive in enumerate(table["archive"].to_pylist()):
            by_run.setdefault(archive, []).append(i)
        place = table["place"].to_pylist()
        keys = [(a, b, c is not None, c or 0) for a, b, c in zip(*(table[c].to_pylist() for c in _ORDER))]
        runs = []
        for archive in sorted(by_run):  # a fragment arrives in pieces; its places are the run's order
            rows = sorted(by_run[archive], key=place.__getitem__)
            runs.append(((keys[i], i) for i in rows))
        order = [i for _, i in LoserTree(runs)]
        yield from table.take(pa.array(order, pa.int64())).combine_chunks().to_batches()

    return cut.mapInArrow(run, index.schema).select(*names)


def capture_histories(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back and merge their indexes."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, least)
    return merge_runs(read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


WARC_SQL = """
WITH p AS (
  SELECT page_id, url, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS hashed FROM pages),
f AS (SELECT hashed, MIN(page_id) AS first_page FROM p GROUP BY hashed),
u AS (
  SELECT p.*, f.first_page,
    regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www[0-9]*\\.', '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS rest
  FROM p JOIN f USING (hashed))
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hashed, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to,
  CASE WHEN url IS NULL THEN '' WHEN host = '' THEN url ELSE
    array_to_string(list_reverse(string_split(host, '.')), ',') || ')' ||
    CASE WHEN starts_with(rest, '/') THEN rest ELSE '/' || rest END END AS url_key,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM u"""
