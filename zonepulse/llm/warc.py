"""Web archives: writing WARC records with revisits, reading them back, and merging their index.

Archives are written by Spark's text sink: a record is one text value and the two line ends
that close a record are the separator, so the files are plain WARC on any store that Spark can
write to. Each file read back gives a run of captures sorted by URL key and time. Runs are
dealt by ranges of that order and merged in each range by a loser tree, which gives one
globally ordered capture history.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonepulse.llm.common import table
from zonepulse.session import scratch_path, stash

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
RECORDS_PER_FILE = 2_000
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = (
    "urlkey string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, archive string, offset long, length long"
)


def base32_sha1(col: Column) -> Column:
    """Upper-case base32 of a SHA-1: each five hex digits are four letters of five bits."""
    digest, parts = F.sha1(col), []
    for n in range(8):
        value = F.conv(F.substring(digest, 5 * n + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            parts.append(F.substring(F.lit(ALPHABET), F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*parts)


def with_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages (page_id, url, captured, body) with size, digest and the record that holds their payload.

    Of equal payloads of at least `min_bytes` the smallest page_id holds it. The firsts are
    found on digests alone and stored; payloads move once, to meet them, and a digest that very
    many pages share is split by the join.
    """
    sized = pages.withColumns(
        {"payload_bytes": F.octet_length("body").cast("long"), "payload_digest": base32_sha1(F.col("body").cast("binary"))}
    )
    firsts = stash(sized.groupBy("payload_digest").agg(F.min("page_id").alias("first_id")), "firsts")
    own = (F.col("page_id") == F.col("first_id")) | F.col("page_id").isNull() | (F.col("payload_bytes") < min_bytes)
    return sized.join(firsts, "payload_digest").withColumn("refers_to", F.when(~own, F.col("first_id")))


def record(min_bytes: int = 0) -> Column:
    """The text of a WARC record, without the two line ends that close it."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END),
    )
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    url = F.regexp_replace(F.coalesce("url", F.lit("urn:page:none")), r"[\s\x00-\x1f]", "%20")
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("body")))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Date: "), F.col("captured")),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(END), block)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Writes one record per row of pages (page_id, url, captured, body).

    A null body is an empty payload; a null page_id is kept as a record of its own; repeated
    rows are repeated records, all responses if they hold the smallest id of their payload.
    Files are compressed by gzip; offsets count bytes of the archive inside.
    """
    pages = pages.select("page_id", "url", "captured", F.coalesce("body", F.lit("")).alias("body"))
    records = with_records(pages, min_bytes).select(record().alias("value"))
    records.write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)


def url_key(url: str) -> str:
    """Sortable key: reversed host, then path and query, in lower case."""
    found = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)", url)
    if not found:
        return url.lower()
    host = ",".join(reversed(re.sub(r"^www\d*\.", "", found[1].lower()).split(".")))
    return f"{host}){found[2].lower() or '/'}"


def _page(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value not in ("", "none") else None


def parse(archive: str, data: bytes) -> Iterator[tuple]:
    """Captures of one archive file; a response whose payload differs from its digest is an error."""
    at = 0
    while at < len(data):
        split = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:split].decode().split("\r\n")[1:])
        start = split + 4
        end = start + int(head["Content-Length"])
        body = data.index(b"\r\n\r\n", start) + 4
        http = data[start:body].decode().split("\r\nContent-Length: ")[1]
        size, digest = int(http.split("\r\n")[0]), head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response":
            found = base64.b32encode(hashlib.sha1(data[body:end]).digest()).decode()
            if found != digest or end - body != size:
                raise ValueError(f"{archive}, offset {at}: payload does not match its record")
        yield (
            url_key(head["WARC-Target-URI"]), head["WARC-Date"], _page(head["WARC-Record-ID"]), size, digest,
            head["WARC-Type"], _page(head.get("WARC-Refers-To")), archive, at, end + 4 - at,
        )
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"{archive}, offset {at}: record is not closed")
        at = end + 4


def _order(row: tuple) -> tuple:
    return row[0], row[1], -1 if row[2] is None else row[2], row[7], row[8]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in CAPTURE.split(", ")])
    return frame.astype({c: "Int64" for c in ("page_id", "refers_to")})


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archives in a folder; those of one file are one sorted run."""

    def runs(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["path"], batch["content"]):
                name = archive.rsplit("/", 1)[-1].removesuffix(".gz")
                yield _frame(sorted(parse(name, gzip.decompress(content)), key=_order))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInPandas(runs, CAPTURE)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(run) for run in runs]
        self.heads = [self._next(n) for n in range(len(runs))]
        self.losers = [0] * max(1, len(runs))
        self.losers[0] = self._build(1) if len(runs) > 1 else 0

    def _next(self, n: int) -> tuple | None:
        row = next(self.runs[n], None)
        return None if row is None else (_order(row), row)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x[0] <= y[0])

    def _build(self, node: int) -> int:
        if node >= len(self.runs):
            return node - len(self.runs)
        a, b = self._build(2 * node), self._build(2 * node + 1)
        winner, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return winner

    def __iter__(self) -> Iterator[tuple]:
        while self.heads and self.heads[winner := self.losers[0]] is not None:
            yield self.heads[winner][1]
            self.heads[winner] = self._next(winner)
            node = (winner + len(self.runs)) // 2
            while node >= 1:
                if not self._beats(winner, self.losers[node]):
                    winner, self.losers[node] = self.losers[node], winner
                node //= 2
            self.losers[0] = winner


def merge_runs(runs: DataFrame) -> DataFrame:
    """One capture history in global order of URL key, time and page: (part, place) is that order.

    Ranges are cut on the whole order, so one URL with very many captures is spread. A range
    holds a slice of each run. Slices are kept apart by run and merged; a slice that the
    shuffle has handed over out of order is sorted first.
    """

    def merge(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices: dict[str, list[tuple]] = {}
        part = None
        for batch in batches:
            part = batch.pop("part").iloc[0] if len(batch) else part
            for row in batch.astype(object).where(batch.notna(), None).itertuples(index=False, name=None):
                slices.setdefault(row[7], []).append(row)
        for run in slices.values():
            if any(_order(x) > _order(y) for x, y in zip(run, run[1:])):
                run.sort(key=_order)
        rows = []
        for place, row in enumerate(LoserTree(list(slices.values()))):
            rows.append((*row, part, place))
            if len(rows) == 20_000:
                yield _placed(rows)
                rows = []
        if rows:
            yield _placed(rows)

    by = ["urlkey", "captured", "page_id", "archive", "offset"]
    dealt = runs.repartitionByRange(*by).withColumn("part", F.spark_partition_id())
    return dealt.mapInPandas(merge, f"{CAPTURE}, part int, place long")


def _placed(rows: list[tuple]) -> pd.DataFrame:
    frame = _frame([r[:-2] for r in rows])
    return frame.assign(part=[r[-2] for r in rows], place=[r[-1] for r in rows])


def op3_warc_index_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Pages have no capture time; a fixed start plus page_id seconds stands for it."""
    captured = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    pages = table(spark, folder, "pages").select("page_id", "url", captured.alias("captured"), F.col("html").alias("body"))
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    history = merge_runs(stash(read_runs(spark, path), "runs"))
    return history.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured",
    )


SQL = {
    "op3_warc_index_merge": f"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, url, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(body) AS digest FROM p
), b AS (
  SELECT *, list_reduce(list_transform(range(0, 8), lambda i: list_reduce(list_transform([15, 10, 5, 0], lambda s:
      substr('{ALPHABET}', 1 + (((('0x' || substr(digest, 5 * i::BIGINT + 1, 5))::BIGINT >> s) & 31))::BIGINT, 1)), lambda x, y: x || y)),
      lambda x, y: x || y) AS payload_digest
  FROM d
), f AS (SELECT payload_digest, min(page_id) AS first_id FROM b GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
  array_to_string(list_reverse(string_split(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1)), '^www[0-9]*\\.', ''), '.')), ',')
    || ')' || coalesce(nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#:]*(?::[0-9]+)?([^#]*)', 1)), ''), '/') AS urlkey,
  strftime(make_timestamp((1700000000 + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM b JOIN f USING (payload_digest)""",
}
