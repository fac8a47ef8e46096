"""WARC archives: writing captures and assembling them again.

``write_archives`` turns every page into three records of one transaction,
response (or revisit), request and metadata, the latter two tied to the first by
WARC-Concurrent-To. The records are text that Spark's own text sink writes into
compressed archives, one or more a partition, of ARCHIVE_RECORDS records at most. Equal payloads of at least MIN_REVISIT bytes are
stored once: the smallest page_id is the response, the others are revisits that
refer to its record.

``read_records`` parses archives by Content-Length in Arrow batches, so payloads
may hold anything, line ends and record headers included; bytes of headers that aren't UTF-8 are
replaced, a record without type or length fails. ``assemble`` brings
the records of a transaction together by their concurrent-to identifiers, one
aggregate with map-side combine, and emits one nested row per capture.

Scale: payloads are shuffled once to lay out archives; the duplicate decision
works on (digest, page_id) with a partial aggregate, so a payload shared by a
third of all pages costs one row a task. No group is collected.

Defined cases: null html is an empty payload, a null url has no target header,
line ends in urls are percent-encoded; a null page_id is never the smallest;
rows that repeat both page_id and payload are numbered, each is a capture, and
if theirs is the smallest page_id all of them are responses; an empty table
gives no captures; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm import text as T
from tunelake.session import scratch_path

MIN_REVISIT = 100
ARCHIVE_RECORDS = 6_000  # of one archive at most: a reader holds one archive, so this and the pages' sizes bound it
DATE = "2000-01-01T00:00:00Z"  # the pages have no capture time
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record(kind: Column, rid: Column, block: Column, *fields: tuple[str, Column]) -> Column:
    """One record without the two line ends that close it; fields with a null value are left out."""
    head = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: <"), rid, F.lit(">")),
            F.lit(f"WARC-Date: {DATE}")]
    head += [F.concat(F.lit(f"{n}: "), v) for n, v in fields]
    head += [F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *head), F.lit(CRLF + CRLF), block)


def captures(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, digest, bytes, n (among equal rows) and first (the response's page_id, for revisits)."""
    df = T.as_row(pages)
    html = F.coalesce("_row.html", F.lit(""))
    df = df.select(F.col("_row.page_id").alias("page_id"), F.col("_row.url").alias("url"), html.alias("html"),
                   F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))
    large = df.where(F.col("bytes") >= min_revisit).select("page_id", "digest")
    first = large.groupBy("digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")) \
        .where(F.col("_n") > 1).select("digest", "_first")
    # digests of a group of copies meet their group's one row; AQE splits a hot digest
    revisits = large.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("_first"))).distinct()
    # a key without nulls, so that the join and the numbering below share one shuffle of payloads
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    r = revisits.select(page.alias("_page"), "digest", "_first")
    df = df.withColumn("_page", page).join(r, ["_page", "digest"], "left")
    same = Window.partitionBy("_page", "digest").orderBy("url")
    return df.select("page_id", "url", "html", "digest", "bytes", F.col("_first").alias("first"),
                     F.row_number().over(same).alias("n"))


def _uri(page: Column, digest: Column, n: Column) -> Column:
    return F.concat(F.lit("urn:capture:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"),
                    F.substring(digest, 1, 16), F.lit(":"), n.cast("string"))


def records(caps: DataFrame) -> DataFrame:
    """Column ``value``: the three records of every capture, side by side."""
    rid = _uri(F.col("page_id"), F.col("digest"), F.col("n"))
    again = F.col("first").isNotNull()
    target = ("WARC-Target-URI", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"))
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}")
    only = lambda c: F.when(again, c)
    answer = _record(
        F.when(again, "revisit").otherwise("response"), rid, F.when(again, http).otherwise(F.concat(http, F.col("html"))),
        target, ("Content-Type", F.lit("application/http; msgtype=response")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Profile", only(F.lit(PROFILE))),
        ("WARC-Refers-To", only(F.concat(F.lit("<"), _uri(F.col("first"), F.col("digest"), F.lit(1)), F.lit(">")))))
    tie = ("WARC-Concurrent-To", F.concat(F.lit("<"), rid, F.lit(">")))
    line = F.concat(F.lit("GET "), F.coalesce(target[1], F.lit("/")), F.lit(f" HTTP/1.1{CRLF}{CRLF}"))
    request = _record(F.lit("request"), F.concat(rid, F.lit(":request")), line, tie, target,
                      ("Content-Type", F.lit("application/http; msgtype=request")))
    told = F.concat_ws(CRLF, F.concat(F.lit("page-id: "), F.col("page_id").cast("string")),
                       F.concat(F.lit("payload-bytes: "), F.col("bytes").cast("string")),
                       F.concat(F.lit("refers-to-page: "), F.col("first").cast("string")), F.lit(""))
    metadata = _record(F.lit("metadata"), F.concat(rid, F.lit(":metadata")), told, tie, target,
                       ("Content-Type", F.lit("application/warc-fields")))
    return caps.select(F.explode(F.array(answer, request, metadata)).alias("value"))


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    records(captures(pages, min_revisit)).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option(
        "maxRecordsPerFile", ARCHIVE_RECORDS).text(path)


RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
          "content_type string, payload_header string, payload binary, payload_bytes long, payload_digest string, "
          "fields map<string,string>")


def parse(stream) -> Iterator[dict]:
    """Records of one archive: headers by line, block by Content-Length."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:60]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        if not head.get("content-length", "").isdigit() or "warc-type" not in head:
            raise ValueError(f"a record without type or length: {head}")
        n = int(head["content-length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError("archive ends inside a record")
        yield _parsed(head, block)


def _parsed(head: dict, block: bytes) -> dict:
    bare = lambda k: head[k].strip("<>") if k in head else None
    kind, payload, fields = head["warc-type"], None, None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
    elif kind == "metadata":
        fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split(CRLF) if x)}
    return {"record_id": bare("warc-record-id"), "type": kind, "concurrent_to": bare("warc-concurrent-to"),
            "refers_to": bare("warc-refers-to"), "target_uri": head.get("warc-target-uri"), "date": head.get("warc-date"),
            "content_type": head.get("content-type"), "payload_header": head.get("warc-payload-digest"),
            "payload": payload, "payload_bytes": None if payload is None else len(payload),
            "payload_digest": None if payload is None else hashlib.sha256(payload).hexdigest(), "fields": fields}


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = [c.split()[0] for c in RECORD.split(", ")]
    for batch in batches:
        for content in batch["content"]:
            raw, rows, size = io.BytesIO(content), [], 0
            for r in parse(gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw):
                rows.append(r)
                size += 500 + (r["payload_bytes"] or 0)
                if size > 4_000_000:
                    yield _frame(rows, cols)
                    rows, size = [], 0
            if rows:
                yield _frame(rows, cols)


def _frame(rows: list[dict], cols: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=cols)
    out["payload_bytes"] = out["payload_bytes"].astype("Int64")
    return out


def read_records(spark, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(_read, RECORD)


def assemble(recs: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, and the response (or revisit), request and metadata
    records that name it. Of several records of a type the greatest id is taken, counts tell."""
    key = F.coalesce("concurrent_to", "record_id")
    answer = F.col("type").isin("response", "revisit")
    pick = lambda cond, *cols: F.max(F.when(cond, F.struct(*cols)))
    return recs.groupBy(key.alias("record_id")).agg(
        pick(answer, "type", "target_uri", "date", "content_type", "refers_to", "payload_header", "payload_bytes",
             "payload_digest", "payload").alias("response"),
        pick(F.col("type") == "request", F.col("record_id").alias("id"), "target_uri", "date").alias("request"),
        pick(F.col("type") == "metadata", F.col("record_id").alias("id"), F.expr("fields['page-id']").alias("page_id"),
             F.expr("fields['payload-bytes']").alias("payload_bytes"),
             F.expr("fields['refers-to-page']").alias("refers_to_page")).alias("metadata"),
        F.count_if(F.col("type") == "request").alias("n_requests"),
        F.count_if(F.col("type") == "metadata").alias("n_metadata")).where(F.col("response").isNotNull())


def op8_warc(spark, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back."""
    path = scratch_path(spark, "warc")
    write_archives(T.table(spark, sf_dir, "pages"), path)
    caps = assemble(read_records(spark, path).drop("payload").withColumn("payload", F.lit(None).cast("binary")))
    r = F.col("response")
    return caps.select(
        F.col("metadata.page_id").cast("long").alias("page_id"),
        F.coalesce(r["payload_bytes"], F.col("metadata.payload_bytes").cast("long")).alias("payload_bytes"),
        F.coalesce(r["payload_digest"], F.replace(r["payload_header"], F.lit("sha256:"), F.lit(""))).alias("payload_digest"),
        r["type"].alias("record_type"), F.col("metadata.refers_to_page").cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to FROM f
"""
