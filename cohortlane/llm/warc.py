"""WARC archives with revisit records for repeated payloads.

Headers (id, digest, length) are shuffled by payload digest; of equal payloads of at least ``LEAST_BYTES`` bytes the row
with the largest id is kept as response and the others become revisit records that refer to it. The archives are plain
WARC/1.1 files, gzip-compressed, written by Spark's text writer with the record end as line separator, so they lie in
whatever store Spark writes to. Reading streams through each file record by record and joins revisits to their response.

A null payload counts as empty. Rows with a null id are written as responses and can't be referred to. Rows that repeat
an id and payload get the same decision each; an empty table gives an archive without records. Line breaks in a url are
percent-encoded; a null url has no target line. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlane.session import scratch_folder

LEAST_BYTES = 1000
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"


def revisits(heads: DataFrame) -> DataFrame:
    """``(page_id, digest, refers_to)`` of the rows whose payload another row, with a larger id, holds too."""
    large = heads.filter(F.col("bytes") >= LEAST_BYTES)
    kept = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("first"))
    kept = kept.filter("first < refers_to").drop("first")
    return large.join(kept, "digest").filter("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()


def records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: the text of each page's record, without the record end."""
    payload = F.coalesce("html", F.lit(""))
    whole = pages.select(
        "page_id", "url", payload.alias("payload"), F.sha1(F.encode(payload, "utf-8")).alias("digest"))
    heads = pages.select(
        "page_id", F.sha1(F.encode(payload, "utf-8")).alias("digest"), F.octet_length(payload).alias("bytes"))
    joined = whole.join(revisits(heads), ["page_id", "digest"], "left")
    first = F.col("refers_to").isNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload"), F.lit(END))
    block = F.when(first, F.concat(http, "payload")).otherwise(http)
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    name = lambda column: F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(first, "response").otherwise("revisit")),
        line("WARC-Record-ID", name("page_id")),
        line("WARC-Target-URI", target),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Profile", F.when(~first, PROFILE)),
        line("WARC-Refers-To", F.when(~first, name("refers_to"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block)),
    )
    return joined.select(F.concat(head, F.lit("\r\n"), block).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    records(pages).write.option("lineSep", END).option("compression", "gzip").text(path)


def read_records(stream: io.BufferedIOBase):
    """(headers, block) of each record of an open archive, one at a time."""
    while line := stream.readline():
        if not line.strip():
            continue
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            key, _, value = line.partition(b":")
            headers[key.decode().lower()] = value.strip().decode()
        block = stream.read(int(headers["content-length"]))
        yield headers, block


SCHEMA = "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, url string, payload binary"


def _parse(batches):
    def number(text):
        digits = (text or "").removeprefix(f"<{ID_PREFIX}").removesuffix(">")
        return int(digits) if digits else None

    for batch in batches:
        for content in batch["content"]:
            rows, size = [], 0
            for headers, block in read_records(gzip.open(io.BytesIO(content))):
                payload = block.partition(END.encode())[2]
                first = headers["warc-type"] == "response"
                rows.append((
                    number(headers["warc-record-id"]), headers["warc-type"], number(headers.get("warc-refers-to")),
                    hashlib.sha1(payload).hexdigest() if first else headers["warc-payload-digest"].removeprefix("sha1:"),
                    len(payload) if first else None, headers.get("warc-target-uri"), payload if first else None))
                size += len(block)
                if size > 1 << 22:
                    yield _frame(rows)
                    rows, size = [], 0
            yield _frame(rows)


def _frame(rows):
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")], dtype=object)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records as rows; a revisit gets length and (if wanted) payload from the response it refers to."""
    found = spark.read.format("binaryFile").load(path).select("content").mapInPandas(_parse, SCHEMA)
    if not payloads:
        found = found.drop("payload")
    response = found.filter("record_type = 'response' and payload_bytes >= %d" % LEAST_BYTES).select(
        F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"),
        *([F.col("payload").alias("_payload")] if payloads else [])).dropDuplicates(["_id", "_digest"])
    again = found.filter("record_type = 'revisit'")
    joined = again.join(
        response, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    filled = {"payload_bytes": F.col("_bytes")} | ({"payload": F.col("_payload")} if payloads else {})
    joined = joined.withColumns(filled).select(*found.columns)
    return found.filter("record_type = 'response'").unionByName(joined)


def archived(pages: DataFrame) -> DataFrame:
    """Write all pages below the shared scratch folder, read them back, and return one row per record."""
    path = f"{scratch_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path, payloads=False)


ORACLE = f"""
with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
k as (select payload_digest, max(page_id) as keep from p where payload_bytes >= {LEAST_BYTES} group by 1)
select page_id, cast(payload_bytes as bigint) as payload_bytes, p.payload_digest,
  case when keep > page_id then 'revisit' else 'response' end as record_type,
  case when keep > page_id then keep end as refers_to
from p left join k on k.payload_digest = p.payload_digest and p.payload_bytes >= {LEAST_BYTES}"""
