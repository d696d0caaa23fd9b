"""WARC archives with revisit resolution.

1. ``resolve``: headers (key, payload digest, size) shuffle by digest; the
   smallest key of equal payloads becomes the original, the others revisits.
   The digest's aggregate has one row a digest, and the headers join it back
   as the large side.  The aggregate is dealt anew before that join, so both
   sides are plain shuffles and AQE can split a digest that very many share.
   Payloads stay out of that shuffle.
2. ``write``: payloads meet their decisions by key and leave as gzip'd WARC/1.1
   files with fresh headers, through Spark's text writer: a record ends with
   the two line breaks that are its line separator, so bytes go out as they
   are and a lost task's files are replaced whole.
3. ``read``: each archive is parsed as a stream by Content-Length, and each
   payload's digest is taken anew.
4. ``restore``: revisit records join the original response with their digest.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_BYTES = 100  # smaller payloads are always responses
ARCHIVE_BYTES = 32 << 20  # payload bytes of an archive, about
DATE = "2024-01-01T00:00:00Z"
BATCH_BYTES = 8 << 20
CRLF = "\r\n"
HTTP = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "


def headers(records: DataFrame) -> DataFrame:
    """records(key, uri, payload binary) -> (key, uri, digest, n_bytes, payload).
    A null payload is empty."""
    payload = F.coalesce("payload", F.lit(b""))
    return records.select("key", "uri", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n_bytes"), payload.alias("payload"))


def resolve(heads: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """heads(key, digest, n_bytes) -> one row per (key, digest): also
    record_type and refers_to, the original's key.

    Rows that repeat key and payload are one record's copies and share its
    type.  A null key never is an original unless all keys of its payload are
    null; then all are responses.
    """
    heads = heads.select("key", "digest", "n_bytes").groupBy("key", "digest").agg(F.first("n_bytes").alias("n_bytes"))
    first = heads.filter(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first").hint("rebalance")
    joined = heads.join(first, "digest", "left")
    again = F.coalesce(~F.col("first").eqNullSafe(F.col("key")), F.lit(False)) & F.col("first").isNotNull()
    return joined.select("key", "digest", "n_bytes", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


def record_id(key: Column, digest: Column) -> Column:
    """A urn:uuid of key and payload digest."""
    h = F.md5(F.concat_ws("|", key.cast("string"), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _field(value: Column) -> Column:
    """A header value on one line."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[\x00-\x1F\x7F]", " ")


def write(records: DataFrame, path: str, min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> None:
    """Deduplicated archives of records(key, uri, payload) under ``path``.
    Null uris and keys are written as empty fields; an empty table leaves no
    record."""
    heads = headers(records)
    plan = resolve(heads, min_bytes).withColumnsRenamed({"key": "p_key", "digest": "p_digest"}).drop("n_bytes")
    rows = heads.join(plan, F.col("key").eqNullSafe(F.col("p_key")) & (F.col("digest") == F.col("p_digest")))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(HTTP), F.col("n_bytes").cast("string"), F.lit(CRLF * 2))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"), F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("key"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), _field(F.col("uri"))), F.concat(F.lit("X-Record-Key: "), _field(F.col("key"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}WARC-Refers-To: "), record_id(F.col("refers_to"), F.col("digest")), F.lit(f"{CRLF}WARC-Refers-To-Date: {date}"))),
        F.concat(F.lit("Content-Type: application/http; msgtype=response" + CRLF + "Content-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string")),
    ]
    value = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), http, body)
    mean = heads.agg(F.avg("n_bytes")).first()[0] or 1
    rows.select(value.alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", max(1, int(archive_bytes / max(mean, 1)))).text(path)


def parse(stream) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of each record of a WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) and line.strip():
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        yield fields, stream.read(int(fields["content-length"]))


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The archives' records: (record_id, record_type, key, uri, digest,
    refers_to_id, payload_bytes, payload).  ``digest`` is taken from the
    payload; for a revisit, which has none, it is the header's."""
    cols = "record_id string, record_type string, key string, uri string, digest string, refers_to_id string, payload_bytes long, payload binary"
    names = [c.split()[0] for c in cols.split(", ")]
    types = [pa.string()] * 6 + [pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        for batch in batches:
            for content in batch["content"]:
                raw = io.BytesIO(content.as_buffer())
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content.as_buffer()[:2].to_pybytes() == b"\x1f\x8b" else raw
                for fields, block in parse(stream):
                    kind = fields.get("warc-type")
                    if kind not in ("response", "revisit"):
                        continue
                    http = fields.get("content-type", "").startswith("application/http")
                    payload = block.partition(b"\r\n\r\n")[2] if http else block
                    whole = kind == "response"
                    digest = sha256(payload).hexdigest() if whole else fields.get("warc-payload-digest", "").removeprefix("sha256:")
                    rows.append((fields.get("warc-record-id"), kind, fields.get("x-record-key") or None, fields.get("warc-target-uri"), digest, fields.get("warc-refers-to"), len(payload) if whole else None, payload if whole and with_payload else None))
                    held += len(payload) * with_payload + 300
                    if held > BATCH_BYTES:
                        yield flush()
                        rows, held = [], 0
        if rows:
            yield flush()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, cols)


def restore(records: DataFrame) -> DataFrame:
    """Read records with each revisit's payload_bytes, refers_to (the
    original's key) and target, from the response of its digest and id."""
    revisit = records.filter("record_type = 'revisit'")
    original = records.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("digest").alias("o_digest"), F.col("key").alias("refers_to"), F.col("payload_bytes").alias("o_bytes"))
    original = original.dropDuplicates(["refers_to_id", "o_digest"])
    found = revisit.join(original, "refers_to_id", "left")
    same = F.col("o_digest") == F.col("digest")
    cols = ["record_id", "record_type", "key", "uri", "digest"]
    found = found.select(*cols, F.when(same, F.col("o_bytes")).alias("payload_bytes"), F.when(same, F.col("refers_to")).alias("refers_to"))
    own = records.filter("record_type = 'response'").select(*cols, "payload_bytes", F.lit(None).cast("string").alias("refers_to"))
    return own.unionByName(found)
