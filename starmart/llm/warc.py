"""WARC archives: writing captures, reading records, assembling captures.

**Writing.** Every page becomes a request, a response or revisit, and a metadata record; request and metadata name
the response in ``WARC-Concurrent-To``, a revisit the record that holds its payload in ``WARC-Refers-To``. Among equal payloads of at least ``threshold`` bytes the row with the largest key holds
the payload and the others revisit it. The three records are one line of Spark's text writer, whose line separator is
the end of a WARC record, so executors write plain gzip WARC files and a lost task is written again.

**Reading.** Spark's text reader cuts a file at every end of a record followed by a version line. A payload may hold
such bytes too, so pieces are joined again until ``Content-Length`` is reached. A gzip file is read by one task from
front to back, one record at a time; archives are cut by the number of partitions that write them.

**Assembly.** Records reach the capture they belong to through concurrent-to identifiers, in either direction and through any
number of records between (one round of joins for each, ended when no record is reached), and each capture is one row: the response, requests and metadata records nested.

Cases: a null payload is empty. A null url has no target URI; control characters and spaces in one are percent-coded. A null key is in no
metadata record. Rows repeated under the largest key are all responses. A record that no identifier ties to a response is a
capture of its own without response. Other columns are ignored. Broken archives raise an error.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sinks.stage import stage

THRESHOLD = 1000
_END = "\r\n\r\n"
_CUT = "\r\n\r\nWARC/1."
_HOLDERS = ("response", "revisit", "resource", "conversion")

RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("concurrent_to", T.ArrayType(T.StringType())), T.StructField("target_uri", T.StringType()),
    T.StructField("date", T.StringType()), T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("block", T.BinaryType()),
])


def _urn(base: Column, kind: str) -> Column:
    h = F.md5(F.concat(base, F.lit(kind)))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: Column | str, urn: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record's text; headers whose value is null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    pairs = [
        ("WARC-Type", kind), ("WARC-Record-ID", urn), *headers,
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in pairs]
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit(_END), block)


def write_archives(
    pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", payload: str = "html",
    threshold: int = THRESHOLD, date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write the captures of all ``pages`` as gzip WARC files below ``path``."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).alias("key"), F.regexp_replace(url, r"[\x00-\x20\x7f]", "%20").alias("url"), body.alias("body")
    ).withColumn("size", F.octet_length("body").cast("long")).withColumn("sha", F.sha1(F.col("body").cast("binary")))
    # stored, so that the join below has a plain shuffle on both sides and a hot payload can be split
    groups = stage(
        rows.where(F.col("size") >= threshold).groupBy("sha", "size")
        .agg(F.max("key").alias("origin"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "warc-payloads",
    )
    rows = rows.join(groups, ["sha", "size"], "left")
    revisit = F.col("origin").isNotNull() & F.coalesce(F.col("key") < F.col("origin"), F.lit(True))
    base = F.concat(F.lit(path), F.lit(":"), F.monotonically_increasing_id().cast("string"))
    rows = rows.withColumn("again", revisit).withColumn("body", F.when(~F.col("again"), F.col("body"))).withColumn("base", base)
    # stored, so that a record has one id wherever it is named; revisits need no payload, responses no second join
    rows = stage(rows, "warc-rows")
    heads = stage(
        rows.where(~F.col("again") & F.col("origin").isNotNull()).groupBy("sha", "size").agg(F.min("base").alias("head")), "warc-heads"
    )
    revisits = rows.where("again").join(heads, ["sha", "size"], "left")
    rows = rows.where("not again").withColumn("head", F.lit(None).cast("string")).unionByName(revisits)
    kind = F.when(F.col("again"), "revisit").otherwise("response")
    hub = _urn(F.col("base"), "response")
    shared = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url"))]
    tied = [*shared, ("WARC-Concurrent-To", hub)]
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit(_END),
    )
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    response = _record(kind, hub, [
        *shared, ("Content-Type", F.lit("application/http; msgtype=response")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha")), ("WARC-Profile", F.when(F.col("again"), profile)),
        ("WARC-Refers-To", F.when(F.col("head").isNotNull(), _urn(F.col("head"), "response"))),
    ], F.concat(http, F.when(F.col("again"), "").otherwise(F.col("body"))))
    request = _record("request", _urn(F.col("base"), "request"), [
        *tied, ("Content-Type", F.lit("application/http; msgtype=request")),
    ], F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1" + _END)))
    facts = F.coalesce(F.concat(F.lit("page-id: "), F.col("key").cast("string")), F.lit(""))
    metadata = _record("metadata", _urn(F.col("base"), "metadata"), [
        *tied, ("Content-Type", F.lit("application/warc-fields")),
    ], F.concat(facts, F.lit("\r\n")))
    lines = rows.select(F.concat_ws(_END, request, response, metadata).alias("value"))
    lines.write.option("lineSep", _END).option("compression", "gzip").text(path)


def _fields(head: bytes) -> list[tuple[str, str]]:
    """Names in lower case and values of header lines; a line that begins with white space goes on."""
    out: list[list[str]] = []
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1][1] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append([name.strip().lower(), value.strip()])
    return [(a, b) for a, b in out]


def _bare_digest(value: str | None) -> str | None:
    """Hexadecimal SHA-1 of a labelled digest in base 32 or base 16."""
    if not value or not value.lower().startswith("sha1:"):
        return None
    digits = value[5:].strip()
    return digits.lower() if len(digits) == 40 else base64.b32decode(digits.upper()).hex()


def _parsed(headers: list[tuple[str, str]], block: bytes, blocks: bool) -> dict:
    named = dict(reversed(headers))
    size = digest = None
    kind = named.get("warc-type", "").lower()
    facts: dict[str, str] = {}
    if "application/http" in named.get("content-type", "") and kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        if kind == "response":
            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        else:
            length = dict(_fields(head)).get("content-length")
            size, digest = int(length) if length else None, _bare_digest(named.get("warc-payload-digest"))
    elif kind in ("response", "resource"):
        size, digest = len(block), hashlib.sha1(block).hexdigest()
    elif named.get("content-type") == "application/warc-fields":
        facts = dict(reversed(_fields(block)))
    return {
        "record_id": named.get("warc-record-id"), "record_type": kind, "target_uri": named.get("warc-target-uri"),
        "concurrent_to": [v for n, v in headers if n == "warc-concurrent-to"], "date": named.get("warc-date"),
        "fields": list(facts.items()), "payload_bytes": size, "payload_digest": digest,
        "refers_to": named.get("warc-refers-to"), "block": block if blocks else None,
    }


def _records(pieces: Iterator[tuple[str, bytes]], blocks: bool) -> Iterator[dict]:
    """Records of the pieces of files in order."""
    cut, file, held = _CUT.encode(), None, None

    def take(held: bytes, last: bool) -> tuple[dict | None, bytes | None]:
        """A record if it is whole, and what is left."""
        head, found, rest = held.partition(b"\r\n\r\n")
        headers = _fields(head) if found else []
        length = int(dict(headers).get("content-length", -1))
        if length < 0:
            if not last:
                return None, held
            raise ValueError(f"record without Content-Length: {held[:80]!r}")
        if len(rest) < length:
            if last:
                raise ValueError(f"record of {length} bytes is cut off after {len(rest)}")
            return None, held
        after = rest[length:]
        if after.startswith(cut):
            after = b"WARC/1." + after[len(cut) :]
        elif after.strip(b"\r\n"):
            raise ValueError(f"no end of record where Content-Length says: {after[:40]!r}")
        else:
            after = None
        return _parsed(headers, rest[:length], blocks), after

    def drain(held: bytes | None, last: bool) -> Iterator[dict]:
        while held:
            record, left = take(held, last)
            if record is None:
                return held
            yield record
            held = left
        return None

    for name, piece in pieces:
        if name != file:
            if held:
                yield from drain(held, True)
            file, held = name, piece if piece.strip(b"\r\n") else None
        else:
            held = b"WARC/1." + piece if held is None else held + cut + piece
        if held:
            held = yield from drain(held, False)
    if held:
        yield from drain(held, True)


def read_records(spark: SparkSession, path: str, *, blocks: bool = True) -> DataFrame:
    """All records of the gzip archives below ``path``; ``blocks=False`` leaves out their content."""
    lines = spark.read.option("lineSep", _CUT).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    made = to_arrow_schema(RECORD)

    def run(batches):
        def pieces():
            for batch in batches:
                for name, piece in zip(batch.column(0), batch.column(1), strict=True):
                    yield name.as_py(), piece.as_py()

        held, size = [], 0
        for record in _records(pieces(), blocks):
            held.append(record)
            size += 500 + len(record["block"] or b"")
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(held, schema=made)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=made)

    return lines.mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One row a capture: capture_id, response, requests, metadata (arrays of records)."""
    holder = F.col("record_type").isin(*_HOLDERS)
    known = stage(records.select("record_id", "concurrent_to", holder.alias("holder")), "warc-links")
    links = known.select("record_id", "holder", F.explode("concurrent_to").alias("to"))
    hubs = known.where("holder").select(F.col("record_id").alias("hub"))
    others = links.where("not holder")
    met = stage(others.join(hubs, others["to"] == hubs["hub"], "left").select("record_id", "to", "hub"), "warc-met")
    direct = met.where("hub is not null").select("record_id", "hub")
    named = links.where("holder").select(F.col("to").alias("record_id"), F.col("record_id").alias("hub"))
    first = stage(direct.unionByName(named).groupBy("record_id").agg(F.min("hub").alias("hub")), "warc-hubs")
    # links between records without a payload, either way, from those that have no capture yet
    between = met.where("hub is null").select("record_id", "to")
    between = between.unionByName(between.select(F.col("to").alias("record_id"), F.col("record_id").alias("to")))
    known = first
    while True:
        between = stage(between.join(known, "record_id", "left_anti"), "warc-between")
        reached = between.join(known.withColumnRenamed("record_id", "to"), "to").groupBy("record_id").agg(F.min("hub").alias("hub"))
        reached = stage(reached, "warc-hubs")
        if reached.isEmpty():
            break
        known = known.unionByName(reached)
    placed = records.join(known, "record_id", "left")
    own = F.when(holder, F.col("record_id"))
    placed = placed.withColumn("capture_id", F.coalesce(own, "hub", "record_id"))
    rows = placed.groupBy("capture_id").agg(F.collect_list(F.struct(*RECORD.names)).alias("all"))
    return rows.select(
        "capture_id",
        F.get(F.filter("all", lambda r: r["record_type"].isin(*_HOLDERS)), F.lit(0)).alias("response"),
        F.filter("all", lambda r: r["record_type"] == "request").alias("requests"),
        F.filter("all", lambda r: r["record_type"] == "metadata").alias("metadata"),
    )


def digest(found: DataFrame) -> DataFrame:
    """Page, size and hash of the payload, and the page of the record that a revisit refers to."""
    facts = F.get("metadata", F.lit(0))["fields"]
    rows = stage(found.select(
        "capture_id", facts["page-id"].cast("long").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.record_type").alias("record_type"),
        F.col("response.refers_to").alias("record"),
    ), "warc-captures")
    holders = rows.select(F.col("capture_id").alias("record"), F.col("page_id").alias("refers_to"))
    linked = rows.where("record is not null").join(holders, "record", "left")
    plain = rows.where("record is null").withColumn("refers_to", F.lit(None).cast("long"))
    return plain.unionByName(linked).drop("capture_id", "record")
