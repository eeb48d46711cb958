"""WARC archives: writing, and reading by boundary-chain verification.

Writing.  Records are lines of a text table whose line separator is the blank
line that ends a record, so Spark's text writer writes them to any file
system.  Of records with equal payloads the one with the smallest id is a
response, the others are revisits without payload that refer to it.  The text
writer may compress whole archives (gzip is the usual form of exchange); plain
archives can be read in splits.

Reading.  A record may hold the record magic inside its payload.  Tasks walk
their split in pieces between blank lines and emit every place that looks like
a record, with the place at which its Content-Length says the next one starts.
The bytes that each split consumed add up to file offsets.  Pointer jumping
from offset 0 of each file (jumps double each round) marks the places that a
chain of records reaches; the others are payload.  A payload that lies within
its own piece run is digested by the task that reads it; payloads broken by
look-alikes or split ends are put together from their pieces.  In the first
split of a file the walk is in step with the chain, so bytes are kept for
look-alikes and broken payloads only; later splits keep theirs.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.llm.common import groups_to_members, staged

SEPARATOR = "\r\n\r\n"
MAGIC = b"WARC/1.0\r\n"
RECORDS_PER_ARCHIVE = 1000
SALTS = 256
RECORD_DATE = "2024-01-01T00:00:00Z"
_SEP = SEPARATOR.encode()


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 (160 bits: no padding)."""
    hexed = F.sha1(data)
    part = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.lower(F.concat(*part)), "0123456789abcdefghijklmnopqrstuv",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(text: Column) -> Column:
    h = F.md5(text)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), _uuid(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("null")),
                                                           digest)), F.lit(">"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_revisit_bytes: int = 0, compression: str = "gzip",
               records_per_archive: int = RECORDS_PER_ARCHIVE) -> None:
    """One record per row.  Null payloads are empty; rows that repeat id and
    payload give one response and revisits; a null id stays null; a table
    without rows gives a folder without records; other columns are ignored."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), payload.alias("_payload"))
    rows = rows.withColumns({"_digest": base32_sha1(F.col("_payload")),
                             "_sha": F.unhex(F.sha2("_payload", 256)),
                             "_bytes": F.octet_length("_payload").cast("long"),
                             "_key": F.coalesce(F.col("_id").cast("string"), F.lit("null")),
                             "_salt": F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int")})
    slim = staged(spark, rows.select("_id", "_key", "_sha", "_digest", "_salt").distinct(), "warc-slim")
    groups = slim.groupBy("_sha", "_digest").agg(F.min("_id").alias("_first"))
    # ids that are not the first of their payload, or are given again
    known = groups_to_members(slim, groups, ["_sha", "_digest"], "_salt")
    flags = known.where(~F.col("_id").eqNullSafe(F.col("_first"))) \
        .select("_key", "_sha", "_first", F.lit(True).alias("_copy"))
    named = rows.join(flags, ["_key", "_sha"], "left")
    again = Window.partitionBy("_key", "_sha").orderBy("_url")  # rows that repeat id and payload
    named = named.withColumn("_again", F.row_number().over(again) > 1)
    small = F.col("_bytes") < min_revisit_bytes
    revisit = (F.col("_copy").isNotNull() | F.col("_again")) & ~small
    first = F.when(F.col("_copy"), F.col("_first")).otherwise(F.col("_id"))
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"\r\n{name}: "), value)).otherwise("")
    url = F.regexp_replace(F.regexp_replace("_url", "\r", "%0D"), "\n", "%0A")
    record = F.concat(
        F.lit("WARC/1.0"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("_id"), F.col("_digest"))),
        line("WARC-Date", F.lit(RECORD_DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        line("WARC-Refers-To", F.when(revisit, _record_id(first, F.col("_digest")))),
        line("X-Page-Id", F.col("_id").cast("string")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("_bytes")).cast("string")),
        F.lit(SEPARATOR), F.when(revisit, F.lit("")).otherwise(F.col("_payload")))
    writer = named.select(record.alias("value")).write.option("lineSep", SEPARATOR) \
        .option("maxRecordsPerFile", records_per_archive)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def _header(block: bytes) -> dict[str, str]:
    fields = {}
    for text in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = text.partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return fields


_PLACES = ("file string, block long, start long, size long, next long, head long, complete boolean, "
           "record_type string, record_id string, refers_to string, page_id long, payload_bytes long, "
           "payload_digest string, body binary, raw binary")
_ARROW = pa.schema([("file", pa.string()), ("block", pa.int64()), ("start", pa.int64()), ("size", pa.int64()),
                    ("next", pa.int64()), ("head", pa.int64()), ("complete", pa.bool_()),
                    ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
                    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("body", pa.binary()), ("raw", pa.binary())])


class _Place:
    """A look-alike record (or the bytes before a split's first one) and all
    bytes up to the next look-alike."""

    def __init__(self, start: int, head: bytes = b""):
        self.start, self.head, self.parts = start, len(head), [head]
        self.header = _header(head) if head else {}
        length = self.header.get("content-length", "")
        self.length = int(length) if length.isascii() and length.isdigit() and len(length) < 19 else None

    def row(self, file: str, block: int, end: int, in_step: bool, keep_bodies: bool) -> dict:
        raw = b"".join(self.parts)
        page = self.header.get("x-page-id", "")
        row = dict.fromkeys(_ARROW.names) | {
            "file": file, "block": block, "start": self.start, "size": end - self.start, "head": self.head,
            "complete": False, "record_type": self.header.get("warc-type"),
            "record_id": self.header.get("warc-record-id"), "refers_to": self.header.get("warc-refers-to"),
            "payload_bytes": self.length, "page_id": int(page) if page.lstrip("-").isdigit() else None}
        if self.length is not None:
            row["next"] = self.start + self.head + self.length + len(_SEP)
            if len(raw) == self.head + self.length + len(_SEP):
                payload = raw[self.head:self.head + self.length]
                row |= {"complete": True, "body": payload if keep_bodies else None,
                        "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode()}
        if not (row["complete"] and in_step):
            row["raw"] = raw
        return row


def _walk(keep_bodies: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, key, at, place, expect = [], 0, None, 0, None, 0

        def close() -> int:
            nonlocal expect
            if place is None or at == place.start:
                return 0
            in_step = key[1] == 0 and place.start == expect
            out.append(place.row(*key, at, in_step, keep_bodies))
            if in_step:
                expect = out[-1]["next"]
            return len(out[-1]["body"] or b"") + len(out[-1]["raw"] or b"") + 200

        for batch in batches:
            files, blocks = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for value, file, block in zip(batch.column(0).cast(pa.binary()), files, blocks):
                piece = value.as_py()
                if key != (file, block):
                    held += close()
                    key, at, expect, place = (file, block), 0, 0, _Place(0)
                lead = 2 if piece.startswith(b"\r\n" + MAGIC) else 0
                if piece.startswith(MAGIC, lead):
                    place.parts.append(piece[:lead])
                    at += lead
                    held += close()
                    place = _Place(at, piece[lead:] + _SEP)
                    at += place.head
                else:
                    place.parts += [piece, _SEP]
                    at += len(piece) + len(_SEP)
                if held > 4_000_000:
                    yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
                    out, held = [], 0
        held += close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
    return run


def _reachable(places: DataFrame) -> DataFrame:
    """(file, start) of the records that a chain from offset 0 reaches.  Each
    round adds the targets of all reached places and doubles the jumps, so a
    file with n records takes about log2(n) rounds."""
    spark = places.sparkSession
    nodes = staged(spark, places.select("file", "start", F.col("next").alias("jump"),
                                        (F.col("start") == 0).alias("hit")), "warc-chain")
    while True:
        targets = nodes.where("hit AND jump IS NOT NULL").select("file", F.col("jump").alias("start")).distinct()
        ends = nodes.select("file", F.col("start").alias("jump"), F.col("jump").alias("far"))
        grown = nodes.join(targets.withColumn("new", F.lit(True)), ["file", "start"], "left") \
            .join(ends, ["file", "jump"], "left") \
            .select("file", "start", F.col("far").alias("jump"),
                    (F.col("hit") | F.coalesce("new", F.lit(False))).alias("hit"))
        nodes = staged(spark, grown, "warc-chain")
        if nodes.where("hit AND jump IS NOT NULL").isEmpty():
            return nodes.where("hit").select("file", "start")


def read_warc(spark: SparkSession, path: str, keep_bodies: bool = False) -> DataFrame:
    """One row per record that the chains reach: file, offset, record_type,
    record_id, refers_to, page_id, payload_bytes, payload_digest (of the bytes
    read) and, with ``keep_bodies``, the payload as ``body``."""
    lines = spark.read.option("lineSep", SEPARATOR).text(path) \
        .select("value", "_metadata.file_path", "_metadata.file_block_start")
    places = staged(spark, lines.mapInArrow(_walk(keep_bodies), _PLACES), "warc-places")
    # file offsets: the bytes that the splits before have consumed
    splits = places.groupBy("file", "block").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    places = places.join(splits, ["file", "block"]) \
        .withColumns({"start": F.col("start") + F.col("base"), "next": F.col("next") + F.col("base")}) \
        .drop("base", "block")
    records = _reachable(places.where("head > 0").select("file", "start", "next"))
    known = places.join(records.withColumn("hit", F.lit(True)), ["file", "start"], "left")
    # payloads broken by look-alikes or split ends: a reached place and what follows it
    follow = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    broken = known.where("hit IS NULL OR NOT complete").select("file", "start", "hit", "raw") \
        .withColumn("record", F.last(F.when(F.col("hit"), F.col("start")), ignorenulls=True).over(follow))
    pieces = broken.groupBy("file", F.col("record").alias("start")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("start").alias("at"), "raw"))).alias("pieces"))
    whole = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["raw"]))
    hits = known.where("hit").join(pieces.select("file", "start", whole.alias("whole")), ["file", "start"], "left")
    cut = F.expr("substring(whole, int(head) + 1, int(payload_bytes))")
    pick = lambda own, put_together: F.when(F.col("complete"), F.col(own)).otherwise(put_together)
    out = hits.select("file", F.col("start").alias("offset"), "record_type", "record_id", "refers_to", "page_id",
                      pick("payload_bytes", F.octet_length(cut).cast("long")).alias("payload_bytes"),
                      pick("payload_digest", base32_sha1(cut)).alias("payload_digest"),
                      pick("body", cut).alias("body"))
    return out if keep_bodies else out.drop("body")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): size
    and digest of a revisit are those of the response it refers to, and
    ``refers_to`` is that response's page id."""
    slim = records.select("page_id", "payload_bytes", "payload_digest", "record_type", "record_id",
                          F.col("refers_to").alias("refers_id"))
    responses = slim.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"), F.col("payload_bytes").alias("full_bytes"),
        F.col("payload_digest").alias("full_digest"), F.col("page_id").alias("refers_to"))
    # only revisits meet their response; one payload may have a third of all
    revisits = slim.where("record_type = 'revisit'").select("page_id", "refers_id", "record_type") \
        .withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    met = groups_to_members(revisits, responses, ["refers_id"], "salt").select(
        "page_id", F.col("full_bytes").alias("payload_bytes"), F.col("full_digest").alias("payload_digest"),
        "record_type", "refers_to")
    own = slim.where("record_type <> 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.lit(None).cast(records.schema["page_id"].dataType).alias("refers_to"))
    return own.unionAll(met)
