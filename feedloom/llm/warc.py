"""Web archive records: write them with Spark's text writer, read archives back in splits of any size.

A reader task sees the pieces between record magics in its split and emits, for every piece that looks like a
record, the offset where the next record has to begin. Magic inside a payload gives such pieces too. Within a
split a task shortens the chains of offsets to where they leave the split; pointer jumping over those, from the
start of each file, then finds the one true entry of every split, and only records on the chain from there stay.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import settle
from feedloom.session import work_dir

# Line ends, record end and magic of the format, and the alphabet of base 32.
END = "\r\n\r\n"
MAGIC = "WARC/1."
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SEPARATOR = END + MAGIC
#: Date of the records; the given tables have none.
DATE = "2024-01-01T00:00:00Z"

_SEP = SEPARATOR.encode()
_FIELD = re.compile(rb"^([A-Za-z-]+):[ \t]*(.*?)\r?$", re.M)
_PAGE = re.compile(rb"<urn:page:(-?\d+)>")


def base32(hexed: Column) -> Column:
    """Base 32 of a SHA-1 given as 40 hexadecimal digits: four characters for every five digits."""
    out = []
    for at in range(8):
        bits = F.conv(F.substring(hexed, 1 + 5 * at, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            out.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*out)


def records(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """One record per row of `pages` (page_id, url, html), without its end, as column `value`.

    The payload is the html in UTF-8; null is the empty payload. Of records with equal payloads of at least
    `revisit_bytes` bytes, that with the largest page_id holds the payload and the others revisit it. Rows that
    tie on the largest page_id all hold it; a null page_id is smaller than any other.
    """
    html = F.coalesce("html", F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), html.alias("html"))
    base = base.withColumns({"_size": F.octet_length("html").cast("long"), "_sha": F.sha1(F.col("html").cast("binary"))})
    holders = settle(
        base.where(F.col("_size") >= revisit_bytes)
        .groupBy("_sha", "_size")
        .agg(F.max("page_id").alias("_holder"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_sha", "_size", "_holder", F.lit(True).alias("_shared")),
        "warc-holders",
    )
    joined = base.join(holders, ["_sha", "_size"], "left")
    revisit = F.coalesce("_shared", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("_holder"))
    size = F.col("_size").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    head = [
        F.lit("WARC/1.0\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        urn("page_id"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        base32(F.col("_sha")),
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
                urn("_holder"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    ]
    return joined.select(F.concat(*head).alias("value"))


def write_archives(pages: DataFrame, path: str, revisit_bytes: int = 0) -> None:
    """One archive file per partition; Spark's line separator is the end of a record."""
    records(pages, revisit_bytes).write.option("lineSep", END).text(path)


def parse(piece: bytes, first: bool) -> dict | None:
    """The fields of a piece that begins behind its magic, or None if it is no record."""
    at = piece.find(END.encode())
    if at < 0 or not piece[:32].split(b"\r\n", 1)[0].removeprefix(MAGIC.encode()).isdigit():
        return None
    fields = {k.lower(): v for k, v in _FIELD.findall(piece[:at])}
    if not fields.get(b"content-length", b"").isdigit() or b"warc-type" not in fields:
        return None
    body, length = at + 4, int(fields[b"content-length"])
    page, refers = (_PAGE.match(fields.get(k, b"")) for k in (b"warc-record-id", b"warc-refers-to"))
    return {
        "next": body + length + 4,
        "kind": fields[b"warc-type"].decode("ascii", "replace"),
        "page_id": int(page[1]) if page else None,
        "refers_to": int(refers[1]) if refers else None,
        "digest": fields.get(b"warc-payload-digest", b"").decode("ascii", "replace"),
        "block": piece[body : body + length],
        "whole": len(piece) in (body + length, body + length + 4),
    }


def payload_of(record: dict) -> tuple[int, str]:
    """(size, base-32 SHA-1) of the full payload; a revisit knows them from its headers only."""
    head, _, payload = record["block"].partition(END.encode())
    if record["kind"] == "revisit":
        fields = {k.lower(): v for k, v in _FIELD.findall(head)}
        return int(fields.get(b"content-length", b"0")), record["digest"].removeprefix("sha1:")
    return len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()


PIECE = "file string, split long, seq long, size long, start long, `next` long, leaves long, whole boolean, page_id long, kind string, refers_to long, payload_bytes long, payload_digest string"
RECORD = ["page_id", "kind", "refers_to", "payload_bytes", "payload_digest"]


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", SEPARATOR).text(path)
    return lines.select(
        F.col("value").cast("binary").alias("piece"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
    )


def numbered(batches):
    """(file, split, seq, offset in the split, piece) of every piece; a split's pieces follow each other."""
    now, seq, at = None, 0, 0
    for batch in batches:
        for piece, file, split in zip(*(batch.column(c).to_pylist() for c in ("piece", "file", "split"))):
            if (file, split) != now:
                now, seq, at = (file, split), 0, 0
            yield file, split, seq, at, piece
            seq, at = seq + 1, at + len(piece) + len(_SEP)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row per piece, offsets from the start of the split's first piece; `leaves` is where its chain leaves it."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(PIECE))

    def flush(rows: list[dict]) -> pa.RecordBatch:
        leaves: dict[int, int] = {}
        for r in reversed(rows):
            if r["next"] is not None:
                leaves[r["start"]] = r["leaves"] = leaves.get(r["next"], r["next"])
        return pa.RecordBatch.from_pylist(rows, schema=arrow)

    def run(batches):
        rows: list[dict] = []
        for file, split, seq, at, piece in numbered(batches):
            if rows and (file, split) != (rows[0]["file"], rows[0]["split"]):
                yield flush(rows)
                rows = []
            first = split == 0 and seq == 0
            found = parse(piece, first)
            row = {"file": file, "split": split, "seq": seq, "size": len(piece) + len(_SEP), "start": at if first else at - len(MAGIC)}
            row |= dict.fromkeys(["next", "leaves", *RECORD]) | {"whole": False}
            if found:
                row |= {"next": at + found["next"]} | {k: found[k] for k in ("kind", "page_id", "refers_to", "whole")}
                if found["whole"]:
                    row["payload_bytes"], row["payload_digest"] = payload_of(found)
            rows.append(row)
        if rows:
            yield flush(rows)

    return read_pieces(spark, path).mapInArrow(run, PIECE)


def reachable(links: DataFrame) -> DataFrame:
    """Rows (file, start) on the chains of `links` (file, start, leaves) from offset 0, by pointer jumping."""
    jumps = settle(
        links.join(links.select("file", F.col("leaves").alias("start")).unionAll(links.select("file", F.lit(0).cast("long"))).distinct(), ["file", "start"], "left_semi"),
        "warc-jumps",
    )
    found = settle(jumps.where("start = 0").select("file", "start"), "warc-found")
    count = -1
    while (now := found.count()) != count:
        count = now
        further = found.join(jumps, ["file", "start"]).select("file", F.col("leaves").alias("start"))
        nodes = further.join(jumps, ["file", "start"], "left_semi")
        found = settle(found.unionAll(nodes).distinct(), "warc-found")
        onward = jumps.select("file", F.col("start").alias("leaves"), F.col("leaves").alias("_far"))
        jumps = settle(
            jumps.join(onward, ["file", "leaves"], "left").select("file", "start", F.coalesce("_far", "leaves").alias("leaves")),
            "warc-jumps",
        )
    return found


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of uncompressed archives: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Splits may begin anywhere. Magic in a payload, even a complete record in it, starts no record. What follows a
    damaged record in its file is not reachable and is left out. An empty folder of files gives no rows.
    """
    raw = settle(candidates(spark, path), "warc-pieces")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        raw.groupBy("file", "split")
        .agg(F.sum("size").alias("_size"))
        .select("file", "split", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    )
    pieces = raw.join(bases, ["file", "split"]).withColumns(
        {c: F.col(c) + F.col("_base") for c in ("start", "next", "leaves")}
    ).drop("_base", "size")
    pieces = settle(pieces, "warc-offsets")
    links = pieces.where("next is not null")
    entries = (
        links.join(reachable(links.select("file", "start", "leaves")), ["file", "start"])
        .groupBy("file", "split")
        .agg(F.min("start").alias("entry"))
    )

    def follow(group: pa.Table) -> pa.Table:
        starts, nexts = group.column("start").to_pylist(), group.column("next").to_pylist()
        place = {s: k for k, s in enumerate(starts)}
        at, kept = group.column("entry")[0].as_py(), []
        while at in place:
            kept.append(place[at])
            at = nexts[place[at]]
        return group.take(pa.array(kept, pa.int64())).drop_columns(["entry"])

    kept = settle(links.join(entries, ["file", "split"]).groupBy("file", "split").applyInArrow(follow, links.schema), "warc-records")
    out = kept.where("whole").select(*RECORD)
    broken = kept.where("not whole")
    if not broken.isEmpty():
        out = out.unionAll(stitched(spark, path, pieces, kept, broken))
    return out.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


def stitched(spark: SparkSession, path: str, pieces: DataFrame, kept: DataFrame, broken: DataFrame) -> DataFrame:
    """Records whose payload holds magic: their pieces are read again and put together."""
    keys = ["file", "split", "seq"]
    inner = pieces.join(kept.select(*keys), keys, "left_anti").withColumn("_own", F.lit(None).cast("long"))
    parts = inner.unionAll(broken.withColumn("_own", F.col("start")))
    along = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    owned = settle(
        parts.withColumn("_record", F.last("_own", ignorenulls=True).over(along)).where("_record is not null").select(*keys, "start", "_record"),
        "warc-parts",
    )

    def content(batches):
        for file, split, seq, _, piece in numbered(batches):
            yield pa.RecordBatch.from_pylist(
                [{"file": file, "split": split, "seq": seq, "piece": piece}],
                schema=pa.schema([("file", pa.string()), ("split", pa.int64()), ("seq", pa.int64()), ("piece", pa.binary())]),
            )

    lines = read_pieces(spark, path).join(owned.select("file", "split").distinct(), ["file", "split"], "left_semi")
    again = lines.select("piece", "file", "split").mapInArrow(content, "file string, split long, seq long, piece binary")
    whole = again.join(owned, keys).groupBy("file", "_record").agg(F.array_sort(F.collect_list(F.struct("start", "piece"))).alias("parts"))

    def join(batches):
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            rows = []
            for parts in batch.column("parts").to_pylist():
                found = parse(_SEP.join(p["piece"] for p in parts), parts[0]["start"] == 0)
                size, digest = payload_of(found)
                rows.append({**{k: found[k] for k in RECORD[:3]}, "payload_bytes": size, "payload_digest": digest})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(zip(RECORD, kinds))))

    return whole.select("parts").mapInArrow(join, "page_id long, kind string, refers_to long, payload_bytes long, payload_digest string")


def round_trip(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """Write all pages to archives on the shared folder and return what `read_archives` finds in them."""
    path = work_dir(pages.sparkSession, "warc")
    write_archives(pages, path, revisit_bytes)
    return read_archives(pages.sparkSession, path)
