"""Web archives: write pages as segmented, chunked records, read them back and reassemble."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = b"\r\n\r\n"
#: Bytes of a record's block beyond which it continues in further records, and of a transfer chunk.
SEGMENT = 16_384
CHUNK = 4_096
_DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at:at + size]
        parts.append(b"%x\r\n%b\r\n" % (len(piece), piece))
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over, a broken frame raises."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(parts)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk is not as long as it says")
        parts.append(body[at:at + size])
        at += size + 2


def _record(kind: str, uid: str, uri: str, block: bytes, more: dict[str, str]) -> bytes:
    """A record without the four bytes that end it."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uid}>", "WARC-Date": _DATE, "WARC-Target-URI": uri, **more, "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block


def records(uid: str, uri: str, payload: bytes, refers_uri: str | None, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    more = {"WARC-Payload-Digest": f"sha1:{digest(payload)}"}
    if refers_uri is not None:
        more |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To-Target-URI": refers_uri, "WARC-Refers-To-Date": _DATE}
        yield _record("revisit", uid, uri, _HTTP, more | {"Content-Type": "application/http; msgtype=response"})
        return
    block = _HTTP + chunked(payload)
    pieces = [block[k:k + segment] for k in range(0, len(block), segment)]
    for k, piece in enumerate(pieces):
        if not k:
            more |= {"Content-Type": "application/http; msgtype=response"}
            yield _record("response", uid, uri, piece, more | ({"WARC-Segment-Number": "1"} if len(pieces) > 1 else {}))
            continue
        link = {"WARC-Segment-Origin-ID": f"<urn:uuid:{uid}>", "WARC-Segment-Number": str(k + 1)}
        if k == len(pieces) - 1:
            link["WARC-Segment-Total-Length"] = str(len(block))
        yield _record("continuation", str(uuid.uuid5(uuid.UUID(uid), str(k))), uri, piece, link)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", payload: str = "html", least: int = 0, segment: int = SEGMENT) -> None:
    """Write one record per row (and its continuations) to gzipped archives below ``path``.

    Of rows with equal payloads of at least ``least`` bytes, those with the smallest
    page_id are responses and the others revisits of it; a null id counts as larger
    than any other. Null payloads are empty. A row that repeats a page and its
    payload is written again as what the first is. Other columns are not read.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    # the groups are counted by digest; only the join to their smallest page moves payloads
    sums = rows.select("page_id", F.sha2("payload", 256).alias("sum"), F.octet_length("payload").alias("size")).where(F.col("size") >= least)
    first = sums.groupBy("sum").agg(F.min("page_id").alias("first"), F.count("*").alias("rows")).where("rows > 1").select("sum", "first")
    named = rows.withColumn("sum", F.sha2("payload", 256)).join(first, "sum", "left")
    chosen = named.withColumn("refers", F.expr(f"if(octet_length(payload) >= {int(least)} and first is not null and not (page_id <=> first), first, null)"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a row's number can't serve as its id, as a task that is run again may see its rows in another order
        for frame in frames:
            out = []
            for page, page_payload, refers in zip(frame["page_id"], frame["payload"], frame["refers"]):
                out += records(str(uuid.uuid4()), _uri(page), bytes(page_payload), None if pd.isna(refers) else _uri(refers), segment)
                if len(out) >= 500:
                    yield pd.DataFrame({"value": out})
                    out = []
            if out:
                yield pd.DataFrame({"value": out})

    chosen.select("page_id", "payload", "refers").mapInPandas(run, "value binary").select(F.col("value").cast("string").alias("value")) \
        .write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


def _uri(page: object) -> str:
    return "urn:page:" + ("" if pd.isna(page) else str(int(page)))


def parse(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and block of each record of a stream that was cut at every ``END``.

    Lengths decide where a record ends, whatever its block holds.
    """
    piece = next(pieces, None)
    while piece is not None:
        piece = piece.lstrip(b"\r\n")
        if not piece:
            piece = next(pieces, None)
            continue
        if not piece.startswith(b"WARC/"):
            raise ValueError("no record begins here")
        head = dict(line.split(": ", 1) for line in piece.decode().split("\r\n")[1:])
        length, parts, held = int(head["Content-Length"]), [], 0
        for n, part in enumerate(pieces):
            part = part if not n else END + part
            parts.append(part)
            held += len(part)
            if held >= length:
                break
        if held < length:
            raise ValueError("record is not as long as it says")
        block = b"".join(parts)
        yield head, block[:length]
        # a block that ends in a line end is cut two bytes early, and the next record's head follows at once
        piece = block[length:].lstrip(b"\r\n") or next(pieces, None)


_SEGMENT_COLUMNS = "origin string, number int, total long, type string, uri string, refers string, digest string, block binary"


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives; each file is read in order by one task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream = (bytes(v) for frame in frames for v in frame["value"])
        out: list[tuple] = []
        for head, block in parse(stream):
            out.append((
                head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"]), int(head.get("WARC-Segment-Number", 1)),
                int(head["WARC-Segment-Total-Length"]) if "WARC-Segment-Total-Length" in head else None if "WARC-Segment-Number" in head else len(block),
                head["WARC-Type"], head["WARC-Target-URI"], head.get("WARC-Refers-To-Target-URI"), head.get("WARC-Payload-Digest"), block))
            if len(out) >= 500:
                yield _segment_frame(out)
                out = []
        if out:
            yield _segment_frame(out)

    return spark.read.option("lineSep", END.decode()).text(path).select(F.col("value").cast("binary").alias("value")).mapInPandas(run, _SEGMENT_COLUMNS)


def _segment_frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _SEGMENT_COLUMNS.split(", ")])
    return frame.astype({"total": "Int64"})


def reassembled(segments: DataFrame) -> DataFrame:
    """One row per logical record: segments grouped by origin, ordered, joined and checked against the total length.

    A record whose segments are not 1 to n, or not as long as the last one says,
    has ``complete`` false and stays. The segments of one record are as large as
    the page they come from.
    """
    parts = segments.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        *[F.min(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("type", "uri", "refers", "digest")])
    # one buffer for all parts, any bytes; folding them by concat would copy the block again for each part
    block = F.expr("cast(array_join(transform(parts, p -> cast(p.block as string)), '') as binary)")
    whole = F.expr("transform(parts, p -> p.number) = sequence(1, size(parts))")
    return parts.withColumn("block", block).select(
        "origin", "type", "uri", "refers", "digest", "block",
        (whole & F.coalesce(F.octet_length("block") == F.col("total"), F.lit(False))).alias("complete"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page in the archives: ``page_id, record_type, refers_to, payload, payload_digest`` (null payload in a revisit).

    The transfer framing is decoded; a payload that does not fit its digest, or a
    record that is not complete, fails the job.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for kind, uri, refers, said, block, complete in zip(*[frame[c] for c in ("type", "uri", "refers", "digest", "block", "complete")]):
                if not complete:
                    raise ValueError(f"{uri}: segments are missing")
                payload = None
                if kind == "response":
                    head, _, body = bytes(block).partition(END)
                    payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                    if f"sha1:{digest(payload)}" != said:
                        raise ValueError(f"{uri}: payload does not fit its digest")
                out.append((_page(uri), kind, _page(refers), payload, said.removeprefix("sha1:")))
            yield pd.DataFrame(out, columns=["page_id", "record_type", "refers_to", "payload", "payload_digest"]).astype({"page_id": "Int64", "refers_to": "Int64"})

    return reassembled(read_segments(spark, path)).drop("origin").mapInPandas(run, "page_id long, record_type string, refers_to long, payload binary, payload_digest string")


def _page(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("urn:page:")
    return int(number) if number else None


def resolved(read: DataFrame) -> DataFrame:
    """The pages with ``payload_bytes`` of the full payload; a revisit takes it from the response it refers to."""
    sized = read if "payload_bytes" in read.columns else read.withColumn("payload_bytes", F.octet_length("payload").cast("long")).drop("payload")
    answers = sized.where("record_type = 'response'").select(
        F.col("page_id").alias("answer"), F.col("payload_digest").alias("answer_digest"), F.col("payload_bytes").alias("answer_bytes")).distinct()
    same = (sized["refers_to"] == answers["answer"]) & (sized["payload_digest"] == answers["answer_digest"])
    return sized.join(answers, same, "left").select(
        "page_id", F.coalesce("payload_bytes", "answer_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
