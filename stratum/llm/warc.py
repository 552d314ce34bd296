"""WARC archives: a writer, and a reader whose tasks take byte ranges of the files.

Writing. A record is one gzip member. Spark's text writer puts the members into files, with
its commit protocol, on any file system that Spark knows: the line separator is the zero
byte, and a member below 16 MiB of content ends in a zero byte (the top byte of its length
field), which the row therefore leaves to the separator. A larger record ends in a second,
small member that holds its last four bytes.

Reading. The files' lengths are listed by Spark and cut into ranges; a task looks in its
range for the gzip magic, takes a place for a record only if it decodes to a WARC header,
and then owns that record, reading past the end of its range as needed. Ranges are read
by ``pyarrow.fs`` through one buffer per file, so a small record costs no read of its own,
and memory follows the longest record.

Defined results: null payloads are empty; a null page id or URL is left out of the record;
payloads below ``REVISIT_BYTES`` are never revisits; of equal payloads the rows with the
smallest page id are responses (also where rows repeat), rows without a page id revisit it
if there is one; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.joins import sized_broadcast
from stratum.session import ensure_checkpoint_dir

REVISIT_BYTES = 100
MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES = 32 << 20
READ_BYTES = 1 << 20
STEP_BYTES = 1 << 14
TAIL = b"\r\n\r\n"
LARGE = 1 << 24
# fixed values of the format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "1970-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = WARC_DATE) -> bytes:
    """A response, or a revisit of the page ``refers_to``, as gzip members."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    urn = lambda n: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {n}')}>"
    head = ["WARC/1.1", "WARC-Type: " + ("response" if refers_to is None else "revisit"),
            f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {date}",
            "WARC-Payload-Digest: sha256:" + hashlib.sha256(payload).hexdigest()]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {urn(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    body = "\r\n".join(head).encode("utf-8") + block + TAIL
    parts = [body] if len(body) < LARGE else [body[:-len(TAIL)], TAIL]
    return b"".join(member(p) for p in parts)


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def revisits(pages: DataFrame, id_col: str, payload: str, least: int = REVISIT_BYTES) -> DataFrame:
    """(page, digest, refers_to) of the rows whose payload a smaller page id holds.

    Only ids and digests are shuffled, combined in their tasks; the equi-join back to the
    digests of a payload that very many rows share is split by adaptive execution.
    """
    rows = pages.select(
        F.col(id_col).alias("page"), F.sha2(F.col(payload), 256).alias("digest"),
        F.octet_length(F.col(payload)).alias("n")).filter(F.col("n") >= least)
    first = (rows.groupBy("digest").agg(F.min("page").alias("refers_to"), F.count("*").alias("c"))
             .filter("c > 1 and refers_to is not null").select("digest", "refers_to"))
    later = F.col("page").isNull() | (F.col("page") > F.col("refers_to"))
    return rows.join(first, "digest").filter(later).select("page", "digest", "refers_to").distinct()


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> None:
    """One record per row into files below ``folder``."""
    base = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.encode(F.col(html).cast("string"), "UTF-8"), F.lit(b"")).alias("payload"))
    base = base.withColumn("digest", F.sha2("payload", 256))
    # within the broadcast bound the payloads are not shuffled to learn what they repeat
    again = sized_broadcast(revisits(base, "page", "payload").checkpoint())
    rows = base.join(again, base["page"].eqNullSafe(again["page"]) & (base["digest"] == again["digest"]), "left").select(
        base["page"], "url", "payload", "refers_to")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        num = lambda x: None if pd.isna(x) else int(x)
        for b in batches:
            yield pd.DataFrame({"value": [
                record(num(p), u if isinstance(u, str) else None, bytes(h), num(r))[:-1]
                for p, u, h, r in zip(b["page"], b["url"], b["payload"], b["refers_to"])]})

    # ids travel as text, for a null among them would turn the rest into floats
    text = rows.select(*[F.col(c).cast("string").alias(c) if c in ("page", "refers_to") else F.col(c)
                         for c in rows.columns])
    members = text.mapInPandas(run, "value binary")
    members.select(F.col("value").cast("string")).write.option("lineSep", "\u0000").option(
        "compression", "none").text(folder)


def _open(path: str):
    """A random-access file of any store that pyarrow reaches."""
    parts = urlsplit(path)
    uri = path if parts.scheme not in ("", "file") else "file://" + parts.path
    store, name = pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return store.open_input_file(name)


class Buffered:
    """Reads of a file through a buffer of ``READ_BYTES`` that follows the reader."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.start, self.data = 0, b""

    def read_at(self, n: int, at: int) -> bytes:
        """Up to ``n`` bytes from ``at``; enough to hold the magic, unless the file ends."""
        skip = at - self.start
        if skip < 0 or len(self.data) - skip < min(len(MAGIC), self.size - at):
            self.data = self.source.read_at(min(READ_BYTES, self.size - at), at)
            self.start, skip = at, 0
        return self.data[skip:skip + n]


def _decode(source, at: int, size: int) -> tuple[bytes, int]:
    """Content of the gzip member at ``at`` and the place behind it; zlib.error if none begins there."""
    unpack, out = zlib.decompressobj(31), []
    while not unpack.eof:
        if at >= size:
            raise zlib.error("cut member")
        data = source.read_at(STEP_BYTES, at)
        out.append(unpack.decompress(data))
        if len(out) == 1 and out[0] and not b"WARC/".startswith(out[0][:5]) and out[0][:4] != TAIL:
            raise zlib.error("no record")
        at += len(data) - len(unpack.unused_data)
    return b"".join(out), at


def _headers(block: bytes) -> tuple[dict[str, str], int]:
    """Lower-cased header fields up to the empty line, and where the rest begins."""
    end = block.find(TAIL)
    if end < 0:
        raise zlib.error("no header")
    lines = block[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = (x.split(":", 1) for x in lines if ":" in x)
    return {k.strip().lower(): v.strip() for k, v in fields}, end + len(TAIL)


def _record_at(source, at: int, size: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header, block and end of the record at ``at``; None if no valid one begins there."""
    try:
        data, end = _decode(source, at, size)
        if not data.startswith(b"WARC/"):
            return None
        head, body = _headers(data)
        need = int(head["content-length"])
        while len(data) < body + need + len(TAIL):
            more, end = _decode(source, end, size)
            data += more
    except (zlib.error, KeyError, ValueError):
        return None
    if "warc-type" not in head or data[body + need:] != TAIL:
        return None
    return head, data[body:body + need], end


def records_in(source, size: int, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records that begin in [start, end)."""
    source, at = Buffered(source, size), start
    while at < end:
        window = source.read_at(STEP_BYTES, at)
        hit = window.find(MAGIC)
        if hit < 0 or at + hit >= end:
            # the magic may straddle two windows
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += hit
        found = _record_at(source, at, size)
        if found is None:
            at += 1
        else:
            yield found[0], found[1]
            at = found[2]


def read(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(type, page_id, url, refers_to, http_length, digest, payload) per record below ``folder``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    ranges = files.filter("length > 0").select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    # one range a task: they are few, and each stands for range_bytes of reading
    n = max(1, -(-(files.agg(F.sum("length")).first()[0] or 0) // range_bytes))
    ranges = ranges.repartition(max(n, spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["type", "page_id", "url", "refers_to", "http_length", "digest", "payload"]
        for b in batches:
            for path, size, start in zip(b["path"], b["length"], b["start"]):
                with _open(path) as source:
                    rows, held = [], 0
                    for head, block in records_in(source, size, start, min(size, start + range_bytes)):
                        http, body = _headers(block)
                        rows.append((head["warc-type"], head.get("x-page-id"), head.get("warc-target-uri"),
                                     head.get("x-refers-to-page-id"), http.get("content-length"),
                                     head.get("warc-payload-digest", "").removeprefix("sha256:"), block[body:]))
                        held += len(block)
                        if held > 8 * READ_BYTES:
                            yield pd.DataFrame(rows, columns=cols)
                            rows, held = [], 0
                    yield pd.DataFrame(rows, columns=cols)

    out = ranges.mapInPandas(run, "type string, page_id string, url string, refers_to string, "
                                  "http_length string, digest string, payload binary")
    return out.select("type", F.col("page_id").cast("long"), "url", F.col("refers_to").cast("long"),
                      F.col("http_length").cast("long"), "digest", "payload")


def archive_folder(spark: SparkSession) -> str:
    """A new folder for an archive, in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4()}"


def round_trip(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html",
               folder: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write ``pages``, read the archive back, and return a row per record read.

    A response's size and digest are taken from the payload read; a revisit's from its headers.
    """
    spark = pages.sparkSession
    folder = folder or archive_folder(spark)
    write(pages, folder, id_col, url, html)
    full = F.col("type") == "response"
    return read(spark, folder, range_bytes).select(
        F.col("page_id").alias(id_col),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")
