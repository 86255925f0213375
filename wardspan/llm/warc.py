"""WARC archives: records written by Spark's text writer, read back by verifying record boundaries.

Every place where a record could start (the magic at the start of a header) is a candidate that
points at its successor: its own offset plus header and content length. Text inside a payload may
look like a header, so a candidate counts only if the chain from the start of its file reaches it.
The chains are followed by pointer jumping: after k rounds all records up to 2^k steps from a start
are known, and pointers reach 2^k steps further.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardspan.llm.common import fresh_name
from wardspan.runtime import stage

END = "\r\n"
BETWEEN = END * 2  # after a header, and after a record
MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
BLOCK = 1 << 20
HEAD = 1 << 16  # bytes of the next block that a block is read with
HEAD_MOST = 1 << 26  # a header, with the one of the payload, is at most this long
FILE_MOST = 1 << 30  # bytes of a file
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CANDIDATE = (
    "path string, offset long, successor long, length long, record_type string, page_id string, "
    "refers_to string, url string, said_digest string, said_bytes long, payload_bytes long, sha1 string"
)


def base32(sha1: Column) -> Column:
    """A hexadecimal SHA-1 in upper-case base32: each five hex digits make four characters."""
    pieces = [F.lpad(F.conv(F.substring(sha1, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*pieces), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def write_archive(
    pages: DataFrame, folder: str, least_bytes: int = 0, records_per_file: int = 4000
) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) as WARC files in ``folder``.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest page_id
    is a response and the others are revisits of it; rows that share that page_id too are all
    responses. A null html is an empty payload, a null url is left out, a null page_id comes after
    all others. Only digests that repeat are joined back. Files hold at most ``records_per_file``
    records, and fewer if the longest would make them larger than ``FILE_MOST``.
    """
    lengths = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("html", "url")]
    longest = (pages.agg(F.max(sum(lengths, F.lit(1024)).cast("long"))).first()[0] or 0)
    records_per_file = max(min(records_per_file, FILE_MOST // max(longest, 1)), 1)
    digest, keeper, n = (fresh_name(pages, c) for c in ("digest", "keeper", "n"))
    payload = F.coalesce("html", F.lit(""))
    pages = pages.withColumn(digest, base32(F.sha1(payload.cast("binary"))))
    repeated = (
        pages.filter(F.octet_length(payload) >= least_bytes)
        .groupBy(digest)
        .agg(F.max("page_id").alias(keeper), F.count(F.lit(1)).alias(n))
        .filter(F.col(n) > 1)
    )
    joined = pages.join(stage(repeated.select(digest, keeper), "warc-copies"), digest, "left")
    revisit = F.col(keeper).isNotNull() & ~F.col("page_id").eqNullSafe(F.col(keeper))

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value, F.lit(END))
        return F.coalesce(text, F.lit("")) if when is None else F.when(when, text).otherwise("")

    def page(name: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit(">"))

    url = F.translate(F.col("url"), "\r\n", "")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(BETWEEN),
    )
    body = F.concat(http, F.when(revisit, "").otherwise(payload))
    record = F.concat(
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", page("page_id")),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col(digest))),
        line("WARC-Profile", F.lit(_PROFILE), revisit),
        line("WARC-Refers-To", page(keeper), revisit),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(END),
        body,
    )
    writer = joined.select(record.alias("value")).write.option("lineSep", BETWEEN)
    writer.option("maxRecordsPerFile", records_per_file).text(folder)


@dataclass
class _Open:
    """A candidate whose payload is still being read."""

    row: dict
    at: int
    end: int
    sha: object = field(default_factory=hashlib.sha1)


def _fields(head: bytes) -> dict[bytes, bytes]:
    pairs = (x.split(b":", 1) for x in head.split(b"\r\n")[1:] if b":" in x)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _number(value: bytes | None) -> int | None:
    return int(value) if value and value.isdigit() and len(value) < 19 else None


class _Unfinished(Exception):
    """A header goes on after the data at hand."""


def _parse(data: bytes, at: int, start: int, path: str, length: int) -> _Open | None:
    """The candidate at ``at`` in ``data``, which begins at ``start`` in its file."""
    more = start + len(data) < length and len(data) - at < HEAD_MOST
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        if more:
            raise _Unfinished
        return None
    fields = _fields(data[at:head_end])
    size = _number(fields.get(b"content-length"))
    if size is None:
        return None
    body = head_end + 4
    http_end = data.find(b"\r\n\r\n", body, body + size)
    said, payload, http = None, body, fields.get(b"content-type", b"").startswith(b"application/http")
    if http and http_end < 0 and more and body + size > len(data):
        raise _Unfinished
    if http and http_end >= 0:
        payload = http_end + 4
        said = _number(_fields(data[body:http_end]).get(b"content-length"))
    text = {k: v.decode("utf-8", "replace") for k, v in fields.items()}
    row = {
        "path": path,
        "offset": start + at,
        "successor": start + body + size + 4,
        "length": length,
        "record_type": text.get(b"warc-type"),
        "page_id": text.get(b"warc-record-id"),
        "refers_to": text.get(b"warc-refers-to"),
        "url": text.get(b"warc-target-uri"),
        "said_digest": text.get(b"warc-payload-digest"),
        "said_bytes": said,
        "payload_bytes": body + size - payload,
    }
    return _Open(row, start + payload, start + body + size)


def _schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in _CANDIDATE.split(", "))])


def _candidates(block: int):
    """Blocks of files in order in, candidates out. A block is followed by HEAD bytes of the next
    one. A header that ends after these waits for the next block, and payloads that go on over blocks
    are hashed piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, path, waiting, begun = _schema(), None, [], []
        for batch in batches:
            done = []
            for k in range(batch.num_rows):
                name, length, start, data = (batch.column(i)[k].as_py() for i in range(4))
                if name != path:
                    path, waiting, begun = name, [], []  # what waits here was cut off at the end of its file
                # Beginnings of records as (their bytes so far, where they start), then new ones.
                starts = [(head + data, at, 0) for head, at in begun]
                hits = (m.start() for m in MAGIC.finditer(data, 0, min(len(data), block + 10)))
                starts += [(data, start, at) for at in hits if at < block]
                begun = []
                for text, origin, at in starts:
                    try:
                        one = _parse(text, at, origin, name, length)
                    except _Unfinished:
                        begun.append((text[at : start + block - origin], origin + at))
                        continue
                    if one:
                        waiting.append(one)
                still = []
                for one in waiting:
                    one.sha.update(data[max(0, one.at - start) : max(0, min(block, one.end - start))])
                    if one.end <= start + min(block, len(data)):
                        done.append(one.row | {"sha1": one.sha.hexdigest()})
                    else:
                        still.append(one)
                waiting = still
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    return run


def reachable(candidates: DataFrame) -> DataFrame:
    """(path, offset) of the candidates (path, offset, successor) on the chain from offset 0.

    Pointers grow with the archive, and their paths pack far tighter in files than in memory, so that
    file sizes say little: every join is a shuffled one.
    """
    pointers = candidates.select("path", "offset", F.col("successor").alias("next"))
    known = candidates.select("path", "offset")
    starts = known.withColumnRenamed("offset", "next")
    jump = stage(pointers.join(starts.hint("merge"), ["path", "next"], "left_semi"), "warc-jumps")
    reached = stage(known.filter("offset = 0"), "warc-reached")
    while True:
        ahead = reached.join(jump.hint("merge"), ["path", "offset"]).select("path", F.col("next").alias("offset"))
        more = stage(ahead, "warc-reached")
        if more.isEmpty():
            return reached
        reached = reached.unionByName(more)
        further = jump.select("path", F.col("offset").alias("next"), F.col("next").alias("far"))
        jump = stage(
            jump.join(further.hint("merge"), ["path", "next"]).select("path", "offset", F.col("far").alias("next")),
            "warc-jumps",
        )


def read_archive(spark: SparkSession, folder: str, block: int = BLOCK) -> DataFrame:
    """All records of the WARC files in ``folder``: record_type, page_id, refers_to, url, the digest
    and size the header names, and those of the payload as it stands in the file.

    Files are read as a whole by the JVM (at most 2 GB each) and in blocks by Python. Headers are at
    most ``HEAD_MOST`` bytes. Raises if the chain of a file does not end where the file ends.
    """
    files = spark.read.format("binaryFile").load(folder).filter("length > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block).cast("long"))
    blocks = files.select("path", "length", "content", F.explode(starts).alias("start"))
    cut = F.substring(F.col("content"), (F.col("start") + 1).cast("int"), F.lit(block + HEAD))
    found = blocks.select("path", "length", "start", cut.alias("data")).mapInArrow(_candidates(block), _CANDIDATE)
    found = stage(found, "warc-candidates")
    real = reachable(found).hint("merge")
    records = stage(found.join(real, ["path", "offset"], "left_semi"), "warc-records")
    ends = files.select("path", "length").join(
        records.filter("successor = length").select("path"), "path", "left_anti"
    )
    broken = ends.limit(3).collect()
    if broken:
        raise ValueError(f"records do not lead to the end of {[r['path'] for r in broken]}")
    return records


def page_digests(records: DataFrame) -> DataFrame:
    """One row per record of a page archive: what its full payload is, and what it refers to."""

    def page(name: str) -> Column:
        return F.expr(f"try_cast(regexp_extract({name}, '^<urn:page:(.*)>$', 1) AS bigint)")

    stored = F.col("record_type") == "response"
    return records.select(
        page("page_id").alias("page_id"),
        F.when(stored, F.col("payload_bytes")).otherwise(F.col("said_bytes")).alias("payload_bytes"),
        F.when(stored, base32(F.col("sha1")))
        .otherwise(F.regexp_replace("said_digest", "^sha1:", ""))
        .alias("payload_digest"),
        "record_type",
        F.when(~stored, page("refers_to")).alias("refers_to"),
    )
