"""WARC archives of pages: writing, and reading back record by record.

Pages with equal payloads are told apart by digest and size: the smallest page
id is the response and the others are revisits of it. Payloads below
``LEAST_SHARED`` bytes are responses always.

Writing: pages are dealt to archives by a hash of their id, and each task writes
its archive to the work folder, one gzip member per record, under a name of its
own. The names that count are rows of a written table, so what a lost or
repeated task leaves behind is never read.

Reading is sequential and holds one record at a time: a member is inflated piece
by piece, the record's content length frames its block, and its payload's digest
is verified. A revisit has no payload; its digest and size are those of its own
headers. They are not compared with the response that it refers to.

A null html is an empty payload, a null url an empty one, and control characters
of urls are percent-encoded. A null page id is written as an empty one and read
back as null; it loses against any id. Rows that repeat a page are records of
their own and of the same type. Extra columns are ignored; an empty table makes
no archives and no rows.
"""

import hashlib
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseframe.llm.work import new_folder, written

LEAST_SHARED = 100
ARCHIVE_BYTES = 64 << 20
_READ = 1 << 16
_SALTS = 64

_RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, url string"
)


class WarcError(ValueError):
    """A record that is not framed as its headers say or fails its digest."""


def record(
    page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool
) -> bytes:
    """One record, uncompressed."""
    block = b"" if revisit else payload
    safe = "".join(c if c.isprintable() and c != " " else _escaped(c) for c in url)
    name = "" if page_id is None else str(page_id)
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Target-URI: {safe}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        target = "" if refers_to is None else str(refers_to)
        headers += [
            f"WARC-Refers-To: <urn:page:{target}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    headers.append(f"Content-Length: {len(block)}")
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _escaped(character: str) -> str:
    return "".join(f"%{byte:02X}" for byte in character.encode())


def members(stream):
    """Inflated content of each gzip member of a file, one at a time."""
    inflater, parts, rest = None, [], b""
    while True:
        piece = rest or stream.read(_READ)
        rest = b""
        if not piece:
            break
        if inflater is None:
            inflater, parts = zlib.decompressobj(wbits=31), []
        try:
            parts.append(inflater.decompress(piece))
        except zlib.error as error:
            raise WarcError(f"damaged member: {error}") from error
        if inflater.eof:
            rest, inflater = inflater.unused_data, None
            yield b"".join(parts)
    if inflater is not None:
        raise WarcError("the last member is cut off")


def parsed(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, checked against its length and digests."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] != "WARC/1.1":
        raise WarcError("not a WARC/1.1 record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    length = int(headers["Content-Length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise WarcError("the block is not as long as Content-Length says")
    digest = f"sha256:{hashlib.sha256(block).hexdigest()}"
    if digest != headers["WARC-Block-Digest"]:
        raise WarcError("the block does not have its digest")
    if headers["WARC-Type"] == "response" and digest != headers["WARC-Payload-Digest"]:
        raise WarcError("the payload does not have its digest")
    return headers, block


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _open(path: str):
    """File system and path of a URI; plain paths are local."""
    from pyarrow import fs

    if "://" not in path and path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _write_archives(folder: str):
    def run(frames):
        import uuid

        out = path = None
        archive, size, records = None, 0, 0
        for frame in frames:
            for page in frame.itertuples(index=False):
                if page.archive != archive:
                    if out is not None:
                        out.close()
                        yield pd.DataFrame({"path": [path], "bytes": [size], "records": [records]})
                    archive, size, records = page.archive, 0, 0
                    path = f"{folder}/{archive:06d}-{uuid.uuid4().hex}.warc.gz"
                    system, local = _open(path)
                    system.create_dir(local.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(local, compression=None)
                refers = None if pd.isna(page.refers_to) else int(page.refers_to)
                page_id = None if pd.isna(page.page_id) else int(page.page_id)
                content = record(
                    page_id, page.url, page.payload, page.digest, refers, bool(page.revisit)
                )
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(content) + packer.flush()
                out.write(member)
                size += len(member)
                records += 1
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [path], "bytes": [size], "records": [records]})

    return run


def _read_archives(with_payload: bool):
    def run(frames):
        for frame in frames:
            for path, records in zip(frame["path"], frame["records"], strict=True):
                system, local = _open(path)
                rows, seen = [], 0
                with system.open_input_stream(local, compression=None) as stream:
                    for content in members(stream):
                        headers, block = parsed(content)
                        refers = headers.get("WARC-Refers-To")
                        row = (
                            _page(headers["WARC-Record-ID"]),
                            int(headers["X-Payload-Length"]),
                            headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                            headers["WARC-Type"],
                            _page(refers) if refers else None,
                            headers["WARC-Target-URI"],
                        )
                        rows.append((*row, block) if with_payload else row)
                        seen += 1
                        if len(rows) == 1000:
                            yield _record_rows(rows, with_payload)
                            rows = []
                if seen != records:
                    raise WarcError(f"{path} has {seen} records, {records} were written")
                if rows:
                    yield _record_rows(rows, with_payload)

    return run


def _record_rows(rows: list[tuple], with_payload: bool) -> pd.DataFrame:
    names = [field.split()[0] for field in _RECORD.split(",")]
    frame = pd.DataFrame(rows, columns=[*names, *(["payload"] if with_payload else [])])
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages; ``path``, ``bytes``, ``records`` of each archive."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumns(
        {
            "digest": F.sha2("payload", 256),
            "size": F.octet_length("payload"),
            # Copies meet by page id first, so one payload's pages are spread.
            "salt": F.expr(f"cast(pmod(xxhash64(page_id), {_SALTS}) as int)"),
        }
    )
    # Two steps, so that a payload that very many pages share is not one task's.
    shared = rows.filter(F.col("size") >= LEAST_SHARED)
    first = (
        shared.groupBy("digest", "size", "salt")
        .agg(F.min("page_id").alias("low"), F.count("*").alias("n"))
        .groupBy("digest", "size")
        .agg(
            F.min("low").alias("first_id"),
            F.sum("n").alias("n"),
            F.collect_list("salt").alias("salts"),
        )
        .filter("n > 1")
    )
    first = written(first.select("digest", "size", "first_id", F.explode("salts").alias("salt")))
    total = rows.agg(F.sum("size")).first()[0] or 0
    archives = max(1, -(-int(total) // archive_bytes))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    archives = max(archives, width)
    dealt = rows.join(first, ["digest", "size", "salt"], "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.col("first_id").alias("refers_to"),
        (F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias(
            "revisit"
        ),
        F.expr(f"cast(pmod(xxhash64(page_id, digest, url), {archives}) as int)").alias("archive"),
    )
    folder = new_folder(spark)
    return written(
        dealt.repartition(width, "archive")
        .sortWithinPartitions("archive", "page_id")
        .mapInPandas(_write_archives(folder), "path string, bytes long, records long")
    )


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of the archives, each archive read by one task from its start to its end."""
    width = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = _RECORD + (", payload binary" if with_payload else "")
    return archives.repartition(width, "path").mapInPandas(_read_archives(with_payload), schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``url``."""
    return read_archives(write_archives(pages))
