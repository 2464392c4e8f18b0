"""WARC archives with an index of byte ranges, written first and read through.

Each task writes archives of its own and returns an index row per record: file,
offset, length, URL and digest. Only files named by a committed index count, so
what a lost or repeated task has left is never read. Reading sorts the selected
records by file and offset and fetches neighbouring ranges in one read.
"""

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import saved, small_batches, text_of
from matchlive.workspace import new_run_dir

#: Equal payloads of fewer bytes are all stored.
REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20
#: Ranges with at most so much between them are read together, up to so much at once.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: A task reads the records that begin in some stretches of files, of about so many bytes in all.
STRETCH_BYTES, TASK_BYTES = 8 << 20, 16 << 20
#: Up to so many revisits are broadcast to the writers (some 40 MB); more are joined by a shuffle.
BROADCAST_REVISITS = 400_000
#: The tables have no time of their own.
DATE = "1970-01-01T00:00:00Z"

INDEX = "file string, offset long, length long, url string, digest string"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One compressed record. A revisit keeps the HTTP header, with the length, and leaves the payload out."""
    target = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {target}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields[2:2] = [f"WARC-Profile: {profile}", f"WARC-Refers-To: {record_id(refers_to)}"]
    packer = zlib.compressobj(1, wbits=31)
    whole = "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def parsed(data: bytes) -> dict:
    head, _, rest = zlib.decompress(data, wbits=31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(line for line in http.decode().split("\r\n") if line.startswith("Content-Length: "))
    url, refers = fields.get("WARC-Target-URI"), fields.get("WARC-Refers-To")
    response = fields["WARC-Type"] == "response"
    return {
        "page_id": page_of(fields["WARC-Record-ID"]),
        "url": url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "record_type": fields["WARC-Type"],
        "refers_to": page_of(refers) if refers else None,
        "payload_bytes": int(length.partition(": ")[2]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "payload": payload if response else None,
    }


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of pages whose payload a page with a smaller id has too."""
    slim = saved(pages.where(F.col("size") >= REVISIT_BYTES).select("page_id", "digest"), "page-digests")
    first = slim.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    several = first.where("refers_to < last").drop("last")
    return slim.join(several, "digest").where("page_id > refers_to").distinct()


def write_archives(pages: DataFrame) -> DataFrame:
    """Writes a record per row of (page_id, url, html) to the shared folder; returns the saved index.

    Of equal payloads of at least REVISIT_BYTES bytes the page with the smallest
    id is stored, the others become revisits of it; rows repeated with that id
    are stored again. Null html is an empty payload; a null id is stored and
    never referred to; a null URL has no target. Extra columns are left out.
    """
    payload = text_of("html")
    rows = small_batches(pages).select("page_id", "url", payload.alias("html"), F.sha2(payload, 256).alias("digest"))
    again = saved(revisits(rows.withColumn("size", F.octet_length("html"))), "revisits")
    few = again.limit(BROADCAST_REVISITS + 1).count() <= BROADCAST_REVISITS
    marked = rows.join(F.broadcast(again) if few else again, ["page_id", "digest"], "left")
    folder = new_run_dir(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = fs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                found: dict[str, list] = {"file": [], "offset": [], "length": [], "url": [], "digest": []}
                for row in zip(*(batch.column(i) for i in range(batch.num_columns)), strict=True):
                    page_id, url, html, digest, refers = row
                    if out is None or offset > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{place}/{name}", compression=None)
                    body = html.as_buffer().to_pybytes()
                    data = record(page_id.as_py(), url.as_py(), body, digest.as_py(), refers.as_py())
                    out.write(data)
                    for key, value in zip(found, (name, offset, len(data), url.as_py(), digest.as_py()), strict=True):
                        found[key].append(value)
                    offset += len(data)
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, kind) for v, kind in zip(found.values(), kinds, strict=True)], names=list(found)
                )
        finally:
            if out is not None:
                out.close()

    index = marked.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(write, INDEX)
    return saved(index.withColumn("file", F.concat(F.lit(folder + "/"), "file")), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """The records that rows of an index name: page_id, url, record_type, refers_to, payload and its length and digest.

    A revisit has no payload of its own; its length and digest are those of the
    payload it stands for.
    """
    stretch = F.expr(f"offset div {STRETCH_BYTES}").alias("stretch")
    # adaptive execution would merge these tasks by the size of the index, not of the archives
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES))
    wanted = index.select("file", stretch, "offset", "length").repartition(tasks, "file", "stretch")

    def runs(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        name, run = "", []
        for file, offset, length in rows:
            end = run[-1][0] + run[-1][1] if run else 0
            if run and (file != name or offset - end > GAP_BYTES or offset + length - run[0][0] > READ_BYTES):
                yield name, run
                run = []
            name = file
            run.append((offset, length))
        if run:
            yield name, run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (zip(*(batch.column(n).to_pylist() for n in ("file", "offset", "length"))) for batch in batches)
        opened, source = "", None
        for name, run in runs(row for rows in columns for row in rows):
            if name != opened:
                files, place = fs.FileSystem.from_uri(name)
                opened, source = name, files.open_input_file(place)
            begin = run[0][0]
            data = source.read_at(run[-1][0] + run[-1][1] - begin, begin)
            found = [parsed(data[at - begin : at - begin + length]) for at, length in run]
            yield pa.RecordBatch.from_pylist(found, schema)

    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
        ]
    )
    return wanted.sortWithinPartitions("file", "offset").mapInArrow(
        read,
        "page_id long, url string, record_type string, refers_to long, "
        "payload_bytes long, payload_digest string, payload binary",
    )
