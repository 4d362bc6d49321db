"""WARC archives compressed with Zstandard, one frame per record, with a dictionary.

An archive starts with a skippable frame that holds the dictionary, itself
compressed; every later frame is one record. A page whose payload was already
written is a revisit that refers to the first. Archives are written and read by
the executors through the file system of their folder's address, a record at a
time, and rolled over at a size, so that an archive is never held whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.llm.tables import join_unique
from tunetables.operators.staging import materialise, stage_path

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_DIGEST = "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"

#: an archive is closed when it has so many bytes
ROLL = 64 << 20
#: payload bytes, at most, that a dictionary is trained from, and its size
TRAIN_BYTES, DICTIONARY_BYTES = 2 << 20, 32 << 10
#: bytes read at once
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive that breaks its format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digest_column(payload):
    """The bare base-32 SHA-1 of a binary column."""

    @F.pandas_udf("string")
    def run(values):
        return values.map(lambda b: EMPTY_DIGEST if b is None else digest(bytes(b)))

    return run(payload)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address, and the path in it; Spark writes local
    addresses with one slash or three."""
    local = re.fullmatch(r"file:/+(.*)", folder)
    if local or "://" not in folder:
        return pafs.LocalFileSystem(), f"/{local[1]}" if local else folder
    return pafs.FileSystem.from_uri(folder)


def address(page_id: int | None, row: str | None) -> str:
    """A record's id: its page's, if it has one, and the row's key where pages have many rows."""
    return f"<urn:page:{'' if page_id is None else page_id}{'' if row is None else f':{row}'}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, sha1: str, size: int, refers_to: int | None, row: str | None = None, refers_row: str | None = None
) -> bytes:
    """A response record with the payload, or a revisit with its headers alone."""
    first = refers_to is None and refers_row is None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload if first else b"")
    head = [("WARC-Type", "response" if first else "revisit"), ("WARC-Record-ID", address(page_id, row)), ("WARC-Date", DATE)]
    if url is not None:
        # a header value is one line
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    head.append(("WARC-Payload-Digest", f"sha1:{sha1}"))
    if not first:
        head += [("WARC-Refers-To", address(refers_to, refers_row)), ("WARC-Profile", PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = b"".join(f"{k}: {v}\r\n".encode("utf-8", "surrogatepass") for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary, or none where the samples are too few or too alike for one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples) if len(samples) >= 8 else None
    except zstandard.ZstdError:
        return None


class Archive:
    """One archive being written; it gets its name when it is whole."""

    def __init__(self, folder: str, dictionary: zstandard.ZstdCompressionDict | None):
        self.fs, root = _filesystem(folder)
        self.fs.create_dir(root, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.path, self.size = f"{root}/{self.name}", 0
        self.out = self.fs.open_output_stream(self.path + ".open", compression=None)
        self.pack = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True)
        if dictionary is not None:
            held = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
            self._write(struct.pack("<II", SKIPPABLE, len(held)) + held)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self._write(self.pack.compress(data))

    def close(self) -> str:
        self.out.close()
        self.fs.move(self.path + ".open", self.path)
        return self.name


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, payload, payload_digest, payload_bytes, refers_to, row, refers_row) rows;
    returns the table of whole archives (name, records, bytes), itself written, so
    that archives of tasks that were lost or run twice are not in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, archive, n, done = None, None, 0, []
        begun = False
        for batch in batches:
            rows = batch.to_pylist()
            if not begun:
                samples, used = [], 0
                for r in rows:
                    if r["payload"] and r["refers_to"] is None and used < TRAIN_BYTES:
                        samples.append(r["payload"][:CHUNK])
                        used += len(samples[-1])
                dictionary, begun = train(samples), True
            for r in rows:
                archive = archive or Archive(folder, dictionary)
                archive.add(record(r["page_id"], r["url"], r["payload"] or b"", r["payload_digest"], r["payload_bytes"], r["refers_to"], r["row"], r["refers_row"]))
                n += 1
                if archive.size >= ROLL:
                    done.append((archive.close(), n, archive.size))
                    archive, n = None, 0
        if archive:
            done.append((archive.close(), n, archive.size))
        names, counts, sizes = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["name", "records", "bytes"]
        )

    columns = ["page_id", "url", "payload", "payload_digest", "payload_bytes", "refers_to", "row", "refers_row"]
    return materialise(pages.select(*columns).mapInArrow(run, "name string, records long, bytes long"), "archives")


def _frames(read) -> Iterator[bytes]:
    """The decoded frames of an archive, the dictionary's applied."""
    held, unpack = read(CHUNK), None
    dictionary = None
    if held[:4] == struct.pack("<I", SKIPPABLE):
        if len(held) < 8:
            raise WarcError("cut inside the dictionary's frame")
        (size,) = struct.unpack("<I", held[4:8])
        while len(held) < 8 + size:
            more = read(CHUNK)
            if not more:
                raise WarcError("cut inside the dictionary")
            held += more
        data, held = held[8 : 8 + size], held[8 + size :]
        if data[:4] == FRAME_MAGIC:
            data = zstandard.ZstdDecompressor().decompress(data, max_output_size=64 << 20)
        dictionary = zstandard.ZstdCompressionDict(data)
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        held = held or read(CHUNK)
        if not held:
            return
        unpack, parts = decoder.decompressobj(), []
        while True:
            try:
                parts.append(unpack.decompress(held))
            except zstandard.ZstdError as e:
                raise WarcError(f"bad frame: {e}") from e
            if unpack.eof:
                held = unpack.unused_data
                break
            held = read(CHUNK)
            if not held:
                raise WarcError("cut inside a frame")
        yield b"".join(parts)


def parse(data: bytes) -> dict:
    """The validated record of one frame: its type, ids, url, payload and digest."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise WarcError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name.strip() != name:
            raise WarcError("bad header line")
        fields[name.decode("ascii", "replace").lower()] = value.strip().decode("utf-8", "surrogatepass")
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        raise WarcError(f"record type {kind}")
    for needed in ("warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if needed not in fields:
            raise WarcError(f"no {needed}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError("block length differs from the header")
    block = rest[:-4]
    http, gap, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length: *(\d+)\r?$", http)
    if not gap or not http.startswith(b"HTTP/") or not size:
        raise WarcError("no HTTP header")
    sha1 = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != int(size[1]) or digest(payload) != sha1):
        raise WarcError("payload differs from its digest or length")

    def addressed(name: str) -> re.Match | None:
        return re.fullmatch(r"<urn:page:(?:(-?\d+)(?::[0-9a-f]+-\d+)?|:[0-9a-f]+-\d+)>", fields.get(name, ""))

    def page(name: str) -> int | None:
        m = addressed(name)
        return int(m[1]) if m and m[1] else None

    if not addressed("warc-record-id") or kind == "revisit" and (not addressed("warc-refers-to") or payload or fields.get("warc-profile") != PROFILE):
        raise WarcError("ids or profile")
    return {
        "page_id": page("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": kind, "payload_bytes": int(size[1]),
        "payload_digest": sha1, "refers_to": page("warc-refers-to"), "payload": payload if kind == "response" else None,
    }


_FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
           ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of a table of archives (name, records), decoded frame by frame.
    Without ``payloads`` they are validated all the same, but not returned. A frame
    that is no valid record, or an archive with another number of records, fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in _FIELDS], [n for n, _ in _FIELDS])

        for listed in batches:
            for name, wanted in zip(listed.column("name").to_pylist(), listed.column("records").to_pylist(), strict=True):
                rows, held, n = [], 0, 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in _frames(stream.read):
                        try:
                            rows.append(parse(data))
                        except WarcError as e:
                            raise WarcError(f"{name}, record {n}: {e}") from e
                        n += 1
                        if not payloads:
                            rows[-1]["payload"] = None
                        held += len(rows[-1]["payload"] or b"") + 200
                        if held > 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if n != wanted:
                    raise WarcError(f"{name}: {n} records, not {wanted}")
                yield batch(rows)

    parts = max(1, archives.sparkSession.sparkContext.defaultParallelism)
    # an archive is a task's work; their names are a small table
    return archives.repartition(parts, "name").mapInArrow(run, SCHEMA)


def mark_rows(pages: DataFrame, least: int) -> DataFrame:
    """As ``mark_revisits`` with ``every_row``, of (page_id, url, payload) rows."""
    keyed = pages.withColumns({
        "page": F.coalesce("page_id", F.lit(0).cast("long")), "cell": F.xxhash64(F.col("page_id").isNull(), F.col("url").isNull(), "url", "payload")
    })
    marked = materialise(
        keyed.select("page", "cell", "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), digest_column(F.col("payload")).alias("payload_digest")),
        "digests",
    )
    # rows alike in every column are one cell and differ by their number
    cells = materialise(marked.groupBy(*marked.columns).agg(F.count("*").alias("n")), "digests")
    first = cells.groupBy("payload_digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "cell")).alias("first"))
    placed = join_unique(cells, materialise(first, "first"), ["payload_digest"]).drop("page_id")
    alike = cells.count() != marked.count()
    rows = (keyed.dropDuplicates(["page", "cell"]) if alike else keyed).join(materialise(placed, "placed"), ["page", "cell"])
    rows = rows.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)) if alike else F.lit(0))
    again = ~(F.col("first.page_id").eqNullSafe(F.col("page_id")) & (F.col("first.cell") == F.col("cell"))) | (F.col("nth") > 0)
    key = lambda cell, nth: F.concat(F.lower(F.hex(cell)), F.lit("-"), nth.cast("string"))
    revisit = (F.col("payload_bytes") >= least) & again
    return rows.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(revisit, F.col("first.page_id")).alias("refers_to"), key(F.col("cell"), F.col("nth")).alias("row"),
        F.when(revisit, key(F.col("first.cell"), F.lit(0))).alias("refers_row"),
    )


def mark_revisits(
    df: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", every_row: bool = False
) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to, row,
    refers_row): of pages with equal payloads of ``least`` bytes or more the
    smallest id is the first, and the others, with a null payload, refer to it.
    Null html is empty.

    With ``every_row`` each row is a page of its own, by the key ``row`` next to
    its id, which may repeat or be null; among equal payloads the smallest id and
    then key is the first, null ids last. Without it, rows that repeat an id are
    one page, of which the row of the smallest digest is kept, and rows without an
    id are left out; there are no keys then."""
    pages = df.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload")
    )
    if every_row:
        return mark_rows(pages, least)
    pages = pages.filter("page_id is not null")
    marked = materialise(
        pages.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), digest_column(F.col("payload")).alias("payload_digest"),
                     F.xxhash64("url", "payload").alias("row")), "digests"
    )
    one = materialise(
        marked.groupBy("page_id").agg(F.min(F.struct("payload_digest", "payload_bytes", "row")).alias("m")).select("page_id", "m.*"), "digests"
    )
    first = one.groupBy("payload_digest").agg(F.min("page_id").alias("first"))
    placed = join_unique(one, materialise(first, "first"), ["payload_digest"]).withColumn(
        "refers_to", F.when((F.col("payload_bytes") >= least) & (F.col("first") < F.col("page_id")), F.col("first"))
    ).drop("first")
    rows = pages.withColumn("row", F.xxhash64("url", "payload")).dropDuplicates(["page_id", "row"]) if one.count() != marked.count() else pages.withColumn(
        "row", F.xxhash64("url", "payload")
    )
    return rows.join(materialise(placed, "placed"), ["page_id", "row"]).withColumns({
        "payload": F.when(F.col("refers_to").isNull(), F.col("payload")), "row": F.lit(None).cast("string"), "refers_row": F.lit(None).cast("string")
    })


def round_trip(df: DataFrame, folder: str | None = None, least: int = 0, payloads: bool = False, every_row: bool = False) -> DataFrame:
    """Write the pages of ``df`` (page_id, url, html) as archives into ``folder``,
    by default a new one below the session's shared folder, and read them back;
    ``every_row`` as in ``mark_revisits``."""
    spark: SparkSession = df.sparkSession
    folder = folder or stage_path(spark, "warc")
    archives = write_archives(mark_revisits(df, least, every_row=every_row), folder)
    return read_archives(archives, folder, payloads)
