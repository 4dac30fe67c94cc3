"""WARC archives as a Spark data source (``format("warc")``).

Writing: every task writes its own record-compressed files (one gzip member a
record, rolled at ``roll_bytes``) into the folder ``_parts``. The driver's commit
writes one new list of the finished files beside the others, under another name
first, and renames it. Only listed files of ``_parts`` are read, so a write still
going on, a failed one, and files of a lost or repeated task read as nothing;
writers that append at once lose none of each other's files. An overwrite names
in its list what it replaces, and deletes that once the list stands. Each member
carries its compressed length in an ``sl`` extra field.

Reading: files are planned into partitions of about ``partition_bytes``.
Predicates on the record type and on header columns are pushed into the
reader. It inflates a record only up to the end of its header block, and skips
to the next member where a predicate rejects the record or its payload isn't
wanted (``payload=none``); an archive of another writer, without the extra
field, is inflated to the member's end but not decoded. Plain ``.warc`` files
are read too.

Defined results: a null payload is empty; a null url writes no target header;
line ends in header values become %0D and %0A; a null identifier ranks below
all others. Of rows that repeat both identifier and payload, one may be the
response (of those with the largest url) and the others revisit it. An empty table writes an empty archive
that reads as no rows. Extra columns are not written.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import written

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, payload_digest string, "
    "payload_bytes long, refers_to string, headers map<string,string>, payload binary, file string, file_offset long"
)
#: What a frame needs to be written; see :func:`archive_pages`.
WRITE_COLUMNS = ["record_id", "record_type", "target_uri", "warc_date", "payload_digest", "payload_bytes", "refers_to", "payload"]
# Header names of the format (X-Payload-Length is an extension).
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "payload_bytes": "X-Payload-Length",
}
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARTS, LISTS = "_parts", "_lists"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def committed(fs: pafs.FileSystem, root: str) -> tuple[list[tuple[str, int]], list[str]]:
    """The archives of a folder that are to be read, as (place in it, size), and
    all that an overwrite replaces: archives first, then the lists of them."""
    lists = {}
    for i in fs.get_file_info(pafs.FileSelector(f"{root}/{LISTS}", allow_not_found=True)):
        if i.path.endswith(".json"):
            with fs.open_input_stream(i.path, compression=None) as f:
                lists[f"{LISTS}/{i.base_name}"] = json.loads(f.read())
    files = {f"{PARTS}/{name}": size for one in lists.values() for name, size in one["files"]}
    for i in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
        name = i.path[len(root.rstrip("/")) + 1 :]
        if i.type == pafs.FileType.File and name.endswith((".warc", ".warc.gz")) and not any(x[0] in "_." for x in name.split("/")):
            files[name] = i.size
    gone = {name for one in lists.values() for name in one["replaces"]}
    return [f for f in files.items() if f[0] not in gone], [*files, *lists]


# ------------------------------------------------------------ records
def record_block(row: dict) -> bytes:
    clean = lambda v: str(v).replace("\r", "%0D").replace("\n", "%0A")
    revisit = row["record_type"] == "revisit"
    body = HTTP_HEAD + (b"" if revisit else row["payload"] or b"")
    lines = ["WARC/1.1"] + [f"{name}: {clean(row[col])}" for col, name in HEADERS.items() if row.get(col) is not None]
    lines += [f"WARC-Profile: {SAME_PAYLOAD}"] * revisit
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def gzip_member(block: bytes, level: int = 6) -> bytes:
    """One gzip member whose ``sl`` field has its own and the block's length."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    data = deflate.compress(block) + deflate.flush()
    size = 10 + 2 + 12 + len(data) + 8
    extra = b"sl" + struct.pack("<HII", 8, size, len(block) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + data + struct.pack("<II", zlib.crc32(block), len(block) & 0xFFFFFFFF)


def parse_header(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def skip_length(head: bytes) -> int:
    """The member's length from its ``sl`` field; 0 if it has none."""
    if not head[3] & 4:
        return 0
    (total,) = struct.unpack_from("<H", head, 10)
    at, end = 12, min(12 + total, len(head))
    while at + 4 <= end:
        (n,) = struct.unpack_from("<H", head, at + 2)
        if head[at : at + 2] == b"sl" and n >= 4 and at + 8 <= end:
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + n
    return 0


class _Inflated:
    """Bytes of one gzip member, inflated only as far as they are asked for."""

    STEP = 8192

    def __init__(self, file, start: int):
        self.file, self.at, self.z, self.held = file, start, zlib.decompressobj(31), b""

    def more(self) -> bool:
        if self.z.eof:
            return False
        data = self.z.unconsumed_tail
        if not data:
            data = self.file.read_at(self.STEP, self.at)
            self.at += len(data)
            if not data:
                raise EOFError("truncated archive")
        self.held += self.z.decompress(data, 4 * self.STEP)
        return True

    def header(self) -> bytes:
        while (k := self.held.find(b"\r\n\r\n")) < 0:
            if not self.more():
                raise ValueError("record without header block")
        head, self.held = self.held[:k], self.held[k + 4 :]
        return head

    def body(self, n: int) -> bytes:
        parts, have = [self.held], len(self.held)
        self.held = b""
        while have < n and self.more():
            parts.append(self.held)
            have += len(self.held)
            self.held = b""
        return b"".join(parts)[:n]

    def end(self) -> int:
        """Offset behind the member, found by inflating (and dropping) the rest."""
        while self.more():
            self.held = b""
        return self.at - len(self.z.unused_data)


class _Plain(_Inflated):
    """A record of an uncompressed archive."""

    def more(self) -> bool:
        data = self.file.read_at(self.STEP, self.at)
        self.at += len(data)
        self.held += data
        return bool(data)


def records(file, size: int, wanted, payload: bool) -> Iterator[tuple[int, dict[str, str], bytes | None]]:
    """(offset, header, body or None) of the records whose header is wanted."""
    at = 0
    while at < size:
        start, lead = at, file.read_at(64, at)
        gz = lead[:2] == b"\x1f\x8b"
        part = _Inflated(file, at) if gz else _Plain(file, at)
        head = parse_header(part.header())
        n = int(head.get("Content-Length", 0))
        body = None
        behind = part.at - len(part.held)  # of a plain archive: where the block starts
        if wanted(head) and payload:
            body = part.body(n)
            yield start, head, body
        elif wanted(head):
            yield start, head, None
        at = (start + skip_length(lead) if skip_length(lead) else part.end()) if gz else behind + n + 4


# ------------------------------------------------------------ reader
@dataclass
class Files(InputPartition):
    files: list


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "all") != "none"
        self.partition_bytes = int(options.get("partition_bytes", 32 << 20))
        self.filters: list[tuple[str, str, object]] = []

    # columns whose predicates the header alone decides
    BY_HEADER = {c: h for c, h in HEADERS.items() if c != "payload_bytes"}
    TESTS = {
        "eq": lambda v, x: v == x,
        "in": lambda v, x: v in x,
        "starts": lambda v, x: v is not None and v.startswith(x),
        "ends": lambda v, x: v is not None and v.endswith(x),
        "contains": lambda v, x: v is not None and x in v,
        "some": lambda v, x: v is not None,
    }

    def pushFilters(self, filters):
        kinds = {EqualTo: "eq", EqualNullSafe: "eq", In: "in", StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "contains", IsNotNull: "some"}
        for f in filters:
            name = self.BY_HEADER.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if name is None or type(f) not in kinds:
                yield f  # Spark filters the rows itself
            else:
                self.filters.append((name, kinds[type(f)], getattr(f, "value", None)))

    def wanted(self, head: dict[str, str]) -> bool:
        return all(self.TESTS[kind](head.get(name), value) for name, kind, value in self.filters)

    def partitions(self):
        fs, root = filesystem(self.path)
        if fs.get_file_info(root).type == pafs.FileType.File:
            found = [(root, fs.get_file_info(root).size)]
        else:
            found = [(f"{root}/{name}", size) for name, size in committed(fs, root)[0]]
        groups: list[list] = []
        room = 0
        for name, size in sorted(found):
            if not groups or size > room:
                groups.append([])
                room = self.partition_bytes
            groups[-1].append((name, size))
            room -= size
        return [Files(g) for g in groups] or [Files([])]

    def read(self, partition):
        fs, _ = filesystem(self.path)
        rows, held = [], 0
        for name, size in partition.files:
            with fs.open_input_file(name) as file:
                for at, head, body in records(file, size, self.wanted, self.payload):
                    row = {col: head.get(h) for col, h in HEADERS.items()}
                    row["payload_bytes"] = int(row["payload_bytes"]) if row["payload_bytes"] else None
                    if body is not None and "msgtype=response" in head.get("Content-Type", ""):
                        body = body.partition(b"\r\n\r\n")[2]
                    row |= {"headers": list(head.items()), "payload": body, "file": name, "file_offset": at}
                    rows.append(row)
                    held += len(body or b"") + 500
                    if held > 4 << 20:
                        yield self.batch(rows)
                        rows, held = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows: list[dict]) -> pa.RecordBatch:
        s = pa.string()
        types = {"payload_bytes": pa.int64(), "headers": pa.map_(s, s), "payload": pa.binary(), "file_offset": pa.int64()}
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types.get(n, s)) for n in names], names=names)


# ------------------------------------------------------------ writer
@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.roll_bytes = int(options.get("roll_bytes", 64 << 20))

    def write(self, iterator):
        fs, root = filesystem(self.path)
        fs.create_dir(f"{root}/{PARTS}", recursive=True)
        done, out, size, name = [], None, 0, ""
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{PARTS}/{name}", compression=None)
                member = gzip_member(record_block(row))
                out.write(member)
                size += len(member)
                if size >= self.roll_bytes:
                    out.close()
                    done.append((name, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size))
        return Written(done)

    def commit(self, messages):
        fs, root = filesystem(self.path)
        for folder in (PARTS, LISTS):
            fs.create_dir(f"{root}/{folder}", recursive=True)
        replaces = committed(fs, root)[1] if self.overwrite else []
        files = [list(f) for m in messages if m is not None for f in m.files]
        place = f"{root}/{LISTS}/{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{place}.writing", compression=None) as f:
            f.write(json.dumps({"files": files, "replaces": replaces}).encode())
        fs.move(f"{place}.writing", f"{place}.json")
        for name in replaces:
            if fs.get_file_info(f"{root}/{name}").type == pafs.FileType.File:
                fs.delete_file(f"{root}/{name}")

    def abort(self, messages):
        fs, root = filesystem(self.path)
        for m in messages:
            for name, _ in m.files if m is not None else ():
                fs.delete_file(f"{root}/{PARTS}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", "all" if payload else "none").load(path)


# ------------------------------------------------------------ pages
#: Beyond the broadcast, a digest's copies are dealt over so many tasks.
SALTS = 32
#: Bytes of the shared digests' leads that are broadcast at most.
BROADCAST_BYTES = 32 << 20
#: Copies of a row that is there several times are made in chunks of so many.
CHUNK = 10_000


def page_rows(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))


def shared_digests(base: DataFrame, min_bytes: int) -> DataFrame:
    """digest, payload_bytes, top, top_url, n_top, salts of the payloads that
    several rows have: the page_id and url of the row that is the response, how
    many rows are equal to it, and the salts in use. Payloads take no part in the
    shuffles, and a digest's rows are reduced before they meet."""
    ones = base.where(F.col("payload_bytes") >= min_bytes).groupBy("digest", "payload_bytes", "page_id", "url").agg(F.count(F.lit(1)).alias("n"))
    return (
        ones.groupBy("digest", "payload_bytes")
        .agg(F.max(F.struct("page_id", "url", "n")).alias("lead"), F.sum("n").alias("n"), F.collect_set(salt()).alias("salts"))
        .where("n > 1")
        .select("digest", "payload_bytes", F.col("lead.page_id").alias("top"), F.col("lead.url").alias("top_url"), F.col("lead.n").alias("n_top"), "salts")
    )


def salt():
    return F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (of responses), digest (hex), payload_bytes and
    ``first_id``: for a row that revisits another, that row's page_id;
    ``is_revisit`` tells.

    Of rows with equal payloads of at least ``min_bytes`` bytes that with the
    largest page_id is the response. The shared digests are found first, in a
    written table without payloads. Where it is small, it is broadcast and no
    payload is shuffled; else rows meet it by digest and salt. Of rows that are
    equal in all columns one goes on and its copies are counted out."""
    base = page_rows(pages)
    shared = written(shared_digests(base, min_bytes), "warc-shared")
    size = shared.agg(F.sum(F.coalesce(F.octet_length("top_url"), F.lit(0)) + F.size("salts") * 8 + 120).alias("bytes"), F.max("n_top").alias("most")).first()
    if (size["bytes"] or 0) <= BROADCAST_BYTES:
        rows = base.join(F.broadcast(shared.drop("salts", "payload_bytes")), "digest", "left")
    else:
        answers = shared.drop("payload_bytes").withColumn("salt", F.explode("salts")).drop("salts")
        rows = base.withColumn("salt", salt()).join(answers, ["digest", "salt"], "left")
    lead = F.col("page_id").eqNullSafe(F.col("top")) & F.col("url").eqNullSafe(F.col("top_url"))
    rows = rows.withColumn("is_shared", F.col("n_top").isNotNull()).withColumn("leads", F.col("is_shared") & lead)
    columns = ["page_id", "url", "payload", "digest", "payload_bytes", "is_revisit", F.when(F.col("is_revisit"), F.col("top")).alias("first_id")]
    revisit = F.col("is_shared") & ~F.col("leads")
    payload = F.when(~F.col("is_revisit"), F.col("payload")).alias("payload")
    once = rows.where(~F.col("leads") | (F.col("n_top") == 1)).withColumn("is_revisit", revisit).withColumn("payload", payload).select(*columns)
    if (size["most"] or 0) <= 1:
        return once
    first = ["page_id", "url", "digest", "payload_bytes", "top"]
    responses = rows.where(F.col("leads") & (F.col("n_top") > 1)).groupBy(*first).agg(F.first("payload").alias("payload"))
    chunks = shared.where("n_top > 1").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_top - 2) div {CHUNK}"))))
    left = F.least(F.lit(CHUNK), F.col("n_top") - 1 - F.col("chunk") * CHUNK).cast("int")
    again = chunks.repartition("digest", "chunk").withColumn("copy", F.explode(F.sequence(F.lit(1), left)))
    copies = again.withColumns({"page_id": F.col("top"), "url": F.col("top_url"), "payload": F.lit(None).cast("binary"), "is_revisit": F.lit(True)})
    return once.unionByName(responses.withColumn("is_revisit", F.lit(False)).select(*columns)).unionByName(copies.select(*columns))


def base32_of_hex(column):
    """Upper-case base32 of 40 hex digits (20 bytes: no padding): each ten hex
    digits are eight digits of base 32."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    eights = [F.lpad(F.conv(F.substring(column, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*eights), digits, alphabet)


def page_urn(column):
    return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("")), F.lit(">"))


def page_of_urn(column):
    number = F.regexp_extract(column, r"^<urn:page:(-?[0-9]+)>$", 1)
    return F.when(number != "", number.cast("long"))


def archive_pages(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", mode: str = "append") -> None:
    """One record per page, added to the archive or (mode ``overwrite``) in its
    place. Ids are ``<urn:page:N>``."""
    register(pages.sparkSession)
    planned = with_revisits(pages, min_bytes)
    revisit = F.col("is_revisit")
    planned.select(
        page_urn(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.concat(F.lit("sha1:"), base32_of_hex(F.col("digest"))).alias("payload_digest"),
        "payload_bytes",
        F.when(revisit, page_urn(F.col("first_id"))).alias("refers_to"),
        "payload",
    ).write.format("warc").mode(mode).save(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages of an archive. Responses are decoded and digested anew;
    revisits are read by their headers only."""
    full = read_archive(spark, path).where(F.col("record_type") == "response")
    heads = read_archive(spark, path, payload=False).where(F.col("record_type") == "revisit")
    same = [page_of_urn(F.col("record_id")).alias("page_id")]
    last = ["record_type", page_of_urn(F.col("refers_to")).alias("refers_to")]
    return full.select(
        *same, F.octet_length("payload").cast("long").alias("payload_bytes"), base32_of_hex(F.sha1("payload")).alias("payload_digest"), *last
    ).unionByName(heads.select(*same, "payload_bytes", F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), *last))
