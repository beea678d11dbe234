"""WARC archives: written by Spark's text writer, read by a Python data source."""

from __future__ import annotations

import gzip
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from tripmill.llm.shared import settle
from tripmill.session import new_folder

SOURCE_NAME = "warc"
SMALLEST_REVISITED = 100
#: Compressed bytes that one read task is planned to take.
BYTES_PER_TASK = 16 << 20
_HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Columns of the source that come from a record's header, and the header's field.
HEADER_FIELDS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "payload_length": "x-payload-length",
}
SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_length string, payload binary"
)


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """A WARC record per row (``page_id``, ``url``, ``html``) into gzip files of a fresh folder.

    Equal payloads of ``SMALLEST_REVISITED`` bytes or more are stored once, under the smallest page_id; the others
    are revisit records that name it and carry digest and length of the full payload.
    Rows that share that page_id are all responses. A null html is empty, a row with a
    null page_id always is a response, a null url has no target header, and line breaks
    in a url become ``%0A`` and ``%0D``.

    The digests that occur twice are counted first and written to the shared folder, so
    that Spark joins them by a broadcast if they are below its threshold and shuffles the
    pages, splitting hot digests, if they are not.
    """
    marked = pages.select(
        F.col("page_id").cast("string").alias("page"),
        F.col("page_id").alias("number"),
        F.regexp_replace(F.regexp_replace("url", "\n", "%0A"), "\r", "%0D").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "size": F.octet_length("html")})
    firsts = settle(
        marked.where(F.col("size") >= SMALLEST_REVISITED)
        .groupBy("digest")
        .agg(F.min("number").alias("first"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .select("digest", "first"),
        "repeated",
    )
    joined = marked.join(firsts, "digest", "left")
    revisit = F.coalesce(F.col("number") != F.col("first"), F.lit(False)) & (F.col("size") >= SMALLEST_REVISITED)
    body = F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(_HTTP_HEAD), "html"))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce("page", F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))),
        F.when(
            revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        ),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
        F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    record = F.concat(head, F.lit("\r\n\r\n"), body)
    joined.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)


#: Schemes by which Hadoop names a store, and pyarrow's name of it.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system of a Hadoop URI, and the path in it."""
    scheme, colon, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}{colon}{rest}")


@dataclass
class Files(InputPartition):
    """Archive files that one task reads."""

    paths: tuple[str, ...]


@dataclass
class WarcReader(DataSourceReader):
    """Reads the files of a folder; equality filters on header columns skip records by their header."""

    folder: str
    columns: tuple[str, ...]
    wanted: dict[str, frozenset] = field(default_factory=dict)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for item in filters:
            column = item.attribute[0] if isinstance(item, (EqualTo, In)) and len(item.attribute) == 1 else None
            if column not in HEADER_FIELDS:
                yield item
                continue
            values = frozenset([item.value] if isinstance(item, EqualTo) else item.value)
            self.wanted[column] = self.wanted.get(column, values) & values

    def partitions(self) -> Sequence[InputPartition]:
        store, root = _store(self.folder)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        names = ((f.path, f.size) for f in found if f.is_file and f.base_name[0] not in "._")
        groups: list[list[str]] = []
        size = BYTES_PER_TASK
        for path, length in sorted(names):
            if size + length > BYTES_PER_TASK:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += length
        return [Files(tuple(group)) for group in groups] or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary() if name == "payload" else pa.string() for name in self.columns]
        rows: list[list] = [[] for _ in self.columns]
        size = 0
        for header, payload in self._records(partition):
            for values, name in zip(rows, self.columns):
                values.append(payload if name == "payload" else header.get(HEADER_FIELDS[name]))
            size += 500 + len(payload or b"")
            if size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows, kinds)], names=list(self.columns))
                rows, size = [[] for _ in self.columns], 0
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows, kinds)], names=list(self.columns))

    def _records(self, partition: Files) -> Iterator[tuple[dict[str, str], bytes | None]]:
        store, _ = _store(self.folder)
        for path in partition.paths:
            with store.open_input_stream(path, compression=None) as raw:
                packed = path.endswith(".gz")
                with gzip.GzipFile(fileobj=raw) if packed else raw as file:
                    yield from self._of(file)

    def _of(self, file) -> Iterator[tuple[dict[str, str], bytes | None]]:
        stream = Buffered(file)
        while (header := stream.header()) is not None:
            length = int(header["content-length"])
            if all(header.get(HEADER_FIELDS[name]) in values for name, values in self.wanted.items()):
                if "payload" in self.columns:
                    yield header, _payload(header, stream.take(length))
                else:
                    stream.skip(length)
                    yield header, None
            else:
                stream.skip(length)
            stream.skip(4)


def _payload(header: dict[str, str], block: bytes) -> bytes | None:
    """What follows the HTTP head of a response; None for a record without a payload."""
    if header.get("warc-type") != "response":
        return None
    return block.partition(b"\r\n\r\n")[2]


class Buffered:
    """Bytes of a stream, in parts of any length."""

    def __init__(self, file, step: int = 1 << 20) -> None:
        self.file, self.step, self.data, self.at = file, step, b"", 0

    def _more(self) -> bool:
        new = self.file.read(self.step)
        self.data, self.at = self.data[self.at :] + new, 0
        return bool(new)

    def header(self) -> dict[str, str] | None:
        """The fields of the next record's header by lower-case name; None at the end."""
        while (end := self.data.find(b"\r\n\r\n", self.at)) < 0:
            if not self._more():
                if self.data[self.at :].strip():
                    raise ValueError("a record's header is cut off")
                return None
        lines = self.data[self.at : end].decode().lstrip("\r\n").split("\r\n")
        self.at = end + 4
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record here")
        return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}

    def take(self, length: int) -> bytes:
        parts = []
        while length:
            part = self.data[self.at : self.at + length]
            if not part and not self._more():
                raise ValueError("a record is cut off")
            parts.append(part)
            self.at += len(part)
            length -= len(part)
        return b"".join(parts)

    def skip(self, length: int) -> None:
        while length:
            step = min(length, len(self.data) - self.at)
            if not step and not self._more():
                raise ValueError("a record is cut off")
            self.at += step
            length -= step


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; option ``payload=false`` leaves payloads out."""

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> str:
        return SCHEMA if self.options.get("payload", "true") == "true" else SCHEMA.removesuffix(", payload binary")

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], tuple(schema.names))


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Records of all archives in a folder, headers first; filters on header columns by ``=`` or ``in`` are pushed down.

    Archives are read by pyarrow's file systems, as plain or gzip files. A damaged
    archive raises. A revisit's payload is null.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format(SOURCE_NAME).option("payload", str(payload).lower()).load(folder)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive the pages, and for each record read back what it says and holds.

    ``page_id``, ``payload_bytes``, ``payload_digest`` (SHA-256 of the full payload),
    ``record_type`` and ``refers_to``. Digest and length of a response are those of the
    payload read back; a revisit's come from its header, and no payload is decoded for it. The
    archives are read once.
    Repeated rows give as many records; an empty table gives none; further columns stay behind.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "archives")
    kind = pages.schema["page_id"].dataType
    write_archives(pages, folder)
    page = lambda column: F.nullif(F.regexp_extract(column, "urn:page:(.*)>", 1), F.lit("")).cast(kind)
    stored = read_archives(spark, folder).where(F.col("record_type").isin("response", "revisit"))
    own = F.col("record_type") == "response"
    return stored.select(
        page("record_id").alias("page_id"),
        F.when(own, F.octet_length("payload")).otherwise(F.col("payload_length").cast("int")).cast("long").alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.regexp_replace("payload_digest", "^sha256:", "")).alias("payload_digest"),
        "record_type",
        F.when(~own, page("refers_to")).alias("refers_to"),
    )
