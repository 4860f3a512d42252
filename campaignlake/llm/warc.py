"""WARC archives of pages, read back into a globally ordered capture index.

``write_archives`` writes one record per page.  Of pages with equal payloads of
at least ``min_revisit`` bytes the one with the largest id is a ``response``, the
others are ``revisit`` records that refer to it and leave the payload out.  Only
digests are grouped; page texts are shuffled only if the list of revisits is too
long to send to all tasks.  Spark's own text writer writes the files, so a lost
executor or a repeated task leaves no half archive: a record's end mark, two line
ends, is the writer's line separator.

``read_archives`` parses the files by their ``Content-Length`` fields, checks each
payload against its digest, and returns a row per capture.  Each archive's
captures are a run, sorted by URL key, time, and place.

``merge_runs`` is the external merge: the order of (URL key, time, run, place) is
cut into ranges of a bounded number of captures, which the runs deal their sorted
stretches to; a task merges the stretches of its range with a loser tree.  No two
captures are equal in that order, so the captures of one URL, or of one moment,
spread over as many ranges as they need.  Offsets are those of the uncompressed
archive.

Defined results: a null page is an empty payload; a null id sorts below all
others; pages that repeat the largest id of their payload are responses, too; a
null URL has the empty key and no URL field; control characters in URLs are
written percent-encoded; empty input gives no archive and no captures.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.session import scratch_path

from .common import cut, fresh, map_arrow
from .ordered import in_order, running

MIN_REVISIT = 1000          # bytes from which an equal payload is written as a revisit
SENT_REVISITS = 100_000     # up to so many revisits (about 100 bytes each) go to all tasks, more are joined
SPREAD = 8                  # parts that a page's rows are joined in, should one page fill the table
RECORDS_PER_FILE = 50_000
RANGE_CAPTURES = 100_000    # captures that one merge task gets, about
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = ("url_key string, captured_at long, page_id long, record_type string, refers_to long, "
           "payload_digest string, payload_bytes long, archive string, offset long, length long")


def _target(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A"), "[\\x00-\\x20]", "%20")


def _keyed(pages: DataFrame) -> DataFrame:
    """With digest, size and the digest as two longs."""
    return (pages.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
            .withColumn("size", F.octet_length("payload").cast("long"))
            .withColumns({"d1": F.xxhash64(F.lit(1), "digest"), "d2": F.xxhash64(F.lit(2), "digest")}))


def revisits(keyed: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(of, r1, r2, response)``: ids and digests of pages whose payload a page of larger id has, each once.

    Equal payloads stand together from the largest id down, over as many
    partitions as they fill, and the first one's id is carried along them.
    """
    shared = keyed.where(F.col("size") >= min_revisit).select("id", "d1", "d2")
    placed = running(in_order(shared, ["d1", "d2"], [F.col("id").desc()]), ["d1", "d2"], count="n")
    first = placed.withColumn("first", F.when(F.col("n") == 1, F.coalesce("id", F.lit(0))).otherwise(0))
    carried = running(first, ["d1", "d2"], sums={"response": "first"})
    return (carried.where("n > 1 and id is distinct from response")
            .select(F.col("id").alias("of"), F.col("d1").alias("r1"), F.col("d2").alias("r2"), "response").distinct())


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``record``: the text of each page's record without its end mark.  ``pages``: id, url, at (seconds), payload."""
    known = _keyed(pages)
    again = cut(revisits(known, min_revisit))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("d1") == F.col("r1")) & (F.col("d2") == F.col("r2"))
    if again.count() <= SENT_REVISITS:
        again = F.broadcast(again)
    else:
        again = again.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        known = known.withColumn("to", F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int"))
        same &= F.col("to") == F.col("part")
    known = known.join(again, same, "left")

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit(END))
    repeats = F.col("r1").isNotNull()
    block = F.when(repeats, http).otherwise(F.concat(http, "payload"))
    name = lambda c: F.concat(F.lit("<urn:x-capture:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda field, value: F.concat(F.lit(f"{field}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(repeats, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("id"))),
        line("WARC-Date", F.date_format(F.expr("timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, at)"),
                                        "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.coalesce(line("WARC-Target-URI", _target(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(repeats, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("response")))))
        .otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return known.select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", at: Column | None = None, min_revisit: int = MIN_REVISIT) -> None:
    """Gzip-compressed archives at ``path``; ``at``: when a page was captured, in seconds since 1970 (default: 0)."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(at if at is not None else F.lit(0), F.lit(0)).cast("long").alias("at"),
                        F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).alias("payload"))
    (records(rows, min_revisit).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def url_key(url: str) -> str:
    """The URL with its host reversed, without scheme, user, port and fragment: ``com,example)/path?query``."""
    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", url)
    if not found:
        return url.partition("#")[0]
    host = re.sub(r":[0-9]*\Z", "", found[1].rpartition("@")[2])
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    return ",".join(reversed(host.split("."))) + ")" + url[found.end():].partition("#")[0]


class Archive:
    """Reads the records of one gzip-compressed archive in order, a piece at a time."""

    STEP = 1 << 16

    def __init__(self, data: bytes):
        self.data, self.at = data, 0            # compressed bytes, and how many are used
        self.held, self.pos, self.offset = b"", 0, 0  # unzipped bytes, the next record's place in them and in all
        self.unzip = zlib.decompressobj(31)

    def _more(self) -> bool:
        """Unzips on; a file may hold several gzip members."""
        if self.unzip.eof:
            piece, self.unzip = self.unzip.unused_data, zlib.decompressobj(31)
        else:
            piece = b""
        if not piece:
            piece = self.data[self.at:self.at + self.STEP]
            self.at += len(piece)
        if not piece:
            return False
        self.held, self.pos = self.held[self.pos:] + self.unzip.decompress(piece), 0
        return True

    def _head(self) -> bytes | None:
        end = END.encode()
        while (found := self.held.find(end, self.pos)) < 0:
            if not self._more():
                if self.pos < len(self.held):
                    raise ValueError("an archive breaks off inside a record's head")
                return None
        return self.held[self.pos:found]

    def __iter__(self):
        """``(offset, length, fields, block)`` per record."""
        mark = len(END)
        while (head := self._head()) is not None:
            version, *lines = head.split(b"\r\n")
            if not version.startswith(b"WARC/"):
                raise ValueError("a record does not start with its version")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines)}
            start = len(head) + mark
            length = start + int(fields[b"content-length"]) + mark
            if len(self.held) - self.pos < length:
                pieces = [self.held[self.pos:]]
                self.held, self.pos = b"", 0
                while sum(map(len, pieces)) < length:
                    if not self._more():
                        raise ValueError("an archive breaks off inside a record")
                    pieces.append(self.held)
                    self.held = b""
                self.held = b"".join(pieces)
            record = self.held[self.pos:self.pos + length]
            if record[-mark:] != END.encode():
                raise ValueError("a record is not as long as it says")
            yield self.offset, length, fields, record[start:-mark]
            self.offset += length
            self.pos += length


def _id(name: bytes) -> int | None:
    number = name.removeprefix(b"<urn:x-capture:").removesuffix(b">")
    return int(number) if number else None


def captures_of(archive: str, data: bytes) -> list[tuple]:
    """An archive's captures, a sorted run."""
    out = []
    for offset, length, fields, block in Archive(data):
        kind, digest = fields[b"warc-type"].decode(), fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
        head, _, payload = block.partition(END.encode())
        size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)[1])
        if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"a payload of {archive} at {offset} does not match its digest")
        when = datetime.strptime(fields[b"warc-date"].decode(), "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
        refers = fields.get(b"warc-refers-to")
        url = fields.get(b"warc-target-uri", b"").decode("utf-8", "surrogateescape")
        out.append((url_key(url).encode("utf-8", "surrogateescape"), int(when.timestamp()),
                    _id(fields[b"warc-record-id"]), kind, _id(refers) if refers else None, digest, size,
                    archive, offset, length))
    return sorted(out, key=_order)


def _order(capture: tuple) -> tuple:
    """URL key, time, then the place: (archive, offset)."""
    return capture[0], capture[1], capture[7], capture[8]


NAMES = [c.split()[0] for c in CAPTURE.split(", ")]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, pa.binary()).view(f.type) if f.name == "url_key" else pa.array(c, f.type)
               for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


ARROW = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in
                   (c.split() for c in CAPTURE.split(", "))])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below ``path``; those of an archive follow each other in order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                found = captures_of(name.rsplit("/", 1)[-1], data.as_py())
                for i in range(0, len(found), 10_000):
                    yield _batch(found[i:i + 10_000], ARROW)

    return map_arrow(files, run, CAPTURE)


class LoserTree:
    """Merges sorted lists: each inner node keeps the run that lost there, the winner of all is on top."""

    def __init__(self, runs: list[list[tuple]], order):
        self.runs, self.order, k = runs, order, max(1, len(runs))
        self.at = [0] * len(runs)
        self.heads = [order(r[0]) if r else None for r in runs]
        self.loser = [-1] * k  # node 0: the winner
        for run in range(len(runs)):
            self._climb(run)

    def _beats(self, a: int, b: int) -> bool:
        if self.heads[b] is None or self.heads[a] is None:
            return self.heads[a] is not None
        return self.heads[a] <= self.heads[b]

    def _climb(self, run: int) -> None:
        """A run plays its way up against the losers kept on it; a place not taken yet keeps it."""
        node = (run + len(self.runs)) // 2
        while node:
            other = self.loser[node]
            if other < 0:
                self.loser[node] = run
                return
            if not self._beats(run, other):
                self.loser[node], run = run, other
            node //= 2
        self.loser[0] = run

    def __iter__(self):
        while self.runs and self.heads[run := self.loser[0]] is not None:
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.heads[run] = self.order(self.runs[run][self.at[run]]) if self.at[run] < len(self.runs[run]) else None
            self._climb(run)


def merge_runs(captures: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """All captures in one order over the partitions, with ``index_row``, their number in it from 0."""
    captures = cut(captures.select(NAMES))
    ranges = max(1, -(-captures.count() // range_captures))
    dealt = captures.repartitionByRange(ranges, "url_key", "captured_at", "archive", "offset")

    def merge(batches):
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            columns = [c.cast(pa.binary()) if n == "url_key" else c for n, c in zip(batch.schema.names, batch.columns)]
            for row in zip(*(c.to_pylist() for c in columns)):
                runs.setdefault(row[7], []).append(row)
        for run in runs.values():  # a stretch arrives as its run was written; the shuffle does not promise it
            if any(_order(a) > _order(b) for a, b in zip(run, run[1:])):
                run.sort(key=_order)
        out = []
        for row in LoserTree(list(runs.values()), _order):
            out.append(row)
            if len(out) == 10_000:
                yield _batch(out, ARROW)
                out = []
        if out:
            yield _batch(out, ARROW)

    at = fresh(dealt, "at")
    merged = cut(map_arrow(dealt, merge, CAPTURE).withColumn(at, F.monotonically_increasing_id()))
    # Partitions follow each other in the order; a row a partition tells how many captures stand before.
    counts = merged.groupBy(F.shiftright(at, 33).alias("part")).count().orderBy("part").collect()
    before, total = [], 0
    for part, n in counts:
        before.append((part, total))
        total += n
    base = F.broadcast(captures.sparkSession.createDataFrame(before, "part long, n long"))
    part = F.shiftright(at, 33)
    return merged.join(base, part == F.col("part")).select(
        *NAMES, (F.col("n") + F.col(at) - F.shiftleft(part, 33)).alias("index_row"))


def capture_history(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Writes the pages' archives (below the checkpoint folder unless ``path`` says where), reads them back and
    merges their runs."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    write_archives(pages, path, **columns)
    return merge_runs(read_archives(spark, path))
