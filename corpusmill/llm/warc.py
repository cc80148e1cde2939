"""WARC archives: written as tables of records, read by verifying the chain of record boundaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.lookup import attach, small_table
from ..session import materialize
from ..sources.lines import SPLIT, split_lines
from .tables import bounded_batches

MAGIC = "WARC/1."
END = "\r\n\r\n"
# The 32 digits of base32, and the profile of records without a payload of their own.
DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
# Files with a record cut by a byte range are named in the plan of a second scan up to this number.
NAMED_FILES = 1_000


def sha1_base32(data: Column) -> Column:
    """The SHA-1 in upper-case base32: 32 digits, four for every five hex digits."""
    number = [F.conv(F.substring(F.sha1(data), 5 * k + 1, 5), 16, 10).cast("int") for k in range(8)]
    digit = [F.shiftright(n, shift).bitwiseAND(F.lit(31)) for n in number for shift in (15, 10, 5, 0)]
    return F.concat(*[F.substring(F.lit(DIGITS), d + 1, F.lit(1)) for d in digit])


def _record_id(page: Column, digest: Column) -> Column:
    name = F.md5(F.concat_ws(":", page.cast("string"), digest))
    ends = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(name, a, n) for a, n in ends]), F.lit(">"))


def records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, date: str = DATE,
) -> DataFrame:
    """(record): a WARC record per row, without the two line ends that follow it.

    Of rows with equal payloads of at least `least` bytes those with the smallest id are
    responses, all others revisit it; a null id comes after all ids. Payloads are equal if SHA-1
    and size are. A null payload is empty. Line ends and blanks of a URL are percent-encoded; a
    null URL has no header.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"digest": sha1_base32(F.col("payload")), "size": F.octet_length("payload")})
    shared = rows.where(F.col("size") >= least).groupBy("digest", "size").agg(F.min("page").alias("first"), F.count("*").alias("n"))
    firsts, fits = small_table(shared.where("n > 1 and first is not null").select("digest", "size", "first"))
    rows = attach(rows, firsts, ["digest", "size"], fits, "left", spread=["page"])
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END)
    )
    rows = rows.withColumn("http", http)
    length = F.octet_length("http") + F.when(revisit, 0).otherwise(F.col("size"))
    address = F.col("url")
    for plain, code in ((" ", "%20"), ("\r", "%0D"), ("\n", "%0A")):
        address = F.replace(address, F.lit(plain), F.lit(code))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    head = F.concat_ws(
        "\r\n", F.lit(f"{MAGIC}1"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", _record_id(F.col("page"), F.col("digest"))),
        field("WARC-Target-URI", address),
        F.lit(f"WARC-Date: {date}"),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, field("WARC-Refers-To", _record_id(F.col("first"), F.col("digest")))),
        F.when(revisit, F.lit(f"WARC-Profile: {SAME_PAYLOAD}")),
        F.when(revisit, field("Refers-To-Page", F.col("first").cast("string"))),
        field("Page", F.col("page").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        field("Content-Length", length.cast("string")),
    )
    own = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    return rows.select(F.concat(head, F.lit(END), F.col("http"), own).alias("record"))


def write_warc(found: DataFrame, path: str) -> None:
    """Archives of the records, a file per partition; each record ends with two line ends."""
    found.write.option("lineSep", END).text(path)


def _candidates(lines: DataFrame) -> DataFrame:
    """(split, _id, size, need): what follows each magic, and how long the record is if one begins there.

    Only numbers: a header is parsed where its magic was found, no payload leaves the scan.
    """
    value = F.col("value")
    head = F.substring_index(value, END, 1)
    named = F.regexp_extract(head, "(?is)^[01]\r\n.*?\r?\n?Content-Length:[ \t]*([0-9]{1,18})[ \t]*(?:\r\n|$)", 1)
    complete = F.instr(value, END) > 0
    need = F.when(complete, len(MAGIC) + F.octet_length(head) + len(END) + named.try_cast("long") + len(END))
    return lines.select(*SPLIT, "_id", F.octet_length(value).cast("long").alias("size"), need.alias("need"))


def _followed(table: pa.Table) -> pa.Table:
    """Candidates of a byte range: where the chain from each leaves the range, and the last record before that."""
    table = table.sort_by("_id")
    size, need = table["size"].to_numpy(), table["need"].combine_chunks()
    here = table["base"][0].as_py() + np.concatenate([[0], np.cumsum(size[:-1] + len(MAGIC))]) - len(MAGIC)
    known = need.is_valid().to_numpy(zero_copy_only=False)
    here, following = here[known], here[known] + need.drop_null().to_numpy()
    place = np.searchsorted(here, following)
    inside = place < len(here)
    inside[inside] = here[place[inside]] == following[inside]
    leaves, last = following.copy(), here.copy()
    for i in np.flatnonzero(inside)[::-1]:  # successors are later, so they are known already
        leaves[i], last[i] = leaves[place[i]], last[place[i]]
    n = len(here)
    split = {c: pa.array([table[c][0].as_py()] * n, t) for c, t in zip(SPLIT, (pa.string(), pa.int64(), pa.int64()))}
    return pa.table({**split, "at": pa.array(here, pa.int64()), "to": pa.array(leaves, pa.int64()), "last": pa.array(last, pa.int64())})


def _boundaries(lines: DataFrame, strict: bool) -> DataFrame:
    """A row per byte range: base, first record, and the record that reaches into it from before.

    (split, base, first, owner, until). Every task follows the chains of its own candidates to the
    end of its range. Candidates at which a chain enters a range, and starts of files, are
    nodes; from the starts on, jumps of doubling length reach all nodes that are on the way.
    What was not reached is text that looks like a record.
    """
    narrow = materialize(_candidates(lines))
    sizes = narrow.groupBy(*SPLIT).agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    before = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits, fits = small_table(sizes.withColumn("base", F.coalesce(F.sum("bytes").over(before), F.lit(0))))
    chains = materialize(
        attach(narrow, splits.drop("bytes"), SPLIT, fits).groupBy(*SPLIT).applyInArrow(
            _followed, "_path string, _start long, _length long, at long, to long, last long"
        )
    )
    starts = splits.select("_path", F.lit(0).cast("long").alias("at")).distinct()
    entered = chains.select("_path", F.col("to").alias("at")).union(starts).distinct()
    nodes = materialize(chains.join(entered, ["_path", "at"]))
    jumps = nodes.select("_path", "at", "to")
    reached, n = materialize(starts), -1
    while (now := reached.count()) != n:
        n = now
        further = reached.join(jumps, ["_path", "at"]).select("_path", F.col("to").alias("at"))
        reached = materialize(reached.union(further).distinct())
        then = jumps.select("_path", F.col("at").alias("to"), F.col("to").alias("_next"))
        jumps = materialize(jumps.join(then, ["_path", "to"]).select("_path", "at", F.col("_next").alias("to")))
    if strict:
        ends = splits.groupBy("_path").agg((F.sum("bytes") - len(MAGIC)).alias("at"))
        broken = ends.join(reached, ["_path", "at"], "left_anti").where("at > 0").first()
        if broken is not None:
            raise ValueError(f"the records of {broken['_path']} do not lead to its end")
    nodes = nodes.join(reached, ["_path", "at"])
    first = nodes.groupBy(*SPLIT).agg(F.min("at").alias("first"))
    events = splits.select(*SPLIT, "base", (F.col("base") - len(MAGIC)).alias("pos"), F.lit(None).cast("struct<owner:long,until:long>").alias("over")).unionByName(
        nodes.select(*SPLIT, F.lit(None).cast("long").alias("base"), F.col("last").alias("pos"),
                     F.struct(F.col("last").alias("owner"), F.col("to").alias("until")).alias("over"))
    )
    earlier = Window.partitionBy("_path").orderBy("pos").rangeBetween(Window.unboundedPreceding, -1)
    owned = events.withColumn("over", F.last("over", True).over(earlier)).where("base is not null")
    reaches = F.col("over.until") > F.col("pos")
    return owned.join(first, SPLIT, "left").select(
        *SPLIT, "base", "first", F.when(reaches, F.col("over.owner")).alias("owner"), F.when(reaches, F.col("over.until")).alias("until"),
    )


def _parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, rest = data.partition(END.encode())
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, rest[: int(fields["content-length"])]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of byte ranges, whole or in pieces: (path, offset, piece, whole, data)."""
    names = ["path", "offset", "piece", "whole", "data"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    split, held = None, None  # held: the record that is not whole yet
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c) for c in ("_path", "_start", "base", "first", "owner", "until")]
        for row, value in enumerate(batch.column("value")):
            here = tuple(c[row].as_py() for c in columns[:2])
            if here != split:
                if held:
                    out.append((held[0], held[1], held[1], False, b"".join(held[3])))
                split, held = here, None
                base, expected, owner, until = (c[row].as_py() for c in columns[2:])
                at = base - len(MAGIC)
            data = MAGIC.encode() + value.as_py()
            if held:
                held[3].append(data)
            elif at == expected:
                fields_end = data.index(END.encode()) + len(END)
                length = fields_end + int(_parsed(data)[0]["content-length"]) + len(END)
                held = [split[0], at, at + length, [data]]
                expected = at + length
            elif until is not None and at < until:
                out.append((split[0], owner, at, False, data))
            at += len(data)
            if held and at >= held[2]:
                out.append((held[0], held[1], held[1], True, b"".join(held[3])))
                held = None
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, types)], names=names)
    if held:
        rest = [held[0], held[1], held[1], False, b"".join(held[3])]
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(rest, types)], names=names)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parsed = [_parsed(d.as_py()) for d in batch.column("data")]
        yield pa.RecordBatch.from_arrays([
            batch.column("path"), batch.column("offset"),
            pa.array([list(f.items()) for f, _ in parsed], pa.map_(pa.string(), pa.string())),
            pa.array([b for _, b in parsed], pa.binary()),
        ], names=["path", "offset", "fields", "block"])


def read_warc(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(path, offset, fields, block) of every record of the uncompressed archives at `path`.

    Files are read in byte ranges, split at the magic of a record. A magic inside a payload, even
    with a header and a successor, is no record: only what the chain of lengths from the start
    of a file leads to is one (`_boundaries`). The first pass keeps numbers only, the second
    cuts the records. One that ends in the range it began in is made there; pieces of others
    are few and put together by a shuffle. With `strict` a file whose chain does not end where
    the file ends is an error; else its records are read as far as the chain goes. No files,
    or empty ones, give no records.
    """
    bounded_batches(spark)
    lines = split_lines(spark, path, MAGIC)
    bounds, fits = small_table(_boundaries(lines, strict))
    shape = "path string, offset long, piece long, whole boolean, data binary"

    def walked(rows: DataFrame, ranges: DataFrame) -> DataFrame:
        rows = attach(rows.select("value", *SPLIT, "_id"), ranges, SPLIT, fits, "left")
        lost = F.raise_error(F.concat(F.lit("an unknown byte range of "), F.col("_path"))).cast("long")
        rows = rows.withColumn("base", F.coalesce("base", lost))
        if not fits:  # the scan keeps the order of lines, a shuffle does not
            rows = rows.repartition(*SPLIT).sortWithinPartitions(*SPLIT, "_id")
        return rows.select(
            F.col("value").cast("binary").alias("value"), "_path", "_start", "base", "first", "owner", "until"
        ).mapInArrow(_walk, shape)

    data = walked(lines, bounds).where("whole").select("path", "offset", "data")
    # a record in pieces has lines in ranges after its own: that range starts before the record ends
    cut = bounds.where("owner is not null").select("_path").distinct()
    names = [r[0] for r in cut.limit(NAMED_FILES + 1).collect()]
    if names:
        some = lines.where(F.col("_path").isin(names)) if len(names) <= NAMED_FILES else lines
        pieces = walked(some, bounds).where("not whole").groupBy("path", "offset").agg(
            F.sort_array(F.collect_list(F.struct("piece", "data"))).alias("p")
        )
        joined = F.aggregate("p", F.lit(b""), lambda done, p: F.concat(done, p["data"]))
        data = data.union(pieces.select("path", "offset", joined.alias("data")))
    return data.mapInArrow(_parse, "path string, offset long, fields map<string,string>, block binary")


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the archives that `records` makes.

    Sizes and digests of responses are those of the payload that was read, which has to agree
    with the header; a revisit has the digest of its header and the size of its HTTP header.
    """
    field = {n: F.col("fields")[n] for n in ("page", "refers-to-page", "warc-type", "warc-payload-digest")}
    block = F.col("block").cast("string")
    http = F.substring_index(block, END, 1)
    own = F.expr(f"substring(block, octet_length(substring_index(cast(block AS string), '\\r\\n\\r\\n', 1)) + {len(END) + 1})")
    read = read_warc(spark, path).select(
        field["page"].cast("long").alias("page_id"), field["warc-type"].alias("record_type"), field["refers-to-page"].cast("long").alias("refers_to"),
        F.substring_index(field["warc-payload-digest"], ":", -1).alias("named"),
        F.regexp_extract(http, "Content-Length: ([0-9]+)", 1).cast("long").alias("size"), own.alias("payload"),
    )
    response = F.col("record_type") == "response"
    same = (sha1_base32(F.col("payload")) == F.col("named")) & (F.octet_length("payload") == F.col("size"))
    wrong = F.raise_error(F.concat(F.lit("payload and header differ for page "), F.coalesce(F.col("page_id").cast("string"), F.lit("without id"))))
    return read.select(
        "page_id", F.when(response & ~same, wrong.cast("long")).otherwise(F.col("size")).alias("payload_bytes"),
        F.col("named").alias("payload_digest"), "record_type", "refers_to",
    )


ARCHIVED_SQL = f"""
WITH hashed AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), ranked AS (
    SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM hashed
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda k:
           substr('{DIGITS}', CAST(1 + ((CAST('0x' || substr(hex, 5 * (k // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM ranked
"""
