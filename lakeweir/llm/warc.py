"""Content-addressed WARC archive.

``write_archive`` stores two tables: ``payloads`` holds the bytes of each distinct payload
once, under its SHA-256; ``records`` holds the exact header bytes of each record
and the digest of its payload. ``read_archive`` joins the two, rebuilds the
records byte by byte and fails if a stored payload does not have its digest.

Only digests that occur twice or more need other rows to decide anything; they are found
by an aggregate of digests and ids, without payloads, with a map-side combine. So one
payload in a third of all rows costs a row per task.

Of records with equal payloads of at least ``revisit_bytes`` bytes that with the largest id is
the response, the others are revisits that refer to it; their blocks hold HTTP headers only.

Defined cases: a null payload is empty; a null url leaves its header line out; a null id is
smaller than all others and is written as an empty name; equal payloads with one id: the
largest url is the response, rows equal in id, url and payload are all responses; line breaks
in a url are percent-encoded; other columns are ignored; an empty table is an empty archive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.storage import Workspace
from lakeweir.operators.joins import (
    SALT,
    fits_broadcast,
    hot_list,
    salted,
    shuffle_width,
    spread_hot_keys,
)

REVISIT_BYTES = 1000
BROADCAST_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    records: DataFrame
    payloads: DataFrame


def name_of(id_: Column) -> Column:
    """Record name of an id, as a URI."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(id_.cast("string")), F.lit("")), F.lit(">"))


def header_text(date: str) -> Column:
    """WARC and HTTP header lines of a record."""
    end = "\r\n"
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(end + end),
    )
    revisit = F.col("refers_to").isNotNull()
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    return F.concat(
        F.lit(f"WARC/1.1{end}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{end}WARC-Record-ID: "),
        name_of(F.col("id")),
        F.lit(f"{end}WARC-Date: {date}{end}"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit(end)), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("sha1"),
        F.lit(end),
        F.when(
            revisit,
            F.concat(
                F.lit("WARC-Refers-To: "), F.col("refers_to"), F.lit(f"{end}WARC-Profile: {PROFILE}{end}")
            ),
        ).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{end}Content-Length: "),
        block.cast("string"),
        F.lit(end + end),
        http,
    )


def write_archive(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    date: str = "1970-01-01T00:00:00Z",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Archive:
    """Store ``pages`` below the shared folder; ``date`` is written into every record."""
    work = Workspace(pages.sparkSession, "archive")
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")
    ).select(
        "*",
        F.octet_length("payload").cast("bigint").alias("bytes"),
        F.sha1("payload").alias("sha1"),
        F.sha2("payload", 256).alias("digest"),
    )
    ranked = F.struct(F.col("id").isNotNull().alias("known"), "id", "url")
    shared = (
        rows.groupBy("digest")
        .agg(F.count("*").alias("n"), F.max(ranked).alias("owner"))
        .filter("n > 1")
        .select(
            "digest", "n", F.col("owner.id").alias("owner_id"), F.col("owner.url").alias("owner_url")
        )
    )
    shared = work.store(shared, "shared")
    marked = with_owners(rows, shared, broadcast_bytes)
    owner = F.col("id").eqNullSafe(F.col("owner_id")) & F.col("url").eqNullSafe(F.col("owner_url"))
    revisits = F.col("again").isNotNull() & ~owner & (F.col("bytes") >= revisit_bytes)
    records = marked.withColumn("refers_to", F.when(revisits, name_of(F.col("owner_id")))).select(
        "id", "digest", F.encode(header_text(date), "UTF-8").alias("header")
    )
    once = marked.filter(F.col("again").isNull()).select("digest", "payload")
    several = marked.filter(F.col("again").isNotNull() & owner).select("digest", "payload")
    payloads = once.union(several.dropDuplicates(["digest"]))
    return Archive(work.store(records, "records"), work.store(payloads, "payloads"))


def with_owners(rows: DataFrame, shared: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Rows with ``again`` and their owner if their digest is shared.

    Beyond a broadcast the rows of digests with more than an even share of the repeated rows are dealt
    over tasks; there are fewer of them than tasks.
    """
    marks = shared.drop("n").withColumn("again", F.lit(True))
    if fits_broadcast(marks, broadcast_bytes):
        return rows.join(F.broadcast(marks), "digest", "left")
    width = shuffle_width(rows)
    repeated = shared.agg(F.sum("n")).collect()[0][0] or 0
    share = max(1, -(-repeated // width))
    hot = [(r["digest"], -(-r["n"] // share)) for r in shared.filter(F.col("n") > share).collect()]
    if not hot:
        return rows.join(marks.hint("merge"), "digest", "left")
    hot = hot_list(rows, "digest", hot)
    rows = salted(rows, "digest", hot, None, first=True)
    marks = salted(marks, "digest", None, hot, first=False)
    return rows.join(marks.hint("merge"), ["digest", SALT], "left").drop(SALT)


def read_archive(archive: Archive) -> DataFrame:
    """Records as they were: ``id``, ``record_type``, ``refers_to``, whole ``record`` bytes
    and the ``payload``, which for a revisit is that of the record it refers to.

    Records of one digest in very many pages are dealt over tasks, and its payload goes to each."""
    # A digest lies once in the payloads, so none is hot there.
    sides = spread_hot_keys(archive.records, archive.payloads, "digest", "digest", hot_dim=[])
    if sides is None:
        rows = archive.records.join(archive.payloads, "digest")
    else:
        rows = sides[0].join(sides[1], ["digest", SALT]).drop(SALT)
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("digest")))
    )
    text = F.decode("header", "UTF-8")
    kind = F.regexp_extract(text, r"^WARC/1\.1\r\nWARC-Type: (\w+)\r\n", 1)
    refers = F.regexp_extract(text, r"\r\nWARC-Refers-To: (<[^\r\n]*>)\r\n", 1)
    return rows.select(
        "id",
        kind.alias("record_type"),
        F.when(refers != "", refers).alias("refers_to"),
        "header",
        checked.alias("payload"),
    ).select(
        "id",
        "record_type",
        "refers_to",
        F.concat(
            "header",
            F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b"")),
            F.lit(b"\r\n\r\n"),
        ).alias("record"),
        "payload",
    )


def id_of(name: Column, kind: str) -> Column:
    """The id in a record name; an empty name is a null id."""
    text = F.url_decode(F.regexp_extract(name, "^<urn:page:(.*)>$", 1))
    return F.nullif(text, F.lit("")).cast(kind)

