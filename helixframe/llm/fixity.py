"""Merkle fixity audit of archive replicas (operator 10).

Each replica holds records; a record's leaf is its id, the SHA-256 of its bytes, its length and its number of copies. A
leaf's place is a number of 60 bits from a hash of id and digest, so replicas written independently, in whatever order and files,
place equal records alike, and a missing, extra or changed record touches its own path alone. Nodes are fixed
ranges of places: the lowest level has up to ``fanout`` leaves a node on average, and ``fanout`` nodes make one of the
level above, up to one root. Records lie in segments (nodes of the level two above the lowest) in the order of places; every
node covers a contiguous offset range of its segment in each replica.

An audit compares the roots, then level by level only the children of nodes that differ, down to the leaves, and
names the records that are damaged, missing or extra.

Places are hashes, so a node never gathers more than a few dozen leaves whatever the ids: equal records are one
leaf with a count (added up before the shuffle), records that share an id but not their bytes have places of their own.

Defined results: null html is an empty body, null url an empty target, a null id an id of its own; equal rows are
copies of one record, stored one after another; no rows: no leaves, an empty root and an empty report.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.session import scratch_path

CRLF = "\r\n"
#: Bits of a place, and of a level (16 children a node).
PLACE_BITS, BITS = 60, 4


def warc_record(record_id: Column, url: Column, body: Column) -> Column:
    """A WARC/1.1 resource record as binary."""
    body_bytes = F.coalesce(body, F.lit("")).cast("binary")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: resource{CRLF}WARC-Record-ID: <urn:record:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(f">{CRLF}WARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "), F.octet_length(body_bytes).cast("string"), F.lit(CRLF + CRLF))
    return F.concat(head.cast("binary"), body_bytes, F.lit(CRLF + CRLF).cast("binary"))


def write_replica(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  fault: Column | None = None) -> DataFrame:
    """Write one record per row (record_id, bytes); with ``fault`` (a column over record_id and bytes) damaged ones."""
    records = pages.select(F.col(id_col).alias("record_id"), warc_record(F.col(id_col), F.col(url_col), F.col(html_col)).alias("bytes"))
    (records if fault is None else damage(records, fault)).write.parquet(path)
    return pages.sparkSession.read.parquet(path)


def damage(replica: DataFrame, fault: Column) -> DataFrame:
    """A replica whose records with ``fault`` have the byte before their closing line ends replaced; lengths stay."""
    n = F.octet_length("bytes")
    flipped = F.concat(F.substr(F.col("bytes"), F.lit(1), n - 5), F.lit("\x00").cast("binary"), F.substr(F.col("bytes"), n - 3, F.lit(4)))
    return replica.withColumn("bytes", F.when(fault, flipped).otherwise(F.col("bytes")))


def leaves(replica: DataFrame, path: str) -> DataFrame:
    """Write and return the replica's leaves: record_id, length, digest, copies, place. Bytes are hashed where they
    are read and never shuffled."""
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("record_id").cast("string"), F.lit("null")), "digest")), 1, PLACE_BITS // 4), 16, 10)
    (replica.select("record_id", F.octet_length("bytes").cast("long").alias("length"), F.sha2("bytes", 256).alias("digest"))
     .groupBy("record_id", "length", "digest").agg(F.count("*").alias("copies"))
     .withColumn("place", place.cast("long")).write.parquet(path))
    return replica.sparkSession.read.parquet(path)


def height(n: int) -> int:
    """Levels above the lowest for n leaves: as few as leave 16 leaves a node on average."""
    levels = 0
    while 16 ** (levels + 1) < n:
        levels += 1
    return levels


def lay_out(leaf: DataFrame, levels: int) -> DataFrame:
    """The leaves with node (of the lowest level), segment and offset."""
    w = Window.partitionBy("segment").orderBy("place", F.col("record_id").asc_nulls_first(), "digest")
    size = F.col("length") * F.col("copies")
    node = F.shiftright("place", PLACE_BITS - BITS * levels) if levels else F.lit(0).cast("long")
    return (leaf.withColumn("node", node).withColumn("segment", F.shiftright("node", BITS * min(levels, 2)))
            .withColumn("offset", F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0)) - size))


def build_tree(layout: DataFrame, folder: str, levels: int) -> None:
    """Write all nodes to ``folder/level=k`` (0: lowest): node, first_offset, last_offset (null above segments), digest."""
    spark = layout.sparkSession
    end = F.col("offset") + F.col("length") * F.col("copies")
    kids = F.array_sort(F.collect_list(F.concat_ws(":", F.lpad("place", 19, "0"), F.coalesce(F.col("record_id").cast("string"), F.lit("null")),
                                                   "digest", "length", "copies")))
    (layout.groupBy("node").agg(F.min("offset").alias("first_offset"), F.max(end).alias("last_offset"), F.sha2(F.array_join(kids, "/"), 256).alias("digest"))
     .write.parquet(posixpath.join(folder, "level=0")))
    for k in range(1, levels + 1):
        below = spark.read.parquet(posixpath.join(folder, f"level={k - 1}"))
        named = F.sort_array(F.collect_list(F.struct("node", "digest")))       # at most 16 of them
        within = F.lit(k <= 2)
        (below.withColumn("parent", F.shiftright("node", BITS)).groupBy("parent")
         .agg(F.when(within, F.min("first_offset")).alias("first_offset"), F.when(within, F.max("last_offset")).alias("last_offset"), named.alias("kids"))
         .select(F.col("parent").alias("node"), "first_offset", "last_offset",
                 F.sha2(F.array_join(F.transform("kids", lambda x: F.concat_ws(":", x["node"].cast("string"), x["digest"])), "/"), 256).alias("digest"))
         .write.parquet(posixpath.join(folder, f"level={k}")))


def audit(spark: SparkSession, folder_a: str, folder_b: str, levels: int) -> tuple[DataFrame, list[dict]]:
    """Lowest nodes that differ (node), and per level how many nodes were compared and how many differ.
    Only children of differing nodes are compared on the way down."""
    trail, suspects = [], None
    for k in range(levels, -1, -1):
        sides = []
        for name, folder in (("digest_a", folder_a), ("digest_b", folder_b)):
            x = spark.read.parquet(posixpath.join(folder, f"level={k}")).select("node", F.col("digest").alias(name))
            if suspects is not None:
                x = x.withColumn("parent", F.shiftright("node", BITS)).join(suspects.select(F.col("node").alias("parent")), "parent", "left_semi").drop("parent")
            sides.append(x)
        path = scratch_path(spark, f"audit{k}")
        (sides[0].join(sides[1], "node", "full_outer").withColumn("differs", ~F.col("digest_a").eqNullSafe(F.col("digest_b"))).write.parquet(path))
        seen = spark.read.parquet(path)
        suspects = seen.filter("differs")
        got = seen.agg(F.count("*").alias("n"), F.sum(F.col("differs").cast("long")).alias("d")).first()
        trail.append({"level": k, "compared": got["n"], "differ": got["d"] or 0})
        if not got["d"]:
            break
    return suspects.select("node"), trail


def differing(layout_a: DataFrame, layout_b: DataFrame, nodes: DataFrame) -> DataFrame:
    """Leaves of the nodes that the replicas don't share: place, record_id, digest, copies_a, copies_b (null: not held)."""
    side = [x.join(nodes, "node", "left_semi").select("place", "record_id", "digest", F.col("copies").alias(f"copies_{n}")) for n, x in (("a", layout_a), ("b", layout_b))]
    b = side[1].select(F.col("place").alias("p"), F.col("record_id").alias("r"), F.col("digest").alias("d"), "copies_b")
    both = side[0].join(b, (F.col("place") == F.col("p")) & (F.col("digest") == F.col("d")) & F.col("record_id").eqNullSafe(F.col("r")), "full_outer")
    return (both.filter(~F.col("copies_a").eqNullSafe(F.col("copies_b")))
            .select(F.coalesce("place", "p").alias("place"), F.coalesce("record_id", "r").alias("record_id"), F.coalesce("digest", "d").alias("digest"),
                    "copies_a", "copies_b"))


def compare_replicas(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame, list[dict]]:
    """(layout of a, leaves that differ, trail of the audit) of two replicas (record_id, bytes)."""
    spark = a.sparkSession
    base = scratch_path(spark, "fixity")
    leaf = {n: leaves(x, f"{base}/leaves_{n}") for n, x in (("a", a), ("b", b))}
    levels = height(max(x.count() for x in leaf.values()))
    layout = {}
    for n, x in leaf.items():
        lay_out(x, levels).write.parquet(f"{base}/layout_{n}")
        layout[n] = spark.read.parquet(f"{base}/layout_{n}")
        build_tree(layout[n], f"{base}/tree_{n}", levels)
    nodes, trail = audit(spark, f"{base}/tree_a", f"{base}/tree_b", levels)
    differing(layout["a"], layout["b"], nodes).write.parquet(f"{base}/differing")
    return layout["a"], spark.read.parquet(f"{base}/differing"), trail


def fixity_report(pages: DataFrame, fault: Column) -> DataFrame:
    """Write two replicas of ``pages``, each on its own and the second with faults, audit them, and return every record
    of the first: page_id, length, sha256, copies, intact, segment, segment_offset."""
    spark = pages.sparkSession
    base = scratch_path(spark, "replicas")
    a = write_replica(pages, f"{base}/a")
    b = write_replica(pages, f"{base}/b", fault=fault)
    layout, bad, _ = compare_replicas(a, b)
    marked = bad.filter("copies_a is not null").select("place", F.col("digest").alias("d"), F.col("record_id").alias("r"), F.lit(False).alias("ok"))
    same = (layout["place"] == marked["place"]) & (layout["digest"] == marked["d"]) & layout["record_id"].eqNullSafe(marked["r"])
    return (layout.join(marked, same, "left")
            .select(F.col("record_id").alias("page_id"), "length", layout["digest"].alias("sha256"), "copies",
                    F.coalesce("ok", F.lit(True)).alias("intact"), "segment", F.col("offset").alias("segment_offset")))
