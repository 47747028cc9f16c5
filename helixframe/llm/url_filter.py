"""URL rules by a sort-merge range join (operator 1).

A rule (host, path) fits its host and all subdomains if the url's path starts with the rule's.
Hosts are keyed by their labels in reverse, each with a dot (``www.a.org`` -> ``org.a.www.``), so
that a host with all its subdomains is the key interval [``org.a.``, ``org.a/``). Such intervals are
nested or disjoint: one sweep over urls and rules sorted by key keeps the open ones on a stack
(never deeper than a host's labels) and finds every fitting rule there.

Urls are dealt into key ranges (ties split by a hash of the row, so that one host may fill many
ranges; equal rows of a batch travel once, with their number); a rule goes to every range that its interval meets.

The longest fitting rule string (host + path) wins; of two equally long the longer host; of equal
rules that contradict each other ``block``. Without a fitting rule the verdict is ``default``.

Defined results: a null url, or one without ``://``, has an empty host and path; the empty host is fitted by no
rule. Null rule hosts or paths drop that rule; no rules: every url gets the default; no urls: no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUT_ROWS = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path
    from there up to ``? #`` or the end. Both empty if there is no ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]", -1)), "."), F.lit("."))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
                ranges: int | None = None, sample_per_range: int = 64) -> DataFrame:
    """page_id, host, path, rule, verdict of every url. ``rules``: host, path, verdict.

    ``sample_per_range`` keys per range (the rows with the smallest hash) are taken to the driver
    to place the range borders; borders steer balance only.
    """
    spark = pages.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                        F.xxhash64(F.col(id_col), F.col(url_col)).alias("salt"))
    urls = urls.withColumn("key", host_key(F.col("host")))
    # key, then salt in hex: the order of ranges inside one host
    spot = F.concat(F.col("key"), F.lit("\x01"), F.lpad(F.hex("salt"), 16, "0"))
    sample = sorted(r[0] for r in urls.select(spot.alias("k"), "salt").orderBy("salt", "k").limit(n * sample_per_range).collect())
    borders = sorted({sample[i * len(sample) // n] for i in range(1, n)}) if sample else []

    def ranges_of(batches):
        for b in batches:
            if not b.num_rows:
                continue
            names = b.schema.names
            once = pa.Table.from_batches([b]).group_by(names, use_threads=False).aggregate([([], "count_all")]).combine_chunks()
            columns = [once.column(c).combine_chunks() for c in (*names, "count_all")]
            at = pa.array([bisect_right(borders, k) for k in once.column("spot").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*columns, at], names=[*names, "copies", "range"])

    def rule_ranges(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                # a border equal to the interval's low end still leaves the range below untouched
                lo, hi = bisect_left(borders, r["key"]), bisect_left(borders, r["key"][:-1] + "/")
                out += [(i, r["key"], r["host"], r["path"], r["verdict"]) for i in range(lo, hi + 1)]
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.string()) for c in cols[1:]]],
                                                 names=["range", "key", "host", "path", "verdict"])

    url_rows = (urls.withColumn("spot", spot).drop("salt")
                .mapInArrow(ranges_of, _with_range(urls.drop("salt"))).drop("spot")
                .withColumn("kind", F.lit(1)).withColumn("verdict", F.lit(None).cast("string")))
    clean = (rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", F.col("verdict").cast("string").alias("verdict"))
             .dropna().filter("host <> ''").withColumn("key", host_key(F.col("host"))))
    rule_rows = (clean.mapInArrow(rule_ranges, "range int, key string, host string, path string, verdict string")
                 .withColumn("kind", F.lit(0)).withColumn("copies", F.lit(1).cast("long"))
                 .withColumn("page_id", F.lit(None).cast(pages.schema[id_col].dataType)))
    both = url_rows.unionByName(rule_rows).repartitionById(len(borders) + 1, F.col("range")).sortWithinPartitions("range", "key", "kind")
    schema = urls.select("page_id", "host", "path").schema.add("rule", "string").add("verdict", "string")

    def sweep(batches):
        stack: list[tuple[str, dict, list]] = []      # (end of interval, verdict by path, path lengths longest first)
        here, top = None, None
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("range", "key", "kind", "host", "path", "verdict")), strict=True)
            keep, found, verdicts, copies = [], [], [], b.column("copies").to_pylist()
            for i, (rng, key, kind, host_, path_, verdict) in enumerate(rows):
                if rng != here:
                    here, stack, top = rng, [], None
                while stack and key >= stack[-1][0]:
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][3] != host_:
                        stack.append((key[:-1] + "/", {}, [], host_))
                    by_path = stack[-1][1]
                    by_path[path_] = "block" if "block" in (verdict, by_path.get(path_)) else verdict
                    stack[-1][2][:] = sorted({len(p) for p in by_path}, reverse=True)
                    continue
                best, top = None, None
                for _, by_path, lengths, rule_host in reversed(stack):      # longer hosts first: ties stay with them
                    for k in lengths:
                        if best is not None and len(rule_host) + k <= best:
                            break
                        if k <= len(path_) and path_[:k] in by_path:
                            best, top = len(rule_host) + k, (rule_host + path_[:k], by_path[path_[:k]])
                            break
                keep.append(i)
                found.append(top[0] if top else None)
                verdicts.append(top[1] if top else default)
            if keep:
                t = b.take(pa.array(keep))
                t = pa.RecordBatch.from_arrays(
                    [t.column("page_id"), t.column("host"), t.column("path"), pa.array(found, pa.string()), pa.array(verdicts, pa.string())],
                    names=["page_id", "host", "path", "rule", "verdict"])
                # every copy is a row again, at most OUT_ROWS a batch
                ends = np.cumsum([copies[i] for i in keep])
                for lo in range(0, int(ends[-1]), OUT_ROWS):
                    yield t.take(pa.array(np.searchsorted(ends, np.arange(lo, min(lo + OUT_ROWS, int(ends[-1]))), "right")))

    return both.select("page_id", "range", "key", "kind", "host", "path", "verdict", "copies").mapInArrow(sweep, schema)


def _with_range(df: DataFrame):
    return df.schema.add("spot", "string").add("copies", "long").add("range", "integer")
