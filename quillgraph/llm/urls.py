"""URL rules by a blocked Bloom filter and an exact hash join.

Listed canonical URLs (host + path) allow or block a host, its subdomains and all that starts with their path. A page's URL gives
one candidate for each host suffix with as many labels as a listed host has, and each path length that the list has. Candidates probe a blocked Bloom filter, whose every key
sets eight bits of one 256-bit block; the few that pass go to an exact hash join with the list, which removes false hits.

Nulls, empties: a null url, or one without `://`, has an empty host and path, no candidates and the default verdict. Repeated
rows and urls are judged each for itself; candidates are made once for each distinct (host, path). Of rules with one host and path the
last verdict by name holds: block before allow. Extra columns are not read. Urls count whole; the html is never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, lower_ascii

#: Keys to a block: 8 keys of 8 bits in 256 leave about 1 false hit in 200.
KEYS_PER_BLOCK = 8
#: Blocks of 32 bytes that may be broadcast: 8 MB. A larger filter is joined by its block number.
BROADCAST_BLOCKS = 1 << 18


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): A-Z of the host lower-cased; both empty for null or a url without `://`."""
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def _bits(key: Column) -> list[Column]:
    """One bit in each of eight 32-bit words, as ints, from the key's second hash."""
    h = F.xxhash64(F.lit(7), key)
    return [F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(h, 5 * k).bitwiseAND(F.lit(31)).cast("int")) for k in range(8)]


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """keys (key) to a filter: block, b0 ... b7."""
    rows = keys.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), *[b.alias(f"b{k}") for k, b in enumerate(_bits(F.col("key")))])
    return rows.groupBy("block").agg(*[F.bit_or(f"b{k}").alias(f"b{k}") for k in range(8)])


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """pages (page_id, url) and rules (host, path, verdict) to page_id, host, path, rule, verdict; the longest rule that fits wins."""
    host, path = parts(F.col("url"))
    all_pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    listed = durable(rules.select(F.concat(lower_ascii(F.col("host")), "path").alias("key"), F.length("host").alias("host_length"), F.length("path").alias("path_length"), F.size(F.split("host", r"\.")).alias("labels"), F.col("verdict").alias("listed")).groupBy("key", "host_length", "path_length", "labels").agg(F.max("listed").alias("listed")))
    # as many lengths as paths have and as many numbers of labels as hosts have, not as rules
    count, lengths, labels = listed.agg(F.count(F.lit(1)), F.collect_set("path_length"), F.collect_set("labels")).first()
    blocks = max(1, -(-count // KEYS_PER_BLOCK))
    filt = bloom(listed.select("key"), blocks)

    names = F.split("host", r"\.")
    suffixes = F.transform(F.filter(F.array(*map(F.lit, sorted(labels))).cast("array<int>"), lambda n: n <= F.size(names)), lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n))
    heads = F.transform(F.filter(F.array(*map(F.lit, sorted(lengths))).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    asked = all_pages.where("host <> ''").select("host", "path").distinct()
    candidates = asked.withColumn("suffix", F.explode(suffixes)).withColumn("head", F.explode(heads)).select("host", "path", F.concat("suffix", "head").alias("key"), F.length("suffix").alias("suffix_length"))
    probed = candidates.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    passes = F.lit(True)
    for k, b in enumerate(_bits(F.col("key"))):
        passes = passes & (F.col(f"b{k}").bitwiseAND(b) != 0)
    possible = probed.join(F.broadcast(filt) if blocks <= BROADCAST_BLOCKS else filt, "block").where(passes)
    exact = possible.join(listed, "key").where("suffix_length = host_length")
    best = exact.groupBy("host", "path").agg(F.max(F.struct(F.length("key").alias("n"), F.col("suffix_length").alias("m"), F.col("key").alias("rule"), F.col("listed").alias("verdict"))).alias("best"))
    out = all_pages.join(best, ["host", "path"], "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
