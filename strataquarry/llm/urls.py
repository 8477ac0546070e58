"""URL filtering by rules on hosts and paths, and by a list of URLs behind a blocked Bloom filter.

A rule names a host and the beginning of a path; it fits its host and all subdomains, and the longest that fits gives the
verdict. Other URLs are blocked if their canonical form is listed. The list's blocked Bloom filter is a table of blocks of
eight 64-bit words, in which a URL sets one bit a word, all in one block, so a probe is one lookup; at 12 bits a URL about
one in 200 URLs that are not listed passes. Only URLs that pass go on to the exact hash join with the list, which removes
those; the rest never move. The filter is broadcast up to `largest` bytes, counted beforehand, and joined by its blocks
beyond. Everything is expressions and joins of the engine.

Canonical form: host and path, with A-Z of the host in lower case, without scheme, user, default port and a leading `www.`;
without index page, .html and closing slash; parameters sorted, without those that only track; no fragment.

Defined results: null, empty and relative URLs have an empty host and path, fit no rule and are allowed; only A-Z change
case; the path of a URL without one is empty, so no rule fits it; of rules of equal length the longer host wins; URLs of any length are
read whole; repeated rows are judged each, repeated or null list entries count once or not at all; other columns, whatever
their names, are ignored by `judge_urls`; an empty table gives an empty result, an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import cut, splittable

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Parameters that only track; a closing * stands for any rest.
TRACKING = ("utm_*", "ref", "gclid", "fbclid")
BITS, LANES, LARGEST = 12, 8, 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ://, empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The form that URLs of one page share; null for null, empty and relative URLs."""
    rest = _rest(url)
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^[^@]*@", ""), r"^www\.|:(?:80|443)\z", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"(?:/index)?\.html?\z", ""), r"/+\z", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    tracks = "^(?:" + "|".join(t[:-1].replace(".", r"\.") + "[^=]*" if t.endswith("*") else t.replace(".", r"\.") for t in TRACKING) + r")(?:=|\z)"
    kept = F.array_sort(F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike(tracks)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """struct(size, host size, rule, verdict) of the longest rule that fits, or null. Rules stand in the plan; long lists belong in the list of URLs."""
    one = []
    for verdict, of, begin in rules:
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(begin)
        found = F.struct(F.lit(len(of) + len(begin)).alias("size"), F.lit(len(of)).alias("host"), F.lit(of + begin).alias("rule"), F.lit(verdict).alias("verdict"))
        one.append(F.when(fits, found))
    return F.array_max(F.array(*one)) if one else F.lit(None).cast("struct<size:int,host:int,rule:string,verdict:string>")


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(F.lit("bits"), key)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(LANES)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom(listed: DataFrame, n: int, bits: int = BITS) -> tuple[DataFrame, int]:
    """(block, words) of the n different values of listed(key), and the number of blocks."""
    blocks = max(1, -(-n * bits // (64 * LANES)))
    words = [F.bit_or(f"m{i}") for i in range(LANES)]
    masks = [m.alias(f"m{i}") for i, m in enumerate(_masks(F.col("key")))]
    return listed.select(_block(F.col("key"), blocks).alias("block"), *masks).groupBy("block").agg(F.array(*words).alias("words")), blocks


def possible(rows: DataFrame, filtered: DataFrame, blocks: int, broadcast: bool) -> DataFrame:
    """rows(key, ...) with `possible`: the filter does not rule the key out."""
    passes = F.lit(True)
    for i, m in enumerate(_masks(F.col("key"))):
        passes &= F.element_at("words", i + 1).bitwiseAND(m) == m
    found = rows.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(filtered) if broadcast else filtered, "block", "left")
    return found.withColumn("possible", F.coalesce(passes & F.col("key").isNotNull(), F.lit(False))).drop("block", "words")


def judge_urls(pages: DataFrame, listed: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, bits: int = BITS, largest: int = LARGEST) -> DataFrame:
    """page_id, host, path, rule, verdict, listed of every row of pages(page_id, url); listed(url)."""
    keys = cut(listed.select(canonical(F.col("url")).alias("key")).where("key is not null").distinct())
    n = keys.count()
    filtered, blocks = bloom(keys, n, bits)
    filtered = cut(filtered)
    found = pages.select("page_id", "url").withColumns({"key": canonical(F.col("url")), "host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    found = found.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", "key", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("ruled"))
    probed = possible(found, filtered, blocks, blocks * (64 * LANES // 8 + 16) <= largest)
    sure = keys.withColumn("listed", F.lit(True)).hint("shuffle_hash")
    hits = splittable(probed.where("possible"), sure, ["key"], "left")
    misses = probed.where("not possible").withColumn("listed", F.lit(False))
    columns = ["page_id", "host", "path", "rule", "ruled"]
    judged = hits.select(*columns, F.coalesce("listed", F.lit(False)).alias("listed")).unionByName(misses.select(*columns, "listed"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
