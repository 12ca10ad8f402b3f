"""URL filters: suffix/prefix rules, and a blocked Bloom filter before an exact join.

Listed URLs are put in a canonical form and hashed. Each is entered in one
512-bit block of a Bloom filter: the hash picks the block, and one bit in each of
its eight 64-bit words. The filter is a table (block, eight words) built by
``bit_or`` and broadcast: its size is fixed by ``max_blocks`` whatever the list's
length, a longer list only lets more false positives through. Pages whose bits
are all set are possible hits; a hash join with the list on the canonical URL
keeps the real ones.

Defined results: a null url or one without ``://`` has an empty host and path, no
canonical form, fits no rule and is never listed; nulls and repeats in the list
are ignored; repeated pages each get their verdict; extra columns pass through,
and columns named like a result are replaced; an empty list allows all.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import lookup_join, lower_ascii, stored

BLOCK_WORDS = 8
MAX_BLOCKS = 1 << 18          # 16 MB of bits at most
URLS_PER_BLOCK = 42           # about 12 bits a URL


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains, and a path prefix."""
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(rest), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without default port and final dot, path without final slashes, query
    without ``utm_`` parameters; scheme and fragment go. Null without ``://``."""
    host = F.regexp_replace(host_of(url), r"(:80|:443)$", "")
    host = F.regexp_replace(host, r"\.$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_")), "&")
    return F.when(url.contains("://"), F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept))
                                                .otherwise("")))


def rule_columns(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits columns ``host`` and ``path``."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = (((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host))
                & F.col("path").startswith(rule.path))
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _bits(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a URL and its bit in each word of the block."""
    h = F.xxhash64(url)
    g = F.xxhash64(url, F.lit("bits"))
    words = [F.call_function("shiftleft", F.lit(1).cast("long"),
                             F.shiftrightunsigned(g, 6 * i).bitwiseAND(63).cast("int"))
             for i in range(BLOCK_WORDS)]
    return F.pmod(h, F.lit(blocks)).alias("_block"), words


def bloom_filter(listed: DataFrame, column: str, blocks: int) -> DataFrame:
    """The filter of the values of ``column``: (_block, _w0 .. _w7), ``blocks`` rows at most."""
    block, words = _bits(F.col(column), blocks)
    bits = listed.select(block, *(w.alias(f"_w{i}") for i, w in enumerate(words)))
    return bits.groupBy("_block").agg(*(F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(BLOCK_WORDS)))


def possible_hits(pages: DataFrame, column: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``pages`` whose bits are all in the filter: every listed row, and few others."""
    block, words = _bits(F.col(column), blocks)
    probed = pages.withColumn("_block", block).join(F.broadcast(bloom), "_block")
    all_set = reduce(Column.__and__, (F.col(f"_w{i}").bitwiseAND(w) == w for i, w in enumerate(words)))
    return probed.filter(all_set).select(*pages.columns)


def filter_urls(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url",
                listed_url: str = "url", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``pages`` plus host, path, rule, listed (boolean) and verdict.

    The verdict is the longest fitting rule's, else ``block`` for a listed page
    and ``allow`` for any other.
    """
    pages = pages.drop("host", "path", "rule", "listed", "verdict").withColumn("_url", canonical(F.col(url)))
    exact = stored(listed.select(canonical(F.col(listed_url)).alias("_url")).filter("_url IS NOT NULL").distinct(),
                   "listed-urls")
    blocks = max(1, min(max_blocks, -(-exact.count() // URLS_PER_BLOCK)))
    bloom = bloom_filter(exact, "_url", blocks)
    possible = possible_hits(pages.select("_url").filter("_url IS NOT NULL"), "_url", bloom, blocks).distinct()
    hits = stored(possible.join(exact, "_url", "left_semi").withColumn("_hit", F.lit(True)), "listed-hits")
    name, verdict = rule_columns(rules)
    out = (lookup_join(pages, hits, ["_url"])
           .withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)),
                         "listed": F.coalesce("_hit", F.lit(False))}).drop("_url", "_hit"))
    return out.withColumns({"rule": name, "verdict": F.coalesce(
        verdict, F.when(F.col("listed"), "block").otherwise("allow"))})
