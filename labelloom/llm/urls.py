"""URL filters by a Bloom filter cascade, with DataFrame functions only.

A rule is a key, host and path run together, and a URL's possible keys are its host's suffixes at a
label's edge with its path's prefixes, as long as some rule's are. All possible keys of the corpus are
the universe over which the cascade is exact: its first level is a Bloom filter of the rules' keys, the
second one of the universe's keys that the first wrongly lets through, the third of the rules' keys that
the second wrongly lets through, and so on until a level lets no key of the other side through. A key's
place is the first level that does not know it. So URLs find their rules by looking at a few bits
that come with the plan, and no URL is joined with anything.

The first level's rate of false positives is chosen by the sizes of both sides, so that the universe's
keys behind it are about as many as the rules'; only these are ever shuffled.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.store import LOWER, land

# Rules of one cascade, so that its bits stay below some 2 MB. More rules are dealt to several cascades by hash.
KEYS = 250_000
LEVELS = 64
# False positives of all levels but the first; smaller is fewer levels with more bits.
_RATE = 1 / 8


class Level:
    """One Bloom filter: its bits, how many there are, and how many are asked for a key."""

    def __init__(self, number: int, keys: int, rate: float):
        self.number = number
        self.asked = max(1, math.ceil(-math.log2(rate)))
        self.size = 8 * max(8, math.ceil(max(1, keys) * self.asked / math.log(2) / 8))
        self.bits = b""

    def places(self, key: Column) -> list[Column]:
        """The bits of a key, by hashes of its own for each level."""
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(i)), F.lit(self.size)) for i in range(self.asked)]

    def build(self, keys: DataFrame) -> None:
        """Set the bits of all `key` values. Bytes are put together from tasks' own; the row is at most a few MB."""
        place = keys.select(F.explode(F.array(*self.places(F.col("key")))).alias("place"))
        one = F.call_function("shiftleft", F.lit(1), F.pmod("place", F.lit(8)).cast("int"))
        held = place.select(F.floor(F.col("place") / 8).alias("at"), one.alias("byte"))
        every = keys.sparkSession.range(self.size // 8).select(F.col("id").alias("at"), F.lit(0).alias("byte"))
        row = every.unionByName(held).groupBy("at").agg(F.bit_or("byte").alias("byte"))
        pairs = F.array_sort(F.collect_list(F.struct("at", F.lpad(F.hex("byte"), 2, "0").alias("hex"))))
        self.bits = bytes(row.agg(F.unhex(F.concat_ws("", F.transform(pairs, lambda p: p["hex"]))).alias("bits")).first()["bits"])

    def knows(self, key: Column) -> Column:
        """True if all bits of the key are set."""
        def bit(place: Column) -> Column:
            byte = F.conv(F.hex(F.substring(F.lit(self.bits), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            return F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int")).bitwiseAND(1) == 1
        return reduce(lambda a, b: a & b, [bit(place) for place in self.places(key)])


class Cascade:
    """Levels that hold exactly the listed keys among all keys of a universe."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def holds(self, key: Column) -> Column:
        """True for a listed key: the first level that does not know it is an even one, or none of an odd number is."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.knows(key), answer).otherwise(F.lit(level.number % 2 == 1))
        return answer


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Build a cascade for the `key`s of `listed` among all `key`s of `universe`, which may repeat and hold listed ones."""
    listed = land(listed.select("key").distinct(), "listed")
    count = listed.count()
    if not count:
        return Cascade([])
    sketch = universe.agg(F.approx_count_distinct("key").alias("n")).first()["n"]
    # False positives of the first level: about as many as the listed keys.
    first = Level(0, count, min(_RATE, max(2.0 ** -40, count / max(1, sketch) / math.sqrt(2))))
    first.build(listed)
    passed = universe.filter(first.knows(F.col("key"))).select("key", F.lit(False).alias("in"))
    both = passed.unionByName(listed.select("key", F.lit(True).alias("in")))
    sides = land(both.groupBy("key").agg(F.max("in").alias("in")), "sides")
    levels = [first]
    while len(levels) < LEVELS:
        # The side that the last level should not have let through; the level after it knows these keys.
        wrong = sides.filter(~F.col("in") if len(levels) % 2 == 1 else F.col("in"))
        for level in levels[1:]:
            wrong = wrong.filter(level.knows(F.col("key")))
        left = wrong.count()
        if not left:
            return Cascade(levels)
        level = Level(len(levels), left, _RATE)
        level.build(wrong)
        levels.append(level)
    raise RuntimeError("a key of both sides passes every level, which only equal hashes of different keys explain")


def with_host(pages: DataFrame, url_col: str, host: str = "host", path: str = "path") -> DataFrame:
    """`host` and `path` of a URL: between the first `://` and `/`, `?` or `#`, and on from there up to `?` or `#`.

    A-Z of the host are lower-cased. A null URL and one without `://` have empty ones.
    """
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    head = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    tail = F.regexp_extract(F.substring(rest, F.length(head) + 1, F.length(rest)), r"\A([^?#]*)", 1)
    return pages.withColumns({host: F.translate(head, *LOWER), path: tail})


def _keys(host: Column, path: Column, hosts: list[int], paths: list[int]) -> Column:
    """Possible keys: suffixes of the host at a label's edge and prefixes of the path, of the given lengths."""
    edge = lambda n: (F.length(host) == n) | ((F.length(host) > n) & (F.substring(host, F.length(host) - n, F.lit(1)) == "."))
    ends = F.transform(F.filter(F.array(*map(F.lit, hosts)), edge), lambda n: F.substring(host, F.length(host) - n + 1, n))
    heads = F.transform(F.filter(F.array(*map(F.lit, paths)), lambda n: F.length(path) >= n), lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(ends, lambda e: F.transform(heads, lambda p: F.struct(
        F.concat(e, p).alias("key"), F.length(e).alias("of_host")))))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages`.

    `rules` (host, path, action) block or allow: a rule fits its host and all subdomains where the URL's path
    starts with its own. Of several the longest wins, then the one with the longer host; a URL that no
    rule fits is not listed, has a null rule and is allowed. A rule given with both actions blocks. Rules with a null or
    empty host or another action are ignored, a null path is empty; rule hosts are lower-cased as the URLs' are.
    Null ids and repeated rows each come back; other columns are ignored. Host and path are told apart in a key
    by the first `/`; rules with one in their host or with a path that does not start with one fit no URL.
    """
    path = F.coalesce(F.col("path"), F.lit(""))
    given = rules.filter("host <> '' and action in ('allow', 'block')").select(F.translate("host", *LOWER).alias("host"), path.alias("path"), "action")
    given = given.filter(((F.col("path") == "") | F.col("path").startswith("/")) & ~F.col("host").contains("/"))
    listed = land(given.groupBy("host", "path").agg(F.max("action").alias("action"))
                  .select(F.concat("host", "path").alias("key"), F.length("host").alias("h"), F.length("path").alias("p"), "action"), "rules")
    shape = listed.agg(F.sort_array(F.collect_set("h")).alias("h"), F.sort_array(F.collect_set("p")).alias("p"), F.count("*").alias("n")).first()
    urls = with_host(pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("_url")), "_url").drop("_url")
    if not shape["n"]:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    keys = _keys(F.col("host"), F.col("path"), shape["h"], shape["p"])
    universe = urls.select(F.explode(F.transform(keys, lambda k: k["key"])).alias("key"))
    parts = math.ceil(shape["n"] / KEYS)
    part = F.pmod(F.xxhash64("key", F.lit("part")), F.lit(parts))
    judged = urls.withColumn("_found", F.array().cast("array<struct<key:string,of_host:int>>"))
    for i in range(parts):
        known = cascade(listed.filter(part == i), universe.filter(part == i))
        judged = judged.withColumn("_found", F.concat("_found", F.filter(keys, lambda k: (
            (F.pmod(F.xxhash64(k["key"], F.lit("part")), F.lit(parts)) == i) & known.holds(k["key"])))))  # noqa: B023
        judged = land(judged, "found") if parts > 1 else judged
    longest = F.array_max(F.transform("_found", lambda k: F.struct(F.length(k["key"]).alias("n"), k["of_host"].alias("h"), k["key"].alias("key"))))
    judged = judged.select("page_id", "host", "path", longest["key"].alias("rule"))
    # Among rules alone, a second cascade tells those that block.
    blocking = F.lit(False)
    for i in range(parts):
        known = cascade(listed.filter("action = 'block'").filter(part == i), listed.filter(part == i))
        blocking = blocking | ((F.pmod(F.xxhash64("rule", F.lit("part")), F.lit(parts)) == i) & known.holds(F.col("rule")))
    return judged.withColumn("verdict", F.when(F.col("rule").isNotNull() & blocking, "block").otherwise("allow"))
