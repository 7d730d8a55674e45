"""Sharding by longest processing time: groups by falling size, each to the least-loaded shard.

Equal texts stay together. A heap cannot hold every group of a corpus, so groups above a fixed share
of all bytes are items of their own (there can only be SHARDS * LARGE of them) and the small ones are
dealt by hash into BUNDLES bundles per shard, each of which is one item. The driver sees these items
only; rows are never moved, and each looks its item up in two small broadcast tables.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.store import land, text_of, with_row_id

LARGE = 256
BUNDLES = 1024


def longest_first(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Item to shard: the largest first, ties by name, each to the shard with the least load, ties to the lowest."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for name, size in sorted(items, key=lambda item: (-item[1], item[0])):
        load, shard = heapq.heappop(heap)
        placed[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def shard_rows(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    `size` is the UTF-8 length of the text plus 1, null texts count as empty and share a group with
    empty ones; rows with equal texts get the same shard, whatever their ids. `slot` numbers the rows
    of a shard from 0 without gaps. The law is `bytes`: the loads differ by no more than a large
    group or a bundle, unless a single group exceeds a fair share. `grown_shard` is null.
    """
    text = text_of(text_col)
    rows = with_row_id(land(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest")), "sizes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = land(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "groups")
    least = max(1, total // (shards * LARGE))
    bundle = F.pmod(F.xxhash64("digest"), F.lit(shards * BUNDLES)).cast("int")
    large = groups.filter(F.col("bytes") > least)
    small = groups.filter(F.col("bytes") <= least).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes"))
    items = [("g" + r[0], r[1]) for r in large.select(F.hex("digest"), "bytes").collect()]
    items += [(f"b{r[0]}", r[1]) for r in small.collect()]
    placed = longest_first(items, shards)
    spark = docs.sparkSession
    by_group = spark.createDataFrame(
        [(bytes.fromhex(k[1:]), v) for k, v in placed.items() if k[0] == "g"], "digest binary, own int")
    by_bundle = spark.createDataFrame([(int(k[1:]), v) for k, v in placed.items() if k[0] == "b"], "bundle int, shared int")
    dealt = (rows.withColumn("bundle", bundle).join(F.broadcast(by_group), "digest", "left")
             .join(F.broadcast(by_bundle), "bundle", "left").withColumn("shard", F.coalesce("own", "shared")))
    # Slots: places within a landed file, after the rows of the same shard in earlier files.
    counts = dealt.groupBy("shard", "row_file").count()
    before = counts.select("shard", "row_file", (
        F.sum("count").over(Window.partitionBy("shard").orderBy("row_file")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "row_file").orderBy("row_index"))
    return dealt.withColumn("place", place).join(before, ["shard", "row_file"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("place") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
