"""Benchmark decontamination: size-partitioned MinHash containment search, by DataFrame functions only.

Test items are short and documents may be very long, so a document's own MinHash says nothing about an
item in it. Both sides are partitioned by size: items into classes whose largest size L doubles, and
for each class every document into windows of 2 L shingles, one every L, so that any run of L shingles
lies inside a window. An item with `share` of its shingles in a window then has a Jaccard similarity
of at least share * q / (2 L + (1 - share) * q) with it, q > L / 2, and each class takes as many
MinHash functions, one per band, as find that similarity with the wanted recall.

A band can only agree where the window holds the item's smallest shingle under that function. So
documents are first narrowed to the places where a shingle is one of those smallest ones, by a lookup
in the items' signatures, and only windows around such places get their minimum computed. Candidates
are then verified exactly, on all distinct shingles of the whole document.

An item of fewer than five words has no shingle of five; its one run of all its words is looked up among
the documents' runs of that length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.store import ROW, SPACES, free_name, land, light, numbered

SHARE = 0.75
SHINGLE = 5
SMALLEST = 8
# Chance of missing an item whose matching shingles stand in one run of its length.
MISS = 1e-4
# Signatures up to so many bytes are broadcast; larger ones are joined by shuffles.
BROADCAST_BYTES = 64 << 20


def with_runs(df: DataFrame, text: str, keep: dict[str, str]) -> DataFrame:
    """`keep` columns under new names, and `runs`: hashes of the 5-word runs of a text in order.

    Words are lower-cased. Fewer than five are one run, none give none. The words are a column of their
    own, so that they are split once and not for every run.
    """
    kept = [F.col(old).alias(new) for old, new in keep.items()]
    split = df.select(*kept, _words_of(F.col(text)).alias("words"))
    return split.select(*keep.values(), _runs_of(F.col("words")).alias("runs"))


def _words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES), lambda w: w != "")


def _runs_of(words: Column) -> Column:
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - SHINGLE + 1),
                       lambda i: F.xxhash64(*(F.element_at(words, (i + j).cast("int")) for j in range(SHINGLE))))
    return (F.when(F.size(words) >= SHINGLE, runs)
            .when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>")))


def bands_for(most: Column) -> Column:
    """MinHash functions for a class with items of up to `most` shingles, by its least similarity."""
    least = F.greatest(F.lit(1), F.floor(most / 2) + 1)
    least = F.when(most <= SMALLEST, F.lit(1)).otherwise(least)
    similarity = F.lit(SHARE) * least / (2 * most + (1 - SHARE) * least)
    return F.ceil(F.lit(math.log(MISS)) / F.log(1 - similarity)).cast("int")


def minhash(h: Column, band: Column) -> Column:
    return F.xxhash64(h, band)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every item found in a document.

    Found is an item of which at least 75 % of the distinct 5-word shingles occur in the document.
    Items with fewer words are one shingle, which a document holds if these words follow each other in it.
    Null and empty texts and items match nothing; ids may be null or repeat, equal rows give one
    result. Other columns are ignored.
    """
    size = F.size("set")
    given = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    documents = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    worded = given.select("item_id", "text", F.size(_words_of(F.col("text"))).alias("n_words"))
    sized = land(
        with_runs(worded.filter(F.col("n_words") >= SHINGLE), "text", {"item_id": "item_id"})
        .select("item_id", F.array_distinct("runs").alias("set")).filter(size > 0)
        .withColumn("most", F.greatest(F.lit(SMALLEST), F.pow(2, F.ceil(F.log2(size)))).cast("int"))
        .dropDuplicates(), "items")
    banded = sized.withColumn("band", F.explode(F.sequence(F.lit(1), bands_for(F.col("most")))))
    # The smallest shingle of each item under each function.
    smallest = F.array_min(F.transform("set", lambda h: F.struct(minhash(h, F.col("band")).alias("m"), h.alias("h"))))
    signatures = land(banded.select("item_id", "most", "band", smallest.alias("s"))
                      .select("item_id", "most", "band", "s.m", "s.h"), "signatures")
    wanted = signatures.select("h", "most", "band", "m").distinct()

    shingled = with_runs(documents, "text", {"doc_id": "doc_id"})
    small = signatures.count() * 32 <= BROADCAST_BYTES
    probe = F.broadcast if small else (lambda df: df)
    keys = wanted.select(F.col("h").alias("run")).distinct()
    # Outer generators: inner ones add a test for empty arrays, which the optimizer would push to the
    # scan and there build the arrays a second time.
    places = (shingled.select("doc_id", F.posexplode_outer("runs").alias("at", "run")).join(probe(keys), "run", "left_semi"))
    # Windows of a class start every `most` shingles; a place lies in at most two of them.
    starts = F.array_distinct(F.array(
        F.greatest(F.lit(0), F.floor(F.col("at") / F.col("most")) - 1), F.floor(F.col("at") / F.col("most"))))
    asked = (places.join(probe(wanted), F.col("run") == F.col("h"))
             .select("doc_id", "most", "band", "m", F.explode(starts).alias("window")).distinct())
    owners = land(asked, "windows")
    own = light(land(owners.select(F.col("doc_id").alias("_own")).distinct(), "owners"))
    held = land(documents.join(own, F.col("doc_id").eqNullSafe(F.col("_own")), "left_semi"), "holders")
    runs = land(with_runs(held, "text", {"doc_id": "_doc"}), "runs")
    per_document = owners.groupBy("doc_id").agg(F.collect_list(F.struct("most", "band", "m", "window")).alias("asked"))
    # A window agrees when none of its shingles is smaller under the band's function.
    agreed = F.filter("asked", lambda q: ~F.exists(
        F.slice(F.col("runs"), (q["window"] * q["most"] + 1).cast("int"), (2 * q["most"]).cast("int")),
        lambda h: minhash(h, q["band"]) < q["m"]))
    met = (per_document.join(runs, F.col("doc_id").eqNullSafe(F.col("_doc")))
           .select("doc_id", F.explode_outer(agreed).alias("q")).filter("q is not null").select("doc_id", "q.most", "q.band", "q.m"))
    candidates = met.join(signatures, ["most", "band", "m"]).select("doc_id", "item_id", "most").distinct()
    # Verification: all candidate items of a document against its whole set, counted within the row.
    lists = (candidates.join(sized, ["item_id", "most"])
             .groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "set")).alias("items")))
    checked = (lists.join(runs, F.col("doc_id").eqNullSafe(F.col("_doc")))
               .select("doc_id", "items", F.array_distinct("runs").alias("held"))
               .select("doc_id", F.explode_outer(F.transform("items", lambda i: F.struct(
                   i["item_id"].alias("item_id"), F.size(i["set"]).cast("long").alias("n_item"),
                   F.size(F.array_intersect(F.col("held"), i["set"])).cast("long").alias("n_shared")))).alias("r"))
               .select("doc_id", "r.*"))
    found = (checked.filter(F.col("n_shared") * 100 >= F.col("n_item") * int(SHARE * 100))
             .groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared")))
    short = _short_leaks(documents, worded.filter(F.col("n_words").between(1, SHINGLE - 1)))
    return (found if short is None else found.unionByName(short)).withColumn("containment", F.col("n_shared") / F.col("n_item"))


def _short_leaks(documents: DataFrame, items: DataFrame) -> DataFrame | None:
    """(doc_id, item_id, n_item, n_shared) of items of fewer than SHINGLE words; None if there are no such items."""
    short = land(items.select("item_id", "n_words", F.xxhash64(_words_of(F.col("text"))).alias("run")).distinct(), "short")
    lengths = sorted(r["n_words"] for r in short.select("n_words").distinct().collect())  # at most SHINGLE - 1 numbers
    if not lengths:
        return None
    words = documents.select("doc_id", _words_of(F.col("text")).alias("words"))

    def runs_of(k: int) -> Column:
        starts = F.when(F.size("words") >= k, F.sequence(F.lit(1), F.size("words") - k + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(
            F.lit(k).alias("n_words"), F.xxhash64(F.slice(F.col("words"), i, k)).alias("run")))

    runs = F.concat(*(runs_of(k) for k in lengths))
    held = words.select("doc_id", F.explode_outer(runs).alias("r")).select("doc_id", "r.n_words", "r.run")
    return (held.join(light(short), ["n_words", "run"]).select("doc_id", "item_id").distinct()
            .select("doc_id", "item_id", F.lit(1).cast("long").alias("n_item"), F.lit(1).cast("long").alias("n_shared")))


def drop_leaking(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in which no item was found; all columns stay. Each row goes by its own text, whatever its id."""
    row = free_name(docs, ROW)
    rows = numbered(docs, row)
    found = light(land(leaks(rows, items, row, text_col).select(F.col("doc_id").alias(row)).distinct(), "leaks"))
    return rows.join(found, row, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
