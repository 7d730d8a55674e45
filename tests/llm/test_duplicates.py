"""Exact, line and near duplicates, shards and leaks against brute force, with the awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import exact, jaccard, leaks, lines, quality, shards

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node string, shard int"


def words(text):
    return [w for w in re.split("[ \t\n\x0b\f\r]+", (text or "").translate(LOWER)) if w]


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def texts():
    """Near copies at many distances, exact copies, shared passages, null, empty, short and long texts."""
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(4000)]
    passage = " ".join(rng.choices(pool, k=60))
    out = [None, None, "", "  \n\t ", "One two", "one TWO", "a b c d", "a b c d e", "A b\nc d e"]
    for _ in range(6):
        base = rng.choices(pool, k=rng.choice([12, 40, 150]))
        for copy in range(9):
            edited = list(base)
            for _ in range(rng.choice([0, 1, 2, len(base) // 25, len(base) // 12])):
                edited[rng.randrange(len(edited))] = rng.choice(pool)
            out.append(" ".join(edited))
            if copy % 4 == 0:
                out.append(" ".join(edited).upper())
    out += [" ".join(rng.choices(pool, k=80)) + " " + passage for _ in range(12)]
    out.append(" ".join(rng.choices(pool, k=60_000)))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, 0.5, "x", 3) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    made = list(enumerate(texts()))
    return [*made, made[9], made[9], (None, "one two"), (None, "only here " * 9)]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_classes(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = defaultdict(lambda: None)
    for k, (i, _) in enumerate(sets):
        if i is not None and (least[find(k)] is None or i < least[find(k)]):
            least[find(k)] = i
    return [(i, len(s), least[find(k)] if s else i) for k, (i, s) in enumerate(sets)]


def test_jaccard_classes(spark, rows):
    got = jaccard.jaccard_classes(table(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(tuple(r) for r in got) == Counter(brute_classes(rows))


def test_jaccard_dense_tiles(spark):
    # One group above DENSE_LEAST of copies at all distances around the limit.
    rng = random.Random(8)
    base = [f"v{i}" for i in range(90)]
    made = []
    for i in range(160):
        edited = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
            edited[rng.randrange(90)] = f"x{rng.randrange(9999)}"
        made.append((i, " ".join(edited)))
    got = jaccard.jaccard_classes(table(spark, made)).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(tuple(r) for r in got) == Counter(brute_classes(made))


def test_jaccard_empty(spark):
    assert jaccard.jaccard_classes(empty(spark)).count() == 0


def test_drop_near_duplicates(spark, rows):
    docs = table(spark, rows)
    kept = jaccard.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    named = [(i, t) for i, t in rows if i is not None]
    want = {i for i, _, c in brute_classes(named) if i == c}
    got = Counter(r["doc_id"] for r in kept.collect())
    assert set(got) - {None} == want and got[None] == 1 and all(n == 1 for i, n in got.items() if i is not None)


def clashing(spark, rows):
    """Columns with the names that the stages use themselves, and one with a dot."""
    return spark.createDataFrame([(i, t, k, k + 1, k + 2, k + 3) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, _row int, `a.b` int, _score int, _leak int")


def test_stages_with_clashing_columns(spark):
    one, two = (" ".join(f"{k}{i}" for i in range(40)) for k in "ab")
    docs = clashing(spark, [(1, one), (2, one), (3, two), (None, one), (4, "")])
    items = spark.createDataFrame([(1, two)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").limit(0)
    expected = {tuple(r) for r in docs.collect()}
    for kept, ids in ((jaccard.drop_near_duplicates(docs), [1, 3, 4]), (leaks.drop_leaking(docs, items), [None, 1, 2, 4]),
                      (quality.drop_bad(docs, labels), [None, 1, 2, 3, 4])):
        found = kept.collect()
        assert kept.columns == docs.columns and {tuple(r) for r in found} <= expected
        assert sorted((r["doc_id"] for r in found), key=lambda i: i or 0) == ids


def test_near_duplicates_go_by_row(spark):
    one, two, three = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(1, one), (2, one + " more"), (2, two), (2, ""), (2, None), (3, three), (3, three), (None, two + " x"), (None, two), (None, "alone")]
    kept = jaccard.drop_near_duplicates(table(spark, rows))
    got = Counter((r["doc_id"], (r["text"] or "")[:2]) for r in kept.collect())
    assert got == Counter([(1, "a0"), (2, "b0"), (2, ""), (2, ""), (3, "c0"), (None, "al")])
    assert jaccard.drop_near_duplicates(empty(spark)).count() == 0


def test_exact_groups(spark, rows):
    got = exact.exact_groups(table(spark, rows), share=20).collect()  # the larger groups count as heavy
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()].append(i)
    kept = Counter()
    for r in got:
        ids = groups[r["text_sha256"]]
        named = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids) and r["keep_id"] == (max(named) if named else None)
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1}
    assert exact.exact_groups(empty(spark)).count() == 0


def test_heavy_digests_are_bounded_and_complete(spark):
    many = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, b"hot").otherwise(F.col("id").cast("string").cast("binary")).alias("d"))
    found, least = exact.frequent(many.repartition(7), "d", share=100)
    names = [bytes(r[0]) for r in found.collect()]
    assert b"hot" in names and len(names) <= 201 and least == 300


def brute_lines(rows, min_docs=5):
    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(LOWER)

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        every = (t or "").split("\n")
        stay = []
        for line in every:
            own = holders.get(key(line), ())
            last = max((x for x in own if x is not None), default=None)
            if not (len(own) >= min_docs and i != last):
                stay.append(line)
        out.append((i, "\n".join(stay), len(every), len(every) - len(stay)))
    return Counter(out)


def line_rows(n=30):
    rng = random.Random(1)
    shared = [" ".join(rng.choices(["alpha", "beta", "gamma", "étage"], k=12)) for _ in range(6)]
    out = []
    for i in range(n):
        own = [rng.choice(shared) if rng.random() < 0.6 else f"line {rng.random()} of document {i} and some more words" for _ in range(8)]
        own += ["short", "", "\t" + own[0].upper() + " \r"]
        out.append((i, "\n".join(own)))
    return [*out, (n, None), (n + 1, ""), (None, shared[0]), (n + 2, shared[0] * 3000), out[3], out[3]]


def test_dedup_lines(spark):
    rows = line_rows()
    assert Counter(tuple(r) for r in lines.dedup_lines(table(spark, rows)).collect()) == brute_lines(rows)
    assert lines.dedup_lines(empty(spark)).count() == 0


def test_lines_insert_and_delete_are_reversible(spark):
    rows = line_rows()[:30]
    first, more = [r for r in rows if r[0] < 20], [r for r in rows if r[0] >= 20]
    docs = lambda x: table(spark, x).select("doc_id", "text")
    grown = lines.insert(lines.build(docs(first)), docs(more))
    assert Counter(tuple(r) for r in lines.drop_lines(grown, docs(rows)).collect()) == brute_lines(rows)
    shrunk = lines.delete(grown, table(spark, more).select("doc_id"))
    assert Counter(tuple(r) for r in lines.drop_lines(shrunk, docs(first)).collect()) == brute_lines(first)


def test_cuckoo_filter():
    keys = np.random.default_rng(0).integers(-(2 ** 62), 2 ** 62, 20_000)
    own = lines.Cuckoo.build(keys)
    assert own.contains(keys).all()
    other = np.random.default_rng(1).integers(-(2 ** 62), 2 ** 62, 20_000)
    assert own.contains(other).mean() < 0.01
    for k in keys[:5000].tolist():
        assert own.delete(k)
    assert own.contains(keys[5000:]).all() and own.contains(keys[:5000]).mean() < 0.01


def test_shards(spark, rows):
    got = shards.shard_rows(table(spark, rows), 4).collect()
    assert len(got) == len(rows)
    by_text = defaultdict(set)
    sizes = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sizes
    for r in got:
        by_text[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert shards.shard_rows(empty(spark)).count() == 0


def test_shard_loads_are_near_equal(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.expr("concat(id, repeat('x', cast(id % 97 as int)))").alias("text"))
    loads = [r[0] for r in shards.shard_rows(docs, 16).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(loads) == 16 and max(loads) - min(loads) < 0.02 * max(loads)


def test_shards_against_plain_scheduling(spark):
    """Loads differ from those of every group on its own, longest first, by no more than a bundle's bytes."""
    rng = random.Random(14)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.choice([1, 3, 40, 400]))) for _ in range(3000)]
    rows = [(i, rng.choice(texts[:30]) if i % 5 == 0 else texts[i % 3000]) for i in range(4000)] + [(4000, None), (4001, "")]
    groups = Counter()
    for _, text in rows:
        groups[text or ""] += len((text or "").encode()) + 1
    for n in (3, 16):
        placed = shards.longest_first(list(groups.items()), n)
        plain = Counter()
        for text, size in groups.items():
            plain[placed[text]] += size
        got = Counter()
        for r in shards.shard_rows(table(spark, rows), n).collect():
            got[r["shard"]] += r["size"]
        assert sum(got.values()) == sum(plain.values())
        least = max(1, sum(got.values()) // (n * shards.LARGE))
        # No bundle of these few small groups is larger than twice what a group may weigh to be small.
        assert all(abs(a - b) <= 2 * least for a, b in zip(sorted(got.values()), sorted(plain.values()), strict=True))


def test_longest_first():
    assert shards.longest_first([("a", 5), ("b", 4), ("c", 3), ("d", 3)], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}


def test_leaks(spark):
    rng = random.Random(2)
    pool = [f"w{i}" for i in range(5000)]
    items = [(k, " ".join(rng.choices(pool, k=n))) for k, n in enumerate([5, 9, 14, 30, 59, 120, 300])]
    items += [(7, None), (8, ""), (9, "just four words here"), (1, items[1][1])]
    rows = []
    for i in range(60):
        text = rng.choices(pool, k=rng.choice([3, 50, 400, 3000]))
        if i % 3 == 0:
            piece = items[i // 3 % 7][1].split()
            if i % 2:  # one changed word
                piece[len(piece) // 2] = "changed"
            at = rng.randrange(len(text))
            text[at:at] = piece
        rows.append((i, " ".join(text)))
    rows += [(60, None), (61, ""), (62, "Just FOUR words here"), rows[0], (None, items[4][1]), (63, " ".join(pool * 10) + " " + items[6][1])]
    given = spark.createDataFrame([(*x, "extra") for x in items], "item_id long, text string, doc_id string")
    found = {(r["doc_id"], r["item_id"]): (r["n_item"], r["n_shared"]) for r in leaks.leaks(table(spark, rows), given).collect()}
    want = {}
    for i, t in rows:
        for k, x in items:
            own, held = shingles(x), shingles(t)
            if own and 100 * len(own & held) >= 75 * len(own):
                want[i, k] = (len(own), len(own & held))
    assert found == want
    kept = leaks.drop_leaking(table(spark, rows), given)
    assert kept.columns == table(spark, rows).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, _ in rows if i not in {a for a, _ in want})
    assert leaks.leaks(empty(spark), given).count() == 0 and leaks.leaks(table(spark, rows), given.limit(0)).count() == 0


def test_leaks_go_by_row(spark):
    text, clean = (" ".join(f"{k}{i}" for i in range(40)) for k in "ab")
    given = spark.createDataFrame([(1, text)], "item_id long, text string")
    rows = [(None, text), (None, clean), (None, None), (7, "x " + text), (7, clean), (7, clean), (8, text)]
    kept = leaks.drop_leaking(table(spark, rows), given)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(None, clean), (None, None), (7, clean), (7, clean)])


def test_short_items_are_found_inside_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(2000))
    given = spark.createDataFrame([(1, "just four words here"), (2, "w7\tW8"), (3, "w8 w7"), (4, "alone"), (4, "alone"), (5, " "), (6, None)],
                                  "item_id long, text string")
    rows = [(1, long + " JUST  four words\nhere " + long), (2, "just four words"), (3, "alone"), (3, "alone"), (4, None), (5, ""),
            (None, "not alone here"), (6, "w7 w8")]
    found = Counter(tuple(r) for r in leaks.leaks(table(spark, rows), given).collect())
    assert found == Counter((d, i, 1, 1, 1.0) for d, i in ((1, 1), (1, 2), (3, 4), (None, 4), (6, 2)))
    kept = leaks.drop_leaking(table(spark, rows), given)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5]
