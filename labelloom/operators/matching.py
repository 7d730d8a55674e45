"""Map free-text descriptions to the frequent ones by fuzzy similarity."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.similarity import best_matches
from labelloom.session import save_point, small_side

TEXTS_PER_BLOCK = 20_000
TARGETS_PER_BLOCK = 5_000
NO_MATCH = "none"


def _blocks(table: DataFrame, size: int) -> Column:
    """Number of blocks that keeps about `size` rows in each, as a scalar subquery."""
    return table.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size)).cast("int").alias("blocks")).scalar()


def _all_blocks(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), count - 1))


def fuzzy_matches(counts: DataFrame, percent_threshold: float, min_similarity: float) -> DataFrame:
    """(text, match, score) for every distinct text; `counts` is (text, count).

    Texts whose count exceeds the given percent of the number of *distinct* texts are majors and
    match themselves; each other text takes the most similar major, or `none` below the cutoff. A match
    needs no shared token, so every block of texts meets every block of majors in some task; there a
    token index and bounds by length and characters leave few pairs to be compared, and a task keeps
    one candidate per text.
    """
    counts = save_point(counts)  # read several times below; one row per distinct text
    distinct = counts.agg(F.count("*").alias("n")).scalar()
    is_major = F.col("count") > distinct * F.lit(percent_threshold / 100)
    majors, minors = counts.filter(is_major), counts.filter(~is_major)
    text_blocks, major_blocks = _blocks(minors, TEXTS_PER_BLOCK), _blocks(majors, TARGETS_PER_BLOCK)
    spread = F.xxhash64("text")
    left = minors.select("text", F.pmod(spread, text_blocks).cast("int").alias("text_block")).select(
        "*", _all_blocks(major_blocks).alias("major_block")
    )
    right = majors.select(
        "text", "count", F.pmod(spread, major_blocks).cast("int").alias("major_block")
    ).select("*", _all_blocks(text_blocks).alias("text_block"))
    keys = ["text_block", "major_block"]

    def score(texts: pd.DataFrame, targets: pd.DataFrame) -> pd.DataFrame:
        return best_matches(texts, targets, min_similarity)

    candidates = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        score, "text string, match string, score double, match_count long"
    )
    best = candidates.groupBy("text").agg(
        F.min_by(F.struct("match", "score"), F.struct(-F.col("score"), -F.col("match_count"), "match")).alias("best")
    )
    matched = minors.select("text").join(best, "text", "left").select(
        "text", F.coalesce("best.match", F.lit(NO_MATCH)).alias("match"), F.col("best.score").alias("score")
    )
    own = majors.select("text", F.col("text").alias("match"), F.lit(100.0).alias("score"))
    return own.unionByName(matched)


def fuzzy_group(
    df: DataFrame, column: str, percent_threshold: float = 3, min_similarity: float = 60, target: str = "fuzzy_match"
) -> DataFrame:
    """Add the matched major description to every row; a null description stays null.

    The mapping holds one row per distinct text, so the rows are read once to count and once to
    attach the match.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("text")).agg(F.count("*").alias("count"))
    mapping = fuzzy_matches(counts, percent_threshold, min_similarity)
    renamed = mapping.select(F.col("text").alias(column), F.col("match").alias(target))
    return df.join(small_side(renamed), column, "left")
