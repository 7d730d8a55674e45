"""From scoped part lines to vocabulary labels, with the standing lists of the domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators.joins import ids_of
from labelloom.operators.matching import fuzzy_group
from labelloom.operators.scope import apply_remap, lower_texts, remove_blacklisted
from labelloom.session import small_side

# Terms in the damage condition that rule a line out.
CONDITION_TERMS = ("housing", "holder", "bracket")

# Descriptions that are relabelled as wheel.
WHEEL_DESCRIPTIONS = (
    "moulding wheel arch front rh", "moulding wheel arch front lh", "front wheel arch protector lh",
    "extension wheel arch front rh", "extension wheel arch front lh", "wheel arch finisher front lh",
    "wheel hub front lh", "moulding wheel arch rear rh", "extension wheel arch rear rh",
    "wheel house extension rear rh", "wheel arch finisher rear rh", "wheel hub rear lh",
    "extension wheel arch rear lh",
)

# Component words that rule a description out.
COMPONENT_TERMS = (
    "weatherstrip", "finisher", "wiring", "hinge", "bulb", "trimboard", "bracket", "sensor", "lock",
    "sealant", "silencer",
)

# Patterns that rule a description out.
DESCRIPTION_TERMS = (
    "roof moulding rh", "roof moulding lh", "door hinge", "headlamp bulb", "lambda sensor",
    "rocker cover", "mirror rear view", "bumper front finisher rh", "radar front screen",
    "exhaust assembly", "chassis assembly", "bodyside assembly rh", "lamp assembly-head left",
    "exhaust front pipe", "front panel weatherstrip", "tailgate finisher", "tailgate lock",
    "boot lid lock", "boot lid aperture weatherstrip", "boot extractor vent", "towing cover",
    "pan assy., oil", "pas container & assembly", "cooling fan resistor", "mudflap front rh",
    "indicator lamp front rh", "stabiliser bar front link rh", "front pillar outer rh",
    "brake abs sensor front rh", "wiper front motor", "front pillar inner rh",
    "chassis member front extension rh", "side step", "stabiliser bar front link lh",
    "front pillar inner lh", "trailing arm rear rh", "mudflap rear rh", "chassis member rear rh",
    "wiper rear motor", "door visor", "trailing arm rear lh", "centre pillar outer rh",
    "runningboard panel outer rh", "centre pillar outer lh", "runningboard panel outer lh",
    "lh bootlid lamp", "rr silencer heat insulation", "inner towing cover", "lower trim",
    "rh tail lamp", "tail panel outer", "face rr bumper", "exhaust silencer rear",
    "face assy. rr bumper lower", "garnish rr. bumper lower", "grille front moulding",
)


def wheel_rules(like: DataFrame) -> DataFrame:
    """The standing relabelling rules as a rule table."""
    rows = [(text, "wheel", "wheel") for text in WHEEL_DESCRIPTIONS]
    return like.sparkSession.createDataFrame(rows, "description string, lvl_2_desc string, lvl_3_desc string")


def part_labels(
    lines: DataFrame,
    cases: DataFrame,
    taxonomy: DataFrame,
    rules: DataFrame | None = None,
    percent_threshold: float = 3,
    min_similarity: float = 60,
    condition_terms: Sequence[str] = CONDITION_TERMS,
    description_terms: Sequence[str] = DESCRIPTION_TERMS,
    component_terms: Sequence[str] = COMPONENT_TERMS,
) -> DataFrame:
    """Lines of the given cases with `lvl_1_desc`, `lvl_2_desc` and `lvl_3_desc`.

    Descriptions and damage conditions are lower-cased first, as the term lists are. The description is matched to a frequent one, looked up in the taxonomy (lines without an entry
    are dropped), relabelled by exact rules, and filtered by the term lists.
    """
    lines = lower_texts(lines)
    scoped = lines.join(ids_of(cases, "case_id"), "case_id", "left_semi")
    matched = fuzzy_group(scoped, "description", percent_threshold, min_similarity, "lvl_1_desc")
    levels = taxonomy.select("lvl_1_desc", *[F.trim(c).alias(c) for c in ("lvl_2_desc", "lvl_3_desc")])
    labelled = matched.join(small_side(levels), "lvl_1_desc")
    damaged = remove_blacklisted(labelled, "damage_cond", condition_terms)
    chosen = wheel_rules(lines) if rules is None else rules
    remapped = apply_remap(damaged, chosen, "description", ["lvl_2_desc", "lvl_3_desc"])
    named = remove_blacklisted(remapped, "description", description_terms)
    return remove_blacklisted(named, "description", component_terms)


def part_vocabulary_map(taxonomy: DataFrame, views: Sequence[str]) -> DataFrame:
    """(view, part) rows of a taxonomy that has one 0/1 column per view."""
    long = taxonomy.unpivot("lvl_3_desc", list(views), "view", "shown").filter("shown = 1")
    return long.select("view", F.trim("lvl_3_desc").alias("part")).distinct()
