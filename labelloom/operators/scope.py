"""Projection, filter, rule and scoping operators over case, part-line and photo tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions import differs, not_in, not_rlike_any, rlike_any
from labelloom.operators.aggregates import complete_views
from labelloom.operators.joins import ids_of
from labelloom.operators.ranking import dedup, first_per
from labelloom.session import save_point
from labelloom.sources.tables import write_table

# Damage conditions that do not count as damage.
UNDAMAGED_CONDITIONS = (
    "no visible damage", "to check", "useable", "not necessary", "not damaged", "slightly bent",
    "slightly cut", "slightly scratched", "slightly dented", "visually intact",
)

# Accident circumstances outside the scope.
EXCLUDED_CIRCUMSTANCES = (
    "Breakage of Windscreen", "Stolen Whilst Parked", "Fire, explosion or lightning", "Malicious damage",
    "Flood", "Fell into a Ravine", "Stolen due to Violence", "Self Ignition- Unknown Cause",
    "Boarding or Alighting", "Damage due to Flood and Typhoon", "Theft of parts and/or accessories",
    "Stolen and recovered",
)


def select_by(
    df: DataFrame, prefix: str | None = None, regex: str | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Columns with a name prefix or matching a regex, minus the excluded ones."""
    chosen = [
        c for c in df.columns
        if (prefix is None or c.startswith(prefix))
        and (regex is None or re.search(regex, c))
        and c not in exclude
    ]
    return df.select(*chosen)


def filter_funnel(df: DataFrame, removed_by: Mapping[str, Column]) -> DataFrame:
    """Rows each rule removes, every rule counted on the unfiltered table, in one pass.

    `removed_by` maps a rule name to the predicate of the rows it removes. The report ends with
    the rows no rule removes (`used`) and all others (`removed`).
    """
    hits = {name: F.coalesce(rule, F.lit(False)) for name, rule in removed_by.items()}
    any_hit = F.lit(False)
    for hit in hits.values():
        any_hit = any_hit | hit
    tallies = {**hits, "used": ~any_hit, "removed": any_hit}
    one_row = df.agg(*[F.sum(hit.cast("long")).alias(name) for name, hit in tallies.items()])
    return one_row.unpivot([], list(tallies), "rule", "rows").select("rule", F.coalesce("rows", F.lit(0)).alias("rows"))


def apply_remap(df: DataFrame, rules: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite `columns` where the text equals a rule's text.

    `rules` holds hand-written rows: `on`, plus one replacement column per name. It carries no
    hint; the optimiser broadcasts it by its known size.
    """
    renamed = rules.select(F.col(on), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(renamed, on, "left")
    return joined.select(*[
        F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns
    ])


def remove_blacklisted(df: DataFrame, column: str, terms: Sequence[str], literal: bool = False) -> DataFrame:
    """Rows whose text holds none of the terms; missing text is not blacklisted."""
    return df.filter(not_rlike_any(F.col(column), terms, literal))


@dataclass(frozen=True)
class ScopeConfig:
    """Bounds and lists of the scoping step."""

    min_cost: float = 100.0
    vehicle_class: int = 2
    claim_types: Sequence[str] = ("OD", "TP")
    excluded_circumstances: Sequence[str] = EXCLUDED_CIRCUMSTANCES
    undamaged: Sequence[str] = UNDAMAGED_CONDITIONS
    required_views: Sequence[str] = field(
        default=("Front View Left", "Front View Right", "Rear View Left", "Rear View Right")
    )


def scope_parts(parts: DataFrame, cfg: ScopeConfig) -> DataFrame:
    """Costed, damaged, described part lines; unknown damage and description are kept.

    Damage and description are lower-cased first, as the lists are, and come back so.
    """
    return lower_texts(parts).filter(
        (F.col("fval") > cfg.min_cost)
        & not_in(F.col("damage_cond"), cfg.undamaged)
        & differs(F.col("description"), "-")
    )


def lower_texts(parts: DataFrame) -> DataFrame:
    """Part lines with damage condition and description in lower case."""
    return parts.withColumns({c: F.lower(c) for c in ("damage_cond", "description")})


def part_funnel(parts: DataFrame, cfg: ScopeConfig, legacy_lt: bool = False) -> DataFrame:
    """Funnel of `scope_parts`. `legacy_lt` counts only costs below the bound, not those equal to it."""
    cost = F.col("fval")
    return filter_funnel(parts, {
        "low_cost": cost < cfg.min_cost if legacy_lt else cost <= cfg.min_cost,
        "no_cost": cost.isNull(),
        "condition": F.lower("damage_cond").isin(list(cfg.undamaged)),
        "dash": F.col("description") == "-",
    })


def case_rules(cfg: ScopeConfig) -> dict[str, Column]:
    """Removal predicates on the case table alone."""
    return {
        "claim_type": ~rlike_any(F.col("claim_type"), cfg.claim_types),
        "vehicle_class": differs(F.col("vehicle_class"), cfg.vehicle_class),
        "circumstances": F.coalesce(F.col("circumstances").isin(list(cfg.excluded_circumstances)), F.lit(False)),
        "gross_offer": F.coalesce(F.col("gross_offer") <= 0, F.lit(True)),
    }


def scope_cases(cases: DataFrame, parts: DataFrame, files: DataFrame, cfg: ScopeConfig) -> DataFrame:
    """Cases inside every bound that have a complete set of views and a scoped part line."""
    kept = cases
    for removed in case_rules(cfg).values():
        kept = kept.filter(~removed)
    complete = complete_views(files, cfg.required_views)
    with_parts = ids_of(scope_parts(parts, cfg), "case_id")
    scoped = kept.join(complete, "case_id", "left_semi").join(with_parts, "case_id", "left_semi")
    return dedup(scoped, ["case_id"], [F.col(c) for c in sorted(set(cases.columns) - {"case_id"})])


def scoped_tables(
    cases: DataFrame, parts: DataFrame, files: DataFrame, cfg: ScopeConfig
) -> dict[str, DataFrame]:
    """Scoped cases, their scoped part lines, and their earliest photo of every required view.

    The scoped cases are saved once, since both other tables are cut by them.
    """
    kept = save_point(scope_cases(cases, parts, files, cfg))
    ids = kept.select("case_id")
    photos = files.filter(F.col("view").isin(list(cfg.required_views))).join(ids, "case_id", "left_semi")
    return {
        "case": kept,
        "part": scope_parts(parts, cfg).join(ids, "case_id", "left_semi"),
        "file": first_per(photos, ["case_id", "view"], [F.col("final_date"), F.col("doc_id")]),
    }


# How each scoped table is partitioned on disk.
SCOPED_BY = {"case": "vehicle_type", "part": "co_type", "file": "view"}


def write_scoped(tables: dict[str, DataFrame], folder: str) -> None:
    """The three scoped tables below a folder, partitioned."""
    for name, table in tables.items():
        write_table(table, f"{folder}/{name}", [SCOPED_BY[name]])


def scope_funnel(cases: DataFrame, parts: DataFrame, files: DataFrame, cfg: ScopeConfig) -> DataFrame:
    """Case funnel: the column rules plus missing views and missing part lines."""
    complete = complete_views(files, cfg.required_views).withColumn("_views", F.lit(True))
    with_parts = ids_of(scope_parts(parts, cfg), "case_id").withColumn("_parts", F.lit(True))
    flagged = cases.join(complete, "case_id", "left").join(with_parts, "case_id", "left")
    return filter_funnel(flagged, {
        **case_rules(cfg),
        "incomplete_views": F.col("_views").isNull(),
        "no_part_lines": F.col("_parts").isNull(),
    })
