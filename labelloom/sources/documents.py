"""Nested JSON case documents and JSON maps."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Field names of the raw documents.
CASE_FIELDS = (
    "CaseID: bigint, Vehicle_Class: int, Vehicle_Type: string, Gross_Offer_Insurer: double, "
    "Circumstances_of_Accident: string, Claim_Type: string, Model: string, Assembly_Type: string, "
    "Vehicle_Still_Driveable: string, NCB_Stat: string, Sum_Insured: double, Repairer: string, "
    "Repairer_Apprv_Count: string, Collision_With: string, Handling_Insurer: string"
)
PART_FIELDS = "Description: string, fVAL: double, DamageCond: string, CoType: string"
FILE_FIELDS = "iDOCID: bigint, FinalDate: string, StdDocDesc: string"


class CaseTables(NamedTuple):
    """The three tables inside one document."""

    case: DataFrame
    part: DataFrame
    file: DataFrame


def document_schema(case_fields: str = CASE_FIELDS, part_fields: str = PART_FIELDS) -> str:
    """Schema of a case document with the given main and part-line fields."""
    details = f"struct<parts: array<struct<{part_fields}>>>"
    return f"struct<status: string, data: struct<data: struct<main: struct<{case_fields}>, est_details: {details}>>>"


def judge_documents(
    raw: DataFrame, case_fields: str = CASE_FIELDS, part_fields: str = PART_FIELDS, file_fields: str = FILE_FIELDS
) -> DataFrame:
    """`main`, `parts`, `files`, the raw `doc`, its `status`, and `outcome`: `ok`, `rejected` by status, or `unreadable`.

    Every document comes back, so that one parse feeds the tables and the quarantine.
    """
    parsed = raw.select(
        "doc", F.from_json("doc", document_schema(case_fields, part_fields)).alias("d"),
        F.from_json("files", f"array<struct<{file_fields}>>").alias("files"),
    )
    status, data = F.col("d.status"), F.col("d.data.data")
    outcome = F.when(status == "OK", "ok").when(status.isNotNull(), "rejected").otherwise("unreadable")
    return parsed.select(
        data["main"].alias("main"), data["est_details"]["parts"].alias("parts"), "files", "doc",
        status.alias("status"), outcome.alias("outcome"),
    )


def quarantine(judged: DataFrame) -> DataFrame:
    """(CaseID, status, outcome, doc) of judged documents that are not `ok`; the id is null where none can be read."""
    return judged.filter("outcome <> 'ok'").select(F.col("main.CaseID").alias("CaseID"), "status", "outcome", "doc")


def parse_documents(
    raw: DataFrame, case_fields: str = CASE_FIELDS, part_fields: str = PART_FIELDS, file_fields: str = FILE_FIELDS
) -> DataFrame:
    """Nested columns `main`, `parts`, `files` of the documents whose status is OK.

    `raw` has `doc` (case JSON) and `files` (JSON array of file objects, may be null). Documents
    that do not parse have no status and are skipped too.
    """
    parsed = raw.select(
        F.from_json("doc", document_schema(case_fields, part_fields)).alias("d"),
        F.from_json("files", f"array<struct<{file_fields}>>").alias("f"),
    ).filter(F.col("d.status") == "OK")
    data = F.col("d.data.data")
    return parsed.select(
        data["main"].alias("main"), data["est_details"]["parts"].alias("parts"), F.col("f").alias("files")
    )


def flatten_parsed(parsed: DataFrame) -> CaseTables:
    """Case, part-line and file tables of parsed documents; children carry the case id."""
    case_id = F.col("main.CaseID").alias("CaseID")
    return CaseTables(
        case=parsed.select("main.*"),
        part=parsed.select(case_id, F.inline("parts")),
        file=parsed.select(case_id, F.inline("files")),
    )


def flatten_cases(
    raw: DataFrame, case_fields: str = CASE_FIELDS, part_fields: str = PART_FIELDS, file_fields: str = FILE_FIELDS,
    keep: str | None = None,
) -> CaseTables:
    """Both steps. Where the tables are read more than once, `keep` names a new folder that holds the parsed rows, so that
    each document is parsed once."""
    parsed = parse_documents(raw, case_fields, part_fields, file_fields)
    if keep is not None:
        parsed.write.parquet(keep)
        parsed = raw.sparkSession.read.schema(parsed.schema).parquet(keep)
    return flatten_parsed(parsed)


def document_report(raw: DataFrame) -> DataFrame:
    """(outcome, documents): how many documents are `ok`, `rejected` by their status or `unreadable`."""
    status = F.from_json("doc", document_schema())["status"]
    outcome = F.when(status == "OK", "ok").when(status.isNotNull(), "rejected").otherwise("unreadable")
    return raw.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("documents"))


def scope_names(tables: CaseTables) -> CaseTables:
    """The three tables with the names and types that scoping takes; texts of part lines in lower case."""
    renamed = {
        "CaseID": "case_id", "Gross_Offer_Insurer": "gross_offer", "Circumstances_of_Accident": "circumstances",
    }
    case = tables.case.select(*[F.col(c).alias(renamed.get(c, c.lower())) for c in tables.case.columns])
    part = tables.part.select(
        F.col("CaseID").alias("case_id"), F.lower("Description").alias("description"), F.col("fVAL").alias("fval"),
        F.lower("DamageCond").alias("damage_cond"), F.col("CoType").alias("co_type"))
    file = tables.file.select(
        F.col("CaseID").alias("case_id"), F.col("iDOCID").alias("doc_id"),
        F.try_to_timestamp("FinalDate").alias("final_date"), F.col("StdDocDesc").alias("view"))
    return CaseTables(case, part, file)


def explode_view_parts(df: DataFrame, column: str) -> DataFrame:
    """JSON map of view -> parts to distinct (view, part) rows."""
    parsed = df.select(F.explode(F.from_json(column, "map<string, array<string>>")).alias("view", "parts"))
    return parsed.select("view", F.explode("parts").alias("part")).distinct()


def parse_list(column: str, element: str = "double"):
    """List literal kept as text in a CSV column, to an array."""
    return F.from_json(F.replace(F.col(column), F.lit("'"), F.lit('"')), f"array<{element}>")
