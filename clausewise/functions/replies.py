"""Reading the replies of a language model: lenient JSON, importances, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISSUES = "issues array<struct<issue:string,importance:string>>"


def json_body(raw: Column) -> Column:
    """What follows the first code fence (its tag dropped), from the first brace to the last."""
    fenced = F.when(F.instr(raw, "```") > 0, F.regexp_replace(F.split(raw, "```", 3)[1], r"^\s*json", "")).otherwise(raw)
    body = F.regexp_extract(fenced, r"(?s)\{.*\}", 0)
    return F.when(body == "", None).otherwise(body)


def importance(x: Column) -> Column:
    """Rounded half to even, held within 0 and 10; anything else is 0."""
    number = x.try_cast("double")
    number = F.when(F.isnan(number), None).otherwise(number)
    number = F.coalesce(number, F.lit(0.0))
    return F.greatest(F.lit(0), F.least(F.lit(10), F.bround(F.greatest(F.lit(-1.0), F.least(F.lit(11.0), number)), 0).cast("int")))


def parse_issues(raw: Column) -> Column:
    """array<struct<issue, importance>>; blank issues go, no JSON gives none."""
    found = F.from_json(json_body(raw), ISSUES)["issues"]
    clean = F.transform(found, lambda x: F.struct(F.trim(F.coalesce(x["issue"], F.lit(""))).alias("issue"), importance(x["importance"]).alias("importance")))
    return F.coalesce(F.filter(clean, lambda x: x["issue"] != ""), F.array().cast("array<struct<issue:string,importance:int>>"))


def parse_answer(raw: Column) -> Column:
    """struct<summary, actions>; a reply without JSON is its own summary."""
    got = F.from_json(json_body(raw), "summary string, actions array<string>")
    return F.struct(
        F.when(got["summary"].isNull() & got["actions"].isNull(), F.trim(raw)).otherwise(F.coalesce(got["summary"], F.lit(""))).alias("summary"),
        F.coalesce(got["actions"], F.array().cast("array<string>")).alias("actions"))


def parse_judgements(raw: Column, strict: bool = False) -> Column:
    """array<struct<index, reason, action_items>> of a fenced or plain JSON list; other text is null,
    or an error with ``strict``."""
    plain = F.regexp_replace(F.trim(raw), r"^```(?:json)?\s*|\s*```$", "")
    found = F.from_json(plain, "array<struct<index:int,reason:string,action_items:array<string>>>")
    if not strict:
        return found
    return F.when(raw.isNotNull() & (found.isNull() | F.try_parse_json(plain).isNull()), F.raise_error(F.concat(F.lit("not a JSON list: "), F.substring(raw, 1, 200)))).otherwise(found)
