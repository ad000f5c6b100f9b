"""Request and answer tables around an external model service."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload import schemas
from homeload.functions import text
from homeload.operators import nested

# Headings of the optional prompt sections.
GUIDANCE_HEADING = "IMPORTANT GUIDANCE FOR REGENERATION:"
LESSONS_HEADING = "LESSONS LEARNED FROM PREVIOUS ATTEMPTS (MUST FOLLOW):"


def requests(
    tasks: DataFrame,
    template: str,
    variables: Mapping[str, Column],
    guidance: Column | None = None,
    lessons: Column | None = None,
) -> DataFrame:
    """Add ``prompt`` and the sorted list of placeholders nothing filled."""
    body = F.lit(template)
    prompt = text.render_template(body, variables)
    if guidance is not None:
        prompt = text.with_suffix(prompt, GUIDANCE_HEADING, guidance)
    if lessons is not None:
        prompt = text.with_suffix(prompt, LESSONS_HEADING, lessons)
    return tasks.withColumn("prompt", prompt).withColumn(
        "unresolved", text.unresolved_names(body, list(variables))
    )


def lessons_of(rules: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rule lines of each ``by`` group, such as a run and its stage, as one sorted text.

    A text goes into every prompt of its group, so it holds the rules of that
    group alone; a task picks it up by a join on ``by``. Lines are distinct
    before they meet, so a text grows with the rules and not with the calls.
    Without ``by`` all rules are one text, for the rule base of one run.
    """
    lines = rules.select(*by, F.concat(F.lit("- [RULE: "), "stage", F.lit("] "), "rule").alias("line")).distinct()
    return lines.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set("line")), "\n").alias("lessons"))


def audit_requests(tasks: DataFrame, template: str, variables: Mapping[str, Column], context: Column, criteria: Column) -> DataFrame:
    """Audit prompts; tasks without criteria get no prompt and severity NONE."""
    filled = {**variables, "context": text.context_block(context), "criteria": criteria}
    ask = text.has_criteria(criteria)
    return tasks.withColumn("prompt", F.when(ask, text.render_template(F.lit(template), filled))).withColumn(
        "severity", F.when(~ask, F.lit("NONE"))
    )


def parse_answers(
    answers: DataFrame, column: str, schema: str, custom_parser: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add ``json`` and ``parsed``; ``parsed`` is null where the answer is no valid JSON."""
    body, parse = F.col("json"), custom_parser or (lambda c: F.from_json(c, schema, schemas.ANY_LENGTH))
    extracted = answers.withColumn("json", text.extract_json(F.col(column)))
    return extracted.withColumn("parsed", F.when(text.is_json(body), parse(body)))


def audit_reports(answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Audit structs of answers with ``auditor`` and ``answer`` columns."""
    return answers.select(*keys, "auditor", nested.parse_audit(F.col("answer"), F.col("auditor")).alias("report"))
