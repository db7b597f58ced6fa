"""Prompts as columns.  Texts are short; what a model must know comes from the row."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.order import running_totals
from pagewright.functions.text import bounded_text, capitalized


@dataclass(frozen=True)
class Task:
    """A generation operator: its instruction, the columns it shows, the fields it returns and
    those of the columns that are shortened to what a prompt may hold."""

    name: str
    role: str
    instruction: str
    shown: tuple[str, ...]
    fields: tuple[tuple[str, str], ...]
    bounded: tuple[str, ...] = ()

    @property
    def schema(self) -> str:
        """Field names and kinds, for the client."""
        return json.dumps(dict(self.fields))

    @property
    def ddl(self) -> str:
        """The reply's fields as a schema for from_json."""
        kinds = {"text": "string", "flag": "boolean", "grade": "int", "list": "array<string>"}
        return ", ".join(f"{n} {kinds[k]}" for n, k in self.fields)


_QUERY_FIELDS = (("queries", "list"),)
TASKS = {
    t.name: t
    for t in (
        Task("describe_document", "text", "Describe in a few sentences what this document is about.", ("content",), (("description", "text"),), ("content",)),
        Task("describe_corpus", "text", "Describe the collection that these documents belong to.", ("descriptions",), (("description", "text"),)),
        Task("check_contents_page", "text", "Say whether this page is a table of contents.", ("page",), (("explanation", "text"), ("has_table_of_contents", "flag"))),
        Task("summarise_section", "text", "Summarise the section in Markdown, in fewer than 500 words.", ("document_description", "section"), (("summary", "text"),)),
        Task("describe_visual_document", "vision", "Describe the document that these page images begin.", ("filename",), (("description", "text"),)),
        Task("summarise_pages", "vision", "Summarise what these page images show, figures and tables included.", ("document_description",), (("summary", "text"),)),
        Task("combine_summaries", "text", "Write one text that combines these summaries, if they have a subject in common.", ("summaries",), (("summary", "text"),)),
        Task("judge_summary", "judge", "Grade the summary from 1 to 5 for each criterion, for the reader described.", ("persona", "summary"), tuple((c, "grade") for c in ("information_richness", "persona_relevance", "query_generation_potential", "conceptual_clarity"))),
        Task("generate_queries", "query", "Write one query for each request, as the reader described would.", ("persona", "summary", "requests"), _QUERY_FIELDS),
        Task("judge_query", "judge", "Grade the query against the criterion from 1 to 5.", ("persona", "summary", "query", "criterion"), (("reasoning", "text"), ("grade", "grade"))),
        Task("detect_answer", "judge", "Say whether the query holds its own answer.", ("query",), (("has_answer", "flag"),)),
        Task("rephrase_query", "query", "Say the query in other words; keep its type, format and meaning.", ("query", "summary", "query_type", "query_format"), (("rephrased_query", "text"),)),
        Task("query_one_section", "vision", "Write queries that these pages answer, one for each request.", ("requests",), _QUERY_FIELDS),
        Task("query_many_sections", "vision", "Write queries that need pages of more than one section.", ("sections", "requests"), _QUERY_FIELDS),
        Task("smoke_test", "text", "Reply with one short summary of this sentence.", (), (("summary", "text"),)),
    )
}

#: The five criteria of a query's judgment: the reply's field for each.
QUERY_CRITERIA = ("relevancy", "self_sufficiency", "persona_adaptation", "query_type_following", "query_format_following")


def rendered(rows: DataFrame, task: Task, language: str = "english") -> DataFrame:
    """rows with prompt and schema; null values are shown as empty.

    Only the task's bounded columns are shortened; such a task's rows say so in ``shortened``.
    """
    cut = F.lit(False)
    parts: list[Column] = [F.lit(f"{task.instruction}\nReply in {language} with a JSON object.")]
    for name in task.shown:
        value = F.col(name)
        if rows.schema[name].dataType.typeName() == "array":
            value = F.array_join(F.transform(value, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
        value = F.coalesce(value.cast("string"), F.lit(""))
        if name in task.bounded:
            whole, value = value, bounded_text(value)
            cut = cut | (F.length(value) < F.length(whole))
        parts.append(F.concat(F.lit(f"\n{name.replace('_', ' ')}:\n"), value))
    own = rows.withColumn("shortened", cut) if task.bounded else rows
    return own.withColumn("prompt", F.concat(*parts)).withColumn("schema", F.lit(task.schema))


def numbered_requests(modules: DataFrame, key: str = "summary_id") -> DataFrame:
    """key and the ordered request lines of the modules drawn for each summary."""
    line = F.concat(capitalized(F.regexp_replace("type", "-", " ")), F.lit(" query in the form of a "), F.col("format"), F.lit(", "), F.col("answerability"), F.lit("ly answered by the "), F.col("pool"), F.lit(" content"))
    ordered = F.array_sort(F.collect_list(F.struct("pool", "draw", line.alias("line"))))
    return modules.groupBy(key).agg(ordered.alias("_r")).select(key, F.col("_r.line").alias("requests"))


def descriptions_in_one(descriptions: DataFrame, order: str = "filename", text: str = "description") -> DataFrame:
    """One row with the array of all descriptions in order."""
    own = descriptions.where(F.col(text).isNotNull())
    return own.agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("_d")).select(F.col(f"_d.{text}").alias("descriptions"))


def description_blocks(descriptions: DataFrame, most_chars: int, order: str = "filename", text: str = "description") -> DataFrame:
    """block, descriptions: all descriptions in order, in blocks of about most_chars characters
    (at most one description more); their numbers rise but may leave some out."""
    own = descriptions.where(F.col(text).isNotNull()).select(order, text, (F.length(text) + 8).cast("bigint").alias("_n"))
    placed = running_totals(own, order, "_n", "_before").withColumn("block", F.floor(F.col("_before") / most_chars))
    return placed.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("_d")).select("block", F.col(f"_d.{text}").alias("descriptions"))


def criteria_rows(queries: DataFrame) -> DataFrame:
    """Each query five times, with ``criterion``."""
    return queries.withColumn("criterion", F.explode(F.array(*[F.lit(c) for c in QUERY_CRITERIA])))
