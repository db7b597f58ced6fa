"""Quality gates of generated queries and the final choice between a query and its rephrasing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.text import hash_integer
from pagewright.operators.querygen import FORBIDDEN

SCORES = ("relevancy", "self_sufficiency", "persona_adaptation")
FOLLOWING = ("query_type_following", "query_format_following")


def forbidden_pair(kind: str = "supposed_query_type", form: str = "supposed_query_format") -> Column:
    """Whether a type has no queries of a format."""
    result = F.lit(False)
    for name, gone in FORBIDDEN.items():
        result = result | ((F.col(kind) == name) & F.col(form).isin(*gone))
    return F.coalesce(result, F.lit(False))


def query_gate(judged: DataFrame, least: int = 4) -> DataFrame:
    """judged with ``status``: 'error' where the judgment failed, 'keep' or 'discard'.

    Kept queries reach least in three scores, follow their type and format, and have a pair
    of type and format that exists; null scores and flags don't.  ``judged_ok`` false or null
    marks a failed judgment.
    """
    good = ~forbidden_pair()
    for name in SCORES:
        good = good & (F.coalesce(F.col(name), F.lit(0)) >= least)
    for name in FOLLOWING:
        good = good & F.coalesce(F.col(name), F.lit(False))
    return judged.withColumn("status", F.when(~F.coalesce(F.col("judged_ok"), F.lit(False)), "error").when(good, "keep").otherwise("discard"))


def gate_rates(gated: DataFrame) -> DataFrame:
    """One row: queries, errors, kept, discarded, and the share kept of those judged."""
    own = gated.agg(F.count(F.lit(1)).alias("queries"), *[F.count_if(F.col("status") == s).alias(n) for s, n in (("error", "errors"), ("keep", "kept"), ("discard", "discarded"))])
    return own.withColumn("kept_share", F.try_divide(F.col("kept"), F.col("kept") + F.col("discarded")))


def without_answer(queries: DataFrame, flag: str = "has_answer") -> DataFrame:
    """Queries that don't hold their own answer; a null flag (a failed check) drops the query."""
    return queries.where(~F.coalesce(F.col(flag), F.lit(True)))


def final_queries(queries: DataFrame, key: str = "qtj_id", seed: str = "42") -> DataFrame:
    """Each query or its rephrasing, chosen by a hash of its key, with what it was before.

    Without a rephrasing the query stays.
    """
    pick = (hash_integer(seed, F.col(key)) % 2 == 1) & F.col("rephrased_query").isNotNull()
    own = queries.withColumn("original_query", F.when(pick, F.col("query"))).withColumn("query", F.when(pick, F.col("rephrased_query")).otherwise(F.col("query")))
    own = own.withColumn("generation_process", F.when(pick, "rephrased").otherwise("original")).drop("rephrased_query")
    return own.withColumnRenamed("summary", "origin_summary") if "summary" in own.columns else own
