"""Selection of summaries: thresholds, buckets, overlap with sections, quotas and priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The four criteria of a summary's judgment.
CRITERIA = ("information_richness", "persona_relevance", "query_generation_potential", "conceptual_clarity")
VISUAL_MARK = "<!--<annotation kind="
VISUAL_REASON = "visual combined summary"

#: What a selected summary says about its bucket.
PRIORITY_REASONS = {
    "multi_document_combined": "visual judged multi-document combined summary",
    "same_document_combined": "visual judged same-document combined summary",
    "single": "visual judged single summary",
}
FALLBACK_REASON = "visual fallback selected summary"


def passes(least: int, *grades: str) -> Column:
    """Whether all grades reach least; a null grade doesn't."""
    return F.coalesce(F.least(*[F.coalesce(F.col(g), F.lit(-1)) for g in grades]) >= least, F.lit(False))


def mean_grade(*grades: str) -> Column:
    return sum((F.col(g).cast("double") for g in grades[1:]), F.col(grades[0]).cast("double")) / float(len(grades))


def count_passing(judged: DataFrame, least: int, *grades: str) -> DataFrame:
    return judged.agg(F.count_if(passes(least, *grades)).alias("passing"))


def is_combined(reason: str = "addition_reason", originals: str = "original_summaries", filenames: str = "filenames", pages: str = "page_numbers") -> Column:
    """Made of several summaries, by its reason, its originals, its files or its page lists."""
    said = F.coalesce(F.col(reason) == VISUAL_REASON, F.lit(False))
    many = (F.coalesce(F.size(filenames), F.lit(0)) > 1) | (F.coalesce(F.size(pages), F.lit(0)) > 1)
    return said | F.col(originals).isNotNull() | many


def bucket(combined: Column, filenames: str = "filenames") -> Column:
    several = F.size(F.array_distinct(F.coalesce(F.col(filenames), F.array().cast("array<string>")))) > 1
    return F.when(~combined, "single").when(several, "multi_document_combined").otherwise("same_document_combined")


def touched_visual(summaries: DataFrame, sections: DataFrame, key: str = "summary_id") -> DataFrame:
    """summaries with ``visual``: whether any section of any of its files that shares a page
    with any of its page lists holds an image annotation.

    Files and page lists are crossed, not paired.  Both sides become (file, page) rows and
    meet in a semi join on both, so that one file's many pages spread over the join's tasks.
    """
    want = summaries.select(key, F.explode("filenames").alias("filename"), F.flatten("page_numbers").alias("_pages")).select(key, "filename", F.explode("_pages").alias("page"))
    have = sections.where(F.instr("section", VISUAL_MARK) > 0).select("filename", F.explode("page_numbers").alias("page")).distinct()
    hits = want.join(have, ["filename", "page"], "left_semi").select(key).distinct().withColumn("_hit", F.lit(True))
    return summaries.join(hits, key, "left").withColumn("visual", F.coalesce("_hit", F.lit(False))).drop("_hit")


def dedupe_combined(passing: DataFrame, order: str = "ord") -> DataFrame:
    """The first of the combined summaries with the same files and page lists, in order."""
    lists = F.transform("page_numbers", lambda x: F.array_join(x, ","))
    key = F.array_join(F.transform(F.arrays_zip(F.col("filenames").alias("f"), lists.alias("p")), lambda z: F.concat(z["f"], F.lit("["), F.coalesce(z["p"], F.lit("")), F.lit("]"))), " ")
    first = F.row_number().over(W.partitionBy("_key").orderBy(order))
    return passing.withColumn("_key", key).withColumn("_rank", first).where("_rank = 1").drop("_key", "_rank")


def fused(parts: DataFrame, *keys: str, text: str = "summary", order: str = "ord") -> DataFrame:
    """keys and the texts of each group in order, joined by spaces; groups are the few parts
    of one summary."""
    ordered = F.array_sort(F.collect_list(F.struct(order, text)))
    return parts.groupBy(*keys).agg(ordered.alias("_p")).select(*keys, F.array_join(F.col(f"_p.{text}"), " ").alias(text))


def priority_fill(judged: DataFrame, wanted: int, least: int = 4, grades: tuple[str, ...] = CRITERIA, order: str = "ord") -> DataFrame:
    """The wanted best summaries with ``bucket``, ``passing`` and ``selected_reason``.

    Passing ones come by bucket (several documents, one document combined, single) and order;
    then the rejected ones by falling mean grade and order,
    those without a mean at the end.  The limit becomes a partial
    top-k in every task.
    """
    ranked = judged.withColumn("passing", passes(least, *grades)).withColumn("bucket", bucket(is_combined()))
    rank = F.when(~F.col("passing"), 3).when(F.col("bucket") == "multi_document_combined", 0).when(F.col("bucket") == "same_document_combined", 1).otherwise(2)
    reason = F.lit(FALLBACK_REASON)
    for name, text in PRIORITY_REASONS.items():
        reason = F.when(F.col("passing") & (F.col("bucket") == name), text).otherwise(reason)
    ranked = ranked.withColumn("_rank", rank).withColumn("_grade", F.when(F.col("passing"), 0.0).otherwise(F.coalesce(-mean_grade(*grades), F.lit(0.0)))).withColumn("selected_reason", reason)
    return ranked.orderBy("_rank", "_grade", order).limit(max(0, wanted)).drop("_rank", "_grade")


def first_candidates(wanted: int, *parts: DataFrame, order: str = "ord") -> DataFrame:
    """The first wanted rows of the ordered union of parts, each part in its own order."""
    result = None
    for rank, part in enumerate(parts):
        own = part.withColumn("_part", F.lit(rank))
        result = own if result is None else result.unionByName(own, allowMissingColumns=True)
    return result.orderBy("_part", order).limit(wanted).drop("_part")


#: What a summary selected from one of six buckets says, in the order of the buckets.
BUCKET_REASONS = tuple(f"summary based on {what} {which} visual information" for which in ("with", "without") for what in ("sections from multiple documents", "sections from a single document", "a section from a single document"))


def six_buckets(summaries: DataFrame, visual: str = "visual", combined: str = "combined") -> DataFrame:
    """summaries with ``bucket_no``: with visual content 0 for several documents, 1 for several
    sections of one, 2 for one section; without it three more."""
    kind = F.when(~F.col(combined), 2).when(bucket(F.col(combined)) == "multi_document_combined", 0).otherwise(1)
    return summaries.withColumn("bucket_no", (kind + F.when(F.col(visual), 0).otherwise(3)).cast("int"))


def balanced_selection(judged: DataFrame, sections: DataFrame, wanted: int, least: int = 4, grades: tuple[str, ...] = CRITERIA, key: str = "summary_id", order: str = "ord", strict: bool = False) -> DataFrame:
    """The wanted summaries, taken in turn from six buckets, with ``round`` and
    ``selected_reason``.

    judged has ``combined``.  Only summaries whose grades all reach least count, of combined
    ones with the same files and pages the first; fewer than wanted are an error.
    """
    passing = judged.where(passes(least, *grades))
    once = passing.where(~F.col("combined")).unionByName(dedupe_combined(passing.where("combined"), order))
    candidates = six_buckets(touched_visual(once, sections, key))
    chosen = quota_round_robin(candidates, wanted, order, strict)
    reasons = F.array(*[F.lit(r) for r in BUCKET_REASONS])
    return chosen.withColumn("selected_reason", F.get(reasons, F.col("bucket_no")))


def quota_plan(sizes: list[int], wanted: int, strict: bool = False) -> list[tuple[int, int, int, int]]:
    """(round, bucket, low, high) of the ranks taken from six buckets.

    Every round asks each of the first three buckets for a sixth of what was missing at its
    begin and 20 more, each of the others for 20 less, at least one.  Rounds go on until
    enough is taken; the last one isn't cut, unless strict.
    """
    if sum(sizes) < wanted:
        raise ValueError(f"{sum(sizes)} summaries for {wanted} wanted")
    taken, plan, n = [0] * len(sizes), [], 0
    while sum(taken) < wanted:
        missing = wanted - sum(taken)
        for b, size in enumerate(sizes):
            quota = max(1, missing // 6 + (20 if b < 3 else -20))
            count = min(quota, size - taken[b])
            if strict:
                count = min(count, wanted - sum(taken))
            if count > 0:
                plan.append((n, b, taken[b], taken[b] + count))
                taken[b] += count
        n += 1
    return plan


def quota_round_robin(candidates: DataFrame, wanted: int, order: str = "ord", strict: bool = False) -> DataFrame:
    """candidates (with ``bucket_no`` from 0 to 5) selected by quota_plan(), with ``round``.

    Only the six counts reach the driver.  Of each bucket no more is taken than its last
    quota's end, so each is a top-k with partial lists in every task; ranks are given to these
    rows alone.
    """
    counts = {r["bucket_no"]: r["count"] for r in candidates.groupBy("bucket_no").count().collect()}
    plan = quota_plan([counts.get(b, 0) for b in range(6)], wanted, strict)
    steps = candidates.sparkSession.createDataFrame(plan, "round int, _b int, low int, high int")
    most: dict[int, int] = {}
    for _, b, _, high in plan:
        most[b] = max(most.get(b, 0), high)
    first = candidates.where("false")
    for b, high in sorted(most.items()):
        first = first.unionByName(candidates.where(F.col("bucket_no") == b).orderBy(order).limit(high))
    ranked = first.withColumn("_rank", F.row_number().over(W.partitionBy("bucket_no").orderBy(order)) - 1)
    inside = (F.col("bucket_no") == F.col("_b")) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    return ranked.join(F.broadcast(steps), inside).drop("_b", "low", "high", "_rank")
