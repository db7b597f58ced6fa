"""Typed queries: how many of each kind, which modules, and the rows of generated queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions.text import hash_integer

# Kinds of questions with their caps, the types of queries and their formats,
# the formats a type doesn't have, and the modules of each pool with their weights.
KINDS = (("adversarial", 1), ("textual", 3), ("tabular", 1), ("visual", 1))
TYPES = ("open-ended", "extractive", "boolean", "numerical", "compare-contrast", "enumerative", "multi-hop")
FORMATS = ("question", "instruction", "keyword")
FORBIDDEN = {"multi-hop": ("keyword",), "enumerative": ("keyword",), "boolean": ("keyword", "instruction")}
TABLE_MODULES = (
    ("extractive", "full", 1.0), ("boolean", "full", 0.5), ("boolean", "partial", 0.5), ("numerical", "full", 1.0),
    ("numerical", "partial", 1.0), ("compare-contrast", "full", 1.0), ("compare-contrast", "partial", 1.0), ("enumerative", "partial", 1.0),
)
TEXT_MODULES = (
    ("extractive", "full", 2.0), ("open-ended", "full", 3.0), ("open-ended", "partial", 3.0), ("boolean", "full", 1.0),
    ("boolean", "partial", 1.0), ("compare-contrast", "full", 1.0), ("compare-contrast", "partial", 1.0), ("enumerative", "partial", 1.0),
)
POOLS = {"tabular": TABLE_MODULES, "visual": TEXT_MODULES, "textual": TEXT_MODULES}


def modules(spark: SparkSession) -> DataFrame:
    """pool, ord, type, answerability, weight, low, high: high is the running sum of weights
    in halves, so that bounds are whole numbers."""
    rows = []
    for pool, own in POOLS.items():
        low = 0
        for n, (kind, answer, weight) in enumerate(own):
            rows.append((pool, n, kind, answer, weight, low, low + int(2 * weight)))
            low += int(2 * weight)
    return spark.createDataFrame(rows, "pool string, ord int, type string, answerability string, weight double, low int, high int")


def allocate(key: Column, wanted: int = 3, draws: int = 16, seed: str = "allocation") -> Column:
    """A map-like struct with the number of questions of each kind for a summary.

    Kinds are drawn uniformly from those left; a kind at its cap is taken out when drawn.
    Every draw is a hash of seed, key and the draw's number.  draws bounds the loop; with the
    caps as they are, at most wanted draws are good and one more for each kind is wasted.
    """
    names = [k for k, _ in KINDS]
    state = F.struct(*[F.lit(0).alias(k) for k in names], F.array(*[F.lit(k) for k in names]).alias("open"), F.lit(0).alias("total"))
    # expressions within a lambda aren't shared: what is used more than once is bound by a step of its own
    points = F.transform(F.sequence(F.lit(1), F.lit(draws)), lambda draw: hash_integer(seed, key, draw))

    def step(acc: Column, point: Column) -> Column:
        at = (point % F.greatest(F.size(acc["open"]), F.lit(1)) + 1).cast("int")
        drawn = F.array(F.struct(F.try_element_at(acc["open"], at).alias("pick"), ((acc["total"] < wanted) & (F.size(acc["open"]) > 0)).alias("live")))

        def judged(d: Column) -> Column:
            full = F.lit(False)
            for name, cap in KINDS:
                full = full | ((d["pick"] == name) & (acc[name] >= cap))
            return F.struct(d["pick"].alias("pick"), (d["live"] & ~full).alias("take"), (d["live"] & full).alias("drop"))

        def after(d: Column) -> Column:
            return F.struct(
                *[(acc[k] + F.when(d["take"] & (d["pick"] == k), 1).otherwise(0)).alias(k) for k in names],
                F.when(d["drop"], F.array_remove(acc["open"], d["pick"])).otherwise(acc["open"]).alias("open"),
                (acc["total"] + F.when(d["take"], 1).otherwise(0)).alias("total"),
            )

        return F.get(F.transform(F.transform(drawn, judged), after), F.lit(0))

    return F.aggregate(points, state, step)


def question_allocation(summaries: DataFrame, key: str = "summary_id", wanted: int = 3) -> DataFrame:
    """key and the number of questions of each kind."""
    # the array keeps the fold in one place: its fields aren't folds of their own
    own = summaries.select(key, F.explode(F.array(allocate(F.col(key), wanted))).alias("_a"))
    return own.select(key, *[F.col(f"_a.{k}").alias(k) for k, _ in KINDS])


def one_of_each(keys: DataFrame, key: str = "summary_id") -> DataFrame:
    """key with one question of each pool, for pages that are shown as images."""
    return keys.select(key, *[F.lit(1).alias(p) for p in POOLS])


def module_sample(allocation: DataFrame, key: str = "summary_id", seed: str = "module") -> DataFrame:
    """key, pool, draw, type, format, answerability: modules drawn with replacement.

    The weighted choice compares a hash with running sums of weights; the format is drawn
    from those that the type has.  Adversarial questions have a slot but no module.
    """
    spark = allocation.sparkSession
    slots = allocation.select(key, F.explode(F.array(*[F.struct(F.lit(p).alias("pool"), F.col(p).alias("n")) for p in POOLS])).alias("s")).where("s.n > 0")
    draws = slots.select(key, "s.pool", F.explode(F.sequence(F.lit(1), F.col("s.n"))).alias("draw"))
    weight = F.lit(None)
    for pool, own in POOLS.items():
        weight = F.when(F.col("pool") == pool, int(sum(2 * w for *_, w in own))).otherwise(weight)
    point = draws.withColumn("point", (hash_integer(seed, F.col(key), F.col("pool"), F.col("draw")) % weight).cast("int"))
    table = F.broadcast(modules(spark).withColumnRenamed("pool", "_pool"))
    chosen = point.join(table, (F.col("pool") == F.col("_pool")) & (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    free = F.array(*[F.lit(f) for f in FORMATS])
    for kind, gone in FORBIDDEN.items():
        free = F.when(F.col("type") == kind, F.array(*[F.lit(f) for f in FORMATS if f not in gone])).otherwise(free)
    pick = F.element_at(free, (hash_integer("format", F.col(key), F.col("pool"), F.col("draw")) % F.size(free) + 1).cast("int"))
    return chosen.select(key, "pool", "draw", "type", pick.alias("format"), "answerability")


def explode_queries(generated: DataFrame, queries: str = "queries") -> DataFrame:
    """A row per generated query with the summary's other columns; failed and empty results
    leave no row."""
    others = [c for c in generated.columns if c != queries]
    return generated.select(*others, F.posexplode(queries).alias("query_no", "_q")).select(*others, "query_no", "_q.*")


def qrels(queries: DataFrame, key: str = "qtj_id") -> DataFrame:
    """key, filename, page: pages that are relevant to a query, from arrays paired by position."""
    pairs = F.arrays_zip(F.col("filenames").alias("f"), F.col("page_numbers").alias("p"))
    own = queries.select(key, F.explode(pairs).alias("z")).select(key, F.col("z.f").alias("filename"), F.explode("z.p").alias("page"))
    return own.where("filename is not null and page is not null").distinct()
