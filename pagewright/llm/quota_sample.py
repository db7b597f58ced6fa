"""Problem 3: a sample whose categories match target shares.

The only statistics are category moments, one distributed count per category.  Inclusion
probabilities come from exponential tilting: the dual of the calibration problem is solved by
Newton iterations on the moments, which are the totals of the types and of the formats.  No
category with enough rows is tilted below its own target; what categories that fall short leave
goes to others, first of the same type or format, so that the marginal shares stay as near to
their targets as they can.  Categories at a bound are fixed there, and the rest is tilted again.
The draw uses the pivotal method, in blocks of bounded size whose undecided rows meet again in
further rounds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.textkit import one_per_key
from pagewright.session import reliable_checkpoint


def category_key(column: Column) -> Column:
    """A category without case, outer spaces and the way its parts are joined."""
    return F.lower(F.regexp_replace(F.regexp_replace(column, r"(?U)^\s+|\s+$", ""), r"(?U)[-_\s]+", "-"))


def tilt(counts: np.ndarray, targets: np.ndarray, design: np.ndarray | None = None, base: np.ndarray | None = None, steps: int = 60) -> np.ndarray:
    """Inclusion probability of each category by exponential tilting of base.

    Minimises the dual sum(counts * base * exp(design @ x)) - targets @ x by Newton's method
    with step halving.  design has a row per category and a column per moment; without one the
    categories are the moments.  base is 1 unless given.  Targets that contradict each other are
    met as far as the steps lead; expected moments tell.
    """
    design = np.eye(len(counts)) if design is None else design
    base = np.ones(len(counts)) if base is None else base
    x = np.zeros(design.shape[1])

    def value(y: np.ndarray) -> float:
        return float((counts * base * np.exp(np.clip(design @ y, -500, 500))).sum() - targets @ y)

    for _ in range(steps):
        expected = counts * base * np.exp(np.clip(design @ x, -500, 500))
        slope = design.T @ expected - targets
        if np.abs(slope).max() <= 1e-9 * max(1.0, float(np.abs(targets).max())):
            break
        curve = design.T @ (design * expected[:, None])
        step = np.linalg.lstsq(curve, slope, rcond=None)[0]
        scale, now = 1.0, value(x)
        while value(x - scale * step) > now and scale > 1e-6:
            scale /= 2
        x = x - scale * step
    return base * np.exp(np.clip(design @ x, -500, 500))


@dataclass
class Plan:
    """What the calibration settles for each category: the chance of its rows, the rows it
    should have, and those of them that it can't have though all its rows be taken."""

    size: int
    probability: np.ndarray
    required: np.ndarray
    unmet: np.ndarray


def _indicators(*labels: list) -> np.ndarray:
    """A column for each value of each list of labels."""
    return np.concatenate([np.array([[x == v for v in sorted(set(own))] for x in own], float).reshape(len(own), -1) for own in labels], axis=1)


def calibrate(available: np.ndarray, permille: np.ndarray, floors: np.ndarray, size: int, types: list | None = None, formats: list | None = None) -> Plan:
    """Inclusion probabilities for a sample of size rows.

    A category's share is permille / 1000 of size, its floor the least number of rows.  One
    whose share is below its floor gets the floor, and one with fewer rows than it should have
    all of them.  The others get their shares and what is left: tilted so that the totals of
    types and formats are the sums of their shares, where that leaves every share whole; if
    floors leave too little, in proportion.
    """
    available, permille, floors = (np.asarray(x, float) for x in (available, permille, floors))
    count = len(available)
    shares = permille * size / 1000
    required = np.maximum(floors, np.ceil(shares - 1e-9))
    design = _indicators(types or [0] * count, formats or [0] * count) if count else np.zeros((0, 0))
    group = np.array([0] * len(set(types or [0])) + [1] * len(set(formats or [0])))
    fixed = available <= 0
    goal = np.zeros(count)
    while not fixed.all():
        open_ = ~fixed
        left = max(0.0, size - goal[fixed].sum())
        whole = shares[open_].sum()
        own = shares[open_] * (left / whole) if whole else np.zeros(open_.sum())
        want = own
        if left and whole:
            moments = design[open_]
            used = moments.any(0)
            totals = np.maximum(design.T @ shares - design[fixed].T @ goal[fixed], 1e-9)[used]
            for k in (0, 1):  # the open categories share all that is left
                totals[group[used] == k] *= left / totals[group[used] == k].sum()
            positive = own > 0
            tilted = np.zeros(len(own))
            tilted[positive] = available[open_][positive] * tilt(available[open_][positive], totals, moments[positive][:, used], own[positive] / available[open_][positive])
            if abs(tilted.sum() - left) <= 1e-6 * max(1.0, left):
                want = tilted
        full = np.zeros(count)
        full[open_] = want
        cap, low = open_ & (floors >= available), open_ & (floors < available) & (full < floors)
        if not (cap.any() or low.any()):
            cap = open_ & (full >= available)
        if not (cap.any() or low.any()) and left > whole:  # no share is cut where rows are left over
            low = open_ & (full < shares - 1e-9)
        goal[low], goal[cap] = np.minimum(available, np.maximum(floors, shares * (left > whole)))[low], available[cap]
        fixed |= cap | low
        if not (cap.any() or low.any()):
            goal[open_] = want
            break
    for _ in range(count):  # what the others had no room for goes to those fixed at a floor
        rest, room = min(size, available.sum()) - goal.sum(), available - goal
        if rest <= 1e-9:
            break
        weight = np.where(room > 1e-9, np.maximum(shares, 1e-9), 0)
        goal += np.minimum(np.maximum(room, 0), rest * weight / weight.sum())
    over, spare = goal.sum() - size, goal - np.minimum(floors, available)
    if over > 1e-9 and spare.sum() > 0:  # floors settled after shares come out of what stands above floors
        goal -= spare * min(1.0, over / spare.sum())
    probability = np.clip(np.divide(goal, available, out=np.zeros(count), where=available > 0), 0, 1)
    return Plan(size, probability, required, np.maximum(0, required - available))


def pivotal(chances: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Sequential pivotal method: chances after every pair has fought, at most one undecided.

    draws: a uniform number for each row.
    """
    result = chances.astype(float).copy()
    hold = -1
    for i in range(len(result)):
        if not 1e-9 < result[i] < 1 - 1e-9:
            result[i] = round(result[i])
            continue
        if hold < 0:
            hold = i
            continue
        a, b = result[hold], result[i]
        total = a + b
        if total < 1:
            winner, loser = (hold, i) if draws[i] * total < a else (i, hold)
            result[winner], result[loser] = total, 0.0
            hold = winner
        else:
            winner, loser = (hold, i) if draws[i] * (2 - total) < 1 - b else (i, hold)
            result[winner], result[loser] = 1.0, total - 1
            hold = loser
        if not 1e-9 < result[hold] < 1 - 1e-9:
            result[hold] = round(result[hold])
            hold = -1
    return result


def _uniform(seed: int, level: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), "id"), 11) / F.lit(float(1 << 53))


def draw(chances: DataFrame, seed: int, most: int, block: int = 20_000) -> DataFrame:
    """id, cell and chance of the rows drawn from ``id, cell, chance``.

    most: rows of the largest cell.  Each round cuts every cell into blocks of about block
    rows, whatever the cell's size, and a block leaves one undecided row at most; the last
    round decides the undecided rows of all cells together.  Draws are hashes of the ids, so
    that a task run twice draws the same.
    """
    columns = "id {}, cell int, chance double, now double".format(chances.schema["id"].dataType.simpleString())

    def fight(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["cell", "u", "id"])
        rows["now"] = pivotal(rows["now"].to_numpy(), rows["v"].to_numpy())
        return rows[["id", "cell", "chance", "now"]]

    open_rows = chances.withColumn("now", F.col("chance"))
    parts = max(1, -(-most // block))
    level, done = 0, None
    while True:
        keyed = open_rows.withColumn("u", _uniform(seed, 2 * level)).withColumn("v", _uniform(seed, 2 * level + 1))
        last = level > 0 and parts == 1
        keyed = keyed.withColumn("cell_key", F.lit(0) if last else F.col("cell"))
        # written down: winners and undecided rows are read from one fight
        out = reliable_checkpoint(keyed.withColumn("part", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(parts))).groupBy("cell_key", "part").applyInPandas(fight, columns))
        won = out.where("now = 1")
        done = won if done is None else done.unionByName(won)
        open_rows = out.where("now > 0 and now < 1")
        if last:
            return done.unionByName(open_rows.withColumn("u", _uniform(seed, 1001)).where("u < now").drop("u")).select("id", "cell", "chance")
        level += 1
        parts = max(1, -(-parts // block)) if parts > 1 else 1


def quota_sample(
    rows: DataFrame, targets: DataFrame, id_col: str = "qtj_id", text_col: str = "query", type_col: str = "supposed_query_type", format_col: str = "supposed_query_format",
    one_in: int = 5, seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """The sample and the report.

    The sample has <id_col>, query_type, query_format and weight (one over the inclusion
    probability); the report has, for each row of targets, available, required (the larger of
    min_rows and the target share rounded up), expected (by the calibration), unmet (the rows
    the calibration can't give, as the category hasn't them), drawn, and gap (required less
    drawn, at least 0).  Rows whose text is null or blank are left out; a null, blank or unknown
    category belongs to no target but counts for the sample's size, one in one_in rows; copies
    of an id count once; without rows every target is a gap, and without targets both results
    are empty; other columns aren't read; ties between rows are settled by hashes of the ids.
    targets, a few rows by nature, is read to the driver after a check of its size.
    """
    cells = targets.select("query_type", "query_format", F.col("target_permille").cast("int").alias("target_permille"), F.col("min_rows").cast("int").alias("min_rows"))
    cells = cells.select("*", category_key(F.col("query_type")).alias("k1"), category_key(F.col("query_format")).alias("k2"))
    table = cells.orderBy("query_type", "query_format").limit(100_001).collect()
    if len(table) > 100_000:
        raise ValueError("targets are too many to calibrate on the driver")
    own = one_per_key(rows, id_col, text_col, type_col, format_col).where(F.col(text_col).rlike(r"(?U)\S"))
    own = own.select(F.col(id_col).alias("id"), category_key(F.coalesce(type_col, F.lit(""))).alias("k1"), category_key(F.coalesce(format_col, F.lit(""))).alias("k2"))
    index = {(r["k1"], r["k2"]): i for i, r in enumerate(table)}
    spark = rows.sparkSession
    names = spark.createDataFrame([(a, b, i) for (a, b), i in index.items()], "k1 string, k2 string, cell int")
    # categories outside the targets may be many: they are added up before anything is collected
    moments = own.groupBy("k1", "k2").count().join(F.broadcast(names), ["k1", "k2"], "left").groupBy("cell").agg(F.sum("count").alias("n")).collect()
    counts = {r["cell"]: r["n"] for r in moments}
    size = sum(counts.values()) // one_in
    available = np.array([counts.get(i, 0) for i in range(len(table))], np.int64)
    plan = calibrate(available, [r["target_permille"] for r in table], [r["min_rows"] for r in table], size, [r["k1"] for r in table], [r["k2"] for r in table])
    chance = spark.createDataFrame([(a, b, i, float(plan.probability[i])) for (a, b), i in index.items()], "k1 string, k2 string, cell int, chance double")
    chances = own.join(F.broadcast(chance), ["k1", "k2"]).where("chance > 0").select("id", "cell", "chance")
    drawn = draw(chances, seed, int(available.max(initial=0)))
    facts = spark.createDataFrame(
        [(i, r["query_type"], r["query_format"], int(available[i]), int(plan.required[i]), float(available[i] * plan.probability[i]), int(plan.unmet[i])) for i, r in enumerate(table)],
        "cell int, query_type string, query_format string, available bigint, required bigint, expected double, unmet bigint",
    )
    sample = drawn.join(F.broadcast(facts), "cell").select(F.col("id").alias(id_col), "query_type", "query_format", (1 / F.col("chance")).alias("weight"))
    taken = drawn.groupBy("cell").agg(F.count("*").alias("drawn"))
    report = facts.join(taken, "cell", "left").select("query_type", "query_format", "available", "required", "expected", "unmet", F.coalesce("drawn", F.lit(0)).alias("drawn"), F.greatest(F.col("required") - F.coalesce("drawn", F.lit(0)), F.lit(0)).alias("gap"))
    return sample, report
