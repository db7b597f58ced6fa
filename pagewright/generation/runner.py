"""Running prompts as a DataFrame stage: envelope, payload, cache, usage."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions.text import json_payload
from pagewright.generation.client import Client, Request
from pagewright.operators.usage import usage_rollup
from pagewright.session import reliable_checkpoint

REPLY = "ok boolean, text string, error string, input_tokens bigint, output_tokens bigint, total_tokens bigint"


def prompt_key(model: str) -> F.Column:
    """Hash of what decides a reply: prompt, images, captions, model and arguments."""
    lists = [F.array_join(F.coalesce(c, F.array().cast("array<string>")), "\x1f") for c in ("images", "captions")]
    return F.sha2(F.concat_ws("\x1f", F.lit(model), "prompt", *lists, F.coalesce("schema", F.lit("")), F.col("max_tokens").cast("string")), 256)


def complete_prompts(prompts: DataFrame) -> DataFrame:
    """prompts with the columns that a caller may leave out."""
    none = F.array().cast("array<string>")
    for name, default in (("images", none), ("captions", none), ("schema", F.lit(None).cast("string")), ("max_tokens", F.lit(10_000))):
        if name not in prompts.columns:
            prompts = prompts.withColumn(name, default)
    return prompts


def run_prompts(prompts: DataFrame, client: Client, model: str, parallel: int | None = None, batch: int = 64) -> DataFrame:
    """A reply for each distinct prompt of ``prompt`` (and, where given, images, captions,
    schema, max_tokens), as prompt_key and the columns of REPLY.

    Equal prompts are asked once.  A task asks for batch prompts at a time; how many requests
    are under way is settled by the cluster's tasks and the client's threads, unless parallel
    bounds the tasks.  Tasks may run twice, so replies belong into a table (see cached_replies)
    before they are used more than once.
    """
    own = complete_prompts(prompts).withColumn("prompt_key", prompt_key(model)).select("prompt_key", "prompt", "images", "captions", "schema", "max_tokens").dropDuplicates(["prompt_key"])
    own = own.repartition(parallel, "prompt_key") if parallel else own

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                asked = [Request(p, tuple(i) if i is not None else (), int(m), s, tuple(c) if c is not None else ()) for p, i, c, s, m in zip(*(part[n] for n in ("prompt", "images", "captions", "schema", "max_tokens")))]
                rows = pd.DataFrame([dataclasses.asdict(r) for r in client.generate(asked)])
                rows["total_tokens"] = rows["input_tokens"] + rows["output_tokens"]
                yield rows.assign(prompt_key=part["prompt_key"].to_numpy())[["prompt_key", "ok", "text", "error", "input_tokens", "output_tokens", "total_tokens"]]

    return own.mapInPandas(run, f"prompt_key string, {REPLY}")


def cached_replies(prompts: DataFrame, client: Client, model: str, path: str, parallel: int | None = None, log: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Replies from the Parquet table at path, those missing asked for and appended first.

    Failed replies are not kept, so that the next run asks again; they are in the result, with
    their error.  log is given all replies of this run, written down before, so that tasks run
    twice count once.
    """
    spark = prompts.sparkSession
    keyed = complete_prompts(prompts).withColumn("prompt_key", prompt_key(model))
    try:
        known = spark.read.schema(f"prompt_key string, {REPLY}").parquet(path)
        missing = keyed.join(known.select("prompt_key"), "prompt_key", "left_anti")
    except Exception as error:  # nothing is written yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        missing = keyed
    fresh = reliable_checkpoint(run_prompts(missing.drop("prompt_key"), client, model, parallel))
    fresh.where("ok").write.mode("append").parquet(path)
    if log is not None:
        log(fresh)
    kept = spark.read.schema(f"prompt_key string, {REPLY}").parquet(path).unionByName(fresh.where("not ok")).dropDuplicates(["prompt_key"])
    return keyed.select("prompt_key").distinct().join(kept, "prompt_key", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))


def parsed(replies: DataFrame, schema: str, required: list[str]) -> DataFrame:
    """replies with ``value`` read from JSON; ok is false where a required field is missing."""
    own = replies.withColumn("value", F.from_json(json_payload(F.col("text")), schema))
    whole = F.lit(True)
    for name in required:
        whole = whole & F.col(f"value.{name}").isNotNull()
    good = F.col("ok") & F.col("value").isNotNull() & whole
    return own.select("*", good.alias("_good")).withColumn("error", F.when(F.col("_good"), None).otherwise(F.coalesce("error", F.lit("PayloadError: required fields are missing")))).withColumn("value", F.when(F.col("_good"), F.col("value"))).withColumn("ok", F.col("_good")).drop("_good")


def split_failures(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good rows, and the failed ones for the table of errors."""
    good = F.coalesce(F.col("ok"), F.lit(False))
    return rows.where(good), rows.where(~good)


def usage_of(replies: DataFrame, model: str, description: str, parallel: int) -> DataFrame:
    """One row on a batch for the append-only usage log; counts come from the replies, so that
    tasks run twice don't count twice."""
    total = usage_rollup(replies)
    return total.select(
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.lit(model).alias("model_name"), F.lit(description).alias("batch_description"), "call_count", "input_tokens", "output_tokens", "total_tokens", F.lit(parallel).alias("max_concurrency"),
    )


def asked(rows: DataFrame, ddl: str, required: list[str], client: Client, model: str) -> DataFrame:
    """rows (with prompt and schema) with ok, error and ``value``, asked in one pass."""
    own = complete_prompts(rows).withColumn("prompt_key", prompt_key(model))
    replies = parsed(run_prompts(own.select("prompt", "images", "captions", "schema", "max_tokens"), client, model), ddl, required)
    return own.join(replies.select("prompt_key", "ok", "error", "value"), "prompt_key", "left").drop("prompt", "images", "captions", "schema", "max_tokens", "prompt_key")
