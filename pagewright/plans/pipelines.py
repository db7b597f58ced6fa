"""The three flows from documents, page images and summaries to queries, stage by stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.functions.order import running_totals
from pagewright.functions.text import uuid5
from pagewright.generation.client import Client
from pagewright.generation.config import ProviderConfig
from pagewright.generation.prompts import TASKS, criteria_rows, description_blocks, descriptions_in_one, numbered_requests, rendered
from pagewright.generation.runner import cached_replies, complete_prompts, parsed, prompt_key, split_failures, usage_of
from pagewright.operators import quality, querygen, selection, vectors
from pagewright.operators.embedding import Embedder, centred, embed_texts, offline_embedder, random_projection
from pagewright.operators.headings import toc_candidate_pages
from pagewright.operators.sections import section_documents
from pagewright.operators.toc import pages_kept
from pagewright.operators.windows import capped_windows, description_sample, page_lists, sliding_windows, tumbling_windows
from pagewright.plans.stages import stage, written
from pagewright.session import reliable_checkpoint
from pagewright.sources.sinks import append_usage, fresh_vectors, write_vectors

NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


@dataclass(frozen=True)
class Settings:
    """Parameters of the flows; None for a cap means no bound."""

    language: str = "english"
    persona: str = ""
    document_description: str = "No description is available."
    wanted: int = 50
    iterations: int = 15
    multi_document_per_mille: int = 500
    neighbours: int = 5
    section_size: int = 1
    stride: int = 1
    max_windows: int | None = None
    max_windows_per_document: int | None = None
    min_grade: int = 4
    judge: bool = True
    combine: bool = True
    overwrite: bool = False
    check_contents: bool = False

    def __post_init__(self) -> None:
        for name in ("section_size", "stride"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be positive")
        for name in ("max_windows", "max_windows_per_document"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be positive or None")
        if not 0 <= self.multi_document_per_mille <= 1000:
            raise ValueError("multi_document_per_mille must lie within 0 and 1000")
        if not 1 <= self.min_grade <= 5:
            raise ValueError("min_grade must lie within 1 and 5")
        if self.wanted < 0 or self.iterations < 0:
            raise ValueError("wanted and iterations must not be negative")


@dataclass
class Flow:
    """A session, a folder for stage tables, a client and settings."""

    spark: SparkSession
    root: str
    client: Client
    provider: ProviderConfig
    settings: Settings = Settings()

    def stage(self, name: str, build) -> DataFrame:
        return stage(self.spark, f"{self.root}/{name}", build, self.settings.overwrite)

    def ask(self, rows: DataFrame, task_name: str) -> DataFrame:
        """rows with ok, error and the task's fields as ``value``; replies are cached by prompt,
        and what was asked anew has a row in the usage log."""
        task = TASKS[task_name]
        model = self.provider.model(task.role)
        asked = complete_prompts(rendered(rows, task, self.settings.language)).withColumn("prompt_key", prompt_key(model))
        log = lambda fresh: append_usage(usage_of(fresh, model, task_name, self.provider.max_concurrency).where("call_count > 0"), f"{self.root}/usage")
        replies = cached_replies(asked.select("prompt", "images", "captions", "schema", "max_tokens"), self.client, model, f"{self.root}/cache/{task_name}", log=log)
        good = parsed(replies, task.ddl, [n for n, _ in task.fields]).select("prompt_key", "ok", "error", "value")
        return asked.join(good, "prompt_key", "left").drop("prompt", "schema", "max_tokens", "prompt_key", "images", "captions")

    def described_corpus(self, descriptions: DataFrame, most_chars: int = 400_000) -> DataFrame:
        """One row (ok, error, value) that describes the corpus by the descriptions of all
        documents (filename, description).

        Descriptions that don't fit into one prompt are described in blocks, and these
        descriptions in turn, until one prompt holds them.  A block that fails fails the whole.
        """
        level = 0
        while True:
            own = descriptions.where("description is not null")
            rows, chars = own.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("description") + 8), F.lit(0))).first()
            if chars <= most_chars or rows < 2:
                break
            blocks = description_blocks(own, most_chars)
            asked = self.stage(f"corpus_description_blocks/{level}", lambda b=blocks: self.ask(b, "describe_corpus").drop("descriptions"))
            failed = asked.where("not coalesce(ok, false)").orderBy("block").limit(1)
            if failed.count():
                return failed.select("ok", "error", "value")
            if asked.count() >= rows:
                break  # each is as long as a prompt: blocks of blocks wouldn't be fewer
            descriptions = asked.select(F.lpad(F.col("block").cast("string"), 20, "0").alias("filename"), F.col("value.description").alias("description"))
            level += 1
        return self.ask(descriptions_in_one(descriptions), "describe_corpus").drop("descriptions")

    # --- summaries --------------------------------------------------------------------------

    def markdown_summaries(self, documents: DataFrame) -> DataFrame:
        """Documents (filename, content) to single summaries with ord and provenance."""
        described = self.stage("descriptions", lambda: self.ask(documents, "describe_document"))
        text = F.coalesce(F.nullif(F.col("value.description"), F.lit("")), F.lit(self.settings.document_description))
        descriptions = described.select("filename", text.alias("description"))
        self.stage("corpus_description", lambda: self.described_corpus(descriptions))
        confirmed = self.contents_pages(documents) if self.settings.check_contents else None
        sections = self.stage("sections", lambda: section_documents(documents, "filename", confirmed=confirmed).join(descriptions.withColumnRenamed("description", "document_description"), "filename", "left"))
        summarised = self.stage("summaries_asked", lambda: self.ask(sections, "summarise_section"))
        return self.stage("summaries", lambda: self._numbered(split_failures(summarised)[0].select("filename", F.col("ord").alias("part"), F.col("value.summary").alias("summary"), "page_numbers")))

    def contents_pages(self, documents: DataFrame) -> DataFrame:
        """filename, page_index, page of the candidate pages that the model takes for tables of
        contents; it sees them in lower case with single spaces and without their title."""
        pages = toc_candidate_pages(documents, "filename")
        shown = F.regexp_replace(F.regexp_replace(F.lower("page"), r"(?U)\s+", " "), "table of contents", "")
        asked = self.stage("contents_asked", lambda: self.ask(pages.select("filename", "page_index", F.col("page").alias("whole"), shown.alias("page")), "check_contents_page"))
        return asked.where("ok and value.has_table_of_contents").select("filename", "page_index", F.col("whole").alias("page"))

    @staticmethod
    def with_images(windows: DataFrame, images: DataFrame, *keys: str) -> DataFrame:
        """windows (keys, page_numbers) with ``images``, the URLs of their pages in order."""
        urls = windows.select(*keys, F.explode("page_numbers").alias("page")).join(images.select("filename", "page", "url"), ["filename", "page"])
        urls = urls.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("page", "url"))).alias("_u")).select(*keys, F.col("_u.url").alias("images"))
        return windows.join(urls, list(keys))

    def visual_descriptions(self, images: DataFrame, most: int = 3) -> DataFrame:
        """filename, description of each document from its first pages; the settings' text where
        the model gave none."""
        first = description_sample(page_lists(images, "page"), most).select("filename", F.col("pages").alias("page_numbers"))
        asked = self.stage("visual_descriptions", lambda: self.ask(self.with_images(first, images, "filename"), "describe_visual_document"))
        return asked.select("filename", F.coalesce(F.nullif(F.col("value.description"), F.lit("")), F.lit(self.settings.document_description)).alias("description"))

    def page_queries(self, images: DataFrame, combined: DataFrame | None = None) -> DataFrame:
        """query, filenames, page_numbers of the queries that a vision model writes for windows
        of pages, and for combinations of summaries, whose images say which section they are of."""
        windows = tumbling_windows(page_lists(images, "page"), self.settings.section_size).withColumn("request_id", uuid5(NAMESPACE, F.concat_ws("/", "filename", F.col("window").cast("string"))))
        requests = numbered_requests(querygen.module_sample(querygen.one_of_each(windows, "request_id"), "request_id"), "request_id")
        own = self.with_images(windows, images, "filename", "request_id").join(requests, "request_id")
        asked = self.stage("page_queries_asked", lambda: self.ask(own, "query_one_section"))
        one = split_failures(asked)[0].select(F.explode("value.queries").alias("query"), F.array("filename").alias("filenames"), F.array("page_numbers").alias("page_numbers"))
        if combined is None:
            return self.stage("page_queries", lambda: one)
        parts = combined.select("summary_id", F.posexplode(F.arrays_zip(F.col("filenames").alias("filename"), F.col("page_numbers").alias("pages"))).alias("section", "z")).select("summary_id", "section", "z.filename", F.explode("z.pages").alias("page"))
        shown = parts.join(images.select("filename", "page", "url"), ["filename", "page"])
        ordered = F.array_sort(F.collect_list(F.struct("section", "page", "url")))
        shown = shown.groupBy("summary_id").agg(ordered.alias("_u")).select("summary_id", F.col("_u.url").alias("images"), F.transform("_u", lambda u: F.concat(F.lit("Images of section "), (u["section"] + 1).cast("string"))).alias("captions"))
        wanted = numbered_requests(querygen.module_sample(querygen.one_of_each(combined)))
        several = combined.select("summary_id", F.col("original_summaries").alias("sections"), "filenames", "page_numbers").join(shown, "summary_id").join(wanted, "summary_id")
        both = self.stage("combination_queries_asked", lambda: self.ask(several, "query_many_sections"))
        many = split_failures(both)[0].select(F.explode("value.queries").alias("query"), "filenames", "page_numbers")
        return self.stage("page_queries", lambda: one.unionByName(many))

    def visual_summaries(self, images: DataFrame, manifest: DataFrame | None = None, descriptions: DataFrame | None = None) -> DataFrame:
        """Page images (filename, page, url) to summaries of sliding windows of pages."""
        kept = images if manifest is None else pages_kept(images.withColumnRenamed("page", "page_index"), manifest).withColumnRenamed("page_index", "page")
        windows = sliding_windows(page_lists(kept, "page"), self.settings.section_size, self.settings.stride)
        windows = capped_windows(windows, self.settings.max_windows_per_document, self.settings.max_windows)
        own = self.with_images(windows, kept, "filename", "window")
        own = own.join(descriptions.select("filename", F.col("description").alias("_d")), "filename", "left") if descriptions is not None else own.withColumn("_d", F.lit(None).cast("string"))
        own = own.withColumn("document_description", F.coalesce(F.nullif(F.col("_d"), F.lit("")), F.lit(self.settings.document_description))).drop("_d")
        asked = self.stage("visual_summaries_asked", lambda: self.ask(own, "summarise_pages"))
        return self.stage("visual_summaries", lambda: self._numbered(split_failures(asked)[0].select("filename", F.col("window").alias("part"), F.col("value.summary").alias("summary"), "page_numbers")))

    @staticmethod
    def _numbered(parts: DataFrame) -> DataFrame:
        """Single summaries with a dense order by document and part: ranks within documents,
        and running totals over documents."""
        sizes = parts.groupBy("filename").agg(F.count(F.lit(1)).alias("_n"))
        before = running_totals(sizes, "filename", "_n", "_before").drop("_n")
        own = parts.withColumn("_k", F.row_number().over(W.partitionBy("filename").orderBy("part"))).join(before, "filename")
        order = (F.col("_before") + F.col("_k") - 1).cast("bigint")
        return own.select(
            order.alias("ord"),
            uuid5(NAMESPACE, F.concat_ws("/", "filename", F.col("part").cast("string"))).alias("summary_id"),
            "summary", F.array(uuid5(NAMESPACE, F.col("filename"))).alias("document_ids"), F.array("filename").alias("filenames"), F.array("page_numbers").alias("page_numbers"),
            F.lit(None).cast("array<string>").alias("original_summaries"), F.lit(None).cast("string").alias("addition_reason"),
        )

    def embedded(self, summaries: DataFrame, embedder: Embedder | None = None, dimensions: int = 32) -> DataFrame:
        """ord, embedding of each summary: embedded where its text is new, centred, and projected
        on fewer dimensions.  Vectors are kept with the hash of their text."""
        embedder = embedder or offline_embedder()
        path, own = f"{self.root}/vectors", summaries.select("ord", "summary")
        if written(self.spark, path):
            known, missing = fresh_vectors(self.spark.read.parquet(path), own, "ord", "summary")
            raw = known.unionByName(embed_texts(missing, embedder).join(missing, "ord").select(known.columns))
        else:
            raw = embed_texts(own, embedder).join(own, "ord")
        raw = reliable_checkpoint(raw)  # read before its own table is written anew
        write_vectors(raw, path, "ord", "summary")
        own = raw.select("ord", "embedding")
        return self.stage("vectors_reduced", lambda: random_projection(centred(own, "ord"), dimensions, key="ord").select("ord", F.col("embedding").cast("array<float>").alias("embedding")))

    def combined_summaries(self, summaries: DataFrame, embeddings: DataFrame | None = None) -> DataFrame:
        """Pairs and triplets of neighbouring summaries combined; embeddings: ord, embedding
        (those of embedded() unless given)."""
        embeddings = self.embedded(summaries) if embeddings is None else embeddings
        clusters = self.stage("clusters", lambda: vectors.density_clusters(embeddings, self.settings.neighbours, key="ord"))
        members = summaries.select("ord", F.element_at("filenames", 1).alias("document")).join(clusters, "ord")

        def build() -> DataFrame:
            pairs = vectors.cluster_tuples(members, 2, self.settings.iterations, self.settings.multi_document_per_mille)
            triplets = vectors.cluster_tuples(members, 3, self.settings.iterations, self.settings.multi_document_per_mille)
            return pairs.unionByName(triplets).select("members").distinct()

        tuples = self.stage("tuples", build)
        parts = tuples.select("members", F.explode("members").alias("ord")).join(summaries, "ord").groupBy("members").agg(F.array_sort(F.collect_list(F.struct("ord", "summary", "document_ids", "filenames", "page_numbers"))).alias("p"))
        own = parts.select("members", F.col("p.summary").alias("summaries"), F.flatten("p.document_ids").alias("document_ids"), F.flatten("p.filenames").alias("filenames"), F.flatten("p.page_numbers").alias("page_numbers"))
        asked = self.stage("combined_asked", lambda: self.ask(own, "combine_summaries"))
        key = F.array_join(F.transform("members", lambda m: m.cast("string")), "+")
        return self.stage("combined", lambda: split_failures(asked)[0].select(
            F.xxhash64("members").alias("ord"), uuid5(NAMESPACE, key).alias("summary_id"), F.col("value.summary").alias("summary"), "document_ids", "filenames", "page_numbers",
            F.col("summaries").alias("original_summaries"), F.lit(selection.VISUAL_REASON).alias("addition_reason")))

    def selected_in_turn(self, summaries: DataFrame, sections: DataFrame, combined: DataFrame | None = None) -> DataFrame:
        """Judged candidates that pass, taken in turn from six buckets by whether their sections
        (filename, section, page_numbers) have visual content and how many they are; all of them
        where there are fewer than wanted."""
        graded = self.judged([summaries] if combined is None else [summaries, combined])
        own = graded.withColumn("combined", F.col("source") == 1).withColumn("_order", F.struct("source", "ord"))
        passing = own.where(selection.passes(self.settings.min_grade, *selection.CRITERIA))
        once = passing.where("not combined").select("summary_id").unionByName(selection.dedupe_combined(passing.where("combined"), "_order").select("summary_id"))
        wanted = min(self.settings.wanted, once.count())
        chosen = lambda: selection.balanced_selection(own, sections, wanted, self.settings.min_grade, order="_order").drop("_order", "value")
        return self.stage("selected", chosen)

    def selected(self, summaries: DataFrame, combined: DataFrame | None = None) -> DataFrame:
        """Judged candidates, combined ones first, and the wanted best of them."""
        parts = [combined, summaries] if combined is not None else [summaries]
        if not self.settings.judge:
            return self.stage("selected", lambda: selection.first_candidates(self.settings.wanted, *parts))
        ordered = self.judged(parts).withColumn("_order", F.struct("source", "ord"))
        return self.stage("selected", lambda: selection.priority_fill(ordered, self.settings.wanted, self.settings.min_grade, order="_order").drop("_order", "value"))

    def judged(self, parts: list[DataFrame]) -> DataFrame:
        """The parts, numbered in ``source``, with a grade for each criterion."""
        candidates = None
        for rank, part in enumerate(parts):
            own = part.withColumn("source", F.lit(rank))
            candidates = own if candidates is None else candidates.unionByName(own)
        asked = self.stage("judgments", lambda: self.ask(candidates.withColumn("persona", F.lit(self.settings.persona)), "judge_summary"))
        # a failed judgment counts as the lowest grades, so that it may still fill up
        return asked.select("*", *[F.when(F.col("ok"), F.col(f"value.{c}")).otherwise(1).alias(c) for c in selection.CRITERIA])

    # --- queries ----------------------------------------------------------------------------

    def queries(self, selected: DataFrame) -> DataFrame:
        """Typed queries of the selected summaries through all gates to the final rows."""
        summaries = selected.select("summary_id", "summary", "document_ids", "filenames", "page_numbers")
        drawn = self.stage("modules", lambda: querygen.module_sample(querygen.question_allocation(summaries)))
        requests = numbered_requests(drawn)
        modules = drawn.withColumn("query_no", F.row_number().over(W.partitionBy("summary_id").orderBy("pool", "draw")) - 1)
        own = summaries.join(requests, "summary_id").withColumn("persona", F.lit(self.settings.persona))
        asked = self.stage("queries_asked", lambda: self.ask(own, "generate_queries"))
        rows = split_failures(asked)[0].select("summary_id", "summary", "document_ids", "filenames", "page_numbers", F.posexplode("value.queries").alias("query_no", "query"))
        kinds = modules.select("summary_id", "query_no", F.col("type").alias("supposed_query_type"), F.col("format").alias("supposed_query_format"))
        to_judge = self.stage("queries_to_judge", lambda: rows.join(kinds, ["summary_id", "query_no"]).withColumn("query_id", uuid5(NAMESPACE, F.concat_ws("/", "summary_id", F.col("query_no").cast("string")))))
        judged = self.stage("query_judgments", lambda: self.ask(criteria_rows(to_judge.withColumn("persona", F.lit(self.settings.persona))), "judge_query"))
        grade = lambda c: F.max(F.when(F.col("criterion") == c, F.col("value.grade")))
        scores = judged.groupBy("query_id").agg(
            F.every(F.coalesce("ok", F.lit(False))).alias("judged_ok"), *[grade(c).alias(c) for c in quality.SCORES], *[(grade(c) >= 3).alias(c) for c in quality.FOLLOWING])
        gated = self.stage("query_gate", lambda: quality.query_gate(to_judge.join(scores, "query_id", "left")))
        checked = self.stage("answer_check", lambda: self.ask(gated.where("status = 'keep'").drop("status", "judged_ok"), "detect_answer"))
        free = quality.without_answer(checked.withColumn("has_answer", F.col("value.has_answer"))).drop("ok", "error", "value", "has_answer")
        named = free.withColumn("query_type", F.col("supposed_query_type")).withColumn("query_format", F.col("supposed_query_format"))
        said = self.stage("rephrased", lambda: self.ask(named, "rephrase_query"))
        return self.stage("final_queries", lambda: quality.final_queries(said.withColumn("rephrased_query", F.col("value.rephrased_query")).drop("value", "ok", "error", "query_type", "query_format"), "query_id"))
