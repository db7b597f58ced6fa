"""The registered queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.functions.fuzzy import partial_ratio_column
from pagewright.generation.client import OfflineClient
from pagewright.generation.prompts import TASKS, numbered_requests, rendered
from pagewright.generation.runner import asked, split_failures, usage_of
from pagewright.operators import embedding, headings, quality, querygen, reconcile, sections, selection, toc, usage, vectors, windows
from pagewright.plans import corpus
from pagewright.plans.corpus import flat, read
from pagewright.plans.pipelines import Flow
from pagewright.plans.sql import oracle_sql
from pagewright.streaming import pages as streams

Query = Callable[[SparkSession, str], DataFrame]
NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
_QUERIES: dict[str, Query] = {}


def registered(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


# --- pages and tables of contents -----------------------------------------------------------


@registered
def line_normalize(spark: SparkSession, folder: str) -> DataFrame:
    own = read(spark, folder, "documents").select("doc_id", F.posexplode(T.split_lines(F.col("text"))).alias("pos", "raw"))
    return flat(own.select("doc_id", "pos", T.normalize_line(F.col("raw")).alias("line")).where("line <> ''"))


@registered
def toc_line_features(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.derived_pages(spark, folder).select("doc_id", toc.clean_lines(F.col("lines")).alias("lines"))
    count = lambda test: F.size(F.filter("lines", test))
    return flat(own.select(
        "doc_id", F.size("lines").alias("line_count"), count(toc.eligible).alias("eligible"), count(lambda x: toc.eligible(x) & x.rlike(toc.DOTTED)).alias("dotted"),
        count(lambda x: toc.eligible(x) & toc.trailing_number(x)).alias("trailing"), count(toc.toc_like).alias("toc_like")))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    return toc.page_manifest(corpus.derived_pages(spark, folder))


@registered
def page_toc_score(spark: SparkSession, folder: str) -> DataFrame:
    scored = toc.score_pages(corpus.derived_pages(spark, folder))
    return flat(scored.select("filename", "page_index", "is_toc_page", "toc_needs_manual_review", "toc_score", "toc_has_title", "toc_is_early_page", "toc_eligible_line_count", "toc_like_line_count", "toc_like_ratio", "toc_dotted_count", "toc_trailing_page_number_count", "toc_section_number_count", F.array_join("toc_reasons", "|").alias("toc_reasons")))


@registered
def page_manifest(spark: SparkSession, folder: str) -> DataFrame:
    own = _manifest(spark, folder)
    return flat(own.select("filename", "pdf_filename", "page_index", "page_number", "image_page_number", "is_toc_page", "exclude_from_visual_summaries", "exclude_from_image_rendering", "exclusion_reason", "text_preview", "parse_status", "toc_score", F.array_join("toc_sample_lines", "|").alias("toc_sample_lines")))


@registered
def toc_document_summary(spark: SparkSession, folder: str) -> DataFrame:
    own = toc.document_summary(_manifest(spark, folder), read(spark, folder, "md_documents").select("filename"))
    return flat(own)


@registered
def excluded_pages(spark: SparkSession, folder: str) -> DataFrame:
    return flat(toc.excluded_pages(_manifest(spark, folder)))


@registered
def pages_kept(spark: SparkSession, folder: str) -> DataFrame:
    own = _manifest(spark, folder)
    return flat(toc.pages_kept(own.select("filename", "page_index"), own))


@registered
def toc_candidate_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = corpus.derived_pages(spark, folder).select("doc_id", F.array_join("lines", "\n").alias("content"))
    return flat(headings.toc_candidate_pages(pages, "doc_id").select("doc_id", "page_index"))


# --- headings and sections ------------------------------------------------------------------


@registered
def heading_outline(spark: SparkSession, folder: str) -> DataFrame:
    return flat(headings.heading_outline(corpus.md_documents(spark, folder)))


@registered
def page_split_at_heading(spark: SparkSession, folder: str) -> DataFrame:
    pages = corpus.md_documents(spark, folder).select("id", F.posexplode(T.split_pages(F.col("content"))).alias("page_index", "page"))
    return flat(pages.select("id", "page_index", headings.split_at_heading(F.col("page")).alias("s")).select("id", "page_index", "s.head", "s.tail"))


def _listed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a table of contents of their own headings put before them."""
    documents = corpus.md_documents(spark, folder)
    outline = headings.heading_outline(documents).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "title", "page"))).alias("o"))
    entries = F.transform("o", lambda x: F.concat(F.trim(F.regexp_replace(x["title"], "#", "")), F.lit(" .... "), x["page"].cast("string")))
    listing = F.concat(F.lit("Table of contents\n"), F.array_join(entries, "\n"), F.lit(f"\n{T.PAGE_BREAK}\n"))
    return documents.join(outline, "id", "left").select("id", F.concat(F.coalesce(listing, F.lit("")), "content").alias("content"))


@registered
def document_sections(spark: SparkSession, folder: str) -> DataFrame:
    return flat(sections.section_documents(_listed_documents(spark, folder)))


@registered
def section_offsets(spark: SparkSession, folder: str) -> DataFrame:
    return flat(sections.document_offsets(_listed_documents(spark, folder)))


def _ruled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """For each file name a document with a listing of parts: every third page begins one, whose
    heading is letters that resemble no others', and stands shift pages after what is listed."""
    names = read(spark, folder, "documents").select(F.col("source").alias("id")).distinct()
    own = names.select("id", (T.hash_integer("shift", F.col("id")) % 4).cast("int").alias("shift"), (25 + T.hash_integer("pages", F.col("id")) % 9).cast("int").alias("pages"))
    letters = lambda k: F.translate(F.substring(F.md5(F.concat_ws("|", "id", k.cast("string"))), 1, 12), "0123456789", "ghijklmnop")
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.col("pages") - 1) / 3).cast("int")), lambda k: F.concat(letters(k), F.lit(" "), (k * 3 + 1).cast("string")))
    body = F.transform(F.sequence(F.lit(0), F.col("pages") - 1), lambda n: F.concat(F.when(n % 3 == 0, F.concat(F.lit("# "), letters((n / 3).cast("int")), F.lit("\n"))).otherwise(""), F.lit("text")))
    filler = F.array_repeat(F.lit("before"), F.col("shift"))
    pages = F.concat(F.array(F.concat(F.lit("Table of contents\n"), F.array_join(parts, "\n"))), filler, body)
    return own.select("id", F.array_join(pages, f"\n{T.PAGE_BREAK}\n").alias("content"))


@registered
def offsets_by_rule(spark: SparkSession, folder: str) -> DataFrame:
    return flat(sections.document_offsets(_ruled_documents(spark, folder)))


@registered
def sections_by_rule(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of the sections of documents whose parts are known."""
    return flat(sections.section_documents(_ruled_documents(spark, folder)).select("id", "ord", "page_numbers"))


@registered
def titles_by_rule(spark: SparkSession, folder: str) -> DataFrame:
    """Titles that are equal, but for marks and digits, or altogether different."""
    own = read(spark, folder, "documents").where("doc_id is not null").select("source", "doc_id", (F.col("doc_id") % 7).cast("int").alias("page"), (T.hash_integer("title", F.col("doc_id")) % 5).cast("string").alias("kind"))
    letters = F.translate(F.substring(F.md5(F.concat_ws("|", "source", "kind")), 1, 12), "0123456789", "ghijklmnop")
    titles = own.select(F.col("source").alias("id"), F.col("doc_id").alias("ord"), F.concat(F.lit("## "), letters, F.lit(" "), F.col("doc_id").cast("string")).alias("title"), "page")
    return flat(sections.dedupe_titles(titles).select("id", "ord", "page"))


@registered
def title_dedupe_fuzzy(spark: SparkSession, folder: str) -> DataFrame:
    outline = headings.heading_outline(corpus.md_documents(spark, folder))
    return flat(sections.dedupe_titles(outline.select("id", F.col("pos").alias("ord"), "title", "page")))


@registered
def title_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Partial ratio of each document's headings with its description."""
    outline = headings.heading_outline(corpus.md_documents(spark, folder))
    described = read(spark, folder, "md_documents").where("description is not null").groupBy("id").agg(F.min("description").alias("description"))
    own = outline.join(described, "id").select("id", "pos", partial_ratio_column(F.col("title"), F.col("description")).alias("ratio"))
    return flat(own)


@registered
def offset_mode(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.sections(spark, folder).where("page_numbers is not null and size(page_numbers) > 0")
    offsets = own.select("filename", F.col("id").alias("ord"), (F.array_max("page_numbers") - F.array_min("page_numbers")).alias("offset"))
    return flat(sections.offset_mode(offsets, "filename"))


# --- windows and statistics -----------------------------------------------------------------


def _page_lists(spark: SparkSession, folder: str) -> DataFrame:
    counts = reconcile.page_counts(corpus.md_documents(spark, folder), "filename")
    return counts.select("filename", F.sequence(F.lit(0), F.col("pages") - 1).alias("pages"))


@registered
def sliding_windows(spark: SparkSession, folder: str) -> DataFrame:
    return flat(windows.sliding_windows(_page_lists(spark, folder), 4, 3))


@registered
def tumbling_windows(spark: SparkSession, folder: str) -> DataFrame:
    return flat(windows.tumbling_windows(_page_lists(spark, folder)))


@registered
def windows_capped(spark: SparkSession, folder: str) -> DataFrame:
    own = windows.sliding_windows(_page_lists(spark, folder), 2, 1)
    return flat(windows.capped_windows(own, 3, 100))


@registered
def description_sample(spark: SparkSession, folder: str) -> DataFrame:
    return flat(windows.description_sample(_page_lists(spark, folder)))


@registered
def corpus_stats(spark: SparkSession, folder: str) -> DataFrame:
    documents = reconcile.page_counts(corpus.md_documents(spark, folder), "filename")
    summaries = corpus.to_judge(spark, folder).select("qtj_id", F.explode("filenames").alias("filename")).distinct()
    return flat(reconcile.corpus_stats(documents, corpus.sections(spark, folder), summaries))


@registered
def corpus_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.missing_on_either_side(read(spark, folder, "documents").select(F.col("source").alias("filename")), read(spark, folder, "sections").where("document_id is not null"))


@registered
def page_count_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    left = reconcile.page_counts(corpus.md_documents(spark, folder), "filename")
    right = read(spark, folder, "documents").where("page_number is not null").groupBy(F.col("source").alias("filename")).agg((F.max("page_number") + 1).alias("pages"))
    return flat(reconcile.page_count_mismatch(left, right))


# --- selection ------------------------------------------------------------------------------


@registered
def judgment_pass(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.judged(spark, folder)
    return flat(own.select("qtj_id", selection.passes(4, *selection.CRITERIA).alias("passing"), selection.bucket(selection.is_combined()).alias("bucket")))


@registered
def judgment_mean(spark: SparkSession, folder: str) -> DataFrame:
    return flat(corpus.judged(spark, folder).select("qtj_id", selection.mean_grade(*selection.CRITERIA).alias("mean_grade")))


@registered
def summary_touches_visual(spark: SparkSession, folder: str) -> DataFrame:
    return flat(selection.touched_visual(corpus.to_judge(spark, folder), corpus.sections(spark, folder), "qtj_id").select("qtj_id", "visual"))


@registered
def combined_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.judged(spark, folder).where(selection.passes(3, *selection.CRITERIA) & F.col("filenames").isNotNull())
    return flat(selection.dedupe_combined(own).select("qtj_id"))


@registered
def priority_fill(spark: SparkSession, folder: str) -> DataFrame:
    own = selection.priority_fill(corpus.judged(spark, folder), 200)
    return flat(own.select("qtj_id", "bucket", "passing", "selected_reason"))


@registered
def quota_round_robin(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.judged(spark, folder).select("ord", "qtj_id", (F.col("qtj_id") % 6).cast("int").alias("bucket_no"))
    return flat(selection.quota_round_robin(own, 400).select("qtj_id", "bucket_no", "round"))


@registered
def balanced_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Passing summaries taken in turn from six buckets, by visual content and combination."""
    own = corpus.judged(spark, folder).where("filenames is not null").withColumn("combined", selection.is_combined())
    return flat(selection.balanced_selection(own, corpus.sections(spark, folder), 20, 2, key="qtj_id").select("qtj_id", "bucket_no", "round", "selected_reason"))


@registered
def passing_count(spark: SparkSession, folder: str) -> DataFrame:
    return selection.count_passing(corpus.judged(spark, folder), 3, *selection.CRITERIA)


@registered
def first_n(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.judged(spark, folder).withColumn("combined", selection.is_combined())
    return flat(selection.first_candidates(150, own.where("combined"), own.where("not combined")).select("qtj_id", "combined"))


# --- queries --------------------------------------------------------------------------------


def _gated(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.to_judge(spark, folder)
    scores = [corpus.grade(c) for c in quality.SCORES]
    flags = [(corpus.grade(c) > 1).alias(c) for c in quality.FOLLOWING]
    return quality.query_gate(own.select("*", *scores, *flags, (F.col("qtj_id") % 17 != 0).alias("judged_ok")))


@registered
def query_gate(spark: SparkSession, folder: str) -> DataFrame:
    return flat(_gated(spark, folder).select("qtj_id", "status"))


@registered
def query_gate_rates(spark: SparkSession, folder: str) -> DataFrame:
    return flat(quality.gate_rates(_gated(spark, folder)))


@registered
def self_answer_filter(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.to_judge(spark, folder).withColumn("has_answer", F.when(F.col("qtj_id") % 13 != 0, F.col("query").rlike(r"\d")))
    return flat(quality.without_answer(own).select("qtj_id"))


@registered
def final_queries(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.to_judge(spark, folder).where("query is not null").withColumn("rephrased_query", F.when(F.col("qtj_id") % 5 != 0, F.lower("query")))
    return flat(quality.final_queries(own).select("qtj_id", "query", "original_query", "generation_process"))


@registered
def question_allocation(spark: SparkSession, folder: str) -> DataFrame:
    return flat(querygen.question_allocation(corpus.to_judge(spark, folder), "qtj_id"))


@registered
def module_sample(spark: SparkSession, folder: str) -> DataFrame:
    return flat(querygen.module_sample(querygen.question_allocation(corpus.to_judge(spark, folder), "qtj_id"), "qtj_id"))


@registered
def query_explode_qrels(spark: SparkSession, folder: str) -> DataFrame:
    return flat(querygen.qrels(corpus.to_judge(spark, folder)))


@registered
def prompt_assembly(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.to_judge(spark, folder).where("query is not null")
    return flat(rendered(own, TASKS["detect_answer"]).select("qtj_id", "prompt"))


@registered
def generated_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Typed queries of all summaries by the offline client, exploded."""
    own = corpus.to_judge(spark, folder).where("summary is not null").select("summary").distinct().withColumn("summary_id", F.md5("summary"))
    asked = own.join(numbered_requests(querygen.module_sample(querygen.question_allocation(own))), "summary_id").withColumn("persona", F.lit("an engineer"))
    said = _asked(asked, "generate_queries").select("summary_id", F.transform("value.queries", lambda q: F.struct(q.alias("query"))).alias("queries"))
    return flat(querygen.explode_queries(said))


def _asked(rows: DataFrame, task: str) -> DataFrame:
    own = TASKS[task]
    return asked(rendered(rows, own), own.ddl, [n for n, _ in own.fields], OfflineClient(fail_every=29), "offline")


def _page_images(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of the derived corpus as images: filename, page, url of the text's bytes."""
    own = corpus.derived_pages(spark, folder)
    return own.select("filename", F.col("page_index").alias("page"), T.data_url(F.lit("page.png"), F.encode(F.array_join("lines", "\n"), "UTF-8")).alias("url"))


@registered
def visual_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    """A description of each document by the offline client, which is shown its first pages."""
    images = _page_images(spark, folder)
    first = windows.description_sample(windows.page_lists(images, "page")).select("filename", F.col("pages").alias("page_numbers"))
    shown = Flow.with_images(first, images, "filename").withColumn("shown", F.size("images"))
    return flat(_asked(shown, "describe_visual_document").select("filename", "shown", "ok", "value.description"))


@registered
def page_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Queries for windows of five pages by the offline client, one of each kind asked for."""
    images = _page_images(spark, folder)
    own = windows.tumbling_windows(windows.page_lists(images, "page")).withColumn("request_id", F.concat_ws("/", "filename", F.col("window").cast("string")))
    wanted = numbered_requests(querygen.module_sample(querygen.one_of_each(own, "request_id"), "request_id"), "request_id")
    said = _asked(Flow.with_images(own, images, "filename", "request_id").join(wanted, "request_id"), "query_one_section")
    return flat(said.where("ok").select("request_id", F.size("page_numbers").alias("pages"), F.posexplode("value.queries").alias("query_no", "query")))


@registered
def contents_check(spark: SparkSession, folder: str) -> DataFrame:
    """What the offline client says of pages that may be tables of contents."""
    pages = corpus.derived_pages(spark, folder).select("doc_id", F.array_join("lines", "\n").alias("content"))
    own = headings.toc_candidate_pages(pages, "doc_id").withColumn("page", F.regexp_replace(F.regexp_replace(F.lower("page"), r"(?U)\s+", " "), "table of contents", ""))
    return flat(_asked(own, "check_contents_page").select("doc_id", "page_index", "ok", "value.has_table_of_contents"))


@registered
def document_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    """A description of each document by the offline client; failures keep their error."""
    return flat(_asked(corpus.md_documents(spark, folder), "describe_document").select("id", "ok", "error", "value.description"))


@registered
def section_summaries(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.sections(spark, folder).where("section is not null").withColumn("document_description", F.lit("No description is available."))
    return flat(split_failures(_asked(own, "summarise_section"))[0].select("id", "filename", "page_numbers", "value.summary"))


@registered
def summary_judgments(spark: SparkSession, folder: str) -> DataFrame:
    """Grades of each summary by the offline client and what they select."""
    own = corpus.to_judge(spark, folder).where("summary is not null").withColumn("persona", F.lit("an engineer"))
    graded = _asked(own, "judge_summary").select("*", *[F.when(F.col("ok"), F.col(f"value.{c}")).otherwise(1).alias(c) for c in selection.CRITERIA])
    return flat(graded.select("qtj_id", *selection.CRITERIA, selection.passes(4, *selection.CRITERIA).alias("passing")))


@registered
def rephrased_queries(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.to_judge(spark, folder).where("query is not null").withColumn("query_type", F.col("supposed_query_type")).withColumn("query_format", F.col("supposed_query_format"))
    said = _asked(own, "rephrase_query").withColumn("rephrased_query", F.col("value.rephrased_query"))
    return flat(quality.final_queries(said).select("qtj_id", "query", "original_query", "generation_process"))


# --- vectors --------------------------------------------------------------------------------


@registered
def mutual_knn(spark: SparkSession, folder: str) -> DataFrame:
    return flat(vectors.mutual_neighbours(vectors.nearest_neighbours(corpus.vectors(spark, folder))))


@registered
def cluster_density(spark: SparkSession, folder: str) -> DataFrame:
    return flat(vectors.density_clusters(corpus.vectors(spark, folder), recall=None))


@registered
def text_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    own = corpus.to_judge(spark, folder).where("summary is not null")
    found = embedding.embed_texts(own, embedding.offline_embedder(), "qtj_id")
    return found.select("qtj_id", F.posexplode("embedding").alias("k", "x")).where("x <> 0").select("qtj_id", F.col("k").cast("bigint").alias("k"), F.round(F.col("x").cast("double") * 1e4).cast("bigint").alias("parts"))


@registered
def vectors_centred(spark: SparkSession, folder: str) -> DataFrame:
    own = embedding.centred(corpus.vectors(spark, folder))
    return own.select("vec_id", F.posexplode("embedding").alias("k", "x")).select("vec_id", F.col("k").cast("bigint").alias("k"), F.round(F.col("x") * 1e6).cast("bigint").alias("micro"))


@registered
def vectors_projected(spark: SparkSession, folder: str) -> DataFrame:
    found = embedding.random_projection(corpus.vectors(spark, folder), 8)
    return found.select("vec_id", F.posexplode("embedding").alias("k", "x")).select("vec_id", F.col("k").cast("bigint").alias("k"), F.round(F.col("x") * 1e6).cast("bigint").alias("micro"))


@registered
def summaries_fused(spark: SparkSession, folder: str) -> DataFrame:
    """The summaries of the queries that share one list of files, in one text."""
    own = corpus.to_judge(spark, folder).where("summary is not null and filenames is not null").select("ord", F.array_join("filenames", ",").alias("files"), "summary")
    own = own.groupBy("files", "summary").agg(F.min("ord").alias("ord"))
    return selection.fused(own, "files")


def _members(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.vectors(spark, folder).select(F.col("vec_id").alias("ord"), (F.col("vec_id") % 20).alias("document"), F.col("label").alias("cluster"))


@registered
def cluster_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return flat(vectors.cluster_tuples(_members(spark, folder), 2))


@registered
def cluster_triplets(spark: SparkSession, folder: str) -> DataFrame:
    return flat(vectors.cluster_tuples(_members(spark, folder), 3))


@registered
def multi_doc_share(spark: SparkSession, folder: str) -> DataFrame:
    own = _members(spark, folder)
    tuples = vectors.cluster_tuples(own, 2).unionByName(vectors.cluster_tuples(own, 3))
    return flat(vectors.multi_document_share(tuples))


# --- scalars and usage ----------------------------------------------------------------------


@registered
def usage_rollup(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events")
    calls = events.select(
        F.col("event_type").alias("model"), (F.col("event_id") % 1000 - 3).alias("input_tokens"), F.when(F.col("event_id") % 7 != 0, F.col("event_id") % 500).alias("output_tokens"),
        (F.col("event_id") % 1500).alias("total_tokens"), F.when(F.col("event_type") != "click", F.col("event_id") % 100).cast("bigint").alias("cost"))
    return flat(usage.usage_rollup(calls, "model"))


@registered
def usage_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The streaming aggregation, over a table that is all there."""
    events = read(spark, folder, "events").select("ts", F.col("event_type").alias("model"), (F.col("event_id") % 1500).alias("tokens"))
    own = streams.usage_windows(events)
    return flat(own.select(F.unix_timestamp("window_start").alias("window_start"), "model", "call_count", "tokens"))


@registered
def event_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """Moments as text, a label of each type, kinds of a list of four, and a hash of the properties."""
    labels = F.create_map(*[F.lit(x) for x in ("click", "pressed", "view", "seen")])
    kinds = F.array_join(T.padded(F.array("event_type"), F.lit(4), F.lit("-")), ",")
    return read(spark, folder, "events").select("event_id", T.utc_stamp(F.col("ts").cast("timestamp")).alias("stamp"), T.lookup(labels, F.col("event_type"), F.lit("other")).alias("label"), kinds.alias("kinds"), T.content_hash(F.coalesce("props", F.lit(""))).alias("hash"))


@registered
def usage_log(spark: SparkSession, folder: str) -> DataFrame:
    """The row of the usage log for one batch of calls."""
    replies = read(spark, folder, "events").select((F.col("event_id") % 500).alias("input_tokens"), (F.col("event_id") % 300 - 5).alias("output_tokens"), (F.col("event_id") % 800).alias("total_tokens"))
    return flat(usage_of(replies, "model", "batch", 4).drop("timestamp"))


@registered
def doc_uuid5(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "documents").select("source").distinct().select("source", T.uuid5(NAMESPACE, F.col("source")).alias("uuid"))


@registered
def filename_normalize(spark: SparkSession, folder: str) -> DataFrame:
    names = read(spark, folder, "md_documents").select(F.coalesce("description", "filename").alias("filename"))
    return reconcile.normalized_names(names)


@registered
def data_url(spark: SparkSession, folder: str) -> DataFrame:
    own = read(spark, folder, "documents").where("text is not null")
    return own.select("doc_id", T.data_url(F.concat("source", F.lit(".png")), F.encode("text", "UTF-8")).alias("url"))


@registered
def think_strip(spark: SparkSession, folder: str) -> DataFrame:
    own = read(spark, folder, "documents").where("text is not null and doc_id is not null")
    reply = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<think>a\nb</think>"), "text")).otherwise(F.col("text"))
    return own.select("doc_id", T.strip_reasoning(reply).alias("reply"))


@registered
def json_payload(spark: SparkSession, folder: str) -> DataFrame:
    own = read(spark, folder, "events").where("props is not null")
    reply = F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```"))
    return own.select("event_id", T.json_payload(reply).alias("payload"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


__all__ = ["oracle_sql", "queries"]
