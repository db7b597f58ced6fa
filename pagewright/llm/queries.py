"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import bpe, langid, leakage, neardup, ocr_repair, pair_defects, quota_sample, readability, splitting
from pagewright.llm.textkit import one_per_key

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The ordered pieces of every document and section; items within their limit have one."""
    limits = _read(spark, folder, "split_limits")
    documents = splitting.split_oversized(_read(spark, folder, "md_documents"), limits, "document", "id", "content")
    return documents.unionByName(splitting.split_oversized(_read(spark, folder, "sections"), limits, "section", "id", "section"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The items that the splitter cut."""
    return p1_pieces(spark, folder).where("pieces > 1 and piece = 0").select("item_kind", "item_id")


def _language_model(spark: SparkSession, folder: str) -> langid.LanguageModel:
    return langid.fit_from_tables(_read(spark, folder, "documents"), _read(spark, folder, "language_names"), _read(spark, folder, "queries"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The languages of the queries whose label is missing, wrong or not the whole truth."""
    return langid.label_defects(_read(spark, folder, "queries"), _read(spark, folder, "language_names"), _language_model(spark, folder))


def p2_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Language, confidence and segments of every query."""
    own = one_per_key(_read(spark, folder, "queries"), "query_id", "query")
    return langid.identify(own, _language_model(spark, folder), "query_id", "query")


def _quotas(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return quota_sample.quota_sample(_read(spark, folder, "queries_to_judge"), _read(spark, folder, "sample_targets"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The categories whose targets the calibration could not meet and the sample doesn't."""
    return _quotas(spark, folder)[1].where("unmet > 0 and gap > 0").select("query_type", "query_format")


def p3_report(spark: SparkSession, folder: str) -> DataFrame:
    """Available, required and unmet rows of each category, and whether the rows drawn are those
    that the calibration expects, but for the rounding of a part."""
    drawn = F.abs(F.col("drawn") - F.col("expected")) < 1
    return _quotas(spark, folder)[1].select("query_type", "query_format", "available", "required", "unmet", drawn.alias("drawn_as_expected"))


def p3_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The sample with its weights."""
    return _quotas(spark, folder)[0]


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The kinds of noise of each scanned page."""
    return ocr_repair.page_noise(_read(spark, folder, "md_documents"))


def p4_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The repaired paragraphs of each scanned page."""
    return ocr_repair.repaired_pages(_read(spark, folder, "md_documents"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The defective pairs and their defects."""
    answers, qrels = _read(spark, folder, "answers"), _read(spark, folder, "qrels")
    model = pair_defects.fit_for_pairs(answers, qrels, _read(spark, folder, "documents"), _read(spark, folder, "language_names"), _read(spark, folder, "queries"))
    return pair_defects.pair_defects(answers, qrels, model).where("defect is not null")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of queries that share nearly all of their words."""
    return neardup.near_duplicate_pairs(_read(spark, folder, "queries"), "query_id", "query")


def p6_links(spark: SparkSession, folder: str) -> DataFrame:
    """The links between classes of equal queries."""
    return neardup.near_duplicate_links(_read(spark, folder, "queries"), "query_id", "query")[0]


def p6_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The class of equal queries of each query."""
    return neardup.membership(_read(spark, folder, "queries"), "query_id", "query")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode_corpus(_read(spark, folder, "documents"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluation items that documents give away."""
    return leakage.leaked_items(_read(spark, folder, "documents"), _read(spark, folder, "eval_items"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """The reading level of each English document of 50 pieces or more."""
    return readability.document_levels(_read(spark, folder, "documents"), _read(spark, folder, "reading_samples"))


def queries() -> dict[str, Query]:
    own = (p1_found, p1_pieces, p2_found, p2_segments, p3_found, p3_report, p3_sample, p4_found, p4_pages, p5_found, p6_found, p6_links, p6_classes, p7_ids, p8_found, p9_found)
    return {f.__name__: f for f in own}


def _category(column: str) -> str:
    return rf"lower(regexp_replace(regexp_replace(coalesce({column}, ''), '^\s+|\s+$', '', 'g'), '[-_\s]+', '-', 'g'))"


_WORDS = r"""
words as (
  select query_id, unnest(regexp_extract_all(replace(strip_accents(lower(query)), 'ß', 'ss'), '[\p{L}\p{N}]+')) as word
  from (select query_id, min(query) as query from queries where query is not null group by query_id)
),
counts as (select query_id, word, count(*) as n from words group by all),
sizes as (select query_id, sum(n) as size from counts group by query_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": """
            with items as (
              select 'document' as item_kind, id as item_id, content as body from md_documents
              union all select 'section', id, section from sections
            )
            select distinct item_kind, item_id from items join split_limits using (item_kind)
            where length(body) > max_chars""",
        "p3_report": rf"""
            with own as (
              select distinct qtj_id, {_category('supposed_query_type')} as k1, {_category('supposed_query_format')} as k2
              from queries_to_judge where regexp_matches(query, '\S')
            ),
            facts as (
              select query_type, query_format, (select count(distinct qtj_id) from own where k1 = {_category('query_type')} and k2 = {_category('query_format')}) as available,
                     greatest(min_rows, ceil(target_permille * (select count(distinct qtj_id) // 5 from own) / 1000))::bigint as required
              from sample_targets
            )
            select *, greatest(required - available, 0) as unmet, true as drawn_as_expected from facts""",
        "p3_found": rf"""
            with own as (
              select distinct qtj_id, {_category('supposed_query_type')} as k1, {_category('supposed_query_format')} as k2
              from queries_to_judge where regexp_matches(query, '\S')
            ),
            size as (select count(distinct qtj_id) // 5 as n from own)
            select query_type, query_format from sample_targets, size
            where (select count(distinct qtj_id) from own where k1 = {_category('query_type')} and k2 = {_category('query_format')})
              < greatest(min_rows, ceil(target_permille * n / 1000))""",
        "p6_found": f"""
            with {_WORDS},
            common as (
              select a.query_id as p, b.query_id as q, sum(least(a.n, b.n)) as common
              from counts a join counts b on a.word = b.word and a.query_id < b.query_id group by all
            )
            select p as query_id_a, q as query_id_b
            from common join sizes x on x.query_id = p join sizes y on y.query_id = q
            where common >= 0.8 * (x.size + y.size - common)""",
        "p6_links": f"""
            with {_WORDS},
            bags as (select query_id, string_agg(word, ' ' order by word) as bag from words group by query_id),
            heads as (select min(query_id) as query_id from bags group by bag),
            own as materialized (select * from counts semi join heads using (query_id)),
            pairs as (
              select a.query_id as a, b.query_id as b, sum(least(a.n, b.n))::bigint as common
              from own a join own b on a.word = b.word and a.query_id < b.query_id group by all
            )
            select a, b, common, (x.size + y.size - common)::bigint as total
            from pairs join sizes x on x.query_id = a join sizes y on y.query_id = b
            where common >= 0.8 * (x.size + y.size - common)""",
        "p8_found": rf"""
            with texts as (
              select 'd' as side, doc_id as id, replace(text, '<!-- page break -->', ' ') as body from documents where text is not null
              union all select 'i', item_id, item_text from eval_items where item_text is not null
            ),
            lists as (select side, id, regexp_extract_all(replace(strip_accents(lower(body)), 'ß', 'ss'), '[\p{{L}}\p{{N}}]+') as w from texts),
            own as materialized (select side, id, len(w) as size, unnest(w) as word, unnest(range(0, len(w))) as at from lists),
            items as (select * from own where side = 'i'),
            -- words in common on one diagonal of a document and an item
            hits as materialized (
              select d.id as doc_id, i.id as item_id, d.at - i.at as diagonal, i.at as at, i.size as m, d.size as n,
                     row_number() over (partition by d.id, i.id, d.at - i.at order by i.at) as k, count(*) over (partition by d.id, i.id, d.at - i.at) as hits
              from own d join items i on d.side = 'd' and d.word = i.word
            ),
            dense as materialized (select *, (m + 1) // 2 as need from hits where hits >= (m + 1) // 2 - ((m + 1) // 2) // 10),
            runs as (
              select a.doc_id, a.item_id, b.at - a.at + 1 as size, b.at - a.at - (b.k - a.k) as errors, a.need,
                     least(a.at, a.at + a.diagonal) + least(a.m - 1 - b.at, a.n - 1 - b.at - a.diagonal) as room
              from dense a join dense b on a.doc_id = b.doc_id and a.item_id = b.item_id and a.diagonal = b.diagonal and a.at <= b.at
            )
            select distinct doc_id, item_id from runs
            where greatest(0, need - size) <= room and (errors + greatest(0, need - size)) * 10 <= greatest(size, need)""",
        "p6_classes": f"""
            with {_WORDS},
            bags as (select query_id, string_agg(word, ' ' order by word) as bag from words group by query_id)
            select query_id, min(query_id) over (partition by bag) as class_id from bags""",
    }
