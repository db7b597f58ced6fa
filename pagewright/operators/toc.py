"""Tables of contents: scores of pages, the page manifest, summaries of documents, exclusions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.functions.text import normalize_line

# What lines of a table of contents look like.
TITLE = r"(?iuU)\b(?:table\s+of\s+contents|contents|sommaire|table\s+des\s+mati[eè]res|toc)\b"
TITLE_PARTS = ("content", "sommaire", "table", "toc", "ſ")  # in lower case each title has one
DOTTED = r"^.{4,}(?:\.{2,}|…+)\s*\d{1,4}$"
TRAILING = r"^.{4,}\s+\d{1,4}$"
LETTER = r"[\p{L}\p{Nl}\p{No}]"
NUMBERED = r"^(?:\d+(?:\.\d+)*\.?|[A-Za-z]\.|\([A-Za-z]\))\s+.+$"
NUMERIC = r"^[\d\s.\-_/]+$"

EXCLUSION_FIELDS = ("exclude_from_visual_summaries", "exclude_from_image_rendering")


def eligible(line: Column) -> Column:
    """Of five characters or more, and not of digits and their separators only."""
    return (F.length(line) >= 5) & ~line.rlike(NUMERIC)


def trailing_number(line: Column) -> Column:
    return line.rlike(TRAILING) & line.rlike(LETTER)


def toc_like(line: Column) -> Column:
    """An eligible line that ends with a page number, after leaders or a space."""
    return eligible(line) & (line.rlike(DOTTED) | trailing_number(line))


def _marks(lines: Column) -> Column:
    """What each line shows: a title, and as an eligible line leaders, a page number at its end, a
    section number with one, or any of the first two.

    Expressions within a lambda aren't shared, so each step binds what the next ones use: every
    line meets every pattern once, and lines without a digit at their end only two of them.
    """
    folded = F.transform(lines, lambda x: F.struct(x.alias("line"), F.lower(x).alias("low")))
    may = lambda m: sum((F.instr(m["low"], part) for part in TITLE_PARTS[1:]), F.instr(m["low"], TITLE_PARTS[0])) > 0
    first = F.transform(folded, lambda m: F.struct(m["line"].alias("line"), (may(m) & m["line"].rlike(TITLE)).alias("title"), eligible(m["line"]).alias("fit")))
    second = F.transform(first, lambda m: m.withField("ended", m["fit"] & m["line"].rlike(r"\d$")))  # all that is sought in entries ends with a number
    third = F.transform(second, lambda m: m.withField("tail", m["ended"] & trailing_number(m["line"])).withField("dotted", m["ended"] & m["line"].rlike(DOTTED)))
    return F.transform(third, lambda m: m.withField("numbered", m["tail"] & m["line"].rlike(NUMBERED)).withField("like", m["dotted"] | m["tail"]))


def clean_lines(lines: Column) -> Column:
    """Normalised lines without blank ones."""
    return F.filter(F.transform(lines, normalize_line), lambda x: x != "")


def _steps(value: Column, *steps: tuple[int, int, str]) -> tuple[Column, Column]:
    points, reason = F.lit(0), F.lit(None).cast("string")
    for least, gain, text in reversed(steps):
        points = F.when(value >= least, gain).otherwise(points)
        reason = F.when(value >= least, text).otherwise(reason)
    return points, reason


def score_pages(pages: DataFrame, lines: str = "lines", page_index: str = "page_index", total_pages: str = "total_pages") -> DataFrame:
    """pages with ``lines`` cleaned and thirteen columns on how much each page looks like a
    table of contents.

    page_index counts from 0.  A null array of lines counts as an empty one.  Everything is
    computed from a page's own array, without exploding it and without a shuffle.
    """
    own = pages.withColumn(lines, clean_lines(F.coalesce(F.col(lines), F.array().cast("array<string>"))))
    own = own.withColumn("_marks", _marks(F.col(lines)))
    count = lambda test: F.size(F.filter("_marks", test))
    samples = F.slice(F.filter("_marks", lambda m: m["title"] | m["like"]), 1, 5)
    own = own.select(
        "*",
        F.exists(F.slice("_marks", 1, 15), lambda m: m["title"]).alias("toc_has_title"),
        (F.col(page_index) < F.least(F.lit(25), F.greatest(F.lit(8), F.floor(F.col(total_pages) * 0.25)))).alias("toc_is_early_page"),
        count(lambda m: m["fit"]).alias("toc_eligible_line_count"),
        count(lambda m: m["like"]).alias("toc_like_line_count"),
        count(lambda m: m["dotted"]).alias("toc_dotted_count"),
        count(lambda m: m["tail"]).alias("toc_trailing_page_number_count"),
        count(lambda m: m["numbered"]).alias("toc_section_number_count"),
        F.transform(samples, lambda m: m["line"]).alias("toc_sample_lines"),
    )
    likes, fits = F.col("toc_like_line_count"), F.col("toc_eligible_line_count")
    ratio = F.when(fits > 0, likes / fits).otherwise(F.lit(0.0))
    titled, early = F.col("toc_has_title"), F.col("toc_is_early_page")
    parts = [
        (F.when(titled, 4).otherwise(0), F.when(titled, "toc_title:+4")),
        _steps(F.col("toc_dotted_count"), (5, 3, "dotted_leaders>=5:+3"), (2, 2, "dotted_leaders>=2:+2"), (1, 1, "dotted_leaders==1:+1")),
        _steps(F.col("toc_trailing_page_number_count"), (8, 3, "trailing_page_numbers>=8:+3"), (4, 2, "trailing_page_numbers>=4:+2"), (2, 1, "trailing_page_numbers>=2:+1")),
        _steps(F.col("toc_section_number_count"), (5, 2, "section_numbered_lines>=5:+2"), (2, 1, "section_numbered_lines>=2:+1")),
        (F.when((fits >= 8) & (ratio >= 0.5), 2).when((fits >= 8) & (ratio >= 0.35), 1).otherwise(0), F.when((fits >= 8) & (ratio >= 0.5), "toc_like_ratio>=0.50:+2").when((fits >= 8) & (ratio >= 0.35), "toc_like_ratio>=0.35:+1")),
        (F.when(early, 1).when(~titled, -2).otherwise(0), F.when(early, "early_page:+1").when(~titled, "late_without_title:-2")),
    ]
    score = sum((p for p, _ in parts[1:]), parts[0][0])
    own = own.select("*", F.bround(ratio, 4).alias("toc_like_ratio"), score.cast("int").alias("toc_score"), F.filter(F.array(*[r for _, r in parts]), lambda x: x.isNotNull()).alias("toc_reasons"))
    is_toc = (F.col("toc_score") >= 6) | (titled & (likes >= 2)) | (early & (likes >= 8) & (ratio >= 0.45))
    own = own.withColumn("is_toc_page", is_toc)
    review = F.col("is_toc_page") & ((F.col("toc_score") <= 6) | ~titled | ~early | (likes < 5))
    return own.withColumn("toc_needs_manual_review", review).drop("_marks")


def page_manifest(pages: DataFrame) -> DataFrame:
    """A row per page from ``filename, page_index, lines`` and, where given, parse_status.

    The number of a document's pages comes from a window over its rows.  A page that could
    not be read has no lines and keeps its status.
    """
    own = pages if "parse_status" in pages.columns else pages.withColumn("parse_status", F.lit("ok"))
    if "total_pages" not in own.columns:
        own = own.withColumn("total_pages", F.count(F.lit(1)).over(W.partitionBy("filename")))
    scored = score_pages(own)
    return scored.select(
        "filename",
        F.concat("filename", F.lit(".pdf")).alias("pdf_filename"),
        F.concat(F.lit("pdfs/"), "filename", F.lit(".pdf")).alias("pdf_path"),
        "page_index",
        (F.col("page_index") + 1).alias("page_number"),
        F.col("page_index").alias("image_page_number"),
        "is_toc_page",
        F.col("is_toc_page").alias("exclude_from_visual_summaries"),
        F.col("is_toc_page").alias("exclude_from_image_rendering"),
        F.when(F.col("is_toc_page"), "toc_page").otherwise("").alias("exclusion_reason"),
        F.substring(F.array_join("lines", "\n"), 1, 500).alias("text_preview"),
        "parse_status",
        *[c for c in scored.columns if c.startswith("toc_")],
    )


def document_summary(manifest: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """A row per document: its pages, its tables of contents and those to review.

    documents (filename and, where known, error) adds those without any page.
    """
    flagged = lambda test: F.sort_array(F.collect_list(F.when(test, F.col("page_number"))))
    own = manifest.groupBy("filename").agg(F.count(F.lit(1)).alias("total_pages"), flagged(F.col("is_toc_page")).alias("toc_pages"), flagged(F.col("toc_needs_manual_review")).alias("toc_manual_review_pages"))
    error = F.lit("")
    if documents is not None:
        listed = documents if "error" in documents.columns else documents.withColumn("error", F.lit(None).cast("string"))
        own = own.join(listed.select("filename", F.col("error").alias("_error")).dropDuplicates(["filename"]), "filename", "full_outer")
        error = F.coalesce("_error", F.lit(""))
    empty = F.array().cast("array<int>")
    return own.select(
        "filename",
        F.coalesce("total_pages", F.lit(0)).alias("total_pages"),
        (F.size(F.coalesce("toc_pages", empty)) > 0).alias("toc_detected"),
        F.coalesce("toc_pages", empty).alias("toc_pages"),
        F.size(F.coalesce("toc_pages", empty)).alias("toc_page_count"),
        F.coalesce("toc_manual_review_pages", empty).alias("toc_manual_review_pages"),
        F.size(F.coalesce("toc_manual_review_pages", empty)).alias("toc_manual_review_page_count"),
        F.when(error == "", "ok").otherwise("error").alias("status"),
        error.alias("error"),
    )


def excluded_pages(manifest: DataFrame, field: str = EXCLUSION_FIELDS[0]) -> DataFrame:
    """filename and the sorted image pages that field excludes; a null flag excludes nothing."""
    if field not in EXCLUSION_FIELDS:
        raise ValueError(f"unknown exclusion field: {field}")
    chosen = manifest.where(F.coalesce(field, F.lit(False)))
    return chosen.groupBy("filename").agg(F.sort_array(F.collect_set("image_page_number")).alias("pages"))


def pages_kept(pages: DataFrame, manifest: DataFrame, field: str = EXCLUSION_FIELDS[0], page: str = "page_index") -> DataFrame:
    """The pages that field doesn't exclude, by an anti join on document and page."""
    if field not in EXCLUSION_FIELDS:
        raise ValueError(f"unknown exclusion field: {field}")
    gone = manifest.where(F.coalesce(field, F.lit(False))).select("filename", F.col("image_page_number").alias(page))
    return pages.join(gone, ["filename", page], "left_anti")
