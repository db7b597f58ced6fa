"""Headings of Markdown documents, candidates for tables of contents, the cut at a heading."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.functions.text import ACCENTED, PAGE_BREAK, PLAIN, split_pages, to_ascii

ANNOTATION = '<!--<annotation kind="description">-->'
ANNOTATION_END = "<!--<annotation/>-->"

#: Words that a page with a table of contents holds.
MARKERS = ("table of contents", "| page |", "index", "page no.", "table des matieres")


def heading_outline(documents: DataFrame, key: str = "id", content: str = "content") -> DataFrame:
    """key, pos, level, title, page of the headings outside image annotations, in order.

    Only lines that may matter pass through the window: headings, page breaks and annotation
    marks.  Appending each heading below the last branch and reading the tree in pre-order
    gives the order of lines, so no tree is built.
    """
    marks = F.expr(f"""filter(transform(split({content}, '\\n', -1), (x, i) -> struct(i as pos, x as line)),
        p -> p.line rlike '^#{{1,5}} ' or instr(p.line, '{PAGE_BREAK}') > 0 or instr(p.line, '<!--<annotation') > 0)""")
    lines = documents.select(key, F.explode(marks).alias("mark")).select(key, "mark.pos", "mark.line")
    run = W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    opened = F.when(F.col("line").startswith(ANNOTATION), True).when(F.instr("line", ANNOTATION_END) > 0, False)
    own = lines.select(
        key, "pos", "line",
        (1 + F.sum((F.instr("line", PAGE_BREAK) > 0).cast("int")).over(run)).alias("page"),
        F.coalesce(F.last(opened, ignorenulls=True).over(run), F.lit(False)).alias("hidden"),
    )
    level = F.length(F.regexp_extract("line", "^(#{1,5}) ", 1))
    return own.where("not hidden and line rlike '^#{1,5} '").select(key, "pos", level.alias("level"), F.col("line").alias("title"), "page")


def _candidate_line(line: Column) -> Column:
    text = F.trim(F.regexp_replace(F.trim(line), r"[^a-z0-9]\s+", " "))
    return text.rlike(r"\d") & text.rlike(r"[a-z]") & (F.length(F.trim(line)) < 150)


def _numbers(line: Column) -> Column:
    return F.regexp_count(F.trim(F.regexp_replace(F.trim(line), r"[^a-z0-9]\s+", " ")), F.lit(r"\d+"))


def _with_accents(marker: str) -> str:
    """A pattern of the marker, any letter with any accent and white space of any kind."""
    letters = {c: "".join(sorted({a for a, b in zip(ACCENTED, PLAIN) if b.lower() == c})) for c in set(marker)}
    return "".join(f"[{c}{letters[c]}]" if letters[c] else r"\s+" if c == " " else re.escape(c) for c in marker)


#: Matches every text with a marker, and little else; texts without it need no second look.
_MAY_HOLD = "(?iuU)" + "|".join(map(_with_accents, MARKERS))


def _is_candidate(page: Column) -> Column:
    folded = to_ascii(F.regexp_replace(F.lower(page), r"(?U)\s+", " "))
    entries = F.filter(F.split(page, "\n", -1), _candidate_line)
    many = F.size(F.filter(entries, lambda x: _numbers(x) >= 4))
    return page.rlike(_MAY_HOLD) & folded.rlike("|".join(map(re.escape, MARKERS))) & (many <= 5) & (F.size(entries) - many > 8)


def candidate_pages(content: Column) -> Column:
    """page_index, page of the pages that hold a marker, more than eight lines with few numbers
    and letters, and at most five lines with many numbers."""
    placed = F.transform(split_pages(content), lambda page, k: F.struct(k.alias("page_index"), page.alias("page")))
    none = F.array().cast("array<struct<page_index: int, page: string>>")
    return F.when(content.rlike(_MAY_HOLD), F.filter(placed, lambda p: _is_candidate(p["page"]))).otherwise(none)


def toc_candidate_pages(documents: DataFrame, key: str = "id", content: str = "content") -> DataFrame:
    """key, page_index, page of candidate_pages()."""
    return documents.select(key, F.explode(candidate_pages(F.col(content))).alias("p")).select(key, "p.page_index", "p.page")


def split_at_heading(page: Column) -> Column:
    """(head, tail) of a page cut before its first heading of the highest level it has.

    A page that begins with a heading of a level isn't cut there or at a lower level.
    """
    cut = F.lit(0)
    for marks in reversed(("# ", "## ", "### ", "#### ", "##### ")):
        at = F.instr(page, "\n" + marks)
        cut = F.when(page.rlike(rf"^\s*{marks}"), 0).when(at > 0, at).otherwise(cut)
    head = F.when(cut > 0, F.substring(page, F.lit(1), cut - 1)).otherwise("")
    tail = F.when(cut > 0, F.substring(page, cut, F.length(page))).otherwise(page)
    return F.struct(head.alias("head"), tail.alias("tail"))
