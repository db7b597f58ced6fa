from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.functions.fuzzy import indel_ratio, partial_ratio
from pagewright.functions.text import PAGE_BREAK
from pagewright.operators import headings, sections


def test_partial_ratio():
    assert partial_ratio("abc", "xxabcxx") == 100
    assert partial_ratio("", "") == 100 and partial_ratio("", "a") == 0
    assert partial_ratio("safety rules", "the safety rule book") > 90
    assert partial_ratio("abc", "xyz") == 0


@given(st.text("abc ", max_size=8), st.text("abc ", max_size=8))
@settings(max_examples=150, deadline=None)
def test_indel_ratio_is_that_of_the_table(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert indel_ratio(a, b) == (200.0 * table[-1][-1] / (len(a) + len(b)) if a or b else 100.0)


def test_listed_number(spark):
    lines = {
        "| Pumps | 12 |": 12, "| Pumps | none |": None, "| a1 | ٣ | 7-9 |": 7, "3 Pumps": 3, "Pumps 7": 7, "- 4. Pumps": 4, "Pumps .... 7!": None, "Pumps (see 7": None, "* 5 Pumps": 5, "no number": None, "": None,
        "99999999999 x": None, "-8": 8, "1,5 and 6": 1,
    }
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    assert {r["line"]: r["n"] for r in frame.select("line", sections.listed_number(frame["line"]).alias("n")).collect()} == lines


def test_entries_reset_by_a_page_that_lists_earlier_pages(spark):
    def entries(*pages):
        frame = spark.createDataFrame([(list(pages),)], "p array<struct<page_index: int, page: string>>")
        return [tuple(e) for e in frame.select(sections.toc_entries(frame["p"]).alias("e")).first()["e"]]

    assert entries((20, "3 Pumps\n5 Pipes")) == [] and entries() == []
    assert entries((1, "5  Pipes\nno\n3 Pumps\n3 Taps")) == [("3 Pumps", 3), ("3 Taps", 3), ("5 Pipes", 5)]
    assert entries((1, "| Pipes | 5 |"), (20, "3 Pumps"), (21, "12 Ends")) == [("12 Ends", 12)]


def test_matches_and_the_quirk_of_their_place():
    headings = [("# One", 3), ("# Two", 5), ("# Three", 6), ("# One", 9)]
    assert sections.match_headings([("One", 1), ("Two", 2), ("Two", 3), ("One", 4)], headings) == [2, 3, 5]
    entries = [("Three", 1), ("One", 1), ("One", 1)]
    assert sections.match_headings(entries, headings) == [5, 8]
    assert sections.match_headings([("Two", 1), ("Three", 1), ("Two", 1)], headings, compat=True) == [4, 5, 4]


def test_unique_titles_per_page():
    kept = sections.unique_titles([("Safety rules", 3), ("Safety  rule", 3), ("Safety rules", 4)])
    assert kept == [("Safety rules", 3), ("Safety rules", 4)]


@given(st.lists(st.tuples(st.booleans(), st.text("ab\n", max_size=6)), min_size=1, max_size=23), st.lists(st.integers(1, 30), max_size=4))
@settings(max_examples=120, deadline=None)
def test_sections_lose_nothing(pages, listed):
    own = [sections.Page(f"x{k}", f"\n# H{k}\n{t}") if h else sections.Page("", f"x{k} {t}") for k, (h, t) in enumerate(pages)]
    pieces = sections.pack_sections(own, sorted(listed), 1)
    covered = [p for piece in pieces for p in piece.pages]
    assert set(covered) == set(range(len(pages)))
    joined = "".join(p.text for p in pieces)
    for k in range(len(pages)):
        assert f"x{k}" in joined and (not pages[k][0] or f"# H{k}\n" in joined)


def test_division_and_its_quirk():
    pages = [sections.Page("", "a")] * 4 + [sections.Page("b", "\n## H\nc")]
    assert sections.divide(pages, 0)[0].text.endswith("c")
    assert not sections.divide(pages, 0, compat=True)[0].text.endswith("c")
    assert [p.pages for p in sections.divide([sections.Page("", "a")] * 12, 3)] == [[3, 4, 5, 6, 7], [8, 9, 10, 11, 12], [13, 14]]


def test_offset_is_the_first_seen_mode():
    assert sections.page_offset([2, 1, 1, 2]) == 2 and sections.page_offset([]) == 0


def test_outline_and_split(spark):
    text = f'# A\ntext\n<!--<annotation kind="description">-->\n# hidden\n<!--<annotation/>-->\n{PAGE_BREAK}\n### B\n###### six'
    documents = spark.createDataFrame([("d", text), ("e", ""), ("f", None)], "id string, content string")
    rows = [tuple(r) for r in headings.heading_outline(documents).orderBy("pos").collect()]
    assert rows == [("d", 0, 1, "# A", 1), ("d", 6, 3, "### B", 2)]
    pages = spark.createDataFrame([("x\n# A\ny",), ("# A\nx",), ("x",), ("x\n## B\n# A",)], "page string")
    got = [(r["s"]["head"], r["s"]["tail"]) for r in pages.select(headings.split_at_heading(pages["page"]).alias("s")).collect()]
    assert got == [("x", "\n# A\ny"), ("", "# A\nx"), ("", "x"), ("x\n## B", "\n# A")]


def test_documents_to_sections(spark):
    documents = spark.createDataFrame([("d", PAGE_BREAK.join("p" * 3 for _ in range(12))), ("n", None)], "id string, content string")
    rows = sections.section_documents(documents).orderBy("ord").collect()
    assert [r["page_numbers"] for r in rows] == [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9], [10, 11]]
    listing = "Table of contents\n" + "\n".join(f"Part {'abcdefghi'[k]} of it {k * 3 + 1}" for k in range(9))
    body = [f"# Part {'abcdefghi'[k // 3]} of it\ntext {k}" if k % 3 == 0 else f"text {k}" for k in range(27)]
    listed = spark.createDataFrame([("l", f"\n{PAGE_BREAK}\n".join([listing, *body])), ("d", "plain")], "id string, content string")
    assert {r["id"]: r["offset"] for r in sections.document_offsets(listed).collect()} == {"l": 1}
    rows = sections.section_documents(listed).where("id = 'l'").orderBy("ord").collect()
    assert [r["page_numbers"] for r in rows] == [list(range(0, 7)), list(range(7, 13)), list(range(13, 19)), list(range(19, 25)), [25, 26, 27]]
