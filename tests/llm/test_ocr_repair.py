from __future__ import annotations

import pytest

from pagewright.llm import ocr_repair
from pagewright.llm.ocr_repair import Lexicon, misread_words, page_noise, repaired_pages, skeletons

BREAK = "\n<!-- page break -->\n"
FILLER = "the supplier agreement improved the maintenance schedule during the spring of every year and the "


def test_skeletons_agree_for_misreadings():
    for right, wrong in (("supplier", "supp1ier"), ("schedule", "scliedule"), ("time", "tirne"), ("budget", "budgct"), ("spring", "sprmg"), ("prix", "pnx"), ("recycling", "recyding"), ("grid", "gnd"), ("below", "6elow"), ("das", "da5")):
        assert skeletons(right) & skeletons(wrong), (right, wrong)


def test_misread_words():
    lexicon = Lexicon({"supplier": 900, "schedule": 500, "time": 700}, set())
    found = misread_words(["The supp1ier had tirne. Krostazofo met Krostaz0fo. BQ42172880 in 1995 and Krostazofo again!"], lexicon)
    assert dict(found[0]) == {"supp1ier": "supplier", "tirne": "time", "Krostaz0fo": "Krostazofo"}


def test_neighbours_choose_the_form(spark):
    texts = ["The modern house stands by the field corn store. " * 60, "A cable modem works with every router. " * 30, "We eat eine kleine suppe today. " * 40]
    frame = spark.createDataFrame([(x,) for x in texts], "content string")
    lexicon = ocr_repair.build_lexicon(frame)
    repairs = lambda text: dict(misread_words([text], lexicon)[0])
    assert repairs("The modem house stands by the field com store.") == {"modem": "modern", "com": "corn"}
    assert repairs("A cable modem works with every router.") == {}
    assert repairs("The cme house stands") == {} and repairs("We eat cine kleine suppe") == {"cine": "eine"}
    # of several forms the supported one, not the most frequent
    several = Lexicon({"modern": 900, "modem": 500, "cable": 90, "works": 90}, set())
    several.pairs, several.times = ocr_repair.np.array(sorted([several.code("cable", "modem"), several.code("modem", "works")])), ocr_repair.np.array([30, 30])
    assert dict(misread_words(["cable mod3m m0dem works"], several)[0])["m0dem"] == "modem"
    text = "The modem house, a cable modem works"
    assert ocr_repair.mended(text, ocr_repair.misreadings([text], lexicon)[0], {}) == "The modern house, a cable modem works"


@pytest.fixture(scope="module")
def documents(spark):
    digital = "# Report\n\n" + FILLER * 3 + "\n\nThe numbers:\n518\n330\n\n- The low-cost item\n"
    page = lambda n, head, foot, body: f"{head}\n{body}\n{foot}"
    body1 = "The supplier agreement improved the main-\ntenance schedule during the spring and the low-\ncost item was repaired by the harbour office and the sche-"
    body2 = "dule was kept. The supp1ier agreement improved the\n887\nmaintenance schedule during the spring of the year\nand nothing else happened."
    body3 = "The supplier agreement improved the maintenance\nschedule during the spring of the year and\nnothing else happened."
    scanned = BREAK.join([page(0, "Water Report Kiska", "- 5 -", body1), page(1, "WATER REPORT KISKA", "- 6 -", body2), page(2, "WATER REP0RT KISKA", "- 7 -", body3)])
    rows = [("d", digital, "digital", 1), ("s", scanned, "kiska_water_report", 1), ("s", scanned, "kiska_water_report", 2), ("n", None, None, 1), ("e", "", "x", 1), ("b", " \n ", "x", 1)]
    rows += [(f"f{k}", FILLER * 20 + " low-cost item" * 3, f"f{k}", 1) for k in range(3)]
    return spark.createDataFrame(rows, "id string, content string, filename string, line string")


def test_pages_of_a_scanned_document(documents):
    rows = {r["page_index"]: r for r in repaired_pages(documents).collect()}
    assert set(rows) == {0, 1, 2} and {r["document_id"] for r in rows.values()} == {"s"}
    assert [rows[k]["hyphenation"] for k in range(3)] == [2, 0, 0]
    assert [rows[k]["running_header"] for k in range(3)] == [0, 1, 1]
    assert [rows[k]["page_number"] for k in range(3)] == [1, 1, 1]
    assert [rows[k]["misread"] > 0 for k in range(3)] == [False, True, True]
    assert "improved the maintenance schedule during the spring and the low-cost item was repaired" in rows[0]["text"]
    assert rows[0]["text"].endswith("the schedule") and rows[1]["text"].startswith("was kept. The supplier agreement improved the maintenance schedule")
    assert "KISKA" not in rows[1]["text"] and "887" not in rows[1]["text"]


def test_noise_rows(documents):
    got = sorted((r["page_index"], r["noise"]) for r in page_noise(documents).collect())
    assert got == [(0, "hyphenation"), (0, "page_number"), (1, "misread"), (1, "page_number"), (1, "running_header"), (2, "misread"), (2, "page_number"), (2, "running_header")]
    assert page_noise(documents.where("false")).count() == 0
    assert page_noise(documents.where("id = 'd'")).count() == 0


def furniture(spark, text):
    """The kinds of furniture of each page of a document."""
    pages = ocr_repair.scanned_pages(spark.createDataFrame([("s", text, "s")], "document_id string, content string, name string"))
    return {r["page_index"]: " ".join(sorted(f["kind"] for f in r["furniture"])) for r in ocr_repair.page_furniture(pages).collect() if r["furniture"]}


def test_page_numbers_must_keep_their_distance(spark):
    body = "The supplier agreement improved the maintenance\nschedule during the spring of the year and\nnothing else happened."
    text = BREAK.join(f"The {name} office kept all of the records for the year\n{body}\n{foot}" for name, foot in (("one", "[3]"), ("two", "[4]"), ("three", "777"), ("four", "[6]")))
    kinds = furniture(spark, text)
    assert kinds == {0: "number", 1: "number", 3: "number"}


def test_headers_with_a_changing_number(spark):
    body = "The supplier agreement improved the maintenance\nschedule during the spring of the year and\nnothing else happened."
    text = BREAK.join(f"{head}\n{body}" for head in ("Opening words of it", "Sheet 10 Water Study", "Sheet 1l Water Study", "Sheet 15 Water Study", "Rivers in the north"))
    assert {k for k, kind in furniture(spark, text).items() if kind == "header"} == {1, 2, 3}


def wrapped(words, width):
    """Text wrapped greedily at width, with words of changing length."""
    lines, line = [], ""
    for k in range(words):
        word = "abcdefghij"[: 3 + k * k % 7]
        if line and len(line) + 1 + len(word) > width:
            lines.append(line)
            line = ""
        line = f"{line} {word}".strip()
    return "\n".join([*lines, line + "."])


def test_wide_pages_and_single_listed_lines(spark):
    for width in (40, 140, 400):
        body = wrapped(400, width)
        assert furniture(spark, BREAK.join(f"{body}\n{n}" for n in (7, 8, 9))) == {0: "number", 1: "number", 2: "number"}, width
    listed = body.replace("\n", "\n15. ", 1)
    assert furniture(spark, BREAK.join(f"{listed}\n{n}" for n in (7, 8))) == {0: "number", 1: "number"}
    assert furniture(spark, BREAK.join(f"# Title\n\n{body}\n{n}" for n in (7, 8))) == {}
    assert furniture(spark, BREAK.join("- item one\n- item two\n- item six\n" + str(n) for n in (7, 8))) == {}


def test_romans_long_numbers_and_several_numberings(spark):
    body = wrapped(120, 60)
    feet = ["cdx", "cdxi", "cdxii", "1", "2", "3", "12345", "12346", "12347"]
    assert furniture(spark, BREAK.join(f"{body}\n{foot}" for foot in feet)) == {k: "number" for k in range(9)}
    assert furniture(spark, BREAK.join(f"{body}\n{foot}" for foot in ("iiv", "1999", "ccm"))) == {}


def test_headers_of_three_lines(spark):
    body = wrapped(120, 60)
    text = BREAK.join([f"Study\n\n{body}"] + [f"Harbour Office\nWater Board\nAnnual Review\n{n}\n\n{body}" for n in (12, 13, 14)])
    assert furniture(spark, text) == {k: "header header header number" for k in (1, 2, 3)}
