"""Problem 4: noise in the text of scanned pages.

Pages are cut into lines.  Running headers are found by comparing lines at the edges of pages,
with digits and numerals masked, with the document's titles and with each other; page numbers
are lines (or ends of header lines) whose value keeps its distance to the page's place.  The
rest is reflowed with SQL windows over a document's lines: words cut at line or page ends are
joined, lines become paragraphs.  Misread words are put right by their skeleton, in which
glyphs that are taken for each other look alike: a word gives way to the frequent word with the
same skeleton that its neighbours support, or to the name of the same document.  The neighbours
testify by how often all documents have the two words side by side.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.textkit import PAGE_BREAK, fold, one_per_key
from pagewright.session import reliable_checkpoint

#: Share of all words from which on a word counts as frequent: at most 1 / FREQUENT words are broadcast.
FREQUENT = 2e-5
#: Share of all words from which on a pair of frequent words side by side supports a form: at
#: most 1 / SUPPORT pairs are broadcast.
SUPPORT = 1e-6

# Marks of a word cut at the end of a line; glyphs by what they are taken for.
HYPHENS = "-¬­‐"
SINGLE = {"!": "i", "@": "a", "0": "o", "1": "l", "5": "s", "6": "b", "8": "b", "9": "g", "$": "s", "|": "l", "c": "e"}
GROUPS = ((("rn", "in", "ni"), "m"), (("ri",), "n"), (("li",), "h"), (("cl",), "d"), (("vv",), "w"), (("tt", "ft"), "f"))

_SINGLES = str.maketrans(SINGLE)
_WIDE = re.compile(r"[^\W_]+(?:[!@$|][^\W_]+)*|[!@$|][^\W\d_]+")
_CODE = re.compile(r"[A-Z]{1,4}[0-9OIlSBo]{4,}|\d+(?:st|nd|rd|th|er|[a-zA-Z])?|[A-Z]?\d+")
_STRANGE = re.compile(r"[0-9!@$|]")


# --- skeletons ------------------------------------------------------------------------------


@lru_cache(maxsize=200_000)
def skeletons(word: str) -> frozenset[str]:
    """The skeletons of a folded word: glyphs replaced one for one, and then, each by itself,
    the groups of two that look like one."""
    base = word.translate(_SINGLES)
    plain = word.translate({k: v for k, v in _SINGLES.items() if k != ord("c")})
    result = {base}
    for pairs, single in GROUPS:
        own = plain
        for pair in pairs:
            own = own.replace(pair, single)
        result.add(f"{single}:{own.translate(_SINGLES)}")
    return frozenset(result)


class Lexicon:
    """Frequent words by skeleton, and how often frequent words stand side by side.

    pairs has sorted codes of two words (see code) and their counts; places also numbers the
    words that are frequent but doubtful, so that their own neighbours are known.
    """

    def __init__(self, words: dict[str, int], compounds: set[str], places: dict[str, int] | None = None):
        self.words, self.compounds = words, compounds
        self.places = {w: k for k, w in enumerate(words)} if places is None else places
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.spelled: dict[str, str] = {}
        self.forms: dict[str, list[str]] = {}
        self._others: dict[str, list[str]] = {}
        self._facts: dict[str, tuple[str, bool, bool, bool, bool]] = {}
        for word in sorted(words, key=lambda w: (-words[w], w)):
            for key in skeletons(word):
                self.forms.setdefault(key, []).append(word)

    def form_of(self, word: str) -> str | None:
        """The most frequent other word with a skeleton of this folded word."""
        return next(iter(self.forms_of(word)), None)

    def forms_of(self, word: str) -> list[str]:
        """All other words with a skeleton of this folded word, frequent ones first."""
        found = {form for key in skeletons(word) for form in self.forms.get(key, ()) if form != word}
        return sorted(found, key=lambda w: (-self.words[w], w))

    def rivals(self, word: str) -> list[str]:
        """forms_of a frequent word, kept."""
        if word not in self._others:
            self._others[word] = self.forms_of(word)
        return self._others[word]

    def facts(self, token: str) -> tuple[str, bool, bool, bool, bool]:
        """The folded token, whether it holds strange glyphs, is frequent, may be a misreading at
        all, and looks like a frequent word; kept for as many tokens as have room."""
        found = self._facts.get(token)
        if found is None:
            word, strange = fold(token), bool(_STRANGE.search(token))
            known = word in self.words
            open_ = not _CODE.fullmatch(token) and len(word) >= 3 - strange and len(word) > 1 and any(c.isalpha() for c in token)
            found = word, strange, known, open_, open_ and bool(self.rivals(word) if known else self.form_of(word))
            if len(self._facts) < 200_000:
                self._facts[token] = found
        return found

    def code(self, left: str | None, right: str | None) -> int | None:
        """The number of a pair of words; None where one of them isn't frequent."""
        a, b = self.places.get(left), self.places.get(right)
        return None if a is None or b is None else a << 32 | b

    def together(self, left: str | None, right: str | None) -> int:
        """How often two words stand side by side in all documents."""
        code = self.code(left, right)
        at = 0 if code is None else int(np.searchsorted(self.pairs, code))
        return int(self.times[at]) if code is not None and at < len(self.pairs) and self.pairs[at] == code else 0

    def supported(self, word: str, before: str | None, after: str | None, strange: bool) -> str | None:
        """The form that the neighbours support in the place of word.

        A frequent word gives way only where both neighbours stand ten times as often beside
        the form as beside the word.  Any other word takes the form with most support, if it
        has more than the word itself; the most frequent one where no neighbour is known, or,
        as a strange glyph is a misreading for sure, where none is supported.
        """
        if word in self.words:
            for form in self.rivals(word):
                sides = ((self.together(before, form), self.together(before, word)), (self.together(form, after), self.together(word, after)))
                if len(form) > 3 and all(n >= 10 * max(1, own) for n, own in sides):
                    return form
            return None
        forms = [f for f in self.forms_of(word) if strange or len(f) > 3]
        if not forms:
            return None
        support = {f: self.together(before, f) + self.together(f, after) for f in forms}
        best = max(forms, key=lambda f: (support[f], self.words[f]))
        if strange or (before not in self.places and after not in self.places):
            return best
        own = self.together(before, word) + self.together(word, after)
        return best if support[best] >= 2 and support[best] > own else None


def tokens(text: str) -> list[str]:
    """Words, with glyphs within them that are read for letters."""
    return _WIDE.findall(text)


def misread_words(texts: list[str], lexicon: Lexicon, known: str = "") -> list[list[tuple[str, str]]]:
    """For each text of one document the (word, its repair) of misread words."""
    return [[(token, form) for _, token, form in found] for found in misreadings(texts, lexicon, known)]


def misreadings(texts: list[str], lexicon: Lexicon, known: str = "") -> list[list[tuple[int, str, str]]]:
    """For each text of one document the (begin, word, repair) of misread words.

    A word is compared by skeleton with the frequent words, by its neighbours at each place,
    or else with the document's own words that stand in it more often (names).  Strange
    glyphs within a word are a misreading even if no repair is known; reference codes are none.
    """
    lists = [tokens(text) for text in texts]
    counts = Counter(itertools.chain.from_iterable(lists))
    counts.update(tokens(known))
    alike: dict[str, list[str]] = {}
    for token in counts:
        word, strange, frequent, *_ = lexicon.facts(token)
        if not strange and not frequent:
            for key in skeletons(word):
                alike.setdefault(key, []).append(token)
    compared: set[str] = set()
    verdict: dict[str, str] = {}
    for token, times in counts.items():
        word, strange, frequent, open_, resembles = lexicon.facts(token)
        if resembles:
            compared.add(token)
        if frequent or not open_:
            continue
        best = None
        for key in skeletons(word):
            for other in alike.get(key, ()):
                n = counts[other]
                if other != token and (strange or n > times) and (best is None or n > counts[best]) and lexicon.facts(other)[0] != word:
                    best = other
        if best or (strange and re.search(r"[^\W\d_].*[0-9!@$|]|[0-9!@$|].*[^\W\d_]", token) and sum(c.islower() for c in token) > 1):
            verdict[token] = best or word.translate(_SINGLES)
    suspects = compared | verdict.keys()
    result = []
    for text, listed in zip(texts, lists):
        if suspects.isdisjoint(listed):
            result.append([])
            continue
        places, found = _WIDE.finditer(text), []
        for k, (token, match) in enumerate(zip(listed, places)):
            if token not in suspects:
                continue
            form = None
            if token in compared:
                before = lexicon.facts(listed[k - 1])[0] if k else None
                after = lexicon.facts(listed[k + 1])[0] if k + 1 < len(listed) else None
                word, strange, *_ = lexicon.facts(token)
                form = lexicon.supported(word, before, after, strange)
            if form or token in verdict:
                found.append((match.start(), token, form or verdict[token]))
        result.append(found)
    return result


def mended(text: str, found: list[tuple[int, str, str]], spelled: dict[str, str]) -> str:
    """The text with its misread words repaired."""
    parts, at = [], 0
    for begin, token, form in found:
        parts += [text[at:begin], _dress(spelled.get(form, form), token)]
        at = begin + len(token)
    return "".join(parts) + text[at:]


def _dress(form: str, token: str) -> str:
    if token.isupper() and len(token) > 1:
        return form.upper()
    return form[:1].upper() + form[1:] if token[:1].isupper() else form


def build_lexicon(documents: DataFrame, text_col: str = "content") -> Lexicon:
    """Frequent words of all texts, cut words joined, in their own spelling (with accents).

    Words are added up in the tasks before they are shuffled; only words of at least the
    share FREQUENT of all reach the driver, so that their number has a bound.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                joined = _LINE_CUT.sub("", text)
                total.update(t.lower() for t in re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", joined))
                if len(total) > 200_000:
                    yield out()
        yield out()

    seen = documents.select(F.col(text_col).alias("_text")).where("_text is not null").mapInArrow(run, "word string, n bigint")
    counted = reliable_checkpoint(seen.groupBy("word").agg(F.sum("n").alias("n")))  # read twice
    total = counted.agg(F.sum("n")).first()[0] or 0
    least = max(5, int(FREQUENT * total))
    rows = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(int(1 / FREQUENT)).collect()
    words, spelled = {}, {}
    for word, n in rows:
        if "-" not in word and fold(word) not in words:  # the most frequent spelling comes first
            words[fold(word)] = n
            spelled[fold(word)] = word
    # of two frequent words with one skeleton, one that is far rarer is a frequent misreading
    doubtful = set()
    probe = Lexicon(words, set())
    for word, n in words.items():
        form = probe.form_of(word)
        if form and len(word) > 3 and words[form] >= 25 * n:
            doubtful.add(word)
    lexicon = Lexicon({w: n for w, n in words.items() if w not in doubtful}, {w for w, _ in rows if "-" in w}, {w: k for k, w in enumerate(words)})
    lexicon.spelled = spelled
    lexicon.pairs, lexicon.times = _pairs(documents, lexicon, max(2, int(SUPPORT * total)), text_col)
    return lexicon


def _pairs(documents: DataFrame, lexicon: Lexicon, least: int, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes and counts of the pairs of frequent words that all texts have side by side
    least times or more."""
    shared = documents.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total: Counter[int] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["code", "n"])
            total.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                row = [own.places.get(fold(t), -1) for t in tokens(_LINE_CUT.sub("", text))]
                total.update(a << 32 | b for a, b in zip(row, row[1:]) if a >= 0 and b >= 0)
                if len(total) > 200_000:
                    yield out()
        yield out()

    counted = documents.select(F.col(text_col).alias("_text")).where("_text is not null").mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= least).orderBy("code").toPandas()
    return rows["code"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


_LINE_CUT = re.compile(rf"(?<=[^\W\d_])[{re.escape(HYPHENS)}][ \t]*\n[ \t]*(?=[^\W\d_])")


# --- lines ----------------------------------------------------------------------------------

# what no scan has at the begin of a line, and what prose may have there
_MARKUP = r"^\s*(?:#{1,6} |\||<!--|```|~~~)"
_LISTED = r"^\s*(?:>|[*+] |- (?!\S{1,8} -\s*$)|\d{1,3}[.)] )"
_HEADING = r"^\s*#{1,6} "
_ACCENTS = ("áàâãäåéèêëíìîïóòôõöúùûüçñýß", "aaaaaaeeeeiiiiooooouuuucnys")


def _skeleton_key(column: Column) -> Column:
    """A title's or header's letters, those that are taken for each other made equal."""
    key = F.translate(F.lower(column), _ACCENTS[0] + "!@01569|ijc", _ACCENTS[1] + "laolsbgllle")
    for pair, single in (("rn", "m"), ("ln", "m"), ("ll", "h"), ("rl", "n"), ("el", "d")):
        key = F.regexp_replace(key, pair, single)
    return F.regexp_replace(key, r"[^a-z]+", "")


def _header_key(column: Column) -> Column:
    """A header's key with each number, also one with letters read for digits, as one mark."""
    masked = F.regexp_replace(column, r"(?<![\p{L}\p{N}])(?=[lIoOSB!]*[0-9])[0-9lIoOSB!]+(?![\p{L}\p{N}])", "\u2116")
    return F.concat(_skeleton_key(masked), F.regexp_replace(masked, "[^\u2116]+", ""))


def scanned_pages(documents: DataFrame) -> DataFrame:
    """The scanned pages of document_id, name, content: with page_index, lines, edges (lines near
    the top or bottom), titles (keys of the document's headings) and title_line.

    A page is wrapped prose when it has no markup, a third of its lines at most look listed, and
    at least half of its lines that another follows are as long as the page's width allows.
    Pages of the same document without markup that aren't wider are scanned, too.  The lines at
    an edge are the first two and those, called outer, before any line as wide as the text.
    """
    doc = W.partitionBy("document_id")
    pages = documents.select("document_id", "name", F.posexplode(F.split("content", re.escape(PAGE_BREAK), -1)).alias("page_index", "page"))
    pages = pages.select("document_id", "name", "page_index", F.split("page", r"\r\n|\n|\r", -1).alias("lines"))
    filled = F.filter(F.transform("lines", lambda x, n: F.struct(n.alias("line_no"), F.trim(x).alias("line"), F.rtrim(x).alias("raw"))), lambda x: x["line"] != "")
    pages = pages.withColumn("filled", filled)
    pages = pages.withColumn("width", F.coalesce(F.array_max(F.transform("filled", lambda x: F.length(x["raw"]))), F.lit(0)))
    pages = pages.withColumn("prose", ~F.exists("filled", lambda x: x["raw"].rlike(_MARKUP)) & (3 * F.size(F.filter("filled", lambda x: x["raw"].rlike(_LISTED))) <= F.size("filled")))
    pairs = F.filter(F.arrays_zip(F.slice("filled", 1, F.greatest(F.size("filled") - 1, F.lit(0))).alias("a"), F.slice("filled", 2, F.size("filled")).alias("b")), lambda z: z["a"]["line_no"] + 1 == z["b"]["line_no"])
    pages = pages.withColumn("pairs", F.when(F.col("prose"), pairs))
    pages = pages.withColumn("full", F.filter("pairs", lambda z: F.length(z["a"]["raw"]) + 1 + F.length(F.substring_index(z["b"]["line"], " ", 1)) > 0.85 * F.col("width")))
    broken = F.exists("full", lambda z: (F.size(F.split(z["a"]["line"], " +")) > 3) & ~z["a"]["line"].rlike("[.:!?]$"))
    wrapped = (F.size("full") > 0) & (2 * F.size("full") >= F.size("pairs")) & broken
    pages = pages.withColumn("widest", F.max(F.when(wrapped, F.col("width"))).over(doc)).drop("pairs", "full")
    pages = pages.withColumn("scanned", F.col("prose") & F.coalesce(F.col("width") <= 1.05 * F.col("widest"), F.lit(False)))
    narrow = lambda x: (F.length(x["line"]) <= 0.75 * F.col("width")) | (F.upper(x["line"]) == x["line"])  # noqa: E731  not as wide as the text, or in capitals
    marked = F.transform("filled", lambda x, i: F.struct(x["line_no"].alias("line_no"), x["line"].alias("line"), x["raw"].alias("raw"), narrow(x).alias("narrow"), (i + 1).alias("top"), (F.size("filled") - i).alias("bottom")))
    pages = pages.withColumn("filled", marked)
    wide = lambda array: F.array_position(F.transform(array, lambda x: ~x["narrow"]), True) - 1
    pages = pages.withColumn("head", wide(F.col("filled"))).withColumn("tail", wide(F.reverse("filled")))
    first = F.get("filled", F.lit(0))
    begins = (F.col("page_index") == 0) & first["narrow"] & ~first["line"].rlike(rf"[.,;:{re.escape(HYPHENS)}]$") & ~first["raw"].rlike(_HEADING)
    headings = F.filter("filled", lambda x: x["raw"].rlike(_HEADING) | (F.coalesce(begins, F.lit(False)) & (x["top"] == 1)))
    keys = F.transform(headings, lambda x: _skeleton_key(F.regexp_replace(x["line"], r"^#+ ", "")))
    keys = F.when(F.col("widest").isNotNull(), keys)  # of documents with scanned pages only
    pages = pages.withColumn("titles", F.array_distinct(F.flatten(F.collect_list(keys).over(doc)))).withColumn("title_line", F.when(begins, first["line_no"]))
    outer = F.transform("filled", lambda x: x.withField("outer", (x["top"] <= F.col("head")) | (x["bottom"] <= F.col("tail"))))
    edges = F.filter(outer, lambda x: x["outer"] | (x["top"] <= 2) | (x["bottom"] <= 2))
    return pages.where("scanned").select("document_id", "name", "page_index", "lines", edges.alias("edges"), "titles", "title_line")


_NUMBER = r"[0-9lIoOSB!]{1,8}|[ivxlcdmIVXLCDM]{1,15}"
_NAME = r"(?:p(?:age|ag|agina|ágina|g)?|seite|s|blatt|folha|hoja|foglio|feuillet)\.?"
_ALONE = rf"(?i)^[\s\[(<{{|*·•–—-]*(?:{_NAME})?[\s]*({_NUMBER})(?:\s*(?:/|of|de|di|von|sur|\|)\s*(?:{_NUMBER}))?[\s\])>}}|*·•–—.-]*$"
_BEFORE = rf"^\s*[\[(]?(?:(?i:{_NAME})\s*)?({_NUMBER})[\])]?\s*(?:\||–|—|·|\s{{2,}})\s*(\S.*)$"
_AFTER = rf"^\s*(\S.*?)\s*(?:\||–|—|·|\s{{2,}})\s*[\[(]?(?:(?i:{_NAME})\s*)?({_NUMBER})[\])]?\s*$"


_ROMAN = r"^(?i:(?=.)m*(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3}))$"
# Of roman numerals.
_ROMAN_VALUES = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def _roman_value(figure: Column) -> Column:
    """The value of a roman numeral: a mark before a larger one is taken away."""
    values = F.create_map(*[F.lit(x) for pair in _ROMAN_VALUES.items() for x in pair])
    marks = F.transform(F.split(F.lower(figure), ""), lambda c: values[c])
    state = F.struct(F.lit(0).alias("total"), F.lit(0).alias("last"))
    step = lambda acc, v: F.struct((acc["total"] + F.when(v < acc["last"], -v).otherwise(v)).alias("total"), v.alias("last"))
    return F.aggregate(F.reverse(marks), state, step)["total"]


def page_furniture(pages: DataFrame) -> DataFrame:
    """document_id, name, page_index, lines of scanned_pages(), with furniture: line_no, kind
    ('header', 'number' or 'both') and line of the lines that aren't part of the text.

    All windows are of one document or parts of it, so rows stay where their document is.
    """
    edge = pages.select("document_id", "name", "page_index", "lines", "titles", "title_line", F.posexplode_outer("edges").alias("place", "e"))
    edge = edge.select("document_id", F.when(F.col("place").isNull() | (F.col("place") == 0), F.struct("name", "lines")).alias("held"), "page_index", "titles", "title_line", "e.*")
    alone = F.regexp_extract("line", _ALONE, 1)
    parted = F.col("line").rlike(r"[|–—·]|\s{2}")  # what stands between a number and a header
    before, after = (F.when(parted, F.regexp_extract("line", *x)).otherwise("") for x in ((_BEFORE, 1), (_AFTER, 2)))
    edge = edge.withColumn("alone", alone).withColumn("before", before).withColumn("after", after)
    edge = edge.withColumn("figure", F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("alone", "before", "after")]))
    rest = F.when(F.col("alone") != "", "").when(F.col("before") != "", F.regexp_extract("line", _BEFORE, 2)).when(F.col("after") != "", F.regexp_extract("line", _AFTER, 1)).otherwise(F.col("line"))
    edge = edge.withColumn("rest", rest).withColumn("alone", F.col("alone") != "").withColumn("key", _skeleton_key(F.col("rest"))).withColumn("masked", _header_key(F.col("rest")))
    is_title = F.exists("titles", lambda t: F.levenshtein(t, F.col("key")) <= F.greatest(F.lit(1), F.floor(F.length(t) / 8)))
    edge = edge.withColumn("is_title", F.coalesce(is_title, F.lit(False))).drop("titles", "before", "after")
    looks = (F.length("key") >= 4) & ~F.col("rest").rlike(rf"[.,;:{re.escape(HYPHENS)}]$") & F.col("rest").rlike(r"^[\p{Lu}0-9!@|]")
    pages_with = lambda key: F.size(F.collect_set("page_index").over(W.partitionBy("document_id", key)))
    # two words at least, as captions ("Table 2") aren't headers
    repeated = (pages_with("key") >= 2) | ((pages_with("masked") >= 2) & F.col("rest").rlike(r"\p{L}{2}.*\s\p{L}{2}"))
    # the title of a part in capitals, even if it comes once only
    apart = (F.col("page_index") > 0) & (F.least("top", "bottom") <= 2) & (F.upper("line") == F.col("line")) & F.col("line").rlike(r"\p{Lu}{2}.*\p{Lu}{3}")
    itself = F.coalesce((F.col("page_index") == 0) & (F.col("line_no") == F.col("title_line")), F.lit(False))
    edge = edge.withColumn("header", F.coalesce(~itself & looks & (F.col("is_title") | (repeated & F.col("narrow")) | apart), F.lit(False)))

    arabic = F.when(F.col("figure").rlike(r"\d") | F.col("figure").rlike(r"^[lIoO!]{1,2}$"), F.translate("figure", "lIoOSB!", "1100581").try_cast("int"))
    roman = F.when(F.col("figure").rlike(_ROMAN) & (F.col("figure").rlike("^[a-z]+$") | F.col("figure").rlike("^[A-Z]+$")), _roman_value(F.col("figure")))
    edge = edge.withColumn("value", F.when(F.col("figure").isNotNull() & (F.col("alone") | F.col("header")), F.array_compact(F.array(arabic, roman))))
    # a figure may be read in two ways; each is a row until one has won
    edge = edge.select("*", F.explode_outer("value").alias("number")).withColumn("offset", F.col("number") - F.col("page_index"))
    same, whole = W.partitionBy("document_id", "offset"), W.partitionBy("document_id")
    edge = edge.withColumn("votes", F.when(F.col("offset").isNotNull(), F.size(F.collect_set("page_index").over(same))))
    in_order = same.orderBy("page_index", "line_no")
    near = lambda other: F.coalesce(F.abs(other - F.col("page_index")).between(1, 3), F.lit(False))
    run = near(F.lag("page_index").over(in_order)) | near(F.lead("page_index").over(in_order))
    edge = edge.withColumn("run", run & F.col("offset").isNotNull())
    edge = edge.withColumn("best", F.max(F.when(F.col("offset").isNotNull(), F.struct("votes", (-F.abs("offset")).alias("nearness"), "offset"))).over(whole))
    # a bare number stands for itself only outside of the text, and if it can't be a year
    decorated = ~F.col("line").rlike(r"^\S{1,4}$")
    lone = (F.col("offset") == F.col("best.offset")) & (F.col("offset") >= -2) & ((F.col("votes") >= 2) | decorated | (F.col("outer") & (F.col("number") < 1000)))
    edge = edge.withColumn("counted", F.coalesce(F.col("run") | lone, F.lit(False)))
    kind = F.when(F.col("header") & F.col("counted"), "both").when(F.col("header"), "header").when(F.col("counted"), "number")
    found = edge.groupBy("document_id", "page_index").agg(F.first("held", ignorenulls=True).alias("held"), F.collect_set(F.when(kind.isNotNull(), F.struct("line_no", kind.alias("kind"), "line"))).alias("furniture"))
    return found.select("document_id", "held.name", "page_index", "held.lines", "furniture")


def reflowed(pages: DataFrame, compounds: set[str]) -> DataFrame:
    """document_id and rows: of each line of the text its page_index, line_no, paragraph, piece
    and cut, and one more for each page with its name and furniture (line_no -1).

    cut is true where a cut word begins.  A compound that is written with a hyphen elsewhere
    keeps it and isn't counted.  A number alone on a line in the middle of a sentence stands in
    the margin and is left out.  All windows have one order, that of a document's lines.
    """
    gone = F.transform("furniture", lambda x: x["line_no"])
    lines = F.transform("lines", lambda x, n: F.struct(F.lit(0).alias("last"), n.alias("line_no"), F.trim(F.regexp_replace(x, r"(?U)^\s+|[ \t]+$", "")).alias("line")))
    kept = F.filter(lines, lambda x: ~F.array_contains(gone, x["line_no"]))
    facts = F.array(F.struct(F.lit(1).alias("last"), F.lit(-1).alias("line_no"), F.lit(None).cast("string").alias("line")))
    own = pages.select("document_id", "page_index", F.struct("name", "furniture").alias("facts"), F.explode(F.concat(kept, facts)).alias("l"))
    own = own.select("document_id", "page_index", F.when(F.col("l.last") == 1, F.col("facts")).alias("facts"), "l.*")
    doc = W.partitionBy("document_id").orderBy("last", "page_index", "line_no")
    own = own.withColumn("gap", F.coalesce(F.lag("line").over(doc) == "", F.lit(True)))
    own = own.where("line <> '' or last = 1")
    before = F.lag("line").over(doc)
    margin = F.col("line").rlike(r"^\d{1,4}$") & ~F.col("gap") & ~before.rlike(r"[.:!?]$") & ~before.rlike(r"^\d{1,4}$")
    own = own.withColumn("margin", F.coalesce(margin, F.lit(False))).where("not margin").drop("margin")
    mark = rf"^(.*?)([^\W\d_]+)[{re.escape(HYPHENS)}]$"
    head = r"^([^\W\d_]+)(?:[^\s]*)"
    own = own.withColumn("next", F.lead("line").over(doc)).withColumn("left", F.regexp_extract("line", "(?U)" + mark, 2))
    own = own.withColumn("right", F.regexp_extract(F.coalesce("next", F.lit("")), "(?U)" + head, 1))
    own = own.withColumn("broken", F.coalesce((F.col("left") != "") & F.col("right").rlike(r"^\p{L}"), F.lit(False)))
    written = pages.sparkSession.createDataFrame([(c,) for c in sorted(compounds)], "compound string")
    own = own.join(F.broadcast(written), F.when(F.col("broken") & F.col("line").endswith("-"), F.lower(F.concat_ws("-", "left", "right"))) == F.col("compound"), "left")
    own = own.withColumn("whole", F.col("compound").isNotNull()).withColumn("taken", F.coalesce(F.lag("broken").over(doc), F.lit(False)))
    opening = F.regexp_extract(F.coalesce("next", F.lit("")), "(?U)" + head, 0)
    rest = F.when(F.col("taken"), F.regexp_replace("line", "(?U)" + head + r"\s*", "")).otherwise(F.col("line"))
    rest = F.when(F.col("broken"), F.concat(F.when(F.col("whole"), rest).otherwise(F.regexp_replace(rest, f"[{re.escape(HYPHENS)}]$", "")), opening)).otherwise(rest)
    fresh = F.sum(F.when(F.col("gap") & ~F.col("taken"), 1).otherwise(0)).over(doc.rowsBetween(W.unboundedPreceding, 0))
    row = F.struct("page_index", "line_no", fresh.alias("paragraph"), rest.alias("piece"), (F.coalesce(F.col("left") != "", F.lit(False)) & ~F.col("whole")).alias("cut"), "facts")
    own = own.select("document_id", row.alias("row"))
    return own.groupBy("document_id").agg(F.collect_list("row").alias("rows"))


def repaired_pages(documents: DataFrame, id_col: str = "id", text_col: str = "content", name_col: str = "filename") -> DataFrame:
    """document_id, page_index, text, hyphenation, misread, running_header, page_number of
    every scanned page: its repaired paragraphs and how often each noise was found.

    Null, empty and blank texts and pages that aren't scanned have no row; copies of an id
    count once; a very long document is one group of its windows, never cut; of equally
    frequent spellings the first in order of code points is taken; an empty table gives an
    empty result; other columns aren't read.  Lexicon counts are those of all documents.

    Documents are shuffled once, by their ids; pages, edges, lines and windows stay there.
    """
    own = one_per_key(documents, id_col, text_col, name_col).where(F.col(text_col).rlike(r"(?U)\S"))
    own = own.select(F.col(id_col).alias("document_id"), F.col(text_col).alias("content"), F.col(name_col).alias("name"))
    lexicon = build_lexicon(own, "content")
    shared = documents.sparkSession.sparkContext.broadcast(lexicon)
    kind = documents.schema[id_col].dataType.simpleString()
    schema = f"document_id {kind}, page_index int, text string, hyphenation bigint, misread bigint, running_header bigint, page_number bigint"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            owner, out = [], []
            for place, rows in enumerate(batch.column(1)):
                found = _finished(rows.values, words)
                owner += [place] * len(found)
                out += found
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int32(), pa.string()] + [pa.int64()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    return reflowed(page_furniture(scanned_pages(own)), lexicon.compounds).mapInArrow(run, schema)


def _finished(rows: pa.StructArray, lexicon: Lexicon) -> list[tuple[int, str, int, int, int, int]]:
    """page_index, text and counts of noise of the pages of one document, from its rows."""
    numbers = [rows.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
    order = np.lexsort(numbers[::-1])
    page_of, line_of, paragraph_of, piece_of, cut_of = (rows.field(k).take(pa.array(order)).to_pylist() for k in range(5))
    facts_of = rows.field(5).take(pa.array(order[numbers[1][order] < 0])).to_pylist()
    pages: dict[int, tuple[dict, dict[int, list[str]], list[bool]]] = {}
    for page, line, paragraph, piece, cut in zip(page_of, line_of, paragraph_of, piece_of, cut_of):
        if line < 0:
            pages[page] = (facts_of[len(pages)], {}, [])
        else:
            _, paragraphs, cuts = pages[page]
            paragraphs.setdefault(paragraph, []).append(piece)
            cuts.append(cut)
    bodies, headlines = [], []
    for facts, paragraphs, _ in pages.values():
        bodies.append("\n\n".join(re.sub(" +", " ", " ".join(p)).strip(" ") for p in paragraphs.values()))
        headlines.append(" ".join(sorted(f["line"] for f in facts["furniture"] if f["kind"] != "number")))
    name = next((facts["name"] for facts, *_ in pages.values() if facts["name"]), "")
    found = misreadings(bodies + headlines, lexicon, re.sub(r"[_\W]+", " ", name).title())
    result = []
    for k, (page, (facts, _, cuts)) in enumerate(pages.items()):
        kinds = [f["kind"] for f in facts["furniture"]]
        headers, numbers = (len({f["line_no"] for f in facts["furniture"] if f["kind"] in (x, "both")}) for x in ("header", "number"))
        result.append((page, mended(bodies[k], found[k], lexicon.spelled), sum(cuts), len(found[k]) + len(found[len(bodies) + k]), headers if kinds else 0, numbers if kinds else 0))
    return result


def page_noise(documents: DataFrame) -> DataFrame:
    """document_id, page_index, noise: the kinds of noise found at least once on each page."""
    kinds = ("hyphenation", "misread", "running_header", "page_number")
    stacked = F.filter(F.array(*[F.when(F.col(k) > 0, k) for k in kinds]), lambda x: x.isNotNull())
    return repaired_pages(documents).select("document_id", "page_index", F.explode(stacked).alias("noise"))
