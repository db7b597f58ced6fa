"""Problem 5: broken pairs of queries and answers.

Truncation is read with a pushdown parser over fences, code, tags, brackets, links, quotation
marks, list items and emphasis, and from how the last words behave in all answers: the share of
their occurrences that stand before the end of a sentence.  Copies of the question are found by
greedy string tiling over words, answers in another language by their script and the language
model, and refusals by a grammar (see refusals) that every sentence of the answer must follow.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.langid import LanguageModel, fit, hashed_sample, table_samples
from pagewright.llm.refusals import says_no
from pagewright.llm.textkit import extended, fold, one_per_key, slices, words
from pagewright.session import reliable_checkpoint

#: Share of all words below which a word counts as a name: at most 1 / RARE others are broadcast.
RARE = 5e-5

#: Strings that stand for no answer, without what isn't a letter.
PLACEHOLDERS = frozenset("na none null nil nan undefined tbd tba ka nichts ninguno ninguna nada nessuno nenhum nenhuma aucun aucune keine rien niente nothing empty".split())

_PUNCTUATION_ONLY = re.compile(r"[\W_]*")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+")
_TOKEN = re.compile(r"[^\W_]+|[.!?…]+(?=[\s\"'»”)\]]|$)|\n")
_CONSTRUCT = re.compile(r"[(\[{«“„\"`~*_<]|^[ \t]*(?:[-+•]|\d{1,3}[.)]|[a-z]\))\s*\Z", re.M)
_OPENERS = {"(": ")", "[": "]", "{": "}", "«": "»", "“": "”", "„": "“"}


# --- emptiness ------------------------------------------------------------------------------


def is_empty(answer: str | None) -> bool:
    """Null, or no more than white space, punctuation or a placeholder for nothing."""
    if answer is None or _PUNCTUATION_ONLY.fullmatch(answer):
        return True
    return re.sub(r"[\W_]+", "", fold(answer)) in PLACEHOLDERS


# --- copies ---------------------------------------------------------------------------------


def greedy_tiles(left: list[str], right: list[str], least: int = 2) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in left, place in right, length), longest tiles first."""
    taken_left, taken_right = [False] * len(left), [False] * len(right)
    tiles = []
    while True:
        best, found = least - 1, []
        runs = [0] * (len(right) + 1)
        for i in range(len(left) - 1, -1, -1):
            fresh = [0] * (len(right) + 1)
            if not taken_left[i]:
                for j in range(len(right) - 1, -1, -1):
                    if not taken_right[j] and left[i] == right[j]:
                        fresh[j] = n = runs[j + 1] + 1
                        if n > best:
                            best, found = n, [(i, j)]
                        elif n == best and n >= least:
                            found.append((i, j))
            runs = fresh
        if best < least or not found:
            return tiles
        for i, j in sorted(found):
            if not any(taken_left[i : i + best]) and not any(taken_right[j : j + best]):
                taken_left[i : i + best] = taken_right[j : j + best] = [True] * best
                tiles.append((i, j, best))


def copies_question(query: str | None, answer: str | None, share: float = 0.8, introduction: int = 7) -> bool:
    """Whether tiles cover share of the query's words and, with repeated copies taken away, no
    more words of the answer are left than an introduction has (no more than the query itself)
    and alterations of the other words of the query."""
    ask, said = words(query), words(answer)
    if not ask or len(said) < share * len(ask):
        return False
    if (Counter(ask) & Counter(said)).total() < share * len(ask):
        return False  # tiles can't cover more words than both have
    if len(ask) <= 2 and set(said) == set(ask):
        return True  # tiles of one word, and nothing else
    left, covered = _without_repeats(said, ask) if len(ask) > 1 else (said, 0.0)
    asked, most = set(ask), min(introduction, len(ask)) + (1 - share) * len(ask)
    if sum(w not in asked for w in left) > most:
        return False  # no tile takes these away
    rest: list[str] = []
    step = 40 * len(ask)
    for begin in range(0, len(left), step):  # in parts, so that the time grows with the words only
        rest += left[begin : begin + step]
        while len(rest) >= share * len(ask):
            tiles = greedy_tiles(rest, ask)
            own = sum(n for *_, n in tiles) / len(ask)
            if own < share:
                break
            covered = max(covered, own)
            gone = {k for i, _, n in tiles for k in range(i, i + n)}
            rest = [w for k, w in enumerate(rest) if k not in gone]
        if len(rest) > step:
            return False  # so many words without a copy
    return covered >= share and len(rest) <= most


def _without_repeats(said: list[str], ask: list[str]) -> tuple[list[str], float]:
    """The words without exact copies of all of ask, and 1.0 if there was one, else 0.0."""
    rest, covered, at, n = [], 0.0, 0, len(ask)
    while at < len(said):
        if said[at] == ask[0] and said[at : at + n] == ask:
            covered, at = 1.0, at + n
        else:
            rest.append(said[at])
            at += 1
    return rest, covered


# --- refusals -------------------------------------------------------------------------------

def is_refusal(answer: str) -> bool:
    """Whether the grammar accepts every sentence: it declines or says that the information is
    lacking.

    Where more than three words follow a colon, what stands after each colon must do so, too,
    and what stands before it unless it is a lead of three words; else something is given.
    """
    strict = ":" in answer and len(words(answer.split(":", 1)[1])) > 3
    sentences = [s for s in _SENTENCE.split(fold(answer).replace("’", "'")) if words(s)]
    return any(map(says_no, sentences)) and all(_refuses(s, strict) for s in sentences)


def _refuses(sentence: str, strict: bool) -> bool:
    before, colon, after = sentence.partition(":")
    if not (strict and colon):
        return says_no(sentence)
    return (len(words(before)) <= 3 or says_no(before)) and (not words(after) or _refuses(after.strip(), strict))


def promises_answer(is_answerable: str | None) -> bool:
    """Whether a label, in whatever spelling, says fully or partially answerable."""
    key = re.sub(r"[\W_]+", " ", (is_answerable or "").lower()).strip()
    return key in ("fully answerable", "partially answerable", "fully", "partially", "answerable", "partly answerable")


# --- truncation -----------------------------------------------------------------------------


def _contexts(tail: list[str]) -> list[str]:
    return [" ".join(tail[-n:]) for n in (3, 2, 1) if len(tail) >= n]


def _events(answer: str) -> Iterator[tuple[list[str], bool]]:
    """(the last three words, whether a sentence or list item ends there) of each word but the
    last one, which counts, as an end, only if it is the whole answer."""
    tail: list[str] = []
    tokens = _TOKEN.findall(answer)
    if len(tokens) == 1 and tokens[0][0] not in ".!?…\n":
        yield ["^", "9" if tokens[0].isdigit() else fold(tokens[0])], True
    for token, following in zip(tokens, tokens[1:] + [""]):
        if token[0] in ".!?…\n":
            tail = ["^"]
            continue
        tail = (tail or ["^"])[-2:] + ["9" if token.isdigit() else fold(token)]
        if following:
            yield tail, following in (".", "!", "?", "\n")


class EndTable:
    """Which words are frequent, and how often contexts occur and end a sentence.

    Words below RARE of all occurrences count as names, which all share one mark; the frequent
    ones are 1 / RARE at most.  counts has (occurrences, sentence ends) of whole short answers
    ("a ...") and of contexts of one to three words ("c ...").  It is exact, grows with the
    texts and is left empty where the counts are joined instead.
    """

    def __init__(self, rare: float, frequent: list[str], counts: dict[str, tuple[int, int]] | None = None):
        self.rare, self.frequent, self.counts = rare, sorted(frequent), counts or {}
        self.known = frozenset(frequent)

    def begins_word(self, part: str) -> bool:
        """Whether a frequent word goes on after part."""
        at = bisect.bisect_right(self.frequent, part)
        return at < len(self.frequent) and self.frequent[at].startswith(part)

    def is_rare(self, word: str) -> bool:
        return word != "9" and word != "^" and word not in self.known

    def mask(self, tail: list[str]) -> list[str]:
        return ["N" if self.is_rare(w) else w for w in tail]


def frequent_words(answers: DataFrame, text_col: str = "answer") -> EndTable:
    """The table of the frequent words of all answers, without counts of contexts."""
    counted = reliable_checkpoint(word_table(answers, text_col))  # read twice
    rare = max(4.0, RARE * float(counted.agg(F.sum("n")).first()[0] or 0))
    return EndTable(rare, [r["word"] for r in counted.where((F.col("n") >= rare) & (F.col("word") != "9")).select("word").collect()])


def context_counts(answers: DataFrame, table: EndTable, text_col: str = "answer") -> DataFrame:
    """key, n, e: exact counts of all contexts and whole short answers, names masked, and of
    the sentence ends after them; added up in the tasks before they are shuffled."""
    shared = answers.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        seen: Counter[str] = Counter()
        ends: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64()), pa.array([ends[k] for k in seen], pa.int64())], names=["key", "n", "e"])
            seen.clear()
            ends.clear()
            return batch

        for batch in batches:
            for answer in batch.column(0).to_pylist():
                for tail, end in _events(answer):
                    found = ["c " + context for context in _contexts(own.mask(tail))]
                    seen.update(found)
                    if end:
                        ends.update(found)
                whole = short_key(answer, own)
                if whole:
                    seen["a " + whole] += 1
                if len(seen) > 300_000:
                    yield out()
        yield out()

    rows = answers.select(F.col(text_col).alias("_text")).where("_text is not null").mapInArrow(run, "key string, n bigint, e bigint")
    return rows.groupBy("key").agg(F.sum("n").alias("n"), F.sum("e").alias("e"))


def end_table(answers: DataFrame, text_col: str = "answer") -> EndTable:
    """The table with the counts of all answers, for as many as the driver can hold."""
    table = frequent_words(answers, text_col)
    rows = context_counts(answers, table, text_col).collect()
    return EndTable(table.rare, table.frequent, {r["key"]: (r["n"], r["e"]) for r in rows})


def word_table(answers: DataFrame, text_col: str = "answer") -> DataFrame:
    """word, n: occurrences of the folded words of all texts; numbers count as the word 9."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Counter("9" if t.isdigit() else fold(t) for text in batch.column(0).to_pylist() for t in _TOKEN.findall(text) if t[0] not in ".!?…\n")
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())], names=["word", "n"])

    counted = answers.select(F.col(text_col).alias("_text")).where("_text is not null").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def short_key(answer: str, table: EndTable) -> str:
    """The masked form of an answer of up to six words; empty for longer ones."""
    tokens = [("9" if t.isdigit() else fold(t)) for t in _TOKEN.findall(answer) if t[0] not in ".!?…\n"]
    return " ".join(table.mask(tokens)) if 0 < len(tokens) <= 6 else ""


# Tags whose end may be left out, those without an end, and the others that are known.
_OPTIONAL = frozenset("p li td th tr dt dd thead tbody tfoot option colgroup".split())
_VOID = frozenset("area br col embed hr img input link meta source track wbr".split())
_TAGS = _OPTIONAL | frozenset("a abbr article aside b blockquote body caption code del details div dl em figcaption figure footer h1 h2 h3 h4 h5 h6 head header html i ins kbd main mark math nav ol pre q s samp script section small span strong style sub summary sup svg table u ul var".split())
_PIECE = re.compile(
    r"""(?P<fence>^[ \t]*(?:`{3,}|~{3,})[^\n]*$) | (?P<blank>^[ \t]*$) | (?P<marker>^[ \t]*(?:[-*+•]|\d{1,3}[.)]|[a-z]\))(?=\s|\Z))
    | (?P<comment><!--|-->) | (?P<tag></?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?(?:>|\Z)) | (?P<code>`+) | (?P<emphasis>\*+|_+|~~) | (?P<link>\]\()
    | (?P<opener>[(\[{«“„]) | (?P<closer>[)\]}»”]) | (?P<quote>") | (?P<other>[^\s`*_~<\-()\[\]{}«»“”„"]+|\S)""", re.M | re.X)


class _Parser:
    """A pushdown parser: one stack for all constructs, what closes each on top of what holds it."""

    def __init__(self) -> None:
        self.stack: list[str] = []

    def pop_to(self, mark: str) -> bool:
        """Close mark and what stands open within it."""
        if mark not in self.stack:
            return False
        while self.stack.pop() != mark:
            pass
        return True

    def end_inline(self) -> None:
        """Emphasis and code in a line reach no farther than its paragraph or list item."""
        self.stack = [x for x in self.stack if x[0] not in "*_~`" or x.startswith(("```", "~~~"))]

    def read(self, text: str) -> list[str]:
        started = False
        for piece in _PIECE.finditer(text):
            kind, own = piece.lastgroup, piece[0]
            top = self.stack[-1] if self.stack else ""
            before, after = text[piece.start() - 1 : piece.start()], text[piece.end() : piece.end() + 1]
            if top.startswith(("```", "~~~")):
                if kind == "fence" and own.strip()[0] == top[0] and own.strip().strip(top[0]) == "" and len(own.strip()) >= len(top):
                    self.stack.pop()
            elif top == "-->":
                if own == top:
                    self.stack.pop()
            elif top.startswith("`"):
                if own == top:
                    self.stack.pop()
                elif kind in ("blank", "marker"):
                    self.end_inline()
            elif kind == "blank":
                self.end_inline()
            elif kind == "marker":
                self.end_inline()
                if top == "item":
                    self.stack.pop()
                if started:  # a mark alone is a text by itself
                    self.stack.append("item")
            else:
                if top == "item":
                    self.stack.pop()
                self.inline(kind, own, before, after)
            started = started or kind != "blank"
        return [x for x in self.stack if x[1:-1] not in _OPTIONAL]

    def inline(self, kind: str, own: str, before: str, after: str) -> None:
        top = self.stack[-1] if self.stack else ""
        if kind == "fence":
            self.stack.append(own.strip()[0] * (len(own.strip()) - len(own.strip().lstrip(own.strip()[0]))))
        elif kind == "comment":
            if own == "<!--":
                self.stack.append("-->")
        elif kind == "tag":
            self.tag(own)
        elif kind == "code":
            self.stack.append(own)
        elif kind == "link" and "]" in self.stack:
            self.pop_to("]")
            self.stack.append(") of a link")
        elif kind in ("link", "closer"):
            for mark in own if kind == "closer" else own[:1]:
                if mark == ")" and ") of a link" in self.stack and ")" not in self.stack:
                    mark = ") of a link"
                self.pop_to(mark)
            if kind == "link":
                self.stack.append(")")
        elif top == ") of a link":
            if own == "(":
                self.stack.append(")")
        elif kind == "opener":
            self.stack.append(_OPENERS[own])
        elif kind == "quote":
            if own in self.stack:
                self.pop_to(own)
            elif not before.isalnum() and after.strip():
                self.stack.append(own)
        elif kind == "emphasis":
            for mark in [own[:2]] * (len(own) // 2) + [own[:1]] * (len(own) % 2) if own[0] != "~" else [own]:
                if before.strip() and mark in self.stack and (own[0] == "*" or not after.isalnum()):
                    self.pop_to(mark)
                elif after.strip() and not before.isalnum() and len(own) <= 3:
                    self.stack.append(mark)

    def tag(self, own: str) -> None:
        name = re.match(r"</?([A-Za-z][A-Za-z0-9]*)", own)[1].lower()
        if name in _VOID or name not in _TAGS or own.endswith("/>"):
            return
        if not own.endswith(">"):
            self.stack.append(own)  # broken off within the tag
        elif own.startswith("</"):
            self.pop_to(f"<{name}>")
        else:
            self.stack.append(f"<{name}>")


def open_constructs(text: str) -> list[str]:
    """What a pushdown parser finds open at the end: fences, code, comments, tags, brackets,
    links, quotation marks, emphasis, list items without a word.

    Straight quotation marks and emphasis open before a word and close after one; an apostrophe
    is none of them.  Enumerations such as "1)" close nothing.  Only known tags count, and those
    whose end may be left out don't.
    """
    return _Parser().read(text) if _CONSTRUCT.search(text) else []


def ending(query: str | None, answer: str, table: EndTable) -> tuple[bool | None, list[str]]:
    """Whether an answer breaks off before its sentence or list item is complete, and the keys
    of the counts that have a say in it (see breaks_off); without keys the verdict stands."""
    text = answer.rstrip()
    if open_constructs(text):
        return True, []
    ellipsis = re.search(r"(?:\.{3,}|…)$", text)
    body = text[: ellipsis.start()].rstrip() if ellipsis else text
    if not body:
        return False, []
    if not ellipsis and re.search(r"[.!?][\"'»”)\]*_`]*$", body):
        return False, []
    if re.search(r"[,;:(\[{«“„–—/&-]$", body):
        return True, []
    tokens = _TOKEN.findall(body)
    tail: list[str] = ["^"]
    for token in tokens:
        tail = ["^"] if token[0] in ".!?…\n" else tail[-2:] + ["9" if token.isdigit() else fold(token)]
    last = next((t for t in reversed(tokens) if t[0] not in ".!?…\n"), "")
    if not last:
        return False, []
    key = short_key(body, table)
    whole = ["a " + key] if key else []
    mark = fold(last)
    single = sum(t[0] not in ".!?…\n" for t in tokens) == 1  # an answer of one word isn't cut within it
    if not single and not mark.isdigit() and table.is_rare(mark):
        around = words(query) + words(body)[:-1]
        if mark not in around and (last[0].islower() or table.begins_word(mark) or any(w.startswith(mark) for w in around)):
            return True, whole  # cut within a word
    if key and len(tokens) <= 3 and "N" in key:
        return False, []  # a name or a number with a preposition
    return None, whole + ["c " + context for context in _contexts(table.mask(tail))]


def breaks_off(verdict: bool | None, keys: list[str], counts: dict[str, tuple[int, int]], rare: float, least_share: float = 0.01, least: int = 12) -> bool:
    """The verdict of ending with the counts of its keys: a short answer that others give as
    well is whole; else, where the verdict is open, the share of sentence ends decides after
    the longest context that is known, that is, seen least times, or after the last word."""
    if keys and keys[0].startswith("a ") and counts.get(keys[0], (0, 0))[0] >= max(3.0, rare):
        return False
    if verdict is not None:
        return verdict
    shares = [e / n if n >= least else None for n, e in (counts.get(k, (0, 0)) for k in keys if k.startswith("c "))]
    share, alone = next((x for x in shares if x is not None), None), shares[-1]
    return (share is not None and share < least_share) or (alone is not None and alone < least_share / 5)


def is_truncated(query: str | None, answer: str, table: EndTable, least_share: float = 0.01) -> bool:
    """Whether an answer breaks off, by a table with counts."""
    return breaks_off(*ending(query, answer, table), table.counts, table.rare, least_share)


# --- scripts --------------------------------------------------------------------------------


@lru_cache(maxsize=50_000)
def _script_of(letter: str) -> str:
    return unicodedata.name(letter, "unknown").split(" ")[0]


def main_script(text: str) -> str | None:
    """The script of most letters, by their Unicode names; None for fewer than three letters."""
    if sum(map(str.isalpha, text)) < 3:
        return None
    if max(text) < "\u0250":  # all letters before it are Latin
        return "LATIN"
    return Counter(_script_of(c) for c in text if c.isalpha()).most_common(1)[0][0]


# --- the operator ---------------------------------------------------------------------------


def classify(query: str | None, answer: str | None, is_answerable: str | None, model: LanguageModel) -> str | None:
    """The defect of a pair, or None; truncation aside."""
    if is_empty(answer):
        return "empty"
    if copies_question(query, answer):
        return "copies_question"
    scripts = main_script(query or ""), main_script(answer)
    if None not in scripts and scripts[0] != scripts[1]:
        return "other_language"
    asked, _, n = model.decide(query or "")
    said, _, m = model.decide(answer)
    if asked and said and asked != said and n > 1 and m > 1:
        scores, _ = model.scores(answer)
        own, other = scores[model.languages.index(said)], scores[model.languages.index(asked)]
        if own - max(other, 0.0) >= min(0.7, 2 / m) * own:  # the fewer words, the clearer they must be
            return "other_language"
    if promises_answer(is_answerable) and is_refusal(answer):
        return "refusal"
    return None


def fit_for_pairs(answers: DataFrame, qrels: DataFrame, documents: DataFrame, names: DataFrame, queries: DataFrame, most_pairs: int = 8_000) -> LanguageModel:
    """A language model that also knows answers.

    The answers of a bounded sample of pairs (most_pairs, by the hashes of their ids) count
    as written in the language that the words of their query vote for, as far as their own
    words agree.
    """
    own = hashed_sample(answers.where(F.col("answer").isNotNull()).select("answer_id", "qrel_id", "answer"), "answer_id", most_pairs)
    rows = own.join(one_per_key(qrels, "qrel_id", "query"), "qrel_id").select("answer_id", "query", "answer").collect()
    rows.sort(key=lambda r: (r[0], r[2]))
    return fit(table_samples(documents, names, queries, replies=[(query, f"a{key}", answer) for key, query, answer in rows]))


def pair_defects(answers: DataFrame, qrels: DataFrame, model: LanguageModel) -> DataFrame:
    """answer_id, defect of each answer whose qrel exists; defect is null for a sound pair.

    Null, empty and blank answers are ``empty`` whatever the query; null or blank queries
    leave out the comparisons with the query; copies of an answer_id or qrel_id count once;
    an answer has one defect, the first that holds in the order empty, copies_question,
    other_language, refusal, truncated; very long answers are read whole; an empty table on
    either side gives an empty result; other columns aren't read, so clashing names do no
    harm.  The counts behind ``truncated`` come from all answers and are joined to the
    endings that ask for them, so that nothing is broadcast but the frequent words.
    """
    own = one_per_key(answers, "answer_id", "qrel_id", "is_answerable", "answer")
    asked = one_per_key(qrels, "qrel_id", "query")
    table = frequent_words(own)
    shared = answers.sparkSession.sparkContext.broadcast((table, model))
    schema = extended(own, "answer_id", "defect string, verdict boolean, keys array<string>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, languages = shared.value
        for batch in batches:
            for part in slices(batch, "answer"):
                found = []
                for q, a, label in zip(*(part.column(k).to_pylist() for k in (1, 2, 3))):
                    defect = classify(q, a, label, languages)
                    verdict, keys = (None, []) if defect else ending(q, a, ends)
                    found.append((defect or ("truncated" if verdict and not keys else None), verdict, keys))
                columns = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.bool_(), pa.list_(pa.string()))))], names=schema.names)

    rows = reliable_checkpoint(own.join(asked, "qrel_id").select("answer_id", "query", "answer", "is_answerable").mapInArrow(run, schema))  # read twice below
    wanted = rows.where("size(keys) > 0").select("answer_id", "verdict", F.posexplode("keys").alias("place", "key"))
    held = wanted.join(context_counts(own, table), "key", "left")
    grouped = held.groupBy("answer_id").agg(F.first("verdict").alias("verdict"), F.array_sort(F.collect_list(F.struct("place", "key", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("e", F.lit(0)).alias("e")))).alias("held"))
    rare = table.rare

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for verdict, held_by in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                cut = breaks_off(verdict, [h["key"] for h in held_by], {h["key"]: (h["n"], h["e"]) for h in held_by}, rare)
                found.append("truncated" if cut else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["answer_id", "defect"])

    closed = grouped.select("answer_id", "verdict", "held").mapInArrow(finish, extended(own, "answer_id", "defect string"))
    return rows.where("size(keys) = 0").select("answer_id", "defect").unionByName(closed)
