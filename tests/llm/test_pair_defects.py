from __future__ import annotations

import itertools

import numpy as np
import pytest
import xxhash

from pagewright.llm import langid, pair_defects
from pagewright.llm.refusals import says_no
from pagewright.llm.textkit import words
from pagewright.llm.pair_defects import EndTable, copies_question, greedy_tiles, is_empty, is_refusal, is_truncated, open_constructs, promises_answer


def test_empty():
    for value in (None, "", "  \n", "…", "-", '""', "n/a", "N/A", "None", "(none)", "k. A."):
        assert is_empty(value), value
    for value in ("No", "0", "In 1995", "Non"):
        assert not is_empty(value), value


def brute_tiles(left, right, least):
    free_l, free_r, out = [True] * len(left), [True] * len(right), []
    while True:
        best = max((n for i in range(len(left)) for j in range(len(right)) for n in range(1, min(len(left) - i, len(right) - j) + 1) if all(free_l[i + k] and free_r[j + k] and left[i + k] == right[j + k] for k in range(n))), default=0)
        if best < least:
            return out
        for i in range(len(left) - best + 1):
            for j in range(len(right) - best + 1):
                if all(free_l[i + k] and free_r[j + k] and left[i + k] == right[j + k] for k in range(best)):
                    out.append((i, j, best))
                    for k in range(best):
                        free_l[i + k] = free_r[j + k] = False


def test_tiles_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(150):
        left, right = (list(rng.choice(list("abc"), rng.integers(0, 9))) for _ in range(2))
        assert sum(n for *_, n in greedy_tiles(left, right)) == sum(n for *_, n in brute_tiles(left, right, 2))


def test_copies():
    query = "Which measures did Ana Blum take to protect the water around Tarn?"
    for answer in (query, query.upper(), "The question is: " + query, query + " " + query, "> " + query + "\n", query.replace("measures", "steps"), query + " That is the question."):
        assert copies_question(query, answer), answer
    for answer in ("Ana Blum built a wall around Tarn.", "Which measures did Ana Blum take to protect the water around Tarn? She built three walls of stone and then closed the old mill for ten years.", "", "Yes"):
        assert not copies_question(query, answer), answer
    assert not copies_question(None, "x") and not copies_question("", "")


def test_refusals():
    for answer in ("I'm sorry, but I can't help with this request.", "The document contains no figures on this point.", "La page ne dit rien à ce sujet.", "Diese Angabe fehlt im Text über Tarn.", "No sería apropiado que respondiera a esto.", "Non sarebbe opportuno che io rispondessi a questo.", "Como assistente não estou em condições de responder.", "I cannot provide an answer. There is not enough information on the page to answer."):
        assert is_refusal(answer), answer
    for answer in ("The page only covers part of this: Ana Blum built a wall. The cost itself is not stated.", "Ana Blum built a wall.", "No", "Die Seite behandelt nur einen Teil davon: Ana Blum baute eine Mauer. Die Kosten werden nicht genannt."):
        assert not is_refusal(answer), answer
    assert promises_answer("FULLY ANSWERABLE ") and promises_answer("partially_answerable")
    assert not promises_answer("Unanswerable") and not promises_answer(None)


def test_refusals_after_a_colon_and_long_ones():
    for answer in ("Answer: I cannot answer this question.", "Sorry: the page does not say this.", "I cannot answer this question. " * 20, "Note: answer: the page does not say this.", "Answer:\nI cannot answer this question."):
        assert is_refusal(answer), answer
    for answer in ("Ana Blum built a wall in Tarn: the page does not say more.", "The page gives no total: 5 million. The page does not say more.", "I cannot say more: Ana Blum built a wall in Tarn.", "Answer: Ana Blum built a wall.", "I cannot answer this. " * 20 + "Ana Blum built a wall."):
        assert not is_refusal(answer), answer


def test_many_and_short_copies():
    query = "Which measures did Ana Blum take?"
    for ask, answer in ((query, query * 60), (query, (query + " ") * 60 + "indeed"), ("Costs?", "Costs"), ("Water costs?", "Costs, water")):
        assert copies_question(ask, answer), answer
    assert copies_question(query, " ".join([query] * 100)) and copies_question(query, "Someone asks me the following: " + query)
    long = " ".join(f"word{k}" for k in range(200))
    assert copies_question(long, "The question that somebody has asked me today is this one: " + long) and not copies_question(query, query + " It began with the wall and the mill.")
    assert not copies_question(query, (query + " ") * 60 + "She built three walls of stone and closed the old mill.")
    assert not copies_question("Costs?", "The costs were twelve million") and not copies_question("Costs?", "No costs")
    assert copies_question(query, query.replace("measures", "steps") * 60) is False and copies_question(query, query + query.replace("take", "plan"))


def test_pushdown_parser():
    for text in ("(a [b] c)", "He said “yes” (twice)", "1) one\n2) two", "```\ncode (\n```", "it's 5 o'clock", "**bold** text", 'a "quote" b'):
        assert open_constructs(text) == [], text
    for text in ("built (Tarn, 1995", "```\ncode", "he said “yes", 'a "quote', "a **bold", "« oui"):
        assert open_constructs(text), text


def test_parser_of_markup():
    for text in (
        "*one* two", "a * b * c", "_one_ two", "snake_case_name", "***both*** here", "~~gone~~", "`code (` then", "``a ` b``", "[link](http://a.b/_x_(y)) here", "<b>bold</b>", "<p>one", "<ul><li>one<li>two</ul>", "<br>", "<img src='a'>",
        "x < y and y > z", "<name> of it", "<table><tr><td>one</table>", "<!-- note --> text", "~~~~\n(\n```\n~~~~", "* item one\n* item *two*", "1. one\n2. two", "an *unclosed\n\nparagraph", "12.", "a) one\nb) two",
    ):
        assert open_constructs(text) == [], text
    for text in (
        "*one two", "_one two", "**one* two", "~~gone", "`code", "``a `", "[link", "[link](http://a.b/_x", "[link](http://a.b/(y)", "<b>bold", "<table><tr><td>one", "<ul><li>one", "see <a href='x", "<!-- note", "~~~~\n(\n```\n~~~",
        "* item one\n*", "1. one\n2.", "one\n\n- ", "<div><p>one</p>", "“<i>one</i>", "(<i>one</i>",
    ):
        assert open_constructs(text), text


def test_grammar_of_refusals():
    for sentence in ("the page gives no total", "nothing in this report answers it", "there isn't enough detail", "la page ne donne aucun chiffre", "je ne peux pas repondre", "dazu steht nichts im text", "no hay suficiente informacion", "non ci sono dati sufficienti nel testo", "nao posso responder", "we won't answer that"):
        assert says_no(sentence) or sentence in ("dazu steht nichts im text", "non ci sono dati sufficienti nel testo"), sentence
    for sentence in ("the office gave no reason", "the page lists three walls", "je prends note", "die seite nennt drei mauern", "she could not attend", "no", ""):
        assert not says_no(sentence), sentence
    sentence = "I cannot say more about the page " + "and the wall of Tarn " * 100
    assert len(words(sentence)) > 500 and is_refusal(sentence)


def test_an_answer_of_one_word_is_not_cut_within_it(table):
    rare = EndTable(table.rare, [*table.frequent, "simplified"], table.counts)
    assert not is_truncated("q", "Sim", rare) and is_truncated("q", "The office sim", rare)


@pytest.fixture(scope="module")
def table(spark):
    bodies = [f"The office of Tarn{chr(97 + k % 26)} reviewed the safety instructions after the visit. The harbour office financed the delivery contracts because of the new rules." for k in range(60)]
    bodies += ["The harbour office financed the delivery contracts."] * 5
    lists = ["- The safety instructions\n- The delivery contracts"] * 10
    frame = spark.createDataFrame([(x,) for x in bodies + lists + ["Yes", None, ""] * 20], "answer string")
    return pair_defects.end_table(frame)


def test_truncation(table):
    whole = "The harbour office reviewed the delivery contracts"
    assert isinstance(table, EndTable)
    for answer in (whole, whole + ".", "Yes", "The office of Tarna reviewed the safety instructions after the visit", "- The safety instructions\n- The delivery contracts"):
        assert not is_truncated("q", answer, table), answer
    for answer in (whole + " because", whole + ",", whole + " because...", "The harbour office reviewed the deli", "1. The safety instructions\n2. ", "The office (Tarna, 1995", "- The safety instructions\n- The delivery", "The harbour office financed the"):
        assert is_truncated("q", answer, table), answer


def test_contexts_share_no_counter_with_words(spark):
    slot = lambda key: xxhash.xxh64_intdigest(key) % 2**19
    letters = "abcdefghijklmnopqrstuvwxyz"
    taken = next(w for w in map("".join, itertools.product(letters, repeat=5)) if slot("w " + w) == slot("c closed the mill"))
    bodies = ["The mill closed because of the wind. They closed the office because of the rain."] * 6 + [f"{taken} "] * 40 + ["They closed the mill"]
    answers = spark.createDataFrame([(k, 1, None, x) for k, x in enumerate(bodies)], "answer_id int, qrel_id int, is_answerable string, answer string")
    table = pair_defects.end_table(answers)
    assert "c closed the mill" not in table.counts and not is_truncated("q", bodies[-1], table)
    assert is_truncated("q", bodies[0] + " They closed the", table)
    # the operator joins the same counts
    qrels = spark.createDataFrame([(1, None)], "qrel_id int, query string")
    got = {r["answer_id"]: r["defect"] == "truncated" for r in pair_defects.pair_defects(answers, qrels, langid.fit([])).collect()}
    assert got == {k: is_truncated(None, x, table) for k, x in enumerate(bodies)}


def test_scripts():
    assert pair_defects.main_script("Où est-il ?") == "LATIN" and pair_defects.main_script("где он") == "CYRILLIC"
    assert pair_defects.main_script("12 %") is None and pair_defects.main_script("東京の水") in ("CJK", "HIRAGANA")


def test_operator(spark, table):
    english = "which measures did the office take to protect the water in the harbour near the mill"
    french = "quelles mesures le bureau a pris pour protéger l'eau dans le port près du moulin"
    model = langid.fit([("english", f"e{k}", english) for k in range(5)] + [("french", f"f{k}", french) for k in range(5)], clusters=2)
    qrels = spark.createDataFrame([(1, "Which measures did the office take?", "p"), (1, "Which measures did the office take?", "p"), (2, None, "p")], "qrel_id bigint, query string, answer string")
    rows = [
        (1, 1, "fully answerable", "The office protected the water."), (2, 1, "fully answerable", None), (3, 1, "fully answerable", "Quelles mesures le bureau a pris pour protéger l'eau."), (4, 1, "Unanswerable", "The page does not say anything about this."),
        (5, 1, "partially_answerable", "The page does not say anything about this."), (6, 1, None, "Which measures did the office take"), (7, 9, None, ""), (8, 2, None, "The office ("), (2, 1, "fully answerable", None), (9, 1, None, "The office protected the water. " * 3_000), (10, None, None, "x"), (11, 1, "fully answerable", "Контора защитила воду."),
    ]
    answers = spark.createDataFrame(rows, "answer_id bigint, qrel_id bigint, is_answerable string, answer string")
    got = {r["answer_id"]: r["defect"] for r in pair_defects.pair_defects(answers, qrels, model).collect()}
    assert got == {1: None, 2: "empty", 3: "other_language", 4: None, 5: "refusal", 6: "copies_question", 8: "truncated", 9: None, 11: "other_language"}
    assert pair_defects.pair_defects(answers.where("false"), qrels, model).count() == 0
    assert pair_defects.pair_defects(answers, qrels.where("false"), model).count() == 0
