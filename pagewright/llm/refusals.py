"""Refusals: a grammar over the words of a sentence, with terminals for each language.

Rules are common to the languages: a subject that stands for the source, a negation and a verb
or noun for what is missing, or a speaker who can't or won't answer.  A sentence is parsed bottom
up into spans of symbols; between the symbols of a rule other words may stand where it says so.
"""

from __future__ import annotations

import re
from functools import lru_cache

_WORD = re.compile(r"[^\W_]+")
_CONTRACTED = ((re.compile(r"\bcannot\b|\bcan't\b"), "can not"), (re.compile(r"\bwon't\b"), "will not"), (re.compile(r"n't\b"), " not"), (re.compile(r"\bquest'"), "questa "))

#: The rules: symbol to its productions.  "..." between symbols lets any words stand there, "~" at most
#: three, nothing none; "^" is the begin of the sentence.
RULES = {
    "refusal": ("lack", "decline"),
    "lack": (
        "source ... denial", "nothing place", "nothing ~ place ... source", "negation ~ enough ~ info", "scarce ~ info", "none info",
        "^ that info ... missing", "negation be found", "be negation given place that",
    ),
    "denial": ("denier", "auxiliary negation", "negation hold", "negation ~ hold ... nothing", "hold none", "hold ... nothing", "be silent", "negation ... nothing"),
    "decline": ("self ... inability", "negation able", "negation ~ proper", "sorry", "consult"),
    "inability": ("modal negation", "negation ~ able", "unable", "refuse", "rather negation"),
}

#: By language the words of each terminal, folded; phrases have underscores.
TERMINALS = {
    "english": {
        "source": "document documents page pages text texts passage passages report reports source sources section sections context file files",
        "info": "information detail details answer figure figures data mention context", "that": "this the that such", "place": "in on by",
        "negation": "not never", "none": "no", "nothing": "nothing", "denier": "never", "auxiliary": "do does did", "hold": "contain contains give gives has have provide provides say says",
        "enough": "enough", "scarce": "insufficient", "missing": "not missing absent unavailable", "be": "be is are", "silent": "silent", "found": "found determined answered",
        "given": "given stated mentioned provided available included specified", "self": "i we", "modal": "can could will must should", "able": "able comfortable in_a_position", "unable": "unable",
        "refuse": "decline refuse", "rather": "rather", "proper": "appropriate", "sorry": "i_m_sorry i_am_sorry we_are_sorry", "consult": "please_consult",
    },
    "french": {
        "source": "document page texte passage rapport section", "info": "information informations chiffre chiffres donnee donnees mention reponse reponses", "that": "cette ces l le la ce", "place": "dans",
        "negation": "ne n pas", "none": "aucun aucune", "nothing": "rien aucun aucune", "hold": "dit contient figure precise mentionne donne fournit comporte parle permet repond indique",
        "enough": "assez suffisamment", "missing": "pas absent absente manque manquent", "self": "je", "able": "en_mesure", "unable": "pas regrette", "refuse": "decliner refuser refuse decline",
        "proper": "approprie opportun convenable", "sorry": "je_suis_desole je_suis_desolee je_reste_desole", "consult": "veuillez_consulter",
    },
    "german": {
        "source": "dokument seite text abschnitt bericht passage", "info": "information informationen angabe angaben auskunft antwort zahlen", "that": "diese die dieser solche", "place": "im in auf",
        "negation": "nicht", "none": "keine keinen kein", "nothing": "nichts", "denier": "keine keinen kein nichts nicht", "enough": "genug", "scarce": "zu_wenig keine_ausreichenden keine_ausreichende", "missing": "fehlt fehlen nicht",
        "self": "ich wir", "unable": "nicht leider keine", "able": "in_der_lage", "proper": "angemessen angebracht", "sorry": "es_tut_mir_leid", "consult": "bitte_wenden_sie_sich",
    },
    "spanish": {
        "source": "documento pagina texto pasaje informe seccion", "info": "informacion datos cifras cifra respuesta", "that": "esta esa la dicha", "place": "en", "negation": "no", "none": "ninguna ningun", "nothing": "nada",
        "hold": "contiene dice menciona indica ofrece da incluye aporta responde proporciona especifica habla", "enough": "suficiente bastante suficientes", "missing": "no falta", "able": "puedo podemos debo estoy_en_condiciones me_es_posible",
        "proper": "apropiado adecuado oportuno", "sorry": "lo_siento prefiero_no debo_declinar debo_rechazar debo_abstenerme", "consult": "consulte_a",
    },
    "italian": {
        "source": "documento pagina testo passo rapporto sezione", "info": "informazione informazioni dati cifre cifra risposta", "that": "questa tale l la", "place": "nel nella", "negation": "non", "none": "nessuna nessun", "nothing": "nulla niente",
        "hold": "contiene dice menziona indica offre fornisce riporta risponde precisa parla", "enough": "abbastanza sufficienti sufficiente", "missing": "non manca", "able": "posso possiamo devo sono_in_grado mi_e_possibile",
        "proper": "opportuno appropriato corretto", "sorry": "mi_dispiace mi_scuso preferisco_non preferirei_non devo_declinare devo_rifiutare devo_astenermi", "consult": "consultate si_rivolga",
    },
    "portuguese": {
        "source": "documento pagina texto passagem relatorio secao seccao", "info": "informacao informacoes dados numeros resposta", "that": "esta essa a tal", "place": "no na", "negation": "nao", "none": "nenhuma nenhum", "nothing": "nada",
        "hold": "contem diz menciona indica oferece da inclui fornece responde refere especifica fala", "enough": "suficiente suficientes bastante", "missing": "nao falta", "able": "posso podemos devo consigo estou_em_condicoes me_e_possivel",
        "proper": "apropriado adequado oportuno", "sorry": "lamento desculpe prefiro_nao preferia_nao tenho_de_recusar tenho_de_declinar devo_recusar devo_declinar", "consult": "consulte_um",
    },
}


class Grammar:
    """The rules with one language's terminals."""

    def __init__(self, terminals: dict[str, str]):
        self.first: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
        for symbol, values in terminals.items():
            for phrase in (tuple(x.split("_")) for x in values.split()):
                self.first.setdefault(phrase[0], []).append((symbol, phrase))

    def accepts(self, sentence: list[str]) -> bool:
        """Whether the sentence holds the symbol refusal."""
        spans: dict[str, set[tuple[int, int]]] = {}
        for at, word in enumerate(sentence):
            for symbol, phrase in self.first.get(word, ()):
                if len(phrase) == 1 or tuple(sentence[at : at + len(phrase)]) == phrase:
                    spans.setdefault(symbol, set()).add((at, at + len(phrase)))
        if not spans:
            return False
        spans["^"] = {(0, 0)}
        for symbol in reversed(RULES):  # no rule uses one that stands before it
            own: set[tuple[int, int]] = set()
            for production in RULES[symbol]:
                own |= _joined(production, spans)
            if own:
                spans.setdefault(symbol, set()).update(own)
        return bool(spans.get("refusal"))


def _joined(production: str, spans: dict[str, set[tuple[int, int]]]) -> set[tuple[int, int]]:
    parts = production.split()
    if any(p not in spans for p in parts if p not in ("...", "~")):
        return set()
    found, gap = spans[parts[0]], 0
    for part in parts[1:]:
        if part in ("...", "~"):
            gap = 1 << 30 if part == "..." else 3
            continue
        if gap > 3:  # of all spans before, the one that ends first leaves most room
            end, begin = min((e, b) for b, e in found) if found else (0, 0)
            found = {(begin, e) for b, e in spans[part] if b >= end} if found else set()
        else:
            found = {(begin, e) for begin, end in found for b, e in spans[part] if 0 <= b - end <= gap}
        gap = 0
        if not found:
            return found
    return found


@lru_cache(maxsize=1)
def _grammars() -> list[Grammar]:
    return [Grammar(x) for x in TERMINALS.values()]


@lru_cache(maxsize=100_000)
def says_no(sentence: str) -> bool:
    """Whether a folded sentence is a refusal in any of the languages."""
    text = sentence
    for pattern, value in _CONTRACTED:
        text = pattern.sub(value, text)
    words = _WORD.findall(text)
    return any(grammar.accepts(words) for grammar in _grammars())
