"""Template residue and error-page text.

A multi-pattern automaton finds multilingual phrases of error pages, filler and
demands for scripts in the body of each document; unfilled fields and the output
of failed renderings are found beside them.  A sentence that holds one counts as
covered, and a document is residue when the covered part outweighs the prose
that is left.  Sentences that mention such things among others leave most of
their document uncovered.

Null and empty texts, and texts without a body, are never residue.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.boilerplate import BODY, Templates, by_site, demote_scripts, fit_templates, scripts_notice, site
from siftwell.llm.structure import COMMON, VOWELS

# Phrases of error pages, filler and demands for scripts, lower case.
PHRASES = (
    # errors and access
    "page could not be found", "page you asked for does not exist", "does not exist or was moved", "page not found", "cannot find what you are looking for", "the server had an internal problem",
    "access denied.", "access denied", "you do not have permission to open this page", "too many requests.", "try again later.", "bad gateway",
    "upstream host sent no reply", "page unavailable", "not allowed to see this", "service unavailable", "error establishing a connection", "your session has ended", "session has expired",
    "this content is not available in your region", "this domain is parked", "the listing has expired", "this account has been suspended",
    "error code:", "nothing here.", "not found.", "item was removed by its owner", "internal server error", "forbidden.", "this page no longer exists",
    "failed to open stream", "uncaught exception", "stack trace:", "gateway timeout", "temporarily unavailable", "connection timed out",
    "die seite wurde nicht gefunden", "seite nicht gefunden", "zugriff verweigert", "diese seite existiert nicht mehr", "ihre sitzung ist abgelaufen",
    "der server antwortet nicht", "interner serverfehler", "page introuvable", "accès refusé", "acces refuse", "cette page n'existe plus",
    "votre session a expiré", "le serveur ne répond pas", "página no encontrada", "acceso denegado", "esta página ya no existe", "su sesión ha caducado",
    "el servidor no responde", "página não encontrada", "acesso negado", "esta página já não existe", "a sua sessão expirou", "o servidor não responde",
    "pagina non trovata", "accesso negato", "questa pagina non esiste più", "la sessione è scaduta", "il server non risponde", "страница не найдена",
    "доступ запрещён", "доступ запрещен", "эта страница больше не существует", "сеанс истёк", "ваш сеанс истёк", "сервер не отвечает",
    # scripts and browser checks
    "please enable javascript", "enable javascript", "requires javascript", "switch on javascript", "switch them on and reload", "turn js on", "then press refresh",
    "before the content can load", "and reload the page", "for full use of this site", "browser must run scripts", "allow scripts",
    "turn on scripts in your browser", "out of date or blocks scripts", "content cannot be shown", "checking your browser", "verify you are human",
    "use a newer browser", "disable your ad blocker", "javascript im browser einschalten", "werden skripte benötigt", "veuillez activer javascript",
    "a besoin des scripts", "active javascript para", "necesita scripts", "ative o javascript", "precisa de scripts", "attiva javascript", "attivare javascript",
    "ha bisogno di script", "richiede script", "включите javascript", "нужны скрипты", "требуются скрипты", "необходимы скрипты",
    # filler
    "text goes here", "this is sample text", "replace this paragraph with your own words", "just another test post", "test test test",
    "add a short summary of your product", "todo: write", "tbd.", "edit this block in the page builder", "asdf asdf", "qwer qwer", "[description to follow]",
    "description to follow", "sample title", "insert title", "your headline goes here", "lorem ipsum", "ipsum lorem", "hier steht ein blindtext", "dies ist ein beispieltext",
    "ceci est un texte d'exemple", "texto de ejemplo", "texto de exemplo", "testo di esempio", "insert text here", "click here to edit", "coming soon.",
)
# What a failed rendering leaves behind.
BROKEN = frozenset("undefined null nan none n/a array #ref! &nbsp; &nbsp [object object] #value! #n/a nil".split())
# Words and signs without which no rule below can hold.
TRACES = ("{", "<", "%", "@", "_", "$", "#", "[", "&nbsp", "undefined", "null", "nan", "none", "n/a", "array", "error", "fehler", "erreur", "errore", "erro", "ошибка", "oops", "whoops", "sorry", "ref", "err")
CODED = re.compile(r"(?m)^[ \t]*[45]\d\d\s")
FILLER = ("ipsum", "headline", "title", "text", "words", "summary")
FIELD = re.compile(
    r"\{\{[^{}\n]{1,40}\}\}|\{%[^%\n]{1,40}%\}|\$\{[^{}\n]{1,40}\}|<%=?[^%\n]{1,40}%>|<<[\w. ]{1,40}>>|%%[\w.]{1,40}%%|@@[\w.]{1,40}@@|__[a-z][\w.]{0,40}?__|\[\[[^\[\]\n]{1,40}\]\]|\[[a-z]+(?:[_.][a-z]+)+\]|\[(?:date|city|company|name|headline|body|author|product)\]|\{[a-zA-Z][\w.]{1,30}\}|#[A-Za-z]+(?:[_.][a-z]+)*#",
    re.I,
)
CODE = re.compile(r"^(?:error code|ref|err(?:or)?|fehler|erreur|errore|erro|ошибка)\b[ :#]*[\w\-/ ]{0,40}\d", re.I)
STATUS = re.compile(r"^\W*(?:error|fehler|erreur|errore|erro|ошибка)\s+[45]\d\d\b|^\s*[45]\d\d\s+[:\-–]|^\s*(?:oops|whoops|sorry)[!.,]", re.I)
ABOUT = re.compile(r"\b(?:guide|readers|how to|was used|were used|such as|stands for|until|is what)\b", re.I)
PARTS = re.compile(r"(?<=[.!?…])\s+(?=\S)")
PROSE_END = re.compile(r"[.!?…;:]['\")»“”\s]*$")


@lru_cache(1)
def automaton():
    a = ahocorasick.Automaton()
    for p in PHRASES:
        a.add_word(p, p)
    a.make_automaton()
    return a


@lru_cache(1)
def traces():
    a = ahocorasick.Automaton()
    for p in (*PHRASES, *TRACES):
        a.add_word(p, len(p) if p.isalpha() and p in TRACES else 0)
    a.make_automaton()
    return a


def traced(low: str) -> bool:
    """Whether a text holds any phrase or sign, or one of the words by itself."""
    for end, n in traces().iter(low):
        if not n or not (low[end - n : end - n + 1].isalpha() if end >= n else False) and not low[end + 1 : end + 2].isalpha():
            return True
    return False


def unfilled(line: str) -> bool:
    """Whether a line is little else than unfilled fields."""
    if not any(c in line for c in "{<%@_[$#"):
        return False
    found = FIELD.findall(line)
    return len(found) >= 2 and len(re.findall(r"\w+", FIELD.sub(" ", line))) <= 10


def _covered(sentence: str, hit: bool) -> bool:
    if hit and not (ABOUT.search(sentence) and len(sentence) > 40):
        return True
    if STATUS.search(sentence) and not ABOUT.search(sentence):
        return True
    if CODE.search(sentence.strip()):
        return True
    if any(c in sentence for c in "{<%@_[$#"):
        found = FIELD.findall(sentence)
        if found:
            rest = FIELD.sub(" ", sentence)
            n = len(re.findall(r"\w+", rest))
            if len(found) >= 2 or n <= 2 or len(found) * 3 >= n:
                return True
    return False


def _broken(line: str) -> bool:
    if line[:9].lower().split(None, 1)[0].strip(".,;()") not in BROKEN and not line.startswith("[o"):
        return False
    t = line.lower().replace("[object object]", "[object").split()
    return bool(t) and sum(x.strip(".,;()") in BROKEN or x == "[object" or x.strip("()").isdigit() for x in t) >= 0.8 * len(t) and any(not x.strip("()").isdigit() for x in t)


def _pseudo(sentence: str) -> bool:
    """Filler in no language: a sentence of many different words, none of them a function word."""
    w = sentence.lower().rstrip(".!?… ").split()
    if len(w) < 8 or not COMMON.isdisjoint(w) or 4 * len(set(w)) <= len(w) or sum(map(str.isalpha, w)) * 10 < 8 * len(w):
        return False
    return sum(bool(VOWELS.search(x)) for x in w) * 10 >= 9 * len(w) and len(VOWELS.findall(sentence)) * 4 > len(sentence) - len(w)


def residue(lines: list[str]) -> tuple[int, int]:
    """Covered characters and characters of prose that nothing covers, of the lines of a body.

    A line of unfilled fields makes a document residue whatever stands beside it.
    """
    auto = automaton()
    whole = "\n".join(lines)
    low = whole.lower()
    foreign = any([COMMON.isdisjoint(x) and len(x) > 7 for x in map(str.split, low.split("\n"))])  # a line without a function word of any language
    if not traced(low) and not CODED.search(whole) and not foreign:
        return 0, len(whole)
    covered = open_prose = fields = 0
    left: list[str] = []
    filler = False
    for raw in lines:
        s = raw.replace("\xa0", " ").strip()
        if not s:
            continue
        low = s.lower()
        if _broken(s):
            covered += len(s)
            continue
        fields += unfilled(s)
        ends = [e for e, _ in auto.iter(low)]  # lower-casing keeps the length but for a few letters
        start = 0
        for part in PARTS.split(s):
            at = s.find(part, start)
            stop = at + len(part)
            hit = any(at <= e < stop for e in ends)
            if _covered(part, hit) or foreign and PROSE_END.search(part) and _pseudo(part):
                covered += len(part)
                filler |= hit and any(x in low[at:stop] for x in FILLER)
            else:
                left.append(part)
            start = stop
    if not covered:
        return 0, sum(map(len, left))
    for p in left:
        w = p.lower().split()
        if filler and not any(x.strip(".,:;!?") in COMMON for x in w):
            covered += len(p)
        elif len(w) > 7 or PROSE_END.search(p) and len(w) > 3 or sum(map(str.isdigit, p)) * 3 > len(p):
            open_prose += len(p)
    return (max(covered, open_prose) if fields else covered), open_prose


def is_residue(lines: list[str]) -> bool:
    covered, rest = residue(lines)
    return covered > 0 and covered >= rest


LEAST = 0.5  # share of a body that phrases must cover


def coverage(lines: list[str]) -> float:
    """Share of the characters of a body in sentences that hold a phrase of the automaton."""
    covered = whole = 0
    for raw in lines:
        s = raw.replace("\xa0", " ").strip()
        whole += len(s)
        ends = [e for e, _ in automaton().iter(s.lower())]
        at = 0
        for part in PARTS.split(s) if ends else ():
            start = s.find(part, at)
            at = start + len(part)
            covered += len(part) if any(start <= e < at for e in ends) else 0
    return covered / whole if whole else 0.0


def body_of(text: str | None, host: str | None, templates: Templates) -> list[tuple[int, str]]:
    """Numbered body lines."""
    if not text:
        return []
    lines = text.split("\n")
    classes = demote_scripts(lines, templates.classify(text, host), scripts_notice)
    return [(i, lines[i - 1]) for i, c in enumerate(classes, 1) if c >= BODY]


def scored(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, ``covered`` and ``open_prose`` of the documents, the characters of residue and of other prose."""

    def run(pdf, ts, _):
        rows = [(d, *(residue([x for _, x in body_of(text, host, t)]) if text else (0, 0))) for d, text, host, t in zip(pdf["doc_id"], pdf["text"], pdf["site"], ts)]
        return pd.DataFrame(rows, columns=["doc_id", "covered", "open_prose"])

    rows = documents.select("doc_id", "text", site(F.col("url")).alias("site"))
    return by_site(rows, fit_templates(pages), run, "doc_id long, covered int, open_prose int")


def covered_documents(documents: DataFrame, pages: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id of the documents whose body the automaton's phrases cover by ``least`` or more; no rule beside it."""

    def run(pdf, ts, _):
        rows = [(d,) for d, text, host, t in zip(pdf["doc_id"], pdf["text"], pdf["site"], ts) if text and coverage([x for _, x in body_of(text, host, t)]) >= least]
        return pd.DataFrame(rows, columns=["doc_id"]).astype({"doc_id": "int64"})

    rows = documents.select("doc_id", "text", site(F.col("url")).alias("site"))
    return by_site(rows, fit_templates(pages), run, "doc_id long")


def residue_documents(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id of the documents that are residue."""
    rows = scored(documents.select("doc_id", "text", "url"), pages)
    return rows.where((F.col("covered") > 0) & (F.col("covered") >= F.col("open_prose"))).select("doc_id")


def without_residue(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """The documents that are not residue."""
    rows = scored(documents.select("doc_id", "text", "url"), pages)
    kept = rows.where((F.col("covered") == 0) | (F.col("covered") < F.col("open_prose"))).select("doc_id")
    return documents.join(kept, "doc_id", "left_semi")
