"""Candidates of personal information in free text, and what speaks for them.

Candidate spans of each kind come from shapes (addresses of mail and network,
numbers, streets) and from words that are, or are built like, names.  Every
candidate is a binary variable: its own potential adds the weights of what it is
made of and of the words around it (WEIGHTS, parameters); neighbours that overlap
exclude each other; and skip edges join distant candidates that repeat a token,
or have the same shape.  Loopy message passing gives the marginals from which
the token field of ``chain`` is fitted.

The list of names is incomplete: surnames are also recognised by parts that
several listed surnames share.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

KINDS = ("email", "phone", "id", "address", "name", "ip")
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id": "[ID]", "address": "[ADDRESS]", "name": "[NAME]", "ip": "[IP]"}

AT = r"\s?(?:[@＠]|[(\[{]\s?at\s?[)\]}])\s?"
DOT = r"(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?)"
EMAIL = re.compile(rf"[\w.+%\-]*[\w+%\-]{AT}[\w\-]+(?:{DOT}[\w\-]+)*{DOT}[^\W\d_]{{2,}}", re.I)
IPV4 = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:/\d{1,2}\b|:\d{2,5}\b)?(?![\d]|\.\d)")
IPV6 = re.compile(r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){2,7}(?::?[0-9a-fA-F]{1,4}|:)(?::[0-9a-fA-F]{1,4})*(?![\w:])|(?<![\w:])[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4})*::(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4})*)?(?![\w:])")
PHONES = (
    (re.compile(r"(?<![\w.])\+\d{1,4}[ .\-]?(?:\(0\)|\(\d{1,4}\))?[ .\-]?\d[\d .\-/]{5,14}\d(?![\w])"), "strong"),
    (re.compile(r"(?<![\w.])\(\d{2,5}\)[ \-]?\d{3,4}[ .\-]\d{3,4}(?![\w])"), "strong"),
    (re.compile(r"(?<![\w.\-/])\d{3}([.\-])\d{3}\1\d{4}(?![\w]|[.\-]\d)"), "strong"),
    (re.compile(r"(?<![\w.\-/])00\d{2} \d{2,4} \d{5,7}(?!\w)"), "strong"),
    (re.compile(r"(?<![\w.\-/])0\d{1,4}(?: \d{2}){4}(?! ?\d)"), "strong"),
    (re.compile(r"(?<![\w.\-/])(?<![0-9a-f]{4} )0\d{2,4}[ /\-]\d{3,5}[ \-]\d{2,4}(?![\w\-])(?! [0-9a-f]{4}\b)"), "strong"),
    (re.compile(r"(?<![\w.\-/])0\d{2,4}/\d{5,8}(?![\w\-])"), "strong"),
    (re.compile(r"(?<![\w.\-/])1[2-9]\d{9}(?![\w\-.])"), "fair"),
    (re.compile(r"(?<![\w.\-/])\d{3}-\d{4}(?![\w\-])"), "weak"),
    (re.compile(r"(?<![\w.\-/])\d{10,12}(?![\w\-])"), "weak"),
)
IDS = (
    (re.compile(r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])"), "strong"),
    (re.compile(r"(?<![\w\-])[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z](?!\w)"), "strong"),
    (re.compile(r"(?<![\w\-])\d{8}[A-Z](?![\w\-])"), "strong"),
    (re.compile(r"(?<![\w\-])[A-Z]{1,2}\d{7}(?![\w\-])"), "strong"),
    (re.compile(r"(?<![\w.\-])\d{2}\.\d{2}\.\d{2}-\d{3}\.\d{2}(?![\w])"), "strong"),
    (re.compile(r"(?<![\w.\-+])(?<!\d )\d{3} \d{3} \d{3} \d{2}(?! ?\d)(?![\w])"), "strong"),
    (re.compile(r"(?<![\w.\-+/=])9\d{8}(?![\w\-.,]*\d)"), "fair"),
    (re.compile(r"(?<![\w.\-+/=])[0-8]\d{8}(?![\w\-.,]*\d)"), "weak"),
)
UPPER = "A-ZÀ-ÖØ-ÞА-ЯЁ"
STREET_EN = r"(?:Street|St\.|Road|Rd\.?|Lane|Avenue|Ave\.?|Blvd\.?|Boulevard|Court|Close|Drive|Terrace|Square|Crescent|Place|Gardens)"
ADDRESSES = (
    re.compile(rf"(?:(?:Flat|Apt\.?|Unit) \d+\w?, )?\d+\w? (?:(?:[NSEW]\.|North|South|East|West|Old|New|Upper|Lower) )?(?:[{UPPER}][\w'’]+ ){{1,2}}{STREET_EN}(?![\w])", re.I),
    re.compile(r"\bP\.? ?O\.? ?Box \d+|\b(?:Postfach|Apartado(?: de correos)?|Casella postale|Caixa postal|Boîte postale|B\.?P\.|а/я) \d+", re.I),
    re.compile(r"\b\w+(?:straße|strasse|str\.|weg|platz|allee|gasse) \d+ ?[a-z]?\b|\b(?:Am|An der|Auf dem|Im|Zum|Zur) \w+(?:berg|tor|markt|bach|feld|hof|ufer|see|wald|garten) \d+ ?[a-z]?\b", re.I),
    re.compile(r"\b\d+(?: (?:bis|ter))?,? (?:rue|avenue|chemin|boulevard|place|allée|impasse|quai) (?:de la |des |du |de |d['’])?\w+", re.I),
    re.compile(r"\b(?:Calle|C/|Avenida|Plaza|Paseo|Rua|Travessa|Praça|Via|Viale|Piazza|Corso|Largo) (?:de la |de |da |do |di |del |dei )?\w+,? (?:n\.? ?º?\.? ?)?\d+", re.I),
    re.compile(r"\b(?:Calle|Rua|Via|Avenida) (?:de la |de |da |do |di |del )?\w+, n\.", re.I),
    re.compile(r"(?:\bул\.|\bулица|\bпр\.|\bпроспект) [\w\-]+,? (?:д\. ?)?\d+", re.I),
)
# What a line with an address holds, by the pattern it calls for.
HINTS = {
    0: "street| st.| st |road| rd|lane|avenue| ave|blvd|boulevard|court|close|drive|terrace|square|crescent|place|gardens",
    1: " box |postfach|apartado|casella|caixa|boîte|b.p.| bp |а/я", 2: "straße|strasse|str. |weg |platz |allee |gasse |am |im |zum |zur |an der |auf dem ",
    3: "rue |avenue |chemin |boulevard |place |allée |impasse |quai ", 4: "calle |c/|avenida |plaza |paseo |rua |travessa |praça |via |viale |piazza |corso |largo ",
    5: "calle |rua |via |avenida ", 6: "ул.|улица|пр.|проспект",
}

# Words around a span that speak for a kind.
PHONE_CUE = re.compile(r"(?:\b(?:tel|tél|telefon|telephone|phone|fax|mobil|móvil|mobile|portable|cell|call|ring|line|llame|appelez|rufen|chiam\w*|ligue|телефон|тел|m|ext)\b[^\w]{0,4}(?:\w+ ){0,4}|☎ ?)$", re.I)
ID_CUE = re.compile(r"\b(?:ssn|id|identity|identidad|identité|identidade|identità|passport|passeport|pasaporte|passaporto|reisepass|ausweis\w*|steuer\w*|tax\w*|fiscal\w*|insurance|versicherung\w*|dni|nif|nie|national|паспорт|инн|снилс)\b\W{0,3}(?:\w+\.?\W{1,2}){0,3}$", re.I)
NOT_ID = re.compile(r"\b(?:order|part|isbn|release|version|serial|invoice|item|sku|bestell\w*|commande|pedido|pages?|took|ratio|between|years?|route|volume|model|part number|ref|error code)\b\W{0,3}(?:\w+\.?\W{1,2}){0,2}$", re.I)
NOT_IP = re.compile(r"\b(?:release|version|v|ver|build|firmware|sensor|section|kapitel|chapter)\W{0,3}$", re.I)
NAME_CUE = re.compile(r"(?:\b(?:by|von|par|por|da|di|thanks to|dank an|merci à|gracias a|grazie a|obrigad[oa] a|given by|kam von|parole était à|fue de|met|signed|wishes|grüßen|cordialement|saludo|saluti|cumprimentos|regards|neighbour|author|autor|auteur|autore|with)\b[,:]?\s+|[—–(]\s?)(?:(?:Mrs?|Ms|Dr|Herr|Frau|Mme|Sra?|Sig)\.? )?$", re.I)
BYLINE = re.compile(r"(?:posted|veröffentlicht|publi\w+|pubblicato|опубликовано)\W+[\d./\-]+\W+(?:by|von|par|por|da|автор)\s+$", re.I)
TITLE = re.compile(r"\b(?:Mrs?|Ms|Dr|Herr|Frau|Mme|Sra?|Sig(?:ra)?|Prof)\.? (?:(?:van|de|al-|von|di|da) ?)?$")
COMPANY = re.compile(r"^(?:,? ?(?:&|und|and|et|y|e) (?:Sons|Söhne|Co|Partner|Fils|Hijos|Bros)|,? ?(?:Ltd|GmbH|Inc|LLC|AG|S\.A|SARL|S\.L|Lda|SpA|S\.p\.A|plc|Corp|Group|Holding))", re.I)
PLACE_AFTER = re.compile(rf"^,? ?(?:{STREET_EN}|Bridge|Hall|Park|Valley|River|Hill|Station|School|County|Church|Farm|Museum|Hotel)\b")
PLACE_BEFORE = re.compile(r"(?:\b(?:Via|Viale|Piazza|Calle|Rua|rue|avenue|chemin|ул\.|near|in|at|from|to|of) (?:de la |de |du |des |da |di )?)$", re.I)
SAID = re.compile(r"^,? (?:said|had|has|wrote|called|thinks|told|für die bilder|for the pictures|pour les photos|por las fotos|per le foto|pelas fotos)\b", re.I)

# Log-odds that each observation adds.
WEIGHTS = {
    "email": 4.0, "ip": 2.5, "ip_version": -6.0, "phone_strong": 2.5, "phone_fair": 0.6, "phone_weak": -2.2, "phone_cue": 3.0, "id_strong": 2.2, "id_fair": 0.3,
    "id_weak": -2.0, "id_cue": 3.5, "not_id": -5.0, "address": 3.0, "full": 2.2, "given": -0.6, "surname": 0.7, "built": 0.3, "cue": 2.2, "byline": 2.5, "title": 3.0,
    "said": 1.6, "company": -6.0, "place": -5.0, "lower": -4.0, "lower_byline": 5.5, "alone_start": -1.2, "repeat": 1.1, "shape": 0.25, "exclude": -4.0,
}
ROUNDS = 8


class Names:
    """Listed names, and surnames built from parts that several listed ones share."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.given = {n.strip().lower() for n, k in rows if n and n.strip() and k == "given"}
        self.surname = {n.strip().lower() for n, k in rows if n and n.strip() and k != "given"}
        heads, tails = Counter(), Counter()
        for n in self.surname:
            for i in range(3, len(n) - 2):
                heads[n[:i]] += 1
                tails[n[i:]] += 1
        self.heads = {x for x, c in heads.items() if c > 2}
        self.tails = {x for x, c in tails.items() if c > 2}
        self.kinds: dict[str, int] = {}

    def kind(self, token: str) -> int:
        """0 no name, 1 given, 2 surname, 3 built like a surname; of a raw token."""
        k = self.kinds.get(token)
        if k is None:
            if len(self.kinds) > 300_000:
                self.kinds.clear()
            core = re.sub(r"^[^\w]+|[^\w]+$", "", token).lower()
            k = 0
            for part in re.split(r"[-'’]", core) if core else ():
                k = max(k, 2 if part in self.surname else 1 if part in self.given else 3 if self._built(part) else 0)
            self.kinds[token] = k
        return k

    def _built(self, w: str) -> bool:
        return len(w) > 5 and any(w[:i] in self.heads and w[i:] in self.tails for i in range(3, len(w) - 2))


NAME_TOKEN = re.compile(rf"[{UPPER}][\w'’]*(?:-(?:[{UPPER}]|[a-z])[\w'’]*)*\.?|(?:van|de|von|di|da|del|der)(?= [{UPPER}])|al-[{UPPER}]\w*|[OD]['’][{UPPER}]\w*")
PARTICLE = {"van", "de", "von", "di", "da", "del", "der"}
TOKEN = re.compile(r"\S+")


class Tagger:
    """Finds the spans of personal information in a text."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.names = Names(rows)

    def _names(self, text: str, taken: list[tuple[int, int]]) -> list[tuple]:
        out = []
        kind = self.names.kind
        kinds = self.names.kinds
        tokens = text.split()
        if not any([k if k is not None else kind(t) for k, t in zip(map(kinds.get, tokens), tokens)]):
            return []
        for line_at, line in _lines(text):
            tokens = line.split()
            if not any([k if k is not None else kind(t) for k, t in zip(map(kinds.get, tokens), tokens)]):
                continue
            spans = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(line)]
            i = 0
            while i < len(spans):
                if not kind(spans[i][2]):
                    i += 1
                    continue
                a = b = i
                # to the left: a given name or a particle that is not listed
                while a > 0 and a > i - 4 and self._joins(spans[a - 1][2], spans[a][2]):
                    a -= 1
                while b + 1 < len(spans) and b < i + 4 and self._follows(spans[b][2], spans[b + 1][2]):
                    b += 1
                out.append((line_at + spans[a][0], line_at + spans[b][1], line, spans[a][0], spans[b][1], [s[2] for s in spans[a : b + 1]]))
                i = b + 1
        found = []
        for start, end, line, x, y, toks in out:
            if any(s < end and start < e for s, e in taken):
                continue
            found.append((start, end, "name", self._name_score(line, x, y, toks), tuple(sorted({re.sub(r"^\W+|\W+$", "", t).lower() for t in toks if self.names.kind(t)}))))
        return found

    def _joins(self, left: str, token: str) -> bool:
        if left[-1] in ",.;:!?)»”" and not re.fullmatch(rf"[{UPPER}]\.", left) and not (left.endswith(",") and self.names.kind(left) > 1 and self.names.kind(token) == 1):
            return False
        core = left.strip("(—„\"'“«")
        return bool(core) and (core in PARTICLE or bool(self.names.kind(core)) or re.fullmatch(rf"[{UPPER}]\.", core) is not None or (core[0].isupper() and core.isalpha() and len(core) > 2 and core.lower() not in STOP and self.names.kind(token) > 1))

    def _follows(self, token: str, right: str) -> bool:
        if token[-1] in ".;:!?)»”" and not re.fullmatch(rf"[{UPPER}]\.", token):
            return False
        if token.endswith(","):
            return self.names.kind(token) > 1 and self.names.kind(right) == 1 or self.names.kind(token) > 1 and right[:1].isupper() and right.rstrip(".,!").isalpha() and right.rstrip(".,!").lower() not in STOP and len(right) > 3
        core = right.strip("(")
        return core in PARTICLE or bool(self.names.kind(core)) or re.fullmatch(rf"[{UPPER}]\.[,.]?", core) is not None

    def _name_score(self, line: str, x: int, y: int, toks: list[str]) -> float:
        w = WEIGHTS
        kinds = [self.names.kind(t) for t in toks]
        before, after = line[max(0, x - 40) : x], line[y : y + 24]
        if toks[-1][-1:] in ",.;:!?":
            after = toks[-1][-1] + after
        real = [t for t in toks if t.lower() not in PARTICLE]
        s = -0.4
        if len(real) > 1 and any(k > 1 for k in kinds):
            s += w["full"]
        if len(real) > 1 and kinds[0] == 1 and any(re.fullmatch(rf"[{UPPER}]\.[,.]?", t) for t in toks[1:]):
            s += w["full"] + 0.8
        s += sum({1: w["given"] if len(real) == 1 else 0.6, 2: w["surname"], 3: w["built"], 0: 0.0}[k] for k in kinds)
        if re.match(r"^\s*(?:[-'’])", after) or COMPANY.match(after.lstrip(".,")):
            s += w["company"] if COMPANY.match(after.lstrip(".,")) else 0
        first = re.sub(r"^\W+", "", toks[0])
        lower = first[:1].islower() and first.lower() not in PARTICLE
        byline = BYLINE.search(before)
        if byline:
            s += w["byline"]
            nxt = after.lstrip().split(" ")[0].rstrip(".,!:")
            if lower:
                s += w["lower_byline"]
            if not any(k > 1 for k in kinds) and nxt[:1].isupper():
                s += w["company"] / 2
        elif NAME_CUE.search(before):
            s += w["cue"]
        if TITLE.search(before):
            s += w["title"]
        if SAID.match(after):
            s += w["said"]
        if lower:
            s += w["lower"]
        if PLACE_AFTER.match(after) and toks[-1][-1:] not in ".,;:!?":
            s += w["place"]
        if PLACE_BEFORE.search(before) and len(real) == 1:
            s += w["place"] / 2
        if len(real) == 1 and kinds[0] == 1 and not TITLE.search(before):
            s += w["alone_start"]
        return s

    def candidates(self, text: str) -> list[tuple]:
        """(start, end, kind, potential, keys) of every candidate; keys are what skip edges join."""
        w = WEIGHTS
        c: list[tuple] = []
        low = text.lower()
        if "@" in text or "＠" in text or "(at" in low or "[at" in low or "{at" in low or "( at" in low:
            for m in EMAIL.finditer(text):
                c.append((m.start(), m.end(), "email", w["email"], (m[0].lower(),)))
        for m in IPV4.finditer(text) if QUAD.search(text) else ():
            c.append((m.start(), m.end(), "ip", w["ip"] + (w["ip_version"] if NOT_IP.search(text[max(0, m.start() - 16) : m.start()]) else 0), (m[0],)))
        if "::" in text or text.count(":") > 6 and COLONS.search(text):
            for m in IPV6.finditer(text):
                if any(x in "abcdefABCDEF" for x in m[0]) or "::" in m[0]:
                    c.append((m.start(), m.end(), "ip", w["ip"] if "::" in m[0] or m[0].count(":") == 7 else -1.0, (m[0],)))
        for region in LONG_NUMBER.finditer(text):
            lo, hi = max(0, region.start() - 6), min(len(text), region.end() + 3)
            for kind, patterns in NUMBERED:
                for pattern, how in patterns:
                    for m in pattern.finditer(text, lo, min(len(text), hi + 8)):
                        a = m.start()
                        left = _left(text, a)
                        if kind == "phone":
                            s = w["phone_" + how] + (w["phone_cue"] if PHONE_CUE.search(left) else 0) - (2.5 if ID_CUE.search(left) else 0)
                        else:
                            s = w["id_" + how] + (w["id_cue"] if ID_CUE.search(left) else 0) - (2.0 if PHONE_CUE.search(left) else 0)
                        s += w["not_id"] if NOT_ID.search(left) else 0
                        c.append((a, m.end(), kind, s, (re.sub(r"\W", "", m[0]), "shape:" + SHAPE.sub("0", m[0]))))
        flat = low.replace("\n", " ") + " "
        if len(low) == len(text) and DIGIT.search(text) or "n." in low:
            for end, ats in _hints().iter(flat):
                lo = max(text.rfind("\n", 0, end) + 1, end - 52)
                hi = text.find("\n", end)
                hi = min(len(text) if hi < 0 else hi, end + 46)
                if DIGIT.search(text, lo, hi) or text.find("n.", lo, hi) >= 0:
                    for at in ats:
                        for m in ADDRESSES[at].finditer(text, lo, hi):
                            c.append((m.start(), m.end(), "address", w["address"], (m[0].lower(),)))
        taken = [(a, b) for a, b, k, s, _ in c if k in ("email", "address") and s > 0]
        return list(dict.fromkeys(c)) + self._names(text, taken)

    def spans(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, kind, marginal) of every candidate with a marginal above one half."""
        c = self.candidates(text)
        p = marginals(c) if c else []
        return [(a, b, k, q) for (a, b, k, _, _), q in zip(c, p) if q > 0.5]


@lru_cache(1)
def _hints():
    a = ahocorasick.Automaton()
    by: dict = defaultdict(set)
    for at, words in HINTS.items():
        for x in words.split("|"):
            by[x].add(at)
    for x, at in by.items():
        a.add_word(x, tuple(at))
    a.make_automaton()
    return a


SHAPE = DIGIT = re.compile(r"\d")
QUAD = re.compile(r"\d\.\d{1,3}\.\d{1,3}\.\d")
COLONS = re.compile(r"(?:[0-9a-fA-F]{1,4}:){4}")
LONG_NUMBER = re.compile(r"\d(?:[ .\-/()]{0,3}\d){5,}")
NUMBERED = (("phone", PHONES), ("id", IDS))
# Capitalised words before a surname that are no given name.
STOP = frozenset("the a an this that these our every by and but from with on in at to of for mr mrs ms dr herr frau mme sr sra sig der die das den ein eine von am im le la les un une par el los las por da di il lo route via calle rua rue posted best many signed questions meet met".split())


def _left(text: str, at: int) -> str:
    left = text[max(0, at - 44) : at]
    return left[left.rfind("\n") + 1 :]


def _lines(text: str):
    at = 0
    for line in text.split("\n"):
        if line:
            yield at, line
        at += len(line) + 1


def marginals(c: list[tuple], rounds: int = ROUNDS) -> list[float]:
    """Marginals of the candidates by loopy sum-product over exclusions and skip edges."""
    n = len(c)
    edges: list[tuple[int, int, float]] = []
    order = sorted(range(n), key=lambda i: (c[i][0], c[i][1]))
    for x, i in enumerate(order):
        for j in order[x + 1 :]:
            if c[j][0] >= c[i][1]:
                break
            edges.append((i, j, 0.0))
    by: dict = defaultdict(list)
    for i, (_, _, kind, _, keys) in enumerate(c):
        for k in keys:
            by[kind, k].append(i)
    for (_, k), members in by.items():
        weight = WEIGHTS["shape"] if k.startswith("shape:") else WEIGHTS["repeat"]
        for a, b in zip(members, members[1:]):  # a chain of skips over the occurrences
            edges.append((a, b, weight))
    h = [x[3] for x in c]
    if not edges:
        return [1 / (1 + math.exp(-max(-30, min(30, x)))) for x in h]
    near: list[list[tuple[int, float, int]]] = [[] for _ in range(n)]
    for e, (a, b, _) in enumerate(edges):
        near[a].append((b, 0.0, e))
        near[b].append((a, 0.0, e))
    message: dict[tuple[int, int], float] = {(i, e): 0.0 for i in range(n) for _, _, e in near[i]}
    belief = list(h)
    for _ in range(rounds):
        new = {}
        for i in range(n):
            total = h[i] + sum(message[i, e] for _, _, e in near[i])
            for j, _, e in near[i]:
                x = max(-30.0, min(30.0, total - message[i, e]))
                w = edges[e][2]
                if w:  # agreement: likes both on, or both off
                    on, off = math.exp(w) * math.exp(x) + 1, math.exp(x) + math.exp(w)
                else:  # exclusion: hardly both on
                    on, off = math.exp(WEIGHTS["exclude"]) * math.exp(x) + 1, math.exp(x) + 1
                new[j, e] = 0.5 * message[j, e] + 0.5 * math.log(on / off)
        message = new
    for i in range(n):
        belief[i] = h[i] + sum(message[i, e] for _, _, e in near[i])
    return [1 / (1 + math.exp(-max(-30, min(30, x)))) for x in belief]


def tagger(person_names: DataFrame) -> list[tuple[str, str]]:
    """The list of names: fixed in size, collected to be shared."""
    return [(r["name"], r["kind"]) for r in person_names.select("name", "kind").collect()]


def mask(text: str, spans: list[tuple[int, int, str, float]]) -> tuple[str, dict[str, int]]:
    """The text with placeholders, and counts by kind; of overlapping spans the likelier stays."""
    kept: list[tuple[int, int, str, float]] = []
    for s in sorted(spans, key=lambda x: (-x[3], x[0])):
        if all(s[1] <= a or b <= s[0] for a, b, _, _ in kept):
            kept.append(s)
    counts = dict.fromkeys(KINDS, 0)
    for a, b, k, _ in sorted(kept, reverse=True):
        while b > a and text[b - 1] in ",;:!?)":
            b -= 1
        text = text[:a] + PLACEHOLDERS[k] + text[b:]
        counts[k] += 1
    return text, counts
