"""Structural profiles of lines.

Every body line gets two distributions: of its characters over classes and of
its tokens over kinds (function words of the line's language, other words, words
that came before, tokens no language has, numbers, symbols, list marks).  The
line belongs to the profile with the smallest Jensen-Shannon divergence, among
the prose of its language and the structures (nearest_profiles); a document is
natural prose when profiles of prose hold most of its body.  line_profiles()
tells paragraphs from headings, lists and rows for other operators, by one pool
of function words and rules for lines too short for a distribution.

Null and empty texts give zero counts and are no prose and no junk.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of English, German, French, Spanish, Portuguese, Italian and Russian.
FUNCTION_WORDS = {
    "en": "the a an of to and in that it is was for on with as at by this these our every but while because before after from or which nobody".split(),
    "de": "der die das den dem des ein eine einen einem und oder aber denn ist im in am an auf mit von zu zum für wegen trotz ohne nach vor bei sondern auch nicht nur unser jeden keine in seit".split(),
    "fr": "le la les l un une des de du d et ou mais car est en dans à au aux pour avec sans par sur chez que qui ce cette notre depuis pendant tous".split(),
    "es": "el la los las un una de del y o pero porque es en a al para con sin por sobre que este esta nuestro desde durante todos antes".split(),
    "pt": "o a os as um uma de do da dos das e ou mas porque é em no na num ao à para com sem por sobre que este esta nosso há durante todos antes".split(),
    "it": "il lo la i gli le l un una uno di del della dei delle e o ma perché è in a al alla per con senza da dai dal che questo questa nostro nella tutti prima dopo sulla".split(),
    "ru": "и в на с у к из за по от до без для не но что как это этот эта за уже после перед из-за во со потому несмотря наш".split(),
}
COMMON = frozenset(w for ws in FUNCTION_WORDS.values() for w in ws)
VOWELS = re.compile(r"[aeiouyàáâãäåèéêëìíîïòóôõöùúûüýœæаеёиоуыэюя]", re.I)
TOKEN = re.compile(r"\S+")
MARK = re.compile(r"^\s*(?:[•*+\-–>]|\d{1,3}[.):])\s+(?=\S)")
ENDS = re.compile(r"[.!?…;]['\")»“”\s]{0,6}$")
HEX = re.compile(r"^[0-9a-f]{4,}$")

CLASSES = ("lower", "upper", "digit", "space", "mark", "bracket", "separator", "symbol")
KINDS = ("function", "word", "repeated", "alien", "number", "symbol", "mark")
# Profiles: shares of character classes, then of token kinds.
PROFILES = {
    "prose": ([0.81, 0.02, 0.005, 0.14, 0.02, 0.003, 0.001, 0.001], [0.40, 0.56, 0.01, 0.0, 0.02, 0.01, 0.0]),
    "plain": ([0.83, 0.01, 0.0, 0.15, 0.005, 0.0, 0.0, 0.0], [0.28, 0.72, 0.0, 0.0, 0.0, 0.0, 0.0]),
    "loud": ([0.02, 0.80, 0.01, 0.14, 0.02, 0.003, 0.001, 0.001], [0.38, 0.58, 0.01, 0.0, 0.02, 0.01, 0.0]),
    "list": ([0.72, 0.04, 0.03, 0.15, 0.04, 0.0, 0.01, 0.02], [0.12, 0.57, 0.0, 0.0, 0.03, 0.0, 0.28]),
    "table": ([0.40, 0.03, 0.25, 0.18, 0.05, 0.02, 0.05, 0.04], [0.08, 0.25, 0.0, 0.05, 0.42, 0.20, 0.0]),
    "machine": ([0.36, 0.06, 0.34, 0.08, 0.06, 0.03, 0.06, 0.02], [0.01, 0.12, 0.0, 0.72, 0.10, 0.05, 0.0]),
    "symbols": ([0.05, 0.01, 0.01, 0.10, 0.10, 0.08, 0.25, 0.45], [0.02, 0.05, 0.0, 0.08, 0.0, 0.85, 0.0]),
    "random": ([0.85, 0.01, 0.03, 0.11, 0.0, 0.0, 0.0, 0.0], [0.0, 0.08, 0.0, 0.92, 0.0, 0.0, 0.0]),
    "stuffed": ([0.83, 0.02, 0.0, 0.15, 0.0, 0.0, 0.0, 0.0], [0.06, 0.12, 0.82, 0.0, 0.0, 0.0, 0.0]),
}
NAMES = tuple(PROFILES)
PROSE = frozenset(("prose", "plain", "loud"))


def _classes() -> np.ndarray:
    t = np.full(0x10000, 7, np.int8)
    for i in range(0x10000):
        c = chr(i)
        if c.isalpha():
            t[i] = 1 if c.isupper() else 0
        elif c.isdigit():
            t[i] = 2
        elif c.isspace():
            t[i] = 3
        elif c in ".,!?;:'\"’“”«»¿¡…-–—":
            t[i] = 4
        elif c in "()[]{}<>":
            t[i] = 5
        elif c in "|/\\_=~^+*":
            t[i] = 6
    return t


_TABLE: list = []
_P = np.array([a for a, _ in PROFILES.values()]) + 1e-3
_P /= _P.sum(1, keepdims=True)
_Q = np.array([b for _, b in PROFILES.values()]) + 1e-3
_Q /= _Q.sum(1, keepdims=True)
KIND_WEIGHT = 2.0


def char_shares(lines: list[str]) -> np.ndarray:
    """Counts of character classes of each line."""
    if not _TABLE:
        _TABLE.append(_classes())
    joined = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = _TABLE[0][np.minimum(joined, 0xFFFF)]
    at = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
    return np.bincount(at * 8 + kind, minlength=8 * len(lines)).reshape(-1, 8)


def token_kinds(line: str) -> list[int]:
    """Counts of token kinds of a line."""
    n = [0] * 7
    m = MARK.match(line)
    low = line.lower().split()
    if m:
        n[6] = 1
        low = low[len(m[0].split()) :]
    common = sum(map(COMMON.__contains__, low))
    stuffed = False
    if len(low) > 9:
        ends = ENDS.search(line[-9:])
        distinct = len(set(low) - COMMON)
        stuffed = distinct * 2 <= len(low) - common and not ends
        if len(low) > 14:
            repeats = len(low) - 1 - len(set(zip(low, low[1:])))
            stuffed |= repeats * 5 >= 2 * len(low) and not ends or repeats * 10 >= 7 * len(low)
        alpha = sum(map(str.isalpha, low))
        if not stuffed and common * 6 >= len(low) and alpha * 10 >= 7 * len(low):  # plainly sentences: the rest is told apart no further
            numbers = sum(map(str.isdigit, low))
            n[0], n[4] = common, numbers
            n[1] = len(low) - common - numbers
            return n
    for t in low:
        if t.isalpha():
            if t in COMMON:
                n[0] += 1
            elif len(t) > 3 and not VOWELS.search(t) or len(t) > 9 and len(VOWELS.findall(t)) * 5 < len(t):
                n[3] += 1
            else:
                n[1] += 1
            continue
        core = t.strip(".,!?;:'\"()[]«»“”…-–—*")
        if not core:
            n[5 if t not in "-–—" else 1] += 1
        elif core in COMMON:
            n[0] += 1
        elif core.isdigit() and len(core) < 4 or core.replace(".", "").replace(",", "").replace("%", "").replace("€", "").isdigit():
            n[4] += 1
        else:
            letters = sum(c.isalpha() for c in core)
            digits = sum(c.isdigit() for c in core)
            if digits and letters or "=" in core or digits > 3:
                n[3] += 1
            elif letters * 2 < len(core):
                n[5] += 1
            elif any(c in core for c in "'’-") or letters == len(core):
                parts = [p for p in re.split(r"['’\-]", core) if p]
                n[0 if any(p in COMMON for p in parts) else 1] += 1
            elif any(c in core for c in "|;=\\_~"):
                n[3] += 1
            else:
                n[1] += 1
    if stuffed:
        n[2], n[0], n[1] = n[0] + n[1], 0, 0
    return n


# Share of a language's own function words in its prose; the profiles of prose are those of "prose" with that share.
FUNCTION_SHARE = {"en": 0.30, "de": 0.28, "fr": 0.36, "es": 0.38, "pt": 0.36, "it": 0.34, "ru": 0.22}
_SETS = {k: frozenset(v) for k, v in FUNCTION_WORDS.items()}
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~«»“”„…–—·•¿¡’‘©→☎€£¥°§®™†‡©×"  # marks around a word
# Languages of each function word, as bits in the order of FUNCTION_WORDS.
_BITS = {w: sum(1 << i for i, ws in enumerate(_SETS.values()) if w in ws) for w in COMMON}
_LANGS = tuple(_SETS)


def language_of(cores: list[str]) -> str:
    """The language that has most of the function words among tokens (ties: the first)."""
    found = Counter([_BITS[c] for c in cores if c in _BITS]).items()
    return max(_LANGS, key=lambda k: sum(n for bits, n in found if bits >> _LANGS.index(k) & 1)) if found else _LANGS[0]


def plain_kinds(line: str) -> tuple[list[int], str]:
    """Counts of token kinds of a line, with the function words of the language that has most of them, and that language.

    A token that came before in its sentence counts as repeated, a function word
    if it stood before the same token, and every token of a sentence that came
    twice before.
    """
    n = [0] * 7
    m = MARK.match(line)
    low = line.lower().split()
    if m:
        n[6] = 1
        low = low[len(m[0].split()) :]
    cores = [t if t.isalpha() else t.strip(_EDGES) for t in low]
    lang = language_of(cores)
    own, at, said = _SETS[lang], 0, {}
    ends = [i + 1 for i, t in enumerate(low) if t[-1] in ".!?;"]
    for end in ends if ends and ends[-1] == len(low) else [*ends, len(low)]:
        part, at = cores[at:end], end
        key = tuple(part)
        said[key] = said.get(key, 0) + 1
        if said[key] > 2:
            n[2] += len(part)
            continue
        seen = set()
        for c, after in zip(part, [*part[1:], ""]):
            if c in own:
                n[2 if (c, after) in seen and after else 0] += 1
                seen.add((c, after))
            elif c in seen:
                n[2] += 1
            elif c.isalpha() and (len(c) < 4 or VOWELS.search(c)):
                n[1] += 1
                seen.add(c)
            elif not c:
                n[5] += 1
            elif c.replace(".", "").replace(",", "").isdigit():
                n[4] += 1
            elif (letters := sum(map(str.isalpha, c))) * 2 < len(c) or letters < len(c) and any(map(str.isdigit, c)) or not VOWELS.search(c):
                n[3] += 1
            else:
                n[1] += 1
                seen.add(c)
    return n, lang


def prose_profile(lang: str) -> np.ndarray:
    """Token kinds of a language's prose."""
    share = FUNCTION_SHARE[lang]
    q = np.array([share, 0.92 - share, 0.05, 0.0, 0.02, 0.01, 0.0]) + 1e-3
    return q / q.sum()


def nearest_profiles(lines: list[str]) -> list[int]:
    """Index of the profile of least divergence of each line: prose of the line's language, or a structure, by nothing else."""
    if not lines:
        return []
    kinds, langs = zip(*map(plain_kinds, lines))
    chars = char_shares(lines)
    c = chars / np.maximum(chars.sum(1, keepdims=True), 1)
    k = np.array(kinds, float)
    k /= np.maximum(k.sum(1, keepdims=True), 1)
    d = _js(k, _Q)
    at = NAMES.index("prose")
    for lang in set(langs):
        rows = np.array([x == lang for x in langs])
        d[rows, at] = _js(k[rows], prose_profile(lang)[None])[:, 0]
    return [int(x) for x in (_js(c, _P) + KIND_WEIGHT * d).argmin(1)]


def _js(x: np.ndarray, profiles: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence of each row to each profile."""
    out = np.empty((len(x), len(profiles)))
    lx = np.where(x > 0, np.log(np.maximum(x, 1e-12)), 0)
    for j, p in enumerate(profiles):
        m = np.log((x + p) / 2)
        out[:, j] = 0.5 * (x * (lx - m)).sum(1) + 0.5 * (p * (np.log(p) - m)).sum(1)
    return out


def line_profiles(lines: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Index of the nearest profile of each line (-1: too short to tell), with the counts it rests on."""
    if not lines:
        return [], np.zeros((0, 8)), np.zeros((0, 7))
    chars = char_shares(lines)
    kinds = np.array([token_kinds(x) for x in lines])
    c = chars / np.maximum(chars.sum(1, keepdims=True), 1)
    k = kinds / np.maximum(kinds.sum(1, keepdims=True), 1)
    best = (_js(c, _P) + KIND_WEIGHT * _js(k, _Q)).argmin(1)
    out = []
    for x, b, n in zip(lines, best, kinds):
        marked = n[6] > 0 and n.sum() <= 8 and not (ENDS.search(x[-9:]) and n.sum() > 5)
        if marked:
            out.append(NAMES.index("list"))
        elif NAMES[b] == "list" and not n[6] or NAMES[b] in PROSE and n.sum() < 9 and not ENDS.search(x[-9:]):
            out.append(-1)
        elif NAMES[b] not in PROSE and n[0] + n[1] >= 4 and n[0] and ENDS.search(x[-9:]) and n[3] + n[4] + n[5] <= n[0] + n[1]:
            out.append(NAMES.index("prose"))
        else:
            out.append(int(b))
    return out, chars, kinds


def structure(lines: list[str], profiles: list[int]) -> tuple[int, int, int]:
    """Characters in lines of prose, in other structures, and the leading other profile (-1: none)."""
    prose = other = 0
    by: dict[int, int] = {}
    for x, p in zip(lines, profiles):
        if p < 0:
            continue
        if NAMES[p] in PROSE:
            prose += len(x)
        else:
            other += len(x)
            by[p] = by.get(p, 0) + len(x)
    return prose, other, max(by, key=lambda q: (by[q], -q)) if by else -1


def nearest(lines: list[str]) -> tuple[int, int, int]:
    """structure() of a single document's lines."""
    return structure(lines, line_profiles(lines)[0])
