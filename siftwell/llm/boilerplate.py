"""Site template removal.

A page is a tree: elements hold elements, blocks hold lines, lines segments,
segments words.  Every subtree of it is hashed over its words, whatever its
markup: elements of several blocks (lists, menus, footers), single blocks, their
sentences, segments, labels and first words, with numbers as open slots.  The
hashes are counted per host over all pages in Spark, and subtrees that recur
across many pages of a host outside the pages' own body are its templates; those
of several hosts hold everywhere but on hosts whose bodies have them.  Documents
meet the templates of their own host in a stream, and lose every line, and every
run of lines, that a template covers.

Lists of links to other pages, breadcrumbs and tag lists differ on every page,
so no subtree of them recurs, and in extracted text no markup tells them apart.
For these alone there are rules (TEASERS, TRAIL, TAGS, and named lines that recur
on their site); ``rules=False`` leaves them out.

Null texts and empty texts have no lines; a null url has no site, so only
templates that hold across sites apply to it.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions import text as T
from siftwell.plans.lineage import cut

MIN_PAGES = 3  # pages that must share a subtree
MAX_BODY_SHARE = 0.04  # share of body elements among the carriers of a template
SITE_PART = 5_000  # documents of a site in one stream
SITE_MIN_DOCS = 5
SITE_MIN_SHARE = 20  # a line on one in so many documents of its site recurs

BLANK, BOILER, BODY, MAYBE = 0, 1, 2, 3

WORD = re.compile(r"[^\W\d_]+|[©]")
SEGMENT = re.compile(r"\s*(?:[|·»>/]|\[\+\]|::|\t|\s{2,})\s*")
LEAD = re.compile(r"^(?:[•>*–—\-]\s*|\d+[.)]?\s+)+")
MARK = re.compile(r"^\s*(?:[•>*–—\-]\s+|\d+[.)]\s+)")
TAIL = re.compile(r"(?:\s*(?:\(\d+\)|[-–]\s*\d+|\s\d+))+\s*[.!?…:;»]*\s*$")
AGE = re.compile(r"\b\d+\s?(?:d|h|min)\s*$")
COPY = re.compile(r"\(c\)|copyright(?= \d)|&copy;", re.I)
SENTENCE = re.compile(r"(?<=[.!?…])\s+(?=\S)")
ENDS = re.compile(r"[.!?…;:]['\")»“”\s]{0,6}$")
NAMED = re.compile(r"^\s*([^:]{3,40}?)(?::| [-–|]) +\S")
LEADER = re.compile(r"\.{4,}|\w[|;]\S|\d\t\S|\S\t\d")
TAGS = re.compile(r"^(?:#|[^\W\d_]+:|[^\W\d_]+ /)?\s*[^\W\d_][^,.:;|()\d]{1,40}(?:, [^,.:;|()\d]{2,40}){3,}\s*$", re.I)
DIGIT_LINE = re.compile(r"\.{4,}|\d\W*$|^\W*\d|\d[;|\t]")
LABEL = re.compile(r"^([^\W\d_][^:/|»]{1,40}?)(?::| [-–/|»(]|  )\s*\S")
TRAIL = re.compile(r"\S\s*(?:::|»|\s>\s)\s*\S")

# Words that open a list of links to other pages, collected from the pages at hand.
TEASERS = (
    "read more", "trending now", "popular this week", "latest posts", "most read", "related stories", "recommended for you",
    "you may also like", "editor s picks", "more on this", "weiterlesen", "meistgelesen", "neueste beiträge", "mehr zum thema",
    "beliebt diese woche", "das könnte sie auch interessieren", "das könnte sie", "lire la suite", "sur le même sujet", "à lire aussi",
    "les plus lus", "populaire cette semaine", "derniers articles", "seguir leyendo", "lo más leído", "popular esta semana",
    "sobre el mismo tema", "le puede interesar", "últimos artículos", "continuar a ler", "mais lidas", "últimos artigos",
    "sobre o mesmo tema", "popular esta semana", "pode interessar", "sullo stesso tema", "continua a leggere", "ultimi articoli",
    "i più letti", "potrebbe interessarti", "popolare questa settimana", "leia também", "читать дальше", "по теме", "популярное", "самое читаемое",
)

LONG = 160  # lines that are longer are not kept in the cache
PROSE_BLANKS = 30  # lines with so many blanks are looked up by their first words first
SHARED = 500_000  # templates shared by hosts that are broadcast at most; more are joined to the sites whose lines have them
RUN = 40  # lines of the longest run that is looked up as one subtree
DIGIT = re.compile(r"\d")


def words(line: str) -> list[str]:
    low = line.lower()
    return WORD.findall(COPY.sub("©", low) if "(c)" in low or "copyr" in low or "&copy" in low else low)


def bare(line: str) -> str:
    """A line without bullets, numbers and counters around it."""
    s = line.replace("\xa0", " ").replace("\r", " ").strip()
    if s and not s[0].isalpha():
        s = LEAD.sub("", s)
    end = s[-14:]
    if DIGIT.search(end):
        s = s[: len(s) - len(end)] + TAIL.sub("", end) if len(end) < len(s) else TAIL.sub("", s)
    return s


def digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key) - (1 << 63)


def opening(w: list[str]) -> str:
    """Key of the words a subtree begins with."""
    return "O" + " ".join(w[:2])


@lru_cache(1 << 16)
def keys(line: str) -> tuple[tuple[str, str], ...]:
    """Subtrees of a block with their openings: whole, segments, sentences, label and first words."""
    s = bare(line)
    w = words(s)
    if not w:
        return ()
    start = opening(w)
    found = [("F" + " ".join(w), start)]
    parts = SEGMENT.split(s)
    for p in parts if len(parts) > 1 else ():
        if x := words(bare(p)):
            found.append(("G" + " ".join(x), opening(x)))
    sentences = SENTENCE.split(s)
    for p in sentences if len(sentences) > 1 else ():
        if x := words(bare(p)):
            found.append(("F" + " ".join(x), opening(x)))
    if m := LABEL.match(s):
        if x := words(m[1]):
            found.append(("P" + " ".join(x), opening(x)))
    if len(w) > 1:
        found += [("H" + " ".join(w[:k]), start) for k in (2, 3, 4) if len(w) > k]
    return tuple(found)


MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-z][a-z0-9]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^'">])*)>|(?P<text>[^<]+|<)""",
    re.I | re.S,
)
CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class Page:
    """Text of each block element, with whether it stands in the body of the page (None: unknown), and the elements of several blocks."""

    BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 div li footer header nav aside td th section article ul ol table tr main br body blockquote pre".split())
    SKIP = frozenset("title head noscript".split())
    VOID = frozenset("br img meta link input hr".split())
    PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 td th li blockquote pre".split())
    OUTER = frozenset("nav footer header aside".split())

    def __init__(self, html: str) -> None:
        self.out: list[tuple[str, bool | None]] = []
        self.trees: list[tuple[list[str], bool]] = []
        self.stack: list[tuple[str, str, int]] = []  # tag, class, blocks before
        self.buffer: list[str] = []
        hidden = 0
        for m in MARKUP.finditer(html):
            text = m["text"]
            if text is not None:
                if not hidden:
                    self.buffer.append(unescape(text) if "&" in text else text)
            elif m["tag"]:
                tag = m["tag"].lower()
                if tag in self.BLOCKS:
                    self._flush()
                if m["end"]:
                    self._end(tag)
                elif tag not in self.VOID:
                    self._start(tag, m["attrs"])
                hidden = tag in self.SKIP and not m["end"] or hidden and any(t in self.SKIP for t, _, _ in self.stack)
        self._flush()

    def _flush(self) -> None:
        text = "".join(self.buffer).strip()
        if self.buffer:
            self.buffer = []
        if text:
            inner = next(((t, c) for t, c, _ in reversed(self.stack) if t in self.BLOCKS), ("", ""))
            outer = any(t in self.OUTER for t, _, _ in self.stack)
            body = not outer and inner[0] in self.PLAIN and not inner[1]
            self.out.append((text, body if body or outer or inner[1] else None))

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "p":
            while self.stack and self.stack[-1][0] == "p":
                self.stack.pop()
        m = CLASS.search(attrs) if "class" in attrs.lower() else None
        self.stack.append((tag, next((x for x in m.groups() if x), "") if m else "", len(self.out)))
        if attrs.endswith("/"):
            self._end(tag)

    def _end(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if tag in self.BLOCKS:
                    self._closed(self.stack[i][2])
                del self.stack[i:]
                break

    def _closed(self, before: int) -> None:
        """Keeps an element of several blocks that are all of the body or all outside it."""
        inside = {b for _, b in self.out[before:]}
        if len(self.out) - before > 1 and len(inside) == 1 and None not in inside:
            self.trees.append(([t for t, _ in self.out[before:]], inside == {True}))


def elements(html: str) -> list[tuple[str, bool | None]]:
    return Page(html).out


def site(url):
    """Column of the host, lower-cased, without scheme, port and a leading www."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.\-]*://)?(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


OPENS, TREE = 1, 2  # kinds of subtrees: openings that may be subheadings, and elements of several blocks
COUNTED = "site string, key long, start long, kind byte, outside long, inside long"


def _count(batches):
    """One row per host and subtree: pages that carry it outside and inside their body."""
    counts: dict = defaultdict(lambda: [0, 0, ""])
    for pdf in batches:
        for host, html in zip(pdf["site"], pdf["html"]):
            seen: dict[str, int] = {}
            starts: dict[str, str] = {}
            page = Page(html)
            for text, body in page.out:
                if body is None or (body and DIGIT_LINE.search(text)):
                    continue
                for k, start in keys(" ".join(text.split()) if body else text):
                    seen[k] = seen.get(k, 0) | (2 if body else 1)
                    starts[k] = start
            for blocks, body in page.trees:
                w = [x for b in blocks for x in words(bare(b))]
                if len(w) > 1:
                    k = "T" + " ".join(w)
                    seen[k] = seen.get(k, 0) | (2 if body else 1)
                    starts[k] = opening(w)
            for k, v in seen.items():
                c = counts[host, k]
                c[0] += v & 1
                c[1] += v >> 1
                c[2] = starts[k]
    kind = lambda k: TREE if k[0] == "T" else OPENS if k[0] in "FH" and 1 <= k.count(" ") <= 2 else 0
    rows = [(h, digest(k), digest(start), kind(k), a, b) for (h, k), (a, b, start) in counts.items()]
    for i in range(0, len(rows), 50_000):
        yield pd.DataFrame(rows[i : i + 50_000], columns=["site", "key", "start", "kind", "outside", "inside"])


def template_counts(pages: DataFrame) -> DataFrame:
    """Subtrees of each host, with the pages that carry them outside and inside their bodies; '' is no host."""
    rows = pages.where(F.col("html").isNotNull()).select(F.coalesce(site(F.col("url")), F.lit("")).alias("site"), "html")
    counted = rows.mapInPandas(_count, COUNTED)
    return counted.groupBy("site", "key").agg(F.first("start").alias("start"), F.first("kind").alias("kind"), F.sum("outside").alias("outside"), F.sum("inside").alias("inside"))


class Fitted(NamedTuple):
    """Templates of each host (site, key, value, start), and those that many hosts share: key to value and start."""

    sites: DataFrame
    common: dict[int, tuple[int, int]]
    shared: DataFrame | None = None  # in place of ``common`` where there are too many to broadcast


def fit_templates(pages: DataFrame) -> Fitted:
    """Templates of each host: subtrees recurring on its pages and hardly in their bodies.

    The value is 1 for a template (2 for one of several blocks), -1 for openings that bodies alone have, and
    0 where the host has in its bodies what is a template elsewhere.  Subtrees
    that recur on hosts, counted once for a host, hold for every document unless
    its own host says otherwise.
    """
    counts = cut(template_counts(pages))
    out, within = F.col("outside"), F.col("inside")
    own = lambda a, b: (b >= MIN_PAGES) & (a <= MAX_BODY_SHARE * b) & (F.col("kind") == OPENS)
    template = lambda a, b: (a >= MIN_PAGES) & (b <= MAX_BODY_SHARE * a)
    decided = lambda: F.when(template(out, within), F.when(F.col("kind") == TREE, 2).otherwise(1)).otherwise(-1).alias("value")
    hosts = counts.groupBy("key").agg(F.first("start").alias("start"), F.first("kind").alias("kind"), F.sum((out > 0).cast("int")).alias("outside"), F.sum((within > 0).cast("int")).alias("inside"))
    shared = cut(hosts.where(template(out, within) | own(out, within)).select("key", decided(), "start"))
    small = shared.count() <= SHARED
    common = {r["key"]: (r["value"], r["start"]) for r in shared.toLocalIterator()} if small else {}
    hostly = counts.where(F.col("site") != "")
    own_rows = hostly.where(template(out, within) | own(out, within)).select("site", "key", decided(), "start")
    body = hostly.where((within > MAX_BODY_SHARE * out) & ~own(out, within)).join(shared.where("value > 0").select("key"), "key", "left_semi")
    return Fitted(own_rows.unionByName(body.select("site", "key", F.lit(0).alias("value"), "start")), common, None if small else shared)


def _line_keys(batches):
    """Subtrees that lines of each site may be looked up by."""
    for pdf in batches:
        found: set[tuple] = set()
        for host, text in zip(pdf["_site"], pdf["text"]):
            for line in set(text.split("\n")) if text else ():
                b = bare(line.replace("\xa0", " ").replace("\r", " ").strip())
                w = words(b)
                found |= {(host, digest(k)) for k, _ in keys(line)} | {(host, digest("F" + " ".join(w[i : i + n]))) for i in range(len(w)) for n in (1, 2)}
                found |= {(host, digest(kind + " ".join(w[:k]))) for k in (2, 3) for kind in "HF"} | {(host, digest("F" + " ".join(words(bare(x))))) for x in SEGMENT.split(b)}
                found |= {(host, digest(opening(w)))} if w else set()
                found |= {(host, digest("G" + x)) for x in w} | {(host, digest("H" + " ".join(words(bare(p))[:k]))) for p in SENTENCE.split(b) for k in (2, 3, 4)}
        rows = list(found)
        for i in range(0, len(rows), 50_000):
            yield pd.DataFrame(rows[i : i + 50_000], columns=["site", "key"])


def with_shared(rows: DataFrame, fitted: Fitted) -> DataFrame:
    """Templates of each site, with those of all hosts that its documents' lines may need and its own do not decide."""
    asked = rows.select(F.coalesce("site", F.lit("")).alias("_site"), "text").mapInPandas(_line_keys, "site string, key long").distinct()
    # Elements of several blocks are asked for by what they begin with.
    trees = fitted.shared.where("value > 1").withColumnRenamed("start", "asked")
    begun = asked.withColumnRenamed("key", "asked").join(trees, "asked").select("site", "key", "value", F.col("asked").alias("start"))
    needed = asked.join(fitted.shared, "key").select("site", "key", "value", "start").unionByName(begun).distinct().join(fitted.sites.select("site", "key"), ["site", "key"], "left_anti")
    return fitted.sites.unionByName(needed.select("site", "key", "value", "start"))


def by_site(rows: DataFrame, fitted: Fitted, run, schema: str, value=None, make=None) -> DataFrame:
    """mapInPandas of run(frame, templates of each row, what is shared) over rows with a ``site``, each with the templates of its site.

    Rows without a doc_id are left out.  Rows meet the templates of their site in one sorted stream.  A large site is
    spread over several streams, each of which gets its templates.
    """
    names = rows.columns
    rows = rows.where(F.col("doc_id").isNotNull())
    shared = share(rows.sparkSession, fitted.common if value is None else value)
    make = make or Held
    key = F.coalesce("site", F.lit(""))
    parts = rows.groupBy(key.alias("_site")).agg(F.floor(F.count("*") / SITE_PART).cast("int").alias("_parts")).where("_parts > 0")
    spread = rows.withColumn("_site", key).join(F.broadcast(parts), "_site", "left")
    spread = spread.withColumn("_part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_parts") + 1).cast("int"), F.lit(0))).drop("_parts")
    known = fitted.sites if fitted.shared is None else with_shared(rows, fitted)
    table = known.withColumnRenamed("site", "_site").join(F.broadcast(parts), "_site", "left")
    table = table.select("_site", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(0)))).alias("_part"), F.col("key").alias("_key"), F.col("value").alias("_value"), F.col("start").alias("_start"))
    both = spread.unionByName(table, allowMissingColumns=True).withColumn("_doc", F.col("_key").isNull())
    both = both.fillna(0, ["_key", "_value", "_start"])  # a null would make floats of the keys
    stream = both.repartition("_site", "_part").sortWithinPartitions("_site", "_part", "_doc")

    def stream_run(batches):
        held = Lazy.of(shared, make)
        at, own, now = None, {}, None
        for pdf in batches:
            ts, docs = [], []
            row = zip(pdf["_site"], pdf["_part"], pdf["_doc"], pdf["_key"], pdf["_value"], pdf["_start"])
            for i, (s, part, doc, k, v, start) in enumerate(row):
                if (s, part) != at:
                    at, own, now = (s, part), {}, None
                if not doc:
                    own[k] = (v, start)
                    continue
                if now is None:
                    now = held.templates.of_site(own) if own else held.templates
                ts.append(now)
                docs.append(i)
            if docs:
                frame = pdf[names].iloc[docs].reset_index(drop=True)
                got = run(frame, ts, held)
                if len(got):
                    yield got

    return stream.mapInPandas(stream_run, schema)


class Layer:
    """A common set with what a site adds to it and takes from it."""

    __slots__ = ("common", "more", "less")

    def __init__(self, common: set, more: set, less: set) -> None:
        self.common, self.more, self.less = common, more, less

    def __contains__(self, key) -> bool:
        return key in self.more or (key in self.common and key not in self.less)


NOTHING = (False, False, 0)


def odd(b: str, w: list[str]) -> bool:
    """Whether a line is a row of a table or of contents, or letters are less than half of it."""
    return LEADER.search(b) is not None or sum(map(len, w)) * 2 < len(b)


class Templates:
    """Decides for the lines of a document whether a template covers them."""

    def __init__(self, table: dict[int, tuple[int, int]], rules: bool = True) -> None:
        self.table = {k for k, (v, _) in table.items() if v > 0}
        self.own = {k for k, (v, _) in table.items() if v < 0}
        self.starts = {x for v, x in table.values() if v > 0}
        self.trees = {x for v, x in table.values() if v > 1}
        self.rules = rules
        self.cache: dict[str, tuple[bool, bool, int]] = {}
        self.teasers = {tuple(t.split()) for t in TEASERS} if rules else set()
        self.longest = max(map(len, self.teasers), default=0)
        self.firsts = {t[0] for t in self.teasers}

    def of_site(self, own: dict[int, tuple[int, int]]) -> Templates:
        """These with what a site's own pages say."""
        t = Templates({}, self.rules)
        t.table = Layer(self.table, {k for k, (v, _) in own.items() if v > 0}, {k for k, (v, _) in own.items() if v <= 0})
        t.own = Layer(self.own, {k for k, (v, _) in own.items() if v < 0}, {k for k, (v, _) in own.items() if v > 0})
        t.starts = Layer(self.starts, {x for v, x in own.values() if v > 0}, set())
        t.trees = self.trees | {x for v, x in own.values() if v > 1}
        return t

    def has(self, kind: str, w) -> bool:
        return digest(kind + " ".join(w)) in self.table

    def line(self, raw: str) -> tuple[bool, bool, int]:
        """Whether it is covered, whether it opens a teaser list, and what it begins with."""
        if len(raw) > LONG:
            return self._line(raw)
        hit = self.cache.get(raw)
        if hit is None:
            hit = self.cache[raw] = self._line(raw)
        return hit

    def _line(self, raw: str) -> tuple[bool, bool, int]:
        s = raw.replace("\xa0", " ").replace("\r", " ").strip()
        b = bare(s)
        prose = b.count(" ") >= PROSE_BLANKS and not (self.rules and "." not in s)  # too long for a label, a trail or tags
        w = words(b[:64] if prose else b)
        if prose and len(w) < 3:
            w = words(b)
        if not w:
            return NOTHING
        start = digest(opening(w))
        # Every template that covers a line, its label, segments or first sentence begins as the line does.
        starts = w[0] == "©" or start in self.starts or digest(opening(w[:1])) in self.starts
        if prose:
            return (self._matched(b, words(b), True), False, start) if starts else NOTHING
        if w[0] in self.firsts and len(w) < 16 and any(tuple(w[:k]) in self.teasers for k in range(1, self.longest + 1)):
            return True, True, start
        if self.rules:
            trail = (">" in b or "»" in b or "::" in b) and len(w) < 18 and not ENDS.search(b[-9:]) and TRAIL.search(b)
            if (trail or s.count(",") > 2 and TAGS.search(s) and all(len(p.split()) < 5 for p in s.split(","))) and not odd(b, w):
                return True, False, start
        return starts and self._matched(b, w, False), False, start

    def _covered(self, s: str) -> bool:
        w = words(bare(s))
        if not w:
            return False
        if self.has("F", w):
            return True
        for k in (4, 3, 2):
            if len(w) > k and self.has("H", w[:k]):
                return True
        return w[0] == "©" and len(w) > 1

    def _matched(self, b: str, w: list[str], prose: bool) -> bool:
        """Whether templates cover a line."""
        if odd(b, w):
            return False
        ended = ENDS.search(b[-9:])
        m = not prose and len(w) < 24 and (not ended or len(w) < 14) and LABEL.match(b)
        if m and self.has("P", words(m[1])):
            return True
        if not ended and self._menu(w):
            return True
        parts = [p for p in (words(bare(x)) for x in SEGMENT.split(b)) if p]
        if len(parts) > 1:
            known = [self.has("G", x) or self.has("F", x) for x in parts]
            if all(known) or known[0] and len(w) < 16 and not ended:
                return True
        sentences = SENTENCE.split(b)
        if len(sentences) == 1:
            return self._covered(b)
        return self.has("F", w) or (self._covered(sentences[0]) and sum(0 if self._covered(x) else len(words(x)) for x in sentences) < 5)

    def heading(self, raw: str) -> bool:
        """Whether a line is a subheading of bodies, or no text."""
        b = bare(raw.replace("\xa0", " ").replace("\r", " ").strip())
        w = words(b)
        return odd(b, w) or any(digest(kind + " ".join(w[:k])) in self.own for k in (2, 3) for kind in "HF")

    def _menu(self, w: list[str]) -> bool:
        """Whether most of the words are entries of a menu, one after another."""
        i = n = 0
        while i < len(w):
            if self.has("F", w[i : i + 1]):
                i, n = i + 1, n + 1
            elif i + 1 < len(w) and self.has("F", w[i : i + 2]):
                i, n = i + 2, n + 1
            elif n >= 2 and len(w) - i < 5:
                break
            elif self.has("G", w[i : i + 1]):
                i += 1
            else:
                return False
        return n >= 2

    def runs(self, lines: list[str], infos: list) -> None:
        """Marks runs of lines whose words are those of one element of several blocks."""
        for i, (_, _, start) in enumerate(infos):
            if start not in self.trees:
                continue
            w, end = words(bare(lines[i])), 0
            for j in range(i + 1, min(i + RUN, len(lines))):
                w += words(bare(lines[j]))
                if self.has("T", w):
                    end = j
            for j in range(i, end + 1) if end else ():
                infos[j] = (True, *infos[j][1:])

    def classify(self, text: str, host: str | None = None) -> list[int]:
        """BLANK, BOILER, BODY or MAYBE (body unless it recurs on its site) of each line."""
        if not text:
            return []
        lines = text.split("\n")
        out: list[int] = []
        infos = [self.line(x) for x in lines]
        self.runs(lines, infos)
        names = set()
        if host and self.rules:
            names.add("".join(WORD.findall(host.rsplit(".", 1)[0])))
        for raw, (covered, _, _) in zip(lines, infos) if self.rules else ():
            if covered and ("©" in raw or COPY.search(raw)):
                w = words(bare(raw))
                names.add("".join(w[w.index("©") + 1 :][:2]) if "©" in w else "")
        names.discard("")
        block = False
        last = BLANK
        for i, raw in enumerate(lines):
            s = raw.strip()
            covered, teaser, _ = infos[i]
            if not s:
                out.append(BLANK)
                continue
            if covered and not scripts_notice(s):
                last = BOILER
                out.append(BOILER)
                if teaser:
                    block = True
                continue
            start = s[:48]
            m = NAMED.match(start.replace("\xa0", " ")) if ":" in start or " -" in start or " |" in start or " –" in start else None
            if m and names:
                head = "".join(words(bare(m[1])))
                if head in names or any(head and n.startswith(head) and len(head) > 5 for n in names):
                    last = BOILER
                    out.append(BOILER)
                    continue
            short = block and len(s) < 110 and not (ENDS.search(s[-9:]) and len(s) > 60)
            if block and short and (MARK.match(raw) or AGE.search(s) or not self.heading(raw)) and not LEADER.search(s) and sum(map(str.isalpha, s)) * 2 > len(s) and (MARK.match(raw) or AGE.search(s) or (not ENDS.search(TAIL.sub("", s)) and len(s.split()) < 13)):
                last = BOILER
                out.append(BOILER)
                continue
            if self.rules and last == BOILER and s.isalpha() and i and s[0].isupper():
                out.append(BOILER)
                continue
            block = False
            last = BODY
            out.append(MAYBE if self.rules and m and len(s) < 300 else BODY)
        return out


# A demand for scripts or another browser, in the languages at hand.
SCRIPTS = re.compile(
    r"java ?script|(?-i:\bJS\b)|\b(?:scripts?|skripte?n?|скрипт\w*|сценари\w*)\b|newer browser|checking your browser|you are human|ad blocker|before the content can load|press refresh|reload the page|switch them on and reload|content cannot be shown",
    re.I,
)
ABOUT = re.compile(r"\b(?:guide|how to|shows|explains)\b", re.I)


HINTED = ("script", "js ", "js,", "skript", "скрипт", "сценари", "browser", "you are human", "ad blocker", "content can", "press refresh", "reload")


def scripts_notice(line: str) -> bool:
    """Whether the sentences of a line that demand scripts are the greater part of it."""
    low = line.lower()
    if not any([x in low for x in HINTED]) or ABOUT.search(line):
        return False
    return 2 * sum(len(x) for x in SENTENCE.split(line) if SCRIPTS.search(x)) > len(line)


def demote_scripts(lines: list[str], classes: list[int], notice) -> list[int]:
    """A notice about scripts beside a body of real content is no body."""
    hits = [i for i, c in enumerate(classes) if c >= BODY and notice(lines[i])]
    if hits:
        others = [lines[i] for i, c in enumerate(classes) if c >= BODY and i not in hits]
        if sum(len(x) for x in others if ENDS.search(x[-9:]) or len(x.split()) > 9 or LEADER.search(x) or sum(map(str.isalpha, x)) * 2 < len(x)) > 40:
            for i in hits:
                classes[i] = BOILER
    return classes


class Plain:
    """The templates of a broadcast value, without the rules beside them."""

    def __init__(self, value) -> None:
        self.templates = Templates(value, rules=False)


class Held:
    """The templates of a broadcast value."""

    def __init__(self, value) -> None:
        self.templates = Templates(value)


class Lazy:
    """What a broadcast value is turned into, once per Python worker."""

    held: dict = {}

    @classmethod
    def of(cls, broadcast, make):
        key = (make.__name__, broadcast.value.get("id"))
        if key not in cls.held:
            for old in [k for k in cls.held if k[0] == key[0]]:
                del cls.held[old]
            cls.held[key] = make(broadcast.value["value"])
        return cls.held[key]


def share(spark, value):
    """Broadcast of a value of bounded size, with an id by which workers keep what they make of it."""
    return spark.sparkContext.broadcast({"id": uuid.uuid4().hex, "value": value})


def body_lines(text: str, host: str | None, templates: Templates) -> list[tuple[int, str]]:
    """Numbered lines of a page's own body."""
    if not text:
        return []
    classes = templates.classify(text, host)
    lines = text.split("\n")
    return [(i, lines[i - 1]) for i, c in enumerate(demote_scripts(lines, classes, scripts_notice), 1) if c >= BODY]


def line_classes(documents: DataFrame, fitted: Fitted, rules: bool = True) -> DataFrame:
    """One row per visible line: doc_id, line_no, site, class and a hash of its letters."""

    def run(pdf, ts, _):
        ids, nos, sites, classes, hashes = [], [], [], [], []
        for d, text, host, t in zip(pdf["doc_id"], pdf["text"], pdf["site"], ts):
            if not text:
                continue
            lines = text.split("\n")
            found = demote_scripts(lines, t.classify(text, host), scripts_notice)
            for i, c in enumerate(found):
                if c != BLANK and c != BODY:
                    ids.append(d)
                    nos.append(i + 1)
                    sites.append(host)
                    classes.append(c)
                    hashes.append(xxhash.xxh64_intdigest("".join(WORD.findall(lines[i].lower()))) - (1 << 63) if c == MAYBE else 0)
        return pd.DataFrame({"doc_id": pd.Series(ids, dtype="int64"), "line_no": pd.Series(nos, dtype="int32"), "site": pd.Series(sites, dtype=object), "class": pd.Series(classes, dtype="int8"), "hash": pd.Series(hashes, dtype="int64")})

    rows = documents.where(F.col("text").isNotNull()).select("doc_id", "text", site(F.col("url")).alias("site"))
    return by_site(rows, fitted, run, "doc_id long, line_no int, site string, class byte, hash long", make=Held if rules else Plain)


def template_lines(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, line_no) of the lines that recurring subtrees cover, by nothing else."""
    return line_classes(documents, fit_templates(pages), rules=False).where(F.col("class") == BOILER).select("doc_id", "line_no")


def boilerplate_lines(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, line_no) of the lines with visible text that are not body.

    Templates cover most of them; a line that no template covers is removed as
    well where it recurs on other pages of its own site (pages that are copies
    of each other count once, by the address without its query).
    """
    lines = cut(line_classes(documents, fit_templates(pages)))  # read three times
    sure = lines.where(F.col("class") == BOILER).select("doc_id", "line_no")
    named = lines.where((F.col("class") == MAYBE) & F.col("site").isNotNull())
    address = F.regexp_replace(F.lower("url"), r"[?#].*$", "")
    per_page = named.join(documents.select("doc_id", address.alias("page")), "doc_id").select("site", "hash", "page").distinct()
    recurring = per_page.groupBy("site", "hash").count().where(F.col("count") >= SITE_MIN_DOCS)
    sizes = documents.where(F.col("text").isNotNull()).groupBy(site(F.col("url")).alias("site")).agg(F.count("*").alias("docs"))
    recurring = recurring.join(sizes, "site").where(F.col("count") * SITE_MIN_SHARE >= F.col("docs")).select("site", "hash")
    return sure.unionByName(named.join(recurring, ["site", "hash"], "left_semi").select("doc_id", "line_no"))


def main_content(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents without blank lines and those of boilerplate_lines(); the other columns stay."""
    gone = boilerplate_lines(documents, pages).groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("line_no").alias("_gone"))
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: (T.strip(x) != "") & ~F.coalesce(F.array_contains("_gone", i + 1), F.lit(False)))
    joined = documents.join(gone, F.col("doc_id") == F.col("_id"), "left")
    return joined.withColumn("text", F.array_join(kept, "\n")).select(documents.columns)
