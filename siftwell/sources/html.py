"""Text of HTML pages: a parser for any page, and a native form for well-formed templates."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKIP = {"script", "style", "head", "title", "noscript", "template"}
ASIDE = {"nav", "header", "footer", "aside"}
BLOCK = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "table", "tr", "section", "article", "main", "blockquote", "pre", "body", "form", "br", "hr", "dd", "dt", "figure"} | ASIDE
VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "track", "wbr"}
# Words in a class or id that mark an element as no part of the main content.
MARKED = ("nav", "footer", "sidebar", "advert", "menu", "cookie", "comment", "breadcrumb", "banner")


class _Reader(HTMLParser):
    def __init__(self, main: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.main, self.blocks, self.now = main, [], []
        self.open: list[tuple[str, bool]] = []
        self.bullet = False

    def _cut(self) -> None:
        text = " ".join("".join(self.now).split())
        if text:
            self.blocks.append(("  • " if self.bullet else "") + text)
            self.bullet = False
        self.now = []

    def _hidden(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._cut()
        a = dict(attrs)
        if tag == "img" and a.get("alt") and not self._hidden():
            self.now.append(a["alt"])
        if tag == "input" and a.get("value") and a.get("type") not in ("hidden", "submit") and not self._hidden():
            self.now.append(a["value"])
        if tag in VOID:
            return
        if tag in ("p", "li"):  # an open one ends where the next begins
            while self.open and self.open[-1][0] == tag:
                self.open.pop()
        names = f"{a.get('class') or ''} {a.get('id') or ''}".lower().replace("-", " ").replace("_", " ").split()
        hidden = tag in SKIP or self.main and (tag in ASIDE or "ad" in names or any(m in n for n in names for m in MARKED))
        self.open.append((tag, self._hidden() or hidden))
        if tag == "li":
            self.bullet = True

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self._cut()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if not self._hidden():
            self.now.append(data)


def decode(content: bytes) -> str:
    """Text of bytes: by their mark, as UTF-8, by the declared charset, or as Latin letters."""
    import re

    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if content.startswith(mark):
            return content.decode(name, "replace")
    try:
        return content.decode("utf-8")
    except UnicodeDecodeError:
        m = re.search(rb"charset=[\"']?([\w\-]+)", content[:2048], re.I)
        try:
            return content.decode(m[1].decode("ascii") if m else "cp1252", "replace")
        except LookupError:
            return content.decode("cp1252", "replace")


def extract(html: str | bytes | None, main_content: bool = True) -> str:
    """Text of a page, blocks apart by blank lines, list items with a bullet; empty where nothing can be read."""
    if not html:
        return ""
    r = _Reader(main_content)
    try:
        r.feed(decode(html) if isinstance(html, bytes) else html)
        r.close()
        r._cut()
    except Exception:
        return ""
    return "\n\n".join(r.blocks)


def extract_text(df: DataFrame, column: str = "html", out: str = "text", main_content: bool = True) -> DataFrame:
    """The frame with the text of its pages."""

    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(x, main_content) for x in pages], dtype=object)

    return df.withColumn(out, F.pandas_udf(run, "string")(F.col(column)))


# The native form, as a chain of replacements that Java and RE2 read alike.
NATIVE = (
    (r"(?is)<!--.*?-->", " "), (r"(?is)<script.*?</script>", " "), (r"(?is)<style.*?</style>", " "), (r"(?is)<head.*?</head>", " "),
    (r"(?is)<nav.*?</nav>", " "), (r"(?is)<footer.*?</footer>", " "), (r"(?is)<aside.*?</aside>", " "), (r"(?s)<[^>]*>", " "),
    ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"),
    (r"[\t-\r \x{a0}]+", " "),
)


def native_text(c: Column) -> Column:
    """Text of a page by built-in expressions only; for templates without nested containers."""
    for pattern, to in NATIVE:
        c = F.regexp_replace(c, pattern, to)
    return F.trim(c)
