"""Word lists and patterns that define results; every operator takes others as parameters."""

from __future__ import annotations

# Substrings of a line that mark it as boilerplate.
LINE_BLACKLIST = (
    "advertisement", "advertisements", "advertising", "sponsored", "sponsor", "promoted content", "promotion", "promotions", "buy now", "order now",
    "shop now", "add to cart", "limited time", "sale ends", "discount code",
    "follow us", "like us on", "share this", "share on", "tweet", "retweet", "comment below", "leave a comment", "join the conversation", "pin it",
    "instagram", "facebook", "linkedin", "youtube", "subscribe", "subscribe to our newsletter", "sign up for updates", "sign up for our newsletter",
    "register now", "create an account", "join now", "log in", "sign up",
    "back to top", "scroll to top", "skip to content", "skip navigation", "next page", "previous page", "read more", "click here", "learn more", "view all",
    "menu", "site map",
    "all rights reserved", "terms of service", "terms of use", "privacy policy", "cookie policy", "cookie settings", "disclaimer", "copyright", "©", "®", "™",
    "legal notice", "accessibility", "user agreement", "privacy statement", "website terms", "website privacy", "this site is protected by",
    "visitor counter", "hit counter", "tracking provided by", "analytics", "google analytics", "powered by", "designed by", "created with", "hosted by",
    "website design by", "website development by", "theme by", "template by",
    "download pdf", "print this", "save as pdf", "view pdf", "download now",
    "contact us", "about us", "faq", "help center", "support", "customer service", "careers", "job openings", "investor relations", "sitemap",
    "newsletter archive",
    "sidebar", "navbar", "footer", "breadcrumbs", "meta info", "tag cloud", "related posts", "recent posts", "popular posts", "archive",
    "powered by wordpress", "built with", "hosted on", "switch to mobile view", "view desktop site",
)

# Terms whose presence marks informative text.
DOMAIN_TERMS = (
    "analysis", "report", "study", "research", "survey", "whitepaper", "case study", "benchmark", "evaluation",
    "tutorial", "guide", "how-to", "walkthrough", "manual", "documentation", "example", "demo", "demonstration", "best practices",
    "overview", "introduction", "primer", "deep dive", "insights", "explanation", "methodology", "methods", "faq", "q&a", "question and answer",
    "review", "summary", "recap", "roundup", "comparison", "pros and cons",
    "specification", "standards", "protocol", "format", "schema",
    "dataset", "data", "statistics", "metrics", "analysis pipeline", "framework", "architecture", "design patterns",
)

# Stop words of the document rules.
STOP_WORDS = ("the", "be", "to", "of", "and", "that", "have", "with")

# Patterns of personal information, and the tokens put in their place, in order of application.
EMAIL = r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b"
PHONE = r"(?:\+?[0-9]{1,3}[\t-\r \-]?)?(?:\(?[0-9]{2,4}\)?[\t-\r \-]?)?[0-9]{3,4}[\t-\r \-]?[0-9]{3,4}"
IPV4 = r"\b(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
MASKS = (("email", EMAIL, "|||EMAIL_ADDRESS|||"), ("phone_numbers", PHONE, "|||PHONE_NUMBER|||"), ("ip_address", IPV4, "|||IP_ADDRESS|||"))

# Classes that Java and RE2 read alike.
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BREAK = r"\r\n|[\n-\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
WORD_TOKEN = r"\.\.\.|[\p{L}\p{N}_]+(?:['.\-][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_\t-\r ]"
HTML_NOISE = r"(?i)</?[a-z][^>]*>|https?://[^\t-\r ]+"
ASCII_PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
