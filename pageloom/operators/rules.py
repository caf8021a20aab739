"""Fixed values of the page rules, and the few that depend on the site being read."""

from __future__ import annotations

import re
from dataclasses import dataclass

# Tags that never hold content.
NON_CONTENT_TAGS = [
    "style", "script", "noscript", "svg", "object", "embed", "canvas", "map", "audio", "video", "source",
    "track", "template",
]

# Selectors tried in this order when no theme cell is found.
FALLBACK_TAGS_AND_CLASSES = [
    ("tag", "article"), ("class", "post-content"), ("class", "entry-content"), ("class", "content-area"),
    ("tag", "main"), ("id", "main-content"), ("class", "main-content"),
]

# Patterns of embedded videos, promotional markup and promotional text.
VIDEO_PATTERNS = [
    r"youtube\.com/embed/([a-zA-Z0-9_-]+)",
    r"youtube\.com/watch\?v=([a-zA-Z0-9_-]+)",
    r"youtu\.be/([a-zA-Z0-9_-]+)",
]
BUTTON_CLASS = r"(?i)avia-button(?!-no)"
PROMO_CLASS = r"(?i)avia-buttonrow|avia-button(?!-no)"
PROMO_HREF = r"(?i)(/trial/|/demo/|/pricing/|/contact/|/request/|#form)"
PROMO_PHRASES = [
    r"free\s+\d+-day\s+trial", r"book\s+a\s+demo", r"request\s+a\s+demo", r"ready\s+to\s+find\s+out\s+more",
    r"get\s+started\s+today", r"schedule\s+a\s+demo", r"contact\s+us\s+today",
]
PROMO_HEADINGS = ["find out more", "book a demo", "get started"]
HIDDEN_STYLE = r"(?i)display:\s*none"
CONTAINERS = ["div", "section", "article", "main", "aside"]

# Words that are no concept on their own.
STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "do", "does", "did", "will", "would", "could", "should", "may", "might",
    "must", "shall", "can", "need", "dare", "ought", "used", "how", "what", "why", "when", "where", "who", "which",
    "whom", "whose", "that", "this", "these", "those", "it", "its", "you", "your", "we", "our", "they", "their", "i",
    "my", "me", "he", "she", "him", "her", "his", "with", "from", "by", "about", "into", "through", "during",
    "before", "after", "above", "below", "between", "under", "again", "further", "then", "once",
]

MIN_CONCEPT, MAX_CONCEPT, MAX_CONCEPTS = 2, 50, 20


@dataclass(frozen=True)
class Site:
    """What the rules need to know about the site: its address, the path of its guide and its name."""

    base_url: str = "https://www.example.org/guide"
    host: str = "example.org"
    guide_path: str = "/guide/"
    brand: str = "Example"

    @property
    def label(self) -> str:
        return self.brand.lower()

    @property
    def title_suffixes(self) -> list[str]:
        return [f" | {self.brand}", f" - {self.brand}"]

    @property
    def webinar_pattern(self) -> str:
        return "(?i)" + re.escape(self.host) + "/webinar/"

    @property
    def promo_text(self) -> str:
        phrases = PROMO_PHRASES + [r"learn\s+more\s+about\s+" + re.escape(self.label)]
        # most places of a text are passed over by their letter, before any phrase is tried
        return "(?iU)(?=[" + "".join(sorted({p[0] for p in phrases})) + "])(" + "|".join(phrases) + ")"

    @property
    def guide_link(self) -> str:
        return re.escape(self.guide_path) + r"([^/]+)/([^/]+)?"
