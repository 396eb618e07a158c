"""Word lists used by the tokenizer and the lexicon sentiment score.

The lists are small, fixed driver-side constants.  They are folded into the
query plan as literals (``IN`` over more than ten literals is rewritten by
Catalyst into a hash-set lookup), so nothing is broadcast or joined.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These three lists must equal the reference word-list file
# entry for entry, or keyword and sentiment results change.  Natural order.
# ---------------------------------------------------------------------------
STOP_WORDS: tuple[str, ...] = (
    "a", "about", "after", "all", "also", "an", "and", "are", "as", "at",
    "be", "because", "but", "by", "can", "for", "from", "has", "have",
    "i", "if", "in", "into", "is", "it", "its", "new", "no", "not",
    "of", "on", "only", "or", "our", "over", "than", "that", "the",
    "their", "there", "this", "to", "today", "was", "we", "what", "when",
    "which", "with", "you", "your", "will",
    "http", "https", "rt", "get", "got", "just", "like", "make", "know",
    "think", "see", "one", "good", "great", "well", "more", "much",
    "even", "now", "some", "still", "time", "day", "way", "people",
    "would", "could", "should", "want", "need", "take", "give", "back",
    "come", "done", "real", "post", "social", "media", "really",
    "actually", "going", "been", "being", "they", "them", "these",
    "those",
    "com", "org", "net", "edu", "gov", "mil", "io", "co", "uk", "us",
    "au", "ca", "de", "fr", "www", "html", "htm", "php", "asp", "json",
    "xml", "pdf", "png", "jpg", "jpeg", "gif", "css", "js", "svg", "amp",
    "via", "says", "said", "according",
)

POSITIVE: tuple[str, ...] = (
    "good", "great", "growth", "gain", "gains", "improve", "improved",
    "strong", "win", "wins", "launch", "fast", "success", "positive",
    "best", "safe", "secure", "stable",
)

NEGATIVE: tuple[str, ...] = (
    "bad", "bug", "bugs", "crash", "down", "fail", "failed", "issue",
    "issues", "loss", "risk", "slow", "negative", "worse", "worst",
    "attack", "outage", "error",
)
# --------------------------------------------------------------------------

WORDLIST_ENV = "TRENDLENS_WORDLIST"


@dataclass(frozen=True)
class Lexicon:
    """Stop words plus the positive / negative sentiment words."""

    stop_words: frozenset[str]
    positive: frozenset[str]
    negative: frozenset[str]

    @classmethod
    def default(cls) -> "Lexicon":
        return cls(frozenset(STOP_WORDS), frozenset(POSITIVE), frozenset(NEGATIVE))

    @classmethod
    def from_json(cls, path: str) -> "Lexicon":
        """Read ``{"stop_words": [...], "positive": [...], "negative": [...]}``;
        a missing key gives an empty set."""
        with open(path, encoding="utf-8") as fh:
            data = json.load(fh)
        return cls(
            frozenset(data.get("stop_words", [])),
            frozenset(data.get("positive", [])),
            frozenset(data.get("negative", [])),
        )

    @classmethod
    def load(cls, path: str | None = None) -> "Lexicon":
        """``path``, else the file named by ``$TRENDLENS_WORDLIST``, else the
        built-in lists."""
        path = path or os.environ.get(WORDLIST_ENV)
        return cls.from_json(path) if path else cls.default()
