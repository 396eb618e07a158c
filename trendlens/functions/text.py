"""Keyword extraction and lexicon sentiment as native Spark expressions.

``keywords_col`` turns a text column into ``array<string>``:

1. lower-case;
2. leave out, in this order, URLs, dotted names ("domains"), e-mail-like
   fragments and bare top-level-domain words;
3. pull every run ``#?[a-z][a-z0-9_]{3,}`` (the match is not anchored to a word
   start, so ``1abcde`` yields ``abcde``) and drop the leading ``#``;
4. drop stop words; duplicates stay.  ``max_keywords`` keeps only the first
   so many survivors (``FIRST_KEYWORDS`` is the original pipeline's cut);
   by default the whole text counts.

``sentiment_col`` scores the *same* array: (positive - negative) / length,
0.0 for an empty array.  Both stay inside the JVM (regex + array
higher-order functions), so no row ever crosses into a Python worker.

Patterns carry ``(?U)`` so ``\\w``, ``\\b`` and ``\\S`` are Unicode-aware, as
they are in Python's ``re`` for ``str`` patterns (without it Java treats
accented letters as non-word characters); the few characters on which the
two engines' Unicode classes still differ are mapped first
(:func:`python_classes_col`).  Pure-ASCII texts, on which the flag changes
nothing, take the same patterns without it, which Java matches faster.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlens.functions.wordlists import Lexicon

# ---------------------------------------------------------------------------
# Cleaning patterns, token pattern and limits that define the
# keyword semantics (must match the reference tokenizer).
# ---------------------------------------------------------------------------
URL_PATTERN = r"https?://\S+"
DOMAIN_PATTERN = r"\b[\w-]+\.[\w.-]+\b"
EMAIL_PATTERN = r"\b[\w.-]+@[\w.-]+\b"
TLD_PATTERN = r"\b(?:com|org|net|edu|gov|io|co|uk|us|au|ca|de|fr|info|biz|me|tv)\b"
# The token's body is captured, so the optional leading '#' is dropped by the
# extraction itself.
TOKEN_BODY = r"#?([a-z][a-z0-9_]{3,})"
FIRST_KEYWORDS = 20
# ---------------------------------------------------------------------------

# Applied in this order; each match becomes a single space.
CLEANING_PATTERNS: tuple[str, ...] = (URL_PATTERN, DOMAIN_PATTERN, EMAIL_PATTERN, TLD_PATTERN)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Java's Unicode classes ((?U)) and Python's ``re`` classes for ``str``
# patterns disagree on a few kinds of characters.  Right after lower-casing,
# each such character is replaced by a stand-in that belongs to the same
# Python class, so every cleaning pattern matches exactly the spans Python
# matches.  Tokens are ASCII, so a stand-in never reaches the output.
#   word in Java only: combining marks (e.g. the dot of a lower-cased
#     Turkish capital I), connector punctuation, joiners  -> U+00A6 (symbol)
#   word in Python only: numbers such as superscripts    -> U+00AA (letter)
#   space in Python only: the separators \x1c-\x1f         -> space
# (No ASCII character is among them; asking for non-ASCII first is the cheaper test.)
_JAVA_ONLY_WORD = r"(?U)[\x80-\x{10FFFF}&&[\w&&[^\p{L}\p{N}_]]]"
_PY_ONLY_WORD = r"(?U)[\x80-\x{10FFFF}&&[\p{N}&&[^\w]]]"
_NONWORD_STANDIN, _WORD_STANDIN = "\u00a6", "\u00aa"
_PY_ONLY_SPACE = "\x1c\x1d\x1e\x1f"


def python_classes_col(text: Column) -> Column:
    """Lower-case ``text`` and map the characters on which Java and Python
    regex classes disagree to stand-ins of their Python class (see above)."""
    mapped = F.regexp_replace(F.regexp_replace(F.lower(text), _JAVA_ONLY_WORD, _NONWORD_STANDIN),
                              _PY_ONLY_WORD, _WORD_STANDIN)
    return _plain_spaces(mapped)


def _plain_spaces(text: Column) -> Column:
    return F.translate(text, _PY_ONLY_SPACE, " " * len(_PY_ONLY_SPACE))


# The same spans without backtracking: what follows a run is not of its class.
_POSSESSIVE = {DOMAIN_PATTERN: r"\b[\w-]++\.[\w.-]+\b", EMAIL_PATTERN: r"\b[\w.-]++@[\w.-]+\b"}
# Literals that every match of a pass needs; a match of the domain pass has a
# dot before a character of its class (any non-ASCII one may map to such).
_URL_MARK, _EMAIL_MARK = "://", "@"
_DOMAIN_MARK = r"\.[\w.\-\x80-\x{10FFFF}]"


# Blanking the bare TLD words takes no pass of its own: a whole word can only
# be a token if it has the four characters of one, so the extraction leaves
# out such words where they stand alone.
_LONG_TLDS = "|".join(w for w in re.findall("[a-z]+", TLD_PATTERN.split("?:")[1]) if len(w) >= 4)
_TOKEN = rf"#?((?!(?<!\w)(?:{_LONG_TLDS})(?!\w))[a-z][a-z0-9_]{{3,}}+)"


def tokens_col(text: Column | str) -> Column:
    """``array<string>`` of the tokens that are left beside URLs, domains,
    e-mails and bare TLDs of the lower-cased text; NULL for NULL.

    A text without any mark of the first three (most have none) is not
    rewritten at all.  Pure-ASCII texts (character count == byte count, a
    cheap test on the input column) take the patterns without ``(?U)`` and
    skip the class mapping, of which only the separator translation applies
    to them.
    """
    raw = _col(text)
    marked = raw.contains(_URL_MARK) | raw.contains(_EMAIL_MARK) | raw.rlike(_DOMAIN_MARK)

    def tokens(out: Column, flag: str) -> Column:
        blank = lambda c, pattern: F.regexp_replace(c, flag + _POSSESSIVE.get(pattern, pattern), " ")
        links = F.when(raw.contains(_URL_MARK), blank(out, URL_PATTERN)).otherwise(out)
        names = blank(links, DOMAIN_PATTERN)
        mails = F.when(raw.contains(_EMAIL_MARK), blank(names, EMAIL_PATTERN)).otherwise(names)
        return F.regexp_extract_all(F.when(marked, mails).otherwise(out), F.lit(flag + _TOKEN), 1)

    ascii_only = F.length(raw) == F.octet_length(raw)
    return F.when(ascii_only, tokens(_plain_spaces(F.lower(raw)), "")).otherwise(
        tokens(python_classes_col(raw), "(?U)"))


def keywords_col(text: Column | str, lexicon: Lexicon | None = None, max_keywords: int | None = None) -> Column:
    """``array<string>`` of all keywords, or of the first ``max_keywords``;
    NULL or empty text gives []."""
    lex = lexicon or Lexicon.default()
    stop = sorted(lex.stop_words)
    kept = tokens_col(text)
    if stop:
        kept = F.filter(kept, lambda t: ~t.isin(*stop))
    if max_keywords is not None:
        kept = F.slice(kept, 1, max_keywords)
    return F.coalesce(kept, F.array().cast("array<string>"))


def sentiment_col(keywords: Column | str, lexicon: Lexicon | None = None) -> Column:
    """Lexicon score of a keyword array: (#positive - #negative) / max(len, 1).

    One ``aggregate`` pass over the array; a word on both lists adds 0.
    """
    lex = lexicon or Lexicon.default()
    pos, neg = sorted(lex.positive), sorted(lex.negative)
    kw = _col(keywords)
    step = lambda words, sign: lambda t: F.when(t.isin(*words), sign).otherwise(0) if words else F.lit(0)
    up, down = step(pos, 1), step(neg, -1)
    net = F.aggregate(kw, F.lit(0), lambda acc, t: acc + up(t) + down(t))
    return (net / F.greatest(F.size(kw), F.lit(1))).cast("double")


def sentiment_label_col(score: Column | str, threshold: float = 0.04) -> Column:
    """Dashboard label: > threshold Positive, < -threshold Negative, else Neutral."""
    s = _col(score)
    return (
        F.when(s > threshold, F.lit("Positive"))
        .when(s < -threshold, F.lit("Negative"))
        .otherwise(F.lit("Neutral"))
    )


# ---------------------------------------------------------------------------
# Plain-Python twin.  Not used by any query plan: it is the row-by-row
# specification the native expression is tested against, and the body of the
# Arrow-batched UDF the bench uses to measure what native expressions save.
# ---------------------------------------------------------------------------
_PY_CLEANERS = [re.compile(p) for p in CLEANING_PATTERNS]
_PY_TOKEN = re.compile(TOKEN_BODY)


def keywords_py(text: str | None, lexicon: Lexicon | None = None, max_keywords: int | None = None) -> list[str]:
    if not text:
        return []
    lex = lexicon or Lexicon.default()
    s = text.lower()
    for rx in _PY_CLEANERS:
        s = rx.sub(" ", s)
    return [w for w in _PY_TOKEN.findall(s) if w not in lex.stop_words][:max_keywords]


def sentiment_py(words: list[str], lexicon: Lexicon | None = None) -> float:
    if not words:
        return 0.0
    lex = lexicon or Lexicon.default()
    net = sum((w in lex.positive) - (w in lex.negative) for w in words)
    return net / max(len(words), 1)


def keywords_pandas_udf(lexicon: Lexicon | None = None, max_keywords: int | None = None):
    """Arrow-batched UDF running :func:`keywords_py` (bench comparison only)."""
    lex = lexicon or Lexicon.default()

    @F.pandas_udf("array<string>")
    def _kw(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: keywords_py(t, lex, max_keywords))

    return _kw
