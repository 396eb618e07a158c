"""SQL access to the keyword and sentiment expressions.

``register_sql_functions(spark)`` defines session-scoped SQL functions

    tl_keywords(text STRING)         -> ARRAY<STRING>
    tl_sentiment(keywords ARRAY<STRING>) -> DOUBLE
    tl_sentiment_label(score DOUBLE) -> STRING

as SQL user-defined functions whose bodies are built-in expressions, so a
query such as ``SELECT tl_keywords(text) FROM posts`` is inlined by the
analyzer and runs exactly like the DataFrame form: JVM-side, no Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from trendlens.functions.text import (
    _DOMAIN_MARK,
    _EMAIL_MARK,
    _JAVA_ONLY_WORD,
    _NONWORD_STANDIN,
    _POSSESSIVE,
    _PY_ONLY_SPACE,
    _PY_ONLY_WORD,
    _TOKEN,
    _URL_MARK,
    _WORD_STANDIN,
    DOMAIN_PATTERN,
    EMAIL_PATTERN,
    URL_PATTERN,
)
from trendlens.functions.wordlists import Lexicon


def _among(arg: str, words) -> str:
    """``arg IN (...)``, which becomes a hash-set lookup; false for no words."""
    listed = ", ".join("'" + w.replace("'", "\\'") + "'" for w in sorted(words))
    return f"{arg} IN ({listed})" if listed else "false"


def keywords_sql_body(arg: str = "text", lexicon: Lexicon | None = None, max_keywords: int | None = None) -> str:
    lex = lexicon or Lexicon.default()
    seps = "".join(f"\\u{ord(c):04x}" for c in _PY_ONLY_SPACE)

    def tokens(expr: str, flag: str) -> str:
        expr = f"translate({expr}, '{seps}', '{' ' * len(_PY_ONLY_SPACE)}')"
        blank = lambda e, pattern: f"regexp_replace({e}, r'{flag}{_POSSESSIVE.get(pattern, pattern)}', ' ')"
        links = f"CASE WHEN contains({arg}, '{_URL_MARK}') THEN {blank(expr, URL_PATTERN)} ELSE {expr} END"
        names = blank(links, DOMAIN_PATTERN)
        mails = f"CASE WHEN contains({arg}, '{_EMAIL_MARK}') THEN {blank(names, EMAIL_PATTERN)} ELSE {names} END"
        marked = (f"contains({arg}, '{_URL_MARK}') OR contains({arg}, '{_EMAIL_MARK}') "
                  f"OR {arg} RLIKE r'{_DOMAIN_MARK}'")
        return f"regexp_extract_all(CASE WHEN {marked} THEN {mails} ELSE {expr} END, r'{flag}{_TOKEN}', 1)"

    # same class mapping and branches as text.tokens_col
    wide = f"regexp_replace(lower({arg}), r'{_JAVA_ONLY_WORD}', '{_NONWORD_STANDIN}')"
    wide = f"regexp_replace({wide}, r'{_PY_ONLY_WORD}', '{_WORD_STANDIN}')"
    expr = (f"CASE WHEN length({arg}) = octet_length({arg}) THEN {tokens(f'lower({arg})', '')} "
            f"ELSE {tokens(wide, '(?U)')} END")
    kept = f"filter({expr}, t -> NOT {_among('t', lex.stop_words)})"
    if max_keywords is not None:
        kept = f"slice({kept}, 1, {int(max_keywords)})"
    return f"coalesce({kept}, CAST(array() AS ARRAY<STRING>))"


def sentiment_sql_body(arg: str = "keywords", lexicon: Lexicon | None = None) -> str:
    lex = lexicon or Lexicon.default()
    step = (f"(acc, t) -> acc + CASE WHEN {_among('t', lex.positive)} THEN 1 ELSE 0 END "
            f"- CASE WHEN {_among('t', lex.negative)} THEN 1 ELSE 0 END")
    return f"CAST(aggregate({arg}, 0, {step}) AS DOUBLE) / greatest(size({arg}), 1)"


def register_sql_functions(spark: SparkSession, lexicon: Lexicon | None = None,
                           max_keywords: int | None = None) -> list[str]:
    stmts = {
        "tl_keywords": ("text STRING", "ARRAY<STRING>", keywords_sql_body("text", lexicon, max_keywords)),
        "tl_sentiment": ("keywords ARRAY<STRING>", "DOUBLE", sentiment_sql_body("keywords", lexicon)),
        "tl_sentiment_label": (
            "score DOUBLE", "STRING",
            "CASE WHEN score > 0.04 THEN 'Positive' WHEN score < -0.04 THEN 'Negative' ELSE 'Neutral' END",
        ),
    }
    for name, (params, ret, body) in stmts.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
    return list(stmts)
