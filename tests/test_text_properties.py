"""Property tests: native keyword extraction == the plain-Python twin."""

import unicodedata

from hypothesis import HealthCheck, Phase, example, given, settings
from hypothesis import strategies as st

from trendlens.functions.text import keywords_col, keywords_py, sentiment_col, sentiment_py

FRAGMENTS = [
    "http://", "https://", "www.", ".com", ".org", ".co.uk", "@", "#", "-", "_", ".", " ", "\n", "\t",
    "info", "good", "crash", "growth", "outage", "the", "about", "john", "bar", "secure", "failed",
    "é", "Été", "é", "ß", "İ", "ſ", "K", "²", "①",
    "‿", "‍", "\x1c", "\x1f", " ", "　", "中文", "\U0001F600", "3.14", "1abcde",
]
ORDINARY = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .,:;!?-_@#/\néèüßç"


def _texts(pieces):
    return st.lists(st.lists(pieces, max_size=30).map("".join), min_size=50, max_size=50)


EXOTIC = _texts(st.one_of(st.sampled_from(FRAGMENTS), st.text(max_size=4)))
PLAIN = _texts(st.one_of(st.sampled_from([f for f in FRAGMENTS if all(ord(c) < 0x250 for c in f)
                                          and unicodedata.is_normalized("NFC", f) and "\x1c" not in f
                                          and "\x1f" not in f and "²" not in f]),
                         st.text(alphabet=ORDINARY, max_size=6)))


def _check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    kw = df.select("i", keywords_col("text").alias("k"))
    for r in kw.select("i", "k", sentiment_col("k").alias("s")).collect():
        expect = keywords_py(texts[r.i])
        assert list(r.k) == expect, repr(texts[r.i])
        assert abs(r.s - sentiment_py(expect)) < 1e-12


# Shrinking a failing batch through Spark is slow; report the batch as is.
FAST = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck),
                phases=[Phase.explicit, Phase.reuse, Phase.generate])

KNOWN = ["İ.orghttp://", "cafe\u0301.com x", "http://a\x1fb c", "x\u203fy.z", "\u00b2abc.def",
         "e\u0301tude.fr good", "a\u200db.info growth", "\u24b6bc.de crash"]


@FAST
@example(KNOWN + [""] * 42)
@given(EXOTIC)
def test_matches_twin_on_any_unicode(spark, texts):
    _check(spark, texts)


@FAST
@given(PLAIN)
def test_matches_twin_on_composed_text(spark, texts):
    _check(spark, texts)
