"""Secret scans: pattern candidates, judged by a random forest.

Candidates are values assigned to a name that holds a credential word,
passwords of ``user:password@host``, private-key blocks and
long runs of key characters, alone or joined by dots; most long runs are
words, hashes or ids.  A
forest over length, character transitions, dictionary coverage, path marks
and neighbouring words removes such false positives.  It is trained on
labelled findings; without labels of one's own, :func:`label_findings` marks
the clear cases of a corpus and the forest judges the rest.

Candidates, features, training and scoring are DataFrame and MLlib jobs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import bounded_sample, fresh, numbered, words_col, written

NAMES = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth[_-]?key|credential"
# A credential name as a whole word, or joined to others by _ - . digits or camel case.
PART = rf"(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z]))(?i:(?:{NAMES})s?)(?:(?![A-Za-z])|(?<=[a-z])(?=[A-Z]))"
ASSIGN = (r"(?<![\w.-])(?=[\w.-]++[\"']?\s{0,4}[:=])" rf"(?=[\w.-]*?{PART})"
          r"[\w.-]++[\"']?\s{0,4}[:=]\s{0,4}[\"']?")
# A value runs to its closing quote; without one to a space, a quote, an angle
# bracket or a comma or semicolon that ends it or precedes the next assignment.
VALUE = (r"(?:(?<=\")(?:[^\"\\\r\n]|\\.){6,}+(?=\")|(?<=')(?:[^'\\\r\n]|\\.){6,}+(?=')"
         r"|(?!-----BEGIN)(?:[^\s\"'<>,;]|[,;](?=[^\s\"'<>,;])(?![\w.-]++[\"']?[:=])){6,}+)")
# user:password@host, after :// or alone; words that stand before mail addresses are no users.
USER = (r"(?:://[^\s/:@\"'<>]*+:|(?<![\w.:/@-])(?!(?i:mailto|e-?mail|mail|to|from|cc|bcc|contact|sips?|xmpp|acct):)"
        r"[A-Za-z][\w.-]*+:)")
LOGIN = USER + r"(?=[^\s/\"'<>]{3})[^\s/\"'<>@]++(?:@[^\s/\"'<>@]++(?=@))*+(?=@[\w\[])"
BLOCK = r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----[\s\S]*?-----END [A-Z ]{0,32}PRIVATE KEY-----"
_LONG = "(?:(?=[A-Za-z{0}_-]*+[0-9])[A-Za-z0-9{0}_-]{{16,}}+|[A-Za-z0-9{0}_-]{{20,}}+)"
# Key segments joined by dots, one of them long.
DOTTED = (r"(?<![\w+/.@-])(?=[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]{2})"
          rf"(?=[A-Za-z0-9_.-]*?(?<![A-Za-z0-9_-]){_LONG.format('')})"
          r"[A-Za-z0-9_-]{2,}+(?:\.[A-Za-z0-9_-]{2,}+)++(?![\w+/@])")
RUN = rf"(?<![\w+/.@-]){_LONG.format('+/')}={{0,2}}(?![\w@])"
NAMED = f"{ASSIGN}{VALUE}|{LOGIN}"
CANDIDATE = f"{BLOCK}|{NAMED}|{DOTTED}|{RUN}"
# Values with a vendor's fixed prefix (fixed values: AWS, GitHub, Slack, Google, SendGrid, JSON web tokens).
VENDOR = (r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}"
          r"|SG\.[\w-]{16,}\.[\w-]{32,}|eyJ[\w-]+\.[\w-]+\.[\w-]{16,})$")
# Base64 has slashes too, but far apart.
BASE64 = r"^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])[A-Za-z0-9+/]{24,}={0,2}$"
PLACEHOLDER = r"(?i)example|changeme|placeholder|your[_-]|xxxx|dummy|\*\*\*"
NEIGHBOURS = 64  # characters of context on either side

# Different texts, and share of all different texts, that make a word a dictionary word.
DICTIONARY_COUNT = 5
DICTIONARY_SHARE = 0.001
GRAM = 4
MIN_TRAINING = 20  # labelled findings of each class without which there is no forest
MAX_TRAINING = 20_000  # labelled findings of each class the forest is fitted on, at most
BROADCAST_ROWS = 100_000  # spans of texts that are sent to every executor, at most
TREES, DEPTH, SEED = 20, 5, 7
THRESHOLD = 0.5

FEATURES = ("f_length", "f_digits", "f_upper", "f_symbols", "f_transitions", "f_distinct", "f_hex", "f_coverage",
            "f_path", "f_named", "f_hash_word", "f_quoted", "f_vendor", "f_placeholder")


# Control characters (separators) around matches.
MARK, OTHER_MARK = "\x1e", "\x1f"


def _gap(text: Column) -> Column:
    return F.struct(F.length(text).alias("n"), F.substring(text, 1, NEIGHBOURS).alias("head"),
                    F.right(text, F.lit(NEIGHBOURS)).alias("tail"))


def candidates(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """One row per candidate: ``keys``, ``row`` (of ``docs``), ``idx`` in the
    text, ``start`` and ``length`` of the value in characters, ``value``,
    ``name`` (the assigned name or login, with its marks, else empty),
    ``before`` (the text before, and the name) and ``after``.

    NULL and empty texts have none.  Each text is searched once: the search
    puts a mark before and after every match, and plain splits at the marks
    give matches and gaps in turn.  (A mark that stands in a text itself is
    read as its neighbour, a control character like it.)
    """
    marked = F.regexp_replace(F.translate(F.col(text_col), MARK, OTHER_MARK), f"({CANDIDATE})", f"{MARK}$1{MARK}")
    rows = docs.select(*keys, F.monotonically_increasing_id().alias("row"), F.split(marked, MARK, -1).alias("cut"))
    place = lambda start: F.sequence(F.lit(start), F.size("cut") - 1, F.lit(2))
    some = F.size("cut") > 1
    rows = rows.select(
        *keys, "row", F.when(some, F.transform(place(1), lambda i: F.get("cut", i))).alias("found"),
        F.when(some, F.transform(place(0), lambda i: _gap(F.get("cut", i)))).alias("gaps"))
    # explode_outer and a filter: for a plain explode a filter on the array's
    # size is pushed below the projections, and the search runs twice.
    each = rows.select(*keys, "row", F.posexplode_outer(F.arrays_zip(
        F.col("found"), F.slice("gaps", 1, F.size("found")).alias("gap"),
        F.slice("gaps", 2, F.size("found")).alias("next"))).alias("idx", "c")).filter("idx IS NOT NULL")
    # Text up to a candidate: all gaps so far and all candidates before it.
    upto = Window.partitionBy("row").orderBy("idx")
    ends = F.sum(F.col("c.gap.n") + F.length("c.found")).over(upto)
    name = F.regexp_extract("c.found", f"^({ASSIGN}|{USER})", 1)
    value = F.substr("c.found", F.length(name) + 1)
    # The text before, across earlier candidates: a candidate has 6 characters
    # or more but for a login's 3 after a mark, so NEIGHBOURS / 4 of them reach.
    earlier = F.array_join(F.collect_list(F.concat("c.gap.tail", F.right("c.found", F.lit(NEIGHBOURS)))).over(
        Window.partitionBy("row").orderBy("idx").rowsBetween(-NEIGHBOURS // 4, -1)), "")
    before = F.right(F.concat(earlier, F.col("c.gap.tail")), F.lit(NEIGHBOURS))
    return (each.withColumn("end", ends.cast("long")).withColumn("text_before", before)
            .select(*keys, "row", "idx", (F.col("end") - F.length(value)).alias("start"),
                    F.length(value).cast("long").alias("length"), value.alias("value"), name.alias("name"),
                    F.concat("text_before", name).alias("before"), F.col("c.next.head").alias("after")))


def different_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(text)`` of one row of each different text.

    Rows are grouped by the hashes of their texts alone; the rows to leave
    out, copies beyond the first, are joined by row keys.
    """
    keyed, keys = numbered(docs.select(F.col(text_col).alias("text")).filter("text IS NOT NULL"), "secret-texts")
    light = written(keyed.select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"),
                                 F.struct(*keys).alias("key")), "secret-hashes")
    firsts = written(light.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("key").alias("first"))
                     .filter("n > 1").select("h1", "h2", "first"), "secret-repeated")
    copies = written(light.join(firsts, ["h1", "h2"]).filter("key <> first").select("key.*"), "secret-copies")
    return keyed.join(copies, keys, "left_anti").select("text")


def dictionary_grams(docs: DataFrame, text_col: str = "text", least: int = DICTIONARY_COUNT,
                     share: float = DICTIONARY_SHARE) -> DataFrame:
    """Letter groups of length ``GRAM`` in the words (a-z after lowering) that
    ``least`` different texts or more, and ``share`` of them, hold; 26^4 rows
    at most.  Copies of a text count once, values next to credential names
    not at all."""
    texts = different_texts(docs, text_col)
    own = F.array_distinct(words_col(F.lower(F.regexp_replace("text", NAMED, " "))))
    # The row without a word counts the texts.
    words = texts.select(F.explode(F.array_append(own, F.lit(None).cast("string"))).alias("w"))
    counts = written(words.filter("w IS NULL OR length(w) >= " + str(GRAM)).groupBy("w").agg(F.count("*").alias("n")),
                     "secret-words")
    total = counts.filter("w IS NULL").agg(F.max("n").alias("n")).first()["n"] or 0
    known = (counts.filter(F.col("w").isNotNull() & (F.col("n") >= max(least, share * total)))
             .filter(F.col("w").rlike(r"^[a-z]+[.,!?]*$")).select(F.regexp_extract("w", "^[a-z]+", 0).alias("w")))
    return (known.filter(F.length("w") >= GRAM)
            .select(F.explode(_grams(F.col("w"))).alias("gram")).distinct())


def _grams(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word) - (GRAM - 1)),
                       lambda i: F.substr(word, i, F.lit(GRAM)))


def with_features(found: DataFrame, grams: DataFrame) -> DataFrame:
    """``found`` with the columns ``FEATURES`` (doubles)."""
    v, n = F.col("value"), F.length("value")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0")
    changes = F.regexp_count(kinds, F.lit(r"(.)(?!\1)(?=.)"))
    letters = F.transform(F.regexp_extract_all(F.lower(v), F.lit(f"([a-z]{{{GRAM},}})"), 1), _grams)
    own = found.select("row", "idx", F.explode(F.flatten(letters)).alias("gram"))
    cover = (own.join(grams.withColumn("known", F.lit(1)), "gram", "left").groupBy("row", "idx")
             .agg((F.count("known") + (GRAM - 1)).alias("covered")))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    # The name of another value says nothing about this one.
    context = F.regexp_replace("before", NAMED, " ")
    slashes = F.regexp_count(v, F.lit("/"))
    coverage = F.least(F.lit(1.0), F.coalesce(F.col("covered") / n, F.lit(0.0)))
    base64 = F.coalesce(v.rlike(BASE64), F.lit(False)) & (n >= (slashes + 1) * 8) & (coverage < 0.5)
    out = found.join(cover, ["row", "idx"], "left").select(
        *found.columns,
        n.cast("double").alias("f_length"), share("[0-9]").alias("f_digits"), share("[A-Z]").alias("f_upper"),
        share("[^A-Za-z0-9]").alias("f_symbols"),
        (changes / F.greatest(n - 1, F.lit(1))).alias("f_transitions"),
        (F.size(F.array_distinct(F.split(v, "", -1))) / F.least(n, F.lit(32))).alias("f_distinct"),
        flag(v.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("f_hex"),
        coverage.alias("f_coverage"),
        F.when(F.col("name").startswith("://"), 0.0).otherwise(F.greatest(
            flag(context.rlike(r"(?i)(https?:|www\.|/)\S*$")),
            F.when(base64, 0.0).otherwise(F.least(slashes / 4.0, F.lit(1.0))))).alias("f_path"),
        flag((F.col("name") != "") | context.rlike(f"(?i)({NAMES})")).alias("f_named"),
        flag(F.col("before").rlike(r"(?i)(sha-?\d*|md5|commit|checksum|digest|uuid|hash|etag)\W*$"))
        .alias("f_hash_word"),
        flag(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).alias("f_quoted"),
        flag(v.rlike(VENDOR) | v.startswith("-----BEGIN")).alias("f_vendor"),
        flag(v.rlike(PLACEHOLDER)).alias("f_placeholder"))
    return out.select(*found.columns, *(F.col(f).cast("double").alias(f) for f in FEATURES))


def clear_label() -> Column:
    """1.0 or 0.0 for the clear cases among featured findings: a vendor's
    format, or a named value mixed from digits and letters that is no word
    and no placeholder; dictionary words, numbers, paths, named hashes,
    placeholders.  NULL for all others."""
    named = (F.col("f_named") > 0) & (F.col("f_digits") >= 0.1) & (F.col("f_coverage") < 0.3)
    false = ((F.col("f_coverage") >= 0.6) | (F.col("f_digits") == 1) | (F.col("f_hash_word") > 0)
             | ((F.col("f_digits") == 0) & (F.col("f_named") == 0) & (F.col("f_vendor") == 0)) | (F.col("f_path") >= 0.5))
    return (F.when(F.col("f_placeholder") > 0, 0.0).when(F.col("f_vendor") > 0, 1.0)
            .when(named & (F.col("f_hash_word") == 0), 1.0).when(false, 0.0))


def label_findings(found: DataFrame) -> DataFrame:
    """The clear cases among featured findings, with their ``label``."""
    return found.withColumn("label", clear_label()).filter("label IS NOT NULL")


def train_forest(labelled: DataFrame, most: int = MAX_TRAINING,
                 least: int = MIN_TRAINING) -> RandomForestClassificationModel | None:
    """Forest fitted on featured findings with a ``label``; of each class the
    ``most`` findings with the smallest hashes.  None if a class has fewer
    than ``least``: so few say nothing of the unlabelled ones."""
    parts = [bounded_sample(labelled.filter(F.col("label") == y).select("label", "value", "before", *FEATURES),
                            ["value", "before"], most) for y in (0.0, 1.0)]
    rows = written(reduce(DataFrame.unionAll, parts).select("label", *FEATURES), "secret-training")
    sizes = rows.agg(*[F.count_if(F.col("label") == y) for y in (0.0, 1.0)]).first()
    if min(sizes) < least:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))


def score_findings(found: DataFrame, model: RandomForestClassificationModel | None,
                   threshold: float = THRESHOLD, clear: bool = True) -> DataFrame:
    """Featured findings with ``score`` and ``is_secret``.

    With ``clear`` the clear cases (:func:`clear_label`) keep their label
    whatever the forest says of them, and the forest judges the others;
    without a model those are no secrets.
    """
    label = clear_label() if clear else F.lit(None).cast("double")
    if model is None:
        scored = found.withColumn("score", F.coalesce(label, F.lit(0.0)))
    else:
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
        judged = F.round(vector_to_array("probability")[1], 6)
        scored = model.transform(ready).withColumn("score", F.coalesce(label, judged)).select(*found.columns, "score")
    return scored.withColumn("is_secret", F.col("score") >= threshold)


def scan_secrets(docs: DataFrame, keys: list[str], text_col: str = "text",
                 labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate in every text with its verdict.

    Rows: ``keys``, ``idx``, ``start``, ``length``, ``value``, ``name``,
    ``score``, ``is_secret``.  ``labelled`` (featured findings with a label)
    trains the forest, which then judges every candidate; by default the clear
    cases of ``docs`` train it and it judges the others.  NULL and
    empty texts give no rows; repeated rows and ids are scanned one by one;
    extra columns are ignored; an empty table gives no rows.
    """
    narrow = docs.select(*(F.col(k).alias(f"k_{k}") for k in keys), F.col(text_col).alias("text"))
    grams = written(dictionary_grams(narrow), "secret-grams")
    found = written(candidates(narrow, [f"k_{k}" for k in keys]), "secret-candidates")
    featured = written(with_features(found, grams), "secret-features")
    model = train_forest(label_findings(featured) if labelled is None else labelled)
    scored = score_findings(featured, model, clear=labelled is None)
    return scored.select(*(F.col(f"k_{k}").alias(k) for k in keys), "idx", "start", "length", "value", "name",
                         "score", "is_secret")


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret value in ``text`` replaced by ``mark`` and
    ``n_chars`` (if there) counted anew for the texts that changed.

    No document is dropped; NULL and empty texts, and texts of any length
    without a secret, pass through untouched; repeated rows and ids are
    redacted row by row (rows are told apart as :func:`numbered` does); other
    columns keep their names and values; an empty table gives no rows.  The
    spans are sent to every executor if there are at most ``BROADCAST_ROWS``
    texts with secrets, else they are joined by row.
    """
    keyed, keys = numbered(docs, "secret-docs")
    spans = fresh(keyed, "spans")
    secrets = scan_secrets(keyed, keys).filter("is_secret")
    found = written(secrets.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias(spans)), "secret-spans")
    text = F.col("text")

    def cut(acc: Column, s: Column) -> Column:
        kept = F.substr(text, acc["at"] + 1, (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.concat(acc["parts"], F.array(kept, F.lit(mark))).alias("parts"),
                        (s["start"] + s["length"]).cast("int").alias("at"))

    clean = F.aggregate(
        spans, F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at")), cut,
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(text, acc["at"] + 1)))
    changed = F.col(spans).isNotNull()
    few = found.count() <= BROADCAST_ROWS
    joined = keyed.join(F.broadcast(found) if few else found, keys, "left").withColumn(
        "text", F.when(changed, clean).otherwise(text))
    columns = [F.when(changed, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
               if c == "n_chars" else F.col(c) for c in docs.columns]
    return joined.select(*columns)
