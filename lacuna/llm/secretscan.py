"""Secrets in text: candidates scored by a random forest that removes false positives.

All steps are built-in functions and Spark's own forest; no Python runs in the tasks.
A candidate is a word of ``SHORTEST`` characters or more with letters and digits.  Its
features: length, character make-up and transitions between classes of characters,
coverage by a dictionary of the corpus, path-like parts, and what the words before it
say.  The dictionary holds the letter words that at least one in ``DICTIONARY_SHARE``
documents has, counted over all documents and added up in the tasks first.

The forest is fitted on labelled findings: a table ``doc_id, word_index, label`` if one
is given, else the candidates that fixed rules decide (``weak_label``); at most
``SAMPLE_ROWS`` of them, chosen by a hash of the candidate.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.session import cut_lineage, tune

SHORTEST = 12
SAMPLE_ROWS = 20_000
DICTIONARY_SHARE = 2000
TREES, DEPTH = 24, 6
# words that announce a secret, and openings of well-known key formats
ANNOUNCE = r"(secret|token|passw|passwd|pwd|api.?key|apikey|access.?key|auth|credential|private.?key)"
FORMATS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,}|xox[abp]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35})$"
HARMLESS = r"(@|^https?:|^www\.|^[0-9]{4}-[0-9]{2}-[0-9]{2}|\.(html?|png|jpe?g|gif|css|js|php|com|org|net)$|^[A-Za-z]+[0-9]{1,4}$)"
FEATURES = [
    "length", "transitions", "digits", "upper", "distinct", "hex", "symbols", "letters_run", "coverage",
    "slashes", "dots", "at", "announced", "assigned", "quoted",
]


def candidates(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """``doc_id, body, word_index, word, value, before``: every candidate of each text.

    ``value`` is the word without quotes, punctuation and a leading ``name=``; ``before``
    the three words before it and that name.  Null texts have none.
    """
    split = docs.select(
        F.col(row_id).alias("doc_id"), F.xxhash64(text).alias("body"), F.split(F.coalesce(F.col(text), F.lit("")), r"\s+").alias("words")
    )

    def possible(w: Column) -> Column:
        return (F.length(w) >= SHORTEST) & w.rlike("[0-9]") & w.rlike("[A-Za-z]")

    found = F.array_compact(F.transform("words", lambda w, i: F.when(possible(w), F.struct(i.alias("i"), w.alias("w")))))
    rows = split.select("doc_id", "body", "words", F.explode(found).alias("c"))
    i = F.col("c.i")
    rows = rows.select(
        "doc_id", "body", i.alias("word_index"), F.col("c.w").alias("word"),
        F.concat_ws(" ", F.slice("words", F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3)))).alias("words_before"),
    )
    name = F.regexp_extract("word", r"([A-Za-z_][A-Za-z_.-]{0,40})[=:]", 1)
    value = F.regexp_replace("word", r"^[^A-Za-z0-9]*([A-Za-z_][A-Za-z_.-]{0,40}[=:]+)?[^A-Za-z0-9/+]*|[^A-Za-z0-9=/+]+$", "")
    return rows.select(
        "doc_id", "body", "word_index", "word", value.alias("value"), F.lower(F.concat_ws(" ", "words_before", name)).alias("before")
    )


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``piece``: lower-case letter words found in enough of all documents."""
    n = docs.count()
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}]+"))
    pieces = docs.select(F.explode(words).alias("piece")).where(F.length("piece").between(3, 24))
    return pieces.groupBy("piece").agg(F.count("*").alias("n")).where(F.col("n") >= max(2, n / DICTIONARY_SHARE)).select("piece")


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with the columns ``FEATURES``; ``known`` is the dictionary."""
    value, size = F.col("value"), F.greatest(F.length("value"), F.lit(1)).cast("double")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")

    def share(pattern: str) -> Column:
        return (F.length("value") - F.length(F.regexp_replace(value, pattern, ""))) / size

    pieces = F.filter(F.split(F.lower(value), "[^a-z]+"), lambda p: F.length(p) >= 3)
    # distinct values only: the same finding in thousands of copies is looked up once
    parts = found.select("value").distinct().select("value", F.explode(F.array_distinct(pieces)).alias("piece"))
    covered = parts.join(known, "piece", "left_semi").groupBy("value").agg(F.sum(F.length("piece")).alias("covered"))
    rows = found.join(covered, "value", "left")
    longest = F.array_max(F.transform(F.split(value, "[^A-Za-z]+"), F.length))
    return rows.select(
        *found.columns,
        F.length("value").cast("double").alias("length"),
        ((F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / size).alias("transitions"),
        share("[0-9]").alias("digits"), share("[A-Z]").alias("upper"),
        (F.size(F.array_distinct(F.split(value, ""))) / size).alias("distinct"),
        value.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hex"),
        share("[^A-Za-z0-9]").alias("symbols"), (F.coalesce(longest, F.lit(0)) / size).alias("letters_run"),
        F.least(F.coalesce("covered", F.lit(0)) / size, F.lit(1.0)).alias("coverage"),
        share("/").alias("slashes"), share(r"\.").alias("dots"), value.contains("@").cast("double").alias("at"),
        F.col("before").rlike(ANNOUNCE).cast("double").alias("announced"),
        (F.col("word").rlike("[A-Za-z_][=:]") | F.col("before").rlike("[=:] ?$|[=:] ")).cast("double").alias("assigned"),
        F.col("word").rlike("[\"'`]").cast("double").alias("quoted"),
    )


def weak_label() -> Column:
    """1 for an announced and assigned value or a known key format, 0 for addresses,
    names with a number, dates and plain words, null where no rule decides."""
    announced = F.col("before").rlike(ANNOUNCE) & (F.col("word").rlike("[A-Za-z_][=:]") | F.col("before").rlike("[=:]"))
    return (
        F.when(F.col("value").rlike(FORMATS), 1.0)
        .when(F.col("value").rlike(HARMLESS) | (F.length("value") < 8), 0.0)
        .when(announced, 1.0)
        .when(F.col("coverage") >= 0.5, 0.0)
    )


def scan(docs: DataFrame, labels: DataFrame | None = None, text: str = "text", row_id: str = "doc_id", rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, word_index, value, before`` of every candidate with its ``score``.

    The score is the forest's probability that the candidate is a secret; where the
    labelled findings hold one class or none, it is that class, or 0.  A null id is
    kept; rows that repeat an id give their findings each.
    """
    tune(docs.sparkSession)
    found = cut_lineage(features(cut_lineage(candidates(docs, text, row_id)), cut_lineage(dictionary(docs, text))))
    if labels is None:
        known = found.withColumn("label", weak_label()).where("label is not null")
    else:
        own = labels.groupBy("doc_id", "word_index").agg(F.max(F.col("label").cast("double")).alias("label"))
        known = found.join(own, ["doc_id", "word_index"]).where("label is not null")
    known = known.groupBy("value", "before", *FEATURES).agg(F.max("label").alias("label"))
    sample = cut_lineage(known.orderBy(F.xxhash64("value", "before"), "value", "before").limit(rows))
    classes = [r[0] for r in sample.select("label").distinct().collect()]
    shown = ["doc_id", "word_index", "value", "before"]
    if len(classes) < 2:
        return found.select(*shown, F.lit(float(classes[0]) if classes else 0.0).alias("score"))
    vector = VectorAssembler(inputCols=FEATURES, outputCol="__features")
    forest = RandomForestClassifier(
        featuresCol="__features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=2, seed=17
    ).fit(vector.transform(sample))
    scored = forest.transform(vector.transform(found))
    return scored.select(*shown, vector_to_array("probability")[1].alias("score"))
