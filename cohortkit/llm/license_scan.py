"""License scans with a positional index of rare words.

The index lists, for every licence template, the words and where they stand.
A file is looked up, for every template with a mandatory key phrase in it, by
that template's words that the corpus has least (highest IDF): each place of
such a word, less the word's place in the template, is a place where the
template would begin, and the rare words of a real licence agree on it. A
template whose words agree on one beginning with enough of their weight is a
match. Templates are ranked each for itself, so that a file of many licences
has them all looked up. All of it is DataFrame functions.

Texts are normalised once. What no template can match, for want of the words
of every key phrase, keeps its word count and drops its text there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import checked_broadcast
from ..session import materialize
from . import common

# Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Label, template, key phrases of which one must stand in the file.
TEMPLATES = [
    ("mit", "released under the mit license", ["the mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", ["permission is hereby granted free of charge"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     ["gnu general public license version 3"]),
    ("gpl-2", "this program is licensed under the gnu general public license version 2",
     ["gnu general public license version 2"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl-3", "licensed under the gnu affero general public license version 3",
     ["gnu affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license v 2", "mozilla public license version 2"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4", "creative commons attribution license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
]

_KEY = ["id", "rid"]


def normal_text(text: str) -> Column:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with one space between; empty for null.

    lower() changes other letters than A-Z too; neither the bounds of words
    nor their agreement with the phrases, which are ASCII, depend on these.
    """
    words = F.regexp_replace(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))),
                             r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.trim(words)


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _starts(words: Column, phrase: str) -> Column:
    """The places where the phrase's words stand one after the other."""
    parts = phrase.split(" ")

    def found(own: Column) -> Column:
        def here(i: Column) -> Column:
            out = F.get(own, i) == parts[0]
            for k, word in enumerate(parts[1:], 1):
                out = out & (F.get(own, i + k) == word)
            return F.coalesce(out, F.lit(False))
        return F.filter(F.sequence(F.lit(0), F.greatest(F.size(own) - len(parts), F.lit(0))), here)

    # Inside transform the words are a value; named directly they would be made anew for each place.
    all_of_them = F.transform(F.array(words), found)[0]
    return F.when(F.contains(F.col("padded"), F.lit(f" {phrase} ")), all_of_them).otherwise(F.array().cast("array<int>"))


def _found_phrases(labels: Sequence[tuple[str, str]]) -> Column:
    """The labels of the phrases in ``padded``, with repeats."""
    return F.array_compact(F.array(*[F.when(F.contains(F.col("padded"), F.lit(f" {p} ")), F.lit(label))
                                     for p, label in labels]))


def scan(docs: DataFrame, base: Mapping[str, str] | None = None,
         templates: Sequence[tuple[str, str, Sequence[str]]] | None = None, rare_words: int = 8,
         least_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    ``score`` is the best match's part of its template's rare-word weight, 0
    without a match. Null and empty texts have no words and no labels; null
    ids stay null; repeated rows get equal rows each; an empty table gives no
    row; other columns are not read.
    """
    base, templates = BASE if base is None else base, TEMPLATES if templates is None else templates
    vocabulary = sorted({w for _, t, keys in templates for p in (t, *keys, *base) for w in p.split(" ")})
    phrases = [p for _, _, keys in templates for p in keys] + list(base)
    rows = docs.select(F.col(id_col).alias("id"), common.row_hash(text_col).alias("rid"),
                       normal_text(text_col).alias("normal"))
    words = F.when(F.col("normal") == "", F.array().cast("array<string>")).otherwise(F.split("normal", " ", -1))
    rows = rows.select(*_KEY, "normal", F.size(words).cast("long").alias("n_words"),
                       F.array_intersect(words, _strings(vocabulary)).alias("found"))
    could = F.lit(False)
    for p in phrases:
        could = could | (F.size(F.array_except(_strings(p.split(" ")), F.col("found"))) == 0)
    files = materialize(rows.withColumn("normal", F.when(could, F.col("normal"))), "licence-words")

    # IDF over all files: as many rows as there are licence words.
    df = files.select(F.explode("found").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    idf = checked_broadcast(df.select("word", F.log(F.lit(files.count() + 1) / F.col("df")).alias("idf")))

    # The positional index: each template's rarest words with their places and weights.
    session = docs.sparkSession
    postings = session.createDataFrame([(t, label, pos, word) for t, (label, text, _) in enumerate(templates)
                                        for pos, word in enumerate(text.split(" "))],
                                       "template int, label string, tpos int, word string")
    order = lambda words: F.sort_array(F.collect_list(words), asc=False)
    weight = lambda words: F.aggregate(words, F.lit(0.0), lambda a, x: a + x["idf"])
    posting = F.struct("idf", "word", "tpos")
    rarest = (postings.join(idf, "word").groupBy("template", "label")
              .agg(F.slice(order(posting), 1, rare_words).alias("top")))
    index = rarest.select("template", "label", weight("top").alias("full"), F.inline("top"))

    held = files.filter(F.col("normal").isNotNull()).dropDuplicates(_KEY)
    keys = [(k, str(t)) for t, (_, _, ks) in enumerate(templates) for k in ks]
    looked = (held.withColumn("padded", F.concat(F.lit(" "), F.col("normal"), F.lit(" ")))
              .withColumn("verified", _found_phrases(keys)).filter(F.size("verified") > 0))
    places = looked.select(*_KEY, "verified", F.posexplode(F.split("normal", " ", -1)).alias("pos", "word"))
    # A beginning and a place in the template name one word, so each counts once.
    begins = (places.join(F.broadcast(index), "word")  # rare_words rows per template
              .filter(F.array_contains("verified", F.col("template").cast("string")))
              .groupBy(*_KEY, "template", "label", "full", (F.col("pos") - F.col("tpos")).alias("begin"))
              .agg(order(posting).alias("agreed")))
    matched = (begins.withColumn("score", F.when(F.col("full") > 0, F.least(F.lit(1.0), weight("agreed") / F.col("full")))
                                 .otherwise(0.0))
               .filter(F.col("score") >= least_score))
    own = matched.groupBy(F.col("id").alias("__id"), F.col("rid").alias("__rid")).agg(
        F.collect_set("label").alias("own"), F.max("score").alias("score"))

    starts = F.flatten(F.array(*[_starts(F.split("normal", " ", -1), p) for p in base]))
    base_found = (held.withColumn("padded", F.concat(F.lit(" "), F.col("normal"), F.lit(" ")))
                  .select(*_KEY, starts.alias("starts"), _found_phrases(list(base.items())).alias("based"))
                  .filter(F.size("starts") > 0)
                  .select(F.col("id").alias("__b"), F.col("rid").alias("__br"), "starts", "based"))
    none = F.array().cast("array<string>")
    out = (files.select(*_KEY, "n_words")
           .join(base_found, F.col("id").eqNullSafe(F.col("__b")) & (F.col("rid") == F.col("__br")), "left")
           .join(own, F.col("id").eqNullSafe(F.col("__id")) & (F.col("rid") == F.col("__rid")), "left"))
    based, found = F.coalesce("based", none), F.coalesce("own", none)
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return out.select(F.col("id").alias(id_col), "n_words",
                      F.coalesce(F.size("starts"), F.lit(0)).cast("long").alias("n_base"),
                      F.array_min("starts").cast("long").alias("first_word"),
                      F.array_max("starts").cast("long").alias("last_word"), text(based).alias("base_labels"),
                      text(F.concat(based, found)).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of every document."""
    return scan(common.table(spark, sf_dir, "documents"))
