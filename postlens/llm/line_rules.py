"""Line-first cleaning: rules decide on lines, what is lost decides on the document. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import WORD

#: A line must end like a sentence, white space aside.
SENTENCE_END = r'[.!?…:;"”»)][\x20\x09-\x0D]*\z'
#: Menus, tables and bread crumbs: at least three separators.
NAVIGATION = r"^(?:[^|›»]*[|›»]){3}"
#: Shouting and runs of symbols.
NOISE = r"^(?:[^!]*!!){3}|[#*$%&<>=~_]{3}"
#: What sites put around their text.
BOILERPLATE = (
    r"(?i)all rights reserved|terms of (?:use|service)|privacy policy|cookie|javascript|lorem ipsum|licensed under"
    r"|copyright|click here|sign up|log in|subscribe"
)
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: A document that loses more than this share of its word characters is rejected.
MAX_LOST_PERCENT = 50
WINDOW = 5


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def good_line(line: Column) -> Column:
    return (line.rlike(WORD) & line.rlike(SENTENCE_END) & ~line.rlike(NAVIGATION) & ~line.rlike(NOISE) & ~line.rlike(BOILERPLATE))


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows that the array holds twice or more, the first one included.

    Takes an array of word hashes. Only an array with a repeated window is sorted; each step
    binds its array once, so a lambda doesn't compute it for every element.
    """
    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[h[i + k] for k in range(window)]))

    def covered(places: Column) -> Column:
        """Words in windows at these ascending places, as (end of the last window, count)."""
        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(places, start, lambda acc, p: F.struct(
            (p + window).alias("end"), (acc["n"] + p + window - F.greatest(p, acc["end"])).cast("long").alias("n")))["n"]

    def positions(w: Column) -> Column:
        pairs = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _bind(pairs, lambda z: F.array_sort(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(z) - 1), lambda k: ((k > 0) & (z[F.greatest(k - 1, F.lit(0))]["h"] == z[k]["h"]))
                     | ((k < F.size(z) - 1) & (z[F.least(k + 1, F.size(z) - 1)]["h"] == z[k]["h"]))),
            lambda k: z[k]["i"])))

    return _bind(hashes, lambda h: F.when(F.size(h) < window + 1, F.lit(0).cast("long")).otherwise(
        _bind(windows(h), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long"))
              .otherwise(covered(positions(w))))))


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def clean_lines(docs: DataFrame, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """Judge every line of a text, remove those that fail, then judge the document by what is left.

    A line stays if it has a word, ends like a sentence and is neither navigation, noise
    nor boilerplate; of equal lines the first stays. Adds to the columns of ``docs``:
    ``__clean_text`` (the lines that stay), ``__n_words``, ``__word_chars``, ``__n_symbols``,
    ``__n_dup_lines``, ``__n_repeat_words``, ``__lost_chars`` (word characters of the lines
    removed), ``__base_failed`` and ``__kept``. A null or empty text has no words, so it
    fails for its length; its counts are 0 and its clean text is empty. Repeated rows
    are judged each; no rows give no rows. Nothing is shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n", -1)
    good = F.array_distinct(F.filter(lines, good_line))
    worded = F.filter(lines, lambda line: line.rlike(WORD))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    out = (docs.withColumn("__clean_text", F.array_join(good, "\n"))
           .withColumn("__hashes", F.transform(words, lambda w: F.xxhash64(w)))
           .withColumn("__n_dup_lines", _bind(worded, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"))
           .withColumn("__word_chars", F.length(_without(text, WHITE)).cast("long"))
           .withColumn("__n_symbols", (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long")))
    counts = _bind(F.col("__hashes"), lambda h: F.struct(F.size(h).cast("long").alias("n"), repeated_words(h).alias("repeated")))
    lost = F.col("__word_chars") - F.length(_without(F.col("__clean_text"), WHITE))
    failed = (F.col("__n_words") < MIN_WORDS) | (100 * F.col("__n_repeat_words") > MAX_REPEATED_PERCENT * F.col("__n_words"))
    return (out.withColumn("__counts", counts).withColumn("__n_words", F.col("__counts.n"))
            .withColumn("__n_repeat_words", F.col("__counts.repeated")).withColumn("__lost_chars", lost.cast("long"))
            .withColumn("__base_failed", failed)
            .withColumn("__kept", ~F.col("__base_failed") & (100 * F.col("__lost_chars") <= max_lost_percent * F.col("__word_chars")))
            .drop("__hashes", "__counts"))
