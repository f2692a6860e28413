"""Line-first cleaning in DataFrame expressions.

Every line with a word is judged on its own; a document is then judged by what its failing lines
take away. A line fails the

* punctuation rule: no sentence end in it (a mark ``. ! ? …`` before white space or at the end,
  closing quotes and brackets allowed);
* navigation rule: more than one separator (``| > » · •``) in 20 characters;
* boilerplate rules: more than one symbol (``# * $ % & <``) or exclamation mark in 20 characters,
  or stock phrases (``PHRASES``, whole words in any case) that hold ``PHRASE_PERCENT`` of its letters or more, so
  that a word like "cookie" in a sentence, or a long text in one line, does not fail for it.

A document is rejected if its base rules fail or its passing lines hold less than
``min_kept_percent`` of the characters of all its lines.

Windows of words are compared inside the document by 64-bit hashes. Nothing is shuffled: each row is judged alone, in the JVM.

Defined results: null, empty and word-free texts have zero counts and fail the base rules;
repeated rows each get a row; a null ``doc_id`` stays null; an empty table gives no rows; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_KEPT_PERCENT = 50
REPEAT_WORDS = 5
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
LINE_SYMBOLS = "#*$%&<!"
SEPARATORS = "|>»·•"
SENTENCE_END = "[.!?…][\"'”’»)\\]]*(\\s|$)"
PHRASE_PERCENT = 33
PHRASES = (
    "cookie", "cookies", "privacy policy", "terms of use", "terms of service", "all rights reserved", "javascript",
    "lorem ipsum", "click here", "read more", "sign in", "sign up", "login", "log in", "subscribe", "newsletter",
    "share this", "follow us", "skip to content", "back to top", "powered by")
# A line without the first word of a phrase has none.
MAY_HOLD_PHRASE = "(?i)(" + "|".join(sorted({p.split()[0] for p in PHRASES})) + ")"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_LETTERS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def let(value: Column, body) -> Column:
    """``body`` of a value computed once (a lambda variable is never computed again)."""
    return F.transform(F.array(value), body)[0]


def count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def repeat_words(words: Column, size: int = REPEAT_WORDS) -> Column:
    """Words inside windows of ``size`` words that occur twice or more, the first included."""
    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - size),
                           lambda i: F.xxhash64(*(w[i + j] for j in range(size))))

    def covered(places: Column) -> Column:
        ordered = F.array_sort(places)
        return let(ordered, lambda p: F.aggregate(
            F.sequence(F.lit(1), F.size(p)), F.lit(0),
            lambda total, k: total + F.when(k == F.size(p), F.lit(size)).otherwise(
                F.least(F.lit(size), F.get(p, k) - F.get(p, k - 1)))))

    def repeated(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: F.transform(
            F.filter(F.transform(s, lambda x, k: F.struct(
                x["i"].alias("i"),
                (F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
                lambda x: x["twice"]),
            lambda x: x["i"]))

    return let(words, lambda w: F.when(F.size(w) < size, F.lit(0)).otherwise(
        let(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
            .otherwise(covered(repeated(h))))))


def phrase_heavy(line: Column) -> Column:
    """Whether stock phrases hold ``PHRASE_PERCENT`` of the line's letters (all characters beyond ASCII count as letters)."""
    # two spaces between words: a phrase takes the one on either side of it
    words = F.concat(F.lit(" "), F.regexp_replace(F.translate(line, CAPITALS, CAPITALS.lower()), NOT_LETTERS, "  "), F.lit(" "))
    phrases = " (" + "|".join(p.replace(" ", "  ") for p in PHRASES) + ") "

    def letters(text):
        return F.char_length(F.translate(text, " ", ""))

    return let(words, lambda w: 100 * (letters(w) - letters(F.regexp_replace(w, phrases, "")))
               >= PHRASE_PERCENT * letters(w))


def line_passes(line: Column) -> Column:
    length = F.char_length(line)
    return (line.rlike(SENTENCE_END)
            & (count_of(line, SEPARATORS) * 20 <= length)
            & (count_of(line, LINE_SYMBOLS) * 20 <= length)
            & ~(line.rlike(MAY_HOLD_PHRASE) & phrase_heavy(line)))


def judge(docs: DataFrame, min_words: int = MIN_WORDS,
          max_repeat_percent: int = MAX_REPEAT_PERCENT,
          min_kept_percent: int = MIN_KEPT_PERCENT, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    line_chars, kept_line_chars, clean_text, kept) of every row."""
    text = F.col("text")
    whole = docs.select(F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = whole.select(
        "doc_id", "text", split_words(text).alias("words"),
        F.filter(F.split(text, "\n", -1),
                 lambda line: F.translate(line, SPACES, "") != "").alias("lines"))
    counts = parts.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        "lines", F.filter("lines", line_passes).alias("kept_lines"))

    def characters(lines: str) -> Column:
        return F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + F.char_length(x))

    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), characters("lines").alias("line_chars"),
        characters("kept_lines").alias("kept_line_chars"),
        F.concat_ws("\n", "kept_lines").alias("clean_text")).withColumn(
        "kept", ~F.col("base_failed")
        & (100 * F.col("kept_line_chars") >= min_kept_percent * F.col("line_chars")))
