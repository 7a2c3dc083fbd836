"""Line-first cleaning: rules judge each line, and a document that loses too much of its text is rejected.

Built from Spark's own expressions alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that part words: blank and 09-0D.
SPACE = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: Base rules: fewer words, or a larger percentage of words in repeated windows, reject a document.
LEAST_WORDS = 50
MOST_REPEATED = 50
#: The largest percentage of words that the rules may remove.
MOST_LOST = 50

#: A line's rules. Percentages: symbols of its characters, marks such as !! of its words.
MOST_SYMBOLS = 10
MOST_SHOUTS = 30
#: Words from which a line in capitals fails.
LEAST_LOUD = 4
SENTENCE_END = r"[.!?…。:;][\"'”’»)\]]*$"
SENTENCE_INSIDE = r"[.!?…。][\"'”’»)\]]*\s"
SHOUT = r"[!?]{2,}"
SEPARATORS = r"[|›»•·→]|>\s|::"
MENU = r"^(home|menu|login|log in|sign in|sign up|register|search|contact|contact us|about|about us|faq|help|sitemap|next|previous|back|share|print|reply|skip to (main )?content)\W*$"
BOILERPLATE = (
    r"\b(cookies?|privacy policy|terms of (use|service)|all rights reserved|enable javascript|newsletter"
    r"|subscribe (now|to)|click here|read more|share (this|on)|follow us|powered by|add to cart)\b"
)
#: Longest lines, in words, that the navigation and the boilerplate rules judge.
NAVIGATION_WORDS = 20
BOILERPLATE_WORDS = 30


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, GAP)))


def symbol_count(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more."""
    after, behind = F.slice(words, 2, F.size(words)), F.slice(words, 3, F.size(words))
    windows = F.filter(F.arrays_zip(words.alias("a"), after.alias("b"), behind.alias("c")), lambda w: w["c"].isNotNull())
    # The hash decides nearly all comparisons of the sort; equality is that of the words.
    placed = F.sort_array(
        F.transform(windows, lambda w, i: F.struct(F.xxhash64(w["a"], w["b"], w["c"]).alias("h"), w.alias("w"), i.alias("i")))
    )

    def starts(s: Column) -> Column:
        """Starts of windows that have an equal neighbour after sorting, in text order."""
        after = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda x, y: x["w"] == y["w"])

        def chosen(same: Column) -> Column:
            marked = F.transform(
                s,
                lambda x, k: F.when(
                    F.coalesce(F.get(same, k), F.lit(False)) | F.coalesce(F.get(same, k - 1), F.lit(False)), x["i"]
                ),
            )
            return F.sort_array(F.array_compact(marked))

        return let(after, chosen)

    # Each start adds the part of its three words that lies behind what is covered.
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        let(placed, starts),
        begin,
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i + 3 - acc["end"])).alias("n"), (i + 3).alias("end")),
    )
    return F.when(F.size(words) < 3, 0).otherwise(covered["n"])


def line_fails(line: Column, n_words: Column) -> Column:
    """True where a rule fails for a line of `n_words` words."""
    chars = F.char_length(F.translate(line, SPACE, ""))
    trimmed = F.btrim(line, F.lit(SPACE))
    unpunctuated = ~trimmed.rlike(SENTENCE_END) & ~trimmed.rlike(SENTENCE_INSIDE)
    symbols = 100 * symbol_count(line) > MOST_SYMBOLS * chars
    shouts = 100 * F.regexp_count(line, F.lit(SHOUT)) > MOST_SHOUTS * n_words
    low = F.lower(trimmed)
    loud = (n_words >= LEAST_LOUD) & (F.upper(trimmed) == trimmed) & (low != trimmed)
    navigation = (n_words <= NAVIGATION_WORDS) & ((F.regexp_count(line, F.lit(SEPARATORS)) >= 2) | low.rlike(MENU))
    boilerplate = (n_words <= BOILERPLATE_WORDS) & low.rlike(BOILERPLATE)
    return unpunctuated | symbols | shouts | loud | navigation | boilerplate


def line_cleaning(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_lost: int = MOST_LOST
) -> DataFrame:
    """Counts and a verdict for every row of `df`.

    Columns: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and
    n_words_left, the words of the lines that pass every rule and are no repetition of an earlier line, and
    clean_text, those lines. A document is kept if the base rules hold and at most `most_lost` percent of its
    words go. A null text counts as empty: all counts 0, base_failed, not kept. Repeated rows give repeated
    results, a null id stays null, an empty table gives an empty result; other columns are not read. Every
    row is judged in place: nothing is shuffled, and memory is that of the longest text's words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    passing = F.filter(F.col("_distinct"), lambda x: ~let(word_count(x), lambda n: line_fails(x, n)))
    counted = df.select(
        F.col(id_col),
        text.alias("_text"),
        let(
            words_of(text),
            lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("repeated")),
        ).alias("_words"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.array_distinct(x).alias("once"))).alias("_lines"),
    ).select("*", F.col("_lines.once").alias("_distinct"))
    judged = counted.select("*", passing.alias("_passing"))
    left = F.aggregate("_passing", F.lit(0), lambda acc, x: acc + word_count(x)).cast("long")
    n_words = F.col("_words.n")
    base_failed = (n_words < LEAST_WORDS) | (100 * F.col("_words.repeated") > MOST_REPEATED * n_words)
    return judged.select(
        F.col(id_col),
        n_words.alias("n_words"),
        F.char_length(F.translate("_text", SPACE, "")).cast("long").alias("word_chars"),
        symbol_count(F.col("_text")).cast("long").alias("n_symbols"),
        (F.col("_lines.n") - F.size("_lines.once")).cast("long").alias("n_dup_lines"),
        F.col("_words.repeated").alias("n_repeat_words"),
        base_failed.alias("base_failed"),
        left.alias("n_words_left"),
        F.array_join("_passing", "\n").alias("clean_text"),
    ).withColumn("kept", ~F.col("base_failed") & (100 * (F.col("n_words") - F.col("n_words_left")) <= most_lost * F.col("n_words")))
