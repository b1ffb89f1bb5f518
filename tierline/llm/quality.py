"""Line-first cleaning: rules judge each line, failing lines go, documents that lose too much text are rejected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tierline.llm.shared import WORD, text_of, words_of

#: Phrases of boilerplate lines, and words of which navigation lines are made; lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
    "enable javascript", "powered by", "lorem ipsum", "subscribe to our", "sign up for our", "click here to",
)
NAVIGATION = (
    "home", "about", "about us", "contact", "contact us", "login", "log in", "sign in", "sign up", "register", "menu",
    "search", "next", "previous", "back to top", "read more", "share", "print", "sitemap", "help", "faq",
)

#: What ends a sentence, what may follow it, and signs that prose uses rarely.
TERMINAL = ".!?;:…。！？"
CLOSING = "\"'’”»)] \t\x0b\f\r"
SEPARATORS = "|>»•·"
SYMBOL = r"[#*$%&|<>]"


def _count(line: Column, sign: str) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit(sign), F.lit("")))) / len(sign)


def _placed(place: Column, hashed: Callable[[Column], Column]) -> Column:
    return F.struct(hashed(place).alias("hash"), place.alias("place"))


def line_view(line: Column) -> Column:
    """The line with what several rules read, so that it is computed once."""
    return F.struct(line.alias("line"), F.lower(line).alias("low"), F.length(line).alias("n"))


def line_fails(view: Column) -> Column:
    """Whether a line (see line_view) breaks a rule on punctuation, navigation or boilerplate. It has a word.

    Punctuation: no sentence ends in it, or a tenth of it are symbols, or "!!" stands in every 16 characters.
    Navigation: menu separators in every 24 characters, or it is one of the menu words. Boilerplate: known phrases.
    """
    line, low, n = view["line"], view["low"], view["n"]
    ended = F.right(F.rtrim(line, F.lit(CLOSING)), F.lit(1)).isin(*TERMINAL)
    for sign in ".!?":
        ended = ended | line.contains(sign + " ")
    shouting = line.contains("!!") & (_count(line, "!!") * 16 > n)
    punctuation = ~ended | shouting | (F.regexp_count(line, F.lit(SYMBOL)) * 10 > n)
    parted, phrase = F.lit(False), F.lit(False)
    for sign in SEPARATORS:
        parted = parted | line.contains(f" {sign} ")
    for known in BOILERPLATE:
        phrase = phrase | low.contains(known)
    navigation = low.isin(*NAVIGATION) | (parted & (F.regexp_count(line, F.lit(f" [{SEPARATORS}] ")) * 24 > n))
    return punctuation | navigation | phrase


def measured(docs: DataFrame, max_lost: float = 0.3, min_words: int = 50, max_repeated: float = 0.5) -> DataFrame:
    """Every row of `docs` with its counts, its cleaned text and the verdict, in columns named q_*.

    NULL text counts as empty; empty and blank texts have no line and fail. Repeated rows are judged one by one.
    Columns of `docs` named q_* are replaced. A document is one row at every step, so nothing is shuffled. An empty table
    gives an empty result; a text at a limit passes it.
    """
    text = text_of()
    out = docs.withColumns(
        {
            "q_list": words_of(text),
            "q_lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "q_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("long"),
        }
    )
    out = out.withColumns(
        {
            "q_words": F.size("q_list").cast("long"),
            "q_word_chars": F.char_length(F.array_join("q_list", "")).cast("long"),
            "q_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
            "q_bad": F.transform(F.transform("q_lines", line_view), line_fails),
            "q_hash": F.transform("q_list", lambda x: F.xxhash64(x)),
        }
    ).drop("q_list")
    # A window is a full 64-bit hash; about n^2 / 2^65 pairs of other windows among n are taken for equal, 10^-8 of a pair in a
    # text of a million words. Numbers sort faster than structs, so those of high hash bits and place find windows that may
    # be equal, and only these are sorted by their full hashes.
    full = lambda i: F.xxhash64(F.get("q_hash", i), F.get("q_hash", i + 1), F.get("q_hash", i + 2))
    out = out.withColumn("q_mask", F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin("q_words"))) - 1)
    out = out.withColumn("q_high", F.bitwise_not("q_mask")).withColumn(
        "q_packed",
        F.sort_array(
            F.transform(
                F.slice("q_hash", F.lit(1), F.greatest(F.size("q_hash") - 2, F.lit(0))),
                lambda x, i: full(i).bitwiseAND(F.col("q_high")).bitwiseOR(i),
            )
        ),
    )
    same = lambda x, y: F.coalesce(x.bitwiseXOR(y).between(0, F.col("q_mask")), F.lit(False))
    out = out.withColumn(
        "q_near",
        F.sort_array(
            F.transform(
                F.filter("q_packed", lambda x, i: same(x, F.get("q_packed", i + 1)) | same(x, F.get("q_packed", i - 1))),
                lambda x: _placed(x.bitwiseAND(F.col("q_mask")).cast("int"), full),
            )
        ),
    )
    equal = lambda x, y: F.coalesce(x["hash"] == y["hash"], F.lit(False))
    out = out.withColumn(
        "q_starts",
        F.sort_array(
            F.transform(
                F.filter("q_near", lambda x, i: equal(x, F.get("q_near", i + 1)) | equal(x, F.get("q_near", i - 1))),
                lambda x: x["place"],
            )
        ),
    ).withColumn(
        "q_repeat_words",
        F.aggregate(
            F.transform("q_starts", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("q_starts", i + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        ),
    )
    lost_words = F.aggregate(
        F.filter("q_lines", lambda x, i: F.get("q_bad", i)),
        F.lit(0).cast("long"),
        lambda a, x: a + F.regexp_count(x, F.lit(WORD)),
    )
    out = out.withColumns(
        {
            "q_left_words": F.when(F.array_contains("q_bad", True), F.col("q_words") - lost_words).otherwise(F.col("q_words")),
            "q_clean": F.when(
                F.array_contains("q_bad", True), F.array_join(F.filter("q_lines", lambda x, i: ~F.get("q_bad", i)), "\n")
            ).otherwise(text),
            "q_base_failed": (F.col("q_words") < min_words)
            | (100 * F.col("q_repeat_words") > int(round(100 * max_repeated)) * F.col("q_words")),
        }
    )
    lost = 100 * (F.col("q_words") - F.col("q_left_words")) > int(round(100 * max_lost)) * F.col("q_words")
    return out.withColumn("q_kept", ~F.col("q_base_failed") & ~lost).drop(
        "q_bad", "q_hash", "q_packed", "q_near", "q_starts", "q_mask", "q_high", "q_lines"
    )


def clean(docs: DataFrame, **limits: float) -> DataFrame:
    """The documents that pass, with failing lines removed from their text and n_chars set anew; columns as in `docs`.

    Columns of other names come through as they are. A line is removed with its line end; texts without a failing line
    stay as they are. NULL, empty and blank texts don't pass; repeated rows pass or go together.
    """
    rows = measured(docs.select("text", F.struct("*").alias("q_row")), **limits)
    new = {"text": F.col("q_clean"), "n_chars": F.char_length("q_clean").cast(dict(docs.dtypes).get("n_chars", "long"))}
    row = F.struct(*[new.get(c, F.col("q_row")[c]).alias(c) for c in docs.columns])
    # As an array of one row or none: a filter would be moved below the projections and repeat all of their work.
    return rows.select(F.inline(F.when(F.col("q_kept"), F.array(row)).otherwise(F.array().cast(ArrayType(docs.schema)))))


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """`measured` over all documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return measured(docs).select(
        "doc_id",
        F.col("q_words").alias("n_words"),
        F.col("q_word_chars").alias("word_chars"),
        F.col("q_symbols").alias("n_symbols"),
        F.col("q_dup_lines").alias("n_dup_lines"),
        F.col("q_repeat_words").alias("n_repeat_words"),
        F.col("q_base_failed").alias("base_failed"),
        F.col("q_kept").alias("kept"),
        F.col("q_left_words").alias("left_words"),
    )
