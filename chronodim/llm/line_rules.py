"""Line-first quality rules, with DataFrame functions only.

Each line of a text is tested by itself: by its punctuation (words that end in runs of
marks or symbols, long lines without any sentence mark), as navigation (a row of
separators), and for boilerplate phrases.  Lines that fail are removed; a document that
loses more than ``MAX_LOSS`` of its characters is rejected, and so is one that fails the
document's base test (too few words, or too many in repeated five-word windows).

Defined cases: a null text counts as empty (no words: rejected by the base test); rows are
judged one by one, so ties, repeated rows and null ids change nothing; an empty table gives
no rows; other columns are passed through, whatever their names, by ``clean_documents`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, WS, as_struct, from_struct, whole_text, words

MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
MAX_LOSS = 0.5              # of a text's characters in lines that fail
NOISY_WORDS = 0.2           # of a line's words that end in runs of marks or symbols
PLAIN_WORDS = 40            # a line of so many words has a sentence mark
SYMBOLS = "#*$%&|<>"

#: The end of a word that ends in two or more marks or symbols.
NOISY = r"(?:[!?]{2,}|[#*$%&|<>~^=@+]{2,})(?:[\x20\x09-\x0D]|\z)"
#: A separator that stands alone, as in rows of links.
SEPARATOR = r"(?:\A|[\x20\x09-\x0D])[|>»›•·/](?:[\x20\x09-\x0D]|\z)"
SENTENCE_MARK = r"[.!?;:,…。！？、，؟।]"
#: Fixed phrases of page furniture.
BOILERPLATE = (r"(?i)(?:\A|[^a-z0-9])(?:accept (?:all )?cookies|cookie (?:policy|settings)|enable javascript|privacy policy|"
               r"terms of (?:use|service)|all rights reserved|click here|read more|sign in|sign up|log in|"
               r"subscribe to|add to cart|share on|skip to content|back to top|lorem ipsum)(?:[^a-z0-9]|\z)")
BOILERPLATE_WORDS = 25      # longer lines are prose that mentions the phrase


def line_fails(line: Column) -> Column:
    """True for a line to remove: punctuation, navigation and boilerplate rules in turn."""
    n = F.regexp_count(line, F.lit(WORD))
    noisy = F.regexp_count(line, F.lit(NOISY)) > F.lit(NOISY_WORDS) * n
    unmarked = (n >= PLAIN_WORDS) & ~line.rlike(SENTENCE_MARK)
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    navigation = (separators >= 3) & (separators * 5 >= n)
    boilerplate = (n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)
    return noisy | unmarked | navigation | boilerplate


def repeated_words(w: Column, n_words: Column, window: int = WINDOW):
    """The windows' hashes, and from them how many words lie in windows that occur twice or more.

    Windows are compared by hash, equal hashes then by their words.  Only texts in which
    some hash repeats are sorted.
    """
    hashes = F.when(n_words >= window, F.transform(
        F.sequence(F.lit(0), n_words - window),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)])))
    return hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h, w, window)) \
        .otherwise(F.lit(0)).cast("long")


def _covered(h: Column, w: Column, window: int) -> Column:
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"])
                          & (F.slice(w, a["i"] + 1, window) == F.slice(w, b["i"] + 1, window)), F.lit(False))

    def positions(s: Column) -> Column:
        hit = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    def total(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window)))),
                           F.lit(0), lambda a, x: a + x)

    # one-element arrays bind an intermediate array to a name
    once = F.transform(F.array(pairs), positions)
    return F.element_at(F.transform(once, total), 1)


def judged(docs: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``kept``, ``clean_text`` and
    ``lost_chars`` in one struct column ``_rules``."""
    text = whole_text("text")
    d = docs.withColumn("_t", text).withColumn("_w", words(F.col("_t")))
    d = d.withColumn("_n", F.size("_w"))
    hashes, count = repeated_words(F.col("_w"), F.col("_n"))
    d = d.withColumn("_h", hashes).withColumn("_l", F.split("_t", "\n"))
    d = d.withColumn("_good", F.filter("_l", lambda x: ~line_fails(x)))
    full = F.filter("_l", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("_full", full).withColumn("_clean", F.array_join("_good", "\n"))
    visible = F.char_length(F.array_join("_w", ""))
    lost = visible - F.char_length(F.regexp_replace("_clean", WS, ""))
    d = d.withColumn("_r", F.coalesce(count(F.col("_h")), F.lit(0).cast("long"))) \
         .withColumn("_v", visible).withColumn("_lost", lost)
    failed = (F.col("_n") < MIN_WORDS) | (100 * F.col("_r") > MAX_REPEAT_PERCENT * F.col("_n"))
    rules = F.struct(
        F.col("_n").cast("long").alias("n_words"), F.col("_v").cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        F.col("_r").alias("n_repeat_words"), failed.alias("base_failed"),
        (~failed & (F.col("_lost") <= F.lit(max_loss) * F.col("_v"))).alias("kept"),
        F.col("_lost").cast("long").alias("lost_chars"), F.col("_clean").alias("clean_text"))
    # exploding one row keeps a later filter from being pushed below, where it would repeat all this
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(rules)).alias("_rules"))


def clean_documents(docs: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """The kept documents with their failing lines removed; ``n_chars`` follows the text."""
    new = {"text": F.col("_rules.clean_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("_rules.clean_text").cast(docs.schema["n_chars"].dataType)
    d = docs.select("text", as_struct(docs.columns))
    return judged(d, max_loss).where("_rules.kept").select(*from_struct(docs.columns, new))


def rule_report(docs: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """doc_id, the statistics, base_failed, kept and lost_chars of every document."""
    return judged(docs.select("doc_id", "text"), max_loss).select("doc_id", "_rules.*").drop("clean_text")
