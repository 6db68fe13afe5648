"""Spelling variants by asymmetric q-chunks: groups of words that differ by one inserted, deleted or replaced character.

Of two words at edit distance one, the shorter (of equal ones the smaller) gives two disjoint chunks of half its length,
the other its positional grams of that length. One edit touches at most one of the chunks. If the second one is whole,
it stands where it stood, or one place on where the other word is longer; else the first one is whole and stands at the
start. So the shift is within one and known from the lengths, and the pair meets in an equi-join on (length, length
difference, place, gram). The edit distance is checked inside the join, so no pair that fails it leaves the join. The
corpus is reduced to distinct words with their counts on the map side before anything is joined.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchvault.llm.store import written

LETTERS = "[A-Za-zÀ-ÿ]+"


def letter_runs(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``(id, run)`` for every maximal run of letters of every text, lower-cased in A-Z only. Null texts have none."""
    low = F.translate(F.col(text_col), string.ascii_uppercase, string.ascii_lowercase)
    runs = F.regexp_extract_all(low, F.lit(LETTERS), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))


def damaged(runs: DataFrame, one_in: int) -> DataFrame:
    """``runs(id, run)`` with one character of about one run in ``one_in`` deleted, decided by CRC-32 of ``id:run``.

    A run whose id is null stays as it is.
    """
    h = F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select("id", F.when(h % one_in == 0, shorter).otherwise(F.col("run")).alias("run"))


def word_counts(runs: DataFrame, shortest=6, at_least=5) -> DataFrame:
    """``(word, n)`` of the distinct runs of at least ``shortest`` characters that occur at least ``at_least`` times."""
    return (
        runs.where(F.length("run") >= shortest).groupBy(F.col("run").alias("word"))
        .agg(F.count("*").alias("n")).where(F.col("n") >= at_least)
    )


def near_words(words: DataFrame) -> DataFrame:
    """``(a, b)``, once for each two of the distinct ``words(word)`` of two or more characters at edit distance one."""
    # Each character flips one bit: two words with more than two bits apart are more than one edit apart.
    flips = F.expr("aggregate(split(word, ''), 0L, (bits, c) -> bits ^ shiftleft(1L, ascii(c)))")
    sized = words.select("word", F.length("word").alias("size"), flips.alias("flips"))
    half = F.expr("size div 2")
    chunks = sized.select(
        F.col("word").alias("a"), F.col("flips").alias("a_flips"), F.col("size").alias("of"),
        F.inline(F.array(*(
            F.struct(F.lit(longer).alias("longer"), (i * (half + longer)).alias("place"),
                     F.expr(f"substring(word, {i} * (size div 2) + 1, size div 2)").alias("gram"))
            for i in (0, 1) for longer in (0, 1)
        ))),
    )
    # Of all positional grams of the other word, those at a place where a chunk can stand after one edit.
    grams = sized.select(
        F.col("word").alias("b"), F.col("flips").alias("b_flips"), F.inline(F.array(*(
            F.struct((F.col("size") - longer).alias("of"), F.lit(longer).alias("longer")) for longer in (0, 1)
        ))),
    )
    grams = grams.select("*", F.explode(F.array(F.lit(0).cast("long"), F.expr("of div 2 + longer"))).alias("place"))
    grams = grams.withColumn("gram", F.expr("substring(b, place + 1, of div 2)"))
    near = F.expr("bit_count(a_flips ^ b_flips) <= 2 AND (longer = 1 OR a < b) AND levenshtein(a, b, 1) = 1")
    met = chunks.join(grams, ["of", "longer", "place", "gram"]).where(near)
    return met.select("a", "b").distinct()


def spelling_forms(words: DataFrame, times=5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``words(word, n)``, whose words are distinct.

    ``n_near``: how many words are at edit distance one. ``form``: the one of them with the largest n (ties: the
    smallest by code points), if its n is at least ``times`` (2 or more) the word's own; else null. ``root``: the last
    word on the way from form to form, the word itself where it has none. An empty table gives an empty one.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent, or forms could go round in a circle")
    words = written(words.select("word", F.col("n").cast("long").alias("n")))
    pairs = written(near_words(words.select("word")))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    ranked = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = ranked.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    fits = -F.col("best.less") >= times * F.col("n")
    found = written(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
        )
    )
    return found.join(_roots(found, times), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(found: DataFrame, times: int) -> DataFrame:
    """``(word, root)`` of the words with a form. Each round doubles the steps taken; n grows ``times``-fold a step."""
    roots = written(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    most = found.agg(F.max("n")).first()[0] or 1
    steps, taken = math.floor(math.log(most, times)) + 1, 1
    while taken < steps:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("last"))
        roots = written(roots.join(onward, "root", "left").select("word", F.coalesce("last", "root").alias("root")))
        taken *= 2
    return roots
