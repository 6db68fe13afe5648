"""SimHash fingerprints in DataFrame operations only.

Terms are runs of letters and digits in lower case; each occurrence votes with its length as weight, so that short
function words count little. Bit b of a term's 64-bit hash votes for or against bit b of the fingerprint. Votes are
summed for two bits at once: the sum for bit k stands in the lower half of a long, that for bit k + 32 in the upper.
Distinct fingerprints within a Hamming radius are found with permuted block tables: 64 bits in six blocks, one table
for each choice of three blocks that leaves at most ``radius`` = 3 others to hold the differing bits.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEAR = 6  # a range of 2^6 ids is sorted together
FAR = 12  # and 2^12 ranges
BLOCKS = 6
TERM_BREAK = r"[^\p{L}\p{N}]+"


def fingerprints(texts: DataFrame, keys: list[str], sides: dict[str, Column]) -> DataFrame:
    """One row for each of ``texts`` with ``keys`` and the fingerprint (a long) of each text in ``sides``.

    The keys must tell different texts apart; rows that agree in all of them are counted and given back as often.
    A text without terms has fingerprint 0. Where ``texts`` is already partitioned by one of the keys nothing is
    shuffled. Weights of a text (its letters, times the number of equal rows) may add up to 2^31.
    """
    sided = [F.struct(F.lit(i).alias("side"), F.split(F.lower(x), TERM_BREAK).alias("terms")) for i, x in enumerate(sides.values())]
    words = texts.select(*keys, F.inline(F.array(*sided))).select(*keys, "side", F.posexplode("terms").alias("at", "term"))
    words = words.select(*keys, "side", "at", F.xxhash64("term").alias("h"), F.length("term").cast("long").alias("w"))
    pair = F.lit((1 << 32) + 1)
    sums = [F.sum(F.col("w") * F.shiftright("h", k).bitwiseAND(pair)).alias(f"v{k}") for k in range(32)]
    voted = words.groupBy(*keys, "side").agg(
        F.sum("w").alias("w"), F.sum((F.col("at") == 0).cast("long")).alias("copies"), *sums
    )
    bits = F.lit(0).cast("long")
    for k in range(32):
        low, high = F.col(f"v{k}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"v{k}", 32)
        for bit, votes in ((k, low), (k + 32, high)):
            value = (1 << bit) - (1 << 64 if bit == 63 else 0)
            bits = bits.bitwiseOR(F.when(2 * votes > F.col("w"), F.lit(value)).otherwise(F.lit(0)).cast("long"))
    printed = voted.select(*keys, "side", "copies", bits.alias("print"))
    out = printed.groupBy(*keys).agg(
        F.max("copies").alias("copies"), *(F.max(F.when(F.col("side") == i, F.col("print"))).alias(c) for i, c in enumerate(sides))
    )
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def as_text(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def within_radius(prints: DataFrame, radius: int = 3) -> DataFrame:
    """All pairs ``(a, b, distance)``, ``a < b``, of the distinct longs in column ``print`` that differ in at most
    ``radius`` (1 to 5) bits. Nulls are left out. A pair is made by the first table in which it agrees.
    """
    width = [11] * 4 + [10] * 2
    at = [sum(width[:i]) for i in range(BLOCKS)]
    masks = []
    for chosen in combinations(range(BLOCKS), BLOCKS - radius):
        mask = sum(((1 << width[i]) - 1) << at[i] for i in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    tables = F.array(*(F.struct(F.lit(t).alias("t"), F.col("print").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)))
    rows = prints.select("print").where("print IS NOT NULL").distinct().select("print", F.inline(tables))
    a, b = rows.alias("a"), rows.alias("b")
    apart = F.col("a.print").bitwiseXOR(F.col("b.print"))
    first = F.coalesce(*(F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(t)) for t, m in enumerate(masks)))
    near = (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.print") < F.col("b.print"))
    near = near & (F.bit_count(apart) <= radius) & (first == F.col("a.t"))
    return a.join(b, near).select(
        F.col("a.print").alias("a"), F.col("b.print").alias("b"), F.bit_count(apart).alias("distance")
    )


def with_next(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(inner, edge)``: rows with the text of the next document, in two parts that together have every row.

    Documents follow each other by id, then text; the first follows the last. A row without an id has no next one
    (an empty text). Ids are cut into ranges of 2^``NEAR``, whose rows are sorted together, so a task holds few
    texts however many there are; only the last row of each range, in ``edge``, is joined to the next range's first.
    """
    ranged = docs.where("doc_id IS NOT NULL").withColumn("range", F.shiftright("doc_id", NEAR))
    # Joins below would add this filter to some branches only, and the exchange could not be reused.
    ranged = ranged.where("range IS NOT NULL").repartition("range")
    follow = Window.partitionBy("range").orderBy("doc_id", "text")
    led = ranged.withColumns(
        {"next_text": F.lead("text").over(follow), "more": F.lead(F.lit(1)).over(follow), "less": F.lag(F.lit(1)).over(follow)}
    )
    firsts = led.where("less IS NULL").select("range", "text")

    group = F.shiftright("range", FAR)
    ranges = docs.where("doc_id IS NOT NULL").select(F.shiftright("doc_id", NEAR).alias("range"))
    ranges = ranges.distinct().withColumn("group", group)
    groups = ranges.groupBy("group").agg(F.min("range").alias("low"))
    all_groups = Window.partitionBy(F.lit(0)).orderBy("group")
    least = F.min("low").over(Window.partitionBy(F.lit(0)))
    groups = groups.select("group", F.coalesce(F.lead("low").over(all_groups), least).alias("after"))
    within = Window.partitionBy("group").orderBy("range")
    ranges = ranges.withColumn("following", F.lead("range").over(within)).join(groups, "group")
    ranges = ranges.select("range", F.coalesce("following", "after").alias("following"))
    edge = led.where("more IS NULL").drop("more", "less", "next_text").join(ranges, "range")
    edge = edge.join(firsts.select(F.col("range").alias("following"), F.col("text").alias("next_text")), "following")
    loose = docs.where("doc_id IS NULL").withColumns({"range": F.lit(None).cast("long"), "next_text": F.lit("")})
    columns = ["range", "doc_id", "text", "next_text"]
    return led.where("more IS NOT NULL").select(*columns), edge.select(*columns).unionByName(loose.select(*columns))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_chars, edited_sha256, and the fingerprints (longs) ``print``,
    ``edited_print`` and ``next_print`` of the text, of its edited text and of the next document's text.

    The edited text has the last ``n_chars div 2`` code points replaced by the first as many of the next document.
    A null text is empty.
    """
    # An alias of an unchanged column would keep branches from sharing their exchange.
    doc_id = "doc_id" if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    base = docs.select(doc_id, F.coalesce("text", F.lit("")).alias("text"))
    parts = []
    for part in with_next(base):
        half = F.floor(F.length("text") / 2).cast("int")
        edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
        part = part.withColumn("edited", edited).select(
            "range", "doc_id", "text", "next_text", "edited", F.length("text").cast("long").alias("n_chars"),
            F.unhex(F.sha2("edited", 256)).alias("sha"), F.xxhash64("text").alias("own"), F.xxhash64("next_text").alias("other"),
        )
        keys = ["range", "doc_id", "n_chars", "sha", "own", "other"]
        sides = {"print": F.col("text"), "edited_print": F.col("edited"), "next_print": F.col("next_text")}
        parts.append(fingerprints(part, keys, sides))
    return parts[0].unionByName(parts[1]).select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "print", "edited_print", "next_print"
    )
