"""Periodic runs of words: descending-LCP Kruskal over the suffixes of each text.

Suffixes of a text that share a prefix of l words form the classes of level l. Going through the neighbours of the
suffix order by decreasing common prefix, classes are united (union-find, each class an ordered list of positions);
two positions that become neighbours in a class at level l and stand no more than l words apart begin a repetition
with that distance as period. The start of a run and the place one period on always become neighbours so, since a
place of the class between them would make the period smaller.

A run of length n and period q needs a common prefix of n - q words, so with bounds on length and exponent levels under
``_shallowest`` hold no seed: only positions whose first words of that number recur in their text take part.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchvault.llm import kernels

SCHEMA = "row_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _shallowest(least: int, times: int) -> int:
    """The shortest common prefix that a run of ``least`` words and ``times`` periods can begin with."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def _recurring(text, token, last, width):
    """Positions whose ``width`` words stand elsewhere in the same text too."""
    at = np.flatnonzero(np.arange(len(token)) + width <= last)
    key = kernels.mix(text[at].astype(np.uint64), 7)
    with np.errstate(over="ignore"):
        for i in range(width):
            key = key * np.uint64(kernels.BASE) + token[at + i]
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(at), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return at[again]


def _suffix_order(text, token, last, wanted):
    """``(positions, common)``: the ``wanted`` suffixes in order, and the words each shares with the one before."""
    rank = np.unique(token, return_inverse=True)[1]
    rank = np.unique(text * (rank.max() + 1) + rank, return_inverse=True)[1]
    ranks, width, n = [rank], 1, len(token)
    here = np.arange(n)
    while True:
        own = np.sort(rank[wanted])
        if (own[1:] != own[:-1]).all():
            break
        ahead = here + width
        after = np.where(ahead < last, rank[np.minimum(ahead, n - 1)] + 1, 0)
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
        ranks.append(rank)
        width *= 2
    order = wanted[np.argsort(rank[wanted])]
    low, high = order[:-1], order[1:]
    common = np.zeros(len(low), dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        a, b = low + common, high + common
        fits = (a + (1 << level) <= last[low]) & (b + (1 << level) <= last[high])
        same = fits & (ranks[level][np.minimum(a, n - 1)] == ranks[level][np.minimum(b, n - 1)])
        common += same << level
    return order, np.concatenate([[0], common])


def _united(order, common, shallowest):
    """``(i, j, level)`` of positions that become neighbours at most ``level`` apart, by uniting classes downwards."""
    edges = np.flatnonzero(common >= shallowest)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    root, places, found = list(range(len(order))), [[p] for p in order.tolist()], []
    for edge, level in zip(edges.tolist(), common[edges].tolist(), strict=True):
        a, b = edge - 1, edge
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if len(places[a]) < len(places[b]):
            a, b = b, a
        root[b] = a
        into, before = places[a], -1
        for p in places[b]:
            at = bisect_left(into, p)
            # The place before, unless it came with p: those two are neighbours since a deeper level.
            if at and into[at - 1] != before and p - into[at - 1] <= level:
                found.append((into[at - 1], p, level))
            if at < len(into) and into[at] - p <= level:
                found.append((p, into[at], level))
            into.insert(at, p)
            before = p
        places[b] = None
    return found


def block_runs(token, first, least, times):
    """``(text, start, length, period)`` arrays of the runs in a block, sorted; ``first`` has where each text begins."""
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    last = first[1:][text]
    shallowest = _shallowest(least, times)
    wanted = _recurring(text, token, last, shallowest)
    if not len(wanted):
        return none
    # Only texts with such positions go on; what follows counts words from the first of those.
    some = np.zeros(len(counts), dtype=bool)
    some[text[wanted]] = True
    kept = some[text]
    place = np.cumsum(kept) - 1
    token, text, wanted = token[kept], text[kept], place[wanted]
    bounds = np.concatenate([[0], np.cumsum(np.where(some, counts, 0))])
    begin, last = bounds[:-1][text], bounds[1:][text]
    seeds = _united(*_suffix_order(text, token, last, wanted), shallowest)
    if not seeds:
        return none
    i, j, level = np.array(seeds, dtype=np.int64).T
    period, length = j - i, j - i + level
    # What can be carried on to the left belongs to a seed further left.
    open_left = (i > begin[i]) & (token[i - 1] == token[j - 1])
    fits = ~open_left & (length >= np.maximum(least, times * period))
    i, period, length = i[fits], period[fits], length[fits]
    order = np.lexsort([period, length, i])
    i, period, length = i[order], period[order], length[order]
    # Of one stretch only the smallest period counts; the others are its multiples.
    new = np.ones(len(i), dtype=bool)
    new[1:] = (i[1:] != i[:-1]) | (length[1:] != length[:-1])
    i, period, length = i[new], period[new], length[new]
    order = np.lexsort([period, i])
    i, period, length = i[order], period[order], length[order]
    return text[i], i - begin[i], length, period


def _collapse(least, times):
    schema = pa.schema([
        ("row_id", pa.int64()), ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), ("collapsed", pa.string()),
    ])

    def run(batches):
        for batch in batches:
            for rows, data, offsets in kernels.blocks(batch):
                starts, ends, first = kernels.words(data, offsets)
                token = kernels.span_hash(kernels.prefix_hash(data), starts, ends)
                text, start, length, period = block_runs(token, first, least, times)
                raw, bounds, out = data.tobytes(), np.searchsorted(text, np.arange(len(first))), []
                for t in range(len(offsets) - 1):
                    words = raw[offsets[t] : offsets[t + 1]].split()
                    mine = slice(bounds[t], bounds[t + 1])
                    if bounds[t] < bounds[t + 1]:
                        stays = np.ones(len(words), dtype=bool)
                        for s, n, q in zip(start[mine], length[mine], period[mine], strict=True):
                            stays[s + q : s + n] = False
                        words = [words[k] for k in np.flatnonzero(stays).tolist()]
                    out.append(b" ".join(words))
                structs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row_id")[rows], pa.array(np.diff(first)),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), structs), pa.array(out, pa.binary()).cast(pa.string())],
                    schema=schema,
                )

    return run


def collapse_runs(docs: DataFrame, id_col="doc_id", text_col="text", least=6, times=4) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` for every row: its periodic runs, and its text with one period of each.

    Words are maximal stretches without white space, numbered from 0. ``runs``: every stretch of at least ``least``
    words and ``times`` (2 or more) times its smallest period that cannot be extended, by start, then period.
    ``collapsed``: the words that no run contains after its first period, joined by one space. A null, empty or blank
    text has no words, no runs and an empty text. Rows that repeat or lack an id are returned as they come, other
    columns are ignored whatever their names. A text is worked on whole, however long; words are compared by 64-bit
    hashes.
    """
    if times < 2:
        raise ValueError("a run has at least two periods")
    texts = docs.select(F.col(id_col).cast("long").alias("row_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(_collapse(least, times), SCHEMA).withColumnRenamed("row_id", id_col)


def looped(docs: DataFrame, one_in=10, id_col="doc_id", text_col="text") -> DataFrame:
    """``(id, text)`` with the end of every ``one_in``-th text, by the CRC-32 ``h`` of its id, replaced by a loop.

    With ``g = h div one_in`` and n words, those from ``a = g % n`` on repeat the first ``1 + (n - a) div (3 + g % 8)``
    of them. Rows without an id and texts without words stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    split = docs.select(
        F.col(id_col), F.col(text_col).alias("text"), F.floor(h / one_in).alias("g"), F.when(h % one_in == 0, words).alias("words")
    ).withColumn("n", F.size("words"))
    split = split.withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n AS int)")))
    split = split.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) AS int)"))
    loop = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) AS int))), 1, n - a)")
    text = F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), loop), " "))
    return split.select(F.col(id_col), F.coalesce(text, "text").alias("text"))
