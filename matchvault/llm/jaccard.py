"""N-gram Jaccard join by prefix filters under several global token orders.

Two sets with Jaccard similarity t or more share l tokens among the first ``n - ceil(t n) + l`` of each, under *every*
total order of the tokens. Pairs that share a token of their prefixes for l = 1 under order 0 are candidates; a candidate
goes on only if its prefixes for l = ``MORE`` under each further order share as many tokens as they then must, which is
decided on two bytes of each token of these prefixes, before any whole set is read. Each order is a permutation of the
token hashes behind a common frequency class, so that frequent tokens come last. Classes only place tokens in the
orders; the result is the same for any classes. Pairs that pass all orders are compared by counts on ``PLACES`` places,
and what is left by whole sets.

A node is a distinct shingle set, so that exact copies are one node however many there are. Near copies are first hung
on one member of their group (equal smallest hash under one of ``KEYS`` permutations, as in MinHash), verified, and
joined to components; the prefix join then pairs only nodes of different components, so a large family of near copies
makes no pairs of its own. Without that first step the result is the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchvault.llm import kernels
from matchvault.llm.components import components
from matchvault.llm.store import bit_map, unused, written

ORDERS = 3
KEYS = 12
BEFORE = 32  # tokens of a node that are looked at so as not to make a pair again at a later token
MORE = 8  # tokens by which prefixes under the orders after the first are longer, less one
PLACES = 1024  # a set's tokens are counted on so many places
FREQUENT = 3  # tokens seen so often in one task's share are reported for the frequency classes
CLASSED = 1 << 18  # at most so many tokens have a class above the lowest
MAP_BITS = 24
SKETCH = 8  # words of 64 bits; each token flips one bit, so two sketches differ in no more bits than the sets in tokens
SKETCHES = [f"s{i}" for i in range(SKETCH)]
HOT = 14  # frequency class, the log of a token's count, from which on its postings never meet in a window
BROADCAST = 1_000_000
BLOCK = 1 << 19  # bytes of text worked on at once
HELD = 1 << 19  # distinct tokens that a task counts at once
SLICES = 12  # bits of a value that say where it meets its like; 32 more are compared there
DEALT = 1 << 21  # values that a task holds before it deals them out
SPARSE = 64  # bits of a map for each value in it
MOST_BITS = 29  # the logarithm of a map's bits at most


def _nodes(first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """64-bit name of each set: the scrambled sum of its scrambled tokens."""
    running = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(kernels.mix(hashes, 17), out=running[1:])
    size = np.diff(first).astype(np.uint64)
    return kernels.signed(kernels.mix(running[first[1:]] - running[first[:-1]] + size, 18))


def _profile(width):
    """Per text: node, set size, smallest hash under ``KEYS`` permutations; then the task's frequent tokens."""
    names = ["row_id", "version", "node", "n", *(f"k{i}" for i in range(KEYS)), *SKETCHES, "token", "seen"]
    schema = pa.schema([(c, pa.int32() if c == "n" else pa.int64()) for c in names])

    def run(batches):
        held, counts, loose = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        for batch in batches:
            ids = batch.column("row_id")
            for rows, data, offsets in kernels.blocks(batch, limit=BLOCK):
                hashes, first = kernels.shingles(data, offsets, width)
                sizes = np.diff(first)
                some = sizes > 0
                columns = {"row_id": ids[rows], "version": batch.column("version")[rows], "node": _nodes(first, hashes), "n": sizes.astype(np.int32)}
                for k in range(KEYS):
                    low = np.zeros(len(sizes), np.uint64)
                    if some.any():
                        low[some] = np.minimum.reduceat(kernels.mix(hashes, 30 + k), first[:-1][some])
                    columns[f"k{k}"] = kernels.signed(low)
                place = hashes & np.uint64(64 * SKETCH - 1)
                bit, word = np.uint64(1) << (place & np.uint64(63)), place >> np.uint64(6)
                for i, c in enumerate(SKETCHES):
                    flipped = np.zeros(len(sizes), np.uint64)
                    if some.any():
                        own = np.where(word == i, bit, np.uint64(0))
                        flipped[some] = np.bitwise_xor.reduceat(own, first[:-1][some])
                    columns[c] = kernels.signed(flipped)
                empty = pa.nulls(len(sizes), pa.int64())
                columns |= {"token": empty, "seen": empty}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[c]) if isinstance(columns[c], np.ndarray) else columns[c] for c in names], schema=schema
                )
                loose.append(hashes)
                if sum(map(len, loose)) >= HELD // 2:
                    held, counts = _counted(held, counts, loose)
                    loose = []
        held, counts = _counted(held, counts, loose)
        often = counts >= FREQUENT
        held, counts = held[often], counts[often]
        if len(held):
            empty = pa.nulls(len(held), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(held), pa.int32()) if c == "n" else pa.array(kernels.signed(held)) if c == "token"
                 else pa.array(counts) if c == "seen" else empty for c in names], schema=schema
            )

    return run, ", ".join(f"{c} {'int' if c == 'n' else 'long'}" for c in names)


def _counted(held, counts, loose):
    """Merge new tokens into counts; beyond ``HELD`` distinct ones the rarest are forgotten (they stay rare)."""
    both = np.concatenate([held, *loose])
    weight = np.concatenate([counts, np.ones(len(both) - len(held), np.int64)])
    order = np.argsort(both)
    both, weight = both[order], weight[order]
    at = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    held = both[at]
    counts = np.add.reduceat(weight, at) if len(at) else np.zeros(0, np.int64)
    floor = 1
    while (counts > floor).sum() > HELD:
        floor *= 2
    return (held, counts) if len(held) <= HELD else (held[counts > floor], counts[counts > floor])


def _ordered_keys(hashes, order, tokens, classes):
    """Sort key of each token under one order: frequency class in the top six bits, then the permuted hash."""
    key = kernels.mix(hashes, 50 + order) >> np.uint64(6)
    if len(tokens):
        at = np.searchsorted(tokens, hashes)
        at[at == len(tokens)] = 0
        key |= np.where(tokens[at] == hashes, classes[at], 0).astype(np.uint64) << np.uint64(58)
    return key


def _met(batches, width, wanted):
    """``(node, n, hashes, bounds)`` of the nodes first met in each block: their names, sizes and tokens."""
    met = set()
    for batch in batches:
        for rows, data, offsets in kernels.blocks(batch, limit=BLOCK):
            hashes, first = kernels.shingles(data, offsets, width)
            node, sizes = _nodes(first, hashes), np.diff(first)
            one = np.flatnonzero(sizes > 0)
            if wanted is not None and len(one):
                at = _place(node[one], batch.column("row_id")[rows].take(pa.array(one)))
                one = one[(wanted[at >> 3] >> (at & 7)) & 1 == 1]
            one = one[np.unique(node[one], return_index=True)[1]]
            one = one[np.array([x not in met for x in node[one].tolist()], dtype=bool)]
            if len(one):
                met.update(node[one].tolist())
                take = np.zeros(len(sizes), dtype=bool)
                take[one] = True
                one = np.sort(one)
                yield node[one], sizes[one], hashes[np.repeat(take, sizes)], np.concatenate([[0], np.cumsum(sizes[one])])


def _first_keys(keys, bounds, take):
    """The ``take[i]`` smallest of each set's keys, sorted, one after the other."""
    parts = []
    for low, high, p in zip(bounds[:-1], bounds[1:], take, strict=True):
        parts.append(np.sort(keys[low:high] if p == high - low else np.partition(keys[low:high], p - 1)[:p]))
    return np.concatenate(parts)


def _short(values):
    """The 44 bits by which values are told apart when it is asked which ones come again."""
    return kernels.mix(values, 73) >> np.uint64(32 - SLICES)


def repeated_map(frame: DataFrame, values):
    """``holds(values)``: which of an array's values may be among those that ``values(batches)`` yields twice or more over
    all rows of ``frame``. It never denies one that is.

    Tasks deal out four bytes of a value, many in one row, whatever the number of partitions, and nothing of the row that
    has it. The bit map grows with the repeated values to at most 2^``MOST_BITS`` bits; beyond, more is held than need be.
    """

    def dealt(held):
        x = np.sort(np.concatenate(held))
        keep = np.ones(len(x), dtype=bool)
        keep[2:] = x[2:] != x[:-2]
        x = x[keep]
        where = (x >> np.uint64(32)).astype(np.int32)
        first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        bounds = np.append(first, len(x)).astype(np.int32) * 4
        low = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(x.astype(np.uint32))])
        return pa.RecordBatch.from_arrays([pa.array(where[first]), low], names=["slice", "low"])

    def run(batches):
        held, n = [], 0
        for part in values(batches):
            held.append(_short(part))
            n += len(part)
            if n >= DEALT:
                yield dealt(held)
                held, n = [], 0
        if n:
            yield dealt(held)

    def again(table):
        x = np.sort(np.frombuffer(b"".join(table.column("low").to_pylist()), np.uint32))
        x = np.unique(x[1:][x[1:] == x[:-1]])
        return pa.table({"slice": table.column("slice")[:1], "low": pa.array([x.tobytes()], pa.binary())})

    both = "slice int, low binary"
    found = written(frame.mapInArrow(run, both).groupBy("slice").applyInArrow(again, both))
    n = (found.agg(F.sum(F.octet_length("low"))).first()[0] or 0) // 4
    rest = min(MOST_BITS, max(SLICES + 3, (SPARSE * n).bit_length())) - SLICES

    def marked(batches):
        for batch in batches:
            marks = []
            for low in batch.column("low").to_pylist():
                bits = np.zeros(1 << rest, dtype=np.uint8)
                bits[np.frombuffer(low, np.uint32) >> np.uint32(32 - rest)] = 1
                marks.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("slice"), pa.array(marks, pa.binary())], names=["slice", "low"])

    marks = found.mapInArrow(marked, both).toArrow()
    bitmap = np.zeros((1 << SLICES, 1 << (rest - 3)), dtype=np.uint8)
    for part, low in zip(marks["slice"].to_pylist(), marks["low"], strict=True):
        bitmap[part] = np.frombuffer(low.as_buffer(), np.uint8)
    bitmap = frame.sparkSession.sparkContext.broadcast(bitmap.ravel())

    def holds(x):
        at = kernels.signed(_short(x) >> np.uint64(32 - rest))
        return (bitmap.value[at >> 3] >> (at & 7)) & 1 == 1

    return holds


def _prefixes(batches, width, percent, shared):
    """``(node, keys, take)`` for blocks of nodes: the keys of their prefixes under order 0, ``take[i]`` of each."""
    tokens, classes, wanted = shared.value
    for node, n, hashes, bounds in _met(batches, width, wanted):
        take = _prefix_length(n, percent)
        yield node, _first_keys(_ordered_keys(hashes, 0, tokens, classes), bounds, take), take


def postings(texts, shared, width, percent):
    """``(node, tokens, places)``: the tokens of each node's prefix under order 0 that another node may have in its own,
    and their places in the prefix; nodes without any are left out."""
    holds = repeated_map(texts, lambda batches: (keys for _, keys, _ in _prefixes(batches, width, percent, shared)))
    schema = pa.schema([("node", pa.int64()), ("tokens", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))])

    def run(batches):
        for node, keys, take in _prefixes(batches, width, percent, shared):
            ends = np.cumsum(take)
            keep = holds(keys)
            bounds = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])]
            places = (np.arange(len(keys)) - np.repeat(ends - take, take)).astype(np.int32)
            rows = pa.RecordBatch.from_arrays(
                [pa.array(node), kernels.lists(kernels.signed(keys[keep]), bounds), kernels.lists(places[keep], bounds)], schema=schema
            )
            yield rows.filter(pa.array(np.diff(bounds) > 0))

    return texts.mapInArrow(run, "node long, tokens array<long>, places array<int>").dropDuplicates(["node"])


def _ordered(width, shared):
    """One row per node met in the task's share: its whole set under order 0."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def run(batches):
        tokens, classes, wanted = shared.value
        for node, n, hashes, bounds in _met(batches, width, wanted):
            keys = _first_keys(_ordered_keys(hashes, 0, tokens, classes), bounds, n)
            lists = kernels.lists(kernels.signed(keys), bounds)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n.astype(np.int32)), lists], schema=schema)

    return run, "node long, n int, tokens array<long>"


def _filters(width, percent, shared):
    """One row per node met: two bytes of each token of its prefixes under the orders after the first, and its counts."""
    names = [*(f"p{order}" for order in range(1, ORDERS)), "counts"]
    schema = pa.schema([("node", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in names)])

    def run(batches):
        tokens, classes, wanted = shared.value
        for node, n, hashes, bounds in _met(batches, width, wanted):
            take = _prefix_length(n, percent, MORE)
            ends = np.cumsum(take)
            arrays = [pa.array(node), pa.array(n.astype(np.int32))]
            for order in range(1, ORDERS):
                keys = _first_keys(_ordered_keys(hashes, order, tokens, classes), bounds, take)
                short = (kernels.mix(keys, 72) >> np.uint64(48)).astype(np.uint16)
                arrays.append(pa.array([np.sort(x).tobytes() for x in np.split(short, ends[:-1])], pa.binary()))
            place = (kernels.mix(hashes, 71) & np.uint64(PLACES - 1)).astype(np.int64)
            counts = [np.bincount(x, minlength=PLACES) for x in np.split(place, bounds[1:-1])]
            arrays.append(pa.array([np.minimum(c, 127).astype(np.int8).tobytes() for c in counts], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run, ", ".join(["node long", "n int", *(f"{c} binary" for c in names)])


def _common(a: bytes, b: bytes) -> int:
    """How many values two sorted lists of two-byte values share, repeated ones as often as both have them."""
    a, b = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
    if (a[1:] == a[:-1]).any() or (b[1:] == b[:-1]).any():
        a, b = np.bincount(a, minlength=1 << 16), np.bincount(b, minlength=1 << 16)
        return int(np.minimum(a, b).sum())
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _prefix_length(n, percent, extra=1):
    least = -(-percent * n // 100)
    return n - least + np.minimum(extra, least)


def _place(node, row_id):
    """Where a node's row stands in the bit map; a missing row id counts as -1."""
    mixed = kernels.mix(np.asarray(row_id.fill_null(-1), dtype=np.int64).view(np.uint64), 69) ^ node.view(np.uint64)
    return kernels.signed(kernels.mix(mixed, 70)) & ((1 << MAP_BITS) - 1)


def node_map(nodes: DataFrame) -> np.ndarray:
    """Bit map over the first row of each of ``nodes(node, low)``; its size is fixed by ``MAP_BITS``."""

    def run(batches):
        for batch in batches:
            at = _place(batch.column(0).to_numpy(), batch.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(at))], names=["at"])

    return bit_map(nodes.select("node", "low").mapInArrow(run, "at long"), MAP_BITS)


def _near(a, b, percent):
    """The bits in which two sketches differ are no more than the tokens in which the sets may differ."""
    apart = " + ".join(f"bit_count({a}sketch.{c} ^ {b}sketch.{c})" for c in SKETCHES)
    return F.expr(f"({apart}) * {100 + percent} <= ({a}n + {b}n) * {100 - percent}")


def _rows_of_ends(texts, nodes, pairs, shared_of, rows):
    """``pairs(a, b)`` with the row of both ends, ``a_n`` and so on, that the task function of ``rows`` makes of a node.

    Rows are made from the first document of each node, which the bit map singles out; should two documents of a node
    pass it, a pair comes twice with the same rows.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "low"), "node")
    run, schema = rows(shared_of(node_map(ends)))
    made = written(texts.mapInArrow(run, schema))
    for x in "ab":
        side = made.select(F.col("node").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in made.columns[1:]))
        pairs = pairs.join(side, x)
    return pairs


def intersected(texts, nodes, pairs, shared_of, width, percent):
    """The ``pairs(a, b)`` that pass the prefix filter of every order after the first, and then the one by counts.

    Of two sets that share o tokens, all shared ones up to the smaller of the two prefixes' last keys are in both prefixes,
    and the set of that prefix, of length p of n, lacks no more than n - o of them: the prefixes share p - n + o
    at least. Two bytes of a token are compared, which can only add to what is shared. A token that one set alone
    has changes one count by one, so the differences of counts (cut at 127, too) are never more than such tokens.
    """

    def run(batches):
        for batch in batches:
            n = {x: np.asarray(batch.column(f"{x}_n"), dtype=np.int64) for x in "ab"}
            both = n["a"] + n["b"]
            least = np.minimum(*(_prefix_length(n[x], percent, MORE) - n[x] for x in "ab")) - (-percent * both // (100 + percent))
            keep = np.ones(len(both), dtype=bool)
            for order in range(1, ORDERS):
                a, b = (batch.column(f"{x}_p{order}") for x in "ab")
                for i in np.flatnonzero(keep):
                    keep[i] = _common(a[i].as_py(), b[i].as_py()) >= least[i]
            a, b = (
                np.frombuffer(b"".join(batch.column(f"{x}_counts").to_pylist()), np.int8).reshape(-1, PLACES).astype(np.int16)
                for x in "ab"
            )
            keep &= np.abs(a - b).sum(axis=1) * (100 + percent) <= both * (100 - percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    both = _rows_of_ends(texts, nodes, pairs, shared_of, lambda shared: _filters(width, percent, shared))
    return written(both.mapInArrow(run, "a long, b long").distinct())


def _sharing(pairs, lists, percent):
    """The ``pairs`` whose prefixes under order 0 share as many tokens as they must: the bound of ``intersected``.

    ``lists`` has the ``tokens`` of each node's prefix that other components have too, one for each group of tokens with
    the same nodes, and the size of that group as its weight.
    """

    def run(batches):
        for batch in batches:
            n = {x: np.asarray(batch.column(f"{x}_n"), dtype=np.int64) for x in "ab"}
            least = np.minimum(*(_prefix_length(n[x], percent) - n[x] for x in "ab")) - (-percent * (n["a"] + n["b"]) // (100 + percent))
            a, b, weights = (batch.column(c) for c in ("a_tokens", "b_tokens", "a_weights"))
            keep = np.zeros(len(least), dtype=bool)
            for i in range(len(keep)):
                both = np.isin(a[i].values, b[i].values, assume_unique=True)
                keep[i] = np.asarray(weights[i].values)[both].sum() >= least[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    for x in "ab":
        pairs = pairs.join(lists.select(F.col("node").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("n", "tokens", "weights"))), x)
    return pairs.mapInArrow(run, "a long, b long")


def _verified(texts, nodes, pairs, shared_of, width, percent):
    """The ``pairs(a, b)`` that pass all filters and whose sets reach the similarity, as ``(u, v)``."""
    pairs = intersected(texts, nodes, pairs, shared_of, width, percent)
    both = _rows_of_ends(texts, nodes, pairs, shared_of, lambda shared: _ordered(width, shared))
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    fits = 100 * shared >= percent * (F.col("a_n") + F.col("b_n") - shared)
    return both.where(fits).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def _of_order(batch, k):
    """A batch's smallest hashes under permutation k, unlike those under the others."""
    return kernels.mix(np.asarray(batch.column(f"k{k}")).view(np.uint64), 80 + k)


def head_pairs(nodes, percent):
    """``(a, b)``: nodes and the head of each of their groups of equal smallest hashes.

    The head is the node whose keys are the most common: in a family of copies, the text with fewest edits.
    """
    def values(batches):
        for batch in batches:
            for k in range(KEYS):
                yield _of_order(batch, k)

    names = [f"k{k}" for k in range(KEYS)]
    holds = repeated_map(nodes.select(*names), values)

    def run(batches):
        for batch in batches:
            for k in range(KEYS):
                node, n, key = batch.select(["node", "n", f"k{k}"]).filter(pa.array(holds(_of_order(batch, k)))).columns
                order = pa.array(np.full(len(node), k, np.int32))
                yield pa.RecordBatch.from_arrays([node, n, order, key], names=["node", "n", "k", "key"])

    keyed = nodes.select("node", "n", *names).mapInArrow(run, "node long, n int, k int, key long")
    sizes = keyed.groupBy("k", "key").agg(F.log2(F.count("*")).alias("size")).where("size > 0")
    keyed = written(keyed.join(sizes, ["k", "key"]))
    ranks = keyed.groupBy("node").agg(F.sum("size").alias("rank"))
    keyed = keyed.join(ranks, "node")
    heads = keyed.groupBy("k", "key").agg(F.max(F.struct("rank", "node", "n")).alias("head"))
    stars = (
        keyed.join(heads, ["k", "key"])
        .where(f"node <> head.node AND least(n, head.n) * 100 >= greatest(n, head.n) * {percent}")
        .select(F.col("head.node").alias("a"), F.col("node").alias("b")).distinct()
    )
    sketches = nodes.select("node", F.struct("n", F.struct(*SKETCHES).alias("sketch")).alias("of"))
    for x in "ab":
        stars = stars.join(sketches.select(F.col("node").alias(x), F.col("of").alias(f"of_{x}")), x)
    return stars.where(_near("of_a.", "of_b.", percent)).select("a", "b")


def jaccard_groups(docs: DataFrame, id_col="doc_id", text_col="text", percent=75, width=5) -> DataFrame:
    """``(id, n_shingles, component_id, version)`` for every row: set size, smallest id reachable over links, and the
    ``xxhash64`` of the text, which tells rows of one id apart.

    Two sets link when ``100 * shared >= percent * union``. Sets are those of ``kernels.shingles``. A null, empty
    or blank text has an empty set and links with nothing: its component is its own id. Rows that repeat are
    returned as often as they come. A null id counts in no minimum; a component of null ids only has null.
    Other columns are ignored. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("row_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"),
    )
    run, schema = _profile(width)
    seen = written(texts.mapInArrow(run, schema))
    rows = seen.where("n IS NOT NULL")
    often = (
        seen.where("n IS NULL").groupBy("token").agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "token").limit(CLASSED).toArrow()
    )
    tokens = often["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    classes = np.ceil(np.log2(np.maximum(often["seen"].to_numpy(), 2))).astype(np.uint64)[order]
    tokens = tokens[order]

    def shared_of(wanted=None):
        return spark.sparkContext.broadcast((tokens, classes, wanted))

    keys = [f"k{i}" for i in range(KEYS)]
    nodes = written(
        rows.where("n > 0").groupBy("node").agg(
            F.min("row_id").alias("low"), F.min("n").alias("n"), *(F.min(k).alias(k) for k in [*keys, *SKETCHES])
        )
    )
    links = written(_verified(texts, nodes, written(head_pairs(nodes, percent)), shared_of, width, percent))
    roots = components(links)

    listed = postings(texts, shared_of(node_map(nodes)), width, percent).join(roots, "node", "left")
    listed = written(listed.select("node", F.coalesce("root", "node").alias("root"), "tokens", "places"))
    split = listed.select("*", F.posexplode("tokens").alias("i", "token")).select(
        "node", "root", "token", F.expr("places[i]").alias("at")
    )

    # A hot token may stand in a third of all prefixes, mostly of one family: its roots are reduced on the map side.
    hot = F.shiftrightunsigned("token", 58) >= HOT
    many = split.where(hot)
    same = Window.partitionBy("token")
    apart = many.groupBy("token").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.bit_xor(F.xxhash64("node")).alias("nodes"),
        F.count("*").alias("many"),
    ).where("least < most").select("token", "nodes", "many")
    # Tokens that more than one component has, with a signature of all nodes of the token.
    split = split.where(~hot).withColumns({
        "least": F.min("root").over(same), "most": F.max("root").over(same),
        "nodes": F.bit_xor(F.xxhash64("node")).over(same), "many": F.count("*").over(same),
    }).where("least < most").drop("least", "most")
    split = split.unionByName(many.join(apart, "token"))
    # Tokens with the same nodes make the same pairs, and one of them stands for all: the first in all of these nodes, which
    # is the first that a pair shares, if any of them is.
    split = split.groupBy("node", "root", "nodes", "many").agg(
        F.min(F.struct("token", "at")).alias("first"), F.count("*").cast("int").alias("weight")
    )
    listed = F.array_sort(F.collect_list(F.struct("first.token", "first.at", "weight")))
    sketches = nodes.select("node", "n", F.struct(*SKETCHES).alias("sketch"))
    lists = split.groupBy("node", "root").agg(listed.alias("list")).join(sketches, "node")
    lists = written(lists.select(
        "node", "root", "n", "sketch", F.col("list.token").alias("tokens"), F.col("list.at").alias("places"),
        F.col("list.weight").alias("weights"),
    ))
    split = lists.select("*", F.posexplode("tokens").alias("i", "token")).select(
        "node", "root", "n", "sketch", "token", F.expr("places[i]").alias("at"),
        F.slice("tokens", F.lit(1), F.least("i", F.lit(BEFORE))).alias("before"),
    )
    a, b = split.alias("a"), split.alias("b")
    # At the first token that a pair shares, all it shares stands at or after both places.
    shared = F.expr("least(a.n - a.at, b.n - b.at)")
    fits = F.expr("a.token = b.token AND a.root < b.root") & (
        100 * shared >= percent * (F.expr("a.n + b.n") - shared)
    ) & _near("a.", "b.", percent) & ~F.arrays_overlap("a.before", "b.before")
    pairs = a.join(b, fits).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    pairs = written(_sharing(pairs, lists, percent))
    more = _verified(texts, nodes, pairs, shared_of, width, percent)
    joined = components(links.unionByName(more))

    named = nodes.select("node", "low").join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.select("node", "root").join(lowest, "root").select("node", "component_id")
    return (
        rows.select("row_id", "version", "node", "n").join(named, "node", "left")
        .select(
            F.col("row_id").alias(id_col),
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("row_id")).otherwise(F.col("component_id")).alias("component_id"),
            "version",
        )
    )


def without_near_copies(docs: DataFrame, percent=75, width=5) -> DataFrame:
    """``docs(doc_id, text, ...)`` with one row of each group of near copies: the one with the smallest id.

    Rows with one id and one text are copies of each other; different texts under one id are different documents,
    and stay if no smaller id is in their group. Rows without an id cannot be named and stay. Other columns come back
    as they are, whatever their names.
    """
    version = unused(docs.columns, "version")
    groups = jaccard_groups(docs, percent=percent, width=width).withColumnRenamed("version", version)
    groups = written(groups)
    key = ["doc_id", version]
    gone = groups.where("doc_id <> component_id").select(*key).distinct()
    again = groups.where("doc_id = component_id").groupBy(*key).count().where("count > 1").select(*key)
    named = docs.withColumn(version, F.xxhash64(F.coalesce("text", F.lit(""))))
    stay = named.join(_small(gone), key, "left_anti")
    if not again.isEmpty():
        one = stay.join(_small(again), key, "left_semi").dropDuplicates(key)
        stay = stay.join(_small(again), key, "left_anti").unionByName(one)
    return stay.select(*docs.columns)


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast up to ``BROADCAST`` rows of two longs; larger, Spark joins by shuffling."""
    df = written(df)
    return F.broadcast(df) if df.count() <= BROADCAST else df
