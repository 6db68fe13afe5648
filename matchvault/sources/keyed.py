"""Tables with one row per key, divided by key hash, where a batch rewrites only the buckets that its keys fall into.

The rows of a bucket are the files of one generation; a manifest, itself a stored table with one row per bucket, names
the generation of each. Writing the manifest's next version is the commit: readers follow the newest complete one, so
a lost job leaves the table as it was, and the files of other buckets are never read or written.
"""

from pyspark.sql import functions as F

from matchvault.operators.cdc import latest_per_key

BUCKET, GENERATION, COUNT = "_bucket", "generation", "buckets"
MANIFEST = "bucket int, generation bigint, buckets int"
_GONE, _NEW = "_keyed_gone", "_keyed_new"


class KeyedTable:
    """The table ``name`` of a ``TableStore`` with one row per ``keys``; NULL is a key value like others.

    ``buckets`` is fixed by the first write. A bucket is one task's work, so choose it such that a bucket holds a few
    million rows: the manifest, which the driver reads, has that many rows and grows with nothing else.
    """

    def __init__(self, store, name, keys, schema, buckets=64):
        self.store, self.spark = store, store.spark
        self.name, self.keys, self.schema = name, list(keys), schema
        self._manifest_name = f"{name}.manifest"
        self._folder = f"{store._folder(name)}/data"
        self._buckets = buckets

    def _state(self):
        """``{bucket: generation}`` in force, and the number of buckets."""
        if not self.store.exists(self._manifest_name):
            return {}, self._buckets
        lines = self.store.read(self._manifest_name, MANIFEST).collect()
        return {r["bucket"]: r[GENERATION] for r in lines if r["bucket"] is not None}, lines[0][COUNT]

    def manifest(self):
        """``{bucket: generation}`` in force."""
        return self._state()[0]

    def _bucket_of(self, n):
        return F.pmod(F.xxhash64(*self.keys), F.lit(n)).cast("int")

    def _empty(self):
        return self.spark.createDataFrame([], self.schema)

    def _read(self, held):
        paths = [f"{self._folder}/g={g}/{BUCKET}={b}" for b, g in sorted(held.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self._empty()

    def read(self):
        return self._read(self.manifest())

    def lookup(self, **key):
        """The row of one key, read from its bucket alone."""
        held, n = self._state()
        types = {f.name: f.dataType for f in self._empty().schema}
        one = self.spark.range(1).select(*[F.lit(key[k]).cast(types[k]).alias(k) for k in self.keys])
        bucket = one.select(self._bucket_of(n)).first()[0]
        rows = self._read({b: g for b, g in held.items() if b == bucket})
        for k in self.keys:
            rows = rows.filter(F.col(k).eqNullSafe(F.lit(key[k]).cast(types[k])))
        return rows

    def upsert(self, changes, order):
        """Write ``changes`` over the rows with their keys; within the batch the last one by ``order`` wins.

        Nothing else tells rows of one key apart, so ``order`` should be a total order. Columns that the table does not
        have are left out. Returns how many rows the rewritten buckets hold now.
        """
        return self._apply(changes.withColumn(_GONE, F.lit(False)), order)

    def delete(self, gone):
        """Remove the keys that ``gone`` lists; buckets in which none of them is found stay as they are."""
        held, n = self._state()
        keys = gone.select(*[F.col(k).alias(f"_gone_{k}") for k in self.keys]).distinct()
        hashed = keys.select(*[F.col(f"_gone_{k}").alias(k) for k in self.keys])
        listed = self._read({b: held[b] for b in self._touched(hashed, n) if b in held})
        same = [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in self.keys]
        found = listed.join(keys, same, "left_semi")
        return self._apply(found.withColumn(_GONE, F.lit(True)), self.keys)

    def _touched(self, rows, n):
        return [r[0] for r in rows.select(self._bucket_of(n)).distinct().collect()]

    def _apply(self, changes, order):
        held, n = self._state()
        touched = self._touched(changes, n)
        if not touched:
            return 0
        # One row per key first, cut down before its shuffle: a key with a third of a batch sends few rows.
        newest = latest_per_key(changes, self.keys, order).select(*self._empty().columns, _GONE)
        before = self._read({b: held[b] for b in touched if b in held})
        both = (
            before.withColumns({_GONE: F.lit(False), _NEW: F.lit(0)})
            .unionByName(newest.withColumn(_NEW, F.lit(1)))
            .withColumn(BUCKET, self._bucket_of(n))
            .repartition(BUCKET)
        )
        # Keys lie within buckets, so the window needs no exchange of its own and a bucket is written as one file.
        merged = latest_per_key(both, [BUCKET, *self.keys], [_NEW]).filter(~F.col(_GONE)).drop(_GONE, _NEW)
        generation = max(self._generations(), default=0) + 1
        path = f"{self._folder}/g={generation}"
        rows = self.store._write(merged, path, "errorifexists", [BUCKET])
        after = {b: g for b, g in held.items() if b not in set(touched)}
        self._commit(after | dict.fromkeys(self._parts(path), generation), n)
        return rows

    def _generations(self):
        return [int(c[2:]) for c in self.store._children(self._folder) if c.startswith("g=")]

    def _parts(self, path):
        """Buckets that a generation holds; those left without rows have no folder."""
        return [int(c.split("=")[1]) for c in self.store._children(path) if c.startswith(f"{BUCKET}=")]

    def _commit(self, held, n):
        # A table that became empty keeps one line without a bucket, for its number of buckets.
        lines = [(b, g, n) for b, g in held.items()] or [(None, None, n)]
        self.store.overwrite(self.spark.createDataFrame(lines, MANIFEST).coalesce(1), self._manifest_name)

    def drop_old_generations(self, keep=2):
        """Delete buckets that the last ``keep`` manifests do not name, and older manifests."""
        self.store.drop_old_versions(self._manifest_name, keep)
        named = set()
        for v in self.store._versions(self._manifest_name):
            path = f"{self.store._folder(self._manifest_name)}/v={v}"
            if self.store._is_complete(path):
                rows = self.spark.read.schema(MANIFEST).parquet(path).collect()
                named |= {(r["bucket"], r[GENERATION]) for r in rows}
        # A generation after the newest named one may be a write that has not committed yet.
        newest = max((g for _, g in named if g is not None), default=0)
        for generation in self._generations():
            for b in self._parts(f"{self._folder}/g={generation}"):
                if generation < newest and (b, generation) not in named:
                    fs, path = self.store._fs(f"{self._folder}/g={generation}/{BUCKET}={b}")
                    fs.delete(path, True)
