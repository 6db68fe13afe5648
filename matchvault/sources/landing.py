"""API payloads that were fetched to JSON files, flattened to rows.

Payloads with a declared schema come through ``read_payloads``. Where the field names of an answer are data (rosters keyed by
position, say), or payloads may be cut or empty, they are landed from text as variants: ``parsed``, then one of the
``land_`` functions that take ``fields``. A payload that is no JSON yields no rows there and is listed by ``unreadable``,
so that its key can be asked for again.
"""

from functools import reduce

from pyspark.sql import functions as F

from matchvault.functions import default_text


def read_payloads(spark, path, schema):
    """JSON documents with a declared schema; folders like ``key=value`` become tag columns."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def land_array(payloads, array, tags=()):
    """One row per element of an array field, tagged with the request's key columns."""
    return payloads.select(*tags, F.inline(F.col(array)))


def land_groups(payloads, arrays, tags=()):
    """One row per element over several array fields of one element type."""
    joined = reduce(
        lambda a, b: F.concat(a, b), [F.coalesce(F.col(a), F.array()) for a in arrays]
    )
    return payloads.select(*tags, F.inline(joined))


def request_keys(hub, key):
    """Keys to ask the source for; they stay a frame to be joined, not a list to loop over."""
    return hub.select(key).distinct()


def to_fetch(keys, payloads, key):
    """The ``keys`` for which no readable payload has landed yet; payloads as ``parsed`` returns them."""
    return keys.join(payloads.filter(F.col("_payload").isNotNull()), key, "left_anti")


def parsed(payloads, text, tags=()):
    """``tags`` and the payload as a variant, ``_payload``: NULL where the text is NULL or no JSON."""
    return payloads.select(*tags, F.try_parse_json(F.col(text)).alias("_payload"))


def unreadable(payloads):
    """Tags of the payloads that could not be parsed."""
    return payloads.filter(F.col("_payload").isNull()).drop("_payload")


def _each(df, variant):
    """A row per element of an array or entry of an object, with ``_key`` (of an entry) and ``_element``."""
    made = df.sparkSession.tvf.variant_explode(F.col(variant).outer()).toDF("_place", "_key", "_element")
    return df.lateralJoin(made).drop("_place", variant)


def _typed(df, tags, fields):
    """``fields`` is ``{column: (path, type)}`` or ``{column: (path, type, default)}``, read from each element.

    A missing field, and one that does not fit its type, is NULL or the default. Elements that are no objects are
    dropped, as they hold no fields.
    """

    def field(path, kind, default=None):
        got = F.try_variant_get("_element", f"$.{path}", kind)
        return got if default is None else F.coalesce(got, F.lit(default).cast(kind))

    objects = df.filter(F.schema_of_variant("_element").startswith("OBJECT"))
    return objects.select(*tags, *[field(*spec).alias(name) for name, spec in fields.items()])


def land_elements(payloads, array, fields, tags=()):
    """One row per element of the array at the path ``array``; payloads without it, or with an empty one, give none."""
    found = payloads.withColumn("_payload", F.try_variant_get("_payload", f"$.{array}", "variant"))
    arrays = found.filter(F.schema_of_variant("_payload").startswith("ARRAY"))
    return _typed(_each(arrays, "_payload").drop("_key"), tags, fields)


def land_entries(payloads, entry, fields, tags=()):
    """One row per element over all arrays of an object whose entries hold arrays; ``entry`` names the entry's key."""
    objects = payloads.filter(F.schema_of_variant("_payload").startswith("OBJECT"))
    arrays = _each(objects, "_payload").select(*tags, F.col("_key").alias(entry), F.col("_element").alias("_array"))
    arrays = arrays.filter(F.schema_of_variant("_array").startswith("ARRAY"))
    return _typed(_each(arrays, "_array").drop("_key"), [*tags, entry], fields)


def look_back(payloads, date, ds, days=14):
    """Payloads of the ``days`` dates that end with ``ds``."""
    day = F.lit(ds).cast("date")
    return payloads.filter(F.col(date).cast("date").between(F.date_sub(day, days - 1), day))


def flatten_defaults(df, cols):
    """Localised text structs replaced by their ``default`` text."""
    return df.withColumns({c: default_text(c) for c in cols})


def json_field(text, field, default=""):
    """A field of a JSON text, with a default where it is missing."""
    return F.coalesce(F.get_json_object(text, f"$.{field}"), F.lit(default))
