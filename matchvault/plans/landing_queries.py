"""Landing of nested payloads: the tables written as API answers, one text per request, and landed again as rows."""

from pyspark.sql import functions as F

from matchvault.plans.registry import query, table
from matchvault.sources import landing

# Requests whose answer was cut off on the way: their rows do not land.
CUT = 7
DS, DAYS = "2024-01-20", 14


def _answers(df, keys, body):
    """``keys`` and ``answer``, the JSON text of ``body``; cut short for some keys."""
    text = F.to_json(body)
    cut = F.pmod(F.xxhash64(*keys) if len(keys) > 1 else F.col(keys[0]), F.lit(50)) == CUT
    return df.select(*keys, F.when(cut, F.substring(text, 1, 20)).otherwise(text).alias("answer"))


def conversation_answers(spark, sf_dir):
    """An array per key: ``{"turns": [{"turn", "role": {"default"}, "text"}]}``; every fifth role is missing."""
    role = F.when(F.col("turn") % 5 != 4, F.struct(F.col("role").alias("default"))).alias("role")
    turns = F.collect_list(F.struct("turn", role, "text")).alias("turns")
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns)
    return _answers(grouped, ["conv_id"], F.struct("turns"))


def event_answers(spark, sf_dir):
    """An object of arrays per key: ``{"click": [{"event_id", "value", "props": {"k"}}], "view": [...], ...}``."""
    element = F.struct("event_id", "value", F.from_json("props", "k bigint").alias("props"))
    lists = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.collect_list(element).alias("list"))
    entries = lists.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "list"))).alias("body"))
    return _answers(entries, ["user_id"], F.col("body"))


def day_answers(spark, sf_dir):
    """An array per date: ``{"day": {"standings": [{"event_id", "user_id", "value"}]}}``."""
    rows = table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    grouped = rows.groupBy("date").agg(F.collect_list(F.struct("event_id", "user_id", "value")).alias("standings"))
    return grouped.select("date", F.to_json(F.struct(F.struct("standings").alias("day"))).alias("answer"))


@query(
    "land_array_per_key",
    f"""SELECT conv_id, turn, CASE WHEN turn % 5 <> 4 THEN role ELSE '' END AS role, length(text) AS n_chars,
        md5(text) AS text_md5 FROM conversations WHERE conv_id % 50 <> {CUT}""",
)
def land_array_per_key(spark, sf_dir):
    answers = landing.parsed(conversation_answers(spark, sf_dir), "answer", ["conv_id"])
    fields = {"turn": ("turn", "bigint"), "role": ("role.default", "string", ""), "text": ("text", "string")}
    rows = landing.land_elements(answers, "turns", fields, ["conv_id"])
    return rows.select("conv_id", "turn", "role", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


@query(
    "land_object_of_arrays",
    f"""SELECT user_id, event_type, event_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events WHERE user_id % 50 <> {CUT}""",
)
def land_object_of_arrays(spark, sf_dir):
    answers = landing.parsed(event_answers(spark, sf_dir), "answer", ["user_id"])
    fields = {"event_id": ("event_id", "bigint"), "value": ("value", "double"), "k": ("props.k", "bigint")}
    return landing.land_entries(answers, "event_type", fields, ["user_id"])


@query(
    "land_array_per_date",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS date, event_id, user_id, value FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '{DS}' - {DAYS - 1} AND DATE '{DS}'""",
)
def land_array_per_date(spark, sf_dir):
    asked = landing.look_back(day_answers(spark, sf_dir), "date", DS, DAYS)
    answers = landing.parsed(asked, "answer", ["date"])
    fields = {"event_id": ("event_id", "bigint"), "user_id": ("user_id", "bigint"), "value": ("value", "double")}
    rows = landing.land_elements(answers, "day.standings", fields, ["date"])
    return rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    "keys_to_fetch",
    f"""SELECT DISTINCT user_id, 'cut' AS why FROM events WHERE user_id % 50 = {CUT}
        UNION ALL SELECT DISTINCT c_custkey, 'never asked' FROM customer
        WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
)
def keys_to_fetch(spark, sf_dir):
    """Keys of a hub (users and customers) whose answer is missing or unreadable."""
    users = landing.request_keys(table(spark, sf_dir, "events"), "user_id")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    answers = landing.parsed(event_answers(spark, sf_dir), "answer", ["user_id"])
    missing = landing.to_fetch(landing.request_keys(users.unionByName(customers), "user_id"), answers, "user_id")
    cut = landing.unreadable(answers).withColumn("why", F.lit("cut"))
    return missing.join(cut, "user_id", "left").select("user_id", F.coalesce("why", F.lit("never asked")).alias("why"))
