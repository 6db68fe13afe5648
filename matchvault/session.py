"""Session settings used by the tests and the benchmark; on a cluster the submitted conf wins."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key splits even where the join feeds a stage that wants its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def build_session(master=None, app="matchvault", **conf):
    """Session with the engine's settings; ``conf`` adds to or replaces them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, str(value))
    return builder.getOrCreate()
