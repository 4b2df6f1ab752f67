"""Session settings the jobs are planned for."""

from pyspark.sql import SparkSession

# Plan settings used by tests and the bench, and advised on a cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key in a join even where that costs another shuffle further on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Per-customer tables hold one row per (cutoff, customer) and lie hashed by customer; a join on
    # both keys may use that layout as it is.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # The generated code of some 95 window aggregates is one large method; this lets it be compiled.
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    # Checkpoints carry intermediate tables: keep them small, and drop them once unused.
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Long column lists are built here; recording a call site for each expression doubles that time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(app="buycast"):
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def local_session(cpus=8, app="buycast", memory="8g"):
    """A small session for tests and the bench."""
    spark = (
        builder(app)
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        # the small test files would all be broadcast, which leaves one task per file; with the
        # larger ones shuffled, the plans are those of a cluster and use all cores
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
