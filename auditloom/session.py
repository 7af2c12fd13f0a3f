"""Session builder for standalone runs."""

from pyspark.sql import SparkSession


def build_session(master=None, shuffle_partitions=None, app_name="auditloom", **conf):
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # A pipeline has more generated classes than the default cache of 100 holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # Above 2,000 reducers block sizes are averaged; report skewed ones exactly,
        # or the adaptive skew join cannot see a hot partition.
        .config("spark.shuffle.accurateBlockSkewedFactor", "5")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    context = spark.sparkContext
    if shuffle_partitions is None and context.master.startswith("local"):
        shuffle_partitions = context.defaultParallelism
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark
