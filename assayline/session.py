"""Session for local runs. On a cluster the given session is used as it is."""

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", app: str = "assayline", **conf: str) -> SparkSession:
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
