"""Streaming scans: topics where the Kafka connector is installed, directories otherwise."""

from pyspark.sql import DataFrame, SparkSession

from cinderlog.functions.envelope import from_envelope


def topic_options(servers, topic, max_offsets=None, starting_offsets=None, fail_on_data_loss=None):
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if starting_offsets is not None:
        options["startingOffsets"] = starting_offsets
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    return options


def topic_values(spark: SparkSession, servers, topic, **limits) -> DataFrame:
    """A topic's messages as text in the column value. Needs the Kafka connector jar."""
    reader = spark.readStream.format("kafka").options(**topic_options(servers, topic, **limits))
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def directory_values(spark: SparkSession, path, max_files=None) -> DataFrame:
    """Lines of the files that arrive in a directory, in the column value."""
    reader = spark.readStream.schema("value string")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def rows_from_values(values: DataFrame, schema) -> DataFrame:
    """The typed rows inside JSON messages."""
    return from_envelope(values, schema)
