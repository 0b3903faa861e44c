"""The events table as raw log lines, so that every query starts from log text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog.plans.structuring import structure
from cinderlog.session import prepare, write_table
from cinderlog.sources.files import spread

# Log text of each kind of event; {time}-like dialect differences are in the callers.
CONTENT = """CASE event_type
  WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'IOException in offerService'
    ELSE concat('PacketResponder for blk_', CAST(user_id AS VARCHAR(20)), ' and blk_-',
                CAST(user_id AS VARCHAR(20)), ' terminating') END
  WHEN 'purchase' THEN concat('Slow BlockReceiver write data to disk cost:',
    CAST(CAST(floor(value*100) AS BIGINT) AS VARCHAR(20)), 'ms (threshold=300ms)')
  WHEN 'signup' THEN concat('Retrying connect to server: mesos-master-1/10.0.0.',
    CAST(user_id % 8 AS VARCHAR(20)), ':9000. Already tried ',
    CAST(event_id % 10 AS VARCHAR(20)), ' time(s)')
  WHEN 'click' THEN concat('Receiving block blk_', CAST(user_id AS VARCHAR(20)),
    ' src: /10.0.1.', CAST(user_id % 16 AS VARCHAR(20)), ':50010 dest: /10.0.2.',
    CAST(event_id % 16 AS VARCHAR(20)), ':50011')
  ELSE concat('src: /10.0.1.', CAST(user_id % 16 AS VARCHAR(20)), ':50010, dest: /10.0.2.',
    CAST(event_id % 16 AS VARCHAR(20)), ':50010, bytes: ',
    CAST((event_id % 64 + 1) * 1048576 AS VARCHAR(20)),
    ', op: HDFS_WRITE, blockid: BP-1-10.0.0.1-2:blk_', CAST(user_id AS VARCHAR(20)),
    '_1, duration: ', CAST(CAST(floor(value*1000000) AS BIGINT) + 1 AS VARCHAR(20)))
 END"""

LEVEL = """CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN'
   WHEN 'signup' THEN 'FATAL' ELSE 'INFO' END"""

_RAW = f"""concat(date_format(ts, 'yyMMdd'), ' ', date_format(ts, 'HHmmss'), ',',
  CAST(user_id AS VARCHAR(20)), ' ', {LEVEL}, ' dfs.DataNode: ', {CONTENT})"""

# Templates of the lines above, as mined.
SLOW_TEMPLATE = "Slow BlockReceiver write data to disk <*> (threshold=300ms)"
RETRY_TEMPLATE = "Retrying connect to server: mesos-master-1<*>. Already tried <*> time(s)"
TRANSFER_TEMPLATE = "src: <*>, dest: <*>, bytes: <*> op: HDFS_WRITE, blockid: <*> duration: <*>"

_stores = {}


def table(spark: SparkSession, sf_dir, name) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir) -> DataFrame:
    """line_id, value."""
    return spread(table(spark, sf_dir, "events"), "event_id").select(
        F.col("event_id").alias("line_id"), F.expr(_RAW).alias("value")
    )


def store(spark: SparkSession, sf_dir) -> DataFrame:
    """The structured log store: raw lines of the whole table parsed, mined and written
    once per application, as the batch job does; reports and sessions read it."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _stores:
        _stores[key] = write_table(structure(raw(spark, sf_dir))[0], "store")
    return _stores[key]


def labels(spark: SparkSession, sf_dir) -> DataFrame:
    """BlockId, Label: block blk_<n> is labelled by document n."""
    return table(spark, sf_dir, "labels").select(
        F.concat(F.lit("blk_"), F.col("doc_id").cast("string")).alias("BlockId"),
        F.when(F.col("toxic") == 1, "Anomaly").otherwise("Normal").alias("Label"),
    )
