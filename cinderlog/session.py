"""Session set-up and the shared scratch folder."""

import contextlib
import contextvars
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

_scope = contextvars.ContextVar("scratch_scope", default="")


def build_session(app_name="cinderlog", master=None, conf=None):
    """A session for the jobs. They rely on adaptive execution, which is on by default:
    it merges small shuffle partitions and splits skewed ones. On a cluster set
    spark.sql.shuffle.partitions to several times its cores and let it shrink from there."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Log times carry no zone: read and print them as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The application's folder under spark.checkpoint.dir. A machine-local folder is
    taken only in local mode, where every task runs on this machine."""
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="cinderlog-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/cinderlog-{context.applicationId}{_scope.get()}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _hadoop_path(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _hadoop_path(spark, path)
    return system.exists(target)


def children(spark: SparkSession, path: str) -> list:
    """Names in a folder, hidden ones included; none if there is no such folder."""
    system, target = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename to a name that is not taken, in one step where the file system has such a rename
    (HDFS, local disks; object stores copy). False if the name is taken."""
    system, to = _hadoop_path(spark, target)
    if system.exists(to):
        return False
    system.mkdirs(to.getParent())
    return system.rename(_hadoop_path(spark, source)[1], to)


def remove(spark: SparkSession, path: str) -> None:
    system, target = _hadoop_path(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str):
    """The text of a small file; None if there is no such file."""
    system, target = _hadoop_path(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole under a name that is not taken; False if it is."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/_{name}-{uuid.uuid4().hex}"
    system, target = _hadoop_path(spark, draft)
    stream = system.create(target)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if move(spark, draft, path):
        return True
    remove(spark, draft)
    return False


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Tables written inside the block are dropped at its end. For work that repeats in
    one application, such as micro-batches."""
    token = _scope.set(f"{_scope.get()}/scope-{uuid.uuid4().hex[:12]}")
    try:
        yield
    finally:
        system, target = _hadoop_path(spark, scratch_root(spark))
        _scope.reset(token)
        system.delete(target, True)


def write_table(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost
    executors, and gives Catalyst a measured size to choose join strategies by."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
