"""Session helper, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

# Settings that matter at scale; a caller may change any of them through ``extra``. The
# master and the number of shuffle partitions belong to the cluster and are never set here
# unless they are passed.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",                 # runtime re-planning
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",        # split hot customer / invoice keys
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",  # broadcast only when measured small
    # a generated method over the JVM's 8,000 bytes is never compiled; without whole-stage
    # generation its expressions are split into methods that are
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # no Python stack walk for every column expression (it was a third of a plan's build time)
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def settings(master: str = None, shuffle_partitions: int = None, extra: dict = None) -> dict:
    """The configuration a session is built with."""
    conf = dict(DEFAULTS)
    if master:
        conf["spark.master"] = master
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf | (extra or {})


def get_session(master: str = None, app: str = "arcash", shuffle_partitions: int = None,
                extra: dict = None) -> SparkSession:
    b = SparkSession.builder.appName(app).config(map=settings(master, shuffle_partitions, extra))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compile_wide_stages(spark: SparkSession) -> None:
    """Give a session that was not built by ``get_session`` its limit for generated methods: above
    it the JVM never compiles them, and the clean of the invoices runs interpreted. A limit that
    the caller set is kept."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == "65535":      # Spark's own default
        spark.conf.set(key, DEFAULTS[key])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set: a folder of the driver's machine would not be seen by the
    executors. Only a local session without the setting, as in tests, gets a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="arcash-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


class RunFolder:
    """Intermediate Parquet tables of one run under the shared folder.

    The folder is named on first use. ``delete`` removes it; a folder that returned frames
    still read is removed when the process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.root = spark, name, None
        self.figures: dict = {}

    def cut(self, df: DataFrame, name: str, partition_by: str = None, observe: dict = None) -> DataFrame:
        """Write ``df`` once and read it back: one computation, and the lineage ends here.

        partition_by: one folder for each value of this column; observe: aggregates by name that
        are computed while writing and kept in ``figures[name]``.
        """
        if self.root is None:
            self.root = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/arcash-{self.name}-{uuid.uuid4().hex}"
            atexit.register(self.delete)
        path, schema = f"{self.root}/{name}", df.schema
        seen = Observation(f"{name}-{uuid.uuid4().hex}") if observe else None
        if seen:
            df = df.observe(seen, *[c.alias(n) for n, c in observe.items()])
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        if seen:
            self.figures[name] = seen.get
        out = self.spark.read.schema(schema).parquet(path)
        return out.select(*schema.names)

    def delete(self) -> None:
        if self.root is None:
            return
        root, self.root = self.root, None
        atexit.unregister(self.delete)
        try:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(root)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:       # the session has ended before the process
            pass
