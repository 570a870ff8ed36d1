"""Tables, staged intermediate results and connected components on a cluster.

Intermediate results are written as Parquet below ``spark.checkpoint.dir``, the
folder that all executors share; losing an executor then costs no recomputation
and the lineage of iterative steps stays short.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, StructField, StructType

from ..session import ship

_own: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set and all runs on one machine (tests), one of our own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="colloquy-")
            atexit.register(shutil.rmtree, _own[app], True)
        where = f"file://{_own[app]}"
    return where.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: No join side is broadcast: tables that grow with the input are joined alike at every size.
_ALIKE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


class Stages:
    """Written intermediate tables of one operator run."""

    def __init__(self, spark: SparkSession, alike: bool = False):
        """alike: plan joins alike at every size of the input."""
        ship(spark)
        self.settings = {_CLEANUP: "true", **(_ALIKE if alike else {})}
        self.spark = spark
        self.root = f"{shared_dir(spark)}/colloquy-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: list[str] = []

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write df and read it back: cuts lineage, survives lost executors."""
        return self.spark.read.schema(df.schema).parquet(self.write(df, name))

    def write(self, df: DataFrame, name: str = "t") -> str:
        """Write df. Its shuffle files are of no more use then and are removed at once."""
        path = self.place(name)
        before = {k: self.spark.conf.get(k, None) for k in self.settings}
        for k, v in self.settings.items():
            self.spark.conf.set(k, v)
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        return path

    def place(self, name: str) -> str:
        """A new path, which drop() and only() delete like written tables."""
        self.count += 1
        self.paths.append(f"{self.root}/{self.count}-{name}")
        return self.paths[-1]

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that keep() wrote, once nothing later reads them."""
        gone = {f.rpartition("/")[0] for df in tables for f in df.inputFiles()}
        self._delete([p for p in self.paths if any(g.endswith(p.rpartition("//")[2]) for g in gone)])

    def only(self, *names: str) -> None:
        """Delete every table but those written under these names."""
        self._delete([p for p in self.paths if p.rpartition("/")[2].partition("-")[2] not in names])

    def _delete(self, paths: list[str]) -> None:
        jvm = self.spark._jvm
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.paths.remove(p)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Links that one task joins in memory, some 100 bytes for each; more go through rounds over the cluster.
LINKS_IN_TASK = 1 << 20


def joined_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links (a, b) in order, and for each the smallest node reachable."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while (label[x] != label[y]).any():  # roots hook on to smaller neighbours: two rounds halve their number
        u, v = label[x], label[y]
        np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
        while ((further := label[label]) != label).any():
            label = further
    return nodes, nodes[label]


def components(stages: Stages, edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over edges (a, b).

    Up to LINKS_IN_TASK links are joined by one task. More go through alternating
    large-star and small-star rounds; each is two partial aggregations and joins
    that adaptive execution can split, so a node with very many links is no hot
    task. Runs until a round changes nothing. Nodes without links have no row.
    """

    def join_all(batches):
        found = [(x.column("a").to_numpy(), x.column("b").to_numpy()) for x in batches]
        if found:
            nodes, least = joined_links(*map(np.concatenate, zip(*found)))
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.int64()), "component": pa.array(least, pa.int64())})

    def pointed(df: DataFrame, both: bool) -> DataFrame:
        if both:
            df = df.select("a", "b").unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = df.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        joined = df.join(least, "a")
        if both:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    if edges.count() <= LINKS_IN_TASK:
        return links.repartition(1).mapInArrow(join_all, "node long, component long")
    current = stages.keep(links.distinct(), "edges")
    before = None
    while True:
        larger = pointed(current, True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        following = stages.keep(pointed(larger, False), "edges")
        now = following.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        stages.drop(current)
        current = following
        if now == before or not now[0]:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


#: Parts into which the rows of a key are dealt first.
KEY_SALTS = 32


def keep_shared(df: DataFrame, key: str, dealt: list[str] | None = None) -> DataFrame:
    """Rows whose key some other row has as well.

    Passes over sorted partitions that hold back a single row, so that a key of any
    number of rows needs no memory. With ``dealt``, rows of a key are first dealt by
    these columns to KEY_SALTS parts, and only the lone row or the first row of a part
    meets the other parts': a key of very many rows is no hot task.
    """

    def run(batches, keys: list[str], sure: bool, mark: bool):
        held, before = None, None  # a row that may be alone, and the key of the last row given
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0] if batch.num_rows else held
            n = batch.num_rows
            if not n:
                continue
            values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            same = np.zeros(n + 1, bool)
            same[1:n] = np.logical_and.reduce([v[1:] == v[:-1] for v in values])
            same[0] = held is None and before is not None and all(b == v[0] for b, v in zip(before, values))
            shared = same[:-1] | same[1:]
            if mark:  # 0: alone in its part, 1: first of several, 2: another of them; the last row waits for the next
                last = n if shared[-1] else n - 1
                held = None if shared[-1] else batch.slice(n - 1)
                before = [v[-1] for v in values]
                state = shared.astype(np.int8) + same[:-1]
                out = batch.slice(0, last)
                yield pa.RecordBatch.from_arrays([*(out.column(c) for c in names), pa.array(state[:last]), out.column("_salt")], [*names, "_state", "_salt"])
                continue
            if sure:
                shared |= batch.column("_state").to_numpy() > 0
            held = None if shared[-1] else batch.slice(n - 1)
            before = [v[-1] for v in values]
            if shared.any():
                yield batch.filter(pa.array(shared)).select(names)
        if mark and held is not None:
            yield pa.RecordBatch.from_arrays([*(held.column(c) for c in names), pa.array(np.zeros(1, np.int8)), held.column("_salt")], [*names, "_state", "_salt"])

    names = df.columns
    if not dealt:
        return df.repartition(key).sortWithinPartitions(key).mapInArrow(lambda b: run(b, [key], False, False), df.schema)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*dealt), F.lit(KEY_SALTS)).cast("int"))
    marked = salted.repartition(key, "_salt").sortWithinPartitions(key, "_salt").mapInArrow(lambda b: run(b, [key, "_salt"], False, True), StructType([*df.schema.fields, StructField("_state", ByteType()), StructField("_salt", IntegerType())]))
    place = F.when(F.col("_state") == 2, F.xxhash64(*dealt)).otherwise(F.xxhash64(key))
    return marked.repartition(place).sortWithinPartitions(key).mapInArrow(lambda b: run(b, [key], True, False), df.schema)
