"""Tree fits in the executors' JVM: ``jvm/TreeFit.java``, which applies the rules of ``trees`` to packed rows.

The two classes are compiled by Janino, which every Spark installation has for its generated code, and added to the application as a
jar. A binned table is packed once into files; each job of a fit reads them in its task, so that no row is shuffled.
"""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.operators.trees import Boosting, Forest, forest_growth
from tabrisk.session import scratch_path

CLASSES = {"TreeFit": "binary", "RowStore": "string"}
PACKED_ROWS = 1 << 18  # in a file
NO_ID = -(1 << 63)  # of rows whose id is null
_lock = threading.Lock()
_made: dict[str, dict] = {}


def _instances(spark: SparkSession) -> dict:
    """The compiled functions of this application; their classes are on the executors' path."""
    sc = spark.sparkContext
    with _lock:
        if sc.applicationId not in _made:
            jvm, folder = sc._jvm, os.path.join(os.path.dirname(os.path.abspath(__file__)), "jvm")
            jar, out = os.path.join(tempfile.mkdtemp(prefix="tabrisk-jvm-"), "tabrisk-trees.jar"), {}
            with zipfile.ZipFile(jar, "w") as z:
                for name in CLASSES:
                    compiler = jvm.org.codehaus.janino.SimpleCompiler()
                    with open(os.path.join(folder, f"{name}.java"), encoding="utf-8") as f:
                        compiler.cook(f.read())
                    for part, code in dict(compiler.getBytecodes()).items():
                        z.writestr(part.replace(".", "/") + ".class", bytes(code))
                    out[name] = compiler.getClassLoader().loadClass(f"tabrisk.{name}").getDeclaredConstructors()[0].newInstance(sc._gateway.new_array(jvm.Object, 0))
            sc._jsc.addJar(jar)
            _made[sc.applicationId] = out
        return _made[sc.applicationId]


def function(spark: SparkSession, name: str):
    """A function of columns that calls one of the classes; registered in this session."""
    sql_name = f"tabrisk_{name.lower()}"
    made = _instances(spark)[name]
    kind = spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromDDL(CLASSES[name])
    spark._jsparkSession.udf().register(sql_name, made, kind)
    return lambda *c: F.call_function(sql_name, *c)


def pack(rows: DataFrame, n_features: int) -> list[tuple[int, str]]:
    """Write a binned table to files of packed columns; (rows, path) of each. Only files of finished tasks are named."""
    spark, folder = rows.sparkSession, scratch_path(rows.sparkSession, "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed():
            t = pa.Table.from_batches(held).combine_chunks()
            column = lambda name, kind, null: t.column(name).fill_null(null).to_numpy(zero_copy_only=False).astype(kind)
            w = column("w", "<f8", 0.0)
            value = b"".join([np.array([len(t), n_features], "<i4").tobytes(), column("id", "<i8", NO_ID).tobytes(), np.where(np.isnan(w), 0.0, w).tobytes(),
                              column("fold", "<i4", -1).tobytes(), column("y", "i1", -1).tobytes(), column("learn", "u1", False).tobytes(),
                              b"".join(t.column("bins").to_pylist())])
            return pa.RecordBatch.from_arrays([pa.array([len(t)], pa.int64()), pa.array([value], pa.binary())], names=["n", "value"])

        for b in batches:
            for lo in range(0, b.num_rows, PACKED_ROWS):
                held.append(b.slice(lo, PACKED_ROWS))
                if sum(h.num_rows for h in held) >= PACKED_ROWS:
                    yield packed()
                    held.clear()
        if held:
            yield packed()

    got = rows.select("id", "w", "fold", "y", "learn", "bins").mapInArrow(run, "n bigint, value binary")
    return [(r["n"], r["path"]) for r in got.select("n", function(spark, "RowStore")("value", F.lit(folder)).alias("path")).collect()]  # a row per file


def spec(setting: Boosting | Forest, held: int, seed: int, k: int, edges: np.ndarray, first: int, last: int, stops: Sequence[int], depths: Sequence[int],
         only_held: bool = False, importances: bool = False) -> bytes:
    forest = isinstance(setting, Forest)
    g = forest_growth(setting, len(edges)) if forest else setting.growth
    v = [forest, k, held, seed, setting.balanced, only_held, importances, first, last, 0 if forest else setting.step, 1 if forest else setting.rows,
         forest and setting.bootstrap, g.depth, g.leaves, g.least, g.split, g.l2, g.hessian, g.columns, g.per_node, g.random_cuts, g.symmetric,
         len(stops), *stops, len(depths), *depths, len(edges)]
    return np.concatenate([np.array(v, "<f8"), edges.astype("<f8").ravel()]).tobytes()


def fitted(spark: SparkSession, files: Sequence[tuple[int, str]], jobs: Sequence[bytes]) -> DataFrame:
    """(job, answer) of every job, each in a task that reads all files."""
    named = "\n".join(f"{n} {path}" for n, path in files)
    table = spark.createDataFrame(spark.sparkContext.parallelize([(i, bytearray(s)) for i, s in enumerate(jobs)], len(jobs)), "job int, spec binary")
    return table.select("job", function(spark, "TreeFit")(F.lit(named), "spec").alias("answer"))


def fitted_together(spark: SparkSession, files: Sequence[tuple[int, str]], job: bytes, tasks: int) -> DataFrame:
    """(job, answer) of one boosting job by tasks that run at the same time, each with its share of the rows."""
    named = f"together {tasks} {scratch_path(spark, 'sums')}\n" + "\n".join(f"{n} {path}" for n, path in files)
    table = spark.createDataFrame(spark.sparkContext.parallelize([(0, bytearray(job))] * tasks, tasks), "job int, spec binary")
    return table.select("job", function(spark, "TreeFit")(F.lit(named), "spec").alias("answer")).mapInArrow(lambda batches: batches, "job int, answer binary", barrier=True)


def read_answer(answer, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and numbers (part, row, class)."""
    n = int(np.frombuffer(answer, "<i4", 1)[0])
    return np.frombuffer(answer, "<i8", n, 4), np.frombuffer(answer, "<f8", -1, 4 + 8 * n).reshape(-1, n, k) if n else np.empty((0, 0, k))
