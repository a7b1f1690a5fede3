"""The session's side of things: the package on Python workers, the shared folder, and cut lineage."""

from __future__ import annotations

import os
import py_compile
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))


def ship(spark: SparkSession) -> None:
    """Send the package, compiled and zipped, with the tasks of this application; once.

    Python functions that Spark runs are found by name, and an executor on another machine has no copy of the
    driver's folder. A package that is itself in an archive came by ``--py-files`` and is there already.
    """
    sc = spark.sparkContext
    if getattr(sc, "_chronolake_shipped", False) or not os.path.isdir(_PACKAGE):
        return
    sc.addPyFile(archive(tempfile.mkdtemp(prefix="chronolake-")))  # the driver serves it; executors keep it in their own work folder
    sc._chronolake_shipped = True


def archive(folder: str) -> str:
    """The package, compiled, as a zip in ``folder``: its own folder may be read-only."""
    path = os.path.join(folder, "chronolake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as packed:
        for top, _, names in os.walk(_PACKAGE):
            for name in sorted(n for n in names if n.endswith(".py")):
                inside = os.path.relpath(os.path.join(top, name), os.path.dirname(_PACKAGE))
                compiled = py_compile.compile(os.path.join(top, name), cfile=os.path.join(folder, "one.pyc"), dfile=inside, doraise=True)
                packed.write(compiled, f"{inside}c")
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share; a temporary one only on a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="chronolake-checkpoint-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, suffix: str = "") -> str:
    """A name in the shared folder that is not taken."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}{suffix}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Compute now and cut lineage, in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """Compute now, as Parquet in the shared folder, and read it back."""
    path = path or new_path(df.sparkSession, ".parquet")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = _file_system(spark, path)
    return files.exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what this library wrote at ``path`` once nothing reads it any more."""
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)
