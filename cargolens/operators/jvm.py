"""The Java classes of this package in the JVMs of a session.

Growing and applying a tree are loops over single rows, which neither SQL nor
NumPy does well.  ``Grower.java``, ``GrowTrees.java`` and ``ApplyForest.java`` are compiled on the driver by Janino, the
compiler of Spark's generated code, and handed to the executors as a jar, the
way :func:`cargolens.session.ship_package` hands out the Python package.  No
other compiler is needed.
"""

from __future__ import annotations

import os
import pkgutil
import tempfile
import threading
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StructType

_COMPILING = threading.Lock()


def source() -> str:
    """All classes as one compilation unit: the grower once for codes of two bytes and once for four."""
    grower, *others = (pkgutil.get_data(__package__, f"{name}.java").decode() for name in ("Grower", "GrowTrees", "ApplyForest"))
    lines = [line for text in (grower.replace("CODE", "char"), grower.replace("CODE", "int"), *others) for line in text.splitlines()]
    imports = dict.fromkeys(line for line in lines if line.startswith("import "))
    return "\n".join(["package cargolens;", *imports, *[line for line in lines if not line.startswith(("import ", "package "))]])


def classes(spark: SparkSession):
    """A class loader of the driver with the classes; the executors get them too."""
    sc = spark.sparkContext
    with _COMPILING:                                         # fits run in several threads
        if getattr(sc, "_cargolens_classes", None) is None:
            compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
            compiler.setParentClassLoader(spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
            compiler.cook(source())
            jar = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cargolens-")), "cargolens-forest.jar")
            with zipfile.ZipFile(jar, "w") as out:
                for name, code in compiler.getBytecodes().items():
                    out.writestr(f"{name.replace('.', '/')}.class", bytes(code))
            sc._jsc.addJar(jar)
            sc._cargolens_classes = compiler.getClassLoader()
    return sc._cargolens_classes


def _array(spark: SparkSession, kind, args):
    values = spark.sparkContext._gateway.new_array(kind, len(args))
    for k, v in enumerate(args):
        values[k] = v
    return values


def _made(spark: SparkSession, name: str, args: tuple):
    return classes(spark).loadClass(name).getConstructors()[0].newInstance(_array(spark, spark._jvm.Object, args))


def map_partitions(df: DataFrame, name: str, schema: str, *args) -> DataFrame:
    """``df`` through the class ``name``, made from ``args``: an iterator of rows to an iterator of rows."""
    spark = df.sparkSession
    task = _made(spark, name, args)
    types = spark._jsparkSession.parseDataType(StructType.fromDDL(schema).json())
    return DataFrame(df.select("*")._jdf.mapPartitions(task, spark._jvm.org.apache.spark.sql.Encoders.row(types)), spark)


def with_column(df: DataFrame, column: str, name: str, of: str, *args) -> DataFrame:
    """``df`` with the double that the class ``name``, made from ``args``, gives for the column ``of``; worked out once a row."""
    spark = df.sparkSession
    kind = spark._jvm.java.lang.Class.forName
    udf = kind("org.apache.spark.sql.functions").getMethod("udf", _array(spark, spark._jvm.java.lang.Class, [
        kind("org.apache.spark.sql.api.java.UDF1"), kind("org.apache.spark.sql.types.DataType")]))       # by name it has another meaning
    types = spark._jsparkSession.parseDataType(DoubleType().json())
    found = udf.invoke(None, _array(spark, spark._jvm.Object, [_made(spark, name, args), types])).asNondeterministic()
    return DataFrame(df._jdf.withColumn(column, found.apply(_array(spark, spark._jvm.org.apache.spark.sql.Column, [df._jdf.col(of)]))), spark)


def heap(spark: SparkSession) -> int:
    """Bytes of an executor's heap."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        return spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    return sc._jsc.sc().executorMemory() << 20
