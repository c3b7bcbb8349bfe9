"""Run queries of a repository in a process that is in another folder, as executors are that have no
copy of the package: prints ``name ok`` or ``name`` and the error, a line for each query.

Arguments: repository, tables, then names; ``-`` before a name leaves it out, no name means all."""

import sys

repo, tables, *names = sys.argv[1:]
sys.path.insert(0, repo)

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__  # noqa: E402

spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
wanted, without = {n for n in names if n[0] != "-"}, {n[1:] for n in names if n[0] == "-"}
for name, query in __spark_entry__.queries().items():
    if name not in without and (not wanted or name in wanted):
        try:
            query(spark, tables).write.format("noop").mode("overwrite").save()
            print(name, "ok", flush=True)
        except Exception as e:
            print(name, " ".join(str(e).split())[-600:], flush=True)
        __spark_entry__.clean(spark)
spark.stop()
