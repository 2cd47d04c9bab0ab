import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (SparkSession.builder.master("local[4]").appName("stairfare-tests")
         .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Values of one expression over a list of inputs, in input order."""
    def run(values, fn, ddl="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
        from pyspark.sql import functions as F
        return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]
    return run


def dec(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))
