import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from auditlake.session import RECOMMENDED  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[8]")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))))
    for k, v in RECOMMENDED.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # No checksum files: each costs forked chmods on a local disk.
    local = session._jvm.org.apache.hadoop.fs.FileSystem.getLocal(session._jsc.hadoopConfiguration())
    local.setWriteChecksum(False)
    yield session
    session.stop()
