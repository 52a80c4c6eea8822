import gzip
import os

from workload.derive import BUCKET, _write_files, write_log_files


def test_log_files_are_written_one_by_one(tmp_path):
    at = [f"{tmp_path}/{BUCKET}/{i % 2}/{i}.json.gz" for i in range(5)]

    def rows():
        for i, path in enumerate(at):
            # No body is held back: the file before is there when the next row is asked for.
            assert all(os.path.exists(p) for p in at[:i])
            yield path, f"body {i}", i == 3

    assert list(_write_files(rows())) == [5]
    for i, path in enumerate(at):
        data = open(path, "rb").read()
        assert (data if i == 3 else gzip.decompress(data)) == f"body {i}".encode()


def test_log_files_of_a_table(spark, tmp_path):
    files = spark.createDataFrame([(f"{i}/a.json.gz", f"é {i}") for i in range(30)], "key string, body string")
    assert write_log_files(files, f"file://{tmp_path}") == 30
    assert write_log_files(files.limit(0), f"file://{tmp_path}") == 0
    assert gzip.decompress((tmp_path / BUCKET / "7" / "a.json.gz").read_bytes()).decode() == "é 7"
