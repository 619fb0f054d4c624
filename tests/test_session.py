"""Settings that bound the memory of a task."""

from obsvar.session import TASK_BYTES, small_tasks
from obsvar.sources import star


def test_large_tasks_are_cut_and_smaller_settings_stay(spark, tmp_path):
    before = {key: spark.conf.get(key) for key in TASK_BYTES}
    try:
        for large in ("64MB", "1g", "134217728b", "134217728", "1p"):
            for key in TASK_BYTES:
                spark.conf.set(key, large)
            small_tasks(spark)
            assert {k: int(spark.conf.get(k)) for k in TASK_BYTES} == TASK_BYTES
        for small in ("16k", "1m", "1024"):
            for key in TASK_BYTES:
                spark.conf.set(key, small)
            star.Tables(spark, str(tmp_path))
            assert {spark.conf.get(k) for k in TASK_BYTES} == {small}
        for key in TASK_BYTES:
            spark.conf.set(key, "64m")
        star.Tables(spark, str(tmp_path))
        assert {k: int(spark.conf.get(k)) for k in TASK_BYTES} == TASK_BYTES
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
