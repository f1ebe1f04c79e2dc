"""Writes to a few folders keep a file open in each instead of sorting rows by folder."""

from pricelens.session import OPEN_FILES, session_conf


def test_settings_of_a_write_are_taken_back(spark):
    key = next(iter(OPEN_FILES))
    before = spark.conf.get(key)
    with session_conf(spark, OPEN_FILES):
        assert spark.conf.get(key) == OPEN_FILES[key] != before
    assert spark.conf.get(key) == before
