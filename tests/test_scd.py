from datetime import datetime

import pytest

from tablewright.functions.columns import row_hash
from tablewright.operators.scd import empty_dimension, scd2_hash

T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1)
OPEN = datetime(2999, 12, 31)
SCHEMA = "business_key string, attr1 string, attr2 string"


def load(dim, staging, ts):
    if dim is None:
        dim = empty_dimension(staging, ["business_key"], ["attr1", "attr2"])
    return scd2_hash(dim, staging, ["business_key"], ["attr1", "attr2"], ts)


def view(dim):
    return {(r.business_key, r.attr1, r.attr2, r.effective_start, r.effective_end, r.is_current) for r in dim.collect()}


def test_closes_and_opens_in_one_pass(spark):
    first = spark.createDataFrame([("a", "1", None), ("b", "2", "x"), (None, "3", "y")], SCHEMA)
    second = spark.createDataFrame([("a", None, "1"), ("b", "2", "x"), ("c", "4", "z"), (None, "3", "Y")], SCHEMA)
    dim = load(load(None, first, T1), second, T2)
    assert view(dim) == {
        ("a", "1", None, T1, T2, False), ("a", None, "1", T2, OPEN, True),
        ("b", "2", "x", T1, OPEN, True),
        ("c", "4", "z", T2, OPEN, True),
        (None, "3", "y", T1, T2, False), (None, "3", "Y", T2, OPEN, True),
    }
    again = load(dim, second, datetime(2024, 3, 1))
    assert view(again) == view(dim)


def test_a_key_twice_in_staging_is_an_error(spark):
    staging = spark.createDataFrame([("a", "1", None), ("a", "2", None)], SCHEMA)
    with pytest.raises(Exception, match="twice in staging"):
        load(None, staging, T1).collect()


def test_hash_tells_rows_apart(spark):
    rows = [("k", None, "b"), ("k", "b", None), ("k", "b", ""), ("k|1:b", None, None), ("k", "1:b", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert df.select(row_hash(*df.columns)).distinct().count() == len(rows)
