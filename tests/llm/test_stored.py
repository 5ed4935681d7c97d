import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored, temporary


def test_temporary_tables_go_and_lasting_ones_stay(spark):
    with temporary(spark):
        a = stored(spark.range(5), "a")
        with temporary(spark):
            b = stored(a.withColumn("x", F.col("id") * 2), "b")
            c = stored(b.filter("x > 2"), "c", lasting=True)
        assert os.path.isdir(a.stored_at) and not os.path.isdir(b.stored_at) and c.count() == 3
        d = stored(c, "d", lasting=True)
    assert not os.path.isdir(a.stored_at) and not os.path.isdir(c.stored_at) and d.count() == 3
    outside = stored(spark.range(2), "e")
    with pytest.raises(ZeroDivisionError), temporary(spark):
        f = stored(outside, "f")
        1 / 0
    assert not os.path.isdir(f.stored_at) and outside.count() == 2
