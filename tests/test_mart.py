"""The whole mart: the shared staged latest frame gives the same tables as
ranking inside every table, and the staging folder is removed afterwards."""

import datetime as dt
import glob
import os
import tempfile

from loanweave.plans.mart import MART_TABLES, OBSERVED_TABLES, run_mart
from loanweave.session import scratch_path
from loanweave.sources.snapshot import portfolio_snapshot

from conftest import SF_SMALL

D = dt.date(2024, 2, 1)
AS_OF = dt.datetime(2024, 2, 1, 6)


def test_shared_and_per_table_latest_give_the_same_mart(spark):
    snap = portfolio_snapshot(spark, SF_SMALL)
    shared, separate = tempfile.mkdtemp(prefix="mart-"), tempfile.mkdtemp(prefix="mart-")
    a = run_mart(spark, snap, shared, D, AS_OF, observed=True, ranking="shared")
    b = run_mart(spark, snap, separate, D, AS_OF, observed=True)
    c = run_mart(spark, snap, tempfile.mkdtemp(prefix="mart-"), D, AS_OF, ranking="late")
    assert set(a) == set(b) == set(MART_TABLES) | set(OBSERVED_TABLES) and set(c) == set(MART_TABLES)
    for name in a:
        x, y = spark.read.parquet(a[name]), spark.read.parquet(b[name])
        assert x.count() == y.count(), name
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
        if name in c:
            z = spark.read.parquet(c[name])
            assert z.exceptAll(y).count() == 0 and y.exceptAll(z).count() == 0, name
    # staged latest frames are dropped after the run
    assert glob.glob(os.path.join(scratch_path(spark, "staging"), "latest_*")) == []
