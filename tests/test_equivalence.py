"""The one-shuffle plan (both split paths) equals the step-wise statement form
for all seventeen loads."""

import pytest

from chronodim.plans.pipelines import PIPELINES
from chronodim.plans.scd2 import apply_scd2
from chronodim.plans.stepwise import apply_stepwise
from conftest import SF_SMALL


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(PIPELINES))
def test_single_pass_equals_stepwise(spark, name):
    p = PIPELINES[name]
    dim, stg = p.frames(spark, SF_SMALL)
    cols = list(p.spec.dim_cols)
    want = _bag(apply_stepwise(dim, stg, p.spec, p.batch_ts).select(*cols))
    assert _bag(apply_scd2(dim, stg, p.spec, p.batch_ts, split="auto").select(*cols)) == want
    assert _bag(apply_scd2(dim, stg, p.spec, p.batch_ts, split="never").select(*cols)) == want


@pytest.mark.parametrize("name", ["pipe_merchant", "pipe_pan_info", "pipe_classification_append", "pipe_kpi_close"])
def test_bucket_split_equals_key_split(spark, name):
    """The split on touched hash buckets (for batches with too many keys to
    broadcast) gives the rows of the split on keys."""
    p = PIPELINES[name]
    dim, stg = p.frames(spark, SF_SMALL)
    want = _bag(apply_scd2(dim, stg, p.spec, p.batch_ts))
    spark.conf.set("chronodim.split.buckets", "8192")
    try:
        got = _bag(apply_scd2(dim, stg, p.spec, p.batch_ts, split="buckets"))
    finally:
        spark.conf.unset("chronodim.split.buckets")
    assert got == want
