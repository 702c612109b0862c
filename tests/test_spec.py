import pytest

from chronodim import DimSpec

K = (("k", "k"),)
A = (("a", "a"),)


def test_columns():
    s = DimSpec(name="x", keys=(("k", "src_k"),), tracked=(("a", "src_a"),), payload=(("g", "src_k"),),
                carry=(("c", "ts"),), ts="ts")
    assert s.dim_cols == ("k", "a", "g", "c", "version", "lastversion", "date_from", "date_to")
    assert s.staging_cols == ("src_k", "src_a", "ts")
    assert s.partition_cols == ("k",)


@pytest.mark.parametrize("kw", [
    {"mode": "merge"},
    {"retire": "all"},
    {"start": "batch"},                                   # batch clock with batch-scope steps
    {"version_partition": ("zz",)},
    {"tiebreak": ("zz",)},
    {"due": "noon"},
])
def test_invalid(kw):
    with pytest.raises(ValueError):
        DimSpec(name="x", keys=K, tracked=A, ts="ts", **kw)


def test_batch_clock_needs_touched_scopes():
    DimSpec(name="x", keys=K, tracked=A, ts="ts", start="batch", retire="touched", redate="touched")
