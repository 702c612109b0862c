"""Bucketed tables with closed versions apart: every load gives the rows of a load of the whole
dimension, and an upsert of the batch's own versions opens no closed folder that it doesn't need."""

import pytest
from pyspark.sql import functions as F

from chronodim import DimSpec, apply_scd2
from chronodim.plans import scd2
from chronodim.plans.pipelines import PIPELINES
from chronodim.sources import buckets
from chronodim.sources.buckets import create_table, latest_manifest, load_table, read_open, read_table
from conftest import SF_SMALL

SPEC = DimSpec(name="d", keys=(("k", "src_k"),), tracked=(("a", "src_a"),), ts="at")
DIM = "k long, a string, version int, lastversion boolean, date_from string, date_to string"
OPEN = "2200-01-01"


def _dim(spark, *rows):
    return spark.createDataFrame(list(rows), DIM).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("date_from", "date_to")})


def _batch(spark, *rows):
    return spark.createDataFrame(list(rows), "src_k long, src_a string, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))


def _bag(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _history(spark, n=30):
    rows = [(k, f"a{v}", v, v == 3, f"2020-01-0{v}", OPEN if v == 3 else f"2020-01-0{v + 1}") for k in range(n) for v in (1, 2, 3)]
    return _dim(spark, *rows)


@pytest.fixture
def opened(monkeypatch):
    """The files that each load reads rows of the table from."""
    seen = []

    def watched(dim, *args, **more):
        seen.append([r[0] for r in dim.select(F.input_file_name()).distinct().collect()])
        return apply_scd2(dim, *args, **more)
    monkeypatch.setattr(scd2, "apply_scd2", watched)
    return seen


@pytest.mark.parametrize("name", sorted(PIPELINES))
def test_every_load_equals_the_load_of_the_whole_dimension(spark, tmp_path, name):
    p = PIPELINES[name]
    dim, stg = p.frames(spark, SF_SMALL)
    root = str(tmp_path / "t")
    create_table(dim, root, p.spec.partition_cols, 4, p.spec.key_cols)
    assert _bag(read_table(spark, root)) == _bag(dim)
    load_table(spark, root, stg, p.spec, p.batch_ts)
    assert _bag(read_table(spark, root)) == _bag(apply_scd2(dim, stg, p.spec, p.batch_ts))


def test_closed_folders_stay_closed(spark, tmp_path, opened):
    root, dim = str(tmp_path / "t"), _history(spark)
    batches = [_batch(spark, (7, "x", "2021-01-01"), (8, "a3", "2021-01-01"), (99, "n", "2021-01-01"), (None, "q", "2021-01-01")),
               _batch(spark, (7, "y", "2021-02-01"), (7, "z", "2021-02-02"), (99, "m", "2021-02-01"))]
    first = create_table(dim, root, ["k"], 4, ["k"])
    plan = read_open(spark, root)
    assert plan.count() == 30 and all("_closed=0" in f for f in plan.inputFiles())
    want = dim
    for batch in batches:
        load_table(spark, root, batch, SPEC)
        want = apply_scd2(want, batch, SPEC)
        assert _bag(read_table(spark, root)) == _bag(want)
    assert len(opened) == 2 and all("_closed=0" in f for files in opened for f in files)
    m = latest_manifest(spark, root)
    assert all(ids[0] == first for ids in m["closed"].values()) and max(map(len, m["closed"].values())) == 3 and m["whole"] == []
    assert _bag(read_open(spark, root)) == _bag(want.where("lastversion"))


def test_a_staged_row_on_a_closed_version_is_found(spark, tmp_path, opened):
    """The closed version belongs to the batch, its date_to is chained again."""
    root, dim = str(tmp_path / "t"), _history(spark)
    batch = _batch(spark, (7, "x", "2020-01-02"), (7, "y", "2021-01-01"), (8, "x", "2020-01-09"))
    create_table(dim, root, ["k"], 4, ["k"])
    load_table(spark, root, batch, SPEC)
    want = apply_scd2(dim, batch, SPEC)
    assert _bag(read_table(spark, root)) == _bag(want) and any("_closed=1" in f for f in opened[0])
    changed = want.join(dim, dim.columns, "left_anti").where("k = 7 and version = 2")
    assert changed.count() == 1                  # a closed version did change


def test_a_key_with_closed_versions_only_is_no_new_key(spark, tmp_path, opened):
    root = str(tmp_path / "t")
    dim = _history(spark, 4).unionByName(_dim(spark, (50, "o", 1, False, "2020-01-01", "2020-01-05"), (None, "o", 1, False, "2020-01-01", OPEN),
                                              (51, "o", 1, None, "2020-01-01", OPEN)))
    batch = _batch(spark, (50, "x", "2021-01-01"), (51, "x", "2021-01-01"), (1, "x", "2021-01-01"))
    create_table(dim, root, ["k"], 64, ["k"])
    assert len(latest_manifest(spark, root)["whole"]) == 1
    load_table(spark, root, batch, SPEC)
    assert _bag(read_table(spark, root)) == _bag(apply_scd2(dim, batch, SPEC))
    assert sum("_closed=1" in f for f in opened[0]) == 1 and len(latest_manifest(spark, root)["whole"]) == 1


def test_a_load_that_leaves_a_key_without_open_version_notes_it(spark, tmp_path):
    """A late row meets a closed version with a higher number than the current one."""
    root = str(tmp_path / "t")
    dim = _dim(spark, (1, "a", 1, True, "2020-01-01", OPEN), (1, "b", 9, False, "2020-02-01", OPEN), (2, "a", 1, True, "2020-01-01", OPEN))
    batch = _batch(spark, (1, "a", "2020-02-01"))
    create_table(dim, root, ["k"], 16, ["k"])
    assert latest_manifest(spark, root)["whole"] == []
    load_table(spark, root, batch, SPEC)
    want = apply_scd2(dim, batch, SPEC)
    assert _bag(read_table(spark, root)) == _bag(want) and want.where("k = 1 and lastversion").count() == 0
    assert len(latest_manifest(spark, root)["whole"]) == 1
    again = _batch(spark, (1, "c", "2022-01-01"))
    load_table(spark, root, again, SPEC)
    assert _bag(read_table(spark, root)) == _bag(apply_scd2(want, again, SPEC))


def test_many_closed_folders_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "MAX_FOLDERS", 2)
    root, want = str(tmp_path / "t"), _history(spark, 3)
    create_table(want, root, ["k"], 1, ["k"])
    folders = []
    for i in range(3):
        batch = _batch(spark, (1, f"x{i}", f"2021-01-0{i + 1}"))
        load_table(spark, root, batch, SPEC)
        want = apply_scd2(want, batch, SPEC)
        folders.append(len(latest_manifest(spark, root)["closed"]["0"]))
    assert folders == [2, 1, 2] and _bag(read_table(spark, root)) == _bag(want)


def test_key_of_the_table(spark, tmp_path):
    with pytest.raises(ValueError):
        create_table(_history(spark, 1), str(tmp_path / "t"), ["k"], 4, ["a"])
    with pytest.raises(ValueError):
        create_table(_history(spark, 1).withColumn("_closed", F.lit(1)), str(tmp_path / "t"), ["k"], 4)
