"""Column names of the user that a load also uses, rows of one timestamp, and new keys
staged many times: the same rows from every form of a load."""

import itertools
import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from chronodim import DimSpec, apply_scd2
from chronodim.plans.stepwise import apply_stepwise
from chronodim.sources.buckets import create_table, load_table, read_table
from chronodim.sources.io import publish, read_dim, read_staging

FORMS = {
    "window": lambda d, s, spec: apply_scd2(d, s, spec, "2024-01-20 12:00:00", skew="off"),
    "hot": lambda d, s, spec: apply_scd2(d, s, spec, "2024-01-20 12:00:00", skew="all"),
    "stepwise": lambda d, s, spec: apply_stepwise(d, s, spec, "2024-01-20 12:00:00"),
}
MODES = {
    "upsert": dict(),
    "number": dict(new_keys="number", redate="touched", retire="touched"),
    "append_all": dict(mode="append_all"),
    "close_previous": dict(mode="close_previous", start="batch", close_numbering="row_number"),
}
#: The load's own names, its struct fields, and names that need quoting.
NAMES = ["v", "kind", "Cur", "_stg", "_ts", "_kind", "cur_version", "max_version", "a.b", "back`tick", "_seen", "column0"]
PLAIN = [f"p{i}" for i in range(len(NAMES))]
BOOK = "version int, lastversion boolean, date_from timestamp_ntz, date_to timestamp_ntz"


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _forms(spec):
    """The step-wise form inserts new keys as the statements do."""
    return [(name, run) for name, run in FORMS.items() if name != "stepwise" or spec.new_keys == "one"]


def _spec(n, **options):
    """Key, five tracked columns, a carried one; the other columns of the dimension aren't named."""
    return DimSpec(name="d", keys=((n[0], n[9]),), tracked=tuple((c, c) for c in n[1:6]), carry=((n[6], n[10]),), ts=n[8], **options)


def _tables(spark, n):
    rng = random.Random(3)
    value = [None, "x", "y"]
    dim = [(k, *[rng.choice(value) for _ in range(5)], rng.randrange(9), f"o{k}{v}", None, f"q{k}", "r", "s",
            v + 1, v == 1, None, None) for k in range(6) for v in range(2)]
    stg = [(k, *[rng.choice(value) for _ in range(5)], rng.randrange(9), rng.randrange(3)) for k in range(10) for _ in range(4)]
    d = spark.createDataFrame(dim, ", ".join(f"`{c.replace('`', '``')}` " + ("int" if i in (0, 6) else "string") for i, c in enumerate(n)) + ", " + BOOK)
    when = F.expr("timestamp_ntz'2020-01-01'") + F.make_dt_interval(F.col("version"))
    d = d.withColumn("date_from", when).withColumn("date_to", F.when(F.col("lastversion"), F.expr("timestamp_ntz'2200-01-01'")).otherwise(when))
    s = spark.createDataFrame(stg, "k int, t1 string, t2 string, t3 string, t4 string, t5 string, c int, day int")
    names = [n[9], *n[1:6], n[10], n[8]]
    s = s.withColumn("day", F.expr("timestamp_ntz'2021-01-01'") + F.make_dt_interval("day"))
    return d, s.toDF(*names)


@pytest.mark.parametrize("mode", MODES)
def test_any_column_name(spark, mode):
    """Values under the load's own names come out as they do under plain ones."""
    spec = _spec(PLAIN, **MODES[mode])
    d, s = _tables(spark, PLAIN)
    want = [tuple(r) for r in FORMS["window"](d, s, spec).collect()]
    d, s = _tables(spark, NAMES)
    spec = _spec(NAMES, **MODES[mode])
    for form, run in _forms(spec):
        out = run(d, s, spec)
        n = len(spec.dim_cols)                  # the step-wise form writes the columns of the spec only
        assert out.columns == [*spec.dim_cols, *[c for c in NAMES if c not in spec.dim_cols and form != "stepwise"]]
        assert _bag(out) == sorted((r[:n] if form == "stepwise" else r for r in want), key=repr)


def test_any_column_name_in_tables(spark, tmp_path):
    d, s = _tables(spark, NAMES)
    spec = _spec(NAMES)
    want = _bag(apply_scd2(d, s, spec))
    publish(d, str(tmp_path / "snap"))
    got = apply_scd2(read_dim(spark, str(tmp_path / "snap"), spec, other_columns=True), read_staging(spark, s, spec), spec)
    assert _bag(got) == want
    create_table(d, str(tmp_path / "buckets"), [NAMES[0]], 4)
    load_table(spark, str(tmp_path / "buckets"), s, spec)
    held = read_table(spark, str(tmp_path / "buckets"))
    assert sorted((tuple(r[c] for c in got.columns) for r in held.collect()), key=repr) == want
    with pytest.raises(ValueError):             # a bucketed table has two names of its own
        create_table(d.withColumn("_bucket", F.lit(1)), str(tmp_path / "no"), [NAMES[0]], 4)


TIES = DimSpec(name="t", keys=(("k", "k"),), tracked=(("a", "a"),), payload=(("note", "note"),), ts="ts")


@pytest.mark.parametrize("mode", MODES)
def test_rows_of_one_timestamp_are_numbered_alike(spark, mode):
    """Six staged rows with one timestamp, in any order and partitioning, for old and new keys."""
    spec = replace(TIES, **MODES[mode])
    d = spark.createDataFrame([(1, "old", "n", 1, True)], "k int, a string, note string, version int, lastversion boolean") \
             .withColumn("date_from", F.expr("timestamp_ntz'2020-01-01'")).withColumn("date_to", F.expr("timestamp_ntz'2200-01-01'"))
    rows = [(k, a, n) for k in (1, 2, None) for a, n in [("x", "1"), ("x", None), (None, "2"), ("y", "3"), ("y", "1"), ("z", "0")]]
    seen = set()
    for turn, (_, run) in itertools.product(range(2), _forms(spec)):
        random.Random(turn).shuffle(rows)
        s = spark.createDataFrame(rows, "k int, a string, note string").repartition(1 + 4 * turn) \
                 .withColumn("ts", F.expr("timestamp_ntz'2021-01-01'"))
        seen.add(tuple(_bag(run(d, s, spec))))
    assert len(seen) == 1


def _new_key(spark, n, differing=0):
    return spark.range(n).select(F.lit(1).alias("k"), F.when(F.col("id") < differing, F.col("id").cast("string")).otherwise("a").alias("a"),
                                 F.lit(None).cast("string").alias("note"),
                                 (F.expr("timestamp_ntz'2021-01-01'") + F.make_dt_interval(secs=F.col("id"))).alias("ts"))


@pytest.mark.parametrize("skew", ["off", "all"])
def test_equal_rows_of_a_new_key_load_in_linear_time(spark, skew):
    """1,000,000 equal rows of one new key are 1,000,000 rows of version 1, in about ten times the time of 100,000."""
    spec = replace(TIES, carry=(("first", "ts"),))
    none = spark.createDataFrame([], f"k int, a string, note string, first timestamp_ntz, {BOOK}")
    took = {}
    for n in (1_000, 100_000, 1_000_000):
        t = time.monotonic()
        got = apply_scd2(none, _new_key(spark, n), spec, skew=skew).groupBy("version", "lastversion").count().collect()
        took[n] = time.monotonic() - t
        assert [tuple(r) for r in got] == [(1, True, n)]
    assert took[1_000_000] < 20 * took[100_000] + 5


@pytest.mark.parametrize("form", ["window", "hot"])
def test_rows_that_differ_from_many_equal_ones(spark, form):
    """3 rows that differ from 2,000 equal ones and from each other: 2,003 + 2 * 3 * 2,000 + 6 rows."""
    none = spark.createDataFrame([], f"k int, a string, note string, {BOOK}")
    out = FORMS[form](none, _new_key(spark, 2003, 3), TIES)
    r = out.agg(F.count("*"), F.countDistinct("version"), F.max("version"), F.sum((F.col("version") == 1).cast("int"))).first()
    assert tuple(r) == (2003 + 12_006, 12_007, 12_007, 2003)
