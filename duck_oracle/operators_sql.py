"""DuckDB oracles for the operator-level queries, in the source's SQL shapes
(LEFT JOIN … IS NULL, LEFT JOIN … AND lastversion with an OR of ``<>``,
``IN`` / tuple ``IN`` subqueries, MaxVersions and next_entries CTEs)."""

from __future__ import annotations

from chronodim.plans.queries import DUE_TS, G, LONG_HISTORY, ORDER_BATCH
from chronodim.plans.pipelines import PIPELINES
from chronodim.spec import DimSpec

from .sql import (_change_test, _order, _parse, _partition, _redate, _rewrite, due_sql, keys_of, next_start_sql,
                  on, pipeline_sql, q, steps, upto, with_sql)


def _w(g: str, ctes, final: str) -> str:
    return with_sql(G[g], ctes, final)


def _steps(g: str, last: str):
    p = G[g]
    return upto(steps(p.spec, p.batch_ts), last)


def _staged(spec: DimSpec) -> str:
    cols = [f"s.{q(sc)} AS {q(d)}" for d, sc in spec.keys + spec.tracked + spec.payload]
    return ", ".join(cols + [f"s.{q(spec.ts)} AS staged_ts"])


def _test(spec: DimSpec, cols=None, null_safe=False) -> str:
    from dataclasses import replace
    tracked = tuple(t for t in spec.tracked if cols is None or t[0] in cols)
    return _change_test(replace(spec, tracked=tracked, null_safe=null_safe), "d0")


def _changed(g: str, cols=None, null_safe=False, where_form=False) -> str:
    spec = G[g].spec
    if null_safe:
        frm = f"s JOIN d0 ON {on(spec, 'd0')} AND d0.lastversion = true WHERE {_test(spec, cols, True)}"
    elif where_form:
        frm = f"s LEFT JOIN d0 ON {on(spec, 'd0')} WHERE ({_test(spec, cols)}) AND d0.lastversion = true"
    else:
        frm = f"s LEFT JOIN d0 ON {on(spec, 'd0')} AND d0.lastversion = true WHERE {_test(spec, cols)}"
    return _w(g, [], f"SELECT {_staged(spec)}, d0.version AS cur_version FROM {frm}")


def _new_keys(g: str) -> str:
    spec = G[g].spec
    return _w(g, [], f"SELECT {_staged(spec)} FROM s LEFT JOIN d0 ON {on(spec, 'd0')} "
                     f"WHERE d0.{q(spec.key_cols[0])} IS NULL")


def _due(how: str) -> str:
    spec = G["fx4"].spec
    return _w("fx4", [], f"SELECT * FROM d0 WHERE EXISTS (SELECT 1 FROM s WHERE {on(spec, 'd0')}) "
                         f"AND {due_sql('d0.date_from', DUE_TS, how)}")


def _max(g: str, where: str, join: str = "") -> str:
    spec = G[g].spec
    return _w(g, [], f"SELECT {keys_of(spec, 'd0')}, CAST(max(d0.version) AS INTEGER) AS max_version "
                     f"FROM d0 {join} {where} GROUP BY {keys_of(spec, 'd0')}")


def _rownum(g: str) -> str:
    spec = G[g].spec
    version = f"CAST(d0.version + row_number() OVER (PARTITION BY {_partition(spec)} ORDER BY {_order(spec)}) AS INTEGER)"
    return _w(g, [], f"SELECT {_staged(spec)}, {version} AS version FROM s LEFT JOIN d0 ON {on(spec, 'd0')} "
                     f"AND d0.lastversion = true WHERE {_test(spec)}")


def _insert_new_dup_column() -> str:
    p = PIPELINES["pipe_bank_terminal"]
    return with_sql(p, upto(steps(p.spec, p.batch_ts), "ins_new"), "SELECT * FROM ins_new")


def _flag_on_latest() -> str:
    spec = G["fx2_append"].spec
    lat = (f"SELECT {keys_of(spec, 'd1')}, max(d1.version) AS max_version FROM d1 "
           f"WHERE EXISTS (SELECT 1 FROM s WHERE {on(spec, 'd1')}) GROUP BY {keys_of(spec, 'd1')}")
    final = (f"SELECT {_rewrite(spec, 'd1', lastversion='CASE WHEN d1.version = lat1.max_version THEN true ELSE d1.lastversion END')} "
             f"FROM d1 LEFT JOIN lat1 ON {on(spec, 'd1', 'lat1', False)}")
    return _w("fx2_append", _steps("fx2_append", "d1") + [("lat1", lat)], final)


def _flag_off_touched() -> str:
    spec = G["fx1"].spec
    case = (f"CASE WHEN d0.lastversion = true AND EXISTS (SELECT 1 FROM s WHERE {on(spec, 'd0')}) "
            f"THEN false ELSE d0.lastversion END")
    return _w("fx1", [], f"SELECT {_rewrite(spec, 'd0', lastversion=case)} FROM d0")


def _redate_only(scope: str) -> str:
    spec = G["fx1"].spec
    return _w("fx1", _steps("fx1", "d2") + _parse(_redate(spec, "d2", scope)), "SELECT * FROM fin")


def _second_latest() -> str:
    spec = G["fx2"].spec
    cols = ", ".join(q(c) for c in spec.dim_cols)
    return _w("fx2", [], f"SELECT {cols} FROM (SELECT d0.*, row_number() OVER (PARTITION BY {keys_of(spec, 'd0')} "
                         f"ORDER BY d0.version DESC, d0.date_from DESC) AS rn FROM d0) x WHERE rn = 2")


def _build() -> dict[str, str]:
    f1, f2, f4 = G["fx1"].spec, G["fx2"].spec, G["fx4"].spec
    carry = _w("fx1", [], f"SELECT {_staged(f1)}, d0.configuration_date, d0.version AS cur_version "
                          f"FROM s LEFT JOIN d0 ON {on(f1, 'd0')} AND d0.lastversion = true WHERE {_test(f1)}")
    c1 = G["fx1_close"].spec
    plus_one = _w("fx1_close", [], f"SELECT {_staged(c1)}, CAST(d0.version + 1 AS INTEGER) AS version "
                                   f"FROM s LEFT JOIN d0 ON {on(c1, 'd0')} "
                                   f"WHERE ({_test(c1)}) AND d0.lastversion = true")
    batch = f"EXISTS (SELECT 1 FROM s WHERE {on(f1, 'd2')} AND d2.date_from = s.{q(f1.ts)})"
    return {
        "staging_scan": "SELECT " + ", ".join(ORDER_BATCH.staging_cols) + " FROM orders",
        "dimension_scan": with_sql(PIPELINES["pipe_merchant"], [], "SELECT * FROM d0"),
        "bucketed_load": pipeline_sql(PIPELINES["pipe_merchant"]),
        "closed_apart_load": pipeline_sql(PIPELINES["pipe_pan_info"]),
        "current_version_scan": _w("fx1", [], "SELECT * FROM d0 WHERE d0.lastversion = true"),
        "insert_new_with_defaults": _w("fx1", _steps("fx1", "d1"), "SELECT * FROM d1"),
        "insert_new_dup_column": _insert_new_dup_column(),
        "carry_forward_config_date": carry,
        "next_version_plus_one": plus_one,
        "append_version_numbers": _w("fx2_append", _steps("fx2_append", "d1"), "SELECT * FROM d1"),
        "close_due_filter_date": _due("date"),
        "close_due_filter_midnight": _due("midnight"),
        "changed_rows_or": _changed("fx1"),
        "changed_rows_null_safe": _changed("fx1", null_safe=True),
        "changed_rows_single": _changed("fx1", cols=("seg",)),
        "changed_rows_where_current": _changed("fx4", where_form=True),
        "changed_rows_composite": _changed("fx3"),
        "second_latest_version": _second_latest(),
        "new_keys_1": _new_keys("fx1"),
        "new_keys_2": _new_keys("fx2"),
        "new_keys_3": _new_keys("fx3"),
        "new_keys_4": _new_keys("fx4"),
        "batch_rows": _w("fx1", _steps("fx1", "d2"), f"SELECT * FROM d2 WHERE {batch}"),
        "max_version_touched_join": _max("fx4", "", f"JOIN s ON {on(f4, 'd0')}"),
        "max_version_touched_in": _max("fx1", f"WHERE d0.{q('k')} IN (SELECT s.{q('src_k')} FROM s)"),
        "max_version_touched_tuple_in": _max("fx2", "WHERE (d0.k1, d0.k2) IN (SELECT s.src_k1, s.src_k2 FROM s)"),
        "max_version_all": _max("fx2", ""),
        "max_version_batch": _w("fx1", _steps("fx1", "mv"),
                                f"SELECT {keys_of(f1, 'mv')}, CAST(mv.max_version AS INTEGER) AS max_version FROM mv"),
        "next_version_rownum": _rownum("fx1"),
        "next_version_narrow_partition": _rownum("fx2_narrow"),
        "next_start_touched": _w("fx2", [], next_start_sql(f2, "d0", "touched")),
        "next_start_batch": _w("fx1", _steps("fx1", "d2"), next_start_sql(f1, "d2", "batch")),
        "flag_off_touched": _flag_off_touched(),
        "flag_on_latest": _flag_on_latest(),
        "retire_older_batch": _w("fx1", _steps("fx1", "d3"), "SELECT * FROM d3"),
        "retire_older_touched": _w("fx1_touched", _steps("fx1_touched", "d3"), "SELECT * FROM d3"),
        "redate_touched": _redate_only("touched"),
        "redate_batch": _redate_only("batch"),
        "close_previous_1": _w("fx1_close", _steps("fx1_close", "fin"), "SELECT * FROM fin"),
        "close_previous_4": _w("fx4_close", _steps("fx4_close", "fin"), "SELECT * FROM fin"),
        "long_histories": _w("fx2", [], f"SELECT {keys_of(f2, 'd0')}, count(*) AS versions, "
                                        f"CAST(max(d0.version) AS INTEGER) AS max_version FROM d0 "
                                        f"GROUP BY {keys_of(f2, 'd0')} HAVING count(*) >= {LONG_HISTORY}"),
    }


OPERATOR_SQL = _build()
