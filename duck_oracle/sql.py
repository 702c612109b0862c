"""DuckDB oracles for the seventeen loads.

Each load is written as the source's statement sequence: one CTE per INSERT or
UPDATE, each reading the state the statement before it left (``d0`` → ``d1``
→ …).  An ``UPDATE … FROM`` becomes a left join to its derived table and a
``CASE`` on the updated column.  Defects that cannot run are written by their
evident intent, as in the library (per-key second-latest version, ``<`` in
the batch-clock retire step, touched-row re-dating for the batch clock).
"""

from __future__ import annotations

from chronodim.plans.pipelines import Pipeline
from chronodim.spec import BOOKKEEPING, CURRENT, DATE_FROM, DATE_TO, VERSION, DimSpec

from .fixtures_sql import FIXTURE_SQL

SENT = "TIMESTAMP '2200-01-01 00:00:00'"


def q(c: str) -> str:
    return f'"{c}"'


def on(spec: DimSpec, a: str, b: str = "s", b_staging: bool = True) -> str:
    """Key equality between dimension-named alias ``a`` and ``b``."""
    return " AND ".join(f"{a}.{q(d)} = {b}.{q(sc if b_staging else d)}" for d, sc in spec.keys)


def keys_of(spec: DimSpec, a: str) -> str:
    return ", ".join(f"{a}.{q(d)}" for d in spec.key_cols)


def stg_name(spec: DimSpec, dim_col: str) -> str:
    return dict(spec.keys + spec.tracked + spec.payload)[dim_col]


def _new_select(spec: DimSpec, version: str, current: str, date_from: str, carry: dict | None = None) -> str:
    m = {d: f"s.{q(sc)}" for d, sc in spec.keys + spec.tracked + spec.payload}
    for d, sc in spec.carry:
        m[d] = (carry or {}).get(d, f"s.{q(sc)}")
    m.update({VERSION: version, CURRENT: current, DATE_FROM: date_from, DATE_TO: SENT})
    return ", ".join(f"{m[c]} AS {q(c)}" for c in spec.dim_cols)


def _rewrite(spec: DimSpec, src: str, **set_) -> str:
    return ", ".join(f"{set_[c]} AS {q(c)}" if c in set_ else f"{src}.{q(c)}" for c in spec.dim_cols)


def _change_test(spec: DimSpec, a: str) -> str:
    op = "IS DISTINCT FROM" if spec.null_safe else "<>"
    return " OR ".join(f"{a}.{q(d)} {op} s.{q(sc)}" for d, sc in spec.tracked)


def _order(spec: DimSpec, first=(), last=()) -> str:
    """Timestamp, tiebreak, then all other staged values; carried columns where the caller says."""
    return ", ".join([f"s.{q(spec.ts)}"] + [f"s.{q(stg_name(spec, c))}" for c in spec.tiebreak] + list(first)
                     + [f"s.{q(stg_name(spec, c))}" for c in spec.order_cols] + list(last))


def _own_carry(spec: DimSpec) -> list[str]:
    return [f"s.{q(sc)}" for _, sc in spec.carry]


def _partition(spec: DimSpec) -> str:
    return ", ".join(f"s.{q(stg_name(spec, c))}" for c in spec.partition_cols)


def _parse(text: str) -> list[tuple[str, str]]:
    """Split ``name AS (body),`` CTE text into (name, body) pairs."""
    out, depth, start, name = [], 0, 0, None
    i = 0
    while i < len(text):
        ch = text[i]
        if ch == "(":
            if depth == 0:
                name = text[start:i].strip().lstrip(",").strip()
                assert name.endswith(" AS"), name
                name, body_start = name[:-3].strip(), i + 1
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                out.append((name, text[body_start:i].strip()))
                start = i + 1
        i += 1
    return out


def next_start_sql(spec: DimSpec, src: str, scope: str) -> str:
    """LEAD(date_from) over the scope's rows of ``src``."""
    match = on(spec, src) + (f" AND {src}.{q(DATE_FROM)} = s.{q(spec.ts)}" if scope == "batch" else "")
    return f"""SELECT {keys_of(spec, src)}, {src}.version,
         lead({src}.date_from) OVER (PARTITION BY {keys_of(spec, src)} ORDER BY {src}.version, {src}.date_from) AS next_date_from
  FROM {src} WHERE EXISTS (SELECT 1 FROM s WHERE {match})"""


def _redate(spec: DimSpec, src: str, scope: str) -> str:
    """LEAD over the scope's rows, then the UPDATE as a left join.  Rows that share a
    version match more than once (Q4): the earliest start is taken."""
    keys = ", ".join(q(c) for c in spec.key_cols)
    return f"""ne AS (
  SELECT {keys}, version, min(next_date_from) AS next_date_from FROM (
  {next_start_sql(spec, src, scope)}) x GROUP BY {keys}, version
),
fin AS (
  SELECT {_rewrite(spec, src, date_to=f"CASE WHEN ne.next_date_from IS NOT NULL THEN ne.next_date_from ELSE {src}.date_to END")}
  FROM {src} LEFT JOIN ne ON {on(spec, src, 'ne', False)} AND {src}.version = ne.version
)"""


def upsert_steps(spec: DimSpec, batch_ts: str | None) -> str:
    start = f"s.{q(spec.ts)}" if spec.start == "staging" else f"TIMESTAMP '{batch_ts}'"
    k1 = spec.key_cols[0]
    carry = {d: f"d1.{q(d)}" for d in spec.carry_cols}
    version = (f"CAST(d1.version + row_number() OVER (PARTITION BY {_partition(spec)} "
               f"ORDER BY {_order(spec, first=carry.values())}) AS INTEGER)")
    if spec.retire == "batch":
        mv_from = f"s JOIN d2 ON {on(spec, 'd2')} AND d2.date_from = s.{q(spec.ts)}"
    else:
        mv_from = f"d2 JOIN s ON {on(spec, 'd2')}"
    return f"""ins_new AS (
  SELECT {_new_select(spec, '1', 'true', start)}
  FROM s LEFT JOIN d0 ON {on(spec, 'd0')} WHERE d0.{q(k1)} IS NULL
),
d1 AS (SELECT * FROM d0 UNION ALL SELECT * FROM ins_new),
ins_chg AS (
  SELECT {_new_select(spec, version, 'true', start, carry)}
  FROM s LEFT JOIN d1 ON {on(spec, 'd1')} AND d1.lastversion = true
  WHERE {_change_test(spec, 'd1')}
),
d2 AS (SELECT * FROM d1 UNION ALL SELECT * FROM ins_chg),
mv AS (SELECT {keys_of(spec, 'd2')}, max(d2.version) AS max_version FROM {mv_from} GROUP BY {keys_of(spec, 'd2')}),
d3 AS (
  SELECT {_rewrite(spec, 'd2', lastversion="CASE WHEN d2.version < mv.max_version THEN false ELSE d2.lastversion END")}
  FROM d2 LEFT JOIN mv ON {on(spec, 'd2', 'mv', False)}
),
{_redate(spec, 'd3', spec.redate)}"""


def append_steps(spec: DimSpec, batch_ts: str | None) -> str:
    version = (f"CAST(COALESCE(mx.max_version, 0) + row_number() OVER (PARTITION BY {_partition(spec)} "
               f"ORDER BY {_order(spec, last=_own_carry(spec))}) AS INTEGER)")
    carry = {d: f"COALESCE(cc.{q(d)}, s.{q(sc)})" for d, sc in spec.carry}
    carry_cte = (f"cc AS (SELECT {keys_of(spec, 'd0')}, {', '.join(f'd0.{q(d)}' for d in spec.carry_cols)} "
                 f"FROM d0 WHERE d0.lastversion = true),") if spec.carry else ""
    carry_join = f" LEFT JOIN cc ON {on(spec, 'cc')}" if spec.carry else ""
    touched = "EXISTS (SELECT 1 FROM s WHERE {})"
    return f"""mx AS (SELECT {keys_of(spec, 'd0')}, max(d0.version) AS max_version FROM d0 GROUP BY {keys_of(spec, 'd0')}),
{carry_cte}
ins AS (
  SELECT {_new_select(spec, version, 'false', f's.{q(spec.ts)}', carry)}
  FROM s LEFT JOIN mx ON {on(spec, 'mx')}{carry_join}
),
d1 AS (SELECT * FROM d0 UNION ALL SELECT * FROM ins),
d2 AS (
  SELECT {_rewrite(spec, 'd1', lastversion=f"CASE WHEN d1.lastversion = true AND {touched.format(on(spec, 'd1'))} THEN false ELSE d1.lastversion END")}
  FROM d1
),
lat AS (
  SELECT {keys_of(spec, 'd2')}, max(d2.version) AS max_version FROM d2
  WHERE {touched.format(on(spec, 'd2'))} GROUP BY {keys_of(spec, 'd2')}
),
d3 AS (
  SELECT {_rewrite(spec, 'd2', lastversion="CASE WHEN d2.version = lat.max_version THEN true ELSE d2.lastversion END")}
  FROM d2 LEFT JOIN lat ON {on(spec, 'd2', 'lat', False)}
),
{_redate(spec, 'd3', 'touched')}"""


def due_sql(col: str, batch_ts: str, how: str) -> str:
    day = batch_ts[:10]
    if how == "date":
        return f"CAST({col} AS DATE) <= DATE '{day}'"
    return f"{col} <= CAST(DATE '{day}' AS TIMESTAMP)"


def close_steps(spec: DimSpec, batch_ts: str) -> str:
    k1 = spec.key_cols[0]
    start = f"TIMESTAMP '{batch_ts}'"
    close_at = f"max(s.{q(spec.ts)})" if spec.close_at == "staging" else start
    hit = f"up.version IS NOT NULL AND {due_sql('d2.date_from', batch_ts, spec.due)}"
    if spec.reclose == "current":
        hit += " AND d2.lastversion = true"
    if spec.close_numbering == "plus_one":
        version = "CAST(d1.version + 1 AS INTEGER)"
    else:
        version = (f"CAST(d1.version + row_number() OVER (PARTITION BY {_partition(spec)} "
                   f"ORDER BY {_order(spec)}) AS INTEGER)")
    return f"""ins_new AS (
  SELECT {_new_select(spec, '1', 'true', start)}
  FROM s LEFT JOIN d0 ON {on(spec, 'd0')} WHERE d0.{q(k1)} IS NULL
),
d1 AS (SELECT * FROM d0 UNION ALL SELECT * FROM ins_new),
ins_chg AS (
  SELECT {_new_select(spec, version, 'true', start)}
  FROM s LEFT JOIN d1 ON {on(spec, 'd1')}
  WHERE ({_change_test(spec, 'd1')}) AND d1.lastversion = true
),
d2 AS (SELECT * FROM d1 UNION ALL SELECT * FROM ins_chg),
rk AS (
  SELECT {keys_of(spec, 'd2')}, d2.version,
         row_number() OVER (PARTITION BY {keys_of(spec, 'd2')} ORDER BY d2.version DESC, d2.date_from DESC) AS rn
  FROM d2 WHERE EXISTS (SELECT 1 FROM s WHERE {on(spec, 'd2')})
),
up AS (
  SELECT {keys_of(spec, 'rk')}, rk.version, {close_at} AS close_at
  FROM rk JOIN s ON {on(spec, 'rk')} WHERE rk.rn = 2 GROUP BY {keys_of(spec, 'rk')}, rk.version
),
fin AS (
  SELECT {_rewrite(spec, 'd2', date_to=f"CASE WHEN {hit} THEN up.close_at ELSE d2.date_to END",
                   lastversion=f"CASE WHEN {hit} THEN false ELSE d2.lastversion END")}
  FROM d2 LEFT JOIN up ON {on(spec, 'd2', 'up', False)} AND d2.version = up.version
)"""


STEPS = {"upsert": upsert_steps, "append_all": append_steps, "close_previous": close_steps}


def steps(spec: DimSpec, batch_ts: str | None) -> list[tuple[str, str]]:
    """The statement CTEs of a load as (name, body) pairs; the last is ``fin``."""
    return _parse(STEPS[spec.mode](spec, batch_ts))


def with_sql(p: Pipeline, ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{n} AS (\n  {b}\n)" for n, b in ctes)
    return f"WITH {frames_sql(p)}" + (f",\n{body}" if ctes else "") + f"\n{final}"


def upto(ctes: list[tuple[str, str]], last: str) -> list[tuple[str, str]]:
    names = [n for n, _ in ctes]
    return ctes[: names.index(last) + 1]


def staging_where(spec: DimSpec) -> str:
    """The staging filter of ``null_keys='drop'`` and ``dedupe`` (empty otherwise)."""
    out = ""
    if spec.null_keys == "drop":
        out += " WHERE " + " AND ".join(f"{q(sc)} IS NOT NULL" for _, sc in spec.keys)
    if spec.dedupe:
        keys = ", ".join(q(sc) for _, sc in spec.keys)
        order = ", ".join([q(spec.ts)] + [q(stg_name(spec, c)) for c in spec.tiebreak + spec.order_cols]
                          + [q(sc) for _, sc in spec.carry])
        w = f"OVER (PARTITION BY {keys} ORDER BY {order})"
        same = " AND ".join(f"{q(sc)} IS NOT DISTINCT FROM lag({q(sc)}) {w}" for _, sc in spec.tracked)
        out += f" QUALIFY row_number() {w} = 1 OR NOT ({same})"
    return out


def frames_sql(p: Pipeline) -> str:
    """Fixture CTEs plus ``d0`` (the dimension) and ``s`` (the staging batch)."""
    fx_text, fdim, fstg = FIXTURE_SQL[p.fixture]
    dim_map, stg_map = p.bindings()
    attrs = [c for c in p.spec.dim_cols if c not in BOOKKEEPING]
    d0 = ", ".join(f"{dim_map[c]} AS {q(c)}" for c in attrs)
    s = ", ".join(f"{e} AS {q(c)}" for c, e in stg_map.items())
    return (f"{fx_text},\nd0 AS MATERIALIZED (SELECT {d0}, CAST(version AS INTEGER) AS version, lastversion, date_from, date_to "
            f"FROM {fdim}),\ns AS MATERIALIZED (SELECT * FROM (SELECT {s} FROM {fstg}) x{staging_where(p.spec)})")


def pipeline_sql(p: Pipeline) -> str:
    return with_sql(p, steps(p.spec, p.batch_ts), "SELECT * FROM fin")
