"""Registry of DuckDB CTEs and assembly of self-contained oracle queries.

An oracle query is ``WITH <needed CTEs in dependency order> <final SELECT>``;
dependencies are found by name, so each query carries only what it uses.
"""

from __future__ import annotations

import re

from ..plans.cleaning import gen1_specs, gen2_specs
from ..sources import schemas
from .fixtures_sql import RAW

CTES: dict[str, str] = {}
CTES.update(RAW)


def register(name: str, sql: str) -> None:
    CTES[name] = sql


def _names_in(sql: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{re.escape(n)}\b", sql)]


def assemble(final_sql: str) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack=()):
        if name in seen:
            return
        for dep in _names_in(CTES[name]):
            if dep != name and dep not in stack:
                visit(dep, stack + (name,))
        seen.add(name)
        order.append(name)

    for n in _names_in(final_sql):
        visit(n)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS (\n{CTES[n].strip()}\n)" for n in order)
    return f"WITH {body}\n{final_sql.strip()}"


# ---- cleaning ------------------------------------------------------------------

def _cols(table: str) -> list[str]:
    return [f.name for f in schemas.RAW_SCHEMAS[table].fields]


def _reason_case(spec) -> str:
    parts = []
    if spec.key and spec.null_reason:
        parts.append(f"WHEN {spec.key[0]} IS NULL THEN '{spec.null_reason}'")
    parts += [f"WHEN {p} THEN '{r}'" for r, p in spec.rules]
    return "CASE " + " ".join(parts) + " END" if parts else "CAST(NULL AS VARCHAR)"


def _valid_pred(spec) -> str:
    conds = []
    if spec.key and spec.null_reason:
        conds.append(f"{spec.key[0]} IS NOT NULL")
    if spec.valid:
        conds.append(f"({spec.valid})")
    return " AND ".join(conds) if conds else "TRUE"


def _normalised(spec, cols) -> list[str]:
    fn = {"lower": "lower(trim({c}))", "upper": "upper(trim({c}))", "trim": "trim({c})"}
    return [fn[spec.normalise[c]].format(c=c) + f" AS {c}" if c in spec.normalise else c for c in cols]


def _gen2(table: str, spec) -> tuple[str, str]:
    cols = _cols(table)
    cl = ", ".join(cols)
    raw = f"raw_{table}"
    flags = [f"{e} AS {n}" for n, e in spec.flags]
    if spec.duplicate_flag and spec.dup_key:
        flags.append(
            f"CASE WHEN count(*) OVER (PARTITION BY {', '.join(spec.dup_key)}) > 1 THEN 1 ELSE 0 END AS duplicate_flag"
        )
    cleaned = (
        f"SELECT {', '.join(_normalised(spec, cols) + flags)}\n"
        f"FROM (SELECT {cl} FROM {raw} WHERE {_valid_pred(spec)} GROUP BY {cl}) d"
    )
    rejects = (
        f"SELECT {cl}, reason AS reject_reason, CAST(1 AS BIGINT) AS rejected_row_count\n"
        f"FROM (SELECT *, {_reason_case(spec)} AS reason FROM {raw}) r WHERE reason IS NOT NULL\n"
        f"UNION ALL\n"
        f"SELECT {cl}, 'EXACT_DUPLICATE_ROW (' || (count(*) - 1) || ' extra copies removed)',\n"
        f"  CAST(count(*) - 1 AS BIGINT)\n"
        f"FROM {raw} WHERE {_valid_pred(spec)} GROUP BY {cl} HAVING count(*) > 1"
    )
    return cleaned, rejects


def _order_by_all(cols) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def _gen1(table: str, spec) -> tuple[str, str]:
    cols = _cols(table)
    cl = ", ".join(cols)
    raw = f"raw_{table}"
    flags = [f"{e} AS {n}" for n, e in spec.flags]
    if spec.dedup_all_rows:
        cleaned = (
            f"SELECT {', '.join(cols + flags)} FROM (\n"
            f"  SELECT DISTINCT {', '.join(_normalised(spec, cols))} FROM {raw} WHERE {_valid_pred(spec)}) d"
        )
        rejects = (
            f"SELECT {cl}, 'EXACT_DUPLICATE_ROW' AS reject_reason, CAST(1 AS BIGINT) AS rejected_row_count\n"
            f"FROM (SELECT *, row_number() OVER (PARTITION BY {cl}) AS rn FROM {raw}) t WHERE rn > 1\n"
            f"UNION ALL\n"
            f"SELECT {cl}, reason, 1 FROM (SELECT DISTINCT {cl}, {_reason_case(spec)} AS reason FROM {raw}) t\n"
            f"WHERE reason IS NOT NULL"
        )
        return cleaned, rejects
    distinct = f"SELECT DISTINCT {cl} FROM {raw} WHERE {_valid_pred(spec)}"
    rejects = (
        f"SELECT {cl}, reason AS reject_reason, CAST(1 AS BIGINT) AS rejected_row_count\n"
        f"FROM (SELECT *, {_reason_case(spec)} AS reason FROM {raw}) r WHERE reason IS NOT NULL\n"
        f"UNION ALL\n"
        f"SELECT {cl}, 'EXACT_DUPLICATE_ROW', 1 FROM (\n"
        f"  SELECT *, row_number() OVER (PARTITION BY {cl}) AS rn FROM {raw} WHERE {_valid_pred(spec)}) t\n"
        f"WHERE rn > 1"
    )
    if spec.dup_key:
        ranked = (
            f"SELECT *, row_number() OVER (PARTITION BY {', '.join(spec.dup_key)} "
            f"ORDER BY {_order_by_all(cols)}) AS key_rn FROM ({distinct}) d"
        )
        rejects += (
            f"\nUNION ALL\nSELECT {cl}, '{spec.dup_reason}', 1 FROM ({ranked}) k WHERE key_rn > 1"
        )
        source = f"({ranked}) k WHERE key_rn = 1"
    else:
        source = f"({distinct}) d"
    cleaned = f"SELECT {', '.join(_normalised(spec, cols) + flags)} FROM {source}"
    return cleaned, rejects


for _t, _s in gen2_specs().items():
    _c, _r = _gen2(_t, _s)
    register(f"cleaned_{_t}", _c)
    register(f"rejects_{_t}", _r)

for _t, _s in gen1_specs().items():
    _c, _r = _gen1(_t, _s)
    register(f"g1_cleaned_{_t}", _c)
    register(f"g1_rejects_{_t}", _r)
