"""The affine gap as DuckDB SQL: one row of the table of a pair is a list, and each step of a recursion makes the next row."""

from __future__ import annotations

from reclink.functions.distance import ABBREVIATION, GAP, MATCH, MISMATCH, SPACE

FAR = 1e12


def gap_distances(pairs: str) -> str:
    """(a, b, distance) of the pairs (a, b) in a table; null where a text is missing or empty.

    The cost of a gap along the row is the least, over its start, of what stands there and the gap from there on. Gaps beyond
    the length of the shorter text cost a share, so paid(j) = cost of a gap from the start to j.
    """

    def paid(j: str) -> str:
        return f"{SPACE} * (least({j}, m) + {ABBREVIATION} * greatest({j} - m, 0))"

    opened = f"{GAP} * (case when k < m then 1 else {ABBREVIATION} end)"
    same = f"case when substr(x, k, 1) = substr(y, i + 1, 1) then {MATCH} else {MISMATCH} end"
    return f"""
with recursive texts as (
  select distinct a, b, case when length(a) >= length(b) then a else b end as x,
    case when length(a) >= length(b) then b else a end as y,
    greatest(length(a), length(b)) as n, least(length(a), length(b)) as m
  from {pairs} where a != '' and b != ''
), folded as (
  select a, b, x, y, n, m, 0::bigint as i,
    list_transform(range(0, n + 1), lambda k: case when k = 0 then 0.0 else {GAP} + {SPACE} * k end::double) as best,
    list_transform(range(0, n + 1), lambda k: {FAR}::double) as down
  from texts
  union all
  select a, b, x, y, n, m, i + 1,
    list_transform(range(0, n + 1), lambda k: case when k = 0 then other[1]
      else least(other[k + 1], {paid('k')} + list_min(starts[1:k])) end::double),
    down
  from (
    select *, list_transform(range(0, n), lambda k: other[k + 1] + {opened} - {paid('k')}) as starts
    from (
      select a, b, x, y, n, m, i, down, list_transform(range(0, n + 1), lambda k: case when k = 0 then {GAP} + {SPACE} * (i + 1)
        else least(down[k + 1], best[k] + {same}) end::double) as other
      from (
        select a, b, x, y, n, m, i, best,
          list_transform(range(0, n + 1), lambda k: (least(down[k + 1], best[k + 1] + {GAP}) + {SPACE})::double) as down
        from folded where i < m
      ) d
    ) o
  ) s
)
select p.a, p.b, case when p.a = p.b then {MATCH} * n else best[n + 1] end / (n + m) as distance
from (select distinct a, b from {pairs}) p left join folded f on f.a = p.a and f.b = p.b and f.i = f.m
where f.a is not null or p.a is null or p.b is null or p.a = '' or p.b = ''
"""
