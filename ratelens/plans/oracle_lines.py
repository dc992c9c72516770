"""Independent DuckDB SQL for the queries over comma files and tab-separated files.

Each builds the lines from the driver views as ``sources.tables`` documents
them, and parses them with its own expressions.
"""

from __future__ import annotations

_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '{_BLANKS}', '', 'g')"


def _part(i: int, sep: str = "l") -> str:
    return _trim(f"{sep}[{i}]")


def _whole(x: str, kind: str = "bigint") -> str:
    return f"case when regexp_full_match({x}, '[+-]?[0-9]+') then try_cast({x} as {kind}) end"


_FULL = "trim(value, ' ' || chr(9)) <> ''"

_TS = "cast(epoch(l_shipdate) as bigint)"
_RATINGS = f"""with f as (select l_orderkey as o, l_partkey as p, cast(l_quantity as varchar) as q, {_TS} as t,
                  (l_orderkey * 7 + l_linenumber) % 20 as k from lineitem),
lines as (select case k when 0 then case when o % 2 = 0 then '' else ' ' || chr(9) end
                        when 1 then 'UserID,MovieID,Rating,Timestamp'
                        when 2 then concat_ws(',', o, p)
                        when 3 then concat_ws(',', o, p, 'x', t)
                        when 4 then concat_ws(',', o || '.5', p, q, t)
                        when 5 then concat_ws(',', o, ' ', q, t)
                        when 6 then concat_ws(',', o, p, q, t, 'more')
                        when 7 then ' ' || concat_ws(' ,' || chr(9), o, p, q, t) || ' '
                        when 8 then concat_ws(',', o, p, q)
                        else concat_ws(',', o, p, q, t) end as value from f),
cut as (select string_split(value, ',') as l from lines where {_FULL} and not starts_with(value, 'UserID')),
r as (select {_whole(_part(1))} as user_id, {_whole(_part(2))} as movie_id, try_cast({_part(3)} as double) as rating,
             {_whole(_part(4))} as ts from cut)
select user_id, movie_id, rating, ts, user_id as user_key from r"""

_MOVIES = f"""with f as (select p_partkey as i, p_name as n, p_type || '|' || replace(p_name, ' ', '|') as g, p_partkey % 13 as k from part),
lines as (select case k when 0 then '  ' when 1 then concat_ws(',', i, n) when 2 then 'x' || concat_ws(',', i, n, g)
                        when 3 then concat_ws(',', i, n, ' The', g) when 4 then ' ' || concat_ws(' , ', i, n, g)
                        when 5 then cast(i as varchar) when 6 then concat_ws(',', i || '.0', n, g)
                        else concat_ws(',', i, n, g) end as value from f),
cut as (select string_split(value, ',') as l from lines where {_FULL}),
m as (select case when len(l) > 1 then {_whole(_part(1))} end as movie_id,
             case when len(l) = 2 then {_part(2)} when len(l) > 2 then {_trim("array_to_string(l[2:len(l) - 1], ',')")} end as title,
             case when len(l) > 2 then {_trim("l[len(l)]")} end as genres from cut)
select movie_id, title, genres from m"""

_USER_LINES = """with f as (select c_custkey as i, case when c_mktsegment = 'BUILDING' then 'M' else 'F' end as g,
                  cast(16 + floor((c_acctbal + 1000) / 200) as integer) as a, c_nationkey as o from customer),
lines as (select case i % 11 when 0 then concat_ws(',', i, '', a, o) when 1 then concat_ws(',', i, g, ' ', o)
                             when 2 then concat_ws(',', i, g, a) when 3 then concat_ws(',', 'x', g, a, o) when 4 then ''
                             when 5 then concat_ws(',', i, g, 'old', o) when 6 then concat_ws(' , ', i, g, a, o)
                             else concat_ws(',', i, g, a, o) end as value, 1 as nth, i from f
          union all select concat_ws(',', i, 'X', a + 1, o), 2, i from f where i % 3 = 0
          union all select concat_ws(',', i, '', '', '99'), 3, i from f where i % 6 = 0),"""
_USERS = f"""{_USER_LINES}
cut as (select string_split(value, ',') as l, nth, i from lines where {_FULL}),
u as (select {_whole(_part(1))} as user_id, nullif({_part(2)}, '') as gender, {_whole(_part(3), 'integer')} as age,
             {_whole(_part(4))} as occupation_id, nth from cut)"""
_USER_COLUMNS = "select user_id, gender, age, occupation_id, user_id as user_key from u"

_OCCUPATIONS = f"""with f as (select n_nationkey as i, n_name as n, n_nationkey % 5 as k from nation),
lines as (select case k when 0 then concat_ws(',', i, n, ' and others') when 1 then cast(i as varchar)
                        when 2 then ' ' || concat_ws(' ,', i, n) when 3 then ' ' else concat_ws(',', i, n) end as value from f),
cut as (select string_split(value, ',') as l from lines where {_FULL}),
o as (select {_whole(_part(1))} as occupation_id,
             case when len(l) > 1 then {_trim("array_to_string(l[2:], ',')")} end as occupation from cut)
select occupation_id, occupation from o"""

ORACLE_LINES: dict[str, str] = {
    "rating_lines_drop": _RATINGS + " where movie_id is not null and rating is not null",
    "rating_lines_null": _RATINGS,
    "movie_lines_drop": _MOVIES + " where movie_id is not null and title is not null",
    "movie_lines_null": _MOVIES,
    "user_lines_drop": f"{_USERS} {_USER_COLUMNS} where user_id is not null",
    "user_lines_null": f"{_USERS} {_USER_COLUMNS}",
    "user_lines_last": f"{_USERS} {_USER_COLUMNS} where user_id is not null "
                       "qualify row_number() over (partition by user_id order by nth desc) = 1",
    "occupation_lines_drop": _OCCUPATIONS + " where occupation_id is not null and occupation is not null",
    "ratings_two_files": f"""select l_orderkey as user_id, l_partkey as movie_id, l_quantity as rating, {_TS} as ts,
       l_orderkey as user_key from lineitem""",
    "reviews_tsv_roundtrip": """select cast(doc_id as varchar) as id, text as review, case when doc_id % 9 <> 0 then source end as aspect,
       case when doc_id % 7 = 0 then '' else lang end as category, 'a' || chr(92) || 'tb' || chr(9) || doc_id as sentiment from documents""",
}
