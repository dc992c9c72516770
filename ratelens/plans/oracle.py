"""Independent DuckDB SQL for every registered query.

Written against the raw driver views (lineitem, orders, customer, part,
nation, documents, labels); shares no expression with the Spark plans, only
the fixed stop-word list. Means are rounded half-up in exact integers, as all
``l_quantity`` are whole numbers.
"""

from __future__ import annotations

from ratelens.functions.text import STOPWORD_PATTERN
from ratelens.plans.oracle_lines import ORACLE_LINES


def _mean(total: str, n: str) -> str:
    """total / n to two decimals, half-up: floor((200 total + n) / 2n) / 100."""
    return f"(((200 * cast({total} as hugeint) + {n}) // nullif(2 * {n}, 0)) / 100.0)"


def _f2(x: str) -> str:
    return f"printf('%.2f', {x})"


def _raw(total: str, n: str) -> str:
    """The unrounded mean in single precision, as text."""
    return f"cast(cast({total} / {n} as float) as varchar)"


RATINGS = """r as (select case when l_orderkey % 10 <> 0 then l_orderkey end as user_key, l_partkey as movie_id,
                l_quantity as rating, l_shipdate from lineitem),
mv as (select case when p_partkey % 11 = 0 then -p_partkey else p_partkey end as movie_id, p_name as title,
              concat_ws('|', p_type, replace(p_name, ' ', '|')) as genres from part)"""

USERS = """cu as (select c_custkey as user_id,
                 case when c_mktsegment = 'BUILDING' then 'M' else 'F' end as gender,
                 cast(16 + floor((c_acctbal + 1000) / 200) as integer) as age,
                 c_nationkey + case when c_custkey % 7 = 0 then 100 else 0 end as occupation_id from customer),
u as (select o_orderkey as user_key, o_custkey as user_id, coalesce(cu.gender, '') as gender, cu.age, cu.occupation_id
      from orders left join cu on cu.user_id = o_custkey)"""

GENRES = """g as (select movie_id, genre from (
         select movie_id, unnest(string_split(genres, '|')) as genre from mv) where genre <> '')"""

MOVIE_SUMS = "s as (select movie_id, sum(rating) as sm, count(rating) as c from r group by movie_id)"


# Result sentences.
def _result(min_n: int, value: str) -> str:
    return f"""case when b.movie_id is not null
            then printf('%s is the highest rated movie with an average rating of %s among movies with at least %d ratings.',
                        b.title, {value}, {min_n})
            else 'No movies has at least {min_n} ratings.' end"""


def _best(min_n: int, rounded: bool) -> str:
    mean = _mean("s.sm", "s.c") if rounded else "s.sm / s.c"
    positive = "" if rounded else " and avg_rating > 0"
    value = _f2("b.avg_rating") if rounded else _raw("b.sm", "b.n")
    return f"""with {RATINGS}, {MOVIE_SUMS},
t as (select s.movie_id, mv.title, {mean} as avg_rating, s.c as n, s.sm
      from s join mv on mv.movie_id = s.movie_id),
b as (select * from t where n >= {min_n}{positive} order by avg_rating desc, movie_id limit 1)
select b.movie_id, b.title, b.avg_rating, b.n, {_result(min_n, value)} as result
from (select 1 as one) d left join b on true"""


# Review role: lines built from documents + labels, then parsed.
_LINE_RX = r"^([^;]+);(.+);([^;]+);([^;]+);([^;]+)$"
_TRIM_RX = r"^[\x00-\x20]+|[\x00-\x20]+$"


# Java's '.' does not match \r \n U+0085 U+2028 U+2029 (RE2's only skips \n),
# so a line whose review part holds one of them does not parse.
_LINE_OK = (f"(regexp_matches(line, '{_LINE_RX}') and not regexp_matches("
            f"regexp_extract(line, '{_LINE_RX}', 2), '[\\r\\n\\x{{85}}\\x{{2028}}\\x{{2029}}]'))")


def _ex(i: int) -> str:
    return f"case when {_LINE_OK} then regexp_extract(line, '{_LINE_RX}', {i}) end"


PARSED = f"""rv as (select d.doc_id as id, d.text as review, d.source as aspect, d.lang as category,
         case when l.quality = 1 then 'positive' when l.quality = 0 then 'negative' else 'neutral' end as sentiment
         from documents d left join labels l on l.doc_id = d.doc_id),
lines as (select 'id;review;aspect;category;sentiment' as line
          union all
          select concat_ws(';', cast(id as varchar), regexp_replace(review, '\\r\\n|\\r|\\n', ' ', 'g'),
                           aspect, category, sentiment) from rv),
pr as (select case when regexp_full_match({_ex(1)}, '[+-]?[0-9]+') then try_cast({_ex(1)} as bigint)
                   else try_cast(trunc(try_cast({_ex(1)} as double)) as bigint) end as id, {_ex(2)} as review, {_ex(3)} as aspect,
              {_ex(4)} as category, {_ex(5)} as sentiment
       from lines where not regexp_full_match(line, 'id;.*'))"""

# Stop-word removal without \\b (RE2's \\b is ASCII-only): split the text into
# maximal runs of word / non-word characters; drop word runs equal to a
# single-word stop word, and the three runs of a two-word stop phrase
# ("w1", " ", "w2"). A phrase whose first word appears earlier in the
# alternation as a single word can never match (the single word wins), so
# only the other phrases are matched.
_ALTS = STOPWORD_PATTERN[len(r"\b("):-len(r")\b")].split("|")
_STOP_SINGLE = [w for w in _ALTS if " " not in w]
_LIVE_PHRASES: dict[str, list[str]] = {}
for _i, _alt in enumerate(_ALTS):
    if " " in _alt and _alt.split(" ")[0] not in _ALTS[:_i]:
        _w1, _w2 = _alt.split(" ")
        _LIVE_PHRASES.setdefault(_w1, []).append(_w2)


def _sql_list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _phrase_at(first: str, second: str) -> str:
    return " or ".join(f"({first} = '{w1}' and {second} in {_sql_list(w2s)})" for w1, w2s in _LIVE_PHRASES.items())


_DROP_RUN = (f"x in {_sql_list(_STOP_SINGLE)}"
             f" or (l[i + 1] = ' ' and ({_phrase_at('x', 'l[i + 2]')}))"
             f" or (i > 1 and x = ' ' and ({_phrase_at('l[i - 1]', 'l[i + 1]')}))"
             f" or (i > 2 and l[i - 1] = ' ' and ({_phrase_at('l[i - 2]', 'x')}))")
_WORD = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"
_NO_STOP = ("array_to_string(list_filter(l, lambda x, i: not coalesce(" + _DROP_RUN + ", false)), '')")
_CLEAN = (f"regexp_replace(regexp_replace(regexp_replace({_NO_STOP}, '[[:punct:]]', ' ', 'g'), "
          f"'[\\t\\n\\x0B\\f\\r ]{{2,}}', ' ', 'g'), '{_TRIM_RX}', '', 'g')")
# The review columns themselves, without a line file in between.
COLUMNS = """pr as (select d.doc_id as id, regexp_replace(d.text, '\\r\\n|\\r|\\n', ' ', 'g') as review, d.source as aspect,
         d.lang as category,
         case when l.quality = 1 then 'positive' when l.quality = 0 then 'negative' else 'neutral' end as sentiment
         from documents d left join labels l on l.doc_id = d.doc_id)"""
_CLEANING = f""",
runs as (select id, regexp_extract_all(lower(review), '[{_WORD}]+|[^{_WORD}]+') as l, review is null as no_review,
                aspect, category, sentiment from pr),
c as (select id, case when no_review then null else {_CLEAN} end as review, aspect, category, sentiment from runs)"""
CLEANED_LINES, CLEANED = PARSED + _CLEANING, COLUMNS + _CLEANING

_TOKENS = "list_filter(regexp_split_to_array({x}, '[ \",()*]'), lambda t: t <> '')"


def _jtrim(x: str) -> str:
    return f"regexp_replace({x}, '{_TRIM_RX}', '', 'g')"


def _top_aspect(sentiment: str) -> str:
    return f"""with {COLUMNS},
x as (select {_jtrim('aspect')} as aspect, lower({_jtrim('sentiment')}) as sentiment from pr)
select aspect, count(aspect) as total_{sentiment} from x
where aspect is not null and sentiment is not null and sentiment = '{sentiment}'
group by aspect order by total_{sentiment} desc, aspect limit 1"""


def _top_words_sentiment(sentiment: str) -> str:
    return f"""with {CLEANED},
d as (select review, category, lower({_jtrim('sentiment')}) as sentiment from c where id is not null),
w as (select category, unnest({_TOKENS.format(x='review')}) as word from d where sentiment = '{sentiment}'),
k as (select category, word, count(category) as freq from w
      where word is not null and length(word) >= 3 group by category, word)
select category, word, freq from k
qualify row_number() over (partition by category order by freq desc, word) <= 5"""


def _count_by(key: str) -> str:
    return f"""with {COLUMNS}
select {key}, count(id) as total_comments from pr group by {key}"""


AGE4 = """case when u.age <= 18 then '0-18' when u.age <= 35 then '18-35' when u.age <= 50 then '35-50'
            when u.age is not null then '50+' end"""
AGE5 = """case when u.age < 18 then 'Under18' when u.age <= 25 then '18-25' when u.age <= 35 then '26-35'
            when u.age <= 50 then '36-50' when u.age is not null then '50+' end"""


def _cond_mean(pred: str) -> str:
    return _mean(f"sum(case when {pred} then rating end)", f"count(case when {pred} then rating end)")


def _age_wide_4() -> str:
    groups = [("0-18", "age_0_18"), ("18-35", "age_18_35"), ("35-50", "age_35_50"), ("50+", "age_50_plus")]
    means = ",\n       ".join(f"{_cond_mean(f'age_group = {chr(39)}{g}{chr(39)}')} as {c}" for g, c in groups)
    cols = ", ".join(f"coalesce({_f2(c)}, 'NA') as {c}" for _, c in groups)
    return f"""with {RATINGS}, {USERS},
j as (select r.movie_id, r.rating, {AGE4} as age_group from r join u on u.user_key = r.user_key),
w as (select movie_id,
       {means}
      from j where age_group is not null group by movie_id)
select w.movie_id, coalesce(mv.title, cast(w.movie_id as varchar)) as title, {cols}
from w left join mv on mv.movie_id = w.movie_id"""


def _s(x: str) -> str:
    return f"coalesce(cast({x} as varchar), '')"


def _age_sentence() -> str:
    groups = [("0-18", "age_0_18"), ("18-35", "age_18_35"), ("35-50", "age_35_50"), ("50+", "age_50_plus")]
    cells = " || ".join(f"'{g}: ' || {c} || chr(9)" for g, c in groups)
    return f"""with w as ({_age_wide_4()})
select title, {cells} as value from w"""


def _fixed(sql: str, cols: list[tuple[str, int, str]]) -> str:
    """printf rendering of a report: kind 's' text (NULL empty), 'u' text
    (NULL 'Unknown'), 'f2' two decimals."""
    def cell(c, kind):
        if kind == "f2":
            return f"coalesce({_f2(c)}, '')"
        return f"coalesce(cast({c} as varchar), '{'Unknown' if kind == 'u' else ''}')"
    fmt = " | ".join(f"%-{w}s" for _, w, _ in cols)
    return f"select printf('{fmt}', {', '.join(cell(c, k) for c, _, k in cols)}) as value from ({sql})"


ORACLE: dict[str, str] = {
    "movie_mean_count": f"""with {RATINGS}, {MOVIE_SUMS}
select s.movie_id, mv.title as title, {_mean('s.sm', 's.c')} as avg_rating, s.c as n
from s join mv on mv.movie_id = s.movie_id""",

    "movie_mean_by_title": f"""with {RATINGS}, {MOVIE_SUMS}
select s.movie_id, coalesce(mv.title, cast(s.movie_id as varchar)) as title, s.sm / s.c as avg_rating, s.c as n
from s left join mv on mv.movie_id = s.movie_id""",

    "best_movie_min5": _best(5, rounded=False),
    "best_movie_min5_rounded": _best(5, rounded=True),
    "best_movie_min50_rounded": _best(50, rounded=True),

    "genre_mean_count": f"""with {RATINGS}, {GENRES}
select g.genre, {_mean('sum(r.rating)', 'count(r.rating)')} as avg_rating, count(r.rating) as n
from r join g on g.movie_id = r.movie_id group by g.genre""",

    "genre_mean_desc": f"""with {RATINGS}, {GENRES}
select g.genre, {_mean('sum(r.rating)', 'count(r.rating)')} as avg_rating
from r join g on g.movie_id = r.movie_id group by g.genre""",

    "gender_wide": f"""with {RATINGS}, {USERS},
j as (select r.movie_id, r.rating, u.gender from r left join u on u.user_key = r.user_key),
w as (select movie_id,
             coalesce({_cond_mean("gender = 'M'")}, 0.0) as male_avg,
             coalesce({_cond_mean("gender is distinct from 'M'")}, 0.0) as female_avg
      from j group by movie_id)
select w.movie_id, coalesce(mv.title, cast(w.movie_id as varchar)) as title, w.male_avg, w.female_avg
from w left join mv on mv.movie_id = w.movie_id""",

    "gender_long_unknown": f"""with {RATINGS}, {USERS},
j as (select r.movie_id, r.rating, case when u.user_key is null then 'Unknown' else u.gender end as gender
      from r left join u on u.user_key = r.user_key),
s as (select movie_id, gender, sum(rating) as sm, count(rating) as c from j group by movie_id, gender)
select s.movie_id, coalesce(mv.title, 'Unknown') as title, s.gender, {_mean('s.sm', 's.c')} as avg_rating, s.c as n
from s left join mv on mv.movie_id = s.movie_id""",

    "age_wide_4": _age_wide_4(),

    "age_long_5": f"""with {RATINGS}, {USERS},
j as (select r.movie_id, r.rating, {AGE5} as age_group from r join u on u.user_key = r.user_key),
s as (select movie_id, age_group, sum(rating) as sm, count(rating) as c
      from j where age_group is not null group by movie_id, age_group)
select s.movie_id, mv.title as title, s.age_group, {_mean('s.sm', 's.c')} as avg_rating, s.c as n
from s join mv on mv.movie_id = s.movie_id""",

    "occupation_mean": f"""with {RATINGS}, {USERS},
uo as (select u.user_key, u.occupation_id, coalesce(n.n_name, 'Unknown') as occupation
       from u left join nation n on n.n_nationkey = u.occupation_id),
j as (select uo.occupation_id, coalesce(uo.occupation, 'Unknown') as occupation, r.rating
      from r left join uo on uo.user_key = r.user_key)
select occupation_id, occupation, {_mean('sum(rating)', 'count(rating)')} as avg_rating, count(rating) as n
from j group by occupation_id, occupation""",

    "year_mean": f"""select cast(year(l_shipdate) as integer) as year,
       {_mean('sum(l_quantity)', 'count(l_quantity)')} as avg_rating, count(l_quantity) as n
from lineitem group by 1""",

    "ratings_union_all": """select l_orderkey as user_key, l_partkey as movie_id, l_quantity as rating,
       cast(epoch(l_shipdate) as bigint) as ts from lineitem where l_linestatus = 'O'
union all
select l_orderkey as user_key, l_partkey as movie_id, l_quantity as rating,
       cast(epoch(l_shipdate) as bigint) as ts from lineitem where l_linestatus is distinct from 'O'""",

    "movie_mean_count_text": f"""with {RATINGS}, {MOVIE_SUMS}
select printf('%-7s | %-60s | %-10s | %-12s', {_s('s.movie_id')}, {_s('mv.title')},
              {_f2(_mean('s.sm', 's.c'))}, {_s('s.c')}) as value
from s join mv on mv.movie_id = s.movie_id""",

    "movie_sentence": f"""with {RATINGS}, {MOVIE_SUMS}
select coalesce(mv.title, cast(s.movie_id as varchar)) as title,
       printf('Average rating: %s (Total ratings: %d)', {_raw('s.sm', 's.c')}, s.c) as value
from s left join mv on mv.movie_id = s.movie_id""",

    "movie_report_with_result": f"""with {RATINGS}, {MOVIE_SUMS}
select coalesce(mv.title, cast(s.movie_id as varchar)) as title,
       printf('Average rating: %s (Total ratings: %d)', {_raw('s.sm', 's.c')}, s.c) as value
from s left join mv on mv.movie_id = s.movie_id
union all
select 'RESULT' as title, result as value from ({_best(5, rounded=False)})""",

    "genre_mean_sentence": f"""with {RATINGS}, {GENRES}
select g.genre, printf('Avg: %s,    Count: %d', {_f2(_mean('sum(r.rating)', 'count(r.rating)'))}, count(r.rating)) as value
from r join g on g.movie_id = r.movie_id group by g.genre""",

    "gender_wide_sentence": f"""with {RATINGS}, {USERS},
j as (select r.movie_id, r.rating, u.gender from r left join u on u.user_key = r.user_key),
w as (select movie_id,
             coalesce({_cond_mean("gender = 'M'")}, 0.0) as male_avg,
             coalesce({_cond_mean("gender is distinct from 'M'")}, 0.0) as female_avg
      from j group by movie_id)
select coalesce(mv.title, cast(w.movie_id as varchar)) as title,
       printf('Male: %s, Female: %s', {_f2('w.male_avg')}, {_f2('w.female_avg')}) as value
from w left join mv on mv.movie_id = w.movie_id""",

    "age_wide_sentence": _age_sentence(),

    "reviews_parse": f"""with {PARSED}
select id, review, aspect, category, sentiment from pr""",

    "reviews_clean": f"""with {CLEANED_LINES}
select id, review, aspect, category, sentiment from c""",

    "top_words_k": f"""with {CLEANED},
w as (select unnest({_TOKENS.format(x='lower(review)')}) as word from c)
select word, count(word) as freq from w where word is not null and word <> ''
group by word order by freq desc, word limit 5""",

    "category_count": _count_by("category"),
    "aspect_count": _count_by("aspect"),
    "top_aspect_positive": _top_aspect("positive"),
    "top_aspect_negative": _top_aspect("negative"),
    "top_words_category_positive": _top_words_sentiment("positive"),
    "top_words_category_negative": _top_words_sentiment("negative"),

    "top_words_category": f"""with {CLEANED},
w0 as (select aspect, category, unnest({_TOKENS.format(x='lower(review)')}) as tok from c),
w as (select aspect, category, regexp_replace(tok, '[^a-zA-Zà-ỹ0-9]', '', 'g') as word from w0),
k as (select category, word, count(aspect) as cnt from w where word is not null and word <> ''
      group by category, word)
select category, word, cnt from k
qualify row_number() over (partition by category order by cnt desc, word) <= 5""",
}

def _top_words_both() -> str:
    return f"""with {CLEANED},
d as (select review, category, lower({_jtrim('sentiment')}) as sentiment from c where id is not null),
w as (select sentiment, category, unnest({_TOKENS.format(x='review')}) as word from d
      where sentiment in ('positive', 'negative')),
k as (select sentiment, category, word, count(category) as freq from w
      where word is not null and length(word) >= 3 group by sentiment, category, word)
select sentiment, category, word, freq from k
qualify row_number() over (partition by sentiment, category order by freq desc, word) <= 5"""


ORACLE.update({
    "top_words_category_by_sentiment": _top_words_both(),
    "genre_mean_desc_text": _fixed(ORACLE["genre_mean_desc"], [("genre", 15, "s"), ("avg_rating", 10, "f2")]),
    "gender_long_text": _fixed(ORACLE["gender_long_unknown"], [("movie_id", 7, "s"), ("title", 60, "s"),
                                                               ("gender", 6, "s"), ("avg_rating", 10, "s"),
                                                               ("n", 10, "s")]),
    "age_long_text": _fixed(ORACLE["age_long_5"], [("movie_id", 7, "s"), ("title", 60, "s"), ("age_group", 10, "s"),
                                                   ("avg_rating", 10, "f2"), ("n", 12, "s")]),
    "occupation_mean_text": _fixed(ORACLE["occupation_mean"], [("occupation_id", 5, "u"), ("occupation", 20, "s"),
                                                               ("avg_rating", 10, "f2"), ("n", 12, "s")]),
    "year_mean_text": _fixed(ORACLE["year_mean"], [("year", 8, "s"), ("avg_rating", 10, "f2"), ("n", 12, "s")]),
})
ORACLE.update(ORACLE_LINES)
