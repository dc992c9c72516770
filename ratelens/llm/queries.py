"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelens.llm import (bucket_refine, exact_dedup, hash_index, language_id, merkle, ngram_join, packing, quality, quote_linking, rank_bpe, secrets,
                          spelling, token_files)
from ratelens.llm.common import crc_fold, read, scratch_path


def op1_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = language_id.fit(docs, crc_fold(F.col("doc_id"), 4) != 2)
    out = language_id.predict(docs, model)
    return out.withColumn("held_out", F.coalesce(crc_fold(F.col("doc_id"), 4) == 2, F.lit(False)))


def op2_hash_index(spark, sf_dir):
    return hash_index.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"), 5) != 0)
    out = quality.score(docs, model)
    return out.withColumn("held_out", F.coalesce(crc_fold(F.col("doc_id"), 5) == 0, F.lit(False)))


def op4_rank_bpe(spark, sf_dir):
    return rank_bpe.digest_columns(rank_bpe.encode_documents(read(spark, sf_dir, "documents")))


def op5_packing(spark, sf_dir):
    return packing.digest_columns(packing.pack(read(spark, sf_dir, "documents")))


def op6_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(read(spark, sf_dir, "documents"), path)
    return token_files.digest_columns(token_files.read_token_files(spark, path))


def op7_ngram_join(spark, sf_dir):
    return ngram_join.link_components(read(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup(read(spark, sf_dir, "documents"))


def quoting_conversations(spark, sf_dir):
    """``conversations`` whole, with quotes: three messages in four quote an earlier
    one of their conversation (its first line, or all of it), as mails do."""
    messages = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kind = (F.col("conv_id") + F.col("turn")) % 4
    quoted = F.when(kind == 0, F.col("turn") - 1).when(kind == 1, F.col("turn") - 2).when(kind == 2, F.expr("turn div 2"))
    quoted = F.when(quoted < F.col("turn"), quoted)
    source = (messages.groupBy("conv_id", F.col("turn").alias("of")).agg(F.min("text").alias("said")))
    lines = F.split("said", "\n", -1)
    lines = F.when(kind == 2, lines).otherwise(F.slice(lines, 1, 1))
    marked = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("> "), x)), "\n")
    joined = messages.withColumn("of", quoted).join(source, ["conv_id", "of"], "left")
    return joined.select("conv_id", "turn", "role", F.coalesce(F.concat(marked, F.lit("\n"), F.coalesce("text", F.lit(""))), "text").alias("text"))


def op9_quotation_linking(spark, sf_dir):
    return quote_linking.format_chats(quoting_conversations(spark, sf_dir))


def op10_secret_scan(spark, sf_dir):
    return secrets.digest_columns(secrets.scan(read(spark, sf_dir, "documents"), secrets.shared_ledger(spark)))


def op11_bucket_refinement(spark, sf_dir):
    return bucket_refine.remove_repeats(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest(read(spark, sf_dir, "documents"))


def op13_spelling_variants(spark, sf_dir):
    return spelling.group_variants(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_hash_index, op3_quality, op4_rank_bpe, op5_packing, op6_token_files, op7_ngram_join, op8_exact_dedup, op9_quotation_linking, op10_secret_scan, op11_bucket_refinement, op12_merkle_manifest, op13_spelling_variants)}

NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

OP7 = r"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as l from documents),
s as (select distinct doc_id, case when len(l) < 3 then array_to_string(l, ' ') else l[i] || ' ' || l[i + 1] || ' ' || l[i + 2] end as shingle
      from (select doc_id, l, unnest(range(1, greatest(len(l) - 1, 2))) as i from w where len(l) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
k as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
e as (select a, b from k union select b, a from k),
reach as (select a as doc_id, b as other from e union select r.doc_id, e.b from reach r join e on e.a = r.other)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(w.doc_id, coalesce(m.least, w.doc_id)) as component_id
from w left join n using (doc_id) left join (select doc_id, min(other) as least from reach group by doc_id) m using (doc_id)"""

OP8 = f"""
with t as (select doc_id, {NORMAL} as content from documents),
k as (select content, min(doc_id) as keep_id, count(*) as group_size from t group by content)
select t.doc_id, k.keep_id, k.group_size, t.doc_id is not distinct from k.keep_id as kept,
       sha256(t.content) as text_sha256
from t join k using (content)"""

_LETTERS = "translate(regexp_replace(line, '^(?:>\\x20?)*', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP9_OVER = f"""
m as (select row_number() over () as id, conv_id, turn, role, coalesce(text, '') as text from messages),
raw as (select id, conv_id, turn, unnest(string_split(text, chr(10))) as line,
               generate_subscripts(string_split(text, chr(10)), 1) as i from m
        where conv_id is not null and turn is not null),
lines as (select id, conv_id, turn, i,
                 length(replace(regexp_extract(line, '^(?:>\\x20?)*'), ' ', '')) as level,
                 trim(regexp_replace({_LETTERS}, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') as content from raw),
runs as (select *, i - row_number() over (partition by id, level order by i) as run from lines where content <> ''),
units as (select distinct conv_id, turn, level, content from lines where content <> ''
          union
          select conv_id, turn, level, string_agg(content, ' ' order by i) as content from runs
          group by id, conv_id, turn, level, run),
quoted as (select * from units where level > 0),
firsts as (select conv_id, content, min(turn) as parent_turn from units where level = 0 group by all),
votes as (select q.conv_id, q.turn, q.level, f.parent_turn, count(*) as n from quoted q
          join firsts f using (conv_id, content) where f.parent_turn < q.turn group by all),
links as (select conv_id, turn, parent_turn, n from votes
          qualify row_number() over (partition by conv_id, turn order by level, n desc, parent_turn desc) = 1),
walk as (select conv_id, turn, parent_turn as up, 1 as depth from links
         union all
         select w.conv_id, w.turn, l.parent_turn, w.depth + 1 from walk w
         join links l on l.conv_id = w.conv_id and l.turn = w.up),
placed as (select conv_id, turn, min(up) as thread_root, max(depth) as depth from walk group by all),
down as (select distinct conv_id, up as turn, [up] as path from walk where not exists
              (select 1 from links l where l.conv_id = walk.conv_id and l.turn = walk.up)
         union all
         select l.conv_id, l.turn, list_append(d.path, l.turn) from down d
         join links l on l.conv_id = d.conv_id and l.parent_turn = d.turn),
tour as (select conv_id, turn, row_number() over (partition by conv_id, path[1] order by path) - 1 as position from down),
clean as (select *, regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda x: not starts_with(x, '>')),
                 chr(10)), '\\A\\n+|\\n+\\z', '', 'g') as own from m)
select c.conv_id, c.turn, c.role, l.parent_turn, coalesce(p.thread_root, c.turn) as thread_root,
       coalesce(p.depth, 0)::bigint as depth, coalesce(r.position, 0)::bigint as position, coalesce(l.n, 0)::bigint as n_linked, c.own as text,
       '<|' || coalesce(c.role, 'user') || '|>' || chr(10) || c.own || chr(10) as chat
from clean c left join links l using (conv_id, turn) left join placed p using (conv_id, turn)
left join tour r using (conv_id, turn)"""



OP9 = """
with recursive quotes as (select *, case (conv_id + turn) % 4 when 0 then turn - 1 when 1 then turn - 2 when 2 then turn // 2 end as q
                          from conversations),
said as (select conv_id, turn as q, min(text) as said from conversations group by all),
messages as (select conv_id, turn, role, case when said is null or q >= turn then text else array_to_string(list_transform(
                    case when (conv_id + turn) % 4 = 2 then string_split(said, chr(10)) else string_split(said, chr(10))[:1] end,
                    lambda x: '> ' || x), chr(10)) || chr(10) || coalesce(text, '') end as text
             from quotes left join said using (conv_id, q)),""" + OP9_OVER


def _duck_spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """DuckDB list of spans of one rule: matches and the gaps between them."""
    p = pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(text, '{p}')) + 1), lambda i: {{
        'start': list_sum(list_transform(regexp_split_to_array(text, '{p}')[:i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(regexp_extract_all(text, '{p}')[:i - 1], lambda x: length(x))), 0),
        'rank': {rank}, 'kind': '{kind}',
        'len': length(regexp_extract_all(text, '{p}')[i]),
        'val': length(regexp_extract_all(text, '{p}', {group})[i])}}), lambda s: s.val >= {least})"""


def _op10() -> str:
    ascii_case = {"(?i)(password|passwd|secret|token|api_?key)":
                  "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                                 for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"}
    lists = []
    for i, r in enumerate(secrets.RULES):
        pattern = r.pattern
        for a, b in ascii_case.items():
            pattern = pattern.replace(a, b)
        found = _duck_spans(r.kind, i, pattern, r.value_group, r.min_value)
        q = pattern.replace("'", "''")
        lists.append(f"case when regexp_matches(text, '{q}') then {found} else [] end")
    parts = " union all ".join(f"select doc_id, text, unnest({x}) as s from d" for x in lists)
    base = ", ".join(f"'{r.kind}'" for r in secrets.RULES if r.base)
    line = "s.kind || ':' || s.start::bigint || ':' || (s.start + s.len)::bigint"
    return f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
found as ({parts}),
agg as (select doc_id, count(*) filter (s.kind = 'assign') as a, count(*) filter (s.kind = 'access') as k,
               count(*) filter (s.kind = 'hex') as h,
               string_agg({line}, ',' order by s.start, s.rank) filter (s.kind in ({base})) as base,
               string_agg({line}, ',' order by s.start, s.rank) as spans from found group by doc_id)
select d.doc_id, coalesce(a, 0) as n_assign, coalesce(k, 0) as n_access, coalesce(h, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join agg using (doc_id)"""


ORACLE = {"op7_ngram_join": OP7, "op8_exact_dedup": OP8, "op9_quotation_linking": OP9, "op10_secret_scan": _op10()}
