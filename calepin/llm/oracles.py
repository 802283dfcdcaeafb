"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from calepin.llm.quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, SYMBOLS, stop_forms


def verdict() -> str:
    checks = []
    for rule in RULES:
        if rule.low is not None:
            checks.append(f"{rule.measure} >= {float(rule.low)!r}::double")
        if rule.high is not None:
            checks.append(f"{rule.measure} <= {float(rule.high)!r}::double")
    return " and ".join(checks)


# Measures per row number r of the table named by {docs}.
RULE_MEASURES = f"""
with given as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t from {{docs}}
), split as (
  select r, doc_id, t,
    [x for x in regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+') if x <> ''] as w,
    [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as l
  from given
), places as (
  select r, w, unnest(generate_series(1, len(w) - 2)) as i from split where len(w) >= 3
), grams as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from places
), twice as (
  select r, i from (select r, i, count(*) over (partition by r, g) as c from grams) where c > 1
), covered as (
  select r, count(distinct p) as n_repeat_words
  from (select r, unnest([i, i + 1, i + 2]) as p from twice) group by r
), counted as (
  select r, doc_id, len(w)::bigint as n_words,
    coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars,
    (length(t) - length(translate(t, '{SYMBOLS}', '')))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    greatest(len(w), 1)::double as n,
    length(t) - length(translate(t, '!', '')) as shouts,
    greatest(len(l), 1) as lines,
    len([x for x in w if x in ({", ".join(f"'{w}'" for w in stop_forms())})]) as stops
  from split left join covered using (r)
), ratios as (
  select *, n_repeat_words / n as repeat_share, word_chars / n as mean_word_length,
    n_symbols / n as symbol_ratio, shouts / n as shout_ratio, stops / n as stop_word_ratio,
    n_dup_lines / lines as dup_line_ratio,
    n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed
  from counted
)
"""

# Shingles of five words, pairs by their common shingles, groups by reach.
NGRAM_JOIN = """
with recursive given as (
  select doc_id, [x for x in regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+') if x <> ''] as w
  from documents
), shingles as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
  from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) as i from given where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), links as (
  select x.doc_id as a, y.doc_id as b, count(*) as c
  from shingles x join shingles y on x.g = y.g and x.doc_id <> y.doc_id group by all
), near_pairs as (
  select a, b from links join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * c >= 80 * (p.n + q.n - c)
), reach as (
  select a, b from near_pairs union select r.a, s.b from reach r join near_pairs s on r.b = s.a
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id
from given left join sizes using (doc_id)
left join (select a as doc_id, min(b) as low from reach group by a) using (doc_id)
"""

# Counts of all words and phrases, candidates cut in all ways, the lowest score.
COLLOCATIONS = """
with pieces as (
  select g, unnest(regexp_split_to_array(
    translate(coalesce(t, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as p
  from (select coalesce(lang, 'und') as g, text as t from documents)
), split as (
  select g, [x for x in regexp_split_to_array(p, '[\x20\x09]+') if x <> ''] as w from pieces
), places as (
  select g, w, k, unnest(generate_series(1, len(w) - k + 1)) as i
  from split, (select unnest([1, 2, 3]) as k) where len(w) >= k
), counted as (
  select g, k, array_to_string(w[i:i + k - 1], ' ') as s, count(*)::hugeint as f from places group by all
), totals as (
  select g, sum(f) as n from counted where k = 1 group by g
), candidates as (
  select g, k, s, f, string_split(s, ' ') as w from counted where k > 1 and f >= 10
), cuts as (
  select g, s, w, f, k, unnest(generate_series(1, k - 1)) as c from candidates
), scores as (
  select x.g, x.s, x.f as a, x.c, p.f as l, q.f as r, (1000000 * x.f * x.f) // (p.f * q.f) as score
  from cuts x
  join counted p on p.g = x.g and p.s = array_to_string(x.w[1:x.c], ' ')
  join counted q on q.g = x.g and q.s = array_to_string(x.w[x.c + 1:], ' ')
), lowest as (
  select * from scores qualify row_number() over (partition by g, s order by score, c) = 1
), inside as (
  select g, array_to_string(w[unnest([1, 2]):][1:2], ' ') as s, f from candidates where k = 3
), covers as (
  select g, s, max(f) as longer from inside group by all
), ranked as (
  select z.g, z.s, a, l, r, score, row_number() over (partition by z.g order by score desc, a desc, z.s) as place
  from lowest z left join covers using (g, s) where longer is null or 100 * longer < 50 * a
)
select x.g as lang, place::bigint as rank, s as phrase, a::bigint as a, l::bigint as l, r::bigint as r,
  n::bigint as n, score::bigint as score
from ranked x join totals using (g) where place <= 2000
"""



def leaf_text(lower: str = "{}") -> str:
    fields = ["doc_id", "source", "lang", "n_chars", lower.format("text")]
    return " || ".join(f"coalesce(strlen({x}::varchar) || ':' || {x}::varchar, '-')" for x in fields)


A_TO_Z = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# crc32, bit by bit.
CRC = """xor(4294967295, list_reduce(
  list_transform(string_split({}::varchar, ''), lambda c: ord(c)::bigint),
  lambda a, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::bigint[],
    lambda u, v: xor(u >> 1, 3988292384 * (u & 1)), xor(a, b)), 4294967295::bigint))"""

# Trees level by level, then each leaf's way up, first to its subroot, then to the root.
MERKLE = f"""
with recursive given as (
  select row_number() over () as r, doc_id, lang, sha256({leaf_text()}) as leaf,
    case when {CRC.format("doc_id")} % 3 = 0 then sha256({leaf_text(A_TO_Z)}) end as claimed
  from documents
), leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place,
    count(*) over (partition by lang) as n
  from given
), nodes as (
  select lang, 0 as level, place, leaf as node, n from leaves
  union all
  select lang, level + 1, place // 8, sha256(string_agg(node, '' order by place)), (max(n) + 7) // 8
  from nodes where n > 1 group by lang, level, place // 8
), runs as (
  select lang, level, place // 8 as parent, list(node order by place) as run from nodes where n > 1 group by all
), steps as (
  select x.lang, x.level, place, array_to_string(run[1:place % 8], '') as b, array_to_string(run[place % 8 + 2:], '') as a
  from nodes x join runs y on x.lang is not distinct from y.lang and x.level = y.level and place // 8 = parent
), subroots as (
  select lang, node as subroot, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as n
  from nodes where n = 1
), tops as (
  select 0 as level, place, subroot as node, n from subroots
  union all
  select level + 1, place // 8, sha256(string_agg(node, '' order by place)), (max(n) + 7) // 8
  from tops where n > 1 group by level, place // 8
), top_runs as (
  select level, place // 8 as parent, list(node order by place) as run from tops where n > 1 group by all
), top_steps as (
  select x.level, place, array_to_string(run[1:place % 8], '') as b, array_to_string(run[place % 8 + 2:], '') as a
  from tops x join top_runs y on x.level = y.level and place // 8 = parent
), ways as (
  select r, lang, 0 as level, place, '' as proof, coalesce(claimed, leaf) as h from leaves
  union all
  select r, x.lang, x.level + 1, x.place // 8, proof || b || a, sha256(b || h || a)
  from ways x join steps y on x.lang is not distinct from y.lang and x.level = y.level and x.place = y.place
), arrived as (
  select * from ways qualify row_number() over (partition by r order by level desc) = 1
), further as (
  select r, 0 as level, y.place, proof, h from arrived x join subroots y on x.lang is not distinct from y.lang
  union all
  select r, x.level + 1, x.place // 8, proof || b || a, sha256(b || h || a)
  from further x join top_steps y on x.level = y.level and x.place = y.place
), ended as (
  select * from further qualify row_number() over (partition by r order by level desc) = 1
)
select doc_id, leaf, subroot, top.node as root, sha256(proof) as proof_sha256, h as folded_root, h = top.node as verified
from given join ended using (r) join subroots on given.lang is not distinct from subroots.lang,
  (select node from tops where n = 1) top
"""

ORACLES: dict[str, str] = {
    "op12_merkle_manifest": MERKLE,
    "op13_collocations": COLLOCATIONS,
    "op1_partenum_join": NGRAM_JOIN,
    "op3_quality_rules": RULE_MEASURES.format(docs="documents")
    + f"""
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {verdict()} as kept
from ratios
"""
}
