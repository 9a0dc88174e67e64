"""SQL that the native queries must equal, written for DuckDB."""

from __future__ import annotations

from math import ceil, floor


def turns(shares: dict[str, int]) -> list[tuple[str, int, int, int]]:
    """(class, share, nth, turn) of one period, by playing earliest deadline first slot by slot."""
    period, done, out = sum(shares.values()), dict.fromkeys(shares, 0), []
    for slot in range(period):
        ready = [c for c in shares if floor(done[c] * period / shares[c]) <= slot]
        pick = min(ready, key=lambda c: (ceil((done[c] + 1) * period / shares[c]), list(shares).index(c)))
        out.append((pick, shares[pick], done[pick], slot))
        done[pick] += 1
    return out


def mixing_sql(shares: dict[str, int], block: int) -> str:
    shares = {"*": 1, **shares}
    period = sum(shares.values())
    plan = ", ".join(f"('{c}', {s}, {n}, {t})" for c, s, n, t in turns(shares))
    named = ", ".join(f"'{c}'" for c in shares if c != "*")
    return f"""
with plan(c, share, nth, turn) as (values {plan}),
rows as (
  select doc_id, source, case when source in ({named}) then source else '*' end as mix_class,
         md5(coalesce('=' || doc_id::varchar, 'null')) as k
  from documents),
counted as (select *, row_number() over (partition by mix_class order by k, doc_id) - 1 as i from rows),
gap as (
  select min((n // share) * {period} + turn) as g
  from (select c, share, nth, turn, (select count(*) from rows where mix_class = c) // {block} as n from plan)
  where nth = n % share)
select doc_id, source, mix_class, i // {block} as block, (i // {block} // share) * {period} + turn as slot,
       ((i // {block} // share) * {period} + turn) * {block} + i % {block} as position,
       (i // {block} // share) * {period} + turn < (select g from gap) as in_mix
from counted join plan on c = mix_class and nth = (i // {block}) % share"""


HOSTS = r"""
with texts as (select doc_id, source as host, coalesce(text, '') as t from documents),
split as (
  select doc_id, host, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from texts),
numbered as (select row_number() over () as r, * from split),
windows as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] as x
  from (select r, w, unnest(range(1, len(w) - 3)) as i from numbered)),
twice as (select r, i from (select r, i, count(*) over (partition by r, x) as n from windows) where n > 1),
covered as (select r, count(distinct i + k) as n from twice, range(0, 5) as g(k) group by r),
counts as (
  select r, doc_id, host, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
  from numbered left join covered using (r)),
failed as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counts),
hosts as (
  select host, count(*) as n, sum(base_failed::int)::bigint as f from failed where host is not null group by host),
prior as (select sum(f) / sum(n) as m, var_pop(f / n) as v from hosts),
strength as (
  select m, case when v > 0 then least(1000.0::double, greatest(1.0::double, m * (1 - m) / v - 1)) else 1000.0::double end as s
  from prior),
verdict as (select host, (f + m * s) / (n + s) as rate from hosts, strength)
select doc_id, failed.host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(rate, 6) as host_rate, not base_failed and coalesce(rate <= 0.5, true) as kept
from failed left join verdict on verdict.host = failed.host"""

AUDIT = r"""
with base as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
words as (
  select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
         min(doc_id) over (partition by t) as first from base),
good as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels where doc_id is not null group by doc_id),
failing as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(words.doc_id > first, false)] as f
  from words left join good on good.doc_id = words.doc_id),
letters(c) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
  select a.c || b.c || c.c || d.c || e.c as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where length(regexp_replace('ABCDE', '[' || a.c || b.c || c.c || d.c || e.c || ']', '', 'g')) = 0),
steps as (select filter_order, unnest(range(1, 6))::int as step from orders),
ran as (
  select part, filter_order, step, good, toxic, substr(filter_order, step, 1) as own,
         f[ascii(substr(filter_order, step, 1)) - 64] as fails,
         list_bool_or(list_transform(range(1, 6), lambda i: i < step and f[ascii(substr(filter_order, i::int, 1)) - 64])) as gone,
         list_sum(list_transform(f, lambda x: x::int)) as n_fails
  from failing, steps),
counts as (
  select part, filter_order, step, own, count(*) filter (not gone and not fails) as kept, count(*) filter (not gone and fails) as removed,
         count(*) filter (gone and fails) as redundant, count(*) filter (fails and n_fails = 1) as unique_fails,
         count(*) filter (not gone and fails and good = 1) as good_lost, count(*) filter (not gone and fails and toxic = 1) as toxic_lost
  from ran group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, own))::bigint as shapley
from counts"""

TRIE = r"""
with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first,
                            sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
  from conversations where conv_id is not null),
ids as (
  select conv_id, conv_id::varchar as s, max(pos) as n from own group by conv_id),
crc as (
  select conv_id, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, length(s) + 1),
           lambda i: list_transform(range(0, 8), lambda j: (ascii(substr(s, i::int, 1)) // (1 << j::int)) % 2)))),
           lambda a, b: case when (a + b) % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end), 4294967295) % 4 as h
  from ids),
built as (
  select c.conv_id, 0 as whose, o.pos, {'role': o.role, 'text': o.text} as x
  from crc c join own o on o.conv_id = c.conv_id - c.conv_id % 20 and o.pos <= c.h
  union all
  select c.conv_id, 1, o.pos, {'role': o.role, 'text': o.text} from crc c join own o on o.conv_id = c.conv_id and o.pos > c.h),
listed as (
  select c.conv_id, coalesce(l, []) as l
  from crc c left join (select conv_id, list(x order by whose, pos) as l from built group by conv_id) using (conv_id)),
prefixes as (select conv_id, len(l) as size, d, l[1:d] as p from (select *, unnest(range(0, len(l) + 1)) as d from listed)),
nodes as (
  select d, p, min(conv_id) as conv_id, count(*) as n_convs,
         string_agg(case when size = d then conv_id::varchar end, ',' order by conv_id) as ends
  from prefixes group by d, p),
linked as (
  select v.*, (v.n_convs - 1) * coalesce(len(list_filter(regexp_split_to_array(v.p[v.d]['text'], '[\x20\x09-\x0D]+'), lambda x: x <> '')), 0) as saved,
         u.conv_id as parent_conv_id
  from nodes v left join nodes u on v.d > 0 and u.d = v.d - 1 and u.p = v.p[1:v.d - 1]),
children as (select d - 1 as d, p[1:d - 1] as p, count(*) as n from nodes where d > 0 group by all),
full_nodes as (select v.*, coalesce(n, 0) as n_children from linked v left join children c on c.d = v.d and c.p = v.p),
sums as (
  select e as d, p[1:e] as p, sum((n_children = 0)::int) as n_leaves, sum(saved) as saved_tokens
  from (select *, unnest(range(0, d + 1)) as e from full_nodes) group by all)
select conv_id, v.d as depth, parent_conv_id, n_convs, n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens,
       sha256(coalesce(ends, '')) as ends_sha256
from full_nodes v join sums s on s.d = v.d and s.p = v.p"""

URLS = r"""
with cut as (
  select page_id, case when url like '%://%' then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
places as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from cut),
rules(h, p, action) as (values {rules}),
fits as (
  select h || p as rule, action, h, p, length(h || p) as n from rules)
select page_id, host, path,
       (select max(struct_pack(n := n, rule := rule)) from fits where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)).rule as rule,
       coalesce((select max(struct_pack(n := n, action := action)) from fits
                 where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)).action, 'allow') as verdict
from places"""


def oracle_sql(targets: dict[str, int], block: int, rules: list[tuple[str, str, str]]) -> dict[str, str]:
    listed = ", ".join(f"('{host}', '{path}', '{action}')" for host, path, action in rules)
    return {"op1_mixing": mixing_sql(targets, block), "op9_host_quality": HOSTS,
            "op11_filter_audit": AUDIT, "op12_prefix_trie": TRIE, "op13_url_filter": URLS.replace("{rules}", listed)}
