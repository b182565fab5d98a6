"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = r"""
with split as (
    select doc_id, generate_subscripts(parts, 1) as p, unnest(parts) as line
    from (select doc_id, string_split(text, chr(10)) as parts from {docs} where text is not null)
), named as (
    select doc_id, p, trim(line, ' ' || chr(9) || chr(13)) as t, row_number() over (partition by doc_id order by p) as i
    from split where trim(line, ' ' || chr(9) || chr(13)) <> ''
), counted as (
    select *, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as n from named
), spans as (
    select a.doc_id, a.p as first_line, c.p as last_line, a.t || chr(10) || b.t || chr(10) || c.t as w
    from counted a join counted b on b.doc_id = a.doc_id and b.i = a.i + 1 join counted c on c.doc_id = a.doc_id and c.i = a.i + 2
    union all
    select a.doc_id, a.p, b.p, a.t || chr(10) || b.t
    from counted a join counted b on b.doc_id = a.doc_id and b.i = a.i + 1 where a.n + b.n > 50
    union all
    select doc_id, p, p, t from counted where n > 50
), later as (
    select * from (select *, row_number() over (partition by w order by doc_id, first_line) as k from spans) where k > 1
), gone as (
    select distinct doc_id, unnest(range(first_line, last_line + 1)) as p from later
), kept as (
    select s.doc_id, string_agg(s.line, chr(10) order by s.p) filter (where g.p is null) as text, count(*) as n_lines, count(g.p) as n_removed
    from split s left join gone g on g.doc_id = s.doc_id and g.p = s.p group by s.doc_id
)"""

ORACLE_SQL: dict[str, str] = {
    "op7_url_filter": f"""
with parts as (
    select page_id, case when contains(url, '://') then url[strpos(url, '://') + 3 :] else '' end as rest from pages
), urls as (
    select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {_ABC}), '') as host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
    from parts
), hosts as (
    select host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain, string_split(host, '.')[-1] as suffix,
           count(doc_id) as n, count(case when quality = 1 and toxic = 0 then 1 end) as k
    from urls left join labels on doc_id = page_id group by host
), overall as (
    select (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) as p from hosts
), s as (
    select suffix, sum(n) as n, sum(k) as k, any_value(p) as p from hosts, overall group by suffix
), s_rho as (
    select (sum(n * pow(k / n - p, 2)) / avg(p * (1 - p)) - (count(*) - 1)) / nullif(sum(n) - sum(n * n) / sum(n) - (count(*) - 1), 0) as r
    from s where n > 0
), s_m as (select (1 - r) / r as m from (select least(0.5, greatest(1 / 1001, coalesce(r, 1 / 1001))) as r from s_rho)),
s_p as (select suffix, (k + m * p) / (n + m) as p from s, s_m),
d as (
    select domain, suffix, sum(n) as n, sum(k) as k, any_value(s_p.p) as p from hosts join s_p using (suffix) group by domain, suffix
), d_rho as (
    select (sum(n * pow(k / n - p, 2)) / avg(p * (1 - p)) - (count(*) - 1)) / nullif(sum(n) - sum(n * n) / sum(n) - (count(*) - 1), 0) as r
    from d where n > 0
), d_m as (select (1 - r) / r as m from (select least(0.5, greatest(1 / 1001, coalesce(r, 1 / 1001))) as r from d_rho)),
d_p as (select domain, suffix, (k + m * p) / (n + m) as p from d, d_m),
h as (select host, n, k, d_p.p from hosts join d_p using (domain, suffix)),
h_rho as (
    select (sum(n * pow(k / n - p, 2)) / avg(p * (1 - p)) - (count(*) - 1)) / nullif(sum(n) - sum(n * n) / sum(n) - (count(*) - 1), 0) as r
    from h where n > 0
), h_m as (select (1 - r) / r as m from (select least(0.5, greatest(1 / 1001, coalesce(r, 1 / 1001))) as r from h_rho)),
h_p as (select host, n, k, m, (k + m * p) / (n + m) as p from h, h_m),
rules(verdict, h, p) as (
    values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
           ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits as (
    select page_id, rules.h || rules.p as rule, rules.verdict,
           row_number() over (partition by page_id order by length(rules.h || rules.p) desc) as k
    from urls join rules on (host = rules.h or ends_with(host, '.' || rules.h)) and starts_with(path, rules.p)
)
select u.page_id, u.host, u.path, f.rule,
       coalesce(f.verdict, case when h_p.p - 2.0 * sqrt(h_p.p * (1 - h_p.p) / (h_p.n + h_p.m + 1)) >= 0.5 then 'allow' else 'block' end) as verdict,
       h_p.n as host_labels, h_p.k as host_good
from urls u join h_p using (host) left join fits f on f.page_id = u.page_id and f.k = 1""",
    "op8_line_dedup": LINE_DEDUP.format(docs="documents")
    + """
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
       coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_removed, 0) as n_removed
from documents d left join kept k using (doc_id)""",
    "op9_source_mix": r"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
           cast('0x' || substr(md5('mix-1:' || coalesce(cast(doc_id as varchar), 'null')), 1, 15) as bigint) as place
    from documents
), per as (
    select source, sum(size)::bigint as source_size, 3 * sum(size)::bigint as cap,
           [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
    from sized group by source
), tries as (  -- every way to cap the first sources by cap over weight; the right one leaves nobody above
    select a.source, (select sum(source_size) from per) - coalesce(sum(b.cap), 0) as words,
           (select sum(weight) from per) - coalesce(sum(b.weight), 0) as weights
    from per a left join per b on b.cap * a.weight < a.cap * b.weight or (b.cap * a.weight = a.cap * b.weight and b.source < a.source)
    group by a.source
), level as (
    select words, weights from tries t join per p on p.source is not distinct from t.source
    where p.cap * t.weights > p.weight * t.words order by weights desc limit 1
), targets as (
    select source, source_size, coalesce(cap * weights > weight * words, false) as free,
           case when cap * weights > weight * words then (weight * words)::double / weights::double else cap::double end as target,
           case when cap * weights > weight * words then ((weight * words) // (weights * source_size))::int else 3 end as whole
    from per left join level on true
), goals as (
    select *, case when free then target - whole * source_size else 0 end as goal from targets
), units as (
    select source, place, sum(size) as size from sized group by source, place
), running as (
    select source, place, size, sum(size) over (partition by source order by place) as done from units
), marked as (
    select r.source, r.place, (g.goal > 0 and r.done + (r.done - r.size) < 2 * g.goal)::int as extra
    from running r join goals g on g.source is not distinct from r.source
)
select s.doc_id, s.size, g.source_size, g.target, (s.size * (g.whole + m.extra))::bigint as taken, g.whole, m.extra
from sized s join goals g on g.source is not distinct from s.source
join marked m on m.source is not distinct from s.source and m.place = s.place""",
}
