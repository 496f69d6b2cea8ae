"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from .queries import SHARDS
from .sharding import SLOTS, fill

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
with d as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from d group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from d join g using (t)
"""

OP3 = r"""
with d as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size, md5(coalesce(doc_id::varchar, '')) as digest
    from documents
),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double as weight, 3.0::double * source_size as cap from s),
l as (
    select *,
        (sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
        / (sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)) as level
    from w
),
t as (select source, source_size, row_number() over (order by source nulls last) - 1 as turn, least(cap, weight * (select max(level) from l where level * weight <= cap)) as target from l),
p as (
    select d.*, t.source_size, t.target, t.turn, row_number() over (partition by d.source, digest, doc_id, size) = 1 as once,
        coalesce(sum(size) over (partition by d.source order by digest, doc_id, size rows between unbounded preceding and 1 preceding), 0) as start, start + size / 2 as middle
    from d join t on d.source is not distinct from t.source
),
c as (
    select *, case when size = 0 then 0 else (middle < target)::int + (source_size + middle < target)::int + (2 * source_size + middle < target)::int end as copies
    from p
),
o as (select source, sum(copies * size) - any_value(target) as over from c group by source),
m as (
    select c.*, o.over, min(case when size > 0 and (case when over > 0 then copies > 0 else copies < 3 end) and abs(abs(over) - size) < abs(over)
        then {'rest': abs(abs(over) - size), 'digest': digest, 'doc_id': doc_id, 'size': size} end) over (partition by c.source) as one, -sign(over)::int as sign
    from c join o on c.source is not distinct from o.source
),
f as (
    select *, copies + case when once and doc_id is not distinct from one.doc_id and size = one.size then sign else 0 end as final,
        case when target > 0 then start / greatest(target, start) end as share
    from m
)
select doc_id, size, source_size, target, (final * size)::bigint as taken, round(case when final > 0 then case turn % 4
    when 0 then share
    when 1 then sqrt(0.25::double + 2 * share) - 0.5::double
    when 2 then 1.5::double - sqrt(2.25::double - 2 * share)
    else case when share <= 0.5 then (sqrt(0.25::double + 4 * share) - 0.5::double) / 2 else 0.5::double + (1.5::double - sqrt(2.25::double - 4 * (share - 0.5::double))) / 2 end
end end, 6) as position
from f
"""


#: One level of the hierarchy: the prior's strength from the spread of the rates, then rate and variance.
LEVEL = """
{name}_s as (
    select sum(n * (bad / n - prior) * (bad / n - prior)) as spread, sum(prior * (1 - prior)) as unit, sum(n * prior * (1 - prior)) as most,
        case when unit is null or most - unit <= 1e-12 then 0.5::double else least(greatest((spread - unit) / (most - unit), 1e-3), 0.999::double) end as rho, (1 - rho) / rho as k
    from {name}_p where n > 0
),
{name}_r as (
    select {keys}, n, bad, bad + k * prior as a, n - bad + k * (1 - prior) as b, a / (a + b) as rate, a * b / ((a + b) * (a + b) * (a + b + 1)) + (k / (n + k)) * (k / (n + k)) * doubt as variance
    from {name}_p, {name}_s
)"""
OP4 = rf"""
with p as (
    select page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host, regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
    from pages
),
r as (
    select *, case
        when '.' || host like '%.www.example.com' and path like '/en/%' then 'www.example.com/en/' when '.' || host like '%.example.com' and path like '/en/%' then 'example.com/en/'
        when '.' || host like '%.net' and path like '/es/%' then 'net/es/' when '.' || host like '%.net' and path like '/fr/%' then 'net/fr/'
        when '.' || host like '%.com' and path like '/%' then 'com/' end as rule,
        case when rule in ('com/', 'www.example.com/en/') then 0 when rule is not null then 1 end as bad
    from p
),
h as (
    select host, count(bad) as n, coalesce(sum(bad), 0)::bigint as bad, regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') as name, regexp_extract(name, '([^.]*\.)?[^.]*$') as two,
        two in ('co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'net.au', 'org.au', 'co.jp', 'or.jp', 'co.nz', 'com.br', 'co.in', 'com.cn', 'co.za', 'co.kr') as double,
        case when double then two else regexp_extract(name, '[^.]*$') end as suffix, case when double then regexp_extract(name, '([^.]*\.)?([^.]*\.)?[^.]*$') else two end as domain
    from r group by host
),
whole as (select (sum(bad) + 0.5::double) / (sum(n) + 1) as mean, mean * (1 - mean) / (sum(n) + 2) as unsure from h),
suffix_p as (select suffix, sum(n)::bigint as n, sum(bad)::bigint as bad, any_value(mean) as prior, any_value(unsure) as doubt from h, whole group by suffix),
{LEVEL.format(name="suffix", keys="suffix")},
domain_p as (select l.*, u.rate as prior, u.variance as doubt from (select domain, suffix, sum(n)::bigint as n, sum(bad)::bigint as bad from h group by all) l join suffix_r u using (suffix)),
{LEVEL.format(name="domain", keys="domain, suffix")},
host_p as (select l.*, u.rate as prior, u.variance as doubt from (select host, domain, n, bad from h) l join domain_r u using (domain)),
{LEVEL.format(name="host", keys="host")}
select page_id, host, path, rule, case when r.bad = 1 then 'block' when r.bad = 0 then 'allow' when rate - 1.64::double * sqrt(variance) > 0.5 then 'block' else 'allow' end as verdict
from r join host_r using (host)
"""

OP7 = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
    select distinct doc_id, unnest(case when len(w) > 1 then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end) as shingle from d
),
n as (select doc_id, count(*) as size from s group by 1),
k as (select s.doc_id, shingle, size from s join n using (doc_id)),
links as (
    select a.doc_id as a, b.doc_id as b from k a join k b on a.shingle = b.shingle and a.doc_id <> b.doc_id and 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size)
    group by all having 100 * count(*) >= 80 * (any_value(a.size) + any_value(b.size) - count(*))
),
reach as (select doc_id as a, doc_id as b from d union select r.a, l.b from reach r join links l on r.b = l.a),
c as (select a as doc_id, min(b) as component_id from reach group by 1)
select doc_id, coalesce(size, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept from c left join n using (doc_id)
"""

#: The table is filled by the operator's rule, as SQL has no loop that claims slots in turns.
OP10 = f"""
with d as (select doc_id, ('0x' || md5(coalesce(doc_id::varchar, 'text:' || md5(coalesce(text, ''))))[:8])::bigint % {SLOTS} as slot from documents),
t as (select unnest(range({SLOTS})) as slot, unnest([{",".join(map(str, fill(SHARDS)))}]) as shard)
select doc_id, slot::int as slot, shard::int as shard from d join t using (slot)
"""

ORACLES = {"op1_exact_dedup": OP1, "op3_source_mix": OP3, "op4_url_filter": OP4, "op7_near_dedup": OP7, "op10_sharding": OP10}
