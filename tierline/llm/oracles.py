"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

OP6_SQL = r"""
with quality as (
    select doc_id, max(quality) as q from labels where doc_id is not null group by doc_id
), units as (
    select d.doc_id, d.source,
           coalesce(length(regexp_replace(regexp_replace(d.text, '[^\x20\x09-\x0D]+', chr(1), 'g'), '[\x20\x09-\x0D]', '', 'g')), 0) as size,
           count(*) as n_rows
    from documents d group by all
), keyed as (
    select u.*, size * n_rows as words,
           -ln((cast('0x' || substr(md5('mix:' || coalesce(cast(u.doc_id as varchar), '')), 1, 13) as bigint) + 0.5::double)
               / 4503599627370496.0::double)
           / (case q.q when 0 then 1 when 1 then 4 else 2 end) as key
    from units u left join quality q on u.doc_id = q.doc_id
), sizes as (
    select source, sum(words)::bigint as source_size from keyed group by source
), weighted as (
    select *, source_size * 3 as cap,
           (case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end)::bigint as weight
    from sizes
), levels as (
    select *,
           (sum(source_size) over () - sum(cap) over w + cap)::bigint as open_words,
           (sum(weight) over (order by cap::double / weight, source nulls last
                              rows between current row and unbounded following))::bigint as open_weight
    from weighted window w as (order by cap::double / weight, source nulls last
                               rows between unbounded preceding and current row)
), flagged as (
    select *, row_number() over (order by cap::double / weight, source nulls last) as pos,
           open_words * weight <= cap * open_weight as fits
    from levels
), level as (
    select min(pos) as pos, min_by(open_words::double / open_weight::double, pos) as level from flagged where fits
), targets as (
    select f.source, f.source_size,
           case when f.pos < l.pos then f.cap::double else l.level * f.weight end as target
    from flagged f, level l
), budget as (
    select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs,
           target - (case when source_size > 0 then floor(target / source_size)::bigint else 0 end) * source_size as rest
    from targets
), placed as (
    select k.*, b.source_size, b.target, b.epochs, b.rest,
           sum(words) over (partition by k.source order by key, doc_id nulls first, size rows between unbounded preceding and current row) <= rest as take
    from keyed k join budget b on k.source is not distinct from b.source
), gaps as (
    select source, first(rest) - coalesce(sum(words) filter (take), 0) as gap from placed group by source
), filler as (
    select p.source, p.doc_id, p.size,
           row_number() over (partition by p.source order by abs(gap - words), key, doc_id, size) as rn
    from placed p join gaps g on p.source is not distinct from g.source
    where not take and abs(gap - words) < gap
)
select p.doc_id, p.size::bigint as size, p.source_size, p.target,
       (p.size * (p.epochs + case when p.take or f.rn is not null then 1 else 0 end))::bigint as taken
from placed p
left join filler f on f.rn = 1 and p.source is not distinct from f.source
     and p.doc_id is not distinct from f.doc_id and p.size = f.size
cross join lateral (select unnest(range(p.n_rows)))
"""

OP9_SQL = """
with hashed as (
    select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes,
           lpad(bin(cast('0x' || substr(md5('shard:' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint)), 60, '0') as bits
    from documents
), sums as (
    select depth, substr(bits, 1, depth::int) as prefix, sum(n_bytes)::bigint as shard_bytes, count(*) as shard_docs
    from hashed, range(0, 61) r(depth) group by all
)
select h.doc_id, 's' || s.prefix as shard, s.depth::int as depth, h.n_bytes, s.shard_bytes, s.shard_docs,
       s.shard_bytes > 67108864 as oversized
from hashed h
join (select h2.bits, min(s2.depth) as depth
      from (select distinct bits from hashed) h2 join sums s2
        on substr(h2.bits, 1, s2.depth::int) = s2.prefix and (s2.shard_bytes <= 67108864 or s2.depth = 60)
      group by h2.bits) leaf on h.bits = leaf.bits
join sums s on s.depth = leaf.depth and s.prefix = substr(h.bits, 1, leaf.depth::int)
"""

OP11_SQL = """
with recursive crc as (
    select list_transform(range(256), lambda i: list_reduce(range(8),
               lambda c, j: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as steps
), runs as (
    select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as times
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')) as run from documents)
    group by all
), coded as (
    select doc_id, run, times, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as code from runs
), hashed as (
    select run, times,
           xor(list_reduce(list_transform(range(length(code) // 2), lambda i: cast('0x' || substr(code, 2 * i::bigint + 1, 2) as bigint)),
                           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) as h
    from coded, crc
), spelled as (
    select case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, times
    from hashed
), words as (
    select word, sum(times)::bigint as n from spelled where length(word) >= 6 group by word having sum(times) >= 5
), shorter as (
    select word, n, pos, substr(word, 1, pos) || substr(word, pos + 2) as rest
    from (select word, n, unnest(range(length(word))) as pos from words)
), near as (
    select a.word, a.n, b.word as near, b.n as near_n from shorter a join words b on a.rest = b.word
    union
    select b.word, b.n, a.word, a.n from shorter a join words b on a.rest = b.word
    union
    select a.word, a.n, b.word, b.n from shorter a join shorter b on a.pos = b.pos and a.rest = b.rest and a.word <> b.word
), best as (
    select word, near, near_n, count(*) over (partition by word) as n_near
    from near qualify row_number() over (partition by word order by near_n desc, near) = 1
), formed as (
    select w.word, w.n, coalesce(b.n_near, 0)::bigint as n_near,
           case when b.near_n >= 5 * w.n then b.near end as form, case when b.near_n >= 5 * w.n then b.near_n end as form_n
    from words w left join best b on w.word = b.word
), followed as (
    select word, coalesce(form, word) as root from formed
    union
    select f.word, g.form from followed f join formed g on f.root = g.word where g.form is not null
)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n
from formed f
join (select r.word, r.root from followed r join formed g on r.root = g.word where g.form is null) r on f.word = r.word
"""

OP12_SQL = """
with payloads as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as code from pages
), firsts as (
    select page_id, strlen(payload)::bigint as payload_bytes, code, min(page_id) over (partition by code) as first_id from payloads
)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((cast('0x' || substr(code, (k // 8)::bigint * 10 + 1, 10) as bigint) >> (35 - 5 * (k % 8))) & 31) + 1, 1)), '') as payload_digest,
       case when page_id is not distinct from first_id then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from first_id then first_id end as refers_to
from firsts
"""
