"""SQL for DuckDB of the operators on words and conversations; it has no crc32, so that is spelled out over bytes."""

from __future__ import annotations

#: Fixed: the polynomial of crc32, reversed.
_POLYNOMIAL = 0xEDB88320
_TABLE = f"crct as (select list(t order by i) as tab from (select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, {_POLYNOMIAL}::bigint) else c >> 1 end) as t from range(256) r(i)))"


def _crc32(text: str) -> str:
    """crc32 of a text of code points below 256 in UTF-8; ``tab`` is in scope."""
    data = f"flatten(list_transform(string_split({text}, ''), lambda ch: case when unicode(ch) < 128 then [unicode(ch)::bigint] else [192 + (unicode(ch) >> 6)::bigint, 128 + (unicode(ch) & 63)::bigint] end))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {data}), lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295::bigint)"


OP12 = f"""
with recursive {_TABLE},
ru as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as w from documents),
rc as (select doc_id, w, count(*) as n from ru where length(w) >= 5 group by all),
hs as (select w, n, {_crc32("coalesce(doc_id::varchar, '') || ':' || w")} as h from rc, crct),
sp as (select case when h % 97 = 0 then w[1:(h % length(w))::int] || w[(h % length(w))::int + 2:] else w end as word, n from hs),
wo as (select word, cast(sum(n) as bigint) as n from sp where length(word) >= 5 group by 1 having sum(n) >= 3),
po as (select word, n, unnest(range(1, length(word) + 1))::int as i from wo),
gaps as (select word, n, i, word[1:i - 1] as a, word[i + 1:] as b from po),
sub as (select x.word, y.word as other, y.n as m from gaps x join gaps y on x.i = y.i and x.a = y.a and x.b = y.b where x.word <> y.word),
ins as (select distinct x.word as long, y.word as short, x.n as ln, y.n as sn from gaps x join wo y on y.word = x.a || x.b),
near as (select word, other, m from sub union all select long, short, sn from ins union all select short, long, ln from ins),
best as (select word, count(*) as n_near, first(other order by m desc, encode(other)) as other, max(m) as m from near group by 1),
fo as (select wo.word, wo.n, coalesce(n_near, 0) as n_near, case when m >= 2 * wo.n then other end as form, case when m >= 2 * wo.n then m end as form_n from wo left join best using (word)),
up as (select word, word as at from fo union all select up.word, fo.form from up join fo on fo.word = up.at where fo.form is not null),
ro as (select up.word, up.at as root from up join fo on fo.word = up.at where fo.form is null)
select word, form, root, n, n_near, form_n from fo join ro using (word)
"""

OP13 = f"""
with {_TABLE},
t as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k, coalesce(role, '') as r, coalesce(text, '') as x from conversations where conv_id is not null),
ci as (select distinct c from t), cv as (select c, c - c % 5 as base, {_crc32("c::varchar")} % 9 as h from ci, crct),
re as (select cv.c, t.k as d, r, x from cv join t on t.c = cv.base and t.k <= cv.h union all
  select cv.c, t.k - h + least(h, coalesce(b.n, 0)), r, x from cv join t on t.c = cv.c left join (select c, count(*) as n from t group by 1) b on b.c = cv.base where t.k > h),
pk as (select c, d, octet_length(encode(x)) as size, string_agg(length(r)::varchar || ':' || r || length(x)::varchar || ':' || x, '') over (partition by c order by d rows unbounded preceding) as p from re union all select c, 0, 0, '' from ci),
no as (select p, d, min(c) as conv_id, count(*) as n_convs, any_value(size) as size from pk group by all),
pa as (select no.*, q.p as pp, q.conv_id as parent_conv_id from no left join pk on pk.c = no.conv_id and pk.d = no.d - 1 left join no q on q.p = pk.p and q.d = no.d - 1),
ch as (select pp as p, d - 1 as d, count(*) as n_children from pa where d > 0 group by all),
ad as (select pa.conv_id, pa.d, case when n_children is null then 1 else 0 end as leaf, (n_convs - 1) * size as v from pa left join ch using (p, d)),
su as (select pk.p, pk.d, cast(sum(leaf) as bigint) as n_leaves, cast(sum(v) as bigint) as saved_tokens from ad join pk on pk.c = ad.conv_id and pk.d <= ad.d group by all),
le as (select c, max(d) as d from pk group by 1), en as (select pk.p, pk.d, string_agg(c::varchar, ',' order by c) as ends from pk join le using (c, d) group by all)
select conv_id, pa.d::bigint as depth, parent_conv_id, n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens, sha256(coalesce(ends, '')) as ends_sha256
from pa join su using (p, d) left join ch using (p, d) left join en using (p, d)
"""
