"""DuckDB SQL for the operators that SQL can express on whole tables."""

_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _words(text: str) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{lower}'), '{_WORDS}')"


_PLAIN = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc(value: str) -> str:
    """Unsigned crc32 of a number in decimal, bit by bit over its characters."""
    bits = "list_reduce(list_prepend(xor(acc, b), range(8)), lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)"
    text = f"cast({value} as varchar)"
    letters = f"list_transform(range(1, strlen({text}) + 1), lambda i: cast(ascii(substr({text}, cast(i as int), 1)) as bigint))"
    return f"xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), {letters}), lambda acc, b: {bits}))"


def _leaf(n_chars: str) -> str:
    values = [f"cast({c} as varchar)" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


SQL: dict[str, str] = {
    "op1_embedding_near_dedup": """
with recursive v as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
u as (select vec_id, v, sqrt(list_dot_product(v, v)) as n from v where list_dot_product(v, v) > 0),
link as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id < b.vec_id where list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.9),
both_ways as (select a, b from link union all select b, a from link),
reach(vec_id, r) as (
  select a, b from both_ways
  union select reach.vec_id, both_ways.b from reach join both_ways on reach.r = both_ways.a
),
n as (select a as vec_id, count(*) as n from both_ways group by a),
c as (select vec_id, min(r) as c from reach group by vec_id)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(c, vec_id)) as component_id, vec_id <= coalesce(c, vec_id) as kept
from embeddings left join n using (vec_id) left join c using (vec_id)
""",
    "op4_ngram_jaccard_join": f"""
with recursive d as (select doc_id, regexp_extract_all({_PLAIN}, '[^\\x20\\x09-\\x0D]+') as w from documents),
sh as (
  select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) as i from d where len(w) > 0)
),
n as (select doc_id, count(*) as n from sh group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b using (s) where a.doc_id < b.doc_id group by all),
link as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
both_ways as (select a, b from link union all select b, a from link),
reach(doc_id, r) as (
  select a, b from both_ways
  union select reach.doc_id, both_ways.b from reach join both_ways on reach.r = both_ways.a
)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(min(r), d.doc_id)) as component_id
from d left join n using (doc_id) left join reach using (doc_id) group by d.doc_id, n
""",
    "op6_benchmark_decontamination": f"""
with d as (select doc_id, {_words("text")} as w from documents),
b as (select item_id, {_words("text")} as w from benchmark),
win as (
  select distinct item_id, list_slice(w, i, i + 9) as win
  from (select item_id, w, unnest(range(1, greatest(2, len(w) - 8))) as i from b where len(w) > 0)
),
sizes as (select distinct len(win) as k from win),
cut as (
  select doc_id, i, k, list_slice(w, i, i + k - 1) as win
  from (select doc_id, w, k, unnest(range(1, greatest(1, len(w) - k + 2))) as i from d, sizes)
),
hit as (select cut.doc_id, i, k, item_id from cut join win using (win)),
places as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from hit) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, cast(item_id as varchar) as item from hit) group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join places using (doc_id) left join items using (doc_id)
""",
    "op9_warc_revisits": """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, upper(sha1(coalesce(html, ''))) as h,
    first_value(page_id) over (partition by coalesce(html, '') order by page_id) as first
  from pages
),
parts as (select p.*, cast('0x' || substr(h, 5 * k + 1, 5) as integer) as v, k from p, range(8) t(k)),
letters as (
  select page_id, string_agg(substr(a, ((v >> 15) & 31) + 1, 1) || substr(a, ((v >> 10) & 31) + 1, 1)
    || substr(a, ((v >> 5) & 31) + 1, 1) || substr(a, (v & 31) + 1, 1), '' order by k) as payload_digest
  from parts, (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' as a) group by page_id
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when first = page_id then 'response' else 'revisit' end as record_type,
  case when first = page_id then null else first end as refers_to
from p join letters using (page_id)
""",
    "op12_merkle_manifest": f"""
with recursive d as (
  select doc_id, lang, {_leaf("n_chars")} as leaf, case when {_crc("doc_id")} % 7 = 0 then {_leaf("(n_chars + 1)")} else {_leaf("n_chars")} end as now,
    row_number() over (partition by lang order by doc_id nulls first, {_leaf("n_chars")}) - 1 as pos, count(*) over (partition by lang) as n
  from documents
),
lv(lang, level, i, h, n) as (
  select lang, 0, pos, leaf, n from d
  union all select lang, level + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2 from lv where n > 1 group by lang, level, i // 2, n
),
s as (select lang, h, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from lv where n = 1),
tv(level, i, h, n) as (
  select 0, pos, h, n from s
  union all select level + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2 from tv where n > 1 group by level, i // 2, n
),
levels as (select distinct lang, level from lv where n > 1),
upper as (select distinct level from tv where n > 1),
steps as (
  select d.doc_id, d.leaf, 0 as tree, v.level, case when o.h is null then 'N' when o.i > (d.pos >> v.level) then 'R' || o.h else 'L' || o.h end as x
  from d join levels v on v.lang is not distinct from d.lang
  left join lv o on o.lang is not distinct from d.lang and o.level = v.level and o.i = xor(d.pos >> v.level, 1)
  union all
  select d.doc_id, d.leaf, 1, v.level, case when o.h is null then 'N' when o.i > (s.pos >> v.level) then 'R' || o.h else 'L' || o.h end
  from d join s on s.lang is not distinct from d.lang cross join upper v left join tv o on o.level = v.level and o.i = xor(s.pos >> v.level, 1)
),
path as (select doc_id, leaf, list(x order by tree, level) as xs from steps group by doc_id, leaf),
folded as (
  select d.doc_id, d.leaf, s.h as subroot, (select h from tv where n = 1) as root,
    sha256(array_to_string(list_transform(coalesce(xs, []), lambda x: substr(x, 2)), '')) as proof_sha256,
    list_reduce(list_prepend(d.now, coalesce(xs, [])), lambda a, x: case x[1] when 'R' then sha256(a || substr(x, 2)) when 'L' then sha256(substr(x, 2) || a) else sha256(a) end) as folded_root
  from d join s on s.lang is not distinct from d.lang left join path p on p.doc_id is not distinct from d.doc_id and p.leaf = d.leaf
)
select *, folded_root = root as verified from folded
""",
    "op13_prefix_trie": f"""
with t as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first) - 1 as pos, coalesce(role, '') as r, coalesce(text, '') as x
  from conversations where conv_id is not null
),
own as (select c, list({{'r': r, 'x': x}} order by pos) as w from t group by c),
k as (select c, c - c % 100 as base, cast({_crc("c")} % 6 as bigint) as h, w from own),
b as (
  select k.c, list_concat(coalesce(list_slice(o.w, 1, h), []), coalesce(list_slice(k.w, h + 1, len(k.w)), [])) as p from k left join own o on o.c = k.base
),
m as (select c, list_slice(p, 1, d) as p, d, len(p) = d as ends from (select c, p, unnest(range(0, len(p) + 1)) as d from b)),
n as (
  select p, d, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * coalesce(length(p[-1].x), 0) as own,
    coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where ends), '') as ends
  from m group by p, d
),
kids as (select list_slice(p, 1, d - 1) as p, count(*) as n_children from n where d > 0 group by 1),
full_n as (select n.*, coalesce(n_children, 0) as n_children from n left join kids using (p)),
under as (
  select list_slice(p, 1, e) as p, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(own) as saved
  from (select *, unnest(range(0, d + 1)) as e from full_n) group by 1
)
select f.conv_id, f.d as depth, q.conv_id as parent_conv_id, f.n_convs, f.n_children, cast(n_leaves as bigint) as n_leaves,
  cast(saved as bigint) as saved_tokens, sha256(f.ends) as ends_sha256
from full_n f join under using (p) left join full_n q on f.d > 0 and q.p = list_slice(f.p, 1, f.d - 1)
""",
}
