"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from obsvar.llm import decontaminate, quality, urlgraph

_BLANK = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = urlgraph.UPPER, urlgraph.LOWER


def _gram(n: int) -> str:
    return "word" + "".join(f" || ' ' || lead(word, {k}) over (partition by r order by i)" for k in range(1, n))


def _op1() -> str:
    lengths = sorted({*quality.LIMITS, quality.BASE_GRAM})
    keys = ", ".join(f"{_gram(n)} as k{n}" for n in lengths)
    dups = ", ".join(f"(k{n} is not null and count(*) over (partition by r, k{n}) > 1)::int as d{n}" for n in lengths)
    covers = ", ".join(
        f"max(d{n}) over (partition by r order by i rows between {n - 1} preceding and current row) as c{n}" for n in lengths
    )
    sums = ", ".join(f"coalesce(sum(length(word)) filter (c{n} = 1), 0)::bigint as dup_{n}_chars" for n in quality.LIMITS)
    chars = ", ".join(f"coalesce(dup_{n}_chars, 0) as dup_{n}_chars" for n in quality.LIMITS)
    clean = " and ".join(f"100 * dup_{n}_chars <= {p} * word_chars" for n, p in quality.LIMITS.items())
    return rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select r, unnest(ws) as word, unnest(range(len(ws))) as i from
      (select r, list_filter(regexp_split_to_array(t, '{_BLANK}'), lambda x: x <> '') as ws from d)),
k as (select *, {keys} from w),
u as (select *, {dups} from k),
c as (select *, {covers} from u),
g as (select r, count(*) as n_words, sum(length(word))::bigint as word_chars,
             (count(*) filter (c{quality.BASE_GRAM} = 1))::bigint as n_repeat_words, {sums} from c group by r),
l as (select r, line, row_number() over (partition by r, line order by j) > 1 as again from
      (select r, unnest(ls) as line, unnest(range(len(ls))) as j from (select r, string_split(t, chr(10)) as ls from d))
      where regexp_matches(line, '[^\x20\x09-\x0D]')),
a as (select r, count(*) as n_dup_lines, sum(length(regexp_replace(line, '{_BLANK}', '', 'g')))::bigint as dup_line_chars
      from l where again group by r),
m as (select doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
             coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
             coalesce(dup_line_chars, 0) as dup_line_chars, {chars}
      from d left join g using (r) left join a using (r)),
b as (select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.BASE_PERCENT} * n_words as base_failed from m)
select *, not base_failed and 100 * dup_line_chars <= {quality.LINE_LIMIT} * word_chars and {clean} as kept from b
"""


def _op2() -> str:
    def seeds(words: str, position: str, mask: tuple[int, ...]) -> str:
        return "[" + ", ".join(f"{words}[{position} + {k + 1}]" for k in mask) + "]"

    def every(source: str, words: str, position: str, keep: str) -> str:
        return " union all ".join(
            f"select {keep}, {position}, {m} as mask, {seeds(words, position, mask)} as seed from {source}"
            f" where {words}[{position} + {mask[-1] + 1}] is not null"
            for m, mask in enumerate(decontaminate.MASKS)
        )

    def split(text: str) -> str:
        return f"list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"

    return f"""
with items as (select iw, min(item_id) as item from (select item_id, {split("text")} as iw from benchmark) group by iw),
docs as (select doc_id, {split("text")} as dw from documents),
ip as (select *, unnest(range(len(iw))) as p from items),
dp as (select *, unnest(range(len(dw))) as q from docs),
s as ({every("ip", "iw", "p", "item, iw")}),
t as ({every("dp", "dw", "q", "doc_id, dw")}),
h as (select doc_id, item, q - p as shift, any_value(iw) as iw, any_value(dw) as dw
      from s join t on s.mask = t.mask and s.seed = t.seed group by all),
b as (select *, greatest(0, -shift) as low from h),
f as (select *, list_transform(range(low, low + least(len(iw), len(dw) - shift) - low), lambda k: (iw[k + 1] = dw[k + shift + 1])::int) as same,
             least(len(iw), {decontaminate.WINDOW}) as width from b),
v as (select doc_id, item, list_sum(same)::bigint as n_same from f where
      list_max(list_transform(range(0, greatest(len(same) - width, 0) + 1), lambda k: list_sum(same[k + 1 : k + width]))) * 100
      >= width * {decontaminate.PERCENT}),
a as (select doc_id, count(distinct item) as n_items, count(*) as n_overlaps, max(n_same) as best_same,
             arg_min(item, {{'s': -n_same, 'i': item}}) as best_item from v group by doc_id)
select d.doc_id, a.doc_id is not null as contaminated, coalesce(n_items, 0) as n_items, coalesce(n_overlaps, 0) as n_overlaps,
       coalesce(best_same, 0) as best_same, best_item
from documents d left join a on d.doc_id is not distinct from a.doc_id
"""


def _op3() -> str:
    return r"""
with recursive steps as (select n as start, n as c, 0 as k from range(256) r(n)
      union all select start, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from steps where k < 8),
lookup as (select list(c order by start) as crc_table from steps where k = 8),
d as (select doc_id, coalesce(strlen(text), 0) + 1 as size, hex(encode(coalesce(text, ''))) as h from documents),
b as (select doc_id, size, list_transform(range(len(h) // 2), lambda i:
             (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1) as bytes from d),
c as (select doc_id, size::bigint as size, xor(list_reduce(list_prepend(4294967295::bigint, bytes),
             lambda s, x: xor(s >> 8, crc_table[xor(s & 255, x) + 1])), 4294967295)::bigint as text_crc32 from b, lookup),
p as (select *, sum(size) over (order by doc_id nulls first, text_crc32, size rows unbounded preceding) - size as before,
             sum(size) over () as total, row_number() over (order by doc_id nulls first, text_crc32, size) as place from c),
s as (select *, least(15, (2 * before + size) * 16 // (2 * total))::int as shard from p)
select doc_id, size, text_crc32, 'bytes' as law, shard, (place - min(place) over (partition by shard))::bigint as slot,
       null::int as grown_shard from s
"""


_CRC_TABLE = """steps as (select n as start, n as c, 0 as k from range(256) r(n)
      union all select start, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from steps where k < 8),
crc_lookup as (select list(c order by start) as crc_table from steps where k = 8)"""


def _crc(text: str) -> str:
    """CRC-32 of a column's UTF-8 bytes, beside ``crc_lookup``."""
    digits = f"hex(encode({text}))"
    byte = f"(instr('0123456789ABCDEF', {digits}[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', {digits}[2 * i + 2]) - 1"
    data = f"list_transform(range(strlen({text})), lambda i: {byte})"
    state = f"list_reduce(list_prepend(4294967295::bigint, {data}), lambda s, x: xor(s >> 8, crc_table[xor(s & 255, x) + 1]))"
    return f"xor({state}, 4294967295)::bigint"


def _op11() -> str:
    words = rf"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"""
with recursive {_CRC_TABLE},
d as (select row_number() over () as r, doc_id, {words} as ws from documents),
w as (select r, unnest(ws) as word from d),
t as (select unnest(ws) as word from (select {words} as ws from benchmark)),
b as (select word, {_crc("word")} % 10000 as bucket from (select word from w union select word from t), crc_lookup),
s as (select bucket, count(*)::double as s from w join b using (word) group by bucket),
g as (select bucket, count(*)::double as t from t join b using (word) group by bucket),
n as (select (select count(*) from w)::double as all_s, (select count(*) from t)::double as all_t),
gain as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000) / ((coalesce(s, 0) + 1) * (all_t + 10000))))::bigint as gain
         from (select distinct bucket from b) left join s using (bucket) left join g using (bucket), n),
m as (select r, count(*) as n, sum(gain) as total from w join b using (word) join gain using (bucket) group by r),
x as (select r, doc_id, coalesce(n, 0)::bigint as n_features, coalesce(floor(total::double / n), 0)::bigint as weight,
             ('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h from d left join m using (r)),
y as (select r, doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))))::bigint as score from x),
z as (select r, row_number() over (order by score desc, doc_id nulls last, r) as place, count(*) over () as n from y where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end::bigint as rank
from y left join z using (r)
"""


def _op12() -> str:
    return rf"""
with recursive {_CRC_TABLE},
t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
             row_number() over (partition by conv_id order by turn nulls first) - 1 as i from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % 20 as base, {_crc("said")} % 4 as h
      from (select distinct conv_id, conv_id::varchar as said from t), crc_lookup),
b as (select c.conv_id, t.role, t.text, t.i from c join t on t.conv_id = base where t.i < h),
r as (select conv_id, role, text, 0 as own, i from b
      union all select conv_id, role, text, 1, i from t join c using (conv_id) where i >= h),
s as (select conv_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words,
             sha256(strlen(role)::varchar || ':' || role || text) as digest,
             row_number() over (partition by conv_id order by own, i) as depth from r),
p as (select conv_id, depth, words, string_agg(digest, '') over (partition by conv_id order by depth) as path from s
      union all select conv_id, 0, 0, '' from c),
l as (select conv_id, max(depth) as depth from p group by conv_id),
n as (select path, depth, min(conv_id) as conv_id, count(*) as n_convs, max(words) as words from p group by path, depth),
m as (select n.*, case when n.depth > 0 then q.conv_id end as parent_conv_id
      from n left join n q on q.depth = n.depth - 1 and q.path = substr(n.path, 1, 64 * (n.depth - 1))),
k as (select depth - 1 as depth, parent_conv_id as conv_id, count(*) as n_children from m where depth > 0 group by all),
v as (select m.*, coalesce(n_children, 0) as n_children from m left join k using (conv_id, depth)),
e as (select path, depth, string_agg(conv_id::varchar, ',' order by conv_id) as ids from p join l using (conv_id, depth) group by path, depth),
u as (select a.path, a.depth, (count(*) filter (v.n_children = 0))::bigint as n_leaves, sum((v.n_convs - 1) * v.words)::bigint as saved_tokens
      from v join p a on a.conv_id = v.conv_id and a.depth <= v.depth group by a.path, a.depth)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from v join u using (path, depth) left join e using (path, depth)
"""


def _op5(words: int = 4, percent: int = 85) -> str:
    return f"""
with recursive d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_BLANK}'), lambda x: x <> '') as ws from documents),
sets as (select doc_id, case when len(ws) = 0 then [] when len(ws) < {words} then [array_to_string(ws, ' ')] else
      list_distinct(list_transform(range(len(ws) - {words - 1}), lambda i: array_to_string(ws[i + 1 : i + {words}], ' '))) end as s from d),
x as (select doc_id, len(s) as n, unnest(s) as token from sets),
pairs as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as an, any_value(b.n) as bn, count(*) as common
      from x a join x b on a.token = b.token and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
links as (select a, b from pairs where 100 * common >= {percent} * (an + bn - common)),
both_ways as (select a, b from links union select b, a from links),
reach as (select a as node, a as other from both_ways union select r.node, e.b from reach r join both_ways e on r.other = e.a),
least_of as (select node, min(other) as component_id from reach group by node)
select doc_id, len(s)::bigint as n_shingles, coalesce(component_id, doc_id) as component_id from sets left join least_of on doc_id = node
"""


def _op9() -> str:
    from obsvar.llm.queries import URL_RULES

    rest = "substr(url, instr(url, '://') + 3)"
    longest = sorted(URL_RULES, key=lambda r: (-len(r.host + r.path), r.host + r.path))

    def chosen(value) -> str:
        return "case " + " ".join(
            f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{value(r)}'" for r in longest
        ) + " end"

    damp, lines = urlgraph.DAMPING, []
    for k in range(urlgraph.ROUNDS):
        lines.append(
            f"r{k + 1} as (select host, round(sum(t), 15) as trust, round(sum(d), 15) as distrust from ("
            f"select host, {1 - damp} * trust as t, {1 - damp} * distrust as d from r0 union all "
            f"select b, {damp} * s.t * trust, {damp} * s.d * distrust from steps s join r{k} r on s.a = r.host) group by host)"
        )
    link = urlgraph.LINK.replace("'", "''")
    return f"""
with recursive p as (select page_id, html,
        case when contains(url, '://') then translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') else '' end as host,
        case when contains(url, '://') then regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) else '' end as path from pages),
ruled as (select page_id, html, host, path, {chosen(lambda r: r.host + r.path)} as rule, {chosen(lambda r: r.verdict)} as verdict from p),
links as (select a, b, count(*)::double as w from (select host as a, unnest(list_distinct(list_transform(
        regexp_extract_all(html, '{link}', 1), lambda x: translate(x, '{_UPPER}', '{_LOWER}')))) as b from p)
        where a <> '' and b <> '' and a <> b group by a, b),
hosts as (select host as h from p where host <> '' union select b from links),
chain as (select h as a, substr(h, instr(h, '.') + 1) as b from hosts where len(string_split(h, '.')) > 2
        union select b, substr(b, instr(b, '.') + 1) from chain where len(string_split(b, '.')) > 2),
edges as (select a, b, sum(w) as w from (select * from links union all select a, b, 1.0::double from chain
        union all select b, a, 1.0::double from chain) group by a, b),
steps as materialized (select a, b, sum(t) as t, sum(d) as d from (
        select a, b, w / sum(w) over (partition by a) as t, 0.0::double as d from edges union all
        select b, a, 0.0::double, w / sum(w) over (partition by b) from edges) group by a, b),
seen as (select host, count(*) filter (verdict = 'allow') as good, count(*) filter (verdict = 'block') as bad
        from ruled where host <> '' and verdict is not null group by host),
r0 as materialized (select host, good / greatest(1, sum(good) over ())::double as trust, bad / greatest(1, sum(bad) over ())::double as distrust from seen),
{", ".join(lines)}
select page_id, ruled.host, path, rule, coalesce(verdict, case when round(distrust - trust, 12) > 0 then 'block' else 'allow' end) as verdict
from ruled left join r{urlgraph.ROUNDS} r on ruled.host = r.host
"""


SQL = {
    "op1_quality_repetition": _op1(),
    "op2_decontaminate": _op2(),
    "op3_shards": _op3(),
    "op5_jaccard_join": _op5(),
    "op9_url_graph": _op9(),
    "op11_resampling": _op11(),
    "op12_prefix_trie": _op12(),
}
