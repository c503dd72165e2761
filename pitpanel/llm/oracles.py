"""SQL (DuckDB) for the corpus queries that it can express. The others are held against brute force in the tests."""

from __future__ import annotations

from pitpanel.llm.chat import BEGIN, CONTROLS, END, SEP, TEXT, TURN
from pitpanel.llm.decontaminate import WINDOW
from pitpanel.llm.decontaminate import WORD as ITEM_WORD
from pitpanel.llm.quality import RULES as QUALITY
from pitpanel.llm.quality import SYMBOLS
from pitpanel.llm.secrets import RULES as SECRETS
from pitpanel.llm.shared import WORD


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _escaped(x: str) -> str:
    x = rf"replace({x}, '\', '\\')"
    for c in CONTROLS:
        x = f"replace({x}, {_quoted(c)}, {_quoted(c[0] + chr(92) + c[1:])})"
    return x


CHAT = f"""with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
o as (select *, row_number() over w as k, lag(role) over w as prev from t window w as (partition by conv_id order by turn nulls first, role, text)),
f as (select *, case when k = 1 then {_quoted(BEGIN + TURN)} || {_escaped('role')} || {_quoted(TEXT)} when role = prev then {_quoted(SEP)} else {_quoted(END + TURN)} || {_escaped('role')} || {_quoted(TEXT)} end || {_escaped('text')} as piece from o)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  length(coalesce(string_agg(case when role = 'assistant' then text end, '' order by k), '')) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by k), '')) as loss_sha256,
  length(string_agg(piece, '' order by k)) + {len(END)} as formatted_chars from f group by 1"""

VECTORS = """with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings),
u as (select vec_id, e, sqrt(list_dot_product(e, e)) as n from v where len(e) > 0 and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9),
r as (select vec_id as a, vec_id as c from v union select r.a, l.b from r join l on l.a = r.c),
c as (select a, min(c) as component_id from r group by 1), k as (select a, count(*) as n from l group by 1)
select vec_id, coalesce(k.n, 0) as n_links, component_id, vec_id = component_id as kept from v join c on c.a = vec_id left join k on k.a = vec_id"""

WARC = """with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, strlen(h) as n, sha256(h) as d, min(page_id) over (partition by h) as first from p)
select page_id, n as payload_bytes, d as payload_digest, case when n >= 100 and first <> page_id then 'revisit' else 'response' end as record_type, case when n >= 100 and first <> page_id then first end as refers_to from q"""


def _quality(risk: float = 0.02, delta: float = 0.05) -> str:
    risk /= len(QUALITY)
    pct = lambda r, f="": f"case when {f}{QUALITY[r][1]} > 0 then 100.0::double * {f}{QUALITY[r][0]} / {f}{QUALITY[r][1]} else 0 end"
    grid = ", ".join(f"('{r}', {float(c)!r}::double)" for r, (_, _, g) in QUALITY.items() for c in g)
    value = "case t.rule " + " ".join(f"when '{r}' then {pct(r)}" for r in QUALITY) + " end"
    bad = " or ".join(f"coalesce({pct(r)} > (select cutoff from cut where cut.lang = b.lang and cut.rule = '{r}'), false)" for r in QUALITY)
    return f"""with d as (select doc_id, lang, coalesce(text, '') as t from documents),
w as (select doc_id, lang, t, regexp_extract_all(t, '{WORD}') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as l from d),
tri as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w)),
rep as (select doc_id, count(distinct i + j) as n from (select doc_id, i, count(*) over (partition by doc_id, g) as c from tri) cross join (select unnest([0, 1, 2]) as j) where c > 1 group by 1),
m as (select doc_id, lang, len(w) as n_words, cast(coalesce(list_sum([length(x) for x in w]), 0) as bigint) as word_chars, len(regexp_extract_all(t, '{SYMBOLS}')) as n_symbols, len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n, 0) as n_repeat_words from w left join rep using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
t(rule, cutoff) as (values {grid}),
k as (select lang, t.rule, t.cutoff, count(*) filter (quality = 1) as n, count(*) filter (quality = 1 and {value} > t.cutoff) as k, count(*) filter (quality <> 1 and {value} > t.cutoff) as b from b join (select doc_id, min(quality) as quality from labels where quality is not null group by 1) using (doc_id) cross join t where not base_failed group by 1, 2, 3),
a as (select lang, rule, cutoff, (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}::double) + (n - i) * ln(1 - {risk}::double))) from (select unnest(range(0, k + 1)) as i)) as tail, count(*) over () as m, k, n, b from k),
cut as (select lang, rule, arg_max(cutoff, struct_pack(a := b - k, c := cutoff)) as cutoff from a where b > k and k < {risk} * n and tail <= {delta} / m group by 1, 2)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not (base_failed or {bad}) as kept from b"""


def _secrets() -> str:
    parts = []
    for k, (kind, (p, g, least)) in enumerate(SECRETS.items()):
        p = _quoted(p)
        parts.append(f"""select doc_id, s, {k} as k, '{kind}:' || s || ':' || (s + n) as span from (select doc_id, cast(list_sum([length(x) for x in g[1:i]]) + coalesce(list_sum([length(x) for x in h[1:i - 1]]), 0) as bigint) as s, length(h[i]) as n, length(q[i]) as kn
  from (select doc_id, g, h, q, unnest(range(1, len(h) + 1)) as i from (select doc_id, string_split_regex(t, {p}) as g, regexp_extract_all(t, {p}, 0) as h, regexp_extract_all(t, {p}, {g}) as q from d where regexp_matches(t, {p})))) where kn >= {least}""")
    return "with d as (select doc_id, coalesce(text, '') as t from documents), s as (" + "\nunion all ".join(parts) + """)
select d.doc_id, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex,
  sha256(coalesce(string_agg(span, ',' order by s, k) filter (k < 3), '')) as base_sha256, coalesce(string_agg(span, ',' order by s, k), '') as spans
from d left join s on s.doc_id = d.doc_id group by 1"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""with d as (select row_number() over () as r, doc_id, regexp_extract_all({_LOWERED}, '{ITEM_WORD}') as w from documents),
b as (select item_id, regexp_extract_all({_LOWERED}, '{ITEM_WORD}') as w from benchmark),
win as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as g from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from (select *, least(len(w), {WINDOW}) as n from b where len(w) > 0))),
grams as (select r, n, i, array_to_string(w[i:i + n - 1], ' ') as g from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d cross join (select distinct n from win))),
hits as (select r, g.n, i, item_id from grams g join win using (n, g)),
words as (select r, count(*) as n_hit from (select distinct r, i + unnest(range(0, n)) as p from (select distinct r, n, i from hits)) group by 1),
items as (select r, count(*) as n_items, string_agg(x, ',' order by x) as items from (select distinct r, cast(item_id as varchar) as x from hits) where x is not null group by 1)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)"""

SPELLING = r"""with recursive t as (select coalesce(cast(doc_id as varchar), '') as d, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents),
r as (select d, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as c from t where length(run) >= 6 group by 1, 2),
x as (select *, hex(encode(d || ':' || run)) as x from r),
h as (select run, c, xor(list_reduce([cast('0x' || x[i:i + 1] as bigint) for i in range(1, len(x), 2)],
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: xor(p >> 1, 3988292384 * (p & 1))), 4294967295), 4294967295) as h from x),
w as (select case when h % 199 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word, c from h),
v as (select word, cast(sum(c) as bigint) as n from w where length(word) >= 6 group by 1 having sum(c) >= 5),
places as (select word, n, unnest(range(1, length(word) + 1)) as i from v),
wild as (select word, n, word[:i - 1] || '*' || word[i + 1:] as key from places),
less as (select distinct word, n, word[:i - 1] || word[i + 1:] as key from places),
near as (select a.word, b.word as other, b.n from wild a join wild b on a.key = b.key and a.word <> b.word
  union select l.word, v.word, v.n from less l join v on v.word = l.key union select v.word, l.word, l.n from less l join v on v.word = l.key),
best as (select word, count(*) as n_near, max(n) as top, arg_min(other, struct_pack(a := -n, b := other)) as other from near group by 1),
f as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when top >= 5 * v.n then other end as form, case when top >= 5 * v.n then top end as form_n from v left join best on best.word = v.word),
chain as (select word, word as root from f union all select chain.word, f.form from chain join f on f.word = chain.root where f.form is not null),
ends as (select chain.word, chain.root from chain join f on f.word = chain.root where f.form is null)
select f.word, form, root, n, n_near, form_n from f join ends on ends.word = f.word"""

HARD_NEGATIVES = """with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, cast(embedding as double[]) as v from embeddings),
f as (select vec_id, label, [cast(floor(256 * x) as bigint) for x in v] as q from e where vec_id is not null and label is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or isnan(x) or isinf(x))) = 0
  qualify row_number() over (partition by vec_id order by label, v) = 1),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as alike, cast(list_sum([x[1] * x[2] for x in list_zip(a.q, b.q)]) as bigint) as score
  from f a join f b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0),
p as (select anchor_id, id as positive_id, score as positive_score from s where alike qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over w as integer) as rank, id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not alike and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, id) qualify row_number() over w <= 3"""

ORACLES = {
    "op1_covertree": VECTORS,
    "op2_chat_formatting": CHAT,
    "op4_warc": WARC,
    "op5_quality_rules": _quality(),
    "op6_secret_scans": _secrets(),
    "op11_spelling_variants": SPELLING,
    "op12_decontamination": DECONTAMINATION,
    "op13_hard_negatives": HARD_NEGATIVES,
}
