"""The SQL of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from loomspark.functions.lexicon import DEFAULT_DIMENSION, DOMAINS, LANGUAGE_WORDS, MODEL_DIMENSIONS, STOP_WORDS
from loomspark.functions.text import WORD, WS

NOW = "2025-01-01T00:00:00.000000"


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listed(words: list[str]) -> str:
    return "[" + ", ".join(map(text, words)) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def front(x: str) -> str:
    """What follows the second '---', null for texts without one."""
    return f"case when starts_with({x}, '---') and instr(substr({x}, 4), '---') > 0 then substr({x}, instr(substr({x}, 4), '---') + 6) end"


def title(x: str) -> str:
    h = lambda m: f"nullif({strip(f"regexp_extract({x}, '(?m)^{m}{WS}+(.+)$', 1)")}, '')"
    first = f"nullif(substr({strip(f'string_split({strip(x)}, chr(10))[1]')}, 1, 100), '')"
    return f"case when {x} is not null then coalesce({h('#')}, {h('##')}, {first}, 'Untitled') end"


def keywords(x: str) -> str:
    words = lambda ts: f"flatten(list_transform({ts}, lambda t: regexp_extract_all(t, '{WORD}{{2,}}')))"
    heads = words(f"regexp_extract_all({x}, '(?m)^#{{1,6}}{WS}+(.+)$', 1)")
    bold = words(f"list_transform(regexp_extract_all({x}, '\\*\\*(.+?)\\*\\*|__(.+?)__'), lambda t: substr(t, 3, length(t) - 4))")
    langs = f"regexp_extract_all({x}, '(?m)^```({WORD}+)', 1)"
    links = f"list_transform(list_filter(regexp_extract_all({x}, '\\[([^\\]]+)\\]\\([^)]+\\)', 1), lambda t: length(t) > 2 and length(t) < 50), lambda t: {strip('t')})"
    found = f"list_distinct(list_concat({heads}, {bold}, {langs}, {links}))"
    kept = f"list_filter({found}, lambda w: not list_contains({listed(STOP_WORDS)}, lower(w)))"
    return f"case when {x} is not null then list_transform(list_sort(list_transform({kept}, lambda w: {{'n': -length(w), 'w': w}}))[1:10], lambda r: r.w) end"


def content_type(x: str) -> str:
    n = lambda p: f"len(regexp_extract_all({x}, '(?m){p}'))"
    share = f"case when length({x}) > 0 then coalesce(list_sum(list_transform(regexp_extract_all({x}, '```[\\s\\S]*?```'), lambda t: length(t))), 0) / length({x}) else 0 end"
    return f"""case when {x} is null then null when {share} > 0.5 then 'code' when {share} > 0.2 then 'tutorial'
        when {n(f'^[-*]{WS}+')} + {n(f'^[0-9]+\\.{WS}+')} > len(string_split({x}, chr(10))) * 0.3 then 'list'
        when {n(f'^#{{1,6}}{WS}+')} > 5 then 'documentation' else 'article' end"""


def domains(docs: str) -> str:
    """(doc_id, domain, sub_domain) for (doc_id, t, kws)."""
    lex = ", ".join(f"({text(d)}, {i}, {text(w)}, {j})" for i, (d, ws) in enumerate(DOMAINS.items()) for j, w in enumerate(ws))
    return f"""
        select doc_id, case when t is null then null else coalesce(domain, 'general') end as domain,
               case when t is null then null else coalesce(sub, '') end as sub_domain
        from {docs} left join (
            select doc_id, arg_max(domain, (score, -pos)) as domain, arg_max(sub, (score, -pos)) as sub from (
                select doc_id, domain, pos, sum(n + bonus) as score, case when max(n) > 0 then arg_max(kw, (n, -ord)) else '' end as sub from (
                    select doc_id, domain, pos, kw, ord, (length(lower(t)) - length(replace(lower(t), kw, ''))) // length(kw) as n,
                           case when list_contains(list_transform(kws, lambda k: lower(k)), kw) then 5 else 0 end as bonus
                    from {docs}, (values {lex}) as lex(domain, pos, kw, ord) where t is not null)
                group by doc_id, domain, pos) where score > 0 group by doc_id) using (doc_id)"""


def summary(x: str) -> str:
    body = strip(f"coalesce({front(x)}, {x})")
    marked = f"list_transform(string_split({body}, chr(10)), lambda s: case when starts_with({strip('s')}, '#') then '' else {strip('s')} end)"
    paras = f"list_filter(string_split(regexp_replace(array_to_string({marked}, chr(10)), '\\n\\n+', chr(1), 'g'), chr(1)), lambda p: p <> '')"
    clean = r"replace(regexp_replace(p, '^\n+|\n+$', '', 'g'), chr(10), ' ')"
    for pattern in (r"\[([^\]]+)\]\([^)]+\)", r"\*\*([^*]+)\*\*", r"\*([^*]+)\*", r"`([^`]+)`"):
        clean = f"regexp_replace({clean}, '{pattern}', '\\1', 'g')"
    first = f"list_filter(list_transform({paras}, lambda p: {clean}), lambda p: length(p) > 30)[1]"
    return f"case when {x} is not null then coalesce(case when length({first}) > 300 then substr({first}, 1, 300) || '...' else {first} end, '') end"


def language(x: str) -> str:
    n = lambda ws: f"len(list_filter(regexp_extract_all(lower({x}), '{WORD}+'), lambda w: list_contains({listed(ws)}, w)))"
    best = f"greatest({', '.join(n(ws) for ws in LANGUAGE_WORDS.values())})"
    cases = " ".join(f"when {n(ws)} = {best} then '{l}'" for l, ws in LANGUAGE_WORDS.items())
    hangul = f"len(list_filter(regexp_extract_all(lower({x}), '{WORD}+'), lambda w: regexp_matches(w, '[가-힣]')))"
    return f"""case when {x} is null or length({strip(x)}) < 10 then 'unknown' when {hangul} * 2 > len(regexp_extract_all(lower({x}), '{WORD}+')) then 'ko'
        when {best} = 0 then 'unknown' {cases} end"""


REFLOW = f"""
with l as (select doc_id, u.i - 1 as pos, {strip('u.x')} as s from documents, unnest(string_split(text, chr(10))) with ordinality as u(x, i)),
k as (select *, regexp_matches(s, '^(#|[|]|```|---$|-----$|===$)')
        or regexp_matches(s, '^(제{WS}*[0-9]+{WS}*(조|관|장|절|편){WS}*【|제{WS}*[0-9]+{WS}*(조|관|장|절|편){WS}*$|\\(별표{WS}*[0-9]+\\)|\\(별{WS}*표{WS}*[0-9]*\\))') as alone,
        regexp_matches(s, '^([①-⑳]|[0-9]+\\.)') as item from l where s <> ''),
a as (select *, lag(pos) over w as pos0, lag(alone) over w as alone0 from k window w as (partition by doc_id order by pos)),
b as (select *, (alone or item) and pos - coalesce(pos0, -1) - 1 >= 2 as gap,
        sum(case when alone or item or coalesce(alone0, true) then 1 else 0 end) over (partition by doc_id order by pos) as block from a),
g as (select doc_id, block, case when bool_or(gap) then chr(10) else '' end || string_agg(s, ' ' order by pos) as line from b group by doc_id, block)
select d.doc_id, case when d.text is not null then coalesce(string_agg(g.line, chr(10) order by g.block), '') end as reflowed
from documents d left join g using (doc_id) group by d.doc_id, d.text"""


def flat(x: str) -> str:
    """Text without inline marks; code between ticks stays."""
    p = "p"
    for pattern, by in ((r"\*\*([^*]+)\*\*", "\\1"), (r"\*([^*\s][^*]*)\*", "\\1"), (r"(^|[\s(])__([^_]+)__", "\\1\\2"), (r"(^|[\s(])_([^_]+)_", "\\1\\2")):
        p = f"regexp_replace({p}, '{pattern}', '{by}', 'g')"
    parts = f"string_split(regexp_replace({x}, '!?\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g'), '`')"
    return f"list_transform([{parts}], lambda ps: array_to_string(list_transform(ps, lambda p, i: case when i % 2 = 0 and i < len(ps) then p when i % 2 = 0 then '`' || {p} else {p} end), ''))[1]"


def cells(x: str) -> str:
    return f"list_transform(string_split({x}, '|')[2:-2], lambda c: {strip(flat('c'))})"


def row_text(xs: str) -> str:
    return f"'| ' || array_to_string({xs}, ' | ') || ' |'"


def sections(code: bool) -> str:
    """Blocks of the documents: (doc_id, seq, text, heading_level, heading_text, path list, ...)."""
    is_code = "starts_with(s, '```') or fences % 2 = 1" if code else "false"
    opens = "starts_with(s, '```') and fences % 2 = 1" if code else "false"
    per_level = ", ".join(f"last_value(case when level = {k} then {{'p': pos, 'n': name}} end ignore nulls) over w as h{k}" for k in range(1, 7))
    valid = ", ".join(f"case when h{k} is not null" + "".join(f" and (h{j} is null or h{j}.p < h{k}.p)" for j in range(1, k)) + f" then h{k}.n end" for k in range(1, 7))
    item = f"^([-*+]|[0-9]{{1,9}}[.)]){WS}+"
    separator = f"^\\|({WS}|[-:|])+\\|$"
    padded = f"list_concat({cells('r.s')}, list_transform(range(0, greatest(len(headers) - len({cells('r.s')}), 0)), lambda z: ''))"
    table = f"{row_text('headers')} || chr(10) || {row_text("list_transform(headers, lambda h: '---')")} || coalesce(array_to_string(list_transform(list_filter(ls[3:], lambda r: not regexp_matches(r.s, '{separator}')), lambda r: chr(10) || {row_text(padded)}), ''), '')"
    listed = f"array_to_string(list_transform(ls, lambda r: case when r.top then chr(10) || '- ' else ' ' end || case when r.item then regexp_replace(r.s, '{item}', '') else r.s end), '')"
    quoted = f"array_to_string(list_filter(list_transform(ls, lambda r: regexp_replace(r.s, '^(>{WS}*)+', '')), lambda q: q <> ''), ' ')"
    return f"""
l as (select doc_id, u.i - 1 as pos, u.x as line, {strip('u.x')} as s from documents, unnest(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10))) with ordinality as u(x, i)),
f as (select *, sum(case when starts_with(s, '```') then 1 else 0 end) over (partition by doc_id order by pos) as fences from l),
k as (select doc_id, pos, line, s, {opens} as opens, case when {is_code} then 'code' when s = '' or regexp_matches(s, '^((-{WS}*){{3,}}|(\\*{WS}*){{3,}}|(_{WS}*){{3,}})$') then 'blank'
        when regexp_matches(s, '^#{{1,6}}{WS}+.+$') then 'heading' when starts_with(s, '|') and ends_with(s, '|') then 'pipe'
        when starts_with(s, '>') then 'quote' when regexp_matches(s, '{item}') then 'item' else 'text' end as kind0 from f),
r as (select *, lag(kind0) over w as pk, lag(pos) over w as pp, lead(kind0) over w as nk, lead(pos) over w as np from k where kind0 <> 'blank' window w as (partition by doc_id order by pos)),
t as (select doc_id, pos, line, s, opens, coalesce(pp, -2) < pos - 1 as gap, regexp_matches(line, '^( {{2}}|\\t)') as ind,
        case when kind0 <> 'pipe' then kind0 when (pk = 'pipe' and pp = pos - 1) or (nk = 'pipe' and np = pos + 1) then 'table' else 'single' end as kind from r),
m as (select *, case when kind <> 'text' or (gap and not ind) then kind end as holds, case when kind = 'item' and not ind then right(regexp_extract(s, '^([-*+]|[0-9]+[.)])'), 1) end as mark from t),
u as (select *, coalesce(last_value(holds ignore nulls) over b, '') as under, last_value(mark ignore nulls) over b as last_mark, coalesce(lag(kind) over (partition by doc_id order by pos), '') as prev
      from m window b as (partition by doc_id order by pos rows between unbounded preceding and 1 preceding)),
n as (select *, case when kind in ('heading', 'single') then true when kind = 'code' then opens when kind = 'table' then prev <> 'table' or gap when kind = 'quote' then under <> 'quote' or gap
        when kind = 'item' then under <> 'item' or coalesce(mark <> last_mark, false) else (gap and not (under = 'item' and ind)) or prev in ('', 'heading', 'code', 'table') end as begins,
        case when kind = 'heading' then length(regexp_extract(s, '^(#{{1,6}})', 1)) end as level,
        case when kind = 'heading' then {flat(strip(f"regexp_extract(s, '^#{{1,6}}{WS}+(.+)$', 1)"))} end as name from u),
b as (select *, sum(begins::int) over w as block, {per_level} from n window w as (partition by doc_id order by pos rows unbounded preceding)),
p as (select *, list_filter([{valid}], lambda x: x is not null) as path from b),
a as (select doc_id, block, case arg_min(kind, pos) when 'single' then 'text' else arg_min(kind, pos) end as kind, min(pos) as line_start, max(pos) as line_end,
        list({{'s': s, 'line': line, 'item': kind = 'item', 'top': kind = 'item' and (begins or not ind)}} order by pos) as ls, coalesce(arg_min(coalesce(level, 0), pos), 0) as heading_level,
        arg_min(path, pos) as path from p group by doc_id, block),
h as (select *, kind = 'table' and len(ls) > 1 and coalesce(regexp_matches(ls[2].s, '{separator}'), false) as ruled,
        case when kind <> 'table' then [] when len(ls) > 1 and regexp_matches(ls[2].s, '{separator}') then {cells('ls[1].s')} else list_filter({cells('ls[1].s')}, lambda c: c <> '') end as headers from a),
x as (select *, case when kind = 'heading' then repeat('#', heading_level::int) || ' ' || path[-1] when kind = 'code' then array_to_string(list_transform(ls, lambda r: r.line), chr(10))
        when ruled then {table} when kind = 'table' then array_to_string(list_transform(ls, lambda r: r.s), chr(10))
        when kind = 'item' then {flat(f'substr({listed}, 2)')} when kind = 'quote' then {flat(quoted)} else {flat("array_to_string(list_transform(ls, lambda r: r.s), ' ')")} end as text from h),
sec as (select doc_id, row_number() over (partition by doc_id order by block) - 1 as seq, text, heading_level, coalesce(path[-1], '') as heading_text, path,
        case kind when 'heading' then 'header' when 'item' then 'list' when 'quote' then 'blockquote' when 'text' then 'paragraph' else kind end as element_type, line_start, line_end, headers,
        case when kind = 'table' then len(list_filter(ls[3:], lambda r: not regexp_matches(r.s, '{separator}'))) else 0 end as row_count from x where {strip('text')} <> '')"""


def packed(size: int) -> str:
    """``grp``: sections with the seq of the first section of their group, by a recursive fold over each document."""
    return f"""
fold as (select doc_id, seq, seq as first, length(text) as run, length(text) > {size} and element_type <> 'header' as big from sec where seq = 0
    union all select s.doc_id, s.seq,
        case when s.element_type = 'header' or length(s.text) > {size} or f.big or f.run + length(s.text) > {size} then s.seq else f.first end,
        case when s.element_type = 'header' or length(s.text) > {size} or f.big or f.run + length(s.text) > {size} then length(s.text) else f.run + length(s.text) end,
        length(s.text) > {size} and s.element_type <> 'header'
    from fold f join sec s on s.doc_id = f.doc_id and s.seq = f.seq + 1),
grp as (select sec.*, fold.first as grp from sec join fold using (doc_id, seq))"""


def sentence_fold(source: str, key: str, x: str, size: int, overlap: int) -> str:
    """``pieces(key, piece, txt)`` of ``source(key, x)`` by a recursive fold over sentences."""
    return f"""
sent as (select {key}, u.i, u.s from {source}, unnest(string_split(regexp_replace({x}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1))) with ordinality as u(s, i)),
sf as (select {key}, 1 as i, cast('' as varchar) as done, s as cur, false as out from sent where i = 1
    union all select n.{key}, n.i,
        case when length(f.cur) + length(n.s) > {size} and f.cur <> '' then {strip('f.cur')} else '' end,
        case when length(f.cur) + length(n.s) > {size} and f.cur <> '' then case when length(f.cur) > {overlap} then substr(f.cur, length(f.cur) - {overlap - 1}) else '' end || ' ' || n.s
             when f.cur <> '' then f.cur || ' ' || n.s else n.s end,
        length(f.cur) + length(n.s) > {size} and f.cur <> ''
    from sf f join sent n on n.{key} = f.{key} and n.i = f.i + 1),
ends as (select {key}, i, done as txt from sf where out
    union all select {key}, i + 1, {strip('cur')} from (select *, row_number() over (partition by {key} order by i desc) as rn from sf) where rn = 1 and {strip('cur')} <> ''),
pieces as (select {key}, row_number() over (partition by {key} order by i) - 1 as piece, txt from ends)"""


ID = "substr(md5(source_file || ':' || chunk_index || ':' || substr(chunk_text, 1, 100)), 1, 16)"


def chunked(size: int) -> str:
    return f"""with recursive {sections(True)}, {packed(size)},
gg as (select doc_id, grp, string_agg(text, chr(10) || chr(10) order by seq) as body, list(element_type order by seq) as types, count(*) as n,
        arg_min(heading_level, seq) as heading_level, arg_min(heading_text, seq) as heading_text, arg_min(path, seq) as path,
        arg_min(case when element_type = 'table' and len(headers) > 0 then headers end, case when element_type = 'table' and len(headers) > 0 then seq end) as headers,
        arg_min(case when element_type = 'table' and len(headers) > 0 then row_count end, case when element_type = 'table' and len(headers) > 0 then seq end) as row_count
      from grp group by doc_id, grp),
ty as (select doc_id, grp, arg_max(t, (n, -first)) as chunk_type from (
        select doc_id, grp, element_type as t, count(*) as n, min(seq) as first from grp group by doc_id, grp, element_type) group by doc_id, grp),
gt as (select gg.*, chunk_type, n = 1 and length(body) > {size} and chunk_type not in ('table', 'code', 'list') as split, row_number() over (order by gg.doc_id, gg.grp) as gid from gg join ty using (doc_id, grp)),
long as (select gid, body from gt where split),
{sentence_fold('long', 'gid', 'body', size, 100)},
parts as (select gt.*, coalesce(piece, 0) as piece, coalesce(txt, body) as chunk_text from gt left join pieces using (gid)),
ck as (select d.doc_id, d.source_file, row_number() over (partition by d.doc_id order by p.grp, p.piece) - 1 as chunk_index, coalesce(p.chunk_text, d.text, '') as chunk_text,
        coalesce(chunk_type, 'document') as chunk_type, coalesce(heading_level, 0) as heading_level, coalesce(heading_text, '') as heading_text,
        case when not coalesce(split, true) and len(path) >= 2 then path[-2] else '' end as parent_heading, coalesce(array_to_string(path, ' > '), '') as section_path,
        case when coalesce(split, true) then '' else coalesce(array_to_string(headers, '|'), '') end as table_headers,
        case when coalesce(split, true) then 0 else coalesce(row_count, 0) end as table_row_count
      from documents d left join parts p using (doc_id))"""


def latest(table: str, key: str, *order: str) -> str:
    return f"(select * from (select *, row_number() over (partition by {key} order by {', '.join(f'{o} desc nulls last' for o in order)}) as rn from {table}) where rn = 1)"


ROWS = latest("chunks", "chunk_id", "updated_at", "version", "chunk_index")
ENRICHED = """select doc_id, case when lower(coalesce(source_format, 'markdown')) in ('pptx', 'ppt') then 'slides' else 'document' end as strategy,
    case when doc_id % 5 = 0 and doc_id % 2 = 0 then 'skipped' when doc_id % 7 <> 0 then 'enriched' else 'copied (LLM failed)' end as status from documents"""


def page_markdown() -> str:
    """What the pages say, put together from the documents and not from the pages."""
    paragraphs = "array_to_string(list_filter(list_transform(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)), lambda l: regexp_replace(l, '[ \\t]+$', '')), lambda l: l <> ''), chr(10) || chr(10))"
    parts = f"[{strip("coalesce(source, '-')")}, '# ' || {strip("coalesce(title, '-')")}, {paragraphs}, '| field | value |' || chr(10) || '| --- | --- |' || chr(10) || '| lang | ' || coalesce(lang, '-') || ' |' || chr(10) || '| only |  |', '```' || chr(10) || 'x = ' || doc_id || chr(10) || '  y < 2' || chr(10) || '```']"
    return f"case when text is not null then array_to_string(list_filter({parts}, lambda x: x <> ''), chr(10) || chr(10)) end"


def hashed(source: str, dim: int = 256) -> str:
    """(chunk_id, filled, weight) of the hashed word vectors of ``source(chunk_id, chunk_text)``."""
    return f"""with w as (select chunk_id, md5(u.w) as h from {source}, unnest(regexp_extract_all(lower(chunk_text), '{WORD}+')) as u(w)),
        p as (select chunk_id, ('0x' || substr(h, 1, 8))::bigint % {dim} as at, sum(case when substr(h, 9, 1) >= '8' then 1 else -1 end) as v from w group by 1, 2),
        n as (select chunk_id, sqrt(sum(v * v)) as norm from p group by 1)
        select c.chunk_id, cast(count(*) filter (v <> 0) as int) as filled, round(coalesce(sum(abs(cast(v / norm as float)::double)) filter (v <> 0), 0), 4) as weight
        from {source} c left join p using (chunk_id) left join n using (chunk_id) group by 1"""


def path_text(x: str) -> str:
    return f"case when len({x}) > 0 then array_to_string({x}, ' > ') else 'N/A' end"


def json_words(xs: str) -> str:
    return f"'[' || array_to_string(list_transform({xs}, lambda w: to_json(w)::varchar), ', ') || ']'"


def versions() -> str:
    return f"""old as (select chunk_id, content_hash, chunk_index, version, created_at from {ROWS}),
new as (select chunk_id, case when k % 10 = 0 then 'edited-' || content_hash else content_hash end as content_hash, chunk_index
        from (select *, cast(('0x' || substr(chunk_id, 1, 4)) as bigint) as k from old) where k % 17 <> 0),
h as (select content_hash, arg_min(version, (chunk_index, chunk_id)) as hv, arg_min(created_at, (chunk_index, chunk_id)) as hc from old group by content_hash),
m as (select n.*, case when hv is not null then 'unchanged' when o.version is not null then 'updated' else 'added' end as status,
        cast(coalesce(hv, o.version + 1, 1) as int) as version, coalesce(hc, o.created_at, '{NOW}') as created_at, '{NOW}' as updated_at
      from new n left join h using (content_hash) left join old o on o.chunk_id = n.chunk_id)"""


def knn(metric: str, k: int) -> str:
    v = "e.embedding::double[]"
    q = "q.embedding::double[]"
    dist = f"sqrt(greatest(list_inner_product({v}, {v}) + list_inner_product({q}, {q}) - 2 * list_inner_product({q}, {v}), 0))" if metric == "l2" else f"1 - list_inner_product({q}, {v}) / (sqrt(list_inner_product({q}, {q})) * sqrt(list_inner_product({v}, {v})))"
    return f"""select query_id, cast(rn as int) as rank, id, distance, round(1 - distance, 6) as similarity from (
        select *, row_number() over (partition by query_id order by distance, id) as rn from (
            select q.vec_id as query_id, e.vec_id as id, round({dist}, 6) as distance from embeddings q, embeddings e where q.vec_id % 100 = 0)) where rn <= {k}"""


PREFIX = "---\ntitle: x\n---\n\n"
FRONTED = f"(select doc_id, case when doc_id % 3 = 0 then text else {text(PREFIX)} || text end as t from documents)"
BODY = f"coalesce({strip(front('t'))}, t)"

ORACLES: dict[str, str] = {
    "meta_title": f"select doc_id, {title('text')} as title from documents",
    "meta_keywords": f"select doc_id, array_to_string({keywords('text')}, '|') as keywords from documents",
    "meta_language": f"select doc_id, {language('text')} as language from documents",
    "meta_content_type": f"select doc_id, {content_type('text')} as content_type from documents",
    "meta_domain": f"with d as (select doc_id, text as t, {keywords('text')} as kws from documents) {domains('d')}",
    "meta_summary": f"select doc_id, {summary('text')} as summary from documents",
    "meta_without_front_matter": f"select doc_id, {BODY} as body from {FRONTED}",
    "meta_front_matter": f"""with s as (select doc_id, source_file, source_format, text as t from documents), b as (select doc_id, source_file, source_format, {BODY} as t from s),
        d as (select *, {keywords('t')} as kws from b), m as ({domains('d')})
        select doc_id, {title('t')} as title, domain, sub_domain, array_to_string(kws, '|') as keywords, {summary('t')} as summary, {language('t')} as language,
        {content_type('t')} as content_type, source_file, source_format from d join m using (doc_id)""",
    "meta_format_histogram": "select coalesce(source_format, '') as source_format, count(*) as n from documents group by 1",
    "reflow_lines": REFLOW,
    "md_sections": f"with {sections(True)} select doc_id, seq, text, heading_level, heading_text, array_to_string(path, ' > ') as section_path, element_type, line_start, line_end, array_to_string(headers, '|') as table_headers, row_count as table_row_count from sec",
    "md_sections_without_code": f"with {sections(False)} select element_type, count(*) as n, sum(length(text)) as chars, sum(row_count) as table_rows from sec group by 1",
    "md_rendered_tables": """with p as (select c_nationkey, c_mktsegment, count(o_orderkey) as n from customer left join orders on o_custkey = c_custkey group by 1, 2)
        select c_nationkey, '| segment | orders |' || chr(10) || '| --- | --- |' || string_agg(chr(10) || '| ' || c_mktsegment || ' | ' || n || ' |', '' order by c_mktsegment) as markdown from p group by 1""",
    "c3_sentence_split": f"""with recursive d as (select doc_id, text from documents where text is not null), {sentence_fold('d', 'doc_id', 'text', 500, 100)},
        c as (select doc_id, source_file, piece as chunk_index, txt as chunk_text from pieces join documents using (doc_id))
        select *, {ID} as chunk_id, sha256(chunk_text) as content_hash from c""",
    "c1_pack": f"with recursive {sections(True)}, {packed(600)} select doc_id, grp as \"group\", count(*) as blocks, sum(length(text)) as chars, min(seq) as first_seq from grp group by 1, 2",
    "c4_chunks": f"{chunked(600)} select *, {ID} as chunk_id, sha256(chunk_text) as content_hash from ck",
    "c8_type_counts": f"{chunked(2000)} select chunk_type, count(*) as n, sum(length(chunk_text)) as chars from ck group by 1",
    "c8_records": f"""{chunked(2000)}, s0 as (select doc_id, text as t from documents), d0 as (select *, {keywords('t')} as kws from s0), m0 as ({domains('d0')}),
        l0 as (select doc_id, {language('t')} as language, {content_type('t')} as content_type from s0)
        select {ID} as chunk_id, sha256(chunk_text) as content_hash, source_file, cast(chunk_index as int) as chunk_index, chunk_text, chunk_type, cast(heading_level as int) as heading_level, heading_text, parent_heading,
        section_path, table_headers, cast(table_row_count as int) as table_row_count, coalesce(domain, '') as domain, coalesce(sub_domain, '') as sub_domain, {json_words('coalesce(kws, [])')} as keywords, language,
        coalesce(content_type, '') as content_type, 1 as version, '{NOW}' as created_at, '{NOW}' as updated_at from ck join m0 using (doc_id) join l0 using (doc_id) join d0 using (doc_id)""",
    "i7_run": f"""{chunked(2000)}, e as (select doc_id from documents where doc_id % 10 = 0 and text <> '')
        select (select count(*) from documents)::int as files, (select count(*) from e)::int as changed, 0 as failed, (select count(*) from e) as added, 0::bigint as updated, 0::bigint as unchanged,
        (select count(*) from ck where doc_id in (select doc_id from e)) as deleted""",
    "i1_ids_and_hashes": f"select distinct chunk_id, chunk_index, {ID} as new_id, sha256(chunk_text) as new_hash from chunks",
    "i3_source_hash": "select doc_id, substr(sha256(coalesce(text, '') || chr(1) || coalesce(title, '') || chr(1) || coalesce(source_file, '')), 1, 32) as source_hash from documents",
    "i4_changed_files": f"""with f as (select source_file, substr(sha256(string_agg(distinct content_hash, '' order by content_hash)), 1, 32) as source_hash from {ROWS} group by 1),
        m as (select source_file, source_hash as old_hash from (select *, row_number() over (partition by source_file order by version desc nulls last, updated_at desc nulls last, source_hash desc nulls last) as rn from manifest where source_hash is not null) where rn = 1)
        select source_file, source_hash, old_hash, old_hash is null or source_hash is distinct from old_hash as changed from f left join m using (source_file)""",
    "i6_next_manifest": f"""select source_file, cast(max(version) + 1 as int) as version, max(source_hash) as source_hash, coalesce(min(created_at), '{NOW}') as created_at, '{NOW}' as updated_at,
        '2.0' as schema_version, 'structure_based' as chunking_method from manifest group by source_file""",
    "i5_merge": f"with {versions()} select * from m",
    "i5_merge_stats": f"""with {versions()} select count(*) filter (status = 'added') as added, count(*) filter (status = 'updated') as updated, count(*) filter (status = 'unchanged') as unchanged,
        (select count(*) from old where chunk_id not in (select chunk_id from new)) as deleted from m""",
    "j1_chunks_with_vectors": f"select c.chunk_id, c.source_file, c.chunk_type, v.dim from {ROWS} c join (select distinct chunk_id, cast(len(embedding) as int) as dim from chunk_vectors where embedding is not null) v using (chunk_id)",
    "j2_missing_vectors": f"select chunk_id, source_file from {ROWS} where chunk_id not in (select chunk_id from chunk_vectors where chunk_id is not null)",
    "j3_embedded": f"select chunk_id, source_file from {ROWS} where chunk_id in (select chunk_id from chunk_vectors)",
    "k1_output_paths": "select doc_id, regexp_replace(source_file, '\\.[^./]+$', '') || '.md' as path from documents",
    "k4_upsert": "select chunk_id, content_hash, updated_at, version from (select *, row_number() over (partition by chunk_id order by updated_at desc nulls last, version desc nulls last) as rn from chunks) where rn = 1",
    "k6_export": f"""select c.chunk_id, c.source_file, cast(case when v.chunk_id is null then 96 else len(v.embedding) end as int) as dim,
        round(coalesce(list_sum(list_transform(v.embedding, lambda x: abs(x::double))), 0.0), 4) as weight
        from {ROWS} c left join (select chunk_id, any_value(embedding) as embedding from chunk_vectors where embedding is not null group by 1) v using (chunk_id)""",
    "k8_listing": f"select chunk_id, '**' || chunk_id || '** (' || source_file || ')' || chr(10) || case when length(chunk_text) > 200 then substr(chunk_text, 1, 200) || '...' else chunk_text end as listing from {ROWS} where chunk_text is not null",
    "t5_enrichment_status": ENRICHED,
    "t6_enrichment_counts": f"select status, count(*) as n from ({ENRICHED}) group by 1",
    "v1_embed_inputs": f"""select chunk_id, md5(case when contains(lower(model_name), 'e5') then 'passage: ' || chunk_text else chunk_text end) as own, md5('passage: ' || chunk_text) as passage, md5('query: ' || chunk_text) as "query"
        from {ROWS}, (select model_name from model_info limit 1)""",
    "v1_embeddings": hashed(ROWS),
    "v2_model_dimensions": """select v.dim, v.n, model_name, cast(coalesce(k.dim, {}) as int) as expected from (select cast(len(embedding) as int) as dim, count(*) as n from chunk_vectors where embedding is not null group by 1) v,
        (select model_name from model_info union all select unnest({})) m left join (values {}) as k(model_name, dim) using (model_name)""".format(
        DEFAULT_DIMENSION, listed(list(MODEL_DIMENSIONS)), ", ".join(f"({text(k)}, {v})" for k, v in MODEL_DIMENSIONS.items())
    ),
    "v3_compatibility": f"""select i as "case", not exists (select 1 from chunk_vectors where len(embedding) <> want) and model_name = asked and embedding_dim = want as compatible, model_name,
        coalesce((select arg_max(dim, (n, dim)) from (select cast(len(embedding) as int) as dim, count(*) as n from chunk_vectors where embedding is not null group by 1) where dim <> want), embedding_dim) as embedding_dim
        from model_info, (values (0, 'lumen-text-96', 96), (1, 'other', 96), (2, 'lumen-text-96', {DEFAULT_DIMENSION})) as a(i, asked, want) where id = 1""",
    "v4_build": f"""with a as (select distinct chunk_id from chunks where chunk_index % 3 <> 0)
        select count(*) as total_chunks, count(*) filter (chunk_id not in (from a)) as new_chunks, count(*) filter (chunk_id in (from a)) as skipped_chunks from {ROWS}""",
    "k5_vectors": f"""with f as (select chunk_id, source_file from {latest('(select * from chunks where chunk_index % 3 <> 0)', 'chunk_id', 'updated_at', 'version', 'chunk_index')})
        select r.chunk_id, 256 as dim, coalesce(f.source_file, r.source_file) as source_file, '{NOW}' as embedded_at from {ROWS} r left join f using (chunk_id)""",
    "v4_build_stats": f"""select count(*) as total_chunks, count(*) filter (chunk_id not in (select chunk_id from chunk_vectors)) as new_chunks,
        count(*) filter (chunk_id in (select chunk_id from chunk_vectors)) as skipped_chunks from {ROWS}""",
    "v5_search": knn("l2", 5),
    "v5_search_cosine": knn("cosine", 5),
    "v5_search_filtered": f"""select query_id, cast(place as int) as place, id, distance, label from (select h.query_id, h.id, h.distance, e.label, row_number() over (partition by h.query_id order by h.rank) as place
        from ({knn('l2', 10)}) h join embeddings e on e.vec_id = h.id where e.label = 0) where place <= 5""",
    "v6_get_chunk": f"""select chunk_id, content_hash, source_file, chunk_index, chunk_text, chunk_type, heading_level, heading_text, parent_heading, array_to_string(section_path, ' > ') as section_path,
        array_to_string(table_headers, '|') as table_headers, table_row_count, domain, sub_domain, keywords, language, content_type from {ROWS}
        where chunk_id in (select arg_min(chunk_id, (chunk_index, chunk_id)) from {ROWS} group by source_file)""",
    "v6_get_chunk_sql": f"select chunk_id, source_file, chunk_index, chunk_text, keywords from {ROWS} where chunk_id = (select min(chunk_id) from chunks)",
    "k8_search_results": f"""select query_id, rank, '## [' || rank || '] ' || chr(10) || '- **File**: ' || source_file || chr(10) || '- **Section**: ' || array_to_string(string_split(coalesce(title, ''), ' '), ' > ') || chr(10)
        || '- **Type**: ' || coalesce(content_type, '') || chr(10) || '- **ID**: ' || id || chr(10) || chr(10) || '```' || chr(10) || substr(coalesce(text, ''), 1, 500) || case when length(text) > 500 then '...' else '' end
        || chr(10) || '```' || chr(10) as markdown from ({knn('l2', 5)}) join documents on doc_id = id""",
    "k8_chunk_texts": f"""select chunk_id, md5('# Chunk: ' || chunk_id || chr(10) || chr(10) || '- **File**: ' || source_file || chr(10) || '- **Section**: ' || {path_text('section_path')} || chr(10) || '- **Type**: ' || chunk_type || chr(10)
        || '- **Domain**: ' || coalesce(domain, '') || chr(10) || '- **Language**: ' || coalesce(language, '') || chr(10) || chr(10) || '## Content' || chr(10) || chr(10) || '```' || chr(10) || chunk_text || chr(10) || '```') as text_md5
        from {ROWS} where chunk_text is not null""",
    "k8_document_list": f"""select '| ' || source_file || ' | ' || count(*) || ' | ' || arg_min(coalesce(domain, ''), (chunk_index, chunk_id)) || ' | ' || arg_min(coalesce(language, ''), (chunk_index, chunk_id)) || ' |' as line
        from {ROWS} group by source_file""",
    "k8_statistics_text": f"""select '# Vector DB Statistics' || chr(10) || chr(10) || '- **Total Chunks**: ' || (select count(*) from {ROWS}) || chr(10) || '- **Total Documents**: ' || (select count(distinct source_file) from {ROWS}) || chr(10)
        || '- **Embedding Model**: lumen-text-96' || chr(10) || '- **Embedding Dimension**: 96' || chr(10) || chr(10) || '## Distribution by Domain' || chr(10)
        || (select string_agg('  - ' || name || ': ' || n, chr(10) order by n desc, name) from (select coalesce(domain, '') as name, count(*) as n from {ROWS} group by 1)) || chr(10) || chr(10)
        || '## Distribution by Chunk Type' || chr(10) || (select string_agg('  - ' || name || ': ' || n, chr(10) order by n desc, name) from (select coalesce(chunk_type, '') as name, count(*) as n from {ROWS} group by 1)) as text""",
    "v7_list_documents": f"select source_file, count(*) as chunk_count, arg_min(coalesce(domain, ''), (chunk_index, chunk_id)) as domain, arg_min(coalesce(language, ''), (chunk_index, chunk_id)) as language from {ROWS} group by 1",
    "v8_statistics": f"""select (select count(*) from {ROWS}) as total_chunks, (select count(distinct source_file) from {ROWS}) as total_documents,
        (select string_agg(name || '=' || n, ';' order by n desc, name) from (select coalesce(domain, '') as name, count(*) as n from {ROWS} group by 1)) as domains,
        (select string_agg(name || '=' || n, ';' order by n desc, name) from (select coalesce(chunk_type, '') as name, count(*) as n from {ROWS} group by 1)) as chunk_types""",
    "a3_counts_by_domain": f"select coalesce(domain, '') as domain, count(*) as n, count(distinct source_file) as files from {ROWS} group by 1",
    "a6_top_subdomain": f"select domain, n, sub_domain from (select domain, sub_domain, count(*) as n, row_number() over (partition by domain order by count(*) desc, sub_domain) as rn from {ROWS} where domain <> '' and sub_domain <> '' group by 1, 2) where rn = 1",
    "s7_html_to_markdown": f"select doc_id, md5({page_markdown()}) as markdown_md5 from documents",
    "s7_csv_to_markdown": """select c_custkey // 50 as part, '| key | name |' || chr(10) || '| --- | --- |' || string_agg(chr(10) || '| ' || c_custkey || ' | ' || c_name || ', "' || c_mktsegment || '" |', '' order by c_custkey) as markdown,
        null::varchar as error from customer group by 1""",
    "s7_json_to_markdown": """select event_id, '| key | value |' || chr(10) || '| --- | --- |' || coalesce(list_reduce(list_transform(json_keys(props), lambda k: chr(10) || '| ' || k || ' | ' || json_extract_string(props, '$.' || k) || ' |'), lambda a, b: a || b), '') as markdown,
        null::varchar as error from events""",
    "u3_union": f"""select source_format, count(*) as n, count(content) as with_content, sum(length(content)) as chars from (
        select 'markdown' as source_format, text as content from documents where doc_id % 2 = 0 union all select 'html', {page_markdown()} from documents where doc_id % 2 = 1) group by 1""",
    "k2_front_matter": """select doc_id, md5('---' || chr(10) || 'title: ' || to_json(coalesce(title, ''))::varchar || chr(10) || 'domain: ' || to_json(coalesce(lang, ''))::varchar || chr(10) || 'keywords:'
        || case when coalesce(source, '') = '' then ' []' else array_to_string(list_transform(list_filter(string_split(source, '-'), lambda x: x <> ''), lambda x: chr(10) || '- ' || to_json(x)::varchar), '') end || chr(10)
        || 'source_file: ' || to_json(source_file)::varchar || chr(10) || '---' || chr(10) || chr(10) || coalesce(text, '')) as file_md5 from documents""",
    "t2_enrich": """select doc_id, strategy, coalesce(e <> text, false) as changed, md5(e) as text_md5 from (select *, case when strategy = 'slides' or coalesce(text, '') = '' then text
        else replace(substr(text, 1, 48000), 'e', 'E') || case when length(text) > 48000 then chr(10) || chr(10) || substr(text, 48001) else '' end end as e
        from (select doc_id, text, case when lower(coalesce(source_format, 'markdown')) in ('pptx', 'ppt') then 'slides' else 'document' end as strategy from documents))""",
    "s11_front_matter": f"select doc_id, case when text is not null then source_file end as title, case when text is not null then cast(doc_id as varchar) end as id, case when text is not null then 'a|b, c|x|y' end as tags, md5({strip('text')}) as body_md5 from documents",
    "s15_orders_by_segment": "select n_name, c_mktsegment, count(*) as orders, round(sum(o_totalprice), 2) as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2",
    "x_event_windows": "select time_bucket(interval 5 minutes, ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2",
}
