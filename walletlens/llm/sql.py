"""SQL of those queries that SQL can express, with all constants written out.

The others (a classifier, a latent space, suffix sorting, extraction, a tokenizer, spans of
automata) have none and are held against brute force in tests/llm.
"""

_WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
with texts as (select row_number() over () as r, doc_id, coalesce(text, '') as x from documents),
facts as (
  select r, doc_id, x, regexp_extract_all(x, '{_WORD}') as ws,
    [l for l in string_split(x, chr(10)) if regexp_matches(l, '{_WORD}')] as lines,
    length(regexp_replace(x, '[^A-Z]', '', 'g')) as upper_letters,
    length(regexp_replace(x, '[^A-Za-z]', '', 'g')) as letters
  from texts),
windows as (
  select r, i, array_to_string(ws[i : i + 7], ' ') as k
  from (select r, ws, unnest(range(1, greatest(len(ws) - 6, 1))) as i from facts)),
repeated as (select r, i from (select r, i, count(*) over (partition by r, k) as n from windows) where n > 1),
covered as (
  select r, count(distinct i + j) as n from repeated, (select unnest(range(0, 8)) as j) group by r),
counted as (
  select doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
    len(lines) as n_lines, upper_letters, letters
  from facts left join covered c using (r)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not (base_failed or 2 * n_symbols > n_words or 100 * n_dup_lines > 30 * n_lines
    or word_chars < 2 * n_words or word_chars > 25 * n_words or 100 * upper_letters > 60 * letters) as kept
from judged
"""

_CONTROL = r"</?s>|\[/?INST\]|\[ROLE:[0-9A-F]*\]|\[/ROLE\]"
_CONTROL_TAIL = r"(<)(/?s>)|(\[)(/?INST\]|ROLE:[0-9A-F]*\]|/ROLE\])"

OP3 = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
bodies as (
  select *, case when regexp_matches(text, '{_CONTROL}') or contains(text, '\')
    then regexp_replace(replace(text, '\', '\\'), '{_CONTROL_TAIL}', '\1\3\\\2\4', 'g') else text end as body,
    case role when 'user' then 6 when 'assistant' then 3 else 7 + length(hex(role)) end
    + case role when 'user' then 7 when 'assistant' then 4 else 7 end as marks
  from turns),
joined as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as told,
    coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as loss,
    sum(length(body) + marks) as formatted_chars
  from bodies group by conv_id)
select conv_id, n_turns, sha256(told) as turns_sha256, length(loss)::bigint as loss_chars,
  sha256(loss) as loss_sha256, formatted_chars::bigint as formatted_chars
from joined
"""

_PLACE = "('0x' || substr(md5({0}), 1, 15))::bigint"

OP5 = rf"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size,
    {_PLACE.format("'7|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))")} as place
  from documents),
sources as (
  select source, source_size, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight
  from (select source, sum(size)::bigint as source_size from sized group by source)),
levels as (
  select *, 3.0::double * source_size as cap, sum(source_size) over () as total,
    3.0::double * source_size / weight as ratio,
    row_number() over (order by 3.0::double * source_size / weight, source nulls last) as k
  from sources),
unit as (
  select greatest(1, least(64, min(source_size) // 200)) as words from sources where source_size > 0),
level as (
  select *, (total - coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by k rows between current row and unbounded following) as level
  from levels),
targets as (
  select source, source_size, total,
    case when ratio > (select arg_min(level, k) from level where ratio >= level)
      then (select arg_min(level, k) from level where ratio >= level) * weight else cap end as target
  from level),
parties as (
  select *, target / (select words from unit) as share, round(total / (select words from unit))::bigint as seats, 3 * ceil(source_size / (select words from unit))::bigint as most,
    least(greatest(0, floor(target / (select words from unit))::bigint - 2), 3 * ceil(source_size / (select words from unit))::bigint) as sure
  from targets),
quotients as (
  select source, seat, row_number() over (order by share / (2 * seat + 1) desc, source nulls first, seat) as place, seats - total_sure as rest
  from (select *, sum(sure) over () as total_sure, unnest(range(sure, sure + 6)) as seat from parties) where seat < most),
quotas as (
  select p.source, p.source_size, p.target, p.sure + coalesce(w.won, 0) as seats,
    greatest(1, ceil(p.source_size / 1000000))::bigint as shards
  from parties p left join (select source, count(*) as won from quotients where place <= rest group by source) w
    on p.source is not distinct from w.source),
placed as (
  select s.*, source_size, target, seats, place % shards as shard,
    sum(size) over (partition by s.source, place % shards order by place, doc_id rows unbounded preceding) as tail
  from sized s join quotas q on s.source is not distinct from q.source),
shards as (
  select source, shard, sum(size) as shard_size, any_value(seats) as seats, any_value(source_size) as whole
  from placed group by source, shard),
shard_parties as (
  select *, ceil(shard_size / (select words from unit))::bigint as blocks, seats * shard_size / greatest(whole, 1) as share from shards),
shard_sure as (
  select *, least(greatest(0, floor(share)::bigint - 2), 3 * blocks) as sure from shard_parties),
shard_quotients as (
  select source, shard, row_number() over (partition by source order by share / (2 * seat + 1) desc, shard, seat) as place, rest
  from (select *, seats - sum(sure) over (partition by source) as rest, unnest(range(sure, sure + 6)) as seat from shard_sure)
  where seat < 3 * blocks),
dealt as (
  select s.source, s.shard, greatest(s.blocks, 1) as n, s.sure + coalesce(w.won, 0) as quota,
    {_PLACE.format("'7|' || coalesce(s.source, '') || '|' || s.shard")} % greatest(s.blocks, 1) as start
  from shard_sure s left join (
    select source, shard, count(*) as won from shard_quotients where place <= rest group by source, shard) w
    on s.source is not distinct from w.source and s.shard = w.shard),
runs as (
  select *, floor(quota / n)::bigint as passes, start * (select words from unit) as run_from, (start + quota % n) * (select words from unit) as run_to, n * (select words from unit) as line
  from dealt)
select doc_id, size, source_size, target,
  (passes * size
   + greatest(0, least(run_to, tail) - greatest(run_from, tail - size))
   + greatest(0, least(run_to - line, tail) - (tail - size)))::bigint as taken
from placed p join runs r on p.source is not distinct from r.source and p.shard = r.shard
"""

OP7 = rf"""
with recursive texts as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as ws
  from documents),
shingles as (
  select distinct r, array_to_string(ws[i : i + 4], ' ') as s
  from (select r, ws, unnest(range(1, len(ws) - 3)) as i from texts where len(ws) >= 5)
  union all select r, array_to_string(ws, ' ') from texts where len(ws) between 1 and 4),
sizes as (select r, count(*) as n from shingles group by r),
pairs as (
  select a.r as a, b.r as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.r <> b.r group by 1, 2),
links as (
  select a, b from pairs join sizes x on a = x.r join sizes y on b = y.r where 100 * c >= 80 * (x.n + y.n - c)),
reach as (select r as a, r as b from texts union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select a, min(doc_id) as component_id from reach join texts on b = r group by a)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from texts left join sizes using (r) join least on a = r
"""

OP11 = rf"""
with turns as (
  select conv_id, turn, len(regexp_extract_all(x, '{_WORD}')) as w,
    substr(sha256(length(r)::varchar || ':' || r || x), 1, 32) as id
  from (select *, coalesce(role, '') as r, coalesce(text, '') as x from conversations where conv_id is not null)),
own as (
  select conv_id, list(id order by turn nulls first, id) as ids, list(w order by turn nulls first, id) as ws
  from turns group by conv_id),
sums as (
  select *, xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten([[ascii(d)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]
      for d in string_split(conv_id::varchar, '')])),
    lambda a, b: case when b >= 0 then xor(a, b) else xor(a >> 1, 3988292384 * (a & 1)) end)) % 4 as h
  from own),
rebuilt as (
  select o.conv_id, coalesce(g.ids[1 : h], []::varchar[]) || o.ids[h + 1 :] as ids,
    coalesce(g.ws[1 : h], []::bigint[]) || o.ws[h + 1 :] as ws
  from sums o left join own g on g.conv_id = o.conv_id - o.conv_id % 20),
steps as (select *, unnest(range(0, len(ids) + 1)) as depth from rebuilt),
nodes as (
  select array_to_string(ids[1 : depth], '') as key, depth, min(conv_id) as conv_id, count(*) as n_convs,
    coalesce(any_value(ws[depth]), 0) as w,
    coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(ids) = depth), '') as ends
  from steps group by all),
children as (
  select substr(key, 1, 32 * (depth - 1)) as key, count(*) as n from nodes where depth > 0 group by all),
known as (select nodes.*, coalesce(n, 0) as n_children from nodes left join children using (key)),
subtrees as (
  select substr(key, 1, 32 * k) as key, sum((n_children = 0)::int) as n_leaves, sum((n_convs - 1) * w) as saved
  from (select *, unnest(range(0, depth + 1)) as k from known) group by all)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, n_leaves::bigint as n_leaves,
  saved::bigint as saved_tokens, sha256(n.ends) as ends_sha256
from known n join subtrees s on s.key = n.key
left join known p on n.depth > 0 and p.key = substr(n.key, 1, 32 * (n.depth - 1))
"""

OP12 = r"""
with drawn as (
  select doc_id, coalesce(text, '') as x, sha256('7:' || coalesce(doc_id::varchar, '')) as digest from documents),
units as (
  select doc_id, x, regexp_extract_all(x, '[^\n]*\n|[^\n]+') as u,
    [('0x' || digest[8 * i + 1 : 8 * i + 8])::bigint for i in range(0, 4)] as h
  from drawn),
cuts as (
  select *, len(u) as n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) as a,
    greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) as b,
    case when x = '' or contains(x, '<P>') or contains(x, '<S>') or contains(x, '<M>') or h[3] % 100 >= 100 then 'plain'
      when h[4] % 100 < 50 then 'spm' else 'psm' end as form
  from units),
parts as (
  select *, array_to_string(u[1 : a], '') as p, array_to_string(u[a + 1 : b], '') as m,
    array_to_string(u[b + 1 :], '') as s
  from cuts)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then x when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(x) as restored_sha256
from parts
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op3_chat_format": OP3,
    "op5_mixing": OP5,
    "op7_jaccard_join": OP7,
    "op11_prefix_trie": OP11,
    "op12_fill_middle": OP12,
}
