"""DuckDB SQL of the queries that SQL can express, under the same keys.

The other queries (2, 3, 4, 6, 8 and 10, and the pipeline) are random, learned or
aligned; ``tests/llm`` holds
some of them against plain versions (the README says which).
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op5_chat_format"] = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), grouped as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as said,
    coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '') as learned,
    sum(length('<|im_start|>') + length(role) + length('<|sep|>') + length('<|im_end|>') + 1
        + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) as formatted_chars
  from rows group by conv_id
)
select conv_id, n_turns, sha256(said) as turns_sha256, length(learned) as loss_chars, sha256(learned) as loss_sha256,
  cast(formatted_chars as bigint) as formatted_chars
from grouped
"""

ORACLE["op9_url_filter"] = r"""
with split as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from split
), rules(rhost, rpath, verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits as (
  select distinct p.host, p.path, r.rhost || r.rpath as rule, r.verdict,
    row_number() over (partition by p.host, p.path order by length(r.rhost || r.rpath) desc) as k
  from (select distinct host, path from parts) p join rules r
    on (p.host = r.rhost or ends_with(p.host, '.' || r.rhost)) and starts_with(p.path, r.rpath)
)
select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from parts p left join fits f on f.host = p.host and f.path = p.path and f.k = 1
"""

ORACLE["op1_quality_rules"] = r"""
with texts as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), positions as (
  select doc_id, words, unnest(range(1, len(words) - 6)) as i from texts where len(words) >= 8
), windows as (
  select doc_id, i, array_to_string(words[i:i + 7], ' ') as w from positions
), marked as (
  select doc_id, i, count(*) over (partition by doc_id, w) as c from windows
), twice as (
  select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from marked where c >= 2
), covered as (
  select doc_id, sum(least(8, coalesce(nxt - i, 8))) as n from twice group by doc_id
), stats as (
  select t.doc_id, t.text, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(c.n, 0) as bigint) as n_repeat_words
  from texts t left join covered c on c.doc_id = t.doc_id
), judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from stats
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (10 * n_symbols > word_chars) and not (word_chars > 20 * n_words) and not (word_chars < 2 * n_words)
  and not (n_dup_lines > 0.5 * (1 + length(text) - length(replace(text, chr(10), ''))))
  and not (2 * length(regexp_replace(text, '[^\p{L}]+', '', 'g')) < word_chars)
  and not (2 * length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) > word_chars) as kept
from judged
"""

ORACLE["op7_jaccard_join"] = r"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as words
  from documents
), shingles as (
  select distinct doc_id, array_to_string(words[i:i + 4], ' ') as s
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) as i from texts where len(words) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2
), links as (
  select x, y from shared join sizes sx on sx.doc_id = x join sizes sy on sy.doc_id = y where 100 * c >= 75 * (sx.n + sy.n - c)
), reach as (
  select doc_id as node, doc_id as root from texts
  union select l.y, r.root from reach r join links l on l.x = r.node where r.root < l.y
)
select t.doc_id, coalesce(s.n, 0) as n_shingles, (select min(root) from reach where node = t.doc_id) as component_id
from texts t left join sizes s on s.doc_id = t.doc_id
"""

ORACLE["op13_divergence"] = r"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents
), words as (
  select row, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), kept as (
  select lang, term, count(*) as total from words group by lang, term having count(distinct row) >= 10
), counts as (
  select w.lang, w.source, w.term, count(*) as n from words w join kept k on k.lang = w.lang and k.term = w.term group by 1, 2, 3
), sizes as (
  select g.lang, g.source, coalesce(c.size, 0) as size from (select distinct lang, source from docs) g
  left join (select lang, source, sum(n) as size from counts group by 1, 2) c on c.lang = g.lang and c.source = g.source
), langs as (
  select s.lang, sum(s.size) as lang_size, coalesce(max(k.v), 0) as v from sizes s
  left join (select lang, count(*) as v from kept group by lang) k on k.lang = s.lang group by s.lang
), shares as (
  select s.lang, s.source, k.term, coalesce(c.n, 0) as n,
    1 + cast(1000000000 as hugeint) * (coalesce(c.n, 0) + 2) // (s.size + 2 * l.v) as p,
    1 + cast(1000000000 as hugeint) * (k.total + 2) // (l.lang_size + 2 * l.v) as q
  from sizes s join langs l on l.lang = s.lang join kept k on k.lang = s.lang
  left join counts c on c.lang = s.lang and c.source = s.source and c.term = k.term
), priced as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(p.value, 0) as bigint) as value
  from sizes a join sizes b on a.lang = b.lang and a.source <> b.source
  left join priced p on p.lang = a.lang and p.source = a.source and p.item = b.source
), found as (
  select * from pairs
  union all select lang, source, 'term', term, cast((p - q) * (p - q) // (p + q) as bigint) from shares where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found
)
select lang, source, part, item, value, cast(rank as int) as rank from ranked where part = 'pair' or rank <= 10
"""


def _centroid_sql(rounds: int = 5, k: int = 40) -> str:
    """Plain rounds: every vector against every centroid, means by component."""
    def nearest(name, centroids):
        gap = "list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i])))"
        return (f"{name} as (select row, vec_id, cluster, distance from (select *, row_number() over (partition by row order by distance, cluster) as best "
                f"from (select v.row, v.vec_id, c.cluster, cast({gap} as bigint) as distance from vecs v cross join {centroids} c) x) y where best = 1)")

    steps = ["""vecs as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and not isnan(x) and not isinf(x))) = 64
)""", f"""c0 as (
  select cast(row_number() over (order by draw, v) - 1 as int) as cluster, v from (
    select sha256('2:' || cast(vec_id as varchar)) as draw, v from vecs where vec_id is not null order by draw, v limit {k}) x
)"""]
    for r in range(rounds):
        steps.append(nearest(f"a{r}", f"c{r}"))
        steps.append(f"""m{r} as (
  select cluster, list(mean order by part) as v from (
    select a.cluster, p.part, cast(floor(sum(v.v[p.part]) / count(*)) as bigint) as mean
    from a{r} a join vecs v on v.row = a.row cross join (select unnest(range(1, 65)) as part) p group by 1, 2) x group by cluster
)""")
        steps.append(f"c{r + 1} as (select c.cluster, coalesce(m.v, c.v) as v from c{r} c left join m{r} m on m.cluster = c.cluster)")
    steps.append(nearest("last", f"c{rounds}"))
    return "with " + ",\n".join(steps) + f"""
select l.vec_id, l.cluster, l.distance, cast(sum(l.distance) over (partition by l.cluster) as bigint) as cluster_inertia,
  cast(sum(l.distance) over () as bigint) as inertia,
  sha256(array_to_string(list_transform(c.v, lambda x: cast(x as varchar)), ',')) as centroid_sha256
from last l join c{rounds} c on c.cluster = l.cluster
"""


ORACLE["op11_centroids"] = _centroid_sql()
