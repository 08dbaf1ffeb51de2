"""SQL texts that the registered queries of the core are checked by, written apart from the operators."""

from __future__ import annotations

from corpusloom.functions import rules


#: The organisation of the test tables, long and short form.
ORGANISATION = ("veldmark institute", "veldmark")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'), ' ')"


def normalized(source: str, columns: str, raw: str, name: str = "norm") -> str:
    """CTEs that end in `name`: `columns` of `source` with `raw` and its normalized form `norm`."""
    t = _strip(f"lower({raw})")
    t = f"regexp_replace({t}, '^(accessing|using|managing|configuring)\\s+', '')"
    t = f"regexp_replace({t}, '\\s+my\\s+', ' ', 'g')"
    t = _strip(f"regexp_replace({t}, '\\s*\\([^)]+\\)\\s*', ' ', 'g')")
    rest = "t"
    long, short = ORGANISATION[0].replace(" ", "\\s+"), ORGANISATION[1]
    for p, to in ((f"\\bat\\s+{long}\\b", ""), (f"\\b{long}\\b", ""), (f"\\bat\\s+{short}\\b", ""), (f"^{short}\\s+", ""), (f"\\s+{short}$", ""), (f"\\s+{short}\\s+", " "), (f"\\s+on\\s+{short}\\b", "")):
        rest = f"regexp_replace({rest}, '{p}', '{to}', 'g')"
    rest = f"regexp_replace({_strip(rest)}, ' ({'|'.join(rules.SUFFIXES)})$', '')"
    values = ", ".join(f"({_q(k)}, {_q(v)})" for k, v in rules.CONSOLIDATION.items())
    return f"""{name}_c(k, v) as (values {values}),
{name}_0 as (select {columns}, {raw} as raw, {t} as t from {source}),
{name}_1 as (select *, {rest} as rest from {name}_0 left join {name}_c on k = t),
{name} as (select {columns.replace('ae.', '')}, raw, case when raw is null or raw = '' then 'General' when v is not null then v
  else array_to_string([upper(w[1]) || w[2:] for w in string_split(rest, ' ')], ' ') end as norm from {name}_1)"""


def categories(source: str, column: str, name: str = "cat") -> str:
    """CTEs that end in `name`(topic, fallback) for the distinct values of `column`."""
    rows = ", ".join(f"({i}, {_q(c)}, {_q(k)})" for i, (c, ks) in enumerate(rules.CATEGORIES.items()) for k in ks)
    return f"""{name}_k(rank, category, keyword) as (values {rows}),
{name}_t as (select distinct {column} as topic, lower({column}) as low from {source}),
{name}_s as (select topic, rank, category, sum(case when low = keyword then 10 when list_contains(string_split(low, ' '), keyword) then 5 when contains(low, keyword) then 2 else 0 end) as score
  from {name}_t, {name}_k group by 1, 2, 3),
{name}_b as (select topic, category, score, row_number() over (partition by topic order by score desc, rank) as r from {name}_s),
{name} as (select topic, case when score >= 2 then array_to_string([upper(w[1]) || w[2:] for w in string_split(category, ' ')], ' ') else 'General' end as fallback from {name}_b where r = 1)"""


FILLED = "coalesce(content <> '', false)"
VALID = "coalesce(content <> '' and not starts_with(content, '[BROKEN ARTICLE:') and not starts_with(content, '[MINIMAL CONTENT:'), false)"


def kb_id(url: str) -> str:
    return f"coalesce(nullif(regexp_extract({url}, '(?i)sys_kb_id=([a-f0-9]+)', 1), ''), nullif(regexp_extract({url}, '(?i)sysparm_article=(KB[0-9]+)', 1), ''))"


def normal_url(url: str) -> str:
    return f"coalesce('sys_kb_id:' || {kb_id(url)}, split_part(regexp_replace({url}, '/+$', ''), '#', 1))"


TITLED = f"tr as (select *, {FILLED} as filled from articles where title is not null and title <> '' and title <> 'Pending')"
TITLE_FIRST = TITLED + ", tf as (select *, first_value(id) over (partition by title order by filled desc, updated_at desc nulls last, crawled_at desc nulls last, id desc) as canonical_id from tr)"
KEYED = f"kr as (select *, coalesce(nullif(sys_kb_id, ''), {kb_id('url')}) as key, {FILLED} as filled, coalesce(title <> 'Pending', false) as named from articles)"
KEY_FIRST = KEYED + ", kf as (select *, first_value(id) over (partition by key order by filled desc, named desc, id) as canonical_id from kr where key is not null)"
EDGES = """ed as (select distinct source_topic_id as s, target_topic_id as t, lower(trim(relationship_type, ' ')) as rel from topic_relationships
  where source_topic_id in (select id from topics) and target_topic_id in (select id from topics))"""
LINKED = """fl as (select distinct source_id, target_id from links), sa as (select distinct article_id, topic_id from topic_articles), fa as (select article_id, min(topic_id) as topic_id from topic_articles group by 1)"""
ASSIGNED = (
    normalized("article_enrichment", "id, article_id, intent, complexity, audience", "canonical_topic")
    + ", size_ as (select norm, count(distinct article_id) as n from norm group by 1), "
    + categories("size_", "norm")
    + """, rows_ as (select norm.*, n >= 2 as specific, fallback from norm join size_ using (norm) join cat on cat.topic = norm.norm),
names_ as (select distinct fallback as name from rows_ where fallback not in (select norm from rows_ where specific)),
first_ as (select fallback, min(id) as first from rows_ where not specific and norm not in (select name from names_) group by 1),
assigned as (select r.id, article_id, case when specific then r.norm else r.fallback end as topic, raw, specific, intent, complexity, audience from rows_ r left join first_ f on f.fallback = r.norm
  where specific or r.norm not in (select name from names_) or f.first is null or f.first > r.id)"""
)
TOPICS_BUILT = ASSIGNED + """, built0 as (select topic, max(specific) as own, min(id) as first, arg_min(raw, id) filter (where specific) as raw_name, count(distinct article_id) as total_articles from assigned group by 1),
built as (select cast(row_number() over (order by own desc, first) as integer) as topic_id, topic as normalized_name, coalesce(raw_name, topic) as name, total_articles from built0)"""
ADJACENT = EDGES + """, adj as (select id as topic_id, (select count(*) from ed where rel = 'subtopic_of' and t = id) as incoming, (select count(*) from ed where rel = 'subtopic_of' and s = id) as outgoing,
  (select count(*) from ed where rel = 'related_to' and s = id) as related, (select count(*) from ed where rel = 'prerequisite_of' and t = id) as prerequisites, (select count(*) from ed where rel = 'prerequisite_of' and s = id) as dependents from topics)"""
MIXED = """mx as (select id, list_sum(map_values(intent_distribution)) as total, list_max(map_values(intent_distribution)) as top, len(map_values(intent_distribution)) as n from topics)"""
ISSUES = ADJACENT + ", " + MIXED + """, iss as (select topic_id, 'orphan' as issue, 'medium' as severity from adj where incoming = 0 and outgoing = 0 and related = 0
  union all select id, 'overloaded', case when total_articles > 100 then 'high' else 'medium' end from topics where total_articles > 50
  union all select id, 'mixed_intent', 'low' from mx where n >= 2 and total >= 5 and top < 0.7 * total)"""
BUILT_WORDS = "tw as (select topic_id as id, lower(normalized_name) as name, list_distinct([w for w in string_split_regex(lower(normalized_name), '\\s+') if w <> '']) as words, total_articles from built)"
PLACED = "ta as (select distinct topic_id, article_id from assigned join built on normalized_name = topic)"
BUILT_LINKED = PLACED + ", fl as (select distinct source_id, target_id from links), sa as (select article_id, topic_id from ta), fa as (select article_id, min(topic_id) as topic_id from ta group by 1)"
WORDS = "tw as (select id, lower(normalized_name) as name, list_distinct([w for w in string_split_regex(lower(normalized_name), '\\s+') if w <> '']) as words, total_articles from topics)"
MATCHED = TOPICS_BUILT + """, ent as (select distinct category, name as entry, lower(name) as low from topic_catalog where category is not null),
match_ as (select category, entry, topic_id, total_articles, case when low = lower(normalized_name) then 1 else 2 end as kind from ent, built
  where low = lower(normalized_name) or contains(lower(normalized_name), low) or contains(low, lower(normalized_name))),
matched as (select * from (select *, row_number() over (partition by category, entry order by kind, total_articles desc, topic_id) as r from match_) where r = 1)"""
KEYWORDS = "kw as (select distinct category, unnest(string_split(lower(name), ' ')) as keyword from topic_catalog where category is not null)"
SIDEBAR = MATCHED + ", " + PLACED + ", " + KEYWORDS + """, kc as (select category, count(distinct a.id) as n from articles a, kw where keyword <> '' and contains(lower(title), keyword) and a.id in (select article_id from ta) group by 1),
nodes as (select category, entry, topic_id, total_articles from matched union all select e.category, e.entry, null, n from ent e join kc using (category) where not exists (select 1 from matched m where m.category = e.category and m.entry = e.entry)),
side as (select category, entry, topic_id, total_articles as article_count, cast(sum(total_articles) over (partition by category) as bigint) as category_count,
  row_number() over (partition by category order by total_articles desc, topic_id nulls first, entry) as place from nodes where total_articles > 0)"""
SCORED = ADJACENT + ", score as (select a.topic_id, 3.0 * total_articles + 2.0 * indegree - 10.0 * incoming - 5.0 * prerequisite_count + 1.5 * outgoing as score, total_articles from adj a join topics on id = topic_id where total_articles >= 3)"
#: A depth-first walk with a stack of paths, down to the third level, ten children at most.
TREE = "recursive " + SCORED + """, roots_ as (select topic_id, row_number() over (order by score desc, total_articles desc, topic_id) as r from score),
kids as (select s as parent, list(t order by r desc) as ids from (select s, t, row_number() over (partition by s order by total_articles desc, t) as r from ed join topics on id = t where rel = 'subtopic_of' and s <> t) where r <= 10 group by 1),
walk(stack, seen, cur) as (select list([topic_id] order by r desc), cast([] as integer[]), cast(null as integer[]) from roots_ where r <= 10
  union all select case when hit or len(top) >= 3 then rest else list_concat(rest, coalesce([list_append(top, x) for x in ids], [])) end, case when hit then seen else list_append(seen, top[len(top)]) end, case when hit then null else top end
  from (select *, list_contains(seen, top[len(top)]) as hit from (select stack[len(stack)] as top, list_slice(stack, 1, len(stack) - 1) as rest, seen from walk where len(stack) > 0)) left join kids on parent = top[len(top)]),
placed as (select cur, cur[len(cur)] as topic_id, case when len(cur) > 1 then cur[len(cur) - 1] end as parent_id, cur[1] as root_id, len(cur) - 1 as depth, total_articles from walk join topics on id = cur[len(cur)] where cur is not null),
tree as (select topic_id, parent_id, root_id, cast(depth as integer) as depth, article_count from placed join (select topic_id, cast(sum(total_articles) as bigint) as article_count from (select unnest(cur) as topic_id, total_articles from placed) group by 1) using (topic_id))"""
