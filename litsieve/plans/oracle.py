"""The same queries as DuckDB SQL over the same tables.

Written from the definitions, with other means than the Spark side: regular
expressions per keyword, recursive SQL for clusters, plain window functions for
ranks.
"""

from __future__ import annotations

import re

from litsieve.config import DisplayRules
from litsieve.defaults import CATEGORY_LABELS
from litsieve.plans.queries import AS_OF, WINDOW_END, WINDOW_START
from litsieve.plans.tables import PROSE_GLOSSARY, PROSE_RULES, PROSE_TOKENS

# Decision, confidence and reason of each branch of the built-in reviewer (fixed values).
OUTCOMES = {
    1: ("reject", 0.95, "editorial or correction item is outside the digest scope"),
    2: ("reject", 0.9, "profile, viewpoint, or Q&A item is outside the digest scope"),
    3: ("reject", 0.88, "topic appears outside the intended biology scope"),
    4: ("keep", 0.83, "biology relevance is clear even though rule-based category remained other"),
    5: ("review", 0.62, "relevance or category remains ambiguous after rule-based classification"),
    6: ("keep", 0.82, "preprint is biology-relevant but should remain marked as preprint"),
    7: ("keep", 0.92, "rule-based filtering and category assignment are consistent with biology scope"),
}

R = PROSE_RULES.relevance
V = PROSE_RULES.review
D: DisplayRules = PROSE_RULES.display


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def some(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def array(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]::VARCHAR[]"


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def clean(x: str) -> str:
    """Entities that occur in the tables, then tags, then white space."""
    for name, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
        x = f"replace({x}, {q(name)}, {q(char)})"
    x = f"regexp_replace({x}, '&amp;?', '&', 'g')"
    return squeeze(f"regexp_replace({x}, '<[^>]+>', ' ', 'g')")


def title_form(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


def iso(x: str) -> str:
    return f"coalesce(strftime({x}, '%Y-%m-%dT%H:%M:%SZ'), '')"


def keyword_test(text: str, keyword: str) -> str:
    key = keyword.lower()
    body = "".join(r"\s+" if ch == " " else "\\" + ch if not ch.isalnum() else ch for ch in key)
    # A single word of three or more characters that starts with a letter may carry a plural s.
    if re.fullmatch("[a-z][a-z0-9-]{2,}", key) and key[-1] != "s":
        body += "s?"
    return f"regexp_matches({text}, {q(f'(^|[^a-z0-9]){body}($|[^a-z0-9])')})"


def hits(text: str, keywords) -> str:
    cases = ", ".join(f"CASE WHEN {keyword_test(text, k)} THEN {q(k)} END" for k in keywords)
    return f"list_filter([{cases}]::VARCHAR[], lambda x: x IS NOT NULL)"


def contains_some(text: str, parts) -> str:
    return "(" + " OR ".join(f"contains({text}, {q(p)})" for p in parts) + ")"


def starts_some(text: str, parts) -> str:
    return "(" + " OR ".join(f"starts_with({text}, {q(p)})" for p in parts) + ")"


def joined(x: str) -> str:
    return f"array_to_string({x}, '|')"


TIME = "(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 2220))"

RAW = f"""
raw AS (
  SELECT doc_id AS seq, source AS source_id, 'Journal ' || source AS journal,
    'family-' || right(source, 1) AS publisher_family,
    CASE WHEN source IN ('src5', 'src9') THEN 'ai-conditional' WHEN source IN ('src2', 'src8') THEN 'plant-core'
         ELSE 'general' END AS "group",
    CASE WHEN lang = 'de' THEN 'preprint' ELSE '' END AS publication_stage,
    'https://feeds.example.org/' || source || '.xml' AS source_url,
    split_part(text, chr(10), 1) AS title,
    CASE WHEN lang = 'de' THEN '' ELSE 'HTTPS://WWW.' || source || '.Example.org/Article/' || n_chars
         || '?utm_source=feed&id=' || n_chars || '&q=a%20b#top' END AS link,
    CASE WHEN lang = 'es' THEN ''
         WHEN lang = 'fr' THEN strftime({TIME}, '%a, %d %b %Y %H:%M:%S') || ' +0000'
         WHEN lang = 'de' THEN strftime({TIME}, '%Y-%m-%d %H:%M:%S')
         ELSE strftime({TIME}, '%Y-%m-%dT%H:%M:%SZ') END AS published,
    CASE WHEN lang = 'es' THEN NULL ELSE {TIME} END AS published_ts,
    text AS abstract,
    CASE WHEN lang = 'fr' THEN '' WHEN lang = 'es' THEN 'doi: 10.1000/' || upper(md5(text))
         ELSE 'https://doi.org/10.1000/' || md5(text) END AS doi,
    [lang, source, ' ', upper(lang)] AS tags,
    string_split(split_part(text, chr(10), 1), ' ') AS authors,
    source, lang, n_chars
  FROM documents)"""

NORM = f"""
norm AS (
  SELECT seq, source_id, journal, publisher_family, "group",
    CASE WHEN lang = 'de' THEN 'preprint' ELSE 'journal' END AS publication_stage,
    'article' AS article_type, {squeeze('title')} AS title_en, {title_form('title')} AS title_norm,
    CASE WHEN lang = 'fr' THEN '' ELSE '10.1000/' || md5(abstract) END AS doi,
    link AS article_url,
    CASE WHEN lang = 'de' THEN '' ELSE 'https://www.' || source || '.example.org/Article/' || n_chars || '?id='
         || n_chars || '&q=a+b' END AS canonical_url,
    {iso('published_ts')} AS published_at, {squeeze('abstract')} AS abstract,
    [lang, source, upper(lang)] AS tags, authors, source_url, '' AS fetched_at,
    published_ts
  FROM raw)"""

REGISTRY = """
registry AS (
  SELECT DISTINCT source AS source_id, source NOT IN ('src10', 'src19') AS enabled, 'Journal ' || source AS journal,
    CASE WHEN source IN ('src5', 'src9') THEN 'ai-conditional' WHEN source IN ('src2', 'src8') THEN 'plant-core'
         ELSE 'general' END AS "group"
  FROM documents)"""

SEARCH = f"""
search AS (
  SELECT n.*, lower({squeeze("journal || ' ' || title_en || ' ' || abstract || ' ' || array_to_string(tags, ' ')")}) AS st
  FROM norm n)"""

HITS = f"""
hit AS MATERIALIZED (
  SELECT s.*, {hits('st', R.keep_keywords)} AS keep_hits, {hits('st', R.ai_keep_keywords)} AS ai_hits,
    {hits('st', R.reject_keywords)} AS reject_hits, {hits('st', R.hard_reject_keywords)} AS hard_hits
  FROM search s)"""

_first3 = lambda x: f"array_to_string(list_slice({x}, 1, 3), ', ')"

RELEVANCE = f"""
branched AS (
  SELECT h.*, CASE
    WHEN {starts_some('title_en', R.title_prefixes)} THEN 1
    WHEN {starts_some('doi', R.doi_prefixes)} THEN 2
    WHEN len(hard_hits) > 0 THEN 3
    WHEN len(ai_hits) > 0 THEN 4
    WHEN (journal IN {some(R.conditional_journals)} OR "group" = 'ai-conditional') AND len(keep_hits) = 0 THEN 5
    WHEN source_id IN {some(R.strict_source_ids)} AND len(keep_hits) = 0 THEN 6
    WHEN len(reject_hits) > 0 AND len(keep_hits) = 0 THEN 7
    WHEN len(reject_hits) > len(keep_hits) + 1 THEN 8
    WHEN len(keep_hits) > 0 THEN 9 ELSE 10 END AS branch
  FROM hit h),
relevance AS (
  SELECT b.*, CASE WHEN branch IN (4, 9, 10) THEN 'keep' ELSE 'reject' END AS relevance_status,
    CASE branch WHEN 1 THEN 'matched editorial title prefix' WHEN 2 THEN 'matched editorial DOI prefix'
      WHEN 3 THEN 'matched hard reject keywords: ' || {_first3('hard_hits')}
      WHEN 4 THEN 'matched AI keep keywords: ' || {_first3('ai_hits')}
      WHEN 5 THEN 'conditional journal without biology-specific signal'
      WHEN 6 THEN 'strict bio source without biology-specific keyword match'
      WHEN 7 THEN 'matched reject keywords: ' || {_first3('reject_hits')}
      WHEN 8 THEN 'reject signals outweigh keep signals: ' || {_first3('reject_hits')}
      WHEN 9 THEN 'matched keep keywords: ' || {_first3('keep_hits')}
      ELSE 'kept by default source scope' END AS relevance_reason
  FROM branched b)"""

_scores = " UNION ALL ".join(
    f"SELECT seq, {q(c)} AS category, {hits('st', words)} AS cat_hits FROM search"
    for c, words in PROSE_RULES.categories.items()
)

SCORES = f"""
scores AS MATERIALIZED (SELECT seq, category, cat_hits, len(cat_hits) AS score FROM ({_scores}) WHERE len(cat_hits) > 0),
best AS (
  SELECT seq, category, cat_hits FROM scores
  QUALIFY row_number() OVER (PARTITION BY seq ORDER BY score DESC, category DESC) = 1)"""

CLASSIFIED = """
classified AS MATERIALIZED (
  SELECT r.*, coalesce(b.category, 'other') AS category,
    CASE WHEN b.seq IS NULL THEN 'no category keyword matched'
         ELSE 'matched category keywords: ' || array_to_string(list_slice(b.cat_hits, 1, 4), ', ') END AS category_reason,
    coalesce(b.cat_hits, []::VARCHAR[]) AS category_hits
  FROM relevance r LEFT JOIN best b USING (seq))"""

CLASSIFIED_ONLY = CLASSIFIED.replace("FROM relevance r", "FROM search r")


def _heuristic(category: str) -> str:
    text = "lower(title_en || ' ' || abstract || ' ' || array_to_string(tags, ' '))"
    return f"""CASE WHEN {starts_some('title_en', V.editorial_prefixes)} THEN 1
      WHEN {' OR '.join(f"list_contains(list_transform(tags, lambda t: lower(t)), {q(t)})" for t in V.editorial_tags)} THEN 2
      WHEN {contains_some(text, V.hard_reject_hints)} THEN 3
      WHEN {category} = 'other' AND {contains_some(text, V.strong_hints)} THEN 4
      WHEN {category} = 'other' THEN 5 WHEN publication_stage = 'preprint' THEN 6 ELSE 7 END"""


def _outcome(branch: str, i: int, text: bool = True) -> str:
    cases = " ".join(f"WHEN {k} THEN {q(v[i]) if text else v[i]}" for k, v in OUTCOMES.items())
    return f"CASE {branch} {cases} END"


REVIEWED = f"""
judged AS (SELECT c.*, {_heuristic('category')} AS rb FROM classified c),
reviewed AS (
  SELECT j.*, relevance_status AS rule_decision, {_outcome('rb', 0)} AS llm_decision,
    {_outcome('rb', 1, False)}::DOUBLE AS llm_confidence, {_outcome('rb', 2)} AS llm_reason,
    {_outcome('rb', 0)} AS final_decision
  FROM judged j)"""

# The confidence is rounded by its exact binary value, as the reference does; round() multiplies first,
# which moves values next to a half.
PROVIDED = f"""
reply AS (
  SELECT doc_id AS seq, CASE WHEN toxic = 1 THEN 'reject' WHEN quality = 1 THEN 'keep' ELSE 'unsure' END AS decision,
    ('0.' || (doc_id * 7919 % 9000 + 1000))::DOUBLE AS confidence, CASE WHEN toxic = 1 THEN 'toxic' END AS reason,
    CASE WHEN toxic = 0 AND quality = 0 THEN 'iberic' END AS override
  FROM labels),
settled AS (
  SELECT c.*, p.override, coalesce(p.confidence, 0.5) AS conf, coalesce(p.decision, 'review') AS decision, p.reason
  FROM classified c LEFT JOIN reply p USING (seq)),
provided AS MATERIALIZED (
  SELECT s.* EXCLUDE (category), relevance_status AS rule_decision,
    CASE WHEN decision IN ('keep', 'review', 'reject') THEN decision WHEN conf >= {V.keep_threshold} THEN 'keep'
         WHEN conf >= {V.review_threshold} THEN 'review' ELSE 'reject' END AS llm_decision,
    printf('%.3f', conf)::DOUBLE AS llm_confidence, coalesce(reason, 'no review reason provided') AS llm_reason,
    CASE WHEN override IS NOT NULL THEN category END AS category_original, override AS llm_category_override,
    coalesce(override, category) AS category,
    CASE WHEN decision IN ('keep', 'review', 'reject') THEN decision WHEN conf >= {V.keep_threshold} THEN 'keep'
         WHEN conf >= {V.review_threshold} THEN 'review' ELSE 'reject' END AS final_decision
  FROM settled s)"""

DKEY = """CASE WHEN doi <> '' THEN 'doi:' || doi WHEN canonical_url <> '' THEN 'url:' || canonical_url
  ELSE 'title:' || lower(journal) || '::' || title_norm END"""

FINAL = f"""
decided AS (
  SELECT {DKEY} AS k, CASE WHEN toxic = 1 THEN 'reject' WHEN quality = 1 THEN 'keep' ELSE '' END AS d,
    CASE WHEN toxic = 0 AND quality = 1 THEN 'romance' ELSE '' END AS c,
    CASE WHEN toxic = 1 THEN 'flagged' ELSE '' END AS notes
  FROM labels l JOIN norm n ON n.seq = l.doc_id
  WHERE toxic = 1 OR quality = 1
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY n.seq DESC) = 1),
final AS (
  SELECT r.* EXCLUDE (category, final_decision), d.k IS NOT NULL AS manual_review_applied,
    CASE WHEN d.k IS NOT NULL THEN d.d END AS manual_review_decision, d.notes AS reviewer_notes,
    CASE WHEN d.c <> '' THEN category END AS category_original,
    coalesce(nullif(d.c, ''), category) AS category, coalesce(d.d, final_decision) AS final_decision
  FROM (SELECT *, {DKEY} AS k FROM reviewed) r LEFT JOIN decided d ON r.k = d.k)"""

KEYS = """
keys AS MATERIALIZED (
  SELECT seq, unnest(list_filter([CASE WHEN canonical_url <> '' THEN 'url:' || canonical_url END,
    CASE WHEN doi <> '' THEN 'doi:' || doi END, 'title:' || lower(journal) || '::' || title_norm],
    lambda x: x IS NOT NULL)) AS key FROM norm)"""

CLUSTERS = f"""
adjacent AS MATERIALIZED (SELECT DISTINCT a.seq AS x, b.seq AS y FROM keys a JOIN keys b ON a.key = b.key AND a.seq <> b.seq),
reach AS (SELECT x, y FROM adjacent UNION SELECT r.x, a.y FROM reach r JOIN adjacent a ON r.y = a.x),
cluster AS (SELECT n.seq, least(n.seq, coalesce(min(r.y), n.seq)) AS cluster FROM norm n LEFT JOIN reach r ON r.x = n.seq GROUP BY n.seq),
scored AS (
  SELECT n.seq, n.title_en, n.doi, n.published_at, {DKEY} AS dedupe_key, c.cluster,
    8 + (doi <> '')::INT + (canonical_url <> '')::INT * 2 + (published_at <> '')::INT + (title_en <> '')::INT
      + (title_norm <> '')::INT + (trim(abstract) <> '')::INT + (len(authors) > 0)::INT AS score
  FROM norm n JOIN cluster c USING (seq)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, published_at, seq) AS rn,
    first(dedupe_key) OVER (PARTITION BY cluster ORDER BY seq) AS duplicate_of
  FROM scored)"""


def plant() -> str:
    text = "lower(journal || ' ' || title_en || ' ' || array_to_string(tags, ', '))"
    return f"(\"group\" IN {some(D.plant_groups)} OR {contains_some(text, D.plant_tokens)})"


POSITION = "list_position(" + array(D.source_order) + ", source_id) - 1"

SHOWN_KEYS = f"""
keyed AS MATERIALIZED (
  SELECT p.*, CASE WHEN {plant()} THEN 0 ELSE 1 END AS k_plant,
    CASE final_decision WHEN 'review' THEN 1 WHEN 'reject' THEN 2 ELSE 0 END AS k_decision,
    CASE WHEN final_decision IN ('review', 'reject') THEN llm_confidence ELSE -llm_confidence END AS k_confidence,
    -coalesce(epoch(published_ts), 0) AS k_time, lower(title_en) AS k_title
  FROM provided p),
shown AS (SELECT * FROM keyed WHERE final_decision IN ('keep', 'review'))"""

BUCKET = f"""CASE WHEN source_id IN {some(D.top_source_ids)} AND k_plant = 0 THEN 'top-plant'
  WHEN source_id IN {some(D.top_source_ids)} THEN 'top-journals' WHEN k_plant = 0 THEN 'plant-priority'
  WHEN category IN {some(D.non_deferred_categories)} THEN 'ai-priority'
  WHEN category IN {some(D.deferred_categories)} THEN 'deferred-gene-function' ELSE 'other-biology' END"""

ORDER = "k_plant, k_decision, k_confidence, k_time, k_title, seq"

HIDDEN = f"""(source_id IN {some(D.hidden_source_ids)} AND k_plant = 1 AND category <> {q(D.never_hidden_category)}
  AND len({hits("lower(journal || ' ' || title_en || ' ' || abstract || ' ' || array_to_string(tags, ', '))", D.hidden_keywords)}) > 0)"""


def groups(source: str, stage: str = "") -> str:
    s = f"{stage}, " if stage else ""
    part = f"PARTITION BY {stage} " if stage else ""
    return f"""
grp AS (
  SELECT {s}source_id, count(*) AS n_records, min((k_decision > 0)::INT) AS all_review,
    CASE WHEN any_value({POSITION}) IS NOT NULL THEN 0 WHEN bool_or(k_plant = 0) THEN 1
         WHEN bool_and(category IN {some(D.deferred_categories)} AND k_plant = 1) THEN 3 ELSE 2 END AS tier,
    coalesce(any_value({POSITION}), 0) AS tier_position, lower(min(journal)) AS group_name, min(journal) AS group_label
  FROM {source} GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER ({part}ORDER BY all_review, tier, tier_position, group_name, source_id) AS group_rank FROM grp)"""


TO_CLASSIFIED = [RAW, NORM, SEARCH, HITS, RELEVANCE, SCORES, CLASSIFIED]
TO_REVIEWED = [*TO_CLASSIFIED, REVIEWED]
TO_PROVIDED = [*TO_CLASSIFIED, PROVIDED]
TO_KEYED = [*TO_PROVIDED, SHOWN_KEYS]
ONLY_CLASSES = [RAW, NORM, SEARCH, SCORES, CLASSIFIED_ONLY]

def sql(ctes: list[str], select: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(ctes) + "\n" + select



WINDOW_STATS = sql([RAW], f"""
  SELECT count(*) AS n_total, count(*) FILTER (published_ts BETWEEN TIMESTAMP '{WINDOW_START}' AND TIMESTAMP '{WINDOW_END}') AS n_inside,
    count(*) FILTER (published_ts IS NULL) AS n_undated,
    count(*) FILTER (published_ts NOT BETWEEN TIMESTAMP '{WINDOW_START}' AND TIMESTAMP '{WINDOW_END}') AS n_outside FROM raw""")


def _glossary(x: str) -> str:
    x = f"trim({x})"
    for source, target in PROSE_GLOSSARY.replacements:
        x = f"replace({x}, {q(source)}, {q(target)})"
    for pattern, target in (
        ("(基准测试)(?:基准测试|测试)+", r"\1"), ("(工作流程)(?:工作流程|流程)+", r"\1"), ("(单细胞)(?:单细胞)+", r"\1"),
        ("流程程+", "流程"), ("测试测试+", "测试"),
    ):
        x = f"regexp_replace({x}, {q(pattern)}, {q(target)}, 'g')"
    return squeeze(x)


def _trace() -> str:
    """One column per step of the running text, and whether the step fires."""
    steps, previous = [], "SELECT conv_id, turn, trim(text) AS t0 FROM conversations"
    for i, (source, target) in enumerate(PROSE_GLOSSARY.replacements):
        previous = f"SELECT *, replace(t{i}, {q(source)}, {q(target)}) AS t{i + 1} FROM ({previous})"
        steps.append(f"CASE WHEN contains(t{i}, {q(source)}) THEN {q(source + '>' + target)} END")
    last = f"t{len(PROSE_GLOSSARY.replacements)}"
    fired = f"array_to_string(list_filter([{', '.join(steps)}]::VARCHAR[], lambda x: x IS NOT NULL), '|')"
    collapsed = last
    for pattern, target in (
        ("(基准测试)(?:基准测试|测试)+", r"\1"), ("(工作流程)(?:工作流程|流程)+", r"\1"), ("(单细胞)(?:单细胞)+", r"\1"),
        ("流程程+", "流程"), ("测试测试+", "测试"),
    ):
        collapsed = f"regexp_replace({collapsed}, {q(pattern)}, {q(target)}, 'g')"
    return f"SELECT conv_id, turn, {squeeze(collapsed)} AS rewritten, {fired} AS changes FROM ({previous})"


def _sentences(x: str, stops: str) -> str:
    return rf"list_filter(list_transform(string_split_regex({x}, '[{stops}]'), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"


def _leading(x: str, n: int = 2) -> str:
    body = f"array_to_string(list_slice({_sentences(x, '。！!?')}, 1, {n}), '。')"
    return f"CASE WHEN {body} = '' THEN '' ELSE {body} || '。' END"


def _cap(x: str, n: int) -> str:
    parts = _sentences(x, "。！?")
    return f"CASE WHEN len({parts}) > {n} THEN array_to_string(list_slice({parts}, 1, {n}), '。') || '。' ELSE {x} END"


def _stage_zh() -> str:
    return "CASE WHEN publication_stage = 'preprint' THEN '预印本' ELSE '正式发表' END"


def _translated(mark: str) -> str:
    """Localized columns for a translator that puts a mark before the text; no class has a Chinese label."""
    summary = (
        "'该文发表于《' || journal || '》，归类为“其他”。' || " f"({_leading(_glossary(f'({mark} || abstract)'))})"
    )
    return f"{_glossary(f'({mark} || title_en)')} AS title_zh, {_cap(f'({summary})', 4)} AS summary_zh"


def _template(labels: str, abstract: str) -> str:
    head = f"'该文来源为《' || journal || '》' || {_stage_zh()} || '条目，归类为“' || {labels} || '”。'"
    return (
        f"CASE WHEN {abstract} <> '' THEN {head} || '当前未配置自动中文翻译模型，建议根据摘要进一步润色。摘要显示研究重点与“' "
        f"|| title_en || '”相关。' ELSE {head} || '当前未抓取到可用摘要，后续需补充标题翻译与中文总结。' END"
    )


def _feed(form: str) -> str:
    head = "SELECT source_id, journal, \"group\", 'https://feeds.example.org/' || source_id || '/' || (seq // 1000) AS source_url"
    pos = "row_number() OVER (PARTITION BY source_id, seq // 1000 ORDER BY seq) - 1 AS item_pos"
    # A blank term of Atom is kept as an empty tag.
    tags = f"lang || '|' || source || '{'||' if form == 'atom' else '|'}' || upper(lang) AS tags"
    authors = r"array_to_string(list_filter(authors, lambda a: a <> ''), '|')" if form == "rdf" else "''"
    published = "published" if form == "rdf" else "CASE WHEN seq % 2 = 1 OR published = '' THEN '2001-02-03T04:05:06Z' ELSE published END"
    doi = "CASE WHEN doi LIKE 'https://doi.org/%' THEN substr(doi, 17) ELSE '' END" if form == "atom" else "doi"
    return sql(
        [RAW],
        f"{head}, {pos}, trim(title) AS title, link, {published} AS published, trim(abstract, ' ' || chr(10)) AS abstract, {doi} AS doi, "
        f"{tags}, {authors} AS authors FROM raw",
    )


def _label(value: str, labels: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in labels.items())
    words = "array_to_string(list_transform(string_split({0}, '-'), lambda w: upper(w[1]) || lower(w[2:])), '-')".format(value)
    return f"CASE {value} {cases} ELSE {words} END"


def _snippet(x: str, n: int) -> str:
    flat = squeeze(x)
    return f"CASE WHEN length({flat}) <= {n} THEN {flat} ELSE rtrim(substr({flat}, 1, {n - 1})) || '…' END"


def _authors(x: str) -> str:
    names = f"list_filter({x}, lambda a: trim(a) <> '')"
    return f"""CASE WHEN len({names}) = 0 THEN '' WHEN len({names}) <= 5 THEN 'Authors: ' || array_to_string({names}, ', ')
      ELSE 'Authors: ' || array_to_string(list_concat(list_slice({names}, 1, 2), list_slice({names}, -3, -1)), ', ') END"""


# RE2 knows ASCII word boundaries only, so each word with another letter in it
# first becomes one underscore, which is a word character no term contains.
TERMS = r"""
occurrence AS MATERIALIZED (
  SELECT seq, title_en, generate_subscripts(m, 1) AS pos, unnest(m) AS match
  FROM (SELECT seq, title_en, regexp_extract_all(
    regexp_replace(lower(title_en || ' ' || abstract || ' ' || array_to_string(tags, ' ')),
      '[a-z0-9_]*[_\x{80}-\x{10FFFF}][a-z0-9_\x{80}-\x{10FFFF}]*', '_', 'g'),
    '\b[a-z][a-z0-9-]{2,}(?:\s+[a-z0-9-]{2,}){0,3}\b', 0) AS m FROM norm))"""


def oracle_sql() -> dict[str, str]:
    known = ", ".join(f"({q(t)})" for t in PROSE_GLOSSARY.known_terms())
    top = lambda rows, n: f"SELECT source_id, count(*) AS n FROM {rows} GROUP BY 1 ORDER BY n DESC, min(seq) LIMIT {n}"
    days = "CASE WHEN o_orderpriority = '1-URGENT' THEN 'latest' ELSE strftime(o_orderdate, '%Y-%m-%d') END"
    tokens = ", ".join(f"({i}, {q(t)})" for i, t in enumerate(PROSE_TOKENS))
    labels = "CASE category WHEN 'romance' THEN '罗曼' WHEN 'germanic' THEN '日耳曼' ELSE '其他' END"
    local = "(ts + INTERVAL 8 HOUR)"
    delivered = f"CASE WHEN {local} < date_trunc('day', {local}) + INTERVAL 8 HOUR THEN date_trunc('day', {local}) - INTERVAL 1 DAY ELSE date_trunc('day', {local}) END"
    return {
        "scan_records": sql([RAW], 'SELECT seq, source_id, "group", title, link, published, abstract, doi, '
                            f"{joined('tags')} AS tags, {joined('authors')} AS authors FROM raw"),
        "feed_rss": _feed("rss"),
        "feed_rdf": _feed("rdf"),
        "feed_atom": _feed("atom"),
        "html_links": """
          WITH a AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h,
            regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS t FROM pages),
          r AS (SELECT page_id, generate_subscripts(h, 1) - 1 AS link_pos, unnest(h) AS href, unnest(t) AS link_text FROM a)
          SELECT page_id, link_pos, href, trim(link_text) AS link_text FROM r""",
        "html_listing": r"""
          WITH a AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h,
            regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS t FROM pages),
          r AS (SELECT page_id, url, generate_subscripts(h, 1) - 1 AS link_pos, unnest(h) AS href, unnest(t) AS link_text FROM a),
          k AS (SELECT page_id, link_pos, trim(link_text) AS title, regexp_extract(url, '^[a-z]+://[^/?#]+') || href AS link
            FROM r WHERE contains(href, '/') AND length(trim(link_text)) >= 4 AND lower(trim(link_text)) NOT IN ('that', 'aulich'))
          SELECT page_id, link, min_by(title, link_pos) AS title, min(link_pos) AS link_pos FROM k GROUP BY 1, 2""",
        "select_sources": sql([REGISTRY], """
          , langs AS (SELECT source AS source_id, lang, row_number() OVER (PARTITION BY source ORDER BY lang) - 1 AS locator_pos
            FROM (SELECT DISTINCT source, lang FROM documents))
          SELECT source_id, journal, "group", locator_pos, 'https://feeds.example.org/' || source_id || '/' || lang AS url
          FROM registry JOIN langs USING (source_id)
          WHERE enabled AND source_id IN ('src1', 'src2', 'src5', 'src10', 'src14')"""),
        "skip_front_matter": sql([RAW], "SELECT seq, split_part(title, ' ', 1) AS title FROM raw WHERE lower(trim(split_part(title, ' ', 1))) NOT IN ('the', 'on', 'de', 'der', 'la')"),
        "route_counts": sql([*TO_REVIEWED, FINAL], "SELECT final_decision AS route, count(*) AS n FROM final GROUP BY 1"),
        "digest_export": sql(TO_KEYED, f"""
          SELECT {_digest_rank()} AS digest_rank, journal, published_at AS publish_date, publication_stage, category, title_en,
            title_en AS title_zh, array_to_string(authors, ', ') AS authors, '' AS summary_zh, abstract, doi, article_url,
            array_to_string(tags, ', ') AS tags FROM shown"""),
        "review_export": sql(TO_KEYED, f"""
          SELECT {_digest_rank()} AS digest_rank, journal, published_at AS publish_date, publication_stage, category, title_en, llm_decision,
            llm_confidence::VARCHAR AS llm_confidence, llm_reason, relevance_reason, doi, article_url,
            array_to_string(tags, ', ') AS tags FROM keyed WHERE final_decision = 'review'"""),
        "archive_retention": f"""
          SELECT DISTINCT {days} AS day_name FROM orders
          WHERE o_orderpriority <> '1-URGENT' AND o_orderdate::DATE <= DATE '1995-06-30' - 30""",
        "archive_kept": f"""
          SELECT DISTINCT {days} AS day_name FROM orders
          WHERE o_orderpriority = '1-URGENT' OR o_orderdate::DATE > DATE '1995-06-30' - 30""",
        "acquire_records": sql([RAW, """
items AS (SELECT source_id, seq // 1000 AS page, row_number() OVER (PARTITION BY source_id, seq // 1000 ORDER BY seq) - 1 AS item_pos,
  trim(title) AS title FROM raw),
addr AS (SELECT DISTINCT source_id, page, side, 'https://feeds.example.org/' || source_id || '/' || page || '/' || side AS url,
  substr(source_id, 4)::INT AS number FROM items, (VALUES ('a'), ('b')) AS s(side)),
pos AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY url) - 1 AS p, count(*) OVER (PARTITION BY source_id) AS c FROM addr),
loc AS (SELECT *, CASE WHEN number % 2 = 1 THEN c - 1 - p ELSE p END AS locator_pos FROM pos
  WHERE number <> 10 AND NOT (number % 7 = 3 AND side = 'a'))"""], """
          SELECT (number * 10000 + locator_pos) * 100000000 + item_pos AS seq, source_id, url AS source_url, title,
            '2024-06-01T00:00:00Z' AS fetched_at FROM items JOIN loc USING (source_id, page)
          QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY locator_pos, item_pos) <= 30"""),
        "acquire_rest": sql([RAW], """
          , pages AS (SELECT DISTINCT source_id, seq // 1000 AS page, substr(source_id, 4)::INT AS number FROM raw WHERE source_id <> 'src10')
          SELECT 'quarantine' AS kind, source_id, 'https://feeds.example.org/' || source_id || '/' || page || '/a' AS url FROM pages WHERE number % 7 = 3
          UNION ALL SELECT DISTINCT 'missing', source_id, 'https://nowhere.example.org/' FROM pages"""),
        "digest_sections": sql([*TO_KEYED, f"""
visible AS (SELECT s.*, publication_stage AS stage FROM shown s WHERE NOT {HIDDEN})""", groups("visible", "stage")], f"""
          SELECT v.seq, CASE v.stage WHEN 'journal' THEN 0 ELSE 1 END AS stage_rank, v.stage,
            CASE v.stage WHEN 'journal' THEN 'Published Papers' ELSE 'Preprints' END AS stage_label, g.group_rank, g.group_label,
            g.n_records, row_number() OVER (PARTITION BY v.stage, v.source_id ORDER BY {ORDER}) AS card_rank
          FROM visible v JOIN ranked g USING (stage, source_id)"""),
        "review_sections": sql(TO_PROVIDED, """
          SELECT seq, CASE publication_stage WHEN 'journal' THEN 0 ELSE 1 END AS stage_rank, publication_stage AS stage,
            category AS section, row_number() OVER (PARTITION BY publication_stage, category ORDER BY seq) AS row_rank FROM provided"""),
        "card_fields": sql(TO_PROVIDED, f"""
          SELECT seq, CASE WHEN article_url <> '' THEN article_url WHEN doi <> '' THEN 'https://doi.org/' || doi ELSE '' END AS href,
            coalesce(strftime(published_ts, '%Y-%m-%d %H:%M UTC'), 'Publish date unavailable') AS date_label,
            {_snippet('abstract', 220)} AS preview, {_authors('authors')} AS author_line,
            CASE publication_stage WHEN 'journal' THEN 'Published Papers' ELSE 'Preprints' END AS stage_label,
            {_label('category', CATEGORY_LABELS)} AS category_label, title_en, journal,
            array_to_string(tags, ', ') AS tags FROM provided"""),
        "normalize_records": sql([RAW, NORM], 'SELECT seq, source_id, journal, publisher_family, "group", publication_stage, '
            "article_type, title_en, title_norm, doi, article_url, canonical_url, published_at, abstract, source_url, fetched_at, "
            f"{joined('tags')} AS tags, {joined('authors')} AS authors FROM norm"),
        "ingest_window": sql([RAW], f"SELECT seq, published FROM raw WHERE published_ts IS NULL OR published_ts BETWEEN TIMESTAMP '{WINDOW_START}' AND TIMESTAMP '{WINDOW_END}'"),
        "window_filter": sql([RAW], f"SELECT seq, {iso('published_ts')} AS published_at FROM raw WHERE published_ts BETWEEN TIMESTAMP '{WINDOW_START}' AND TIMESTAMP '{WINDOW_END}'"),
        "window_stats": WINDOW_STATS,
        "lookback_filter": sql([RAW], f"SELECT seq, published FROM raw WHERE published_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 96 HOUR"),
        "digest_window": f"""
          WITH d AS (SELECT event_id, {delivered} AS day FROM events)
          SELECT event_id, strftime(day - INTERVAL 32 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
            strftime(day, '%Y-%m-%dT%H:%M:%SZ') AS window_end, strftime(day, '%Y-%m-%d') AS digest_date FROM d""",
        "digest_windows": """
          WITH days AS (SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events) - INTERVAL 3 DAY,
            (SELECT date_trunc('day', max(ts)) FROM events) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS d),
          w AS (SELECT d - INTERVAL 8 HOUR AS s, d + INTERVAL 24 HOUR AS e FROM days)
          SELECT strftime(s, '%Y-%m-%dT%H:%M:%SZ') AS window_start, strftime(e, '%Y-%m-%dT%H:%M:%SZ') AS window_end, event_type, count(*) AS n
          FROM events JOIN w ON ts >= s AND ts < e GROUP BY ALL""",
        "limit_per_source": sql([RAW], "SELECT source_id, seq FROM raw QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY seq) <= 20"),
        "relevance_split": sql([RAW, NORM, SEARCH, HITS, RELEVANCE], "SELECT seq, relevance_status, relevance_reason FROM relevance WHERE relevance_status = 'reject'"),
        "window_observed": WINDOW_STATS,
        "decisions_csv": sql([RAW], """
          SELECT CASE WHEN toxic = 1 THEN 'reject' ELSE 'keep' END AS review_final_decision,
            CASE WHEN toxic = 1 THEN '' ELSE 'romance' END AS review_final_category, CASE WHEN toxic = 1 THEN 'flagged' ELSE '' END AS reviewer_notes,
            count(*) AS n, count(DISTINCT nullif(trim(title), '')) AS n_titles, min(nullif(trim(doi), '')) AS first_doi
          FROM labels JOIN raw ON seq = doc_id WHERE toxic = 1 OR quality = 1 GROUP BY 1, 2, 3"""),
        "delivery_gate": sql([*TO_REVIEWED, FINAL], """
          SELECT 'all' AS records, count(*) FILTER (final_decision = 'review') > 0 AS blocked, false AS blocked_if_allowed FROM final
          UNION ALL SELECT 'kept', false, false"""),
        "fallback_summary": sql([RAW, NORM], f"""
          SELECT seq, '该文来源为《' || journal || '》' || {_stage_zh()} || '条目，归类为“其他”。当前未抓取到可用摘要，建议后续人工补充中文总结。' AS summary_zh
          FROM norm WHERE publication_stage = 'preprint'"""),
        "relevance_filter": sql([RAW, NORM, SEARCH, HITS, RELEVANCE], f"""
          SELECT seq, relevance_status, relevance_reason, {joined('keep_hits')} AS relevance_keep_hits,
            {joined('ai_hits')} AS relevance_ai_keep_hits, {joined('reject_hits')} AS relevance_reject_hits,
            {joined('hard_hits')} AS relevance_hard_reject_hits FROM relevance"""),
        "heuristic_review": sql([*ONLY_CLASSES, f"""
opened AS (SELECT * REPLACE (CASE WHEN category = 'romance' THEN 'other' ELSE category END AS category) FROM classified),
judged AS (SELECT seq, {_heuristic('category')} AS rb FROM opened)"""], f"""
          SELECT seq, {_outcome('rb', 0)} AS decision, ({_outcome('rb', 1, False)})::DOUBLE AS confidence, {_outcome('rb', 2)} AS reason FROM judged"""),
        "finalize_review": sql(TO_PROVIDED, """
          SELECT seq, rule_decision, llm_decision, llm_confidence, llm_reason, category_original, llm_category_override, category,
            final_decision FROM provided"""),
        **dict.fromkeys(["review_provider", "review_journal"], sql(ONLY_CLASSES, f"""
          , r AS (SELECT seq, category, length(abstract) AS n, CASE WHEN length(abstract) > 1000 THEN 0.9 WHEN length(abstract) > 300 THEN 0.7 ELSE 0.2 END AS c FROM classified)
          SELECT seq, CASE WHEN n > 2000 THEN 'keep' WHEN c >= {V.keep_threshold} THEN 'keep' WHEN c >= {V.review_threshold} THEN 'review' ELSE 'reject' END AS llm_decision,
            c::DOUBLE AS llm_confidence, n || ' characters' AS llm_reason, CASE WHEN n > 8000 THEN 'long-read' ELSE category END AS category FROM r""")),
        "digest_gate": sql(TO_REVIEWED, """
          SELECT seq, CASE final_decision WHEN 'keep' THEN 0 ELSE 1 END AS part, final_decision FROM reviewed WHERE final_decision IN ('keep', 'review')"""),
        "visual_filter": sql(TO_KEYED, f"SELECT seq, {HIDDEN} AS hidden FROM keyed"),
        "display_bucket": sql(TO_KEYED, f"SELECT seq, {BUCKET} AS bucket FROM keyed"),
        "source_enrich": sql([RAW, REGISTRY], 'SELECT r.seq, r.source_id, g."group" AS registry_group FROM raw r LEFT JOIN registry g ON g.source_id = r.source_id AND g.enabled'),
        "manual_decisions": sql([*TO_REVIEWED, FINAL], """
          SELECT seq, final_decision, manual_review_applied, manual_review_decision, reviewer_notes, category, category_original FROM final"""),
        "keyword_hits": f"SELECT doc_id, {joined(hits('lower(text)', R.keep_keywords + R.reject_keywords))} AS hits FROM documents",
        "glossary_candidates": sql([RAW, NORM, TERMS, f"""
usable AS (SELECT seq, title_en, pos, trim(regexp_replace(match, '\\s+', ' ', 'g')) AS term FROM occurrence),
counted AS (
  SELECT seq, title_en, pos, term FROM usable
  WHERE length(term) >= 4 AND NOT (regexp_matches(term, '[0-9]') AND len(string_split(term, ' ')) > 2)
    AND term NOT IN ('with', 'from', 'through', 'during', 'under', 'between', 'using')
    AND term NOT IN (SELECT t FROM (VALUES {known}) AS k(t))
    AND term NOT IN (SELECT trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) FROM benchmark))"""], """
          , top AS (SELECT term, count(*) AS n, min(struct_pack(s := seq, p := pos)) AS f FROM counted GROUP BY 1 ORDER BY n DESC, f LIMIT 50),
          ex AS (SELECT term, title_en, seq, pos FROM counted SEMI JOIN top USING (term) QUALIFY row_number() OVER (PARTITION BY term ORDER BY seq, pos) <= 2)
          SELECT t.term, t.n, t.f.s AS first_seq, string_agg(e.title_en, '|' ORDER BY e.seq, e.pos) AS examples FROM top t JOIN ex e USING (term) GROUP BY ALL"""),
        "dedupe_key": sql([RAW, NORM], f"SELECT seq, {DKEY} AS dedupe_key FROM norm"),
        "dedupe_candidates": sql([RAW, NORM, """
lists AS (SELECT seq, list_filter([CASE WHEN canonical_url <> '' THEN 'url:' || canonical_url END, CASE WHEN doi <> '' THEN 'doi:' || doi END,
  'title:' || lower(journal) || '::' || title_norm], lambda x: x IS NOT NULL) AS c FROM norm)"""],
            "SELECT seq, generate_subscripts(c, 1) - 1 AS pos, unnest(c) AS candidate FROM lists"),
        "dedupe_clusters": sql([RAW, NORM, KEYS, CLUSTERS], "SELECT seq, cluster FROM cluster", True),
        "completeness": sql([RAW, NORM, KEYS, CLUSTERS], "SELECT seq, score FROM scored", True),
        "dedupe_survivors": sql([RAW, NORM, KEYS, CLUSTERS], "SELECT seq, title_en, doi FROM placed WHERE rn = 1", True),
        "dedupe_audit": sql([RAW, NORM, KEYS, CLUSTERS], "SELECT seq, title_en, duplicate_of FROM placed WHERE rn > 1", True),
        "decision_counts": sql(TO_REVIEWED, """
          SELECT count(*) AS n_total, count(*) FILTER (final_decision = 'keep') AS n_keep, count(*) FILTER (final_decision = 'review') AS n_review,
            count(*) FILTER (final_decision = 'reject') AS n_reject FROM reviewed"""),
        "nonkeep_sources": sql(TO_PROVIDED, top("(SELECT * FROM provided WHERE final_decision <> 'keep')", 10)),
        "rule_feedback": sql(TO_PROVIDED, """
          SELECT llm_decision AS kind, seq, source_id, category, title_en, llm_reason, row_number() OVER (PARTITION BY llm_decision ORDER BY seq) AS item
          FROM provided WHERE rule_decision = 'keep' AND llm_decision IN ('review', 'reject') QUALIFY item <= 10"""),
        "category_overrides": sql(TO_PROVIDED, """
          SELECT seq, source_id, category_original, llm_category_override, title_en, row_number() OVER (ORDER BY seq) AS item
          FROM provided WHERE llm_category_override IS NOT NULL QUALIFY item <= 10"""),
        "other_sources": sql(ONLY_CLASSES, top("(SELECT * FROM classified WHERE category IN ('other', 'germanic'))", 20)),
        "review_sources": sql(TO_PROVIDED, top("(SELECT * FROM provided WHERE final_decision = 'review')", 20)),
        "token_suggestions": sql([*TO_PROVIDED, f"""
pool AS (
  SELECT 0 AS part, s.seq, s.title_en, s.abstract FROM search s LEFT JOIN best b USING (seq) WHERE coalesce(b.category, 'other') IN ('other', 'germanic')
  UNION ALL SELECT 1, seq, title_en, abstract FROM provided WHERE final_decision = 'review'),
seen AS (SELECT part, seq, title_en, i, token FROM pool JOIN (VALUES {tokens}) AS t(i, token) ON contains(lower(title_en || ' ' || abstract), token))"""], """
          , top AS (SELECT token, count(*) AS n FROM seen GROUP BY 1 ORDER BY n DESC, min(struct_pack(a := part, b := seq, c := i)) LIMIT 30),
          ex AS (SELECT token, title_en, part, seq FROM seen QUALIFY row_number() OVER (PARTITION BY token ORDER BY part, seq) <= 3)
          SELECT t.token, t.n, string_agg(e.title_en, '|' ORDER BY e.part, e.seq) AS examples FROM top t JOIN ex e USING (token) GROUP BY ALL"""),
        "suggestions_report": sql([*TO_PROVIDED, f"""
pool AS (
  SELECT 0 AS part, s.seq, s.title_en, s.abstract FROM search s LEFT JOIN best b USING (seq) WHERE coalesce(b.category, 'other') IN ('other', 'germanic')
  UNION ALL SELECT 1, seq, title_en, abstract FROM provided WHERE final_decision = 'review'),
seen AS (SELECT part, seq, title_en, i, token FROM pool JOIN (VALUES {tokens}) AS t(i, token) ON contains(lower(title_en || ' ' || abstract), token))"""], """
          , o AS (SELECT source_id AS name, count(*) AS n FROM (SELECT * FROM pool JOIN norm USING (seq) WHERE part = 0) GROUP BY 1 ORDER BY n DESC, min(seq) LIMIT 20),
          r AS (SELECT source_id AS name, count(*) AS n FROM (SELECT * FROM pool JOIN norm USING (seq) WHERE part = 1) GROUP BY 1 ORDER BY n DESC, min(seq) LIMIT 20),
          t AS (SELECT token AS name, count(*) AS n FROM seen GROUP BY 1 ORDER BY n DESC, min(struct_pack(a := part, b := seq, c := i)) LIMIT 30)
          SELECT to_json({'other_sources': (SELECT coalesce(list({'name': name, 'n': n} ORDER BY n DESC, name), []) FROM o),
            'review_sources': (SELECT coalesce(list({'name': name, 'n': n} ORDER BY n DESC, name), []) FROM r),
            'tokens': (SELECT coalesce(list({'name': name, 'n': n} ORDER BY n DESC, name), []) FROM t)})::VARCHAR AS report"""),
        "review_examples": sql(TO_PROVIDED, """
          SELECT final_decision AS kind, seq, source_id, title_en, llm_reason, row_number() OVER (PARTITION BY final_decision ORDER BY seq) AS item
          FROM provided WHERE final_decision IN ('review', 'reject') QUALIFY item <= 20"""),
        "category_scores": sql([RAW, NORM, SEARCH, SCORES], "SELECT seq, category, score FROM scores"),
        "classify": sql(ONLY_CLASSES, f"SELECT seq, category, category_reason, {joined('category_hits')} AS category_hits FROM classified"),
        "journal_groups": sql([*TO_KEYED, groups("shown")], """
          SELECT source_id, n_records, all_review, tier, tier_position, group_name, group_rank FROM ranked"""),
        "normalized_order": sql([RAW, NORM], "SELECT seq, row_number() OVER (ORDER BY published_at DESC, journal DESC, title_en DESC, seq) AS rank FROM norm"),
        "display_order": sql(TO_KEYED, f"SELECT seq, row_number() OVER (ORDER BY {ORDER}) AS display_rank FROM keyed"),
        "priority_groups": sql(TO_KEYED, f"""
          SELECT seq, {BUCKET} AS bucket, row_number() OVER (PARTITION BY {BUCKET} ORDER BY {ORDER}) AS bucket_rank FROM shown"""),
        "digest_order": sql(TO_KEYED, f"SELECT seq, {_digest_rank()} AS digest_rank FROM shown"),
        "clean_text": f"SELECT page_id, {clean('html')} AS cleaned FROM pages",
        "normalize_title": "SELECT page_id, " + title_form(clean("regexp_extract(html, '<title>([^<]*)</title>', 1)")) + " AS title_norm FROM pages",
        "canonical_doi": sql([RAW], "SELECT seq, CASE WHEN doi = '' THEN '' ELSE '10.1000/' || md5(abstract) END AS doi FROM raw"),
        "canonical_url": r"""
          WITH u AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS url FROM pages),
          p AS (SELECT page_id, split_part(url, '?', 1) AS base, list_filter(string_split(split_part(url, '?', 2), '&'),
            lambda x: x <> '' AND NOT starts_with(x, 'utm_')) AS params FROM u)
          SELECT page_id, base || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical_url FROM p""",
        "parse_datetime": sql([RAW], f"SELECT seq, {iso('published_ts')} AS published_at FROM raw"),
        "snippet": f"SELECT conv_id, turn, {_snippet('text', 120)} AS snippet FROM conversations",
        "author_line": sql([RAW], f"SELECT seq, {_authors('authors')} AS author_line FROM raw"),
        "glossary_apply": f"SELECT doc_id, {_glossary('text')} AS rewritten FROM documents",
        "glossary_trace": _trace(),
        "summary_text": "SELECT doc_id, " + _leading("replace(replace(text, '. ', '。'), ', ', '! ')") + " AS summary FROM documents",
        "sentence_cap": "SELECT conv_id, turn, " + _cap("replace(replace(text, '. ', '。'), ', ', '? ')", 4) + " AS capped FROM conversations",
        "template_summary": sql(ONLY_CLASSES, f"SELECT seq, {_template(labels, "CASE WHEN publication_stage = 'preprint' THEN '' ELSE abstract END")} AS summary_zh FROM classified"),
        "review_payload": "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.k') AS deep, NULL::VARCHAR AS missing FROM events",
        "localize": sql([RAW, NORM], f"SELECT seq, {_translated(q('译:'))} FROM norm"),
        "localize_fallback": sql([RAW, NORM], "SELECT seq, " + _translated("CASE WHEN length(title_en) > 600 OR length(abstract) > 600 THEN '再译:' ELSE '译:' END") + " FROM norm"),
        "translation_memory": sql([RAW, NORM, f"""
en AS (SELECT title_en AS t FROM norm WHERE tags[1] = 'en' UNION SELECT abstract FROM norm WHERE tags[1] = 'en'),
fr AS (SELECT title_en AS t FROM norm WHERE tags[1] = 'fr' UNION SELECT abstract FROM norm WHERE tags[1] = 'fr'),
marked AS (SELECT n.*, CASE WHEN title_en IN (SELECT t FROM en) AND abstract IN (SELECT t FROM en) THEN '译:'
  WHEN title_en IN (SELECT t FROM fr) AND abstract IN (SELECT t FROM fr) THEN '再译:' ELSE '' END AS mark FROM norm n)"""], f"""
          SELECT seq, title_zh, CASE WHEN mark = '' THEN {_template("'其他'", 'abstract')} ELSE summary_zh END AS summary_zh
          FROM (SELECT seq, journal, publication_stage, title_en, abstract, mark, {_translated('mark')} FROM marked)"""),
        "stream_digest": sql(TO_REVIEWED, "SELECT seq, relevance_status, category, llm_confidence, final_decision FROM reviewed"),
        "stream_dedupe": sql([RAW, NORM], f"SELECT min(seq) AS seq, {DKEY} AS dedupe_key FROM norm WHERE published_at <> '' GROUP BY 2"),
        "stream_undated": sql([RAW, NORM], "SELECT source_id, count(*) AS n FROM norm WHERE published_at = '' GROUP BY 1"),
        "stream_clusters": sql([RAW, NORM, KEYS, CLUSTERS], "SELECT seq, cluster FROM cluster", True),
        "stream_late": """
          WITH e AS (SELECT event_type, ts, day(ts) // 8 + (event_id % 10 = 0)::INT AS run FROM events),
          marks AS (SELECT run, max(max(ts)) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM e GROUP BY run),
          days AS (SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events) - INTERVAL 3 DAY,
            (SELECT date_trunc('day', max(ts)) FROM events) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS d),
          w AS (SELECT d - INTERVAL 8 HOUR AS s, d + INTERVAL 24 HOUR AS t FROM days),
          seen AS (SELECT event_type, s, t, coalesce(t <= mark - INTERVAL 1 DAY, false) AS late FROM e JOIN marks USING (run) JOIN w ON ts >= s AND ts < t)
          SELECT strftime(s, '%Y-%m-%dT%H:%M:%SZ') AS window_start, strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS window_end, event_type,
            count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS n_late
          FROM seen GROUP BY ALL""",
    }


def _digest_rank() -> str:
    tier = (
        f"CASE WHEN {POSITION} IS NOT NULL THEN 0 WHEN k_plant = 0 THEN 1 "
        f"WHEN category IN {some(D.deferred_categories)} THEN 3 ELSE 2 END"
    )
    return (
        "row_number() OVER (ORDER BY CASE publication_stage WHEN 'journal' THEN 0 WHEN 'preprint' THEN 1 ELSE 9 END, "
        f"(k_decision > 0)::INT, {tier}, coalesce({POSITION}, 0), lower(journal), {ORDER})"
    )
