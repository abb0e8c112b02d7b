"""The same results in SQL, computed by another engine by its own means.

Fixed word lists and patterns are the package's own, so a wrong entry in one of them would pass here;
everything else is written anew.
"""

from __future__ import annotations

from newsloom.functions.quality import BOILERPLATE, LOW_SOURCES, MARKET_REPORT, MID_SOURCES
from newsloom.functions.text import ACRONYMS, ENTITIES, PAGE_PARTS, STOP_PHRASES
from newsloom.operators.neardup import STOP_WORDS
from newsloom.operators.report import BENIGN_TERMS, RISK_PHRASES
from newsloom.plans.tables import CALENDAR, DOCS, MOMENTUM, SIGNAL, VOLUMES, dense_sql, mean_sql
from newsloom.sources.documents import LEGAL_PHRASES


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


TOPIC_V = VOLUMES.format(name="v", keys="topic")
RISK_V = VOLUMES.format(name="v", keys="risk, topic")
CAL_V = CALENDAR.format(of="v")
TOPIC_BASE = _with(SIGNAL, TOPIC_V, CAL_V, dense_sql("topic", "v_s"))
RISK_BASE = _with(SIGNAL, RISK_V, CAL_V, dense_sql("risk, topic", "v_s"))
STATS = f"""max_by(month, x * 1000000 - idx) AS peak_month, round(max(x), 2) AS peak, round({mean_sql('x')}, 2) AS mean_x, round(coalesce(regr_slope(x, idx), 0), 3) AS slope, round({MOMENTUM}, 2) AS mom"""
TOPIC_STATS = f"{TOPIC_BASE}, stats AS (SELECT topic, {STATS} FROM dense GROUP BY topic), totals AS (SELECT topic, CAST(sum(volume) AS BIGINT) AS total, sum(neg_articles) / greatest(1, sum(volume)) < 0.08 AND max(volume) < 5 AS benign FROM v GROUP BY topic)"
PAIR_STATS = f"{RISK_BASE}, pairs AS (SELECT risk, topic, {STATS} FROM dense GROUP BY risk, topic)"
AS_OF = "2001-08"
RISK_SUMS = "rm AS (SELECT risk, month, round(CAST(sum(CAST(intensity AS DECIMAL(18,4))) AS DOUBLE), 1) AS x0 FROM v_s GROUP BY risk, month)"
STATUS = f"""{_with(SIGNAL, RISK_V)}, {RISK_SUMS},
cal AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS idx, count(*) OVER () AS n FROM (SELECT DISTINCT month FROM v_s) WHERE month <> '{AS_OF}'),
ser AS (SELECT r.risk, idx, n, coalesce(x0, 0.0::DOUBLE) AS x FROM (SELECT DISTINCT risk FROM v_s) r CROSS JOIN cal c LEFT JOIN rm ON rm.risk = r.risk AND rm.month = c.month),
b AS (SELECT risk, max(n) AS n, max(x) AS top, max(CASE WHEN n - idx = 1 THEN x END) AS latest, median(CASE WHEN n - idx > 1 THEN x END) AS median, stddev_pop(CASE WHEN n - idx > 1 THEN x END) AS std,
  {mean_sql('CASE WHEN n - idx <= 3 THEN x END')} AS recent, {mean_sql('CASE WHEN n - idx BETWEEN 4 AND 6 THEN x END')} AS mid, {mean_sql('CASE WHEN n - idx > 3 THEN x END')} AS older FROM ser GROUP BY risk),
m AS (SELECT ser.risk, median(abs(x - b.median)) AS mad FROM ser JOIN b USING (risk) WHERE ser.n - idx > 1 GROUP BY ser.risk),
c AS (SELECT *, median + 1.5 * coalesce(CASE WHEN mad > 0 THEN mad END, CASE WHEN std > 0 THEN std END, 1.0) AS band, CASE WHEN n >= 6 THEN mid WHEN n > 3 THEN older ELSE median END AS prior FROM b LEFT JOIN m USING (risk)),
d AS (SELECT *, (recent - prior) / CASE WHEN prior > 0 THEN prior ELSE 1.0 END AS mom FROM c),
st AS (SELECT *, CASE WHEN n < 2 OR top <= 0 THEN 'Quiet' WHEN latest >= 10 AND (mom >= 0.5 OR (latest > band AND mom >= 0.15)) THEN 'Escalating' WHEN latest >= 10 AND latest > band THEN 'Elevated' WHEN mom <= -0.3 AND median > 0 THEN 'Cooling' ELSE 'Stable' END AS status FROM d)"""

HALVES = """halves AS (SELECT seq, CASE WHEN seq % 3 = 0 THEN '' ELSE link END AS link, title, source, day FROM signal)"""
KEY = "coalesce(nullif(lower(trim(link)), ''), lower(trim(title)) || '|' || lower(trim(source)))"

UNIT = "sqrt(sum(v * v)) + 1e-9"


def _mean_vectors(name: str, rows: str, keys: str) -> str:
    """Unit mean vectors of rows (keys, vector), as rows (keys, pos, v)."""
    g = f"{keys}, " if keys else ""
    on = f"USING ({keys})" if keys else "ON true"
    return f"""{name}_e AS (SELECT {g}unnest(vector) AS x, generate_subscripts(vector, 1) - 1 AS pos FROM {rows}),
{name}_m AS (SELECT {g}pos, CAST(sum(CAST(x AS DECIMAL(20,12))) AS DOUBLE) / count(*) AS v FROM {name}_e GROUP BY {g}pos),
{name}_n AS (SELECT {g}{UNIT} AS size FROM {name}_m {f'GROUP BY {keys}' if keys else ''}),
{name} AS (SELECT {', '.join(f'm.{k.strip()}' for k in keys.split(',')) + ', ' if keys else ''}pos, v / size AS v FROM {name}_m m JOIN {name}_n {on})"""


VEC = "vec AS (SELECT vec_id AS seq, CAST(label AS INTEGER) AS topic, CAST(label % 7 AS INTEGER) AS risk, CAST(vec_id % 7 AS INTEGER) AS term_risk, embedding AS vector FROM embeddings)"
HEAD = "head AS (SELECT topic, vector FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY seq) AS r FROM vec WHERE topic <> -1) WHERE r <= 40)"
CENTROIDS = _mean_vectors("cent", "head", "topic")
RISKV = _mean_vectors("rv", "(SELECT term_risk AS rid, vector FROM vec)", "rid")
ANCHOR = _mean_vectors("anchor", "(SELECT vector FROM vec WHERE seq % 4 = 0)", "")
SIMS = "sims AS (SELECT topic, rid, round(sum(cent.v * rv.v), 6) AS sim FROM cent JOIN rv USING (pos) GROUP BY topic, rid)"
VEC_BASE = _with(VEC, HEAD, CENTROIDS, RISKV, SIMS)
VEC_ART = "art AS (SELECT * REPLACE (CASE WHEN topic <> 5 THEN risk END AS risk), CASE WHEN seq % 10 <> 0 AND topic <> 8 THEN '2024-' || lpad(CAST(seq % 9 + 1 + CASE WHEN topic = 3 THEN 3 ELSE 0 END AS VARCHAR), 2, '0') END AS month, seq // 2 AS grp, (seq % 11) / 10.0::DOUBLE AS quality FROM vec)"
SEEN = "newest AS (SELECT min(month) AS start FROM (SELECT DISTINCT month FROM art WHERE month IS NOT NULL ORDER BY month DESC LIMIT 3)), seen AS (SELECT topic, min(month) AS first_seen, coalesce(min(month) >= (SELECT start FROM newest), false) AS is_new FROM art GROUP BY topic)"
GAPS = f"""{VEC_BASE}, {VEC_ART}, {SEEN},
own AS (SELECT DISTINCT topic, risk AS rid FROM art WHERE risk IS NOT NULL),
terms AS (SELECT seq, term_risk AS rid, unnest(vector) AS x, generate_subscripts(vector, 1) - 1 AS pos FROM vec),
tsim AS (SELECT topic, rid, round(sum(cent.v * x), 6) AS s FROM own JOIN terms USING (rid) JOIN cent USING (topic, pos) GROUP BY topic, rid, seq),
best AS (SELECT topic, max(s) AS s, max_by(rid, s * 1000 - rid * 0.0001) AS best_risk FROM tsim GROUP BY topic),
marked AS (SELECT sims.*, own.rid IS NOT NULL AS mine, coalesce(max(CASE WHEN own.rid IS NOT NULL THEN sim END) OVER (PARTITION BY sims.topic), 0.0::DOUBLE) AS top_own FROM sims LEFT JOIN own ON own.topic = sims.topic AND own.rid = sims.rid),
cal AS (SELECT topic, CASE WHEN bool_or(mine) THEN avg(CASE WHEN sim <= top_own THEN 1 ELSE 0 END) ELSE 1.0 END AS pct, max_by(rid, sim * 1000 - rid * 0.0001) AS top_rid, max_by(mine, sim * 1000 - rid * 0.0001) OR NOT bool_or(mine) AS top_mine FROM marked GROUP BY topic),
peak AS (SELECT topic, coalesce(max(n), any_value(rows)) AS peak FROM (SELECT topic, count(*) AS rows FROM art GROUP BY topic) LEFT JOIN (SELECT topic, month, count(DISTINCT grp) AS n FROM art WHERE month IS NOT NULL GROUP BY topic, month) USING (topic) GROUP BY topic),
tot AS (SELECT topic, count(*) AS total, round(CAST(sum(CAST(quality AS DECIMAL(18,6))) AS DOUBLE) / count(*), 3) AS quality FROM art GROUP BY topic)"""

TERMS = """words AS (SELECT source AS topic, list_filter(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'), lambda w: w NOT IN ('the', 'of', 'and')) AS w FROM documents),
terms AS (SELECT topic, unnest(w) AS term FROM words UNION ALL SELECT topic, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM words WHERE len(w) > 1),
tf AS (SELECT topic, term, count(*) AS n FROM terms GROUP BY topic, term),
size AS (SELECT topic, sum(n) AS size FROM tf GROUP BY topic), f AS (SELECT term, sum(n) AS f FROM tf GROUP BY term),
scored AS (SELECT topic, term, round(CAST(n AS DOUBLE) / CAST(size AS DOUBLE) * ln(1 + (SELECT CAST(sum(size) AS DOUBLE) / count(*) FROM size) / CAST(f AS DOUBLE)), 8) AS score FROM tf JOIN size USING (topic) JOIN f USING (term))"""

_low = "|".join(LOW_SOURCES)


# Compilations: an action is the text from its name to the next one's, a section header before that among it.
ACTIONS = """WITH c AS (SELECT c_custkey AS k, {doc} AS doc, {name} AS name FROM customer),
o AS (SELECT *, lead(k) OVER (PARTITION BY doc ORDER BY k) % {every} = 0 AS headed, bool_or(k % {every} = 0) OVER (PARTITION BY doc ORDER BY k) AS sectioned FROM c),
body AS (SELECT doc, name, CASE WHEN sectioned THEN '{header}' ELSE 'disciplinary action' END AS section,
  rtrim(name || ' was fined. ' || repeat('It did so again. ', k % 12)) || CASE WHEN headed THEN ' {header}' ELSE '' END AS body FROM o)"""


def _quality(title: str, summary: str, source: str) -> str:
    t, s, g = f"coalesce({title}, '')", f"trim(coalesce({summary}, ''))", f"lower(trim(coalesce({source}, '')))"
    boiler, market = BOILERPLATE.replace("'", "''"), MARKET_REPORT.replace("'", "''")
    return f"""round(greatest(0, 1000 - (CASE WHEN regexp_matches({g}, '{_low}') THEN 500 WHEN {g} IN ({_list(MID_SOURCES)}) THEN 150 ELSE 0 END
 + CASE WHEN regexp_matches({t}, '{boiler}') THEN 400 ELSE 0 END + CASE WHEN regexp_matches({t}, '{market}') THEN 250 ELSE 0 END
 + CASE WHEN {s} = '' THEN 300 WHEN length({s}) < 120 THEN 100 ELSE 0 END
 + CASE WHEN contains(lower({s}), 'legal disclaimer') OR contains(lower({s}), 'provides this news content') THEN 300 ELSE 0 END)) / 1000.0::DOUBLE, 3)"""


_caps = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ACRONYMS.items())
_legal = "|".join(p.replace("-", "\\-").replace("'", "''") for p in LEGAL_PHRASES)
_parse = "coalesce(try_strptime({x}, '%B %d, %Y'), try_strptime({x}, '%b %d, %Y'), try_strptime({x}, '%Y-%m-%d'))"
_turn = "(turn * 2 + CASE WHEN role = 'assistant' THEN 1 ELSE 0 END)"
_tokens = f"list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z]{{3,}}')), lambda w: w NOT IN ({_list(STOP_WORDS)}))"

_page = "html"
for _tag in PAGE_PARTS:
    _page = f"regexp_replace({_page}, '(?is)<{_tag}(?:\\s[^>]*)?>.*?</{_tag}>', ' ', 'g')"
_page = f"regexp_replace(regexp_replace({_page}, '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g')"
for _name, _char in ENTITIES:
    _page = f"replace({_page}, '{_name}', '{_char.replace(chr(39), chr(39) * 2)}')"
_page = f"trim(regexp_replace({_page}, '\\s+', ' ', 'g'))"

SQL: dict[str, str] = {
    "topic_month_intensity": f"{_with(SIGNAL, TOPIC_V)} SELECT topic, month, volume, neg_articles, round(share, 4) AS neg_share, round(mean, 4) AS avg_compound, round(volume / CAST(sum(volume) OVER (PARTITION BY month) AS DOUBLE), 5) AS share_of_coverage, round(severity, 6) AS severity, intensity FROM v_s",
    "topic_share_of_coverage": f"{_with(SIGNAL, TOPIC_V)} SELECT month, round(CAST(sum(CAST(s AS DECIMAL(18,5))) AS DOUBLE), 3) AS share, max(s) AS top_share, count(*) AS topics FROM (SELECT month, round(volume / CAST(sum(volume) OVER (PARTITION BY month) AS DOUBLE), 5) AS s FROM v_s) GROUP BY month",
    "risk_topic_month_intensity": f"{PAIR_STATS} SELECT risk, topic, month, volume, intensity, peak AS peak_intensity, mom AS momentum FROM v_s JOIN pairs USING (risk, topic)",
    "topic_trend_meta": f"{TOPIC_STATS}, rl AS (SELECT topic, string_agg(CAST(risk AS VARCHAR), ', ' ORDER BY risk) AS r FROM (SELECT DISTINCT topic, risk FROM signal) GROUP BY topic) SELECT topic, total AS \"TOTAL_ARTICLES\", peak_month AS \"PEAK_MONTH\", peak AS \"PEAK_INTENSITY\", mean_x AS \"MEAN_INTENSITY\", slope AS \"TREND_SLOPE\", mom AS \"MOMENTUM\", benign AS \"IS_BENIGN\", r AS \"RISK_IDS\" FROM stats JOIN totals USING (topic) JOIN rl USING (topic)",
    "incremental_trends": f'{TOPIC_STATS} SELECT topic, month, volume, round(volume / CAST(sum(volume) OVER (PARTITION BY month) AS DOUBLE), 5) AS share_of_coverage, intensity, slope AS "TREND_SLOPE", mom AS "MOMENTUM", totals.total AS "TOTAL_ARTICLES" FROM v_s JOIN stats USING (topic) JOIN totals USING (topic)',
    "topic_slope": f'{TOPIC_STATS} SELECT topic, slope AS "TREND_SLOPE" FROM stats',
    "topic_momentum": f'{TOPIC_STATS} SELECT topic, mom AS "MOMENTUM" FROM stats',
    "topic_benign_flag": f"{_with(SIGNAL)}, f AS (SELECT topic * 10000 + CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) AS topic, month, count(*) AS v, sum(CASE WHEN k < 0 THEN 1 ELSE 0 END) AS n FROM signal WHERE topic <> -1 GROUP BY 1, 2) SELECT topic, sum(n) / greatest(1, sum(v)) < 0.08 AND max(v) < 5 AS benign FROM f GROUP BY topic",
    "rising_topics_topk": f'{TOPIC_STATS} SELECT topic, mom AS "MOMENTUM", peak AS "PEAK_INTENSITY" FROM stats JOIN totals USING (topic) WHERE NOT benign ORDER BY mom DESC, topic LIMIT 10',
    "benign_topics_dropped": f"{TOPIC_STATS} SELECT topic, month, volume FROM v WHERE topic IN (SELECT topic FROM stats WHERE mom >= 0)",
    "calendar_spine": f"{TOPIC_BASE} SELECT topic, month, idx, x AS intensity FROM dense",
    "trend_series_payload": f"{TOPIC_BASE} SELECT topic, CAST(count(*) AS INTEGER) AS n, string_agg(CAST(CAST(round(x * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY idx) AS hundredths FROM dense GROUP BY topic",
    "risk_month_sum": f"{_with(SIGNAL, RISK_V, RISK_SUMS)} SELECT risk, month, x0 AS intensity FROM rm",
    "risk_status": f"{STATUS} SELECT risk, status, CASE WHEN status <> 'Quiet' THEN round(latest, 1) END AS latest, CASE WHEN status <> 'Quiet' THEN round(median, 1) END AS median, CASE WHEN status <> 'Quiet' THEN round(band, 1) END AS band_hi, CASE WHEN status <> 'Quiet' THEN round(mom * 100, 0) END AS mom_pct FROM st",
    "risk_status_counts": f"{STATUS} SELECT status, count(*) AS n FROM st GROUP BY status",
    "risk_status_tiles": f"{STATUS} SELECT row_number() OVER (ORDER BY list_position(['Escalating', 'Elevated', 'Stable', 'Cooling', 'Quiet'], status), coalesce(CASE WHEN status <> 'Quiet' THEN round(latest, 1) END, 0.0) DESC, risk) AS place, risk, status FROM st",
    "risk_drivers_topk": f"{_with(SIGNAL, RISK_V)} SELECT risk, rank, topic, intensity FROM (SELECT *, row_number() OVER (PARTITION BY risk ORDER BY intensity DESC, topic) AS rank FROM v_s WHERE month = (SELECT max(month) FROM v_s WHERE month <> '{AS_OF}')) WHERE rank <= 3 AND intensity > 0",
    "recent_window": f"{_with(SIGNAL)} SELECT topic, count(*) AS n, min(day) AS first_day FROM signal WHERE ts >= (SELECT max(ts) FROM signal) - INTERVAL 90 DAY GROUP BY topic",
    "corpus_upsert_dedup": f"{_with(SIGNAL, HALVES)} SELECT seq, link FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY seq % 2, seq) AS r FROM halves) WHERE r = 1",
    "corpus_upsert_by_title": f"{_with(SIGNAL, HALVES)} SELECT seq, title FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(title)) || '|' || day ORDER BY seq % 2, seq) AS r FROM halves) WHERE r = 1",
    "renumber_after_dedup": f"{_with(SIGNAL, HALVES)} SELECT seq, row_number() OVER (ORDER BY seq % 2, seq) - 1 AS idx FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY seq % 2, seq) AS r FROM halves) WHERE r = 1",
    "seen_link_anti_join": f"{_with(SIGNAL, HALVES)} SELECT seq, link FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(link)) ORDER BY seq) AS r FROM halves WHERE seq % 2 = 1 AND link <> '' AND lower(trim(link)) NOT IN (SELECT lower(trim(link)) FROM halves WHERE seq % 2 = 0)) WHERE r = 1",
    "lane_filter_counts": "SELECT event_type AS lane, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT event_type, count(*) FROM events WHERE event_type = 'click' GROUP BY 1",
    "age_cutoff": f"{_with(SIGNAL)} SELECT month, count(*) AS n FROM signal WHERE day >= '2000-01-01' GROUP BY month",
    "fetch_tallies": f"{_with(DOCS)} SELECT count(*) FILTER (length(summary) >= 400) AS kept, count(*) FILTER (length(summary) < 400) AS thin, CAST(0 AS BIGINT) AS old FROM docs",
    "backfill_merge": f"{_with(DOCS)} SELECT seq, md5(s) AS summary, CAST(length(s) AS INTEGER) AS n FROM (SELECT seq, CASE WHEN seq % 10 = 5 AND length('x' || summary) >= 600 THEN substr('x' || summary, 1, 900) ELSE summary END AS s FROM docs)",
    "backfill_targets": f"{_with(DOCS)} SELECT seq FROM docs WHERE length(summary) < 500",
    "corpus_stats": f"{_with(SIGNAL)} SELECT count(*) AS total, count(DISTINCT source) AS sources, count(DISTINCT risk) AS risks, min(day) AS first_date, max(day) AS last_date FROM signal",
    "quality_score": f"{_with(DOCS)} SELECT seq, {_quality('title', 'summary', 'source')} AS quality FROM docs",
    "quality_score_titles": f"SELECT p_partkey, {_quality('t', 's', 'o')} AS quality FROM (SELECT p_partkey, p_name || ' market size $' || p_size AS t, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_type END AS s, ['fool', 'prnewswire', 'reuters', 'PR.cision.com'][p_size % 4 + 1] AS o FROM part)",
    "document_text": f"{_with(DOCS)} SELECT seq, md5(t) AS md5, CAST(length(t) AS INTEGER) AS n FROM (SELECT seq, trim(regexp_replace(coalesce(title, '') || '. ' || coalesce(summary, ''), '\\s+', ' ', 'g')) AS t FROM docs)",
    "block_key_groups": "SELECT substr(trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g'), '\\s+', ' ', 'g')), 1, 40) AS block, count(*) AS n FROM documents GROUP BY 1",
    "exact_text_dups": "SELECT min(doc_id) AS first, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1",
    "source_slug": "SELECT page_id, CASE WHEN len(string_split(h, '.')) > 2 THEN string_split(h, '.')[-2] ELSE h END AS source FROM (SELECT page_id, replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'www.', '') AS h FROM pages)",
    "page_title_extract": "SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g')) AS title FROM pages",
    "sentiment_labels": f"{_with(SIGNAL)} SELECT CASE WHEN k / 5.0 >= 0.05 THEN 'Positive' WHEN k / 5.0 <= -0.05 THEN 'Negative' ELSE 'Neutral' END AS label, count(*) AS n FROM signal GROUP BY 1",
    "date_parse_chain": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
    "page_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 OR o_orderdate >= '2000-01-01' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
    "normal_titles": "SELECT p_partkey, trim(lower(p_name), ' .:-—|') AS title FROM part",
    "title_keywords": f"{_with(DOCS)}, w AS (SELECT seq, unnest(f) AS w, generate_subscripts(f, 1) AS i FROM (SELECT seq, regexp_extract_all(lower(summary), '[a-z]{{4,}}') AS f FROM docs)), c AS (SELECT seq, w, count(*) AS n, min(i) AS i FROM w GROUP BY seq, w), r AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY n DESC, i) AS r FROM c) SELECT d.seq, coalesce(string_agg(w, ',' ORDER BY r), '') AS keywords FROM docs d LEFT JOIN (SELECT * FROM r WHERE r <= 5) x ON x.seq = d.seq GROUP BY d.seq",
    "keyword_filter": f"{_with(DOCS)}, p AS (SELECT seq, unnest(f) AS w, generate_subscripts(f, 1) AS i FROM (SELECT seq, regexp_split_to_array(text, '[\\s,.]+') AS f FROM docs)), k AS (SELECT seq, min(i) AS i, x FROM (SELECT seq, i, trim(lower(w)) AS x FROM p) WHERE length(x) >= 3 AND regexp_matches(x, '[a-z]') AND x NOT IN ({_list(STOP_PHRASES)}) GROUP BY seq, x) SELECT d.seq, coalesce(string_agg(x, ',' ORDER BY i), '') AS keywords FROM docs d LEFT JOIN k ON k.seq = d.seq GROUP BY d.seq",
    "risk_id_normalise": "SELECT n_name, n_nationkey AS risk FROM nation",
    "date_windows": "SELECT strftime(d, '%Y-%m-%d') AS window_start, strftime(least(d + INTERVAL 44 DAY, b), '%Y-%m-%d') AS window_end FROM (SELECT unnest(generate_series(a, b, INTERVAL 45 DAY)) AS d, b FROM (SELECT date_trunc('day', min(o_orderdate)) AS a, date_trunc('day', max(o_orderdate)) AS b FROM orders))",
    "fetch_plan": """WITH o AS (SELECT c_nationkey AS scan, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
c AS (SELECT c_nationkey AS scan, c_mktsegment AS category, min(c_custkey) AS i FROM customer GROUP BY 1, 2),
w AS (SELECT scan, unnest(generate_series(a, b, INTERVAL 14 DAY)) AS d FROM o)
SELECT scan, strftime(d, '%Y-%m-%d') AS window_start, category, page FROM (SELECT *, row_number() OVER (PARTITION BY scan ORDER BY d, i, page) AS k FROM w JOIN c USING (scan) CROSS JOIN (SELECT unnest(CAST([1, 2] AS BIGINT[])) AS page)) WHERE k <= 25""",
    "phrase_lane": "SELECT doc_id, 'lex:' || CASE WHEN contains(lower(text), 'general public license') THEN 'general public license' WHEN contains(lower(text), 'licensed under') THEN 'licensed under' ELSE 'all rights reserved' END AS category FROM documents WHERE contains(lower(text), 'general public license') OR contains(lower(text), 'licensed under') OR contains(lower(text), 'all rights reserved')",
    "cache_keys": "SELECT doc_id, sha1('m' || chr(0) || text) AS key FROM documents",
    "cache_misses": "SELECT DISTINCT sha1(text) AS key FROM documents WHERE doc_id % 2 = 1 AND sha1(text) NOT IN (SELECT sha1(text) FROM documents WHERE doc_id % 2 = 0)",
    "full_text_fallback": f"{_with(DOCS)} SELECT seq, md5(CASE WHEN length(s) >= 800 THEN s ELSE title END) AS md5 FROM (SELECT seq, title, substr(trim(regexp_replace(summary, '\\s+', ' ', 'g')), 1, 2000) AS s FROM docs)",
    "extraction_hit_rate": f"{_with(DOCS)} SELECT lang, round(avg(CASE WHEN length(summary) >= 1000 THEN 1 ELSE 0 END), 4) AS hit_rate, count(*) AS n FROM docs GROUP BY lang",
    "description_cleanup": "SELECT p_partkey, 'Coverage of ' || p_name || '.' AS description FROM part",
    "search_highlight": "SELECT p_partkey, regexp_replace(p_name, '(an)', '<mark>\\1</mark>', 'gi') AS marked FROM part",
    "jaccard_containment_pairs": f"WITH t AS (SELECT conv_id AS g, conv_id * 100 + {_turn} AS seq, {_tokens} AS tok FROM conversations), e AS (SELECT g, seq, len(tok) AS n, unnest(tok) AS w FROM t), p AS (SELECT x.seq AS a, y.seq AS b, x.n AS na, y.n AS nb, count(*) AS c FROM e x JOIN e y ON x.g = y.g AND x.w = y.w AND x.seq < y.seq GROUP BY ALL) SELECT a, b, round(c / CAST(na + nb - c AS DOUBLE), 4) AS jaccard, round(c / CAST(least(na, nb) AS DOUBLE), 4) AS containment FROM p WHERE round(c / CAST(na + nb - c AS DOUBLE), 4) >= 0.2 OR round(c / CAST(least(na, nb) AS DOUBLE), 4) >= 0.35",
    "page_text": f"WITH t AS (SELECT page_id, {_page} AS t FROM pages) SELECT page_id, md5(t) AS md5, CAST(length(t) AS INTEGER) AS n FROM t",
    "best_headlines": f"{_with(DOCS)}, l AS (SELECT source, list(title ORDER BY seq) AS ts FROM docs GROUP BY source), f AS (SELECT source, ts, list_filter(ts, lambda t: length(t) BETWEEN 15 AND 140) AS fit FROM l) SELECT source, coalesce(list_filter(fit, lambda t: contains(lower(t), 'qu') OR contains(lower(t), 'ing'))[1], fit[1], substr(ts[1], 1, 140), '') AS headline FROM f",
    "thin_text_reject": f"{_with(DOCS)} SELECT lang, count(*) AS n FROM docs WHERE length(summary) >= 150 GROUP BY lang",
    "link_sample": "SELECT least(100, count(DISTINCT url)) AS n, least(100, count(DISTINCT url)) AS links FROM pages",
    "natural_id_order": "SELECT id, row_number() OVER (PARTITION BY length(id) ORDER BY id) AS place FROM (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer)",
    "card_orders": f"""{_with(SIGNAL)}, c AS (SELECT topic, count(*) AS n, count(DISTINCT risk) AS r, round(CAST(sum(CAST(k / 5.0 AS DECIMAL(18,8))) AS DOUBLE) / count(*), 4) AS m FROM signal GROUP BY topic)
SELECT 'count' AS by, topic, row_number() OVER (ORDER BY n DESC, topic) AS place FROM c UNION ALL SELECT 'risks', topic, row_number() OVER (ORDER BY r DESC, n DESC, topic) FROM c
UNION ALL SELECT 'positive', topic, row_number() OVER (ORDER BY m DESC, n DESC, topic) FROM c UNION ALL SELECT 'negative', topic, row_number() OVER (ORDER BY m, n DESC, topic) FROM c""",
    "gap_payload": f'{GAPS} SELECT topic AS id, coalesce(CAST(best_risk AS VARCHAR), \'\') AS "bestFitRisk", coalesce(CAST(CASE WHEN NOT top_mine THEN top_rid END AS VARCHAR), \'\') AS "betterFitRisk", round(round(greatest(0, coalesce(s, 0)), 4), 3) AS fit, round(round(1 - pct, 4), 3) AS gap, round(round(1 - greatest(0, coalesce(s, 0)), 4), 3) AS "gapRaw", round(round(pct, 4), 3) AS "fitPercentile", first_seen AS "FIRST_SEEN", is_new AS "IS_NEW", peak AS "PEAK_VOLUME", quality, round(round(round(1 - pct, 4) * ln(1 + peak) * CASE WHEN is_new THEN 1.5 ELSE 1.0 END, 4), 3) AS score FROM cal LEFT JOIN best USING (topic) JOIN seen USING (topic) JOIN peak USING (topic) JOIN tot USING (topic)',
    "vector_centroids": f"{_with(VEC, HEAD, CENTROIDS)} SELECT topic, CAST(pos AS INTEGER) AS pos, round(v, 4) AS v FROM cent",
    "cosine_matrix_topk": f"{VEC_BASE} SELECT topic, rank, rid AS risk, round(sim, 4) AS sim FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY sim DESC, rid) AS rank FROM sims) WHERE rank <= 3",
    "topic_gap_scores": f'{GAPS} SELECT topic, best_risk, round(greatest(0, coalesce(s, 0)), 4) AS "FIT", round(1 - greatest(0, coalesce(s, 0)), 4) AS "GAP_RAW", round(pct, 4) AS "FIT_PERCENTILE", round(1 - pct, 4) AS "GAP", CASE WHEN NOT top_mine THEN top_rid END AS better_risk, first_seen AS "FIRST_SEEN", is_new AS "IS_NEW", peak AS "PEAK_VOLUME", total AS "TOTAL_ARTICLES", quality AS "AVG_QUALITY", round(round(1 - pct, 4) * ln(1 + peak) * CASE WHEN is_new THEN 1.5 ELSE 1.0 END, 4) AS "EMERGING_GAP_SCORE" FROM cal LEFT JOIN best USING (topic) JOIN seen USING (topic) JOIN peak USING (topic) JOIN tot USING (topic)',
    "topic_gap_quality_having": f'{_with(VEC, VEC_ART)}, tot AS (SELECT topic, round(CAST(sum(CAST(quality AS DECIMAL(18,6))) AS DOUBLE) / count(*), 3) AS q FROM art GROUP BY topic) SELECT topic, q AS "AVG_QUALITY" FROM tot WHERE q >= 0.5',
    "novelty_scores": f'{VEC_BASE} SELECT topic, max_by(rid, sim * 1000 - rid * 0.0001) AS risk, round(max(sim), 4) AS sim, round(1 - max(sim), 4) AS "NOVELTY" FROM sims GROUP BY topic',
    "anchor_relevance": f'{_with(VEC, HEAD, CENTROIDS, ANCHOR)} SELECT topic, round(greatest(0.0, sum(cent.v * anchor.v)), 4) AS "RELEVANCE" FROM cent JOIN anchor USING (pos) GROUP BY topic',
    "relevance_bands": f"{_with(VEC, HEAD, CENTROIDS, ANCHOR)} SELECT topic, CASE WHEN r >= 0.3 THEN 'high' WHEN r >= 0.15 THEN 'moderate' ELSE 'low' END AS band FROM (SELECT topic, round(greatest(0.0, sum(cent.v * anchor.v)), 4) AS r FROM cent JOIN anchor USING (pos) GROUP BY topic)",
    "discovery_ranking": f"{VEC_BASE}, {VEC_ART}, {SEEN}, nov AS (SELECT topic, round(1 - max(sim), 4) AS novelty FROM sims GROUP BY topic), tot AS (SELECT topic, count(DISTINCT grp) AS stories, round(CAST(sum(CAST(quality AS DECIMAL(18,6))) AS DOUBLE) / count(*), 3) AS quality FROM art GROUP BY topic) SELECT topic, stories, quality, round(novelty * ln(1 + stories) * quality * CASE WHEN is_new THEN 1.3 ELSE 1.0 END, 4) AS score FROM nov JOIN tot USING (topic) JOIN seen USING (topic)",
    "candidate_tiers": f"{_with(VEC, HEAD, CENTROIDS, RISKV, SIMS, ANCHOR)}, rel AS (SELECT topic, round(greatest(0.0, sum(cent.v * anchor.v)), 4) AS r FROM cent JOIN anchor USING (pos) GROUP BY topic), nov AS (SELECT topic, round(1 - max(sim), 4) AS n FROM sims GROUP BY topic) SELECT topic, CASE WHEN len(list_filter([{_list(BENIGN_TERMS)}], lambda t: contains(lower(['Football Season', 'Cyber Fraud', 'Box office hits', 'Bank runs'][topic % 4 + 1] || ' '), t))) > 0 THEN 'benign' ELSE 'meaningful' END AS tier, round(n * r, 4) AS combined FROM rel JOIN nov USING (topic)",
    "scatter_encoding": f"{_with(VEC, HEAD, CENTROIDS, RISKV, SIMS, ANCHOR)}, rel AS (SELECT topic, round(greatest(0.0, sum(cent.v * anchor.v)), 4) AS r FROM cent JOIN anchor USING (pos) GROUP BY topic), nov AS (SELECT topic, round(1 - max(sim), 4) AS n FROM sims GROUP BY topic) SELECT topic, max(n) OVER () AS x_max, max(r) OVER () AS y_max, n >= max(n) OVER () / 2 AND r >= max(r) OVER () / 2 AS sweet, row_number() OVER (ORDER BY n * r DESC, topic) <= 6 AS labelled FROM rel JOIN nov USING (topic)",
    "representative_docs": f"{_with(VEC, _mean_vectors('cent', 'vec', 'topic'))}, e AS (SELECT seq, topic, unnest(vector) AS x, generate_subscripts(vector, 1) - 1 AS pos FROM vec), s AS (SELECT seq, topic, round(sum(x * v), 6) AS sim FROM e JOIN cent USING (topic, pos) GROUP BY seq, topic) SELECT topic, rank, seq FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY sim DESC, seq) AS rank FROM s) WHERE rank <= 3",
    "pairwise_cosine": f"{_with(VEC)}, e AS (SELECT seq, unnest(vector) AS x, generate_subscripts(vector, 1) AS pos FROM vec), s AS (SELECT a.seq AS q, b.seq, round(sum(CAST(a.x AS DOUBLE) * b.x), 4) AS sim FROM e a JOIN e b USING (pos) WHERE a.seq % 20 = 0 AND a.seq <> b.seq GROUP BY 1, 2) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, seq) AS rank FROM s) WHERE rank <= 5",
    "distinct_stories": f"{_with(SIGNAL)} SELECT topic, count(DISTINCT grp) AS stories FROM signal GROUP BY topic",
    "peak_distinct_month": f"{_with(SIGNAL)} SELECT topic, max(n) AS peak FROM (SELECT topic, month, count(DISTINCT grp) AS n FROM signal WHERE topic <> -1 GROUP BY topic, month) GROUP BY topic",
    "dominant_sentiment": f"{_with(SIGNAL)} SELECT topic, s AS sentiment FROM (SELECT topic, s, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, min(seq), s) AS r FROM (SELECT *, CASE WHEN k > 0 THEN 'Positive' WHEN k < 0 THEN 'Negative' ELSE 'Neutral' END AS s FROM signal) GROUP BY topic, s) WHERE r = 1",
    "topic_risk_lists": f"{_with(SIGNAL)} SELECT topic, string_agg(CAST(risk AS VARCHAR), ', ' ORDER BY risk) AS risks, count(*) AS n FROM (SELECT DISTINCT topic, risk FROM signal) GROUP BY topic",
    "topic_summary": f"""{_with(SIGNAL)}, l AS (SELECT *, CASE WHEN k > 0 THEN 'Positive' WHEN k < 0 THEN 'Negative' ELSE 'Neutral' END AS s FROM signal),
dom AS (SELECT topic, s FROM (SELECT topic, s, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, min(seq), s) AS r FROM l GROUP BY topic, s) WHERE r = 1),
ent AS (SELECT topic, string_agg(source, ', ' ORDER BY r) AS e FROM (SELECT topic, source, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, min(seq), source) AS r FROM l GROUP BY topic, source) WHERE r <= 8 GROUP BY topic)
SELECT l.topic, count(*) AS "ARTICLE_COUNT", count(DISTINCT grp) AS "DISTINCT_STORIES", count(DISTINCT risk) AS "DISTINCT_RISK_COUNT", round(CAST(sum(CAST(k / 5.0 AS DECIMAL(18,8))) AS DOUBLE) / count(*), 4) AS "AVG_SENTIMENT_COMPOUND", round(CAST(sum(CAST(quality AS DECIMAL(18,8))) AS DOUBLE) / count(*), 4) AS "AVG_QUALITY", any_value(dom.s) AS "DOMINANT_SENTIMENT", any_value(e) AS "TOP_ENTITIES" FROM l JOIN dom USING (topic) JOIN ent USING (topic) GROUP BY l.topic""",
    "top_entities": f"{_with(SIGNAL)} SELECT topic, rank, entity, n FROM (SELECT topic, source AS entity, count(*) AS n, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, min(seq), source) AS rank FROM signal GROUP BY topic, source) WHERE rank <= 8",
    "ctfidf_keywords": f"{_with(TERMS)} SELECT topic, rank, term, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, term) AS rank FROM scored) WHERE rank <= 5",
    "first_filled_value": f"{_with(DOCS)} SELECT source, coalesce(min_by(t, seq) FILTER (t IS NOT NULL), '') AS title FROM (SELECT source, seq, CASE WHEN seq % 3 <> 0 AND trim(title) <> '' THEN title END AS t FROM docs) GROUP BY source",
    "topic_propagation": f"{_with(SIGNAL)}, r AS (SELECT grp, CAST(min(seq) % 7 AS INTEGER) AS t FROM signal GROUP BY grp HAVING grp % 5 <> 0) SELECT coalesce(t, -1) AS topic, count(*) AS n FROM signal LEFT JOIN r USING (grp) GROUP BY 1",
    "topic_text_lookup": f"{_with(SIGNAL)} SELECT coalesce(n_name, '') AS title, CASE WHEN n_name IS NULL THEN '' ELSE 'd' END AS description, count(*) AS n FROM signal LEFT JOIN nation ON topic = n_nationkey GROUP BY 1, 2",
    "topic_descriptions": f"""{_with(SIGNAL)}, l AS (SELECT *, CASE WHEN k > 0 THEN 'positive' WHEN k < 0 THEN 'negative' ELSE 'neutral' END AS s FROM signal WHERE topic <> -1),
dom AS (SELECT topic, s FROM (SELECT topic, s, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, min(seq), s) AS r FROM l GROUP BY topic, s) WHERE r = 1),
rk AS (SELECT topic, list_sort(list_distinct(list(risk))) AS rs, count(*) AS n FROM l GROUP BY topic)
SELECT topic, 'Coverage of alpha, beta and t' || topic || ', with mostly ' || s || ' sentiment (' || n || ' articles). For example: "A headline." Linked to ' || array_to_string(list_transform(rs[1:3], lambda r: 'risk ' || r), '; ') || CASE WHEN len(rs) > 3 THEN '; +' || (len(rs) - 3) || ' more' ELSE '' END || '.' AS description FROM rk JOIN dom USING (topic)""",
    "topic_titles": f"SELECT p_partkey, array_to_string(list_transform(list_filter(regexp_split_to_array(p_name, '\\s+'), lambda w: w <> ''), lambda w: coalesce(CASE lower(w) {_caps} END, CASE WHEN regexp_matches(w, '\\d') THEN w END, upper(w[1:1]) || w[2:])), ' ') AS title FROM part",
    "articles_per_topic_topn": f"{_with(SIGNAL)} SELECT topic, rank, seq FROM (SELECT topic, seq, row_number() OVER (PARTITION BY topic ORDER BY ts DESC NULLS LAST, seq) AS rank FROM signal) WHERE rank <= CASE WHEN topic = -1 THEN 40 ELSE 60 END",
    "best_article_per_story": f"{_with(SIGNAL)}, o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic, grp ORDER BY quality DESC, seq) AS r FROM signal WHERE topic <> -1) WHERE r = 1) SELECT topic, rank, seq FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY quality DESC, seq) AS rank FROM o) WHERE rank <= 25",
    "stories_by_date": f"{_with(SIGNAL)} SELECT topic, rank, seq FROM (SELECT topic, seq, row_number() OVER (PARTITION BY topic ORDER BY day DESC, seq) AS rank FROM signal)",
    "facet_search": f"{_with(SIGNAL)} SELECT topic, count(*) AS \"ARTICLE_COUNT\" FROM signal WHERE topic <> -1 AND contains('brand ' || topic || ' topic ' || topic, 'topic 1') GROUP BY topic HAVING bool_or(risk = 3)",
    "sentiment_histogram": f"{_with(SIGNAL)} SELECT CASE WHEN k > 0 THEN 'Positive' WHEN k < 0 THEN 'Negative' ELSE 'Unknown' END AS sentiment, count(*) AS n FROM signal GROUP BY 1",
    "topics_per_risk": f"{_with(SIGNAL)} SELECT risk, count(DISTINCT topic) AS topics FROM signal WHERE topic <> -1 GROUP BY risk",
    "top_topics_per_risk": f"{PAIR_STATS}, t AS (SELECT *, row_number() OVER (PARTITION BY risk ORDER BY peak DESC, topic) AS rank FROM pairs) SELECT risk, rank, topic, peak AS peak_intensity, greatest(0.0::DOUBLE, max(mom) OVER (PARTITION BY risk)) AS risk_momentum, greatest(0.0::DOUBLE, max(peak) OVER (PARTITION BY risk)) AS risk_peak FROM t WHERE rank <= 5",
    "topic_payload": f"{_with(SIGNAL)} SELECT topic, count(*) AS n, (SELECT seq FROM signal i WHERE i.topic = s.topic ORDER BY ts DESC, seq LIMIT 1) AS newest, CAST(least(count(*), CASE WHEN topic = -1 THEN 2 ELSE 3 END) AS INTEGER) AS listed FROM signal s GROUP BY topic",
    "report_order": "SELECT n_name FROM nation ORDER BY CASE n_name WHEN 'JAPAN' THEN 1 WHEN 'CHINA' THEN 2 ELSE 3 END, n_name",
    "display_counts": f"{_with(SIGNAL)} SELECT risk, CAST(CASE WHEN count(*) >= 1000 THEN round(count(*), -2) ELSE count(*) END AS BIGINT) AS shown FROM signal GROUP BY risk",
    "taxonomy_union": "SELECT 'ENT' AS namespace, n_regionkey AS risk, min_by(n_name, n_nationkey) AS label, string_agg(n_name, '|' ORDER BY n_nationkey) AS terms FROM nation GROUP BY n_regionkey UNION ALL SELECT 'EMG', r_regionkey, r_name, r_name FROM region",
    "asof_carry_forward": f"WITH t AS (SELECT conv_id, {_turn} AS pos, role, CAST(length(text) AS INTEGER) AS n FROM conversations) SELECT conv_id, pos, n, asked FROM (SELECT *, last_value(CASE WHEN role = 'user' THEN n END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS asked FROM t) WHERE role = 'assistant'",
    "segment_split": f"WITH t AS (SELECT conv_id, {_turn} AS o, role, length(replace(text, '@', '')) + length(role) + 3 AS len FROM conversations), c AS (SELECT *, sum(len + 1) OVER (PARTITION BY conv_id ORDER BY o) - len - 1 AS pos, lead(o) OVER (PARTITION BY conv_id ORDER BY o) AS nxt FROM t) SELECT conv_id, CAST(pos AS BIGINT) AS pos, role, CAST(len + CASE WHEN nxt IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n FROM c",
    "listing_links": "SELECT DISTINCT page_id AS doc, link, CASE WHEN link = '/last' THEN '2024-02-07' ELSE '2024-01-05' END AS date FROM (SELECT page_id, unnest(regexp_extract_all(html || '<a href=\"/last\">', '<a href=\"(/[^\"]*)\"', 1)) AS link FROM pages)",
    "legal_scrub": f"SELECT s_suppkey, trim(regexp_replace(regexp_replace(regexp_replace('The Commission finds , pursuant to Section 5, that ' || s_name || ' owed disgorgement , a civil penalty and cease-and-desist relief .', '(?i)\\b(?:{_legal})\\b', ' ', 'g'), '\\s{{2,}}', ' ', 'g'), '\\s+([,.;:])', '\\1', 'g')) AS text FROM supplier",
    "digest_stories": "WITH o AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders) SELECT 'Order ' || k AS title, 'Reuters' AS source, d AS date, 'A summary. More of it.' AS summary, 'A Clerk' AS byline, 'Markets' AS section, false AS paywalled, true AS \"primary\" FROM o UNION ALL SELECT 'Other ' || k, 'Barron', d, '', '', 'Markets', true, false FROM o",
    "structured_rows": "SELECT c_mktsegment AS title, c_custkey % 2 = 0 AS paywalled, '2024-05-06' AS date FROM customer WHERE c_custkey % 7 <> 0",
    "keyword_scan": """WITH t AS (SELECT n_nationkey AS risk, n_name AS term, length(n_name) AS len FROM nation WHERE n_name NOT LIKE 'A%'),
r AS (SELECT risk, term, unnest(range(0, least(len, 8))) AS k, least(3, (len + 2) // 3) AS requests FROM t),
l AS (SELECT risk, CAST(k + 1 AS INTEGER) AS place, term || ' ' || k AS title, CASE WHEN k = 1 THEN 'http://same/' ELSE 'http://' || lower(term) || '/' || k END AS link, k, term, CAST(requests AS INTEGER) AS requests FROM r),
f AS (SELECT *, row_number() OVER (PARTITION BY lower(link) ORDER BY risk, place) AS n FROM l WHERE lower(link) <> 'http://brazil/0')
SELECT risk, place, title, link, CASE WHEN k = 0 THEN 'wire' WHEN k = 1 THEN 'same' ELSE lower(term) END AS source, requests FROM f WHERE n = 1""",
    "latest_scan_plan": "SELECT 'DISCOVERY' AS lane, lower(r_name) AS category, 'https://api.test/1/news?category=' || replace(lower(r_name), ' ', '+') || '&country=us&language=en&prioritydomain=top' AS url FROM region",
    "lexicon_scan_plan": "SELECT DISTINCT 'LEXICON' AS lane, 'lex:' || lower(p_type) AS category, 'https://api.test/1/news?q=%22' || replace(lower(p_type), ' ', '+') || '%22&country=us&language=en&prioritydomain=top' AS url FROM part",
    "regulator_lane": """WITH c AS (SELECT c_custkey AS k, c_nationkey AS doc, c_name, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS id FROM customer),
l AS (SELECT *, 'SEC' AS source, 'https://www.sec.gov/newsroom/press-releases/2024-' || id AS url FROM c UNION ALL SELECT *, 'CFTC', 'https://www.cftc.gov/PressRoom/PressReleases/' || substr(id, 1, 4) || '-' || substr(id, 5, 2) FROM c),
d AS (SELECT *, CASE WHEN bool_or(k % 3 = 0) OVER (PARTITION BY source, doc ORDER BY k ROWS UNBOUNDED PRECEDING) THEN '2024-02-03' ELSE '' END AS date, 11 + length(c_name) + CASE WHEN k % 80 > 0 THEN 5 * (k % 80) ELSE 0 END AS n FROM l)
SELECT url, source, date, 'Release of ' || c_name AS title, CAST(n AS INTEGER) AS n FROM d WHERE n >= 150""",
    "enforcement_bodies": "WITH b AS (SELECT 'u' || s_suppkey AS url, s_suppkey % 2 = 0 AS admin, s_name, trim(repeat('The firm ' || s_name || ' did so. ', 30)) AS t FROM supplier) SELECT url, CASE WHEN admin THEN 'administrative_proceeding' ELSE 'litigation_release' END AS kind, CASE WHEN admin THEN s_name ELSE 'SEC Charges Firm With Fraud' END AS title, md5(CASE WHEN admin THEN t ELSE 'SEC Charges Firm With Fraud' || chr(10) || t END) AS md5 FROM b",
    # Valences as published: boosted by 0.293 (damped by distance), by 0.733 in capitals, turned by -0.74 after a negation.
    "lexicon_sentiment": """WITH v AS (SELECT p_partkey, CAST(CASE p_size % 4 WHEN 0 THEN 3.1 + 1.6 WHEN 1 THEN -2.8 * -0.74 WHEN 2 THEN (-2.5 - 0.733 - 0.293) + (-1.7 - 0.293 * 0.95) ELSE 0 END AS DOUBLE) AS v FROM part)
SELECT p_partkey, round(v / sqrt(v * v + 15), 4) AS compound FROM v""",
    "risk_articles_balanced": f"""WITH RECURSIVE {SIGNAL},
t AS (SELECT risk, topic, row_number() OVER (PARTITION BY risk ORDER BY count(*) DESC, 'Topic ' || topic) AS tr FROM signal GROUP BY risk, topic QUALIFY tr <= 8),
r AS MATERIALIZED (SELECT risk, row_number() OVER (PARTITION BY risk ORDER BY tr, ts DESC, seq) AS pos, struct_pack(tr := tr, seq := seq, grp := grp, link := link, title := lower(trim(title))) AS x FROM signal JOIN t USING (risk, topic)),
pick AS (SELECT risk, pos, x, CAST(1 AS BIGINT) AS n, [x.grp] AS groups, [x.link] AS links, [x.title] AS titles FROM r WHERE pos = 1
  UNION ALL
  SELECT risk, pos, y, CASE WHEN y.tr = x.tr THEN n + 1 ELSE 1 END, list_append(groups, y.grp), list_append(links, y.link), list_append(titles, y.title)
  FROM (SELECT p.risk, p.x, p.n, p.groups, p.links, p.titles, min(r.pos) AS pos, min_by(r.x, r.pos) AS y FROM pick p JOIN r ON r.risk = p.risk AND r.pos > p.pos
    WHERE (r.x.tr <> p.x.tr OR p.n < 6) AND NOT list_contains(p.groups, r.x.grp) AND NOT list_contains(p.links, r.x.link) AND NOT list_contains(p.titles, r.x.title) GROUP BY ALL))
SELECT risk, x.tr AS topic_rank, x.seq AS seq FROM pick""",
    "distinct_keywords": f"""{_with(DOCS)}, w AS (SELECT seq, list_transform(string_split_regex(regexp_replace(lower(text), '[^a-z ]', '', 'g'), ' +'), lambda x: [x]) AS ws FROM docs),
k AS (SELECT seq, list_reduce(ws, lambda kept, one: CASE WHEN len(kept) >= 5 OR one[1] = '' OR list_contains(kept, one[1]) THEN kept
  WHEN len(list_filter(kept, lambda k: contains(k, one[1]) OR contains(one[1], k))) > 0 THEN list_transform(kept, lambda k: CASE WHEN contains(one[1], k) THEN one[1] ELSE k END)
  ELSE list_append(kept, one[1]) END, CAST([] AS VARCHAR[])) AS kept FROM w)
SELECT seq, array_to_string(list_filter(kept, lambda x, i: list_position(kept, x) = i), ',') AS keywords FROM k""",
    "factor_split": r"""WITH d AS (SELECT doc_id, string_split_regex(replace(text, chr(10), chr(10) || chr(10)), '\n\s*\n+') AS lines, replace(text, chr(10), chr(10) || chr(10)) AS t FROM documents),
p AS (SELECT doc_id, CASE WHEN len(lines) >= 3 THEN lines ELSE string_split(regexp_replace(t, '([.])\s+([A-Z][a-z]+(?:\s+\w+){2,}\s+(?:could|may|would|risk|adversely|our|we|the))', '\1' || chr(1) || '\2', 'g'), chr(1)) END AS parts FROM d),
e AS (SELECT doc_id, unnest(range(0, len(parts))) AS seq, unnest(parts) AS part FROM p),
f AS (SELECT doc_id, seq, x FROM (SELECT doc_id, seq, trim(regexp_replace(replace(part, chr(160), ' '), '\s+', ' ', 'g')) AS x FROM e) WHERE length(x) >= 200),
g AS (SELECT *, trim(CASE WHEN regexp_matches(x, '[.]\s') THEN regexp_extract(x, '(?s)^(.*?[.])\s', 1) ELSE x END) AS first FROM f)
SELECT doc_id AS filing, CAST(seq AS INTEGER) AS seq, CAST(length(x) AS INTEGER) AS n, CASE WHEN length(first) > 140 THEN substr(first, 1, 140) || '...' ELSE first END AS title FROM g""",
    "action_split": f"""{ACTIONS.format(name="'Customer Co (CRD #' || c_custkey || ', Rome, NY)'", doc="CAST(c_custkey // 600 * 25 + c_nationkey AS BIGINT)", every=5, header="Firms Fined")}
SELECT doc, name, CAST(length(body) AS INTEGER) AS n, section, name || ' - was fined.' AS title FROM body WHERE length(body) >= 120""",
    "action_articles": f"""{ACTIONS.format(name="'Firm Co (CRD #' || c_custkey || ', Rome, NY)'", doc="c_nationkey * 1000000 + c_custkey // 200", every=7, header="Individuals Barred")}
SELECT 'ENFORCEMENT' AS SEARCH_TERM_ID, name || ' - was fined.' AS TITLE, CAST(length(body) AS INTEGER) AS n, 'FINRA Disciplinary Actions' AS SOURCE, '2024-' || lpad(CAST(doc % 12 + 1 AS VARCHAR), 2, '0') || '-01' AS PUBLISHED_DATE,
  '/files/2024-' || lpad(CAST(doc % 12 + 1 AS VARCHAR), 2, '0') || '/n' || doc || '.pdf' AS LINK, 'enforcement:' || replace(lower(section), ' ', '_') AS CATEGORY FROM body WHERE length(body) >= 120""",
    "monthly_files": "SELECT DISTINCT url, month FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN '/sites/files/' || strftime(o_orderdate, '%Y-%m') || '/actions.pdf' ELSE '/files/disciplinary-actions-' || lower(strftime(o_orderdate, '%B')) || '-' || strftime(o_orderdate, '%Y') || '.pdf' END AS url, strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE o_orderkey % 3 <> 2) ORDER BY month DESC, url LIMIT 12",
    "latest_filings": "SELECT ticker, form, rank, date, link FROM (SELECT *, row_number() OVER (PARTITION BY ticker, form ORDER BY date DESC, link) AS rank FROM (SELECT 'T' || (o_custkey % 50) AS ticker, ['10-K', '10-Q', '10-K/A'][o_orderkey % 3 + 1] AS form, strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(o_orderkey AS VARCHAR) AS link FROM orders WHERE o_custkey % 50 < 40 AND o_orderkey % 3 < 2)) WHERE rank <= 2",
    "filing_sections": "SELECT p_partkey, md5(trim(repeat(p_name || ' may fail. ', p_size))) AS md5 FROM part",
    "text_repair": "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'caf' || chr(233) || '  ' WHEN 1 THEN ' ' WHEN 2 THEN 'caf' || chr(195) || chr(169) || ' ' ELSE 'plain ' END || p_name AS text FROM part",
    "ascii_spelling": "SELECT p_partkey, '\"Cafe\" -- naive... ' || p_name AS text FROM part",
    "stage_csv": """SELECT c_nationkey AS risk, md5(c_name || CASE c_custkey % 4 WHEN 0 THEN ' said "no", twice' WHEN 1 THEN chr(10) || 'next line' WHEN 2 THEN ' ' ELSE chr(92) END) AS title,
  CAST(c_acctbal AS DOUBLE) AS tone, c_mktsegment || ', ' || c_name AS entities, true AS no_link FROM customer""",
    "stage_by_month": f"{_with(SIGNAL)} SELECT month, count(*) AS n, count(*) FILTER (k < 0) AS negative FROM signal WHERE month >= '1995-01' GROUP BY month",
    "report_pages": "SELECT p_partkey, p_name AS title, CASE WHEN p_partkey % 4 < 2 THEN CAST(p_size AS BIGINT) END AS articles, CASE WHEN p_partkey % 4 < 2 THEN CAST(7 AS BIGINT) END AS topics, CASE WHEN p_partkey % 4 < 2 THEN '2024-01,m' || p_size END AS months FROM part",
    "fetch_retries": "SELECT 'http://n/' || n_nationkey AS url, CASE n_nationkey % 3 WHEN 0 THEN 404 WHEN 1 THEN 200 ELSE 503 END AS status, CASE n_nationkey % 3 WHEN 0 THEN '1' ELSE '3' END AS requests FROM nation",
    "embedding_cache": "SELECT DISTINCT sha1('m' || chr(0) || text) AS key, CAST(1 AS BIGINT) AS n, 4 AS size FROM documents WHERE text IS NOT NULL",
    "quality_validity": f"{_with(DOCS)} SELECT seq, CASE WHEN seq % 2 = 0 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END AS kept, {_quality('title', 'summary', 'source')} AS anew FROM docs",
    "lane_articles": f"""WITH i AS (SELECT s_suppkey AS k, s_name AS title, substr(repeat(s_name, 5), 1, CAST(30 + s_suppkey % 60 AS INTEGER)) AS t FROM supplier)
SELECT 'http://s/' || k AS LINK, -1 AS RISK_ID, 'ENF' AS SEARCH_TERM_ID, title AS TITLE, substr(t, 1, 60) AS SUMMARY, 'enforcement:' || CASE k % 3 WHEN 0 THEN 'order' ELSE 'general' END AS CATEGORY,
  CASE WHEN length(t) >= 55 THEN 'Positive' WHEN length(t) <= 45 THEN 'Negative' ELSE 'Neutral' END AS SENTIMENT, {_quality('title', 'substr(t, 1, 60)', "'SEC'")} AS quality, true AS no_place FROM i""",
    "pdf_punctuation": """SELECT p_partkey, '"' || p_name || '" ' || chr(39) || 's "q" 1-2 Acme(R)' AS text FROM part""",
    "clean_values": "SELECT p_partkey, CASE WHEN p_size % 5 = 3 THEN CAST(p_size AS DOUBLE) ELSE 0.0::DOUBLE END AS number, CASE p_size % 5 WHEN 2 THEN 'x1' WHEN 3 THEN CAST(p_size AS VARCHAR) ELSE '' END AS word FROM part",
    "slug_titles": "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') || ' ' || p_size AS title FROM part",
    "topic_labels": "SELECT p_partkey, nullif(array_to_string(string_split(p_name || ' ' || p_type, ' ')[1:least(4, p_size % 6)], ' / '), '') AS label FROM part",
    "run_settings": """WITH n AS (SELECT c_nationkey AS k, count(*) AS n, CAST(floor(c_nationkey * 30.44) AS INTEGER) AS days FROM customer GROUP BY c_nationkey)
SELECT k AS months, days, CASE WHEN days = 0 THEN 'out/topics.csv' ELSE 'out/topics_last' || days || 'd.csv' END AS file, CASE WHEN days = 0 THEN 'out/topics' ELSE 'out/topics_last' || days || 'd' END AS folder,
  CAST(greatest(2, least(10, n // 20)) AS INTEGER) AS min_topic_size, CAST(CASE WHEN n < 200 THEN greatest(2, least(15, n - 1)) ELSE 15 END AS INTEGER) AS n_neighbors,
  CAST(CASE WHEN n < 200 THEN 1 ELSE greatest(2, least(10, n // 20)) END AS INTEGER) AS min_samples, CAST(n >= 3 AS INTEGER) AS enough FROM n""",
    "model_places": "SELECT n_name AS name, CASE WHEN length(n_name) % 2 = 0 THEN n_name WHEN length(n_name) % 3 = 0 THEN '/cache/' || n_name || '/' ELSE n_name END AS place, length(n_name) % 2 = 0 OR length(n_name) % 3 = 0 AS local FROM nation",
    "corpus_newest_first": f"{_with(SIGNAL)} SELECT seq, row_number() OVER (ORDER BY CASE WHEN seq % 7 <> 0 THEN day END DESC NULLS LAST, seq) - 1 AS place FROM signal",
    "risk_labels": f"{_with(SIGNAL)} SELECT CASE WHEN n_nationkey < 20 THEN n_name ELSE 'unknown' END AS label, count(*) AS n FROM signal LEFT JOIN nation ON risk = n_nationkey GROUP BY 1",
    "topics_large_enough": f"{_with(SIGNAL)}, s AS (SELECT topic, count(*) AS n FROM signal GROUP BY topic) SELECT CASE WHEN n < 240 THEN -1 ELSE topic END AS topic, CAST(sum(n) AS BIGINT) AS n FROM s GROUP BY 1",
    "hashed_embeddings": """WITH w AS (SELECT item_id, unnest(list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS x FROM benchmark),
c AS (SELECT item_id, CAST(('0x' || substr(md5(x), 1, 8))::UBIGINT % 16 AS INTEGER) AS pos, count(*) AS n FROM w GROUP BY 1, 2),
f AS (SELECT item_id, pos, ln(1 + coalesce(n, 0)) AS v FROM (SELECT item_id, unnest(range(0, 16))::INTEGER AS pos FROM benchmark) LEFT JOIN c USING (item_id, pos)),
s AS (SELECT item_id, sqrt(sum(v * v)) + 1e-9 AS size FROM f GROUP BY item_id)
SELECT item_id, pos, round(CAST(v / size AS FLOAT), 4) AS v FROM f JOIN s USING (item_id)""",
    "stream_tumbling_counts": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2",
    "stream_sliding_counts": "SELECT strftime(d, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM (SELECT date_trunc('day', ts) - INTERVAL 1 DAY * i AS d, event_type FROM events CROSS JOIN (VALUES (0), (1)) t(i)) GROUP BY 1, 2",
    "stream_sessions": "WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n FROM s GROUP BY user_id, s.s",
    "stream_closed_days": "SELECT event_type AS key, strftime(date_trunc('day', ts), '%Y-%m-%d') AS period, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2",
    "stream_dedup": "SELECT DISTINCT user_id FROM events",
}

# Unit vectors beside each other, all pairs.
UNIT = "u AS (SELECT vec_id AS seq, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS v FROM embeddings), p AS (SELECT x.seq AS a, y.seq AS b, list_dot_product(x.v, y.v) AS c FROM u x JOIN u y ON x.seq != y.seq)"
SQL["similar_vector_pairs"] = f"WITH {UNIT} SELECT a, b, round(c, 6) AS cosine FROM p WHERE a < b AND round(c, 9) >= 0.5"
SQL["nearest_vectors"] = f"""WITH {UNIT}, d AS (SELECT a, b, sqrt(round(greatest(2 - 2 * c, 0), 12)) AS distance FROM p)
SELECT a AS seq, b AS other, round(distance, 5) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY distance, b) AS k FROM d) WHERE k <= 5"""

SQL["indexed_search"] = "SELECT q AS query, doc_id AS doc FROM documents CROSS JOIN (VALUES ('All rights'), ('topic 7'), ('ß')) t(q) WHERE contains(lower(coalesce(text || ' ', '') || 'topic ' || doc_id), lower(q))"
SQL["estimated_stories"] = f"{_with(SIGNAL)} SELECT topic, count(DISTINCT grp) AS stories, true AS near, count(DISTINCT CASE WHEN month BETWEEN '1995-01' AND '1995-12' THEN grp END) AS of_year, true AS near_of_year FROM signal GROUP BY topic"
_WORDS = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
SQL["corpus_weights"] = f"""WITH d AS (SELECT doc_id, unnest(list_distinct({_WORDS})) AS word FROM documents), f AS (SELECT word, count(*) AS df FROM d GROUP BY word),
w AS (SELECT item_id, word, count(*) AS n FROM (SELECT item_id, unnest({_WORDS}) AS word FROM benchmark) GROUP BY 1, 2)
SELECT item_id AS item, word, round((1 + ln(n)) * greatest(ln(((SELECT count(DISTINCT doc_id) FROM documents) + 1)::DOUBLE / (coalesce(df, 0) + 1)), 0), 6) AS weight FROM w LEFT JOIN f USING (word)"""
SQL["entity_model"] = "SELECT c_custkey, n_name || '|' || c_name AS entities FROM customer JOIN nation ON c_nationkey = n_nationkey"
SQL["enforcement_listing"] = """WITH c AS (SELECT c_custkey AS k, c_name AS name, c_custkey % 2 = 0 AS admin, c_nationkey * 1000000 + c_custkey // 200 AS doc, trim(repeat('The firm ' || c_name || ' did so. ', 30)) AS t FROM customer),
d AS (SELECT *, max(CASE WHEN k % 3 = 0 THEN k END) OVER (PARTITION BY doc, admin ORDER BY k ROWS UNBOUNDED PRECEDING) AS dated FROM c)
SELECT CASE WHEN admin THEN name || ' and others' ELSE 'SEC Charges Firm With Fraud' END AS title, md5(CASE WHEN admin THEN t ELSE 'SEC Charges Firm With Fraud' || chr(10) || t END) AS md5, 'SEC' AS source,
  CASE WHEN dated IS NULL THEN '' ELSE '2024-03-0' || (dated % 9 + 1) END AS date, 'https://www.sec.gov/lit/' || k AS link, CASE WHEN admin THEN 'sec:administrative_proceeding' ELSE 'sec:litigation_release' END AS category FROM d"""
SQL["filing_factors"] = """WITH f AS (SELECT p_partkey, 'Our cafe - ' || p_name || ' may fail to meet demand.' AS a, 'Rules & taxes of ' || p_type || ' could rise at any time and hurt.' AS b FROM part)
SELECT p_partkey, md5(repeat(a || ' ', 8) || 'Once more, naively.') AS md5, a AS title FROM f UNION ALL SELECT p_partkey, md5(rtrim(repeat(b || ' ', 8))), b FROM f"""
