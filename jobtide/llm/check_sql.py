"""SQL text that gives the same rows as the registered queries, where SQL can express them."""

from __future__ import annotations

from jobtide.llm.quality_rules import HOST_LIMIT, LEAST_STRENGTH, LEAST_WORDS, MOST_STRENGTH, REPEATED_LIMIT, SYMBOL_LIMIT
from jobtide.llm.sharding import SHARDS, SLOTS, lookup_table
from jobtide.llm.url_filter import LOWER, RULES, UPPER

WORD_LIST = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def shards() -> str:
    table = ",".join(map(str, lookup_table(SHARDS, SLOTS)))
    names = ",".join(f"'{name}'" for name in SHARDS)
    return f"""
WITH slots AS (
  SELECT doc_id, (('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS})::INTEGER AS slot FROM documents),
lookup AS (SELECT unnest(range({SLOTS}))::INTEGER AS slot, unnest([{table}])::INTEGER AS shard_no)
SELECT doc_id, slot, shard_no, ([{names}])[shard_no + 1] AS shard FROM slots JOIN lookup USING (slot)"""


NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORD_LIST.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
reached AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reached.d, links.b FROM reached JOIN links ON links.a = reached.r),
named AS (SELECT d, min(r) AS component_id FROM reached GROUP BY d)
SELECT documents.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN named ON named.d = documents.doc_id"""


def _rate(name: str) -> str:
    mean = f"(m.{name} / m.n)"
    spread = f"(m.{name}_spread - {mean} * (1 - {mean}) * m.sampling)"
    strength = f"CASE WHEN {spread} > 0 THEN greatest({LEAST_STRENGTH}, least({MOST_STRENGTH}, {mean} * (1 - {mean}) / {spread} - 1)) ELSE {MOST_STRENGTH} END"
    return f"(h.{name} + {mean} * ({strength})) / (h.n + ({strength}))"


QUALITY_RULES = rf"""
WITH words AS (SELECT doc_id, source, coalesce(text, '') AS t, {WORD_LIST.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
repeats AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT doc_id, sum(least(8, i - before))::BIGINT AS n
  FROM (SELECT doc_id, i, lag(i, 1, i - 8) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM repeats) GROUP BY doc_id),
lines AS (
  SELECT doc_id, len(l) - len(list_distinct(l)) AS n
  FROM (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words)),
measured AS (
  SELECT words.doc_id, source, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    lines.n::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
failed AS (
  SELECT *, n_words < {LEAST_WORDS} AS short, n_repeat_words * 100 > n_words * {REPEATED_LIMIT} AS repeats,
    n_symbols * 100 > word_chars * {SYMBOL_LIMIT} AS symbols FROM measured),
hosts AS (
  SELECT source, count(*)::DOUBLE AS n, sum(short::INT)::DOUBLE AS short, sum(repeats::INT)::DOUBLE AS repeats, sum(symbols::INT)::DOUBLE AS symbols
  FROM failed GROUP BY source),
moments AS (
  SELECT sum(n) AS n, avg(1 / n) AS sampling, sum(short) AS short, sum(repeats) AS repeats, sum(symbols) AS symbols,
    coalesce(var_samp(short / n), 0) AS short_spread, coalesce(var_samp(repeats / n), 0) AS repeats_spread,
    coalesce(var_samp(symbols / n), 0) AS symbols_spread FROM hosts),
verdicts AS (
  SELECT source, greatest({_rate("short")}, {_rate("repeats")}, {_rate("symbols")}) > {HOST_LIMIT} AS rejected FROM hosts h, moments m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
  NOT (short OR repeats) AND NOT rejected AS kept
FROM failed JOIN verdicts ON failed.source IS NOT DISTINCT FROM verdicts.source"""


def _fitting(host: str, path: str) -> str:
    rules = ",".join(f"('{action}', '{h}', '{p}')" for action, h, p in RULES)
    return f"""(SELECT {{'rule': r.h || r.p, 'act': r.act}} FROM (VALUES {rules}) r(act, h, p)
    WHERE ({host} = r.h OR ends_with({host}, '.' || r.h)) AND starts_with({path}, r.p) ORDER BY length(r.h || r.p) DESC, r.act LIMIT 1)"""


def _host(url: str) -> str:
    return rf"translate(coalesce(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}')"


def _path(url: str) -> str:
    return rf"coalesce(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _dotless(path: str) -> str:
    segments = f"string_split(substr({path}, 2), '/')"
    walked = f"""list_reduce(list_concat([[]::VARCHAR[]], list_transform({segments}, lambda s: [s])),
      lambda kept, s: CASE s[1] WHEN '.' THEN kept WHEN '..' THEN kept[1:greatest(len(kept) - 1, 0)] ELSE list_concat(kept, s) END)"""
    ended = f"CASE WHEN {segments}[-1] IN ('.', '..') THEN list_concat({walked}, ['']) ELSE {walked} END"
    return f"CASE WHEN {path} = '' THEN '/' ELSE '/' || array_to_string({ended}, '/') END"


def _address(url: str) -> str:
    query = rf"regexp_extract({url}, '(?s)^.*?://[^?#]*(\?[^#]*)', 1)"
    return f"CASE WHEN {_host(url)} <> '' THEN {_host(url)} || {_dotless(_path(url))} || {query} END"


URLS = rf"""
WITH RECURSIVE tags AS (
  SELECT url,
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'),
      lambda t: regexp_matches(t, '(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')),
      lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)) AS links,
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'),
      lambda t: regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')),
      lambda t: regexp_extract(t, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1)) AS refreshes,
    [url_decode(regexp_extract(url, '[?&](?:url|target|dest|redirect|redirect_uri|redirect_url)=(https?(?:%3[Aa]|:)[^&#]*)', 1))] AS wrapped
  FROM pages),
found AS (
  SELECT url, replace(trim(unnest(list_concat(coalesce(links, []), coalesce(refreshes, []), coalesce(wrapped, [])))), '&amp;', '&') AS link FROM tags),
ends AS (
  SELECT url, CASE WHEN link = '' THEN NULL
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(link, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || link
    WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || link
    WHEN starts_with(link, '#') THEN url
    WHEN starts_with(link, '?') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || {_path("url")} || link
    ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || coalesce(nullif(regexp_extract({_path("url")}, '(?s)^(.*/)', 1), ''), '/') || link END AS goal
  FROM found),
edges AS (SELECT DISTINCT {_address("url")} AS a, {_address("goal")} AS b FROM ends WHERE {_address("url")} <> {_address("goal")}),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached AS (SELECT a AS x, a AS y FROM both_ways UNION SELECT x, b FROM reached JOIN both_ways ON a = y),
addresses AS (SELECT DISTINCT y, 'x://' || y AS u FROM reached),
ruled AS (SELECT y, {_fitting(_host("u"), _path("u"))}.act AS act FROM addresses),
acts AS (SELECT x, min(act) AS act FROM reached JOIN ruled USING (y) WHERE act IS NOT NULL GROUP BY x),
judged AS (
  SELECT page_id, {_host("url")} AS host, {_path("url")} AS path, {_address("url")} AS address,
    {_fitting(_host("url"), _path("url"))} AS own FROM pages)
SELECT page_id, host, path, own.rule AS rule, coalesce(own.act, act, 'allow') AS verdict,
  CASE WHEN own.act IS NOT NULL THEN 'rule' WHEN act IS NOT NULL THEN 'alias' ELSE 'default' END AS decided_by
FROM judged LEFT JOIN acts ON x = address"""


def _counted(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_counted, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# every byte is taken in and then divided out bit by bit
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""


def _tree(name: str, start: str) -> str:
    """All nodes (tree, n, level, place, digest) above the leaves that ``start`` selects."""
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT tree, n, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM {name}
  WHERE ((n - 1) >> level) > 0 GROUP BY tree, n, level, place // 2)"""


def _steps(name: str, nodes: str) -> str:
    """Siblings (tree, place of the leaf, level, step) of all leaves; the step tells the side, too."""
    return f"""{name} AS (
  SELECT l.tree, l.place, s.level, CASE WHEN o.place IS NULL THEN '=' WHEN o.place < (l.place >> s.level) THEN '<' || o.digest ELSE '>' || o.digest END AS step
  FROM {nodes} l JOIN (SELECT DISTINCT tree, level FROM {nodes} WHERE ((n - 1) >> level) > 0) s ON s.tree = l.tree
  LEFT JOIN {nodes} o ON o.tree = l.tree AND o.level = s.level AND o.place = xor(l.place >> s.level, 1::BIGINT) WHERE l.level = 0)"""


MANIFEST = rf"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("n_chars")} AS leaf,
    CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS found FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
{_tree("nodes", "SELECT tree, n, 0 AS level, place, leaf AS digest FROM placed")},
subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE ((n - 1) >> level) = 0),
{_tree("above", "SELECT '' AS tree, n, 0 AS level, place, digest FROM subroots")},
{_steps("inner_steps", "nodes")},
{_steps("outer_steps", "above")},
steps AS (
  SELECT tree, place, level, step FROM inner_steps
  UNION ALL SELECT p.tree, p.place, 1000 + o.level, o.step FROM placed p JOIN subroots s USING (tree) JOIN outer_steps o ON o.place = s.place),
proofs AS (SELECT tree, place, list(step ORDER BY level) AS steps FROM steps GROUP BY tree, place),
folded AS (
  SELECT placed.*, coalesce(steps, []) AS steps, list_reduce(list_concat([found], coalesce(steps, [])),
    lambda d, s: sha256(CASE s[1] WHEN '<' THEN s[2:] || d WHEN '>' THEN d || s[2:] ELSE d END)) AS folded_root
  FROM placed LEFT JOIN proofs USING (tree, place)),
top AS (SELECT digest AS root FROM above WHERE ((n - 1) >> level) = 0)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folded JOIN subroots s USING (tree), top"""


COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
sequences AS (
  SELECT lang, k, unnest(CASE WHEN len(w) >= k THEN list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1]) ELSE [] END) AS s
  FROM words, (VALUES (1), (2), (3), (4)) sizes(k)),
counts AS (SELECT lang, k, s, count(*)::BIGINT AS f FROM sequences GROUP BY ALL),
candidates AS (SELECT lang, k, s, f AS a FROM counts WHERE k >= 2 AND f >= 30),
inner_parts AS (
  SELECT lang, k, a, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: s[i:i + m - 1])))) AS s
  FROM candidates WHERE k > 2),
covering AS (SELECT lang, s, max(a) AS a FROM inner_parts GROUP BY ALL),
left_over AS (
  SELECT c.* FROM candidates c LEFT JOIN covering o ON o.lang = c.lang AND o.s = c.s WHERE o.a IS NULL OR 100 * o.a::HUGEINT < 80 * c.a::HUGEINT),
cuts AS (
  SELECT c.lang, c.s, c.a, cut, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
  FROM left_over c JOIN (VALUES (1), (2), (3)) places(cut) ON cut < k
  JOIN counts x ON x.lang = c.lang AND x.s = c.s[:cut] JOIN counts y ON y.lang = c.lang AND y.s = c.s[cut + 1:]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, cut) = 1),
named AS (SELECT lang, array_to_string(s, ' ') AS phrase, a, l, r, score FROM lowest)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM named JOIN totals USING (lang) QUALIFY rank <= 2000"""
