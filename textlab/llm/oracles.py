"""The same results in DuckDB SQL, for the queries of this folder that SQL can express on whole tables.

Fingerprints, checksums, token ids and fitted models have no SQL form; their tests compare with brute force.
"""

from __future__ import annotations

from collections.abc import Sequence

from textlab.llm.queries import URL_RULES
from textlab.llm.url_templates import NUMBER, Growth, Rule

LINE_QUALITY = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l : regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d),
grams AS (SELECT doc_id, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS g FROM win),
again AS (SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (SELECT grams.doc_id, count(DISTINCT i + k) AS n FROM grams JOIN again ON grams.doc_id = again.doc_id AND grams.g = again.g, (VALUES (0), (1), (2)) v(k) GROUP BY grams.doc_id),
texts AS (SELECT DISTINCT source, t, lines FROM d),
held AS (SELECT source, t, generate_subscripts(lines, 1) AS place, unnest(lines) AS l FROM texts),
normal AS (
  SELECT source, t, place, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
    trim(regexp_replace(regexp_replace(lower(l), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM held),
hosts AS (SELECT source, count(*) AS documents FROM texts GROUP BY source),
frequent AS (
  SELECT f.source, f.line FROM (SELECT source, line, count(DISTINCT t) AS found FROM normal GROUP BY source, line) f
  JOIN hosts ON f.source IS NOT DISTINCT FROM hosts.source WHERE found > 10 AND found > documents * 0.05),
removed AS (
  SELECT normal.source, t, sum(n) AS removed FROM normal JOIN frequent ON normal.source IS NOT DISTINCT FROM frequent.source AND normal.line = frequent.line
  GROUP BY normal.source, t),
stats AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(removed, 0) AS BIGINT) AS n_removed_words
  FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN removed ON d.source IS NOT DISTINCT FROM removed.source AND d.t = removed.t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - n_removed_words >= n_words * 0.5 AS kept, n_removed_words
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats)
"""

VORONOI_KNN = """
WITH v AS (SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x : CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.place, q.vec_id AS query_id, c.vec_id, c.place AS other, CAST(CASE WHEN len(q.x) = 0 THEN 0 ELSE list_inner_product(q.x, c.x) END AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.place <> c.place AND len(q.x) = len(c.x)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id ASC NULLS LAST, other) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

COLLOCATIONS = r"""
WITH pieces AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w : w <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (SELECT lang, words, unnest(list_transform(range(1, len(w) - words + 2), lambda i : array_to_string(w[i:i + words - 1], ' '))) AS phrase
  FROM pieces, (VALUES (1), (2), (3)) v(words)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
f AS MATERIALIZED (SELECT lang, words, phrase, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
cuts AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, words)) AS k FROM f WHERE words >= 2),
parted AS (SELECT cuts.lang, cuts.words, cuts.phrase, a, k, l.f AS l, r.f AS r, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts JOIN f l ON cuts.lang = l.lang AND l.phrase = array_to_string(w[1:k], ' ') JOIN f r ON cuts.lang = r.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
candidates AS MATERIALIZED (SELECT * FROM parted QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase
  FROM candidates WHERE words = 3),
most AS (SELECT lang, phrase, max(a) AS most FROM inner_parts GROUP BY ALL),
kept AS (SELECT candidates.* FROM candidates LEFT JOIN most ON candidates.lang = most.lang AND candidates.phrase = most.phrase WHERE most IS NULL OR 100 * most < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

RANKED_SEARCH = r"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS place, doc_id,
  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
lengths AS (SELECT place, doc_id, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS documents, CAST(sum(n) AS BIGINT) AS words FROM lengths),
counts AS MATERIALIZED (SELECT place, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT place, unnest(terms) AS term FROM docs) GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, total GROUP BY term, documents),
parts AS (SELECT item_id, lengths.place, doc_id, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * documents) // words)))) AS part
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths ON counts.place = lengths.place, total),
scores AS (SELECT item_id, place, doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def url_templates(rules: Sequence[Rule], growth: Growth = Growth()) -> str:
    """The levels of the tree are written out; a level without segments changes nothing."""
    ordered = sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name), reverse=True)
    cases = lambda value: "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, value)}'" for r in ordered
    ) + " END"
    steps = [
        f"""pages_in AS (SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END, '') AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM pages_in),
r0 AS MATERIALIZED (SELECT host, path, CASE {cases("verdict")} WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END AS bad, '' AS template, '' AS branch,
  list_filter(string_split(path, '/'), lambda s : s <> '') AS seg FROM (SELECT DISTINCT host, path FROM parts))"""
    ]
    for i in range(growth.depth):
        steps.append(f"""c{i} AS MATERIALIZED (SELECT host, branch, seg[{i + 1}] AS segment, count(*) AS n FROM r{i} WHERE len(seg) > {i} GROUP BY ALL),
k{i} AS (SELECT host, branch, segment FROM c{i} JOIN (SELECT host, branch, sum(n) AS total FROM c{i} GROUP BY ALL) USING (host, branch)
  WHERE n >= {growth.least_urls} AND n * 100 >= total * {growth.least_percent}
    OR segment IN (SELECT segment FROM c{i} WHERE NOT regexp_matches(segment, '{NUMBER}') GROUP BY segment
      HAVING count(DISTINCT host) >= {growth.least_hosts} AND count(DISTINCT host) * 100 >= (SELECT count(DISTINCT host) FROM c{i}) * {growth.least_percent})),
p{i} AS MATERIALIZED (SELECT r.*, CASE WHEN len(seg) <= {i} THEN NULL WHEN k.segment IS NOT NULL THEN seg[{i + 1}]
    WHEN regexp_matches(seg[{i + 1}], '{NUMBER}') THEN '#n' ELSE '#w' END AS child
  FROM r{i} r LEFT JOIN k{i} k ON r.host = k.host AND r.branch = k.branch AND seg[{i + 1}] = k.segment),
s{i} AS (SELECT *, b / n AS share FROM (SELECT host, branch, child, sum(bad) AS b, count(*) AS n FROM p{i} WHERE child IS NOT NULL AND bad IS NOT NULL GROUP BY ALL)),
g{i} AS (SELECT *, lag(b) OVER w AS pb, lag(n) OVER w AS pn, lag(share) OVER w AS ps FROM s{i} WINDOW w AS (PARTITION BY host, branch ORDER BY share, child)),
d{i} AS (SELECT *, sum(CASE WHEN (share - ps) * (share - ps) > CAST({growth.z} AS DOUBLE) * CAST({growth.z} AS DOUBLE) * ((b + pb) / (n + pn)) * (1 - (b + pb) / (n + pn)) * (1 / n + 1 / pn) THEN 1 ELSE 0 END)
  OVER (PARTITION BY host, branch ORDER BY share, child) AS run FROM g{i}),
m{i} AS (SELECT host, branch, run, CASE WHEN count(*) > 1 THEN '#{{' || string_agg(child, '|' ORDER BY child) || '}}' ELSE min(child) END AS name FROM d{i} GROUP BY ALL),
r{i + 1} AS MATERIALIZED (SELECT p.host, path, bad, CASE WHEN p.child IS NULL THEN template ELSE template || '/' || p.child END AS template,
    CASE WHEN p.child IS NULL THEN p.branch ELSE p.branch || '/' || coalesce(m.name, p.child) END AS branch, seg
  FROM p{i} p LEFT JOIN d{i} d ON p.host = d.host AND p.branch = d.branch AND p.child = d.child LEFT JOIN m{i} m ON d.host = m.host AND d.branch = m.branch AND d.run = m.run)""")
    last, strength = growth.depth, f"CAST({growth.strength} AS DOUBLE)"
    steps.append(f"""leaves AS MATERIALIZED (SELECT host, path, bad, CASE WHEN len(seg) > {last} THEN template || '/#t' ELSE template END AS template,
    CASE WHEN len(seg) > {last} THEN branch || '/#t' ELSE branch END AS branch FROM r{last}),
overall AS (SELECT (coalesce(sum(bad), 0) + 1) / (count(bad) + 2) AS o FROM leaves),
priors AS (SELECT template, (coalesce(sum(bad), 0) + {strength} * (SELECT o FROM overall)) / (count(bad) + {strength}) AS prior FROM leaves GROUP BY template),
branches AS (SELECT host, branch, coalesce(sum(bad), 0) AS bb, count(bad) AS bn FROM leaves GROUP BY host, branch),
pure AS (SELECT l.host, l.path, l.branch, (bb + {strength} * prior) / (bn + {strength}) AS purity
  FROM leaves l JOIN branches USING (host, branch) JOIN priors ON l.template = priors.template)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT page_id, host, path, {cases("name")} AS rule, coalesce({cases("verdict")}, CASE WHEN purity > {growth.limit} THEN 'block' ELSE 'allow' END) AS verdict,
  branch AS template, round(purity, 6) AS purity
FROM parts JOIN pure USING (host, path)
"""


def all_oracles() -> dict[str, str]:
    return {
        "op2_line_quality": LINE_QUALITY,
        "op10_voronoi_knn": VORONOI_KNN,
        "op11_collocations": COLLOCATIONS,
        "op12_url_templates": url_templates(URL_RULES),
        "op13_ranked_search": RANKED_SEARCH,
    }
