"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import re

from .license_scan import BASE, TEMPLATES

# The letters that are lower-cased.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = f"""
WITH lines AS (
  SELECT doc_id, row_no, u.i AS i, u.line AS line,
         {_LOWER.format(r"regexp_replace(u.line, '^[ \t-\r]+|[ \t-\r]+$', '', 'g')")} AS key
  FROM (SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS text FROM documents),
       LATERAL (SELECT unnest(range(len(string_split(text, chr(10))))) AS i,
                       unnest(string_split(text, chr(10))) AS line) u),
firsts AS (
  SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 AND doc_id IS NOT NULL
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT l.*, (f.first IS NOT NULL AND l.doc_id > f.first) IS TRUE AS gone FROM lines l LEFT JOIN firsts f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row_no"""


_WORDS = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _template_pattern(markup: str) -> tuple[str, int]:
    """A template as a regular expression over ' '-led words, and its number of mandatory words."""
    out, depth, mandatory = "", 0, 0
    for i, piece in enumerate(re.split(r"<<(.*?)>>", markup)):
        if i % 2 == 0:
            words = re.findall(r"[0-9a-z]+", piece)
            out += "".join(" " + w for w in words)
            mandatory += 0 if depth else len(words)
        elif piece == "beginOptional":
            out, depth = out + "(", depth + 1
        elif piece == "endOptional":
            out, depth = out + ")?", depth - 1
        else:
            out += "( [^ ]+){1," + re.search(r"max=(\d+)", piece)[1] + "}"
    return out, mandatory


def _op1() -> str:
    patterns = [(label, *_template_pattern(markup)) for label, markup in [*BASE, *TEMPLATES]]
    found = ", ".join(f"CASE WHEN regexp_matches(joined, '{p}( |$)') THEN {{'label': '{label}', 'm': {m}}} END"
                      for label, p, m in patterns)
    places = []
    for label, phrase in BASE:
        words = phrase.split()
        test = " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(words, 1))
        places.append(f"CASE WHEN {test} THEN '{label}' END")
    return f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS words FROM documents),
places AS (
  SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM (SELECT r, i, unnest([{', '.join(places)}]) AS label
        FROM (SELECT r, words, unnest(range(len(words))) AS i FROM w))
  WHERE label IS NOT NULL GROUP BY r),
labels AS (
  SELECT r, string_agg(DISTINCT f.label, ',' ORDER BY f.label) AS labels, max(f.m) AS m
  FROM (SELECT r, unnest([{found}]) AS f
        FROM (SELECT r, list_aggregate(list_transform(words, lambda x: ' ' || x), 'string_agg', '') AS joined FROM w))
  WHERE f IS NOT NULL GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(m / (m + 4.0), 0.0)::DOUBLE AS score
FROM w LEFT JOIN places USING (r) LEFT JOIN labels USING (r)"""


OP2 = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(text,
      '\\', '\\\\'), '<|', '<\\|'), '</s>', '<\\/s>'), '<s>', '<\\s>'), '[INST]', '[\\INST]'),
      '[/INST]', '[\\/INST]'), '<<SYS>>', '<\\<SYS>>'), '<</SYS>>', '<\\</SYS>>') AS content FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                                  ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + 1 + length(content) + length('<|im_end|>') + 1)::BIGINT
         AS formatted_chars
FROM escaped GROUP BY conv_id"""


OP7 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p + 1:p + least(len(w), 10)], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(len(w) - least(len(w), 10) + 1)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
document_windows AS (
  SELECT r, p, n, array_to_string(w[p + 1:p + n], ' ') AS t
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT r, p, n, item_id FROM document_windows JOIN item_windows USING (n, t)),
hit AS (SELECT r, count(DISTINCT pos) AS n_hit
        FROM (SELECT r, unnest(range(p, p + n)) AS pos FROM (SELECT DISTINCT r, p, n FROM found)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""


OP8 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^ \\t-\\r]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - 3), lambda p: array_to_string(w[p + 1:p + 4], ' ')) END) AS s FROM d),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
both_ways AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT doc_id, len(any_value(s)) AS n_shingles, min(b) AS component_id
FROM sets JOIN reach ON a = doc_id GROUP BY doc_id"""


OP12 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^ \\t]+') AS w
  FROM (SELECT lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents)),
grams AS MATERIALIZED (
  SELECT lang, m, array_to_string(w[p + 1:p + m], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, m, w, unnest(range(len(w) - m + 1)) AS p FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS m)
        WHERE len(w) >= m) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM grams WHERE m = 1 GROUP BY lang),
candidates AS MATERIALIZED (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE m > 1 AND f >= 30),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (2000000::HUGEINT * a) // (x.f + y.f), k) AS best
  FROM cuts c JOIN grams x ON c.lang = x.lang AND c.first = x.phrase
              JOIN grams y ON c.lang = y.lang AND c.rest = y.phrase),
longer AS (
  SELECT lang, phrase, max(a) AS most
  FROM (SELECT lang, a, array_to_string(w[p + 1:p + size], ' ') AS phrase
        FROM (SELECT lang, a, w, size, unnest(range(m - size + 1)) AS p
              FROM (SELECT *, unnest(range(2, m)) AS size FROM candidates))) GROUP BY lang, phrase),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored s LEFT JOIN longer USING (lang, phrase)
  WHERE best = 1 AND (most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a))
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def _op13(k: int = 40, rounds: int = 5) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS m
  FROM (SELECT r, vec_id, kept.v AS v, c, list_sum(list_transform(list_zip(kept.v, c{i}.v),
               lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept, c{i}) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (
  SELECT c, list((s - (s % n + n) % n) // n ORDER BY p)::BIGINT[] AS v
  FROM (SELECT c, p, sum(x) AS s, count(*) AS n
        FROM (SELECT m.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{i}) GROUP BY c, p) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, 'null')) AS h, v FROM kept ORDER BY h, v LIMIT {k})),
{",".join(steps)}
SELECT vec_id, m.c::INTEGER AS cluster, m.d AS distance,
       sum(m.d) OVER (PARTITION BY m.c)::BIGINT AS cluster_inertia, sum(m.d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON m.c = c{rounds}.c"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": _op1(), "op2_chat_format": OP2, "op7_decontamination": OP7,
            "op8_ngram_jaccard_join": OP8, "op9_line_dedup": OP9,
            "op12_phrase_mining": OP12, "op13_centroid_clustering": _op13()}
