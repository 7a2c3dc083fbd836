"""The text queries that SQL can express, for comparison in DuckDB."""

from __future__ import annotations

from tallyhawk.llm import divergence, licences, line_rules, repeats

_WORD = r"[^\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _line_rules() -> str:
    r = line_rules
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS words FROM d),
win AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
counted AS (SELECT doc_id, line, count(*) AS times, len(regexp_extract_all(line, '{_WORD}')) AS n,
    regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS trimmed
  FROM ln WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id, line),
judged AS (SELECT *,
    (NOT regexp_matches(trimmed, {_text(r.SENTENCE_END)}) AND NOT regexp_matches(trimmed, {_text(r.SENTENCE_INSIDE)}))
    OR 100 * len(regexp_extract_all(line, '[#*$%&|<>]'))
       > {r.MOST_SYMBOLS} * length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))
    OR 100 * len(regexp_extract_all(line, {_text(r.SHOUT)})) > {r.MOST_SHOUTS} * n
    OR (n >= {r.LEAST_LOUD} AND upper(trimmed) = trimmed AND lower(trimmed) <> trimmed)
    OR (n <= {r.NAVIGATION_WORDS} AND (len(regexp_extract_all(line, {_text(r.SEPARATORS)})) >= 2
        OR regexp_matches(lower(trimmed), {_text(r.MENU)})))
    OR (n <= {r.BOILERPLATE_WORDS} AND regexp_matches(lower(trimmed), {_text(r.BOILERPLATE)})) AS fails
  FROM counted),
l AS (SELECT doc_id, sum(times - 1) AS dups, sum(CASE WHEN fails THEN 0 ELSE n END) AS kept_words FROM judged GROUP BY doc_id),
c AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(l.kept_words, 0) AS BIGINT) AS n_words_left
  FROM w LEFT JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id))
SELECT *, n_words < {r.LEAST_WORDS} OR 100 * n_repeat_words > {r.MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {r.LEAST_WORDS} OR 100 * n_repeat_words > {r.MOST_REPEATED} * n_words)
    AND 100 * (n_words - n_words_left) <= {r.MOST_LOST} * n_words AS kept
FROM c"""


def _licences() -> str:
    least = licences.LEAST_DICE
    values = ", ".join(f"({i}, {_text(name)}, {_text(text)})" for i, (name, text) in enumerate(licences.TEMPLATES))
    words = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    sentences = r"unnest(string_split(regexp_replace({}, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(1), 'g'), chr(1)))"
    return rf"""
WITH given(template, licence, text) AS (VALUES {values}),
tw AS (SELECT template, licence, string_split({words.format("text")}, ' ') AS w FROM given),
tb AS (SELECT DISTINCT template, licence, len(w) AS words, w[i] || ' ' || w[i + 1] AS b
  FROM (SELECT *, unnest(range(1, len(w))) AS i FROM tw)),
tn AS (SELECT *, count(*) OVER (PARTITION BY template) AS n_template FROM tb),
ln AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS u FROM documents),
wrapped AS (SELECT doc_id, unnest(string_split_regex(coalesce(text, ''), '{licences.BREAK}')) AS u FROM documents),
units AS (SELECT doc_id, u, 0 AS runs_over FROM ln
  UNION SELECT doc_id, {sentences.format("u")}, 0 FROM ln
  UNION SELECT doc_id, unnest(string_split_regex(coalesce(text, ''), '{licences.PARAGRAPH_GAP}')), 0 FROM documents
  UNION SELECT doc_id, {sentences.format("u")}, 1 FROM wrapped),
normal AS (SELECT doc_id, {words.format("u")} AS unit, min(runs_over) AS runs_over FROM units GROUP BY ALL),
ub AS (SELECT DISTINCT doc_id, unit, w[i] || ' ' || w[i + 1] AS b
  FROM (SELECT *, unnest(range(1, len(w))) AS i FROM (SELECT *, string_split(unit, ' ') AS w FROM normal))),
un AS (SELECT doc_id, unit, count(*) AS n_unit FROM ub GROUP BY doc_id, unit),
shared AS (SELECT ub.doc_id, ub.unit, template, licence, n_template, count(*) AS n
  FROM ub JOIN tn USING (b) GROUP BY ALL),
scored AS (SELECT doc_id, unit, template, licence, 2 * n / CAST(n_unit + n_template AS DOUBLE) AS dice
  FROM shared JOIN un USING (doc_id, unit)),
near AS (SELECT * FROM scored JOIN normal USING (doc_id, unit) WHERE dice >= {least}
  QUALIFY row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, template) = 1),
counted AS (SELECT doc_id, licence, unit, dice, false AS win FROM near x WHERE runs_over = 0 OR NOT EXISTS (
  SELECT 1 FROM near y WHERE y.doc_id = x.doc_id AND y.licence = x.licence AND y.runs_over = 0 AND y.dice >= x.dice
    AND contains(' ' || x.unit || ' ', ' ' || y.unit || ' '))),
dw AS (SELECT doc_id, string_split({words.format("coalesce(text, '')")}, ' ') AS w FROM documents),
pos AS (SELECT doc_id, i, len(w) AS long, w[i] || ' ' || w[i + 1] AS b FROM (SELECT *, unnest(range(1, len(w))) AS i FROM dw)),
met AS (SELECT doc_id, i, long, b, template, licence, words, n_template FROM pos JOIN tn USING (b)),
start AS (SELECT DISTINCT doc_id, template, licence, words, n_template, least(i, greatest(long - words + 1, 1)) AS i FROM met),
full_ AS (SELECT a.doc_id, a.template, a.licence, a.words, a.n_template, a.i FROM start a
  JOIN met c ON c.doc_id = a.doc_id AND c.template = a.template AND c.i BETWEEN a.i AND a.i + a.words - 2
  GROUP BY ALL HAVING count(DISTINCT c.b) * (2 - {least}) + 1e-6 >= a.n_template * {least}),
held AS (SELECT f.doc_id, f.template, f.licence, f.words, f.n_template, f.i, count(DISTINCT p.b) AS n_own, count(DISTINCT tb.b) AS n
  FROM full_ f JOIN pos p ON p.doc_id = f.doc_id AND p.i BETWEEN f.i AND f.i + f.words - 2
  LEFT JOIN tb ON tb.template = f.template AND tb.b = p.b GROUP BY ALL),
hit AS (SELECT h.doc_id, template, licence, i, 2 * n / CAST(n_own + n_template AS DOUBLE) AS dice, dw.w[i:i + words - 1] AS ws
  FROM held h JOIN dw USING (doc_id) WHERE 2 * n / CAST(n_own + n_template AS DOUBLE) >= {least}),
place AS (SELECT *, unnest(range(i, i + len(ws))) AS p FROM hit),
first_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, p ORDER BY dice DESC, template, i) = 1 AS first_here FROM place),
won AS (SELECT doc_id, template, licence, i, dice, array_to_string(ws, ' ') AS unit FROM first_ GROUP BY ALL HAVING bool_and(first_here)),
inside AS (SELECT doc_id, licence, unit, max(dice) AS dice, true AS win FROM won GROUP BY doc_id, licence, unit),
stated AS (SELECT * FROM counted UNION ALL SELECT doc_id, licence, unit, dice, win FROM inside),
further AS (SELECT *, NOT win OR NOT EXISTS (SELECT 1 FROM counted y WHERE y.doc_id = x.doc_id AND y.licence = x.licence
    AND (contains(' ' || x.unit || ' ', ' ' || y.unit || ' ') OR contains(' ' || y.unit || ' ', ' ' || x.unit || ' '))) AS counts
  FROM stated x),
best AS (SELECT *, count(*) FILTER (counts) OVER (PARTITION BY doc_id, licence) AS n_units FROM further
  QUALIFY row_number() OVER (PARTITION BY doc_id, licence ORDER BY dice DESC, win, unit) = 1)
SELECT doc_id, licence, dice, n_units, unit AS statement FROM best"""


def _repeats() -> str:
    n = repeats.WINDOW
    return rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + {n - 1}], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {n - 2})) AS i FROM w)),
later AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i FROM later),
one AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
  FROM one ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def _divergence() -> str:
    d = divergence

    def share(n: str, total: str) -> str:
        return f"CAST(1 + CAST({d.UNIT} AS HUGEINT) * ({n} + {d.SMOOTHING}) // ({total} + {d.SMOOTHING} * v) AS BIGINT)"

    return rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY ALL HAVING count(*) >= {d.LEAST_DOCUMENTS}),
n AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM d) JOIN kept USING (lang, term) GROUP BY ALL),
c AS (SELECT g.lang, g.source, term, coalesce(n.n, 0) AS n, count(*) OVER (PARTITION BY g.lang, g.source) AS v
  FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang, term) AS lang_n,
    sum(n) OVER (PARTITION BY lang) AS lang_total FROM c),
p AS (SELECT lang, source, term, n, {share("n", "total")} AS p, {share("lang_n", "lang_total")} AS q FROM s),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(far.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {d.MOST_TERMS}"""


ORACLES: dict[str, str] = {
    "op12_divergence": _divergence(),
    "op4_licences": _licences(),
    "op7_repeats": _repeats(),
    "op8_line_rules": _line_rules(),
}
