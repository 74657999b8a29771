"""SQL counterparts of the operators that SQL can express. The others are tested against brute force."""

from __future__ import annotations

import re

from daybook.llm.licences import PHRASES, TEMPLATES
from daybook.llm.sharding import DIGITS, SHARDS, SLOTS, filled_table, shard_names

WORD_COUNT = r"coalesce(len(regexp_extract_all({}, '[^\x20\x09-\x0D]+')), 0)"

PRODUCTS = """
WITH vectors AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""

# Sources at their cap are found step by step: each round takes those that the level of the others exceeds.
MIXING = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST({WORD_COUNT.format("text")} AS BIGINT) AS size,
    md5(md5(coalesce(text, '')) || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, source_rank % 3 + 1 AS weight, 3 * source_size AS cap FROM sources
), levels(round, level) AS (
  SELECT 0, CAST(sum(source_size) AS DOUBLE) / sum(weight) FROM weighted
  UNION ALL
  SELECT round + 1, (SELECT CASE WHEN count(*) FILTER (cap > level * weight) = 0 THEN level ELSE
    CAST(sum(source_size) - coalesce(sum(cap) FILTER (cap <= level * weight), 0) AS DOUBLE)
      / sum(weight) FILTER (cap > level * weight) END FROM weighted)
  FROM levels WHERE round < (SELECT count(*) FROM weighted)
), targets AS (
  SELECT source, source_size, source_rank, least(CAST(cap AS DOUBLE), (SELECT arg_max(level, round) FROM levels) * weight) AS target
  FROM weighted
), queued AS (
  SELECT s.*, source_size, source_rank, target,
    row_number() OVER (PARTITION BY source_rank ORDER BY h) AS place,
    coalesce(sum(size) OVER (PARTITION BY source_rank ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, copy * source_size + start AS first, first < target AND first + size > target AS meets,
    CASE WHEN meets THEN CAST(floor(target) AS BIGINT) - first ELSE size END AS words,
    CASE WHEN meets THEN 1 ELSE CAST(first + size AS DOUBLE) / target END AS finish
  FROM queued, (SELECT unnest([0, 1, 2]) AS copy) WHERE size > 0 AND target > 0
), mixed AS (
  SELECT source_rank, place, words, sum(words) OVER (ORDER BY finish, source_rank, copy, h, place) AS spent
  FROM copies WHERE words > 0
), words AS (
  SELECT source_rank, place, sum(words) AS taken FROM mixed WHERE spent <= (SELECT sum(size) FROM sized) GROUP BY ALL
)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queued LEFT JOIN words USING (source_rank, place)
"""

LINES = rf"""
WITH split AS (
  SELECT doc_id, source, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents
), keyed AS (
  SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key,
    {WORD_COUNT.format("line")} AS n, n >= 1 AS counts FROM split
), enough AS (
  SELECT greatest(2, (count(DISTINCT source) + 4) // 5) AS sites FROM documents
), wide AS (
  SELECT key FROM keyed WHERE counts GROUP BY key
  HAVING count(DISTINCT source) >= CASE WHEN max(n) > 50 THEN 2 ELSE (SELECT sites FROM enough) END
), marked AS (
  SELECT k.*, w.key IS NOT NULL AND row_number() OVER (PARTITION BY k.key, counts ORDER BY doc_id NULLS LAST, place) > 1 AS goes
  FROM keyed k LEFT JOIN wide w ON counts AND k.key = w.key
)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT goes), '') END AS text,
  CAST(CASE WHEN text IS NULL THEN 0 ELSE count(*) END AS INTEGER) AS lines, CAST(count(*) FILTER (goes) AS INTEGER) AS removed
FROM marked GROUP BY doc_id, marked.text
"""


def sharding_sql() -> str:
    table = ", ".join(map(str, filled_table(shard_names(SHARDS), SLOTS)))
    return f"""
WITH slots AS (
  SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, {DIGITS}) AS BIGINT) % {SLOTS} AS slot FROM documents
), shards AS (SELECT [{table}] AS by_slot)
SELECT doc_id, slot, CAST(by_slot[slot + 1] AS INTEGER) AS shard FROM slots, shards
"""


MIDDLE = r"""
WITH tokens AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t FROM documents
), drawn AS (
  SELECT *, CAST(len(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(t) + 1) AS c1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(t) + 1) AS c2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
    CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM tokens
), cut AS (
  SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
    OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    coalesce(array_to_string(t[1:least(c1, c2)], ''), '') AS prefix,
    coalesce(array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS middle,
    coalesce(array_to_string(t[greatest(c1, c2) + 1:], ''), '') AS suffix FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM cut
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DIVERGENCE = rf"""
WITH numbered AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), used AS (
  SELECT id, lang, source, unnest(terms) AS term FROM numbered
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM used GROUP BY ALL HAVING count(DISTINCT id) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM numbered
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM used SEMI JOIN kept USING (lang, term) GROUP BY ALL
), whole AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, v, lang_total
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (total + 5 * v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (lang_n + 5)) // (lang_total + 5 * v) AS q FROM whole
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups o ON o.lang = g.lang AND o.source <> g.source
    LEFT JOIN apart a ON a.lang = g.lang AND a.source = g.source AND a.item = o.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def _pattern(markup: str) -> str:
    """A licence template as a regular expression over words with a blank before each, and one behind the last."""
    steps = (
        (r"\s+", " "),
        (r" *([\[\]|]) *", r"\1"),
        (r"\{(\d+)-(\d+)\}", r"#\1,\2#"),
        (r"(^|[\[|\]])(?=[a-z0-9#])", r"\1 "),
        (r"\[", "(?:"),
        (r"\]", ")?"),
        (r" #(\d+),(\d+)#", r"(?: [^ ]+){\1,\2}"),
    )
    for this, that in steps:
        markup = re.sub(this, that, markup.strip() if this == r"\s+" else markup)
    return markup + " "


def licences_sql() -> str:
    wanted = [(phrase, label, True) for phrase, label in PHRASES.items()] + [(m, label, False) for label, m in TEMPLATES]
    found, base, firsts = [], [], []
    for markup, label, is_base in wanted:
        must = len(re.sub(r"\{[^}]*\}", "", _outermost(markup)).split())
        found.append(f"CASE WHEN regexp_matches(line, '{_pattern(markup)}') THEN {{'label': '{label}', 'must': {must}, 'base': {is_base}}} END")
        if is_base:
            same = " AND ".join(f"z[{i}] = '{word}'" for i, word in enumerate(markup.split(), 1))
            firsts.append(f"[z[5] FOR z IN beside IF {same}]")

    def labels(which: str) -> str:
        return f"array_to_string(list_sort(list_distinct([x.label FOR x IN found IF {which}])), ',')"

    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), scanned AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line, list_zip(w, w[2:], w[3:], w[4:], range(len(w))) AS beside FROM words
), matched AS (
  SELECT doc_id, w, [x FOR x IN [{", ".join(found)}] IF x IS NOT NULL] AS found, {" || ".join(firsts)} AS firsts FROM scanned
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(firsts) AS BIGINT) AS n_base, list_min(firsts) AS first_word,
  list_max(firsts) AS last_word, coalesce({labels("x.base")}, '') AS base_labels, coalesce({labels("true")}, '') AS labels,
  coalesce(CAST(list_max([x.must FOR x IN found]) AS DOUBLE) / (list_max([x.must FOR x IN found]) + 1), 0) AS score
FROM matched
"""


def _outermost(markup: str) -> str:
    while "[" in markup:
        markup = re.sub(r"\[[^\[\]]*\]", " ", markup)
    return markup


def llm_oracles() -> dict[str, str]:
    return {
        "op2_highest_products": PRODUCTS,
        "op7_mixing": MIXING,
        "op8_lines": LINES,
        "op10_sharding": sharding_sql(),
        "op11_fill_in_middle": MIDDLE,
        "op12_source_divergence": DIVERGENCE,
        "op13_licences": licences_sql(),
    }
