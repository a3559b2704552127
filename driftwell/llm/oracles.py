"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from driftwell.llm import licenses, merkle, mixing, top_scores, url_lists, vector_codes
from driftwell.llm.license_texts import TEMPLATES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licenses() -> str:
    rows = ", ".join(
        f"({_quoted(name)}, [{', '.join(map(_quoted, licenses.template_bigrams(text)))}])" for name, text in sorted(TEMPLATES.items())
    )
    return rf"""
WITH templates(license, bigrams) AS (VALUES {rows}),
cleaned AS (SELECT rowid AS row_id, doc_id, regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS value FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
units AS (
  SELECT row_id, unnest(list_distinct(list_transform(
    string_split(value, chr(10))
    || list_transform(string_split_regex(value, '\n *\n[ \n]*'), lambda b: regexp_replace(b, '[ \n]+', ' ', 'g'))
    || [regexp_replace(value, '[ \n]+', ' ', 'g')], lambda u: trim(u)))) AS unit
  FROM cleaned WHERE value IS NOT NULL),
grams AS (
  SELECT row_id, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigrams
  FROM (SELECT row_id, string_split(unit, ' ') AS words FROM units)),
matches AS (
  SELECT row_id, license, 2.0::DOUBLE * len(list_intersect(g.bigrams, t.bigrams)) / (len(g.bigrams) + len(t.bigrams)) AS dice
  FROM grams g, templates t WHERE len(g.bigrams) > 0),
kept AS (SELECT * FROM matches WHERE dice >= {licenses.MIN_DICE}),
summed AS (
  SELECT row_id, count(*) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
    first(license ORDER BY dice DESC, license) AS best, max(dice) AS best_dice
  FROM kept GROUP BY row_id)
SELECT doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses, best, best_dice
FROM cleaned LEFT JOIN summed USING (row_id)"""


def _fingerprints() -> str:
    piece = merkle.PIECE.replace("'", "''")
    section = merkle.SECTION_BREAK

    def printed(column: str) -> str:
        pieces = f"list_transform(CASE WHEN p = '' THEN [''] ELSE regexp_extract_all(p, '{piece}') END, lambda x: sha256(x))"
        paragraph = f"list_transform([{pieces}], lambda l: {{'digest': sha256(array_to_string(l, '')), 'list': array_to_string(list_transform(l, lambda d: left(d, {merkle.PIECE_DIGITS})), '')}})[1]"
        paragraphs = f"list_transform(string_split(s, chr(10)), lambda p: {paragraph})"
        shown = f"list_transform(q, lambda r: left(r.digest, {merkle.DIGITS}) || '=' || r.list)"
        own = "sha256(array_to_string(list_transform(q, lambda r: r.digest), ''))"
        section_ = f"list_transform([{paragraphs}], lambda q: {{'digest': {own}, 'shown': left({own}, {merkle.DIGITS}) || ':' || array_to_string({shown}, ',')}})[1]"
        sections = f"list_transform(string_split_regex({column}, '{section}'), lambda s: {section_})"
        return f"list_transform([{sections}], lambda v: sha256(array_to_string(list_transform(v, lambda w: w.digest), '')) || '/' || array_to_string(list_transform(v, lambda w: w.shown), ';'))[1]"

    def pieces(column: str) -> str:
        lists = f"array_to_string(regexp_extract_all({column}, '=([0-9a-f]*)', 1), '')"
        return f"list_distinct(regexp_extract_all({lists}, '[0-9a-f]{{{merkle.PIECE_DIGITS}}}'))"

    return rf"""
WITH own AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
ordered AS (SELECT *, row_number() OVER (ORDER BY doc_id DESC NULLS LAST) AS place, count(*) OVER () AS n FROM own),
following AS (
  SELECT a.doc_id, a.text, b.text AS next FROM ordered a JOIN ordered b ON b.place = CASE WHEN a.place = a.n THEN 1 ELSE a.place + 1 END),
edits AS (
  SELECT *, left(text, length(text) - length(text) // 2) || left(next, length(text) // 2) AS edited FROM following),
prints AS (
  SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
    {printed("text")} AS fingerprint, {printed("edited")} AS edited_fingerprint, {printed("next")} AS next_fingerprint FROM edits),
lists AS (
  SELECT *, {pieces("fingerprint")} AS own, {pieces("edited_fingerprint")} AS edited, {pieces("next_fingerprint")} AS next FROM prints)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  2.0::DOUBLE * len(list_intersect(own, edited)) / (len(own) + len(edited)) AS near_edited,
  2.0::DOUBLE * len(list_intersect(own, next)) / (len(own) + len(next)) AS near_next
FROM lists"""


_URL_LISTS = rf"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_days(((page_id * 7919) % 366)::INT) + to_minutes((page_id * 104729) % 1440) AS fetched_at,
    nullif(regexp_replace(lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@\s]+)', 1)), '\.$', ''), '') AS host,
    list_filter(string_split(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda s: s <> '')[1:{url_lists.PATH_DEPTH}] AS segments
  FROM pages),
asked AS (
  SELECT page_id, url, fetched_at, unnest(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda n: {{'rank': n, 'key': array_to_string(string_split(host, '.')[len(string_split(host, '.')) - n + 1:], '.')}})
    || list_transform(range(1, len(segments) + 1), lambda i: {{'rank': len(string_split(host, '.')) + i, 'key': host || '/' || array_to_string(segments[1:i], '/')}})) AS k
  FROM captures WHERE host IS NOT NULL),
numbers AS (SELECT key, ('0x' || left(md5(key), 6))::BIGINT AS n, contains(key, '/') AS in_path FROM (SELECT DISTINCT k.key AS key FROM asked)),
entries AS (
  SELECT key, 'allow' AS action, n % 300 AS day FROM numbers WHERE in_path AND n % 5 = 0
  UNION ALL SELECT key, unnest(['block', 'remove', 'block']), unnest([n % 200, n % 200 + 60, n % 200 + 150]) FROM numbers WHERE NOT in_path AND n % 3 = 0
  UNION ALL SELECT key, unnest(['allow', 'block']), unnest([n % 100, n % 100 + 120]) FROM numbers WHERE NOT in_path AND n % 3 = 1),
valid AS (
  SELECT key, action, TIMESTAMP '2024-01-01' + to_days(day::INT) AS since,
    lead(TIMESTAMP '2024-01-01' + to_days(day::INT)) OVER (PARTITION BY key ORDER BY day) AS until FROM entries),
hits AS (
  SELECT page_id, url, action, key, since, row_number() OVER (PARTITION BY page_id, url ORDER BY k.rank DESC) AS turn
  FROM asked JOIN valid ON k.key = key AND since <= fetched_at AND (until IS NULL OR fetched_at < until) WHERE action <> 'remove')
SELECT c.page_id, CASE WHEN host IS NULL OR fetched_at IS NULL THEN 'unknown' ELSE coalesce(action, 'none') END AS verdict, key, since
FROM captures c LEFT JOIN hits h ON h.page_id = c.page_id AND h.url = c.url AND turn = 1"""


_MIXING = rf"""
WITH sized AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(len(regexp_extract_all(text, '{mixing.WORD}')), 0) AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS shuffle_key FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [{', '.join(map(str, mixing.WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS number FROM sized GROUP BY source),
ordered AS (
  SELECT *, row_number() OVER bind AS turn,
    ({mixing.SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum({mixing.MOST} * source_size) OVER (bind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER (bind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM sources WINDOW bind AS (ORDER BY source_size / weight, number)),
fit AS (SELECT turn, level FROM ordered WHERE level * weight <= {mixing.MOST} * source_size ORDER BY turn LIMIT 1),
targets AS (
  SELECT o.*, CASE WHEN f.turn IS NULL OR o.turn < f.turn THEN ({mixing.MOST} * source_size)::DOUBLE ELSE f.level * weight END AS target
  FROM ordered o LEFT JOIN fit f ON true),
placed AS (
  SELECT s.*, source_size, target, floor(target)::BIGINT AS words,
    coalesce(sum(size) OVER (PARTITION BY number ORDER BY shuffle_key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_word
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE words // source_size * size + greatest(0, least(first_word + size, words % source_size) - first_word) END AS taken
FROM placed"""


_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

_TOP_SCORES = rf"""
WITH vectors AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor({top_scores.FACTOR} * x::DOUBLE)) AS c
  FROM embeddings WHERE {_USABLE}),
scored AS (
  SELECT q.row_id, q.vec_id AS query_id, v.vec_id, list_inner_product(q.c, v.c)::BIGINT AS score, v.row_id AS other
  FROM vectors q JOIN vectors v ON q.row_id <> v.row_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY row_id ORDER BY score DESC, vec_id NULLS LAST, other)
QUALIFY row_number() OVER best <= 20"""


def _vector_codes() -> str:
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES
    steps = []
    for step in range(vector_codes.ROUNDS + 1):
        steps.append(f"""
near{step} AS (
  SELECT a.n, a.p, min(list_sum(list_transform(list_zip(a.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {entries} + b.e) AS best
  FROM cut a JOIN book{step} b USING (p) GROUP BY a.n, a.p)""")
        if step < vector_codes.ROUNDS:
            steps.append(f"""
sums{step} AS (
  SELECT p, best % {entries} AS e, i, sum(v)::BIGINT AS total, count(*) AS number
  FROM (SELECT c.p, best, unnest(c.c) AS v, unnest(range(len(c.c))) AS i FROM cut c JOIN near{step} USING (n, p)) GROUP BY ALL),
book{step + 1} AS (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{step} b
  LEFT JOIN (SELECT p, e, list((total - ((total % number) + number) % number) // number ORDER BY i) AS c FROM sums{step} GROUP BY p, e) m USING (p, e))""")
    last = vector_codes.ROUNDS
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS n, vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.FACTOR} * x::DOUBLE)::BIGINT) AS numbers
  FROM embeddings WHERE {_USABLE}),
cut AS (
  SELECT n, p, numbers[p * (len(numbers) // {parts}) + 1 : (p + 1) * (len(numbers) // {parts})] AS c
  FROM (SELECT n, numbers, unnest(range({parts})) AS p FROM kept)),
book0 AS (SELECT p, n AS e, c FROM cut WHERE n < {entries}),{','.join(steps)},
coded AS (
  SELECT n, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error FROM near{last} GROUP BY n),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{last})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN coded USING (n), digest"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_licenses": _licenses(),
        "op3_fingerprints": _fingerprints(),
        "op9_url_lists": _URL_LISTS,
        "op10_mixing": _MIXING,
        "op11_top_scores": _TOP_SCORES,
        "op13_vector_codes": _vector_codes(),
    }
