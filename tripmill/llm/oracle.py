"""DuckDB twins of the queries of this subpackage that SQL can express."""

from __future__ import annotations

import corpus_pipeline


EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


URL_FILTER = """
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT row_number() OVER () AS page, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), fits AS (
  SELECT p.page, arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) AS best
  FROM parsed p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM parsed LEFT JOIN fits USING (page)
"""


# Edits are of characters. DuckDB counts bytes, so the characters of two lines are written as one byte each, which holds
# for up to 126 different characters in both lines. Two edits of characters are at most eight of bytes.
LINE_DEDUP = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, CAST(n - 1 AS INTEGER) AS line_no, parts[n] AS line
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS n FROM split)
  WHERE trim(parts[n]) <> ''
), firsts AS (
  SELECT line, length(line) AS size, min(struct_pack(d := doc_id, n := line_no)) AS place FROM lines GROUP BY line
), close AS (
  SELECT u.line, v.line AS other, levenshtein(u.line, v.line) AS bytes FROM firsts u JOIN firsts v
    ON v.size BETWEEN u.size - 2 AND u.size + 2 AND v.place < u.place AND u.size >= 20 AND v.size >= 20
       AND levenshtein(u.line, v.line) <= 8
), coded AS (
  SELECT *, list_distinct(string_split(line || other, '')) AS letters FROM close
), near AS (
  SELECT DISTINCT line FROM coded
  WHERE bytes <= 2 OR levenshtein(
    array_to_string(list_transform(string_split(line, ''), lambda c: chr(CAST(list_position(letters, c) AS INTEGER))), ''),
    array_to_string(list_transform(string_split(other, ''), lambda c: chr(CAST(list_position(letters, c) AS INTEGER))), '')) <= 2
)
SELECT DISTINCT l.doc_id, l.line_no, n.line IS NOT NULL AS near
FROM lines l JOIN firsts f USING (line) LEFT JOIN near n USING (line)
WHERE n.line IS NOT NULL OR (l.doc_id, l.line_no) <> (f.place.d, f.place.n)
"""


INFILLING = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, body, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM units
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, n, form, body, coalesce(array_to_string(u[1:lo], ''), '') AS prefix,
         coalesce(array_to_string(u[lo + 1:hi], ''), '') AS middle, coalesce(array_to_string(u[hi + 1:], ''), '') AS suffix
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""


COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), windows AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, range(1, 5) sizes(k) WHERE len(w) >= k
), counts AS (
  SELECT lang, w[i:i + k - 1] AS p, k, count(*) AS f FROM windows GROUP BY ALL
), frequent AS (SELECT * FROM counts WHERE f >= 30
), totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
), cuts AS (
  SELECT c.lang, c.p, c.k, c.f AS a, j, l.f AS l, r.f AS r, CAST(2000000 AS HUGEINT) * c.f // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM frequent WHERE k > 1) c
  JOIN frequent l ON l.lang = c.lang AND l.p = c.p[1:j]
  JOIN frequent r ON r.lang = c.lang AND r.p = c.p[j + 1:]
), worst AS (
  SELECT lang, p, k, a, arg_min(struct_pack(l := l, r := r), score * 10 + j) AS cut, min(score) AS score
  FROM cuts GROUP BY lang, p, k, a
), inner_parts AS (
  SELECT lang, k, f, p[s:s + size - 1] AS part
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS s FROM frequent, range(2, 4) sizes(size) WHERE size < k)
), longer AS (SELECT lang, part, max(f) AS most FROM inner_parts GROUP BY lang, part
), ranked AS (
  SELECT w.lang, array_to_string(w.p, ' ') AS phrase, a, cut.l AS l, cut.r AS r, score,
         row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, array_to_string(w.p, ' ')) AS rank
  FROM worst w LEFT JOIN longer o ON o.lang = w.lang AND o.part = w.p
  WHERE o.most IS NULL OR CAST(100 AS HUGEINT) * o.most < CAST(80 AS HUGEINT) * a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


# Kind, pattern, group with the value, its least size, part, and whether the kind is weak.
SECRET_KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, "secret", False),
    ("access", "(AKIA[A-Z0-9]+)", 16, "name", False),
    ("hex", "([0-9a-f]+)", 32, "secret", False),
    ("user", r"""\b(?i:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]+)""", 3, "name", True),
    ("value", r"""\b(?i:pass|pwd|passphrase|credentials?|auth|private_?key|key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, "secret", True),
    ("base64", "([A-Za-z0-9+/]+)", 40, "secret", True),
    ("url", r"\b([a-z][a-z0-9+.-]*://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+)", 8, "address", True),
    ("host", r"""\b(?i:host(?:_?name)?|endpoint|server)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._:-]+)""", 4, "address", True),
)


def _secrets() -> str:
    """All spans by splitting, links by all pairs of a document."""
    kinds = []
    for rank, (kind, pattern, least, part, weak) in enumerate(SECRET_KINDS):
        quoted = "'" + pattern.replace("'", "''") + "'"
        kinds.append(f"""
  SELECT r, doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, '{part}' AS part, {weak} AS weak,
         string_split_regex(body, {quoted}) AS gaps, regexp_extract_all(body, {quoted}) AS hits,
         regexp_extract_all(body, {quoted}, 1) AS vals
  FROM docs WHERE regexp_matches(body, {quoted})""")
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
searched AS ({" UNION ALL ".join(kinds)}),
parts AS (
  SELECT r, rank, kind, least, part, weak, unnest(range(1, len(hits) + 1)) AS i, unnest(gaps[1:len(hits)]) AS gap,
         unnest(hits) AS hit, unnest(vals) AS val
  FROM searched
), placed AS (
  SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY r, rank ORDER BY i) AS BIGINT) AS stop FROM parts
), spans AS (
  SELECT r, rank, kind, part, weak, stop - length(hit) AS start, stop FROM placed WHERE length(val) >= least
), kept AS (
  SELECT * FROM spans s
  WHERE NOT weak OR (
    NOT EXISTS (SELECT 1 FROM spans t WHERE t.r = s.r AND NOT t.weak AND t.start < s.stop AND s.start < t.stop)
    AND EXISTS (SELECT 1 FROM spans t WHERE t.r = s.r AND abs(t.start - s.start) < 400
                AND CASE s.part WHEN 'secret' THEN t.part IN ('name', 'address') ELSE t.part = 'secret' END))
), told AS (
  SELECT r, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access, count_if(kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (NOT weak) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM kept GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (r)
"""


def sql() -> dict[str, str]:
    twins = {
        "op7_line_dedup": LINE_DEDUP,
        "op9_exact_dedup": EXACT_DEDUP,
        "op10_url_filter": URL_FILTER,
        "op11_infilling": INFILLING,
        "op12_collocations": COLLOCATIONS,
        "op13_secrets": _secrets(),
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: twin for name, twin in twins.items() if twin}
