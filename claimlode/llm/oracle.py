"""SQL for a second engine: the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations

SQL: dict[str, str] = {
    "op7_source_mixing": r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
filled AS (
  SELECT *, row_number() OVER o AS place,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights
  FROM sources WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)),
cut AS (
  SELECT min(place) AS place FROM filled WHERE 3 * source_size * weights >= rest * weight),
shares AS (
  SELECT f.source, f.source_size,
         CASE WHEN f.place < c.place THEN 3.0::DOUBLE * f.source_size
              ELSE s.rest::DOUBLE / s.weights::DOUBLE * f.weight END AS target
  FROM filled f, (SELECT place FROM cut) c JOIN filled s ON s.place = c.place),
parts AS (
  SELECT d.doc_id, d.size, d.source, s.source_size, s.target,
         CASE WHEN d.size > 0 THEN floor(s.target / s.source_size * 16777216)::BIGINT ELSE 0 END AS part,
         ('0x' || substr(md5(concat_ws(chr(10), '1', d.source)), 1, 6))::BIGINT AS shift
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source),
summed AS (
  SELECT *, shift + sum(part) OVER (PARTITION BY source ORDER BY size, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM parts)
SELECT doc_id, size, source_size, target,
       ((upto // 16777216 - (upto - part) // 16777216) * size)::BIGINT AS taken
FROM summed
""",
    "op4_chat_formatting": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('<|im_start|>') + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\1\\|', 'g'))
             + 1 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1) AS chars
  FROM rows GROUP BY conv_id)
SELECT conv_id::BIGINT AS conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars
FROM joined
""",
    "op11_turn_repair": r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS k
  FROM conversations),
hashed AS (
  SELECT *, xor(4294967295, list_reduce(
           [4294967295::BIGINT] || list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT),
           lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END))) % 20 AS fault
  FROM keyed),
rows AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS time
  FROM hashed WHERE fault <> 0),
placed AS (
  SELECT *, row_number() OVER w AS place, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, time) AS seen,
         left(role, 1) AS initial, lag(left(role, 1)) OVER w AS previous,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, time)),
judged AS (
  SELECT *, CASE WHEN final = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS flaw
  FROM placed),
inserts(state, then_state, n, lines) AS (
  VALUES (0, 0, 0, []::VARCHAR[]), (1, 1, 0, []), (2, 2, 0, []), (3, 3, 0, []), (0, 2, 1, ['user:']), (1, 2, 1, ['user:']),
         (2, 3, 1, ['assistant:']), (3, 2, 1, ['user:']), (0, 3, 2, ['user:', 'assistant:']), (1, 3, 2, ['user:', 'assistant:'])),
edits(edit, state, then_state, speaker, price, told) AS (
  VALUES ('K', 0, 1, 's', 0, ''), ('K', 0, 2, 'u', 0, ''), ('K', 1, 2, 'u', 0, ''), ('K', 2, 3, 'a', 0, ''), ('K', 3, 2, 'u', 0, ''),
         ('R', 0, 2, '', 3, 'user'), ('R', 1, 2, '', 3, 'user'), ('R', 2, 3, '', 3, 'assistant'), ('R', 3, 2, '', 3, 'user'),
         ('D', 0, 0, '', 4, ''), ('D', 1, 1, '', 4, ''), ('D', 2, 2, '', 4, ''), ('D', 3, 3, '', 4, '')),
ways AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS place, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS best FROM judged
  UNION ALL
  SELECT w.conv_id, j.place, e.then_state, min({
      'cost': w.best.cost + 3 * i.n + e.price + CASE WHEN j.flaw = 'truncated' AND e.edit <> 'D' THEN 3 ELSE 0 END,
      'audit': w.best.audit || repeat('I', i.n) || e.edit,
      'lines': w.best.lines || i.lines || CASE e.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [j.role || ':' || j.text] ELSE [e.told || ':' || j.text] END})
  FROM ways w
  JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1
  JOIN inserts i ON i.state = w.state
  JOIN edits e ON e.state = i.then_state
  WHERE e.edit = 'D' OR (j.flaw NOT IN ('blank', 'duplicate') AND (e.edit = 'R' OR e.speaker = j.initial))
  GROUP BY w.conv_id, j.place, e.then_state),
counted AS (
  SELECT conv_id, max(place) AS places, count(*) FILTER (flaw = 'blank') AS blank, count(*) FILTER (flaw = 'duplicate') AS duplicate,
         count(*) FILTER (flaw = 'truncated') AS truncated,
         count(*) FILTER (place > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM judged GROUP BY conv_id),
ended AS (
  SELECT c.conv_id, min({'cost': w.best.cost + 3 * i.n, 'audit': w.best.audit || repeat('I', i.n), 'lines': w.best.lines || i.lines}) AS best
  FROM counted c JOIN ways w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.place = c.places
  JOIN inserts i ON i.state = w.state AND i.then_state IN (0, 3)
  GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
       coalesce(e.best.audit, '') AS audit, sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
""",
    "op12_pivot_links": r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, len(embedding) AS size, embedding::DOUBLE[] AS v,
         sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS length
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND a.size = b.size AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (a.length * b.length) >= 0.93),
reached AS (
  SELECT a AS vec_id, b AS other FROM links
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other),
joined AS (
  SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
         least(e.vec_id, coalesce((SELECT min(other) FROM reached r WHERE r.vec_id = e.vec_id), e.vec_id)) AS component_id
  FROM embeddings e)
SELECT vec_id, n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM joined
""",
}
