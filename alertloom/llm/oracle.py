"""The results of those operators of this folder that SQL can express, for DuckDB."""

OP13_MIXING = r"""
WITH rows_ AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         2.0::DOUBLE * sum(size)::DOUBLE AS most
  FROM rows_ GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER before, 0.0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0)) AS level
  FROM sizes
  WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), wanted AS (
  SELECT source, source_size,
         CASE WHEN level * weight > most THEN most
              ELSE weight * first_value(CASE WHEN level * weight > most THEN NULL ELSE level END IGNORE NULLS)
                   OVER (ORDER BY most / weight, source NULLS LAST
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS target
  FROM levels
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes
  FROM wanted
), run AS (
  SELECT r.doc_id, r.size, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY key, r.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM rows_ r JOIN planned p ON r.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (passes + CASE WHEN rest > 0 AND (upto <= rest OR (upto - size <= rest AND upto - rest <= rest - (upto - size)))
                                  THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""

OP12_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS (
  SELECT lang, m, ws[i : i + m - 1] AS g, count(*) AS f
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM words, range(1, 6) t(m))
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM grams WHERE m = 1 GROUP BY lang
), frequent AS (
  SELECT * FROM grams WHERE f >= 100
), inside AS (
  SELECT lang, g, max(f) AS around FROM (
    SELECT lang, g[2:] AS g, f FROM frequent WHERE m > 2 UNION ALL SELECT lang, g[:m - 1], f FROM frequent WHERE m > 2)
  GROUP BY lang, g
), cuts AS (
  SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, n,
         (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM frequent WHERE m > 1) c
  JOIN frequent l ON l.lang = c.lang AND l.g = c.g[:k]
  JOIN frequent r ON r.lang = c.lang AND r.g = c.g[k + 1:]
  JOIN totals t ON t.lang = c.lang
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, array_to_string(s.g, ' ')) AS rank
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.g = s.g
  WHERE around IS NULL OR around < a
)
SELECT lang, rank, array_to_string(g, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


def _more(cell: str, cost: str, letters: str) -> str:
    """A cell of eight digits of cost and the audit after them, so that the least string is the best one."""
    return f"(lpad(CAST(CAST(left({cell}, 8) AS INTEGER) + {cost} AS VARCHAR), 8, '0') || substr({cell}, 9) || '{letters}')"


def _least(*cells: str) -> str:
    return f"list_min([{', '.join(cells)}])"


def _repair_step() -> str:
    """The cells of the four states after a row x = [initial, fault, truncated], from those before, c."""
    state = lambda p: f"c[{p + 1}]"
    taken = lambda p, initial: (
        f"CASE WHEN x[2] <> '' THEN NULL WHEN x[1] = '{initial}' THEN {_more(state(p), 'CAST(x[3] AS INTEGER)', 'K')}"
        f" ELSE {_more(state(p), '2 + CAST(x[3] AS INTEGER)', 'R')} END"
    )
    system = f"CASE WHEN x[2] = '' AND x[1] = 's' THEN {_more(state(0), 'CAST(x[3] AS INTEGER)', 'K')} END"
    gone = [_more(state(p), "3", "D") for p in range(4)]
    after = [
        gone[0],
        _least(gone[1], system),
        _least(gone[2], taken(0, "u"), taken(1, "u"), taken(3, "u")),
        _least(gone[3], taken(2, "a")),
    ]
    closed = [
        after[0],
        after[1],
        _least(after[2], *[_more(after[p], "2", "I") for p in (0, 1, 3)]),
        _least(after[3], _more(after[2], "2", "I"), *[_more(after[p], "4", "II") for p in (0, 1)]),
    ]
    return f"[{', '.join(closed)}]"


OP11_REPAIR = rf"""
WITH shifts AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, b: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                        lambda x: CAST(ord(x) AS BIGINT)) AS name
  FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce([4294967295] || name, lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) % 20 AS kind
  FROM named, shifts
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), digested AS (
  SELECT *, md5(length(role) || ':' || role || text) AS digest, left(role, 1) AS initial,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
  FROM damaged
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS rn FROM digested
), marked AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, digest ORDER BY rn) > 1 THEN 'duplicate' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY rn) || initial AS pair
  FROM numbered
), cut AS (
  SELECT *, CASE WHEN fault = '' AND right(solid, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS truncated FROM marked
), parsed AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         sum(truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         list_reduce([['00000000', '99000000', '00000002I', '00000004II']]
                     || list([initial, fault, CAST(truncated AS VARCHAR)] ORDER BY rn), lambda c, x: {_repair_step()}) AS cells
  FROM cut GROUP BY conv_id
), best AS (
  SELECT *, least(cells[1], cells[4]) AS cell, substr(least(cells[1], cells[4]), 9) AS audit FROM parsed
), letters AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS i FROM best WHERE audit <> ''
), places AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER sofar AS rn, count(*) FILTER (edit <> 'D') OVER sofar AS seat FROM letters
  WINDOW sofar AS (PARTITION BY conv_id ORDER BY i)
), lines AS (
  SELECT p.conv_id, p.i, p.seat, p.edit, c.role, c.text,
         max(CASE WHEN p.seat = 1 AND p.edit = 'K' AND c.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS shift
  FROM places p LEFT JOIN cut c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.rn = p.rn AND p.edit <> 'I'
  WHERE p.edit <> 'D'
), repaired AS (
  SELECT conv_id, sha256(string_agg(
           CASE WHEN edit = 'K' THEN role WHEN (seat - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
           chr(10) ORDER BY i)) AS sha
  FROM lines GROUP BY conv_id
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(left(cell, 8), '0') AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""

ORACLE = {"op11_conversation_repair": OP11_REPAIR, "op12_phrase_collocations": OP12_PHRASES, "op13_source_mixing": OP13_MIXING}
