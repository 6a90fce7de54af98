"""DuckDB SQL for the queries that SQL can express, written plainly over whole tables."""

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

EXACT = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept,
       text_sha256
FROM t
"""

WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, coalesce(html, '') AS body,
         sha1(coalesce(html, '')) AS hex FROM pages),
o AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM p),
d AS (
  SELECT *, list_aggregate(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
        (CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)),
    'string_agg', '') AS payload_digest
  FROM o)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""

MIXING = rf"""
WITH t AS (
  SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size, md5(coalesce(text, '')) AS digest, substr(digest, 1, 16) AS tie,
         greatest(20, coalesce(length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) * 100 // greatest(length(text), 1), 20)) AS quality
  FROM documents),
k AS (
  SELECT *, -ln((CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '#' || digest)), 1, 12) AS BIGINT) + 0.5::DOUBLE)
      / 281474976710656.0::DOUBLE) / quality AS key FROM t),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s),
l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (
      ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
g AS (SELECT arg_min(level, cap / weight) AS level FROM l WHERE level * weight <= cap),
q AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * (SELECT level FROM g)) AS target FROM w),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM q),
r AS (
  SELECT k.*, source_size, target, epochs, target - epochs * source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size, tie
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST((epochs + CASE WHEN ahead < rest AND ahead + size - rest <= rest - ahead THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM r
"""

NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE
      WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS sh FROM w),
d AS (SELECT doc_id, len(sh) AS n, CASE WHEN len(sh) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY sh) END AS rep, sh FROM s),
g AS (SELECT rep, n, unnest(sh) AS shingle FROM d WHERE doc_id = rep),
pairs AS (
  SELECT a.rep AS x, b.rep AS y FROM g a JOIN g b ON a.shingle = b.shingle AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
roots AS (SELECT x, min(y) AS low FROM reach GROUP BY x)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, least(rep, coalesce(low, rep)) AS component_id,
       doc_id = least(rep, coalesce(low, rep)) AS kept
FROM d LEFT JOIN roots ON rep = x
"""

#: crc32 of a short ASCII text, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({0}) + 1), lambda i: CAST(ascii(substr({0}, i, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
        lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)), 4294967295)"""

_SIZED = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_SIZED.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + ")"

MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS id, doc_id, lang, {_LEAF.format("n_chars")} AS leaf,
         {_LEAF.format(f"(n_chars + CASE WHEN {_CRC.format('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN 1 ELSE 0 END)")} AS changed
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM d),
lower_ AS (
  SELECT lang, 0 AS level, place, leaf AS node, n FROM p
  UNION ALL
  SELECT lang, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (n + 1) // 2 FROM lower_ WHERE n > 1
  GROUP BY lang, level, place // 2, n),
tops AS (SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM lower_ WHERE n = 1),
upper_ AS (
  SELECT 1000 AS level, place, node, n FROM tops
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (n + 1) // 2 FROM upper_ WHERE n > 1 GROUP BY level, place // 2, n),
steps AS (
  SELECT p.id, own.level, own.place % 2 AS side, coalesce(other.node, '') AS node
  FROM p JOIN lower_ own ON own.lang IS NOT DISTINCT FROM p.lang AND own.place = p.place // CAST(2 ** own.level AS BIGINT) AND own.n > 1
  LEFT JOIN lower_ other ON other.lang IS NOT DISTINCT FROM p.lang AND other.level = own.level AND other.place = xor(own.place, 1)
  UNION ALL
  SELECT p.id, own.level, own.place % 2, coalesce(other.node, '')
  FROM p JOIN tops ON tops.lang IS NOT DISTINCT FROM p.lang
  JOIN upper_ own ON own.place = tops.place // CAST(2 ** (own.level - 1000) AS BIGINT) AND own.n > 1
  LEFT JOIN upper_ other ON other.level = own.level AND other.place = xor(own.place, 1)),
paths AS (
  SELECT id, list(CASE WHEN side = 1 THEN 'L' ELSE 'R' END || node ORDER BY level) AS path, string_agg(node, '' ORDER BY level) AS siblings
  FROM steps GROUP BY id),
f AS (
  SELECT p.doc_id, p.leaf, tops.node AS subroot, (SELECT node FROM upper_ WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(list_prepend(coalesce(p.changed, p.leaf), coalesce(path, CAST([] AS VARCHAR[]))),
             lambda node, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || node ELSE node || s[2:] END)) AS folded_root
  FROM p JOIN tops ON tops.lang IS NOT DISTINCT FROM p.lang LEFT JOIN paths USING (id))
SELECT *, folded_root = root AS verified FROM f
"""

def _edit(label: str, cost: str, letter: str) -> str:
    """A label (nine digits of cost, then the audit) after one more edit; null stays null."""
    return f"lpad(CAST(CAST({label}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {label}[10:] || '{letter}'"


def _least(own: str, kept: str, role: str, others: list[str]) -> str:
    """The least label of a state: rows deleted, kept (of the role's initial) or given another role."""
    found = [_edit(own, "2", "D")]
    found += [f"CASE WHEN code = '{role}' THEN {_edit(x, 'spoilt', 'K')} END" for x in kept.split()]
    found += [f"CASE WHEN code <> 'd' THEN {_edit(x, '1 + spoilt', 'R')} END" for x in others]
    return f"least({', '.join(found)})"


CONVERSATIONS = rf"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM t WHERE kind <> 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(octet_length(encode(role)) || ':' || role || text)) AS i FROM d),
m AS (
  SELECT *, min(i) OVER (PARTITION BY conv_id, role, text) AS first, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut FROM r),
q AS (
  SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN first < i THEN 'duplicate' WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM m),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (illegal) AS illegal, count(*) AS n
  FROM q GROUP BY conv_id),
codes AS (
  SELECT conv_id, i, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS code,
         CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS spoilt FROM q),
-- Of use are only insertions of a user after nothing, system or assistant, and of an assistant after a user.
b AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS l0, CAST(NULL AS VARCHAR) AS l1, '000000005I' AS l2, '000000010II' AS l3 FROM c
  UNION ALL
  SELECT conv_id, i, l0, l1, least(l2, {_edit("l0", "5", "I")}, {_edit("l1", "5", "I")}, {_edit("l3", "5", "I")}) AS l2,
         least(l3, {_edit("least(l2, " + ", ".join(_edit(x, "5", "I") for x in ("l0", "l1", "l3")) + ")", "5", "I")}) AS l3
  FROM (
    SELECT b.conv_id, codes.i, {_edit("l0", "2", "D")} AS l0, {_least("l1", "l0", "s", [])} AS l1,
           {_least("l2", "l0 l1 l3", "u", ["l0", "l1", "l3"])} AS l2, {_least("l3", "l2", "a", ["l2"])} AS l3
    FROM b JOIN codes ON codes.conv_id IS NOT DISTINCT FROM b.conv_id AND codes.i = b.i + 1)),
e AS (
  SELECT c.*, CAST(least(l0, l3)[1:9] AS BIGINT) AS cost, least(l0, l3)[10:] AS audit
  FROM c JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.n),
letters AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS j, unnest(string_split(audit, '')) AS letter FROM e),
placed AS (SELECT *, sum(CAST(letter <> 'I' AS INT)) OVER (PARTITION BY conv_id ORDER BY j) AS i FROM letters),
stay AS (
  SELECT p.conv_id, j, letter, CASE WHEN letter = 'I' THEN '' ELSE text END AS text, role, row_number() OVER (PARTITION BY p.conv_id ORDER BY j) AS k,
         first_value(letter = 'K' AND left(role, 1) = 's') OVER (PARTITION BY p.conv_id ORDER BY j) AS headed
  FROM placed p LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM p.conv_id AND q.i = p.i WHERE letter <> 'D'),
told AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (k - CAST(headed AS INT)) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                    || ':' || text, chr(10) ORDER BY j)) AS digest FROM stay GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLE = {"op2_minhash": NEAR, "op5_warc": WARC, "op8_mixing": MIXING, "op9_exact_dedup": EXACT, "op11_merkle": MERKLE, "op12_conversations": CONVERSATIONS}
