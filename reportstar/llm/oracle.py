"""SQL for DuckDB of the operators on words, conversations and URLs, written apart from their methods."""

#: The rules of the registered URL filter: host, path, action.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


# The CRC-32 of each byte value, eight shifts each.
_CRC = """
crc_bits AS (
  WITH RECURSIVE t(b, x, k) AS (
    SELECT range::BIGINT, range::BIGINT, 0 FROM range(256)
    UNION ALL SELECT b, CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END, k + 1 FROM t WHERE k < 8)
  SELECT list(x ORDER BY b) AS codes FROM t WHERE k = 8)"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of ``text``; the query must have ``crc_bits``, whose list is ``codes``."""
    start = "[4294967295::BIGINT]"
    digits = f"hex(encode({text}))"
    values = f"list_transform(range(0, len({digits}), 2), lambda i: ('0x' || substr({digits}, i::INT + 1, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce(list_concat({start}, {values}), lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255)::INT + 1])))"


def _edit(value: str, cost: str, letter: str, turn: str = "[]") -> str:
    return f"{{'c': {value}.c + {cost}, 'a': '{letter}' || {value}.a, 't': list_concat({turn}::VARCHAR[], {value}.t)}}"


def _kept(initials: dict[str, str]) -> str:
    """The state's value after keeping a row, by the initial of its role."""
    ways = " ".join(f"WHEN ini = '{i}' THEN {_edit(v, 'late', 'K', '[said]')}" for i, v in initials.items())
    return f"CASE WHEN must THEN NULL {ways} END"


def _step(state: int, kept: dict[str, str]) -> str:
    given, role = ("v3", "assistant") if state == 2 else ("v2", "user")
    reroled = f"CASE WHEN NOT must THEN {_edit(given, '2 + late', 'R', f'[{chr(39)}{role}:{chr(39)} || text]')} END"
    return f"least({_edit(f'v{state}', '3', 'D')}, {reroled}, {_kept(kept | {'': f'v{state}'})}) AS b{state}"


ORACLE = {
    "op11_spelling_variants": f"""
WITH RECURSIVE {_CRC.strip()},
runs AS (
  SELECT doc_id, {_lower("unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+'))")} AS run FROM documents),
per_doc AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY ALL),
seeded AS (SELECT *, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM per_doc, crc_bits),
damaged AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c
  FROM seeded),
words AS (SELECT word, sum(c)::BIGINT AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
places AS (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS p FROM words),
less AS (SELECT DISTINCT word, n, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM places),
masked AS (SELECT word, n, substr(word, 1, p - 1) || '*' || substr(word, p + 1) AS rest FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n FROM masked a JOIN masked b ON a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION ALL SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, min({{'m': -n, 'w': encode(other)}}) AS b FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -b.m >= 5 * w.n THEN decode(b.w) END AS form, CASE WHEN -b.m >= 5 * w.n THEN -b.m END AS form_n
  FROM words w LEFT JOIN best USING (word)),
path(word, place) AS (
  SELECT word, word FROM words
  UNION ALL SELECT path.word, forms.form FROM path JOIN forms ON path.place = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT path.word, path.place AS root FROM path JOIN forms ON path.place = forms.word WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
""",
    "op12_conversation_repair": f"""
WITH RECURSIVE {_CRC.strip()},
source AS (
  SELECT conv_id, turn, row_number() OVER () AS k, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS way
  FROM conversations, crc_bits),
damaged AS (
  SELECT conv, turn, k, unnest(CASE WHEN way = 3 THEN [0, 1] ELSE [0] END) AS copy, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
         CASE way WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM source WHERE way <> 0),
bare AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, k, copy) AS i, left(role, 1) AS ini,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS stem
  FROM damaged),
faults AS (
  SELECT *, stem = '' AS blank, stem <> '' AND row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
         coalesce(lag(ini) OVER (PARTITION BY conv ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM bare),
rows_in AS (
  SELECT *, blank OR again AS must, (NOT blank AND NOT again AND right(stem, 1) NOT IN ('.', '!', '?'))::BIGINT AS late,
         role || ':' || text AS said
  FROM faults),
sums AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again) AS duplicate, sum(late)::BIGINT AS truncated, count(*) FILTER (illegal) AS illegal, max(i) AS n
  FROM rows_in GROUP BY conv),
ways(conv, i, v0, v1, v2, v3) AS (
  SELECT s.conv, coalesce(n, 0) + 1, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}}, {{'c': 4::BIGINT, 'a': 'II', 't': ['user:', 'assistant:']}},
         {{'c': 2::BIGINT, 'a': 'I', 't': ['assistant:']}}, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}}
  FROM (SELECT DISTINCT conv FROM source) s LEFT JOIN sums ON sums.conv = s.conv
  UNION ALL
  SELECT conv, i, least(b0, {_edit("w2", "2", "I", "['user:']")}), least(b1, {_edit("w2", "2", "I", "['user:']")}), w2,
         least(b3, {_edit("w2", "2", "I", "['user:']")})
  FROM (
    SELECT *, least(b2, {_edit("b3", "2", "I", "['assistant:']")}) AS w2
    FROM (
      SELECT r.conv, r.i, {_step(0, {"s": "v1", "u": "v2"})}, {_step(1, {"u": "v2"})}, {_step(2, {"a": "v3"})}, {_step(3, {"u": "v2"})}
      FROM ways w JOIN rows_in r ON r.conv = w.conv AND r.i = w.i - 1))),
starts AS (SELECT conv, v0 FROM ways WHERE i = 1)
SELECT s.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, v0.c AS cost, v0.a AS audit, sha256(coalesce(array_to_string(v0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM source) s JOIN starts ON starts.conv = s.conv LEFT JOIN sums ON sums.conv = s.conv
""",
    "op13_url_filter": f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {", ".join(str(r) for r in RULES)}),
cut AS (
  SELECT page_id, row_number() OVER () AS k,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, k, {_lower("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.action, 'allow') AS verdict
FROM parts LEFT JOIN (
  SELECT k, max({{'chars': length(rule_host || rule_path), 'action': action, 'rule': rule_host || rule_path}}) AS best
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY k) USING (k)
""",
}
