"""SQL (DuckDB) for the queries that SQL can express."""

from __future__ import annotations

from ticketloom.llm.licence_texts import TEMPLATES

WORD = r"[^\x20\x09-\x0D]+"

_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in TEMPLATES)
_NORMALISED = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


def _checksum(key: str) -> str:
    """CRC-32 of an ASCII string, byte by byte over the table of remainders."""
    table = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    codes = f"list_transform(string_split({key}, ''), lambda c: ascii(c)::BIGINT)"
    step = f"lambda s, b: xor(s >> 8, {table}[1 + (xor(s, b) & 255)]::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295::BIGINT)"


def _row_edits(state: int) -> str:
    """Cheapest way on from a state over one row, without inserts; ``e0`` to ``e3`` hold cost, audit and lines after it."""
    after = 3 if state == 2 else 2
    name = "assistant" if state == 2 else "user"
    kept = f"initial = '{name[0]}'"
    ways = [
        f"{{'c': e{state}.c + 4, 'a': 'D' || e{state}.a, 'r': e{state}.r}}",
        f"CASE WHEN fault NOT IN (1, 2) THEN {{'c': e{after}.c + 3 + late, 'a': 'R' || e{after}.a, 'r': '{name}:' || text || chr(2) || e{after}.r}} END",
        f"CASE WHEN fault NOT IN (1, 2) AND {kept} THEN {{'c': e{after}.c + late, 'a': 'K' || e{after}.a, 'r': line || e{after}.r}} END",
    ]
    if state == 0:
        ways.append("CASE WHEN fault NOT IN (1, 2) AND initial = 's' THEN {'c': e1.c + late, 'a': 'K' || e1.a, 'r': line || e1.r} END")
    return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1] AS b{state}"


def _row_inserts(state: int, old: str, rest: str, new: str) -> str:
    after, name = (3, "assistant") if state == 2 else (2, "user")
    put = f"{{'c': {rest}{after}.c + 3, 'a': 'I' || {rest}{after}.a, 'r': '{name}:' || chr(2) || {rest}{after}.r}}"
    return f"list_sort([{old}{state}, {put}])[1] AS {new}{state}"


_STATES = range(4)

ORACLES: dict[str, str] = {
    "op13_repair_conversations": rf"""
WITH RECURSIVE fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_checksum("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0
), placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial, role || ':' || text || chr(2) AS line,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         regexp_extract(text, '([^ 	-
])[ 	-
]*\z', 1) AS final
  FROM damaged
), told AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed
), judged AS (
  SELECT *, CASE WHEN final = '' THEN 1 WHEN again THEN 2 WHEN final NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM told
), tally AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM judged GROUP BY conv_id
), back AS (
  SELECT conv_id, n AS i, {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS e0,
         {{'c': 6::BIGINT, 'a': 'II', 'r': 'user:' || chr(2) || 'assistant:' || chr(2)}} AS e1,
         {{'c': 3::BIGINT, 'a': 'I', 'r': 'assistant:' || chr(2)}} AS e2, {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS e3 FROM tally
  UNION ALL
  SELECT conv_id, i - 1, {', '.join(_row_inserts(s, 'b', 'h', 'f') for s in _STATES)} FROM (
    SELECT *, {', '.join(_row_inserts(s, 'b', 'b', 'h') for s in _STATES)} FROM (
      SELECT *, {', '.join(_row_edits(s) for s in _STATES)} FROM (
        SELECT back.*, role, text, initial, line, fault, CASE WHEN fault = 3 THEN 3 ELSE 0 END AS late
        FROM back JOIN judged ON judged.conv_id IS NOT DISTINCT FROM back.conv_id AND judged.i = back.i)))
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e0.c, 0) AS cost, coalesce(e0.a, '') AS audit,
       sha256(coalesce(replace(rtrim(e0.r, chr(2)), chr(2), chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN tally ON tally.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN back ON back.conv_id IS NOT DISTINCT FROM a.conv_id AND back.i = 0
""",
    "op3_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, regexp_extract_all(t, '{WORD}') AS w FROM d
), places AS (
  SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5
), windows AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g FROM places
), twice AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), repeated AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(0, 5) AS r(k) GROUP BY rid
), lines AS (
  SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d
), full_lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
  SELECT doc_id, len(w.w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN full_lines USING (rid) LEFT JOIN repeated USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines) AS kept
FROM m
""",
    "op7_decontaminate": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
), places AS (
  SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
), found AS (
  SELECT rid, i, p.n, item_id FROM (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM places) p
  JOIN windows x ON x.n = p.n AND x.g = p.g
), hit AS (
  SELECT rid, count(DISTINCT i + k) AS n_hit FROM (SELECT rid, i, unnest(range(0, n)) AS k FROM (SELECT DISTINCT rid, i, n FROM found))
  GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item_id FROM found) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
""",
    "op8_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND last <> page_id THEN last END AS refers_to
FROM m
""",
    "op1_licence_scan": f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), lines AS (
  SELECT rid, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d
), worded AS (
  SELECT rid, i, line, len({_NORMALISED.format("line")}) AS n FROM lines
), paragraphs AS (
  SELECT rid, string_agg(line, chr(10) ORDER BY i) AS part
  FROM (SELECT *, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS p FROM worded) WHERE n > 0 GROUP BY rid, p
), parts AS (
  SELECT rid, part, row_number() OVER () AS pid
  FROM (SELECT rid, line AS part FROM lines UNION ALL SELECT * FROM paragraphs UNION ALL SELECT rid, t FROM d)
), words AS (
  SELECT rid, pid, {_NORMALISED.format("part")} AS w FROM parts
), bigrams AS (
  SELECT DISTINCT rid, pid, w[i] || ' ' || w[i + 1] AS g FROM (SELECT *, unnest(range(1, len(w))) AS i FROM words WHERE len(w) > 1)
), sizes AS (
  SELECT pid, count(*) AS x FROM bigrams GROUP BY pid
), templates AS (
  SELECT name, {_NORMALISED.format("body")} AS w FROM (VALUES {_TEMPLATE_ROWS}) AS v(name, body)
), template_bigrams AS (
  SELECT DISTINCT name, w[i] || ' ' || w[i + 1] AS g FROM (SELECT *, unnest(range(1, len(w))) AS i FROM templates)
), template_sizes AS (
  SELECT name, count(*) AS y FROM template_bigrams GROUP BY name
), common AS (
  SELECT rid, pid, name, count(*) AS n FROM bigrams JOIN template_bigrams USING (g) GROUP BY ALL
), scored AS (
  SELECT rid, name, max((2 * n)::DOUBLE / (x + y)) AS dice
  FROM common JOIN sizes USING (pid) JOIN template_sizes USING (name) WHERE 2 * n >= 0.85::DOUBLE * (x + y) GROUP BY rid, name
), best AS (
  SELECT rid, string_agg(name, ',' ORDER BY name) AS licences, first(name ORDER BY dice DESC, name) AS best, max(dice) AS dice
  FROM scored GROUP BY rid
)
SELECT doc_id, coalesce(licences, '') AS licences, best, coalesce(dice, 0.0)::DOUBLE AS dice FROM d LEFT JOIN best USING (rid)
""",
    "op11_lexical_search": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents
), docs AS (
  SELECT rid, doc_id, w, len(w) AS n FROM d WHERE len(w) > 0
), g AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM docs
), q AS (
  SELECT iid, item_id, unnest(list_distinct(w)) AS t
  FROM (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS w FROM benchmark)
), tf AS (
  SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM docs) WHERE t IN (SELECT t FROM q) GROUP BY rid, t
), df AS (
  SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, g GROUP BY t
), s AS (
  SELECT iid, item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN df USING (t) JOIN (SELECT rid, doc_id, n FROM docs) USING (rid), g
  GROUP BY iid, item_id, rid, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
) WHERE rank <= 10
""",
}
