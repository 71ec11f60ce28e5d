"""Parts of the queries' SQL for the independent engine."""

from __future__ import annotations

from collections.abc import Sequence

PATTERNS = (
    ("CONTACT_EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]+"),
    ("CONTACT_PHONE", r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}"),
    ("ID", r"\b[0-9]{16}\b"),
    ("OTHER", r"\bpassword=[0-9a-f]+"),
)


#: The SQL engine's word border, which knows ASCII only, for Java's patterns.
ASCII_BORDER = "(?:(?<![0-9A-Za-z_])(?=[0-9A-Za-z_])|(?<=[0-9A-Za-z_])(?![0-9A-Za-z_]))"


def java(pattern: str) -> str:
    return pattern.replace(r"\b", ASCII_BORDER)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def one(kind: str, pattern: str, text: str = "coalesce(text, '')") -> str:
    """Rows (doc, kind, b, e, txt) of a pattern's matches; places from the lengths of gaps and matches."""
    p = quoted(pattern)
    return f"""SELECT doc, {quoted(kind)} AS kind, CAST(place AS INTEGER) AS b, CAST(place + length(ms[i]) AS INTEGER) AS e, ms[i] AS txt FROM (
      SELECT doc, i, ms, list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS place FROM (
        SELECT doc, ms, gs, unnest(generate_series(1, len(ms))) AS i FROM (
          SELECT doc_id AS doc, regexp_extract_all({text}, {p}) AS ms, regexp_split_to_array({text}, {p}) AS gs FROM documents)))"""


SPANS = "WITH spans AS (" + " UNION ALL ".join(one(k, p) for k, p in PATTERNS) + ")"


def words(pattern: str) -> str:
    return "WITH spans AS (" + one("WORD", pattern) + ")"


def rewritten(replacement: str) -> str:
    return f"""{SPANS}, r AS (SELECT *, lag(e, 1, 0) OVER (PARTITION BY doc ORDER BY b) AS before, {replacement} AS new FROM spans),
    g AS (SELECT r.doc, string_agg(substr(text, before + 1, b - before) || new, '' ORDER BY b) AS head, max(e) AS tail FROM r JOIN documents ON doc_id = r.doc GROUP BY r.doc)
    SELECT doc_id AS doc, coalesce(head || substr(text, tail + 1), text, '') AS text FROM documents LEFT JOIN g ON doc_id = doc"""


def number(*parts: str) -> str:
    return "CAST('0x' || substr(md5(" + " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + "), 1, 8) AS BIGINT)"


def _hex(parts: Sequence[str], at: int) -> str:
    joined = " || '|' || ".join(["'salt'", *(f"CAST({p} AS VARCHAR)" for p in parts)])
    return f"CAST('0x' || substr(md5({joined}), {at}, 4) AS BIGINT)"


def key6(*parts: str) -> str:
    letter = lambda i: f"chr(CAST(65 + {_hex(parts, i)} % 26 AS INTEGER))"
    digit = lambda i: f"CAST({_hex(parts, i)} % 10 AS VARCHAR)"
    return " || ".join([letter(1), letter(5), digit(9), letter(13), letter(17), digit(21)])


def key8(*parts: str) -> str:
    return " || ".join(f"CAST({_hex(parts, 4 * i + 1)} % 10 AS VARCHAR)" if i in (3, 7) else f"chr(CAST(65 + {_hex(parts, 4 * i + 1)} % 26 AS INTEGER))" for i in range(8))


def scramble(text: str) -> str:
    n = number("'run'", text, "i")
    c = f"substr({text}, i + 1, 1)"
    pick = lambda letters: f"substr('{letters}', CAST({n} % {len(letters)} AS INTEGER) + 1, 1)"
    one_ = f"CASE WHEN regexp_matches({c}, '^\\p{{Lu}}$') THEN {pick('ABCDEFGHIJKLMNOPQRSTUVWXYZ')} WHEN regexp_matches({c}, '^\\p{{Ll}}$') THEN {pick('abcdefghijklmnopqrstuvwxyz')} WHEN regexp_matches({c}, '^[0-9]$') THEN {pick('0123456789')} ELSE {c} END"
    return f"array_to_string(list_transform(range(0, length({text})), lambda i: {one_}), '')"


def chain(text: str, steps: Sequence[tuple[str, str]]) -> str:
    for pattern, new in steps:
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(new)}, 'g')"
    return f"trim({text}, ' ')"


FAULTS = """WITH f AS (
  SELECT l_returnflag AS annotator, l_orderkey AS doc, CAST(l_partkey AS VARCHAR) AS code, l_linenumber AS line, 'whitelist' AS list, CAST(NULL AS VARCHAR) AS fsn FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)
  UNION ALL SELECT l_returnflag, l_orderkey, CAST(l_partkey AS VARCHAR), l_linenumber, 'blacklist', p_name || ' (' || lower(p_type) || ')' FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size % 10 = 3
)"""

CLOSURE = """WITH RECURSIVE isa AS (
  SELECT 'world' AS parent, 'r' || n_regionkey AS child FROM nation UNION SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation UNION SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer
), c AS (SELECT '{root}' AS code, 0 AS depth UNION SELECT child, depth + 1 FROM c JOIN isa ON code = parent WHERE depth < {depth})
SELECT '{root}' AS root, code, min(depth) AS depth FROM c GROUP BY code"""

LONGEST_PREFIX = """WITH n AS (SELECT DISTINCT CAST(c_custkey * 7919 AS VARCHAR) AS number FROM customer), c AS (SELECT CAST(n_nationkey * 37 + 11 AS VARCHAR) AS code, n_name AS city FROM nation),
p AS (SELECT number, code, city, s FROM n JOIN (SELECT *, unnest(generate_series(1, length(code))) AS s FROM c) ON substr(number, 1, s) = substr(code, 1, s) AND s <= length(number)),
b AS (SELECT *, max(s) OVER (PARTITION BY number) AS m FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY number ORDER BY
    CASE WHEN length(number) = s THEN 0 WHEN length(code) = s THEN 10 ELSE abs(CAST(substr(code, s + 1, 1) AS INTEGER) - CAST(substr(number, s + 1, 1) AS INTEGER)) END,
    CASE WHEN length(number) = s THEN abs(CAST(code AS BIGINT) - CAST(number AS BIGINT)) ELSE 0 END, code) AS k FROM b WHERE s = m)
SELECT number, code, city, CAST(s AS INTEGER) AS shared FROM r WHERE k = 1"""

TOP = """WITH q AS (SELECT vec_id AS query, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 20 = 0), i AS (SELECT vec_id AS item, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT query, item, round(list_cosine_similarity(q.v, i.v), 6) AS similarity FROM q, i),
t AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, item) AS n FROM x)"""

LEV_RANK = """WITH a AS (SELECT p_brand, p_size, p_partkey AS query, list_filter(regexp_split_to_array(lower(p_type), '[ -]'), lambda x: x <> '') AS t FROM part),
b AS (SELECT p_brand, p_size, p_partkey AS item, list_filter(regexp_split_to_array(lower(p_type || ' ' || p_name), '[ -]'), lambda x: x <> '') AS c FROM part),
p AS (SELECT query, item, t, c FROM a JOIN b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND query <> item),
x AS (SELECT query, item, c, len(t) AS n, unnest(t) AS x FROM p), y AS (SELECT query, item, n, x, unnest(c) AS y FROM x),
m AS (SELECT query, item, n, x, min(levenshtein(x, y) / greatest(length(x), length(y))) AS d, count(*) AS k FROM y GROUP BY query, item, n, x),
w AS (SELECT query, item, x, count(*) AS times FROM x GROUP BY query, item, x)
SELECT m.query, m.item, round(1 - sum(d * times) / max(n), 6) AS score FROM m JOIN w ON m.query = w.query AND m.item = w.item AND m.x = w.x GROUP BY m.query, m.item"""

NAMES = """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[^A-Za-z]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, w, list_extract(['hinter', 'nach', 'los', 'van', 'und', 'zwischen', 'la', ''], doc_id % 8 + 1) AS p FROM w),
n AS (SELECT doc_id, list_filter(list_concat(list_concat(w[1:doc_id % 4 + 1], [p]), w[5:5]), lambda x: x <> '') AS ws, array_to_string(list_filter(list_concat(list_concat(w[1:doc_id % 4 + 1], [p]), w[5:5]), lambda x: x <> ''), ' ') AS name,
  list_concat(list_concat(w[6:7], [list_extract(['Herr', 'Frau', 'Dr.', 'von'], doc_id % 4 + 1)]), list_extract([['rer.', 'nat.'], [], ['med.'], ['Prof.']], doc_id % 5 % 4 + 1)) AS before FROM p)"""

#: Fixed values of the annotation rules, written out here for the independent engine: words that start a last name, parts of titles.
_PARTICLES = """'ab', 'an', 'auf', 'aus', 'bei', 'bis', 'durch', 'für', 'gegen', 'ohne', 'um', 'unter', 'über', 'vor', 'hinter', 'neben', 'zwischen', 'nach', 'mit', 'von', 'zu', 'gegenüber',
  'während', 'trotz', 'wegen', 'statt', 'gemäß', 'entlang', 'seit', 'laut', 'vom', 'zur', 'zum', 'beim', 'van', 'des', 'de', 'del', 'dos', 'der', 'die', 'das', 'den', 'dem',
  'ein', 'eine', 'einen', 'einem', 'einer', 'eines', 'el', 'la', 'los', 'las', 'le', 'les', 'l'"""
IS_TITLE = "(" + " OR ".join(f"contains(lower(w), '{t}')" for t in "dr phil univ medic dres med dipl psych dent vet habil mult rer päd nat".split()) + ")"
_START = f"coalesce(nullif(list_position(list_transform(ws, lambda x: lower(x) IN ({_PARTICLES})), true), 0), len(ws))"
CLASSIFY = f"""CASE WHEN len(ws) = 0 THEN '' WHEN len(ws) = 1 THEN CASE WHEN list_has_any(before, ['Herr', 'Frau']) THEN 'LN:' ELSE 'FN:' END || ws[1]
  ELSE array_to_string(list_concat(list_transform(ws[1:{_START} - 1], lambda x: 'FN:' || x), ['LN:' || array_to_string(ws[{_START}:], ' ')]), '|') END"""
