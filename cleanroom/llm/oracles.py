"""The same results in SQL, where SQL can express them.

Scores, token ids, parser events, XXH64 and Spark's hash orders are beyond SQL: those
operators are compared with plain versions in the tests.
"""

from cleanroom.llm.divergence import Rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
RULES = Rules()

ORACLES: dict[str, str] = {}

ORACLES["op1_metric_join"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(degree.n, 0)::BIGINT AS n_links, least.component_id, v.vec_id = least.component_id AS kept
FROM v JOIN least ON least.a = v.vec_id LEFT JOIN degree ON degree.a = v.vec_id
"""

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({part} >> {shift}) & 31)::INT, 1)"
_PART = "('0x' || substr(h, {at}, 5))::BIGINT"
BASE32 = " || ".join(
    _DIGIT.format(part=_PART.format(at=1 + 5 * i), shift=shift) for i in range(8) for shift in (15, 10, 5, 0)
)

ORACLES["op2_warc"] = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), top AS (
  SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS last FROM p
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {BASE32} AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM top
"""


def _class_counts() -> str:
    classes = {
        "lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "space": r"[ \t\v\f\r]", "newline": r"\n", "stop": "[.?!]",
        "pause": r"[,;:\-''\"()]", "symbol": r"[#*$%&|<>]", "beyond_ascii": r"[^\x00-\x7F]",
    }
    count = lambda p: f"length(t) - length(regexp_replace(t, '{p}', '', 'g'))"
    named = ", ".join(f"'{k}': {count(p)}" for k, p in classes.items())
    rest = " - ".join(["length(t)", *(f"({count(p)})" for p in classes.values())])
    return f"MAP {{{named}, 'other_ascii': {rest}}}"


ORACLES["op3_divergence"] = rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS} AS w FROM documents
), lines AS (
  SELECT doc_id, line, count(*) - 1 AS again
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL
), windows AS (
  SELECT doc_id, i, w[i:i+2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) r(k) GROUP BY doc_id
), base AS (
  SELECT d.doc_id, d.lang, d.t, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce((SELECT sum(again) FROM lines l WHERE l.doc_id = d.doc_id), 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN repeated r ON r.doc_id = d.doc_id
), per_doc AS (
  SELECT doc_id, lang, word, count(*) AS n FROM (SELECT doc_id, lang, unnest(w) AS word FROM d) GROUP BY ALL
), per_lang AS (SELECT lang, sum(n) AS total FROM per_doc GROUP BY lang),
common AS (
  SELECT lang, word, sum(n) / any_value(total) AS q FROM per_doc JOIN per_lang USING (lang)
  GROUP BY lang, word HAVING sum(n) >= {RULES.common_share} * any_value(total)
), other AS (SELECT lang, greatest(0, 1 - sum(q)) AS q, sum(q) AS listed FROM common GROUP BY lang),
hits AS (
  SELECT p.doc_id, p.n / b.n_words AS p, c.q FROM per_doc p JOIN common c USING (lang, word) JOIN base b USING (doc_id)
), hit AS (
  SELECT doc_id, sum(p) AS p, sum(q) AS q, sum(p * log2(p / ((p + q) / 2)) + q * log2(q / ((p + q) / 2))) AS s FROM hits GROUP BY doc_id
), joined AS (
  SELECT b.doc_id, coalesce(s, 0) + (o.listed - coalesce(h.q, 0)) AS s, 1 - coalesce(h.p, 0) AS p, o.q
  FROM base b JOIN other o USING (lang) LEFT JOIN hit h USING (doc_id)
), word_far AS (
  SELECT doc_id, sqrt(greatest(0, (s + CASE WHEN p > 1e-12 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS far FROM joined
), counts AS (
  SELECT doc_id, lang, length(t) AS chars, unnest(map_entries({_class_counts()})) AS e FROM base
), class_refs AS (
  SELECT lang, e.key AS k, sum(e.value) / sum(sum(e.value)) OVER (PARTITION BY lang) AS q FROM counts GROUP BY lang, e.key
), class_terms AS (
  SELECT doc_id, chars, e.value / chars AS p, q FROM counts c JOIN class_refs r ON r.lang = c.lang AND r.k = c.e.key WHERE chars > 0
), class_far AS (
  SELECT doc_id, any_value(chars) AS chars, sqrt(greatest(0, sum(
    CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS far
  FROM class_terms GROUP BY doc_id
)
SELECT b.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND NOT coalesce(c.chars >= {RULES.min_chars} AND c.far > {RULES.max_class_distance}, false)
    AND NOT coalesce(n_words >= {RULES.min_words} AND w.far > {RULES.max_word_distance}, false) AS kept
FROM base b LEFT JOIN class_far c USING (doc_id) LEFT JOIN word_far w USING (doc_id)
"""

ORACLES["op4_prefix_free"] = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, length(h) // 2 - 98)) AS i, h FROM d
), windows AS (
  SELECT doc_id, i, md5(substr(h, 2 * i - 1, 200)) AS g FROM starts
), late AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1
), bounds AS (
  SELECT doc_id, i, CASE WHEN i > 100 + lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) THEN 1 ELSE 0 END AS fresh FROM late
), numbered AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM bounds
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS since FROM spans
), cut AS (
  SELECT g.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS rest,
    string_agg(substr(h, (2 * since - 1)::BIGINT, (2 * (a - since))::BIGINT), '' ORDER BY a) AS head
  FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id
)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head || substr(h, (2 * rest - 1)::BIGINT), h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

ORACLES["op7_fm_index"] = f"""
WITH d AS (
  SELECT doc_id, {WORDS} AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i+19], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)
), late AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM late, range(20) r(k)
), words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# The last line of the checksum's inner loop, eight times a byte, over the decimal digits of an id.
CRC32 = """xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
    lambda a, b: list_reduce(range(8), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)), xor(a, b)), 4294967295), 4294967295)"""

ORACLES["op11_prefix_trie"] = rf"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (SELECT DISTINCT c FROM turns), every AS (SELECT c, {CRC32} % 4 AS h, c - c % 20 AS base FROM ids),
rebuilt AS (
  SELECT c, p, role, text FROM turns JOIN every USING (c) WHERE p > h
  UNION ALL
  SELECT e.c, t.p, t.role, t.text FROM every e JOIN turns t ON t.c = e.base AND t.p <= e.h
), steps AS (
  SELECT c, row_number() OVER w AS depth, md5(string_agg(md5(role) || md5(text), '') OVER w) AS node,
    len({WORDS}) AS words
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY p)
), paths AS (
  SELECT c, depth, node, lag(node, 1, '') OVER (PARTITION BY c ORDER BY depth) AS parent, words FROM steps
  UNION ALL SELECT c, 0, '', NULL, 0 FROM every
), marked AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY c) AS ends FROM paths
), nodes AS (
  SELECT node, min(c) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
    (count(*) - 1) * any_value(words) AS saved, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM marked GROUP BY node
), kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (node)),
below AS (
  SELECT p.node, sum((m.n_children = 0)::INT) AS n_leaves, sum(m.saved) AS saved_tokens
  FROM counted m JOIN paths p ON p.c = m.conv_id AND p.depth <= m.depth GROUP BY p.node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN below b USING (node) LEFT JOIN nodes up ON up.node = n.parent
"""

ORACLES["op12_ball_tree"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, {TERMS} AS w FROM documents
), whole AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, whole GROUP BY term
), asked AS (
  SELECT number, item_id, unnest(list_distinct({TERMS})) AS term
  FROM (SELECT row_number() OVER () AS number, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))
), scores AS (
  SELECT number, any_value(item_id) AS item_id, k, any_value(doc_id) AS doc_id,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(w) * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN d USING (k), whole GROUP BY number, k
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY number ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES["op13_positional_index"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, {TERMS} AS w FROM documents
), phrases AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[j:j+9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS j FROM (SELECT item_id, {TERMS} AS w FROM benchmark) WHERE len(w) > 0)
), windows AS (
  SELECT k, j, n, array_to_string(w[j:j+n-1], ' ') AS g
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS j FROM d JOIN (SELECT DISTINCT n FROM phrases) ON len(w) >= n)
), found AS (SELECT DISTINCT k, j, n, item_id FROM windows JOIN phrases USING (n, g)),
hits AS (SELECT k, count(DISTINCT j + x) AS n_hit FROM found JOIN range(10) r(x) ON x < n GROUP BY k),
items AS (
  SELECT k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS list
  FROM (SELECT DISTINCT k, item_id::VARCHAR AS item_id FROM found WHERE item_id IS NOT NULL) GROUP BY k
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (k) LEFT JOIN items USING (k)
"""
