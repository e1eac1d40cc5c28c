"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

from crashlens.llm.licenses import TEMPLATES

_HEX = 13  # hex digits of a hash that make a number

_COMPONENTS = """
reach AS (SELECT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
parts AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

REMOVE_REPEATS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS s FROM starts),
lowest AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s),
hits AS (SELECT doc_id, i FROM windows JOIN lowest USING (s) WHERE first_id < doc_id),
gone AS (SELECT DISTINCT doc_id, i + o AS i FROM hits, range(0, 13) t(o)),
places AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
kept AS (SELECT doc_id, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (g.i IS NULL) AS left_over
         FROM places LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

EMBEDDING_DUPLICATES = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id
          WHERE list_cosine_similarity(p.x, q.x) >= 0.93),
{_COMPONENTS}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM v LEFT JOIN parts ON id = vec_id
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, CASE WHEN len(words) > 0 THEN 2 ELSE 1 END))) AS i FROM w),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM shingles p JOIN shingles q USING (s) WHERE p.doc_id <> q.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)),
{_COMPONENTS}
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id, coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN parts ON id = w.doc_id
"""

DECONTAMINATE = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS words FROM benchmark),
sized AS (SELECT item, words, least(len(words), 13) AS n FROM items WHERE len(words) > 0),
item_starts AS (SELECT item, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM sized),
windows AS (SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS s FROM item_starts),
lengths AS (SELECT DISTINCT n FROM windows),
doc_starts AS (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, lengths),
found AS (SELECT doc_id, i, n, item FROM (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS s FROM doc_starts) JOIN windows USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(words), false) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


def licences_sql(dice: float = 0.8) -> str:
    """SQL for the query over ``scan``: parts by their lines, the nearest template of each."""
    rows = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in item)) for item in sorted(TEMPLATES.items()))
    words = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
    bigrams = "list_distinct([words[i] || ' ' || words[i + 1] for i in range(1, len(words))])"
    return rf"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS s,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
filled AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM lines WHERE NOT regexp_full_match(s, '[\x09-\x0D\x20]*')),
parts AS (SELECT doc_id, 0 AS kind, i AS a, i AS b, s FROM filled UNION ALL
          SELECT doc_id, 1, min(i), max(i), string_agg(s, chr(10) ORDER BY i) FROM filled GROUP BY doc_id, run HAVING count(*) > 1 UNION ALL
          SELECT doc_id, 2, min(i), max(i), string_agg(s, chr(10) ORDER BY i) FROM filled GROUP BY doc_id HAVING count(DISTINCT run) > 1),
part_words AS (SELECT doc_id, kind, a, b, {words.format("s")} AS words FROM parts),
own AS (SELECT doc_id, kind, a, b, {bigrams} AS grams FROM part_words),
template_words AS (SELECT licence, {words.format("s")} AS words FROM (VALUES {rows}) t(licence, s)),
templates AS (SELECT licence, {bigrams} AS grams FROM template_words),
compared AS (SELECT doc_id, kind, a, b, licence, 2 * len(list_intersect(own.grams, t.grams)) / (len(own.grams) + len(t.grams)) AS dice
             FROM own JOIN templates t ON list_has_any(own.grams, t.grams)),
near AS (SELECT * FROM compared WHERE dice >= {dice} QUALIFY row_number() OVER (PARTITION BY doc_id, kind, a, b ORDER BY dice DESC, licence) = 1),
shown AS (SELECT * FROM near n WHERE NOT EXISTS (SELECT 1 FROM near m WHERE m.doc_id = n.doc_id AND m.kind < n.kind AND m.a >= n.a AND m.b <= n.b
                                                 AND m.licence = n.licence AND m.dice >= n.dice)),
summed AS (SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences,
                  max(struct_pack(dice := dice, licence := licence)) AS best FROM shown GROUP BY doc_id)
SELECT doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licences, '') AS licences, best.licence AS best_licence, best.dice AS best_dice
FROM documents LEFT JOIN summed USING (doc_id)
"""


def mix_sql(table: str = "documents", columns: str = "doc_id, source", *, temper: float = 0.5, seed: str = "mix") -> str:
    """SQL for the rows of ``mix`` without weights, as many as the table has; ids are unique (others draw by their place in the input)."""
    def u(*parts: str) -> str:
        text = " || ':' || ".join(parts)
        return f"(CAST('0x' || substr(md5({text}), 1, {_HEX}) AS BIGINT) / {float(1 << 4 * _HEX)!r})"

    doc = "coalesce(CAST(doc_id AS VARCHAR), '')"
    return f"""
WITH counts AS (SELECT source, count(*) AS n FROM {table} GROUP BY source),
shares AS (SELECT source, n, pow(CAST(n AS DOUBLE), {temper!r}) AS share FROM counts),
rates AS (SELECT source, share / (SELECT sum(share) FROM shares) * (SELECT sum(n) FROM shares) / n AS rate FROM shares),
parts AS (SELECT source, rate / greatest(ceil(rate / 32), 1) AS rate, CAST(greatest(ceil(rate / 32), 1) AS BIGINT) AS parts FROM rates),
terms AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1.0)) AS p FROM parts, range(0, 128) t(k)
          WHERE k <= ceil(rate + 12 * sqrt(rate) + 24)),
steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM terms),
split AS (SELECT d.*, parts, unnest(range(1, parts + 1)) AS part FROM {table} d JOIN parts s ON s.source IS NOT DISTINCT FROM d.source),
drawn AS (SELECT *, CASE WHEN parts = 1 THEN {u(f"'{seed}'", doc)} ELSE {u(f"'{seed}'", doc, "CAST(part AS VARCHAR)")} END AS u FROM split),
copies AS (SELECT *, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.cdf <= d.u) AS copies
           FROM drawn d),
rows AS (SELECT *, (part - 1) * 128 + unnest(range(1, copies + 1)) AS i FROM copies)
SELECT {columns}, CAST(i AS INTEGER) AS copy, {u(f"'{seed}-order'", doc, "CAST(i AS VARCHAR)")} AS shuffle_key FROM rows
"""


FILL_MIDDLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, x, length(x) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS d FROM t),
v AS (SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR d[3] % 100 >= 90 THEN 'plain'
                  WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
o AS (SELECT *, substr(x, 1, a) AS prefix, substr(x, a + 1, b - a) AS middle, substr(x, b + 1) AS suffix FROM v)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM o
"""

_CRC_STEP = "CASE WHEN {0} % 2 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"

IMPORTANCE = rf"""
WITH RECURSIVE bits AS (SELECT 0 AS k, i, CAST(i AS BIGINT) AS c FROM range(256) t(i)
                        UNION ALL SELECT k + 1, i, {_CRC_STEP.format("c")} FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM d) GROUP BY word),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM b) GROUP BY word),
spelled AS (SELECT word, list_transform(range(0, length(hex(word)) // 2), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT)) AS bytes
            FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
buckets AS (SELECT word, xor(list_reduce(bytes, lambda r, x: xor(r >> 8, t[xor(r, x) % 256 + 1]), 4294967295), 4294967295) % 10000 AS bucket
            FROM spelled, crc),
s AS (SELECT bucket, sum(n) AS s FROM dw JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM bw JOIN buckets USING (word) GROUP BY bucket),
totals AS (SELECT CAST(coalesce((SELECT sum(s) FROM s), 0) AS DOUBLE) AS all_s, CAST(coalesce((SELECT sum(t) FROM t), 0) AS DOUBLE) AS all_t),
gain AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (all_s + 10000) / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * (all_t + 10000)))) AS BIGINT) AS g
         FROM s FULL JOIN t USING (bucket), totals),
gains AS (SELECT word, g FROM buckets JOIN gain USING (bucket)),
weights AS (SELECT doc_id, CAST(sum(g) AS BIGINT) AS weight FROM (SELECT doc_id, unnest(w) AS word FROM d) JOIN gains USING (word) GROUP BY doc_id),
scored AS (SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
           FROM d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN r <= (SELECT 10 * count(*) // 100 FROM ranked) THEN r END AS BIGINT) AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_remove_repeats": REMOVE_REPEATS,
    "op2_embedding_duplicates": EMBEDDING_DUPLICATES,
    "op3_near_duplicates": NEAR_DUPLICATES,
    "op5_decontaminate": DECONTAMINATE,
    "op7_licenses": licences_sql(),
    "op6_mix_sources": mix_sql("documents", "doc_id, text, lang, source, n_chars"),
    "op11_fill_middle": FILL_MIDDLE,
    "op13_importance": IMPORTANCE,
}
