"""DuckDB SQL of the queries that SQL can express, over the whole tables."""

from __future__ import annotations

from tallymark.llm.quality_rules import COMMON_WORDS, OTHERS, Limits
from tallymark.llm.secrets import KINDS, RULES

_SPACE = r"[\x20\x09-\x0D]"
_WORDS = rf"list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> '')"


def mixing_sql(weights: tuple[int, ...] = (5, 2, 1), ceiling: int = 3) -> str:
    cases = " ".join(f"WHEN {i} THEN {w}.0::DOUBLE" for i, w in enumerate(weights))
    return f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * {ceiling} AS top,
    CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(weights)} {cases} END AS weight
  FROM d GROUP BY source),
c AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(top) OVER (ORDER BY top / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY top / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM s),
t AS (
  SELECT source, source_size, least(top, weight * coalesce(
      (SELECT arg_min(x.level, x.top / x.weight) FROM c x WHERE x.level * x.weight <= x.top), 0)) AS target
  FROM c)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE size * (floor(target / source_size)
    + CASE WHEN draw < target / source_size - floor(target / source_size) THEN 1 ELSE 0 END) END::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""


def secrets_sql() -> str:
    """Spans from the pieces between the matches: each match begins where the pieces and matches before it end."""
    parts = []
    for rank, kind in enumerate(KINDS):
        _, pattern, group, least = RULES[kind]
        pattern = pattern.replace("'", "''")
        parts.append(f"""
SELECT doc_id, row_id, {rank} AS rank, '{kind}' AS kind, unnest(range(1, len(found) + 1)) AS i, found, counted, {least} AS least,
  string_split_regex(text, '{pattern}') AS pieces
FROM (SELECT doc_id, row_id, text, regexp_extract_all(text, '{pattern}') AS found, regexp_extract_all(text, '{pattern}', {group}) AS counted
      FROM rows WHERE regexp_matches(text, '{pattern}'))""")
    base = ", ".join(f"'{k}'" for k in KINDS[:3])
    joined = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank){0}, '')"
    return f"""
WITH rows AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(parts)}),
p AS (
  SELECT row_id, rank, kind, found[i] AS hit, len(counted[i]) >= least AS good,
    list_sum(list_transform(pieces[1:i], lambda x: len(x)))::BIGINT + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: len(x))), 0)::BIGINT AS s
  FROM m),
f AS (SELECT *, s + len(hit) AS e FROM p WHERE good),
a AS (
  SELECT row_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex, {joined.format(f" FILTER (WHERE kind IN ({base}))")} AS base, {joined.format("")} AS spans
  FROM f GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM rows LEFT JOIN a USING (row_id)
"""


def quality_rules_sql(limits: Limits = Limits()) -> str:
    k = limits.window
    others = ", ".join(f"len(text) - len(regexp_replace(text, '{p.replace(chr(92) * 2, chr(92)).replace(chr(39), chr(39) * 2)}', '', 'g'))" for p in OTHERS)
    common = ", ".join(f"'{w}'" for w in COMMON_WORDS)
    return f"""
WITH rows AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(lang, chr(1)) AS lang, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
w AS (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, win) AS n
  FROM (SELECT row_id, i, ws[i:i + {k - 1}] AS win FROM (SELECT row_id, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM rows))),
r AS (SELECT row_id, sum(least({k}, coalesce(nxt - i, {k})))::BIGINT AS n_repeat_words
  FROM (SELECT row_id, i, lead(i) OVER (PARTITION BY row_id ORDER BY i) AS nxt FROM w WHERE n > 1) GROUP BY row_id),
b AS (
  SELECT doc_id, lang, len(ws)::BIGINT AS n_words, len(text) AS n_chars,
    len(regexp_replace(text, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
    (len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^{_SPACE[1:]}')) AS lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    [len(text) - len(regexp_replace(text, '[a-z]', '', 'g')), {others}, len(text) - len(regexp_replace(text, '{_SPACE}', '', 'g'))] AS cb,
    list_transform([{common}], lambda c: len(list_filter(ws, lambda x: lower(x) = c))) AS wb
  FROM rows LEFT JOIN r USING (row_id)),
f AS (
  SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    list_append(cb, n_chars - list_sum(cb)) AS class_bins, list_append(wb, n_words - list_sum(wb)) AS word_bins,
    n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words AS base_failed
  FROM b),
m AS (
  SELECT lang, list(cm ORDER BY i) AS class_mean FROM (
    SELECT lang, i, avg(class_bins[i] / n_chars) AS cm FROM f, range(1, {len(OTHERS) + 4}) t(i) WHERE NOT base_failed GROUP BY lang, i) GROUP BY lang),
v AS (
  SELECT lang, list(wm ORDER BY i) AS word_mean FROM (
    SELECT lang, i, avg(word_bins[i] / n_words) AS wm FROM f, range(1, {len(COMMON_WORDS) + 2}) t(i) WHERE NOT base_failed GROUP BY lang, i) GROUP BY lang),
x AS (
  SELECT f.*, list_transform(list_zip(class_bins, class_mean), lambda z: [z[1] / n_chars, z[2]]) AS cz, list_transform(list_zip(word_bins, word_mean), lambda z: [z[1] / n_words, z[2]]) AS wz
  FROM f LEFT JOIN m USING (lang) LEFT JOIN v USING (lang)),
y AS (
  SELECT *, {_divergence("cz")} AS cd, {_divergence("wz")} AS wd FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_chars >= {limits.class_chars} AND coalesce(cd, 0) > {limits.class_distance})
    AND NOT (n_words >= {limits.word_words} AND coalesce(wd, 0) > {limits.word_distance}) AS kept
FROM y
"""


def _divergence(pairs: str) -> str:
    one = "CASE WHEN {0} > 0 THEN {0} * log2({0} / ((z[1] + z[2]) / 2)) ELSE 0 END"
    return f"sqrt(greatest(0, list_sum(list_transform({pairs}, lambda z: {one.format('z[1]')} + {one.format('z[2]')})) / 2))"


def lexical_search_sql(k: int = 10) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    found = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, {found} AS terms FROM documents),
n AS (SELECT row_id, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
sums AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM n),
p AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, sums GROUP BY term, n_docs),
q AS (SELECT DISTINCT item_id, unnest({found}) AS term FROM benchmark),
s AS (
  SELECT q.item_id, n.doc_id, row_id, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * n.n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN n USING (row_id), sums GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, row_id)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {k}
"""


def manifest_sql(levels: int = 11, group_levels: int = 6) -> str:
    """For sources of up to 3 ** levels rows and up to 3 ** group_levels sources; levels that a tree lacks do nothing."""

    def leaf(text: str) -> str:
        parts = ["doc_id", "source", "lang", "n_chars", text]
        return "sha256(" + " || ".join(f"coalesce(strlen(({p})::VARCHAR) || ':' || ({p})::VARCHAR, '-')" for p in parts) + ")"

    def climb(name: str, depth: int) -> str:
        out = []
        for level in range(depth):
            out.append(f"""{name}_runs{level} AS MATERIALIZED (
  SELECT tree, i // 3 AS i, (n + 2) // 3 AS n, list(h ORDER BY i) AS hs FROM {name}{level} WHERE n > 1 GROUP BY ALL),
{name}{level + 1} AS MATERIALIZED (
  SELECT tree, i, n, sha256(array_to_string(hs, '')) AS h FROM {name}_runs{level} UNION ALL SELECT tree, i, n, h FROM {name}{level} WHERE n <= 1),
{name}_path{level + 1} AS MATERIALIZED (
  SELECT p.id, p.tree, p.i // 3 AS i, coalesce(sha256(array_to_string(list_transform(hs, lambda h, k: CASE WHEN k = p.i % 3 + 1 THEN p.f ELSE h END), '')), p.f) AS f,
    p.proof || coalesce(array_to_string(list_filter(hs, lambda h, k: k <> p.i % 3 + 1), ''), '') AS proof
  FROM {name}_path{level} p LEFT JOIN {name}_runs{level} r ON r.tree = p.tree AND r.i = p.i // 3)""")
        return ",\n".join(out)

    return f"""
WITH RECURSIVE ids AS (SELECT row_number() OVER () AS id, * FROM documents),
crc AS (
  SELECT id, doc_id::VARCHAR AS t, 0 AS step, 4294967295::BIGINT AS c FROM ids WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT id, t, step + 1, xor(x >> 1, 3988292384 * (x & 1))
  FROM (SELECT *, CASE WHEN step % 8 = 0 THEN xor(c, ascii(t[step // 8 + 1])::BIGINT) ELSE c END AS x FROM crc WHERE step < 8 * len(t))),
hit AS (SELECT id, c & 1 = 1 AS hit FROM crc WHERE step = 8 * len(t)),
leaves AS MATERIALIZED (
  SELECT id, doc_id, source, {leaf("text")} AS leaf, CASE WHEN hit THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS found
  FROM ids LEFT JOIN hit USING (id)),
placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
a0 AS MATERIALIZED (SELECT tree, i, n, leaf AS h FROM placed),
a_path0 AS MATERIALIZED (SELECT id, tree, i, found AS f, '' AS proof FROM placed),
{climb("a", levels)},
b0 AS MATERIALIZED (SELECT 0 AS tree, tree AS i, count(*) OVER () AS n, h FROM a{levels}),
b_path0 AS MATERIALIZED (SELECT id, 0 AS tree, tree AS i, f, proof FROM a_path{levels}),
{climb("b", group_levels)}
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(p.proof) AS proof_sha256, p.f AS folded_root, p.f = r.h AS verified
FROM placed JOIN a{levels} s USING (tree) JOIN b_path{group_levels} p USING (id), b{group_levels} r
"""
