"""DuckDB SQL for the operators that SQL can express, worked out in another way than they are."""

from __future__ import annotations

from itertools import permutations

from . import codes, mixing, quality, substrings

_WORD = r"'[^\x20\x09-\x0D]+'"
_DOCS = "d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x, source FROM documents)"


def _words(text: str) -> str:
    return f"w AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT r, regexp_extract_all({text}, {_WORD}) AS ws FROM d))"


def _gram(n: int) -> str:
    return "CASE WHEN lead(w, {0}) OVER q IS NOT NULL THEN concat_ws(' ', {1}) END".format(n - 1, ", ".join(f"lead(w, {k}) OVER q" for k in range(n)))


def repetition() -> str:
    ns = list(quality.NGRAM_SHARE)
    grams = ", ".join(f"{_gram(n)} AS g{n}" for n in (3, *ns))
    marks = ", ".join(f"g{n} IS NOT NULL AND row_number() OVER (PARTITION BY r, g{n} ORDER BY i) > 1 AS m{n}" for n in ns)
    covered = ", ".join(f"max(m{n}::int) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS v{n}" for n in (3, *ns))
    sums = ", ".join(f"sum(v{n} * c) AS dup_chars_{n}" for n in ns)
    zero = ", ".join(f"coalesce({x}, 0)::bigint AS {x}" for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars", *(f"dup_chars_{n}" for n in ns)))
    shares = " AND ".join(f"dup_chars_{n} <= {share}::double * word_chars" for n, share in quality.NGRAM_SHARE.items())
    return f"""WITH {_DOCS}, {_words("x")},
    g AS (SELECT r, i, len(w) AS c, {grams} FROM w WINDOW q AS (PARTITION BY r ORDER BY i)),
    m AS (SELECT r, i, c, g3 IS NOT NULL AND count(*) OVER (PARTITION BY r, g3) > 1 AS m3, {marks} FROM g),
    v AS (SELECT r, c, {covered} FROM m),
    by_word AS (SELECT r, count(*) AS n_words, sum(c) AS word_chars, sum(v3) AS n_repeat_words, {sums} FROM v GROUP BY r),
    l AS (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM (SELECT r, string_split(x, chr(10)) AS ls FROM d)),
    ll AS (SELECT r, length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS c, (row_number() OVER (PARTITION BY r, line ORDER BY k) > 1)::int AS later FROM l WHERE regexp_matches(line, {_WORD})),
    by_line AS (SELECT r, count(*) AS n_lines, sum(later) AS n_dup_lines, sum(later * c) AS dup_line_chars FROM ll GROUP BY r),
    s AS (SELECT r, length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
    a AS (SELECT doc_id, {zero} FROM d LEFT JOIN by_word USING (r) LEFT JOIN by_line USING (r) LEFT JOIN s USING (r)),
    b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
    SELECT *, NOT base_failed AND n_symbols <= {quality.SYMBOLS_PER_WORD}::double * n_words AND n_dup_lines <= {quality.LINE_SHARE}::double * n_lines AND dup_line_chars <= {quality.LINE_CHAR_SHARE}::double * word_chars AND {shares} AS kept FROM b"""


def jaccard_join() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = f"translate(x, '{upper}', '{upper.lower()}')"
    return f"""WITH RECURSIVE {_DOCS}, {_words(lowered)},
    s AS (SELECT DISTINCT r, g FROM (SELECT r, {_gram(5)} AS g FROM w WINDOW q AS (PARTITION BY r ORDER BY i)) WHERE g IS NOT NULL
          UNION ALL SELECT r, string_agg(w, ' ' ORDER BY i) FROM w GROUP BY r HAVING count(*) < 5),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    met AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
    links AS (SELECT a, b FROM met JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
    reach(r, root) AS (SELECT r, r FROM d UNION SELECT l.b, c.root FROM reach c JOIN links l ON l.a = c.r)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(e.doc_id) FROM reach JOIN d e ON e.r = reach.root WHERE reach.r = d.r) AS component_id FROM d LEFT JOIN n USING (r)"""


def mix() -> str:
    cap, blocks, seed = mixing.CAP, mixing.BLOCKS, mixing.SEED
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD}))::bigint AS size FROM documents),
    k AS (SELECT *, md5(concat('{seed}:', coalesce(doc_id::varchar, ''), ':', size)) AS key FROM d),
    s AS (SELECT source, sum(size)::bigint AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
    t AS (SELECT *, [{weights}][(rank - 1) % {len(mixing.WEIGHTS)} + 1] AS weight, source_size * {cap} AS most, (sum(source_size) OVER ())::bigint AS total FROM s),
    o AS (SELECT *, row_number() OVER f AS nth, (total - coalesce((sum(most) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::bigint, 0)) / (sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::bigint AS level FROM t WINDOW f AS (ORDER BY most / weight, rank)),
    g AS (SELECT *, least(most::double, weight * (SELECT level FROM o WHERE level * weight <= most ORDER BY nth LIMIT 1)) AS target, greatest(1, ceil(total / {blocks}))::bigint AS block FROM o),
    h AS (SELECT *, total // block AS house, floor((total // block) * target / greatest(total, 1) + 0.5)::bigint AS seats FROM g),
    q AS (SELECT *, (house - sum(seats) OVER ())::bigint AS short FROM h),
    j AS (SELECT *, unnest(range(abs(short))) AS j FROM q),
    r AS (SELECT rank, short, row_number() OVER (ORDER BY quotient DESC NULLS LAST, rank, j) AS nth, quotient FROM (SELECT *, CASE WHEN short > 0 THEN target / (2 * (seats + j) + 1) WHEN seats > j THEN -target / (2 * (seats - j) - 1) END AS quotient FROM j)),
    z AS (SELECT q.*, q.seats + coalesce((SELECT sum(sign(r.short)) FROM r WHERE r.rank = q.rank AND r.nth <= abs(r.short) AND quotient IS NOT NULL), 0)::bigint AS n_blocks FROM q),
    y AS (SELECT *, least(n_blocks * block, most) AS given, ('0x' || substr(md5(concat('{seed}@', coalesce(source, ''))), 1, 12))::bigint % greatest(source_size, 1) AS ring FROM z),
    x AS (SELECT *, CASE WHEN source_size > 0 THEN given // source_size ELSE 0 END AS rounds, CASE WHEN source_size > 0 THEN given % source_size ELSE 0 END AS rest FROM y),
    p AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS spot FROM k)
    SELECT doc_id, size, source_size, target, p.source AS source, rounds::bigint AS rounds, (rounds * size + greatest(0, least(spot + size, ring + rest, source_size) - greatest(spot, ring)) + greatest(0, least(spot + size, ring + rest - source_size) - spot))::bigint AS taken
    FROM p JOIN x ON p.source IS NOT DISTINCT FROM x.source"""


def substring_dedup() -> str:
    k = substrings.WINDOW
    return f"""WITH {_DOCS}, l AS (SELECT r, doc_id, regexp_extract_all(x, {_WORD}) AS ws FROM d),
    p AS (SELECT r, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM l WHERE len(ws) >= {k}),
    g AS (SELECT r, i, sha256(array_to_string(ws[i:i + {k - 1}], ' ')) AS g FROM p),
    m AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY g) > 1),
    c AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM l),
    u AS (SELECT c.r, c.w, c.i, max(m.i) OVER (PARTITION BY c.r ORDER BY c.i) AS start FROM c LEFT JOIN m ON m.r = c.r AND m.i = c.i),
    k AS (SELECT r, count(*) AS kept, string_agg(w, ' ' ORDER BY i) AS text FROM u WHERE start IS NULL OR start < i - {k - 1} GROUP BY r)
    SELECT doc_id, len(ws)::bigint AS n_words, (len(ws) - coalesce(kept, 0))::bigint AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM l LEFT JOIN k USING (r)"""


def vector_codes() -> str:
    parts, entries = codes.PARTS, codes.ENTRIES
    found = """SELECT r, part, unnest(arg_min(struct_pack(entry := entry, far := far), struct_pack(a := far, b := entry))) FROM
        (SELECT c.r, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x))::bigint AS far FROM c JOIN {0} b USING (part, pos) GROUP BY ALL) GROUP BY r, part"""
    moved = """SELECT b.part, b.entry, b.pos, coalesce(s.x, b.x) AS x FROM {0} b LEFT JOIN (SELECT part, entry, pos, CASE WHEN t >= 0 THEN t // n ELSE -((n - 1 - t) // n) END AS x FROM
        (SELECT part, entry, pos, sum(c.x)::bigint AS t, count(*) AS n FROM c JOIN {1} USING (r, part) GROUP BY ALL)) s USING (part, entry, pos)"""
    return f"""WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, embedding FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c AS MATERIALIZED (SELECT r, (i * {parts}) // n AS part, i % (n // {parts}) AS pos, floor({codes.SCALE} * x::double)::bigint AS x FROM (SELECT r, len(embedding) AS n, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM v)),
    b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, x FROM c WHERE r <= {entries}),
    f0 AS MATERIALIZED ({found.format("b0")}), b1 AS MATERIALIZED ({moved.format("b0", "f0")}),
    f1 AS MATERIALIZED ({found.format("b1")}), b2 AS MATERIALIZED ({moved.format("b1", "f1")}),
    f2 AS MATERIALIZED ({found.format("b2")}),
    e AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::bigint AS error FROM f2 GROUP BY r)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::bigint AS label_error, (SELECT sha256(string_agg(x, ',' ORDER BY part, entry, pos)) FROM b2) AS codebooks_sha256 FROM e JOIN v USING (r)"""


def filter_audit() -> str:
    orders = ", ".join(f"'{''.join(x)}'" for x in permutations("ABCDE"))
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
    w AS (SELECT *, regexp_extract_all(x, {_WORD}) AS ws, min(doc_id) OVER (PARTITION BY x) AS least FROM d),
    l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
    f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, concat(CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END, CASE WHEN 100 * (length(x) - length(regexp_replace(x, '[A-Z]', '', 'g'))) > 3 * length(x) THEN 'C' ELSE '' END,
        CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN coalesce(doc_id > least, false) THEN 'E' ELSE '' END) AS fails FROM w LEFT JOIN l USING (doc_id)),
    o AS (SELECT unnest([{orders}]) AS filter_order), s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
    t AS (SELECT filter_order, step::int AS step, filter_order[step:step] AS name, filter_order[1:step - 1] AS before FROM s),
    g AS (SELECT part, fails, count(*) AS n, count_if(good) AS n_good, count_if(toxic) AS n_toxic FROM f GROUP BY ALL),
    c AS (SELECT part, filter_order, step, name, n, n_good, n_toxic, fails, contains(fails, name) AS own, before <> '' AND regexp_matches(fails, concat('[', before, 'x]')) AS gone FROM g CROSS JOIN t),
    a AS (SELECT part, filter_order, step, any_value(name) AS name, sum(CASE WHEN NOT own AND NOT gone THEN n ELSE 0 END)::bigint AS kept, sum(CASE WHEN own AND NOT gone THEN n ELSE 0 END)::bigint AS removed, sum(CASE WHEN own AND gone THEN n ELSE 0 END)::bigint AS redundant,
        sum(CASE WHEN fails = name THEN n ELSE 0 END)::bigint AS unique_fails, sum(CASE WHEN own AND NOT gone THEN n_good ELSE 0 END)::bigint AS good_lost, sum(CASE WHEN own AND NOT gone THEN n_toxic ELSE 0 END)::bigint AS toxic_lost FROM c GROUP BY part, filter_order, step)
    SELECT * EXCLUDE (name), (sum(removed) OVER (PARTITION BY part, name))::bigint AS shapley FROM a"""


def oracles() -> dict[str, str]:
    return {"op6_mixing": mix(), "op7_jaccard_join": jaccard_join(), "op10_repetition": repetition(), "op11_substring_dedup": substring_dedup(), "op12_vector_codes": vector_codes(), "op13_filter_audit": filter_audit()}
