"""DuckDB SQL for the queries that SQL can express; the others are tested by brute force."""

from __future__ import annotations

from eventlake.llm.mixing import DRAWS, MAX_REPEAT, SEEDS

# Terms of the lexical search: A-Z lower-cased, all else as it is.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _merkle() -> str:
    """The manifest's trees level by level: enough levels for 8^9 documents of a language, 8^4 languages."""
    crc = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(split(CAST(doc_id AS VARCHAR), ''),
        lambda c: ascii(c)::UBIGINT)), lambda a, b: %s)"""
    step = "xor(a, b)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda c: xor(c >> 1, (c & 1) * 3988292384))[1]"
    value = "coalesce(octet_length(encode({0})) || ':' || {0}, '-')"
    names = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)")
    head = " || ".join(value.format(f) for f in names)
    parts = [
        f"""base AS (
    SELECT doc_id, lang, sha256({head} || {value.format("text")}) AS leaf,
           sha256({head} || {value.format(_LOWER)}) AS low,
           coalesce(xor({crc % step}, 4294967295) % 3 = 0, FALSE) AS tampered
    FROM documents
), l0 AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h FROM base
)"""
    ]

    def level(name: str, below: str, group: str) -> str:
        return f"""{name} AS (
    SELECT {group} i // 8 AS i, CASE WHEN any_value(c) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
    FROM (SELECT *, count(*) OVER ({"PARTITION BY lang" if group else ""}) AS c FROM {below}) GROUP BY {group} i // 8
)"""

    for d in range(1, 10):
        parts.append(level(f"l{d}", f"l{d - 1}", "lang,"))
    parts.append("t0 AS (SELECT row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, lang, h FROM l9)")
    for d in range(1, 5):
        parts.append(level(f"t{d}", f"t{d - 1}", ""))
    # The siblings of every node: what stands before and after it in its run, nothing once one is left.

    def beside(name: str, level: str, group: str) -> str:
        return f"""{name} AS (
    SELECT *, coalesce(string_agg(h, '') OVER (PARTITION BY {group} i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
           coalesce(string_agg(h, '') OVER (PARTITION BY {group} i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a,
           count(*) OVER ({"PARTITION BY lang" if group else ""}) AS c FROM {level}
)"""

    parts += [beside(f"s{d}", f"l{d}", "lang,") for d in range(9)]
    parts += [beside(f"u{d}", f"t{d}", "") for d in range(4)]
    rows = """rows AS (
    SELECT doc_id, lang, leaf, CASE WHEN tampered THEN low ELSE leaf END AS h,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM base
), f0 AS (SELECT *, i AS j, '' AS p, h AS h0, CAST(1 AS BIGINT) AS copies FROM rows)"""
    parts.append(rows)
    for d in range(9):
        parts.append(f"""f{d + 1} AS (
    SELECT f.* EXCLUDE (h, j, p, copies), f.copies + (s.c > 1)::BIGINT AS copies, f.j // 8 AS j, f.p || s.b || s.a AS p,
           CASE WHEN s.c = 1 THEN f.h ELSE sha256(s.b || f.h || s.a) END AS h
    FROM f{d} f JOIN s{d} s ON f.lang IS NOT DISTINCT FROM s.lang AND f.j = s.i
)""")
    parts.append("""g0 AS (
    SELECT f.* EXCLUDE (j), t.i AS j, t.h AS subroot FROM f9 f JOIN t0 t ON f.lang IS NOT DISTINCT FROM t.lang
)""")
    for d in range(4):
        parts.append(f"""g{d + 1} AS (
    SELECT g.* EXCLUDE (h, j, p, copies), g.copies + (u.c > 1)::BIGINT AS copies, g.j // 8 AS j, g.p || u.b || u.a AS p,
           CASE WHEN u.c = 1 THEN g.h ELSE sha256(u.b || g.h || u.a) END AS h
    FROM g{d} g JOIN u{d} u ON g.j = u.i
)""")
    return f"""WITH {", ".join(parts)}
SELECT g.doc_id, g.leaf, g.subroot, t.h AS root, sha256(g.p) AS proof_sha256, g.h AS folded_root, g.h = t.h AS verified,
       CASE WHEN g.h0 <> g.leaf THEN g.copies ELSE 0 END AS n_copied
FROM g4 g, t4 t"""


_MERKLE = _merkle()

ORACLES: dict[str, str] = {
    "op6_mixing": rf"""
WITH sized AS (
    SELECT doc_id, source,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), by_source AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
           {MAX_REPEAT} * source_size AS room
    FROM by_source
), steps AS (
    SELECT *, sum(source_size) OVER () AS total,
           coalesce(sum(room) OVER before, 0) AS full_before,
           sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
    FROM weighed
    WINDOW before AS (ORDER BY CAST(room AS DOUBLE) / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
    SELECT *, CAST(total - full_before AS DOUBLE) / CAST(weight_left AS DOUBLE) AS share FROM steps
), settled AS (
    SELECT max(share) AS share FROM shares WHERE weight * share <= room
), aimed AS (
    SELECT source, source_size,
           CASE WHEN weight * s.share > room THEN CAST(room AS DOUBLE) ELSE weight * s.share END AS target
    FROM weighed, settled s
), rated AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 1.0 END AS rate FROM aimed
), drawn AS (
    SELECT d.source, d.doc_id, d.size, r.rate, s.seed, r.target,
           floor(r.rate) + CASE WHEN CAST(CAST('0x' || substr(md5(s.seed || '|' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS DOUBLE)
                                     / {DRAWS}.0 < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS n
    FROM sized d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source, range({SEEDS}) s(seed)
), missed AS (
    SELECT source, seed, abs(sum(size * n) - any_value(target)) AS miss FROM drawn GROUP BY source, seed
), best AS (
    SELECT source, seed FROM missed
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, seed) = 1
)
SELECT d.doc_id, d.size, d.source, r.source_size, r.target, CAST(d.size * d.n AS BIGINT) AS taken
FROM drawn d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.seed = b.seed
JOIN rated r ON d.source IS NOT DISTINCT FROM r.source
""",
    "op3_cover_tree": """
WITH points AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.x, d.x) AS BIGINT) AS score
    FROM points q JOIN points d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op7_url_filter": r"""
WITH hosted AS (
    SELECT page_id, url,
           nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), parts AS (
    SELECT *, string_split(host, '.') AS labels FROM hosted
), captures AS (
    SELECT p.*, epoch_us(e.ts) AS t_us FROM parts p LEFT JOIN events e ON e.event_id = p.page_id
), changes AS (
    SELECT CASE WHEN event_type IN ('click', 'error')
                THEN 'domain:' || array_to_string(list_slice(labels, greatest(len(labels) - 2, 1), len(labels)), '.')
                WHEN event_type = 'view' THEN 'url:' || host || path
                ELSE 'host:' || host END AS rule,
           epoch_us(ts) AS t_us,
           CASE WHEN event_type IN ('click', 'view') THEN 'block' WHEN event_type = 'purchase' THEN 'allow' END AS action
    FROM events JOIN parts ON user_id = page_id
), merged AS (
    SELECT rule, t_us, max(action) AS action FROM changes WHERE rule IS NOT NULL AND t_us IS NOT NULL GROUP BY rule, t_us
), spans AS (
    SELECT *, coalesce(lead(t_us) OVER (PARTITION BY rule ORDER BY t_us), 4503599627370496) AS until FROM merged
), asked AS (
    SELECT page_id, t_us, 'url:' || host || path AS rule, 2000 AS rank FROM captures
    UNION ALL SELECT page_id, t_us, 'host:' || host, 1000 FROM captures
    UNION ALL SELECT page_id, t_us, 'domain:' || array_to_string(list_slice(labels, len(labels) - n + 1, len(labels)), '.'), n
              FROM captures, range(2, 100) r(n) WHERE n <= len(labels)
), hits AS (
    SELECT a.page_id, a.rule, a.rank, s.action
    FROM asked a JOIN spans s ON a.rule = s.rule AND s.t_us <= a.t_us AND a.t_us < s.until AND s.action IS NOT NULL
), tops AS (
    SELECT page_id, count(*) AS n_active, arg_max(rule, rank) AS rule, arg_max(action, rank) AS action
    FROM hits GROUP BY page_id
)
SELECT c.page_id, CAST(coalesce(t.n_active, 0) AS BIGINT) AS n_active, t.rule, t.action,
       coalesce(t.action = 'block', false) AS blocked
FROM captures c LEFT JOIN tops t USING (page_id)
""",
    "op11_lexical": rf"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents
), sizes AS (
    SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), whole AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), counted AS (
    SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), weighed AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counted, whole GROUP BY term
), means AS (
    SELECT doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM sizes, whole
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN counted USING (term) JOIN weighed USING (term) JOIN means USING (doc_id)
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
    "op12_manifest": _MERKLE,
}
