"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

from citysignal.llm import queries, secrets, toolcalls

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _found(kind: str, pattern: str, fits: str = "true", tail: int = 0) -> str:
    """Spans of all matches: gaps and matches in turn, summed up."""
    p = _quoted(pattern.replace("\\n", "\n") if "\\n" in pattern else pattern)
    return f"""
      SELECT digest, '{kind}' AS kind, start, start + len AS stop FROM (
        SELECT digest, k, len, tail, token,
               list_sum(list_transform(gaps[1:k], lambda g: length(g)))
               + coalesce(list_sum(list_transform(hits[1:k - 1], lambda g: length(g))), 0) AS start
        FROM (
          SELECT digest, k, gaps, hits, length(hits[k]) AS len, tails[k] AS tail, hits[k] AS token
          FROM (
            SELECT digest, string_split_regex(body, {p}) AS gaps,
                   regexp_extract_all(body, {p}) AS hits, regexp_extract_all(body, {p}, {tail}) AS tails
            FROM texts
          ), unnest(range(1, len(hits) + 1)) AS u(k)
        )
      ) WHERE {fits}"""


_MIXED = (
    "regexp_matches(token, '[0-9]') AND regexp_matches(token, '[A-Z]') "
    "AND regexp_matches(token, '[a-z]')"
)
_RANK = "list_position([" + ", ".join(map(_quoted, secrets.KINDS)) + "], kind)"
_NEAR = f"b.digest = a.digest AND b.scope = a.scope AND b.start <= a.stop + {secrets.REACH} AND b.stop + {secrets.REACH} >= a.start"  # noqa: E501


def linked_secrets() -> str:
    spelled = f"string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, {_RANK}, stop)"
    ident, both = "('access', 'ident')", "('assign', 'hex', 'secret')"
    return f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS body, sha256(coalesce(text, '')) AS digest FROM documents),
    texts AS (SELECT digest, any_value(body) AS body FROM docs GROUP BY digest),
    strong AS ({_found("assign", secrets.ASSIGN, f"length(tail) >= {secrets.ASSIGN_LEAST}", 2)}
      UNION ALL {_found("access", secrets.ACCESS)}
      UNION ALL {_found("hex", secrets.HEX)}),
    weak AS (SELECT * FROM ({_found("ident", secrets.IDENT)}
      UNION ALL {_found("secret", secrets.SECRET, _MIXED)}
      UNION ALL {_found("endpoint", secrets.ENDPOINT)}) w
      WHERE NOT EXISTS (SELECT 1 FROM strong s WHERE s.digest = w.digest AND s.start < w.stop AND w.start < s.stop)),
    blanks AS ({_found("blank", secrets.BLANK)}),
    parts AS (SELECT p.*, coalesce((SELECT max(stop) FROM blanks b WHERE b.digest = p.digest AND b.stop <= p.start), 0) AS scope
      FROM (SELECT * FROM weak UNION ALL SELECT * FROM strong) p),
    links AS (SELECT a.digest, a.kind, a.start, a.stop FROM parts a
      WHERE (a.kind = 'ident' AND EXISTS (SELECT 1 FROM parts b WHERE b.kind IN {both} AND {_NEAR}))
         OR (a.kind = 'secret' AND EXISTS (SELECT 1 FROM parts b WHERE b.kind IN {ident} AND {_NEAR}))
         OR (a.kind = 'endpoint' AND EXISTS (SELECT 1 FROM parts b WHERE b.kind IN {both} AND {_NEAR})
             AND EXISTS (SELECT 1 FROM parts b WHERE b.kind IN {ident} AND {_NEAR}))),
    base AS (SELECT digest, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                    count(*) FILTER (kind = 'hex') AS n_hex, {spelled} AS base FROM strong GROUP BY digest),
    whole AS (SELECT digest, {spelled} AS spans FROM (SELECT digest, kind, start, stop FROM strong
              UNION ALL SELECT digest, kind, start, stop FROM links) GROUP BY digest)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM docs LEFT JOIN base USING (digest) LEFT JOIN whole USING (digest)"""  # noqa: E501


def linked_calls() -> str:
    rule = toolcalls.SEARCH["search"]
    least, most = rule["query"]["min_length"], rule["limit"]["maximum"]
    return f"""
    WITH turns AS (
      SELECT conv_id, turn, role, coalesce(text, '') AS body, role <> 'assistant' AS is_call,
             conv_id || '-' || (turn - CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) AS call_id
      FROM conversations),
    calls AS (SELECT conv_id, call_id, min(turn) AS turn, count(*) AS copies, arg_min(role, turn) AS role, arg_min(body, turn) AS body
      FROM turns WHERE is_call GROUP BY ALL),
    results AS (SELECT conv_id, call_id, min(turn) AS result_turn, count(*) AS result_copies, arg_min(body, turn) AS result
      FROM turns WHERE NOT is_call GROUP BY ALL),
    joined AS (
      SELECT conv_id, call_id, turn, result_turn, coalesce(copies, result_copies) AS copies, result, body,
             CASE role WHEN 'user' THEN 'search' WHEN 'system' THEN 'instruct' END AS name,
             len(string_split(body, ' ')) AS n, turn IS NOT NULL AS is_call
      FROM calls FULL JOIN results USING (conv_id, call_id)),
    judged AS (
      SELECT *, CASE WHEN NOT is_call THEN ''
                     WHEN name = 'search' THEN concat_ws(',', CASE WHEN n > {most} THEN 'limit:value' END, CASE WHEN length(body) < {least} THEN 'query:value' END)
                     ELSE CASE WHEN body = '' THEN 'text:value' ELSE '' END END AS errors
      FROM joined)
    SELECT conv_id, call_id, name, turn, result_turn, coalesce(turn, result_turn) AS order_at, 0 AS order_hops,
           CASE WHEN NOT is_call THEN 'orphan' WHEN result_turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
           copies, is_call AND errors = '' AS valid, errors,
           '{{"arguments":' || CASE WHEN name = 'search' THEN '{{"limit":' || n || ',"mode":"' || CASE WHEN length(body) > 300 THEN 'long' ELSE 'plain' END
             || '","query":' || to_json(body)::VARCHAR || '}}' WHEN is_call THEN '{{"text":' || to_json(body)::VARCHAR || '}}' ELSE 'null' END
           || ',"id":' || to_json(call_id)::VARCHAR || ',"name":' || coalesce('"' || name || '"', 'null')
           || ',"result":' || CASE WHEN result_turn IS NULL THEN 'null' ELSE '{{"text":' || to_json(result)::VARCHAR || '}}' END || '}}' AS record
    FROM judged"""  # noqa: E501


def benchmark_hits() -> str:
    words = (
        f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
        "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    return f"""
    WITH items AS (SELECT item_id, {words} AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
      FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
    docs AS (SELECT row_number() OVER () AS row, doc_id, {words} AS w FROM documents),
    sizes AS (SELECT DISTINCT size FROM windows),
    spots AS (
      SELECT row, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
      FROM docs, sizes, unnest(range(1, greatest(len(w) - size + 1, 0) + 1)) AS u(i)),
    hits AS (SELECT row, size, i, item_id FROM spots JOIN windows USING (size, win)),
    marked AS (SELECT row, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, size)) AS u(k) GROUP BY row),
    proven AS (SELECT row, count(DISTINCT item_id) AS n_items,
                      sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS listed FROM hits GROUP BY row)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           coalesce(listed, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN marked USING (row) LEFT JOIN proven USING (row)"""  # noqa: E501


def salvaged_archives() -> str:
    return """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h,
                 min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '') AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM d"""  # noqa: E501


def jaccard_groups() -> str:
    return f"""
    WITH RECURSIVE docs AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
      FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
      FROM docs, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (
      SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
    ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached(doc_id, other) AS (
      SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, e.b FROM reached r JOIN ends e ON e.a = r.other)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM docs d LEFT JOIN sizes USING (doc_id)
    JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)"""  # noqa: E501


def url_verdicts() -> str:
    rules = ", ".join(
        f"('{r.text}', '{r.host}', '{r.path}', '{r.verdict}', {len(r.text)})" for r in queries.URL_RULES
    )
    named = f"(^|[.-])({'|'.join(queries.SUSPECT_WORDS)})([.-]|$)"
    return f"""
    WITH cut AS (
      SELECT row_number() OVER () AS row, page_id,
             translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
      FROM pages),
    bad AS (SELECT host, path, count(*) OVER (PARTITION BY host) AS n FROM cut WHERE regexp_matches(host, '{named}')),
    entries AS (SELECT DISTINCT CASE WHEN n >= {queries.SUSPECT_PAGES} THEN host ELSE host || path END AS entry FROM bad),
    labels AS (SELECT row, host, path, string_split(host, '.') AS l FROM cut),
    names AS (
      SELECT row, 0 AS rank, host || path AS name FROM cut
      UNION ALL SELECT row, i, array_to_string(l[i:], '.') FROM labels, unnest(range(1, len(l) + 1)) AS u(i)),
    found AS (SELECT row, arg_min(entry, rank) AS listed FROM names JOIN entries ON entry = name GROUP BY row),
    rules AS (SELECT * FROM (VALUES {rules}) AS r(rule, rule_host, rule_path, rule_verdict, size)),
    fits AS (
      SELECT row, arg_max(rule, size) AS rule, arg_max(rule_verdict, size) AS rule_verdict FROM cut JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row)
    SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN listed IS NULL THEN 'allow' ELSE 'block' END) AS verdict, listed
    FROM cut LEFT JOIN fits USING (row) LEFT JOIN found USING (row)"""  # noqa: E501


def merkle_proofs() -> str:
    encoded = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(map(encoded, ("doc_id", "source", "lang", "n_chars")))
    bits = "list_transform(range(0, 8), lambda z: z::BIGINT)"
    step = "CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END"
    table = f"list_transform(range(0, 256), lambda n: list_reduce([n::BIGINT] || {bits}, lambda c, k: {step}))"
    codes = "list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)"
    checksum = f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"
    run = "nodes[3 * i + 1:3 * i + 3]"
    climb = f"list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string({run}, '')))"
    side = lambda a, b: f"array_to_string(nodes[{a}:{b}], '')"
    return f"""
    WITH RECURSIVE crc AS (SELECT {table} AS t),
    docs AS (
      SELECT row_number() OVER () AS row, doc_id, source, {head} AS head, text,
             CASE WHEN {checksum} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut FROM documents, crc),
    leaves AS (
      SELECT row, doc_id, source, sha256(head || {encoded("text")}) AS leaf, sha256(head || {encoded("cut")}) AS other FROM docs),
    placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot FROM leaves),
    trees(source, level, nodes) AS (
      SELECT source, 0, list(leaf ORDER BY spot) FROM placed GROUP BY source
      UNION ALL SELECT source, level + 1, {climb} FROM trees WHERE len(nodes) > 1),
    subroots AS (
      SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place
      FROM trees WHERE len(nodes) = 1),
    crown(level, nodes) AS (
      SELECT 0, list(subroot ORDER BY place) FROM subroots
      UNION ALL SELECT level + 1, {climb} FROM crown WHERE len(nodes) > 1),
    whole AS (SELECT nodes[1] AS root FROM crown WHERE len(nodes) = 1),
    steps AS (
      SELECT row, false AS upper, level, {side("b + 1", "i")} AS before, {side("i + 2", "b + 3")} AS after
      FROM (SELECT row, level, nodes, (spot // (3 ** level)::BIGINT)::BIGINT AS i, i // 3 * 3 AS b
            FROM placed p JOIN trees t ON p.source IS NOT DISTINCT FROM t.source WHERE len(nodes) > 1)
      UNION ALL
      SELECT row, true, level, {side("b + 1", "i")}, {side("i + 2", "b + 3")}
      FROM (SELECT row, level, nodes, (place // (3 ** level)::BIGINT)::BIGINT AS i, i // 3 * 3 AS b
            FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source, crown WHERE len(nodes) > 1)),
    paths AS (
      SELECT row, list({{'before': before, 'after': after}} ORDER BY upper, level) AS path,
             string_agg(before || after, '' ORDER BY upper, level) AS proof FROM steps GROUP BY row),
    folds(row, k, digest) AS (
      SELECT row, 0, other FROM placed
      UNION ALL
      SELECT f.row, k + 1, sha256(path[k + 1].before || digest || path[k + 1].after)
      FROM folds f JOIN paths p USING (row) WHERE k < len(path))
    SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, digest AS folded_root, digest = root AS verified
    FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source CROSS JOIN whole
    LEFT JOIN paths USING (row) JOIN folds f USING (row) WHERE k = coalesce(len(path), 0)"""  # noqa: E501


ORACLES: dict[str, str] = {
    "op3_linked_secrets": linked_secrets(),
    "op4_linked_calls": linked_calls(),
    "op7_benchmark_hits": benchmark_hits(),
    "op8_salvaged_archives": salvaged_archives(),
    "op10_jaccard_groups": jaccard_groups(),
    "op11_url_verdicts": url_verdicts(),
    "op13_merkle_proofs": merkle_proofs(),
}
