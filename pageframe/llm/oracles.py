"""The queries that SQL can express, as DuckDB text."""

from __future__ import annotations

import re

from pageframe.llm import licenses, url_filter

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _low(column: str) -> str:
    return f"translate({column}, '{UPPER}', '{LOWER}')"


def _url_filter() -> str:
    ranked = sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = {_text(h)} OR ends_with(host, {_text('.' + h)})) AND starts_with(path, {_text(p)})", h + p, v) for h, p, v in ranked]
    rule = " ".join(f"WHEN {c} THEN {_text(name)}" for c, name, _ in fits)
    verdict = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    globs = ["".join("(?s:.*)" if p == "**" else "[^/?]*" if p == "*" else re.escape(p).replace("/", "/") for p in re.split(r"(\*\*|\*)", g))
             for g in url_filter.BLOCKED]
    return f"""WITH parts AS (SELECT page_id,
            coalesce({_low("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*(\\?[^#]*)', 1), '') AS query FROM pages)
        SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict}
            WHEN regexp_full_match('.' || host || path || query, {_text('|'.join(f'(?:{g})' for g in globs))}) THEN 'block' ELSE 'allow' END AS verdict
        FROM parts"""


def _licenses() -> str:
    def spelled(x):
        for old, new in licenses.SPELLINGS:
            x = f"replace({x}, {_text(old)}, {_text(new)})"
        return x

    def plain(x):
        return f"regexp_replace(regexp_replace(lower({x}), {_text(licenses._COPYRIGHT_LINE)}, '', 'g'), {_text(licenses._MARKS)}, ' ', 'g')"

    def whole(x):
        one_line = rf"regexp_replace({x}, '\s+', ' ', 'g')"
        return f"sha256({spelled(f'trim({one_line})')})"

    known = ", ".join(f"({_text(i)}, {r}, {_text(t)})" for i, r, t in licenses.KNOWN)
    return f"""WITH known AS (SELECT DISTINCT ON (digest) * FROM (SELECT id, restricted, {whole(plain('t'))} AS digest
            FROM (VALUES {known}) v(id, restricted, t))),
        docs AS (SELECT doc_id, {plain("coalesce(text, '')")} AS p FROM documents),
        lines AS (SELECT doc_id, sha256(line) AS digest FROM (SELECT doc_id, trim(unnest(string_split({spelled('p')}, chr(10)))) AS line FROM docs)
            WHERE line <> ''),
        found AS (SELECT doc_id, string_agg(DISTINCT id, ',' ORDER BY id) AS notices, count(*) AS n, bool_or(restricted) AS r
            FROM lines JOIN known USING (digest) GROUP BY doc_id)
        SELECT d.doc_id, d.digest, k.id AS license_id, coalesce(f.notices, '') AS notices, coalesce(f.n, 0)::BIGINT AS n_notices,
            coalesce(f.r, false) OR coalesce(k.restricted, false) AS restricted
        FROM (SELECT doc_id, {whole('p')} AS digest FROM docs) d LEFT JOIN known k USING (digest) LEFT JOIN found f USING (doc_id)"""


_CONTAMINATION = f"""WITH w AS (SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
    iw AS (SELECT item_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
    windows AS (SELECT item_id, s, ws[s:s + 9] AS g, least(len(ws), 10) AS k
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM iw WHERE len(ws) > 0)),
    places AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM w, (SELECT DISTINCT k FROM windows)),
    hits AS (SELECT doc_id, p, k, item_id, s FROM (SELECT doc_id, p, k, ws[p:p + k - 1] AS g FROM places) JOIN windows USING (g, k)),
    covered AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
    items AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
        FROM hits GROUP BY doc_id),
    runs AS (SELECT doc_id, item_id, p - s AS diagonal, min(p) AS first, max(p + k) - min(p) AS words
        FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item_id, p - s ORDER BY p) AS island FROM hits)
        GROUP BY doc_id, item_id, p - s, island),
    best AS (SELECT DISTINCT ON (doc_id) doc_id, words, item_id, first - 1 AS at FROM runs ORDER BY doc_id, words DESC, item_id, diagonal, first)
    SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
        sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated, coalesce(b.words, 0)::BIGINT AS longest,
        b.item_id AS longest_item, b.at::BIGINT AS longest_start
    FROM w LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id) LEFT JOIN best b USING (doc_id)"""

_NEAR = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    sets AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
    ids AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM ids LEFT JOIN sizes USING (doc_id)"""


_WARC = """WITH raw AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
    firsts AS (SELECT h, min(page_id) AS first FROM raw GROUP BY h),
    fives AS (SELECT r.*, f.first, list_transform(range(0, 4), lambda g: ('0x' || substr(r.h, 10 * g + 1, 10))::BIGINT) AS v FROM raw r JOIN firsts f USING (h))
    SELECT page_id, n::BIGINT AS payload_bytes,
        array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v[i // 8 + 1] >> (35 - 5 * (i % 8))) & 31) + 1, 1)), '')
            AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
    FROM fives"""

_SEARCH = f"""WITH docs AS (SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
    items AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws
        FROM benchmark),
    whole AS (SELECT count(*)::BIGINT AS n, sum(len(ws))::BIGINT AS l FROM docs WHERE len(ws) > 0),
    tf AS (SELECT doc_id, n, t, count(*) AS f FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS t FROM docs) GROUP BY ALL),
    wanted AS (SELECT item, item_id, t, count(*) AS often FROM (SELECT item, item_id, unnest(ws) AS t FROM items) GROUP BY ALL),
    df AS (SELECT t, count(*) AS d FROM tf WHERE t IN (SELECT t FROM wanted) GROUP BY t),
    scores AS (SELECT item, item_id, doc_id, sum(often * floor(1000 * ln((2 * w.n + 2) / (2 * d + 1)))::BIGINT
            * ((1000000000 * f) // (1000 * f + 12 * (100 - 25 + (25 * tf.n * w.n) // w.l)))) AS score
        FROM tf JOIN wanted USING (t) JOIN df USING (t), whole w GROUP BY ALL),
    ranks AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranks WHERE rank <= 20"""

# States of the role sequence: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.  The rows of a conversation
# are taken from left to right, here without spans: the least (cost, audit) of every state after every row.
_REPAIR = """WITH RECURSIVE hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)),
            lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(0, 8), lambda z: 0::BIGINT)),
                lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
                ), 4294967295::BIGINT) % 20 AS code
        FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations)),
    after AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(0, CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
        FROM hit WHERE code <> 0),
    placed AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, substr(role, 1, 1) AS r,
            lag(substr(role, 1, 1)) OVER w AS before, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS tail
        FROM after WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy)),
    faults AS (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM placed),
    counts AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) AS n_rows, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
    says(r, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
    added(p, q, cost, audit) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (1, 2, 3, 'I'), (3, 2, 3, 'I'), (2, 3, 3, 'I'), (0, 3, 6, 'II'), (1, 3, 6, 'II')),
    edits AS (SELECT conv_id, i, p, q, CASE WHEN f.r = says.r THEN 0 ELSE 3 END + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cost,
            CASE WHEN f.r = says.r THEN 'K' ELSE 'R' END AS audit
        FROM faults f, says WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate') AND (f.r = says.r OR says.r <> 's')
        UNION ALL SELECT conv_id, i, q, q, 4, 'D' FROM faults, unnest(range(0, 4)) u(q)),
    steps AS (SELECT e.conv_id, e.i, e.p, a.q, min({'cost': e.cost + a.cost, 'audit': e.audit || a.audit}) AS best
        FROM edits e JOIN added a ON a.p = e.q GROUP BY ALL),
    states AS (SELECT conv_id, 0::BIGINT AS i, q, {'cost': cost, 'audit': audit} AS best FROM (SELECT DISTINCT conv_id FROM faults), added WHERE p = 0
        UNION ALL SELECT s.conv_id, s.i, s.q, min({'cost': b.best.cost + s.best.cost, 'audit': b.best.audit || s.best.audit})
        FROM states b JOIN steps s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i + 1 AND s.p = b.q GROUP BY s.conv_id, s.i, s.q),
    final AS (SELECT s.conv_id, min(best) AS best FROM states s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = c.n_rows WHERE q IN (0, 3) GROUP BY s.conv_id),
    letters AS (SELECT conv_id, audit, pos, substr(audit, pos, 1) AS e, length(replace(substr(audit, 1, pos), 'I', '')) AS i,
            length(replace(substr(audit, 1, pos), 'D', '')) + length(replace(audit, 'D', '')) % 2 AS said
        FROM (SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS pos FROM final)),
    lines AS (SELECT l.conv_id, string_agg(CASE WHEN e = 'K' THEN f.role WHEN said % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE f.text END,
            chr(10) ORDER BY pos) AS whole
        FROM letters l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i WHERE e <> 'D' GROUP BY l.conv_id)
    SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
        coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(f.best.cost, 0)::BIGINT AS cost,
        coalesce(f.best.audit, '') AS audit, sha256(coalesce(l.whole, '')) AS repaired_sha256, coalesce(c.n_rows, 0)::BIGINT AS n_rows
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN final f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM o.conv_id"""

ORACLES = {"op5_url_automaton": _url_filter(), "op6_license_digests": _licenses(), "op7_suffix_arrays": _CONTAMINATION, "op10_bottom_k": _NEAR,
           "op11_warc_source": _WARC, "op12_reversed_search": _SEARCH, "op13_interval_repair": _REPAIR}
