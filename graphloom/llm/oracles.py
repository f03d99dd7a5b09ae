"""DuckDB statements for the training-data queries that plain SQL can express.

The statements hold their own literal values, so that a wrong table in an operator shows.
"""

from __future__ import annotations

# Letters drawn like Latin ones and what they are drawn like, letter by letter.
_ALIKE = "ΑАᎪΒВᏴСϹᏟᎠΕЕᎬϜԌᏀΗНᎻΙІӀЈᎫͿΚКᏦᏞΜМᎷϺΝΟОՕΡРᏢԚЅՏᏚΤТᎢՍѴᏙԜᎳΧХΥҮΖᏃаɑαсϲԁеɡցһհіιıјϳӏոоοօрρԛѕսυѵνԝхχуүγᴢ"
_DRAWN = "AAABBBCCCDEEEFGGHHHIIIJJJKKKLMMMMNOOOPPPQSSSTTTUVVWWXXYYZZaaaccdegghhiiijjlnoooppqsuuvvwxxyyyz"
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_NARROW = "".join(map(chr, range(0x21, 0x7F)))
_LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}
_TRUST = "CASE origin WHEN 'manual' THEN 4 WHEN 'llm' THEN 3 WHEN 'p' THEN 2 WHEN 't' THEN 1 ELSE 0 END"
_FIELDS = ("entity_type", "description", "syntax", "remarks", "header", "return_value")


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _folded(column: str) -> str:
    out = f"translate({column}, {_text(_ALIKE + _WIDE + chr(0x212A))}, {_text(_DRAWN + _NARROW + 'K')})"
    for joined, letters in _LIGATURES.items():
        out = f"replace({out}, '{joined}', '{letters}')"
    return out


def _keyed() -> str:
    value = lambda c: f"CASE WHEN trim(translate(lower({c}), '\t\n\r 　', '     ')) NOT IN ('', '-', '--', '—', 'n/a', 'na', 'null', 'none', 'nil', 'tbd', '无', '暂无', '待补充', '未知') THEN {c} END AS {c}"
    return f"""WITH k AS (SELECT refined_id, document_id, name, refined_at, {_TRUST} AS rank, CASE WHEN confidence BETWEEN 0 AND 1 AND NOT isnan(confidence) THEN confidence END AS confidence,
            {", ".join(value(c) for c in _FIELDS)}, {_folded("name")} AS folded FROM refined),
        m AS (SELECT *, nullif(regexp_replace(regexp_replace(lower(folded), '^.*::', ''), '[^\\p{{L}}\\p{{N}}]', '', 'g'), '') AS name_key FROM k)"""


def _found() -> str:
    flags = ", ".join(f"({c} IS NOT NULL) AS has_{c}" for c in _FIELDS)
    tops = ", ".join(f"max(has_{c}) AS top_{c}" for c in _FIELDS)
    same = " AND ".join(f"has_{c} = top_{c}" for c in _FIELDS)
    return f"""{_keyed()},
        r AS (SELECT refined_id, document_id, name_key, refined_at, coalesce(confidence, -1) AS c, coalesce(length(description), 0) AS n, {flags} FROM m WHERE document_id IS NOT NULL AND name_key IS NOT NULL),
        g AS (SELECT document_id, name_key, count(*) AS n_rows, max(refined_at) AS top_at, max(c) AS top_c, max(n) AS top_n, {tops} FROM r GROUP BY ALL),
        b AS (SELECT r.refined_id, r.document_id, r.name_key FROM r JOIN g USING (document_id, name_key)
            WHERE n_rows >= 2 AND refined_at = top_at AND c = top_c AND n = top_n AND {same})
    SELECT min(refined_id) AS refined_id FROM b GROUP BY document_id, name_key HAVING count(*) = 1"""


def _survivors() -> str:
    n = lambda c: f"length({c})" if c in ("description", "syntax", "remarks") else "0"
    best = ", ".join(f"first({c} ORDER BY {c} IS NOT NULL DESC, rank DESC, refined_at DESC, {n(c)} DESC, {c} DESC) AS {c}" for c in (*_FIELDS, "confidence"))
    return f"""{_keyed()}
    SELECT document_id, name_key, first(name ORDER BY CAST(name = trim(folded) AS INT) + CAST(regexp_matches(name, '^[A-Za-z0-9_]+$') AS INT) DESC, rank DESC, refined_at DESC, name DESC) AS name, {best},
        strftime(max(refined_at) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f') AS refined_at, count(*) AS n_rows, min(refined_id) AS first_id
    FROM m WHERE document_id IS NOT NULL AND name_key IS NOT NULL GROUP BY document_id, name_key"""


_SHARES = """WITH t AS (SELECT source, max(target_share) AS share, max(coalesce(max_repeats, 1)) AS most FROM mix_targets WHERE source IS NOT NULL AND target_share > 0 GROUP BY source),
    d AS (SELECT source, min(doc_id) AS doc_id, length(text) AS n FROM documents WHERE text <> '' AND source IN (SELECT source FROM t) GROUP BY source, text),
    s AS (SELECT t.*, size FROM t JOIN (SELECT source, sum(n) AS size FROM d GROUP BY source) USING (source) WHERE most > 0),
    w AS (SELECT sum(share) AS whole, min(size * most * (SELECT sum(share) FROM s) / share) AS total FROM s),
    p AS (SELECT source, size, least(total * share / whole, size * most) AS need FROM s, w),
    c AS (SELECT d.source, n, size, need, sum(n) OVER (PARTITION BY d.source ORDER BY md5(doc_id || 'mix'), doc_id) - n AS start FROM d JOIN p USING (source)),
    r AS (SELECT source, n, CAST(floor(need / size) + CASE WHEN start < need - floor(need / size) * size THEN 1 ELSE 0 END AS BIGINT) AS k FROM c),
    u AS (SELECT source, count(*) AS n_texts, sum(k) AS n_copies, sum(n * k) AS n_tokens, max(k) AS most_repeats FROM r WHERE k > 0 GROUP BY source)
SELECT m.source, target_share, max_repeats, coalesce(n_texts, 0) AS n_texts, CAST(coalesce(n_copies, 0) AS BIGINT) AS n_copies, CAST(coalesce(n_tokens, 0) AS BIGINT) AS n_tokens, CAST(coalesce(most_repeats, 0) AS INT) AS most_repeats,
    coalesce(n_tokens, 0) / (SELECT CAST(sum(n_tokens) AS DOUBLE) FROM u) AS actual_share FROM mix_targets m LEFT JOIN u ON m.source = u.source"""


def oracle_sql() -> dict[str, str]:
    """One statement per query."""
    return {"p6_found": _found(), "p6_survivors": _survivors(), "p9_shares_by_characters": _SHARES}
