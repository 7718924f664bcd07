"""The repair query as one SQL statement, without the operator's integers and pieces.

Insertions are left out of the recursion: no cheapest repair has one (a test searches all
edits).  A value is twelve digits of cost and then the letters, so that text order decides.
"""

from __future__ import annotations


def _after(value: str, cost: str, letter: str) -> str:
    return (
        f"lpad(CAST(CAST(substr({value}, 1, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0')"
        f" || substr({value}, 13) || '{letter}'"
    )


def _edge(value: str, initial: str, may_rerole: bool = True) -> str:
    """Keeping a message of this initial, or giving it."""
    kept = f"CASE WHEN fault IN (0, 3) AND initial = '{initial}' THEN {_after(value, 'late', 'K')} END"
    given = f"CASE WHEN fault IN (0, 3) THEN {_after(value, '1 + late', 'R')} END"
    return f"{kept}, {given}" if may_rerole else kept


def statement() -> str:
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
        FROM conversations),
    crc AS (
        SELECT *, xor(list_reduce(list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT)),
            lambda a, b: list_reduce(CAST(range(8) AS BIGINT[]),
                lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(a, b)),
            4294967295), 4294967295) % 20 AS kind
        FROM keyed),
    copies AS (SELECT unnest([3, 99]) AS only_kind),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                ELSE text END AS text
        FROM crc, copies WHERE kind <> 0 AND (only_kind = 99 OR only_kind = kind)),
    placed AS (
        SELECT *, substr(role, 1, 1) AS initial, rtrim(text, {white}) AS body,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
        FROM damaged),
    seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS again,
            lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM placed),
    judged AS (
        SELECT *, CASE WHEN body = '' THEN 1 WHEN again > 1 THEN 2
            WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
        FROM seen),
    messages AS (SELECT *, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS late FROM judged),
    best AS (
        SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, '000000000000' AS v0,
            CAST(NULL AS VARCHAR) AS v1, CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3
        FROM conversations
        UNION ALL
        SELECT b.conv_id, m.n, {_after('v0', '2', 'D')},
            least({_after('v1', '2', 'D')}, {_edge('v0', 's', False)}),
            least({_after('v2', '2', 'D')}, {_edge('v0', 'u')}, {_edge('v1', 'u')}, {_edge('v3', 'u')}),
            least({_after('v3', '2', 'D')}, {_edge('v2', 'a')})
        FROM best b JOIN messages m ON b.conv_id IS NOT DISTINCT FROM m.conv_id AND m.n = b.n + 1),
    solved AS (
        SELECT conv_id, CAST(substr(least(v0, v3), 1, 12) AS BIGINT) AS cost,
            substr(least(v0, v3), 13) AS audit
        FROM best
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
    edited AS (
        SELECT m.conv_id, m.n, m.role, m.text, m.initial, substr(s.audit, m.n, 1) AS letter
        FROM messages m JOIN solved s ON m.conv_id IS NOT DISTINCT FROM s.conv_id),
    stays AS (
        SELECT *, row_number() OVER lines - CAST(first_value(initial || letter) OVER lines = 'sK' AS INT)
            AS place
        FROM edited WHERE letter <> 'D' WINDOW lines AS (PARTITION BY conv_id ORDER BY n)),
    texts AS (
        SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN place % 2 = 1 THEN 'user'
            ELSE 'assistant' END || ':' || text, chr(10) ORDER BY n) AS repaired
        FROM stays GROUP BY conv_id),
    counts AS (
        SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
            count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
            count(*) FILTER (WHERE fault = 3) AS truncated,
            count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM messages GROUP BY conv_id)
    SELECT s.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
        coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, cost, audit,
        sha256(coalesce(repaired, '')) AS repaired_sha256
    FROM solved s LEFT JOIN counts c ON s.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN texts t ON s.conv_id IS NOT DISTINCT FROM t.conv_id
    """
