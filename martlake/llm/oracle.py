"""DuckDB SQL for those registered queries that SQL expresses, written from
their definitions."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op10_line_dedup"] = r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents WHERE doc_id IS NOT NULL
), lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key, max(doc_id) AS top FROM keyed
    WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), flagged AS (
    SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND c.top <> k.doc_id AS gone
    FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""


def _shares_sql(parent: str, path: str, level: str) -> str:
    """Budgets of one level: a node is full if the weighted share of its
    siblings' common rest reaches its capacity."""
    by = f"PARTITION BY {parent}" if parent else ""
    using = f"USING ({parent})" if parent else "ON true"
    return f"""
{level}_nodes AS (
    SELECT {path}, sum(cap)::BIGINT AS cap, max(w_{level}) AS w FROM leaves GROUP BY {path} HAVING sum(cap) > 0
), {level}_rank AS (
    SELECT n.*, a.budget AS above,
        row_number() OVER ({by} ORDER BY n.cap::DOUBLE / w::DOUBLE, {level}) AS r
    FROM {level}_nodes n JOIN {{above}} a {using}
), {level}_sums AS (
    SELECT *, sum(w) OVER o AS w_from, sum(cap) OVER p - cap AS c_before FROM {level}_rank
    WINDOW o AS ({by} ORDER BY r DESC), p AS ({by} ORDER BY r)
), {level}_full AS (
    SELECT *, cap * w_from <= w * (above - c_before) AS is_full FROM {level}_sums
), {level}_budget AS (
    SELECT {path}, CASE WHEN is_full THEN cap ELSE
        (w * (above - coalesce(sum(cap) FILTER (is_full) OVER b, 0))) // sum(w) FILTER (NOT is_full) OVER b
        END::BIGINT AS budget
    FROM {level}_full WINDOW b AS ({by})
)"""


def _mixing_sql() -> str:
    from martlake.llm import mixing

    def weight(level):
        listed = mixing.WEIGHTS[level]
        cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in listed.items())
        return f"(CASE {level} {cases} ELSE 1 END)" if listed else "1"

    domains = ", ".join(f"'{d}'" for d in mixing.DOMAINS)
    levels = [("", "domain", "domain"), ("domain", "domain, lang", "lang"), ("domain, lang", "domain, lang, source", "source")]
    parts, above = [], "root"
    for parent, path, level in levels:
        parts.append(_shares_sql(parent, path, level).replace("{above}", above))
        above = f"{level}_budget"
    return rf"""
WITH base AS (
    SELECT doc_id, [{domains}][coalesce(TRY_CAST(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS BIGINT), 0)
            % {len(mixing.DOMAINS)} + 1] AS domain,
        coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
    FROM documents
), counted AS (SELECT * FROM base WHERE n_tokens > 0
), leaves AS (
    SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::BIGINT * {mixing.MAX_EPOCHS} AS cap,
        {weight('domain')} AS w_domain, {weight('lang')} AS w_lang, {weight('source')} AS w_source
    FROM counted GROUP BY domain, lang, source
), root AS (SELECT sum(tokens)::BIGINT AS budget FROM leaves
), {",".join(parts)}, plan AS (
    SELECT l.domain, l.lang, l.source, budget // tokens AS epochs, budget % tokens AS rest
    FROM leaves l JOIN source_budget b USING (domain, lang, source)
), run AS (
    SELECT c.*, epochs, rest, sum(n_tokens) OVER (
        PARTITION BY domain, lang, source ORDER BY md5(concat_ws(':', '{mixing.SEED}', epochs::VARCHAR, doc_id::VARCHAR))
        ROWS UNBOUNDED PRECEDING) AS upto
    FROM counted c JOIN plan USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_tokens, (epochs + (upto <= rest)::INT)::BIGINT AS copies
FROM run WHERE epochs + (upto <= rest)::INT > 0
"""


ORACLE_SQL["op5_source_mixing"] = _mixing_sql()
