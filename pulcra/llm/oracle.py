"""SQL of the queries that SQL can express, over the same tables."""

_FILTER_AUDIT = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM docs
), masks AS (
  SELECT doc_id, part,
    (len(w) < 200)::INT
    + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > first, false)::INT AS mask
  FROM words
), marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS filter_order, [a.bit, b.bit, d.bit, e.bit, g.bit] AS bits
  FROM f a JOIN f b ON b.c <> a.c JOIN f d ON d.c NOT IN (a.c, b.c)
  JOIN f e ON e.c NOT IN (a.c, b.c, d.c) JOIN f g ON g.c NOT IN (a.c, b.c, d.c, e.c)
), steps AS (
  SELECT filter_order, step::INT AS step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS prior
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), sums AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER (mask & (own + prior) = 0) AS kept,
    sum(n) FILTER (mask & own <> 0 AND mask & prior = 0) AS removed,
    sum(n) FILTER (mask & own <> 0 AND mask & prior <> 0) AS redundant,
    sum(n) FILTER (mask = own) AS unique_fails,
    sum(good) FILTER (mask & own <> 0 AND mask & prior = 0) AS good_lost,
    sum(toxic) FILTER (mask & own <> 0 AND mask & prior = 0) AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM sums
"""



def _secret_scan() -> str:
    either = lambda words: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)
    sep = r"""["\']?\x20*[:=]\x20*["\']?"""
    value = "([A-Za-z0-9+/_.=-]+)"
    kinds = [  # name, pattern, measured group, least length
        ("assign", f"({either('password|passwd|secret|token|api_?key')}){sep}{value}", 2, 8),
        ("access", "AKIA[A-Z0-9]+", 0, 16),
        ("hex", "[0-9a-f]+", 0, 32),
        ("identifier", f"({either('user_?name|user_?id|client_?id|access_?key_?id|account_?id|login')}){sep}([A-Za-z0-9@._+-]+)", 2, 3),
        ("pass", f"({either('pwd|pass|passphrase|secret_?key|private_?key|access_?key|signing_?key|credentials?')}){sep}{value}", 2, 4),
        ("blob", "[A-Za-z0-9+/=_-]{20,}", 0, 20),
        (
            "endpoint",
            "(?:https?|ftps?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|amqps?|rediss?|s3)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+"
            f"|(?:{either('host|hostname|endpoint|base_?url')}){sep}[A-Za-z0-9._:/-]+",
            0,
            10,
        ),
        ("break", r"\n[\x20\t\r]*\n", 0, 0),
    ]
    quoted = [(name, pattern.replace("'", "''"), group, least) for name, pattern, group, least in kinds]
    raw = " UNION ALL ".join(
        f"SELECT r, {k} AS rank, '{name}' AS kind, {least} AS least, string_split_regex(t, '{pattern}') AS gaps, "
        f"regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {group}) AS v FROM docs"
        for k, (name, pattern, group, least) in enumerate(quoted)
    )
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), raw AS ({raw}
), items AS (
  SELECT r, rank, kind, least, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS m, unnest(v) AS v, unnest(gaps[1:len(m)]) AS gap FROM raw
), placed AS (
  SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY r, rank ORDER BY i)::BIGINT AS e FROM items
), checked AS (
  SELECT r, e - length(m) AS s, e,
    CASE WHEN rank = 0 AND length(v) BETWEEN 4 AND 7 THEN 4 ELSE rank END AS rank,
    CASE WHEN rank = 0 AND length(v) BETWEEN 4 AND 7 THEN 'pass' ELSE kind END AS kind,
    CASE WHEN rank = 0 AND length(v) BETWEEN 4 AND 7 THEN true
      WHEN rank = 5 THEN regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')
      ELSE length(v) >= least END AS good
  FROM placed
), ordered AS (
  SELECT *, coalesce(max(e) FILTER (good AND rank < 3) OVER before > s, false) AS covered, count(*) FILTER (rank = 7) OVER before AS scope
  FROM checked WINDOW before AS (PARTITION BY r ORDER BY s, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), parts AS (
  SELECT *, CASE WHEN rank IN (1, 3) THEN 'i' WHEN rank = 6 THEN 'e' ELSE 's' END AS part
  FROM ordered WHERE good AND rank < 7 AND (rank < 3 OR NOT covered)
), linked AS (
  SELECT a.r, a.rank, a.kind, a.s, a.e FROM parts a JOIN parts b
    ON a.r = b.r AND a.scope = b.scope AND abs(a.s - b.s) <= 400 AND a.part <> b.part
  WHERE a.rank > 2 GROUP BY a.r, a.rank, a.kind, a.s, a.e, a.part
  HAVING CASE a.part WHEN 'e' THEN bool_or(b.part = 's') AND bool_or(b.part = 'i') WHEN 'i' THEN bool_or(b.part = 's') ELSE true END
), spans AS (
  SELECT r, rank, kind, s, e FROM parts WHERE rank < 3 UNION ALL SELECT * FROM linked
), lists AS (
  SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN lists USING (r)
"""


ORACLE: dict[str, str] = {"op12_filter_audit": _FILTER_AUDIT, "op13_secret_scan": _secret_scan()}
