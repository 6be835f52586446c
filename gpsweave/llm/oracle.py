"""DuckDB text for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from math import ceil

from . import license_scan as lic

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH n AS (SELECT doc_id, {LOWERED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


def license_scan_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    notices = ", ".join(
        f"([{', '.join(repr(w) for w in sorted(set(t.split())))}], "
        f"{ceil(lic.CONTAINMENT * len(set(t.split())) - 1e-9)}, {lic.window(t)}, '{label}')" for t, label in lic.NOTICES)
    hits = " UNION ALL ".join(
        f"SELECT doc_id, unnest(list_filter(range(len(w)), lambda i: "
        + " AND ".join(f"w[i + {j + 1}] = '{x}'" for j, x in enumerate(p.split()))
        + f")) AS pos, '{label}' AS label FROM words" for p, label in lic.PHRASES.items())
    ends = lic.PARAGRAPH_END
    return f"""
WITH low AS (SELECT doc_id, {LOWERED} AS t FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '{word}') AS w FROM low),
hits AS ({hits}),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
                list(DISTINCT label) AS labels FROM hits GROUP BY doc_id),
notices(need_words, need, width, label) AS (VALUES {notices}),
paragraphs AS (SELECT doc_id, regexp_extract_all(b, '{word}') AS w
               FROM (SELECT doc_id, unnest(string_split_regex(t, '{ends}')) AS b FROM low)),
likely AS (SELECT doc_id, w, need_words, need, width, label FROM paragraphs, notices WHERE len(list_intersect(w, need_words)) >= need),
shares AS (SELECT doc_id, label, len(list_intersect(w[i:i + width - 1], need_words)) AS n, len(need_words) AS size, need
           FROM (SELECT *, unnest(list_filter(range(1, len(w) + 1), lambda i: list_contains(need_words, w[i]))) AS i FROM likely)),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(n / size) AS share
          FROM shares WHERE n >= need GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(b.n_base, 0)::BIGINT AS n_base,
       b.first_word::BIGINT AS first_word, b.last_word::BIGINT AS last_word,
       array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels,
       CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(f.share, 0.0)::DOUBLE END AS score
FROM words w LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)
"""


FILTER_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
             + 4 * (100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * len(t))::INT
             + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > first_id, false)::INT AS fails
      FROM w LEFT JOIN marks ON w.doc_id = marks.doc_id),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
letters(f, i) AS (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4)),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step, (1 << (ascii(filter_order[step]) - 65))::INT AS own,
                 list_sum([0] || list_transform(range(1, step), lambda i: (1 << (ascii(filter_order[i]) - 65))::INT))::INT AS earlier
          FROM orders, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, own,
             sum(CASE WHEN fails & (earlier | own) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN fails & earlier = 0 AND fails & own > 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fails & earlier > 0 AND fails & own > 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fails & earlier = 0 AND fails & own > 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN fails & earlier = 0 AND fails & own > 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM g, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""


COLLOCATIONS = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
sizes(k) AS (VALUES (1), (2), (3), (4)),
starts AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, sizes WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM starts GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE f >= 30),
longer AS (SELECT lang, unnest([array_to_string(v[1:s], ' ') FOR s IN [k - 1]] || [array_to_string(v[2:k], ' ')] ||
                               CASE WHEN k = 4 THEN [array_to_string(v[1:2], ' '), array_to_string(v[2:3], ' '), array_to_string(v[3:4], ' ')] ELSE [] END)
                  AS phrase, f FROM (SELECT *, string_split(phrase, ' ') AS v FROM often WHERE k > 2)),
inside AS (SELECT lang, phrase, max(f) AS most FROM longer GROUP BY ALL),
kept AS (SELECT o.lang, o.phrase, o.k, o.f AS a, string_split(o.phrase, ' ') AS v FROM often o LEFT JOIN inside i ON o.lang = i.lang AND o.phrase = i.phrase
         WHERE o.k > 1 AND coalesce(100 * i.most < 80 * o.f, true)),
cuts AS (SELECT lang, phrase, a, k, v, unnest(range(1, k)) AS c FROM kept),
parts AS (SELECT x.lang, x.phrase, x.a, x.c, l.f AS l, r.f AS r, (2000000::HUGEINT * x.a) // (l.f::HUGEINT + r.f) AS score
          FROM cuts x JOIN often l ON l.lang = x.lang AND l.phrase = array_to_string(x.v[1:x.c], ' ')
                      JOIN often r ON r.lang = x.lang AND r.phrase = array_to_string(x.v[x.c + 1:x.k], ' ')),
least AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM least)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_license_scan": license_scan_sql(), "op8_exact_dedup": EXACT_DEDUP, "op11_collocations": COLLOCATIONS,
            "op12_filter_audit": FILTER_AUDIT}
