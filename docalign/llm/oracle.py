"""SQL for the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k
  FROM s
), c AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
            >= cap * sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS over
  FROM o
), f AS (
  SELECT *, bool_and(over) OVER (ORDER BY k) AS capped FROM c
), t AS (
  SELECT source, source_size::BIGINT AS source_size,
         CASE WHEN capped THEN cap
              ELSE coalesce((total - coalesce(sum(cap) FILTER (capped) OVER (), 0)) * weight
                   / nullif(sum(weight) FILTER (NOT capped) OVER (), 0), 0) END AS target
  FROM f
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
, r AS (
  SELECT *, (CASE WHEN before + size / 2.0 < target THEN 1 ELSE 0 END)
       + (CASE WHEN before + source_size + size / 2.0 < target THEN 1 ELSE 0 END)
       + (CASE WHEN before + 2 * source_size + size / 2.0 < target THEN 1 ELSE 0 END) AS repeats
  FROM p
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * repeats)::BIGINT AS taken, repeats::INT AS repeats,
       CASE WHEN repeats > 0 THEN round((before + size / 2.0) / target, 9) END AS first_position
FROM r
"""

OP2 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         list_sum(list_transform(list_zip(q.c, v.c), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""

#: Measures and verdict of the quality rules; the limits are those of LineLimits.
QUALITY = r"""
words AS (
  SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS raw
  FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 4]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, range(5) AS r(k) WHERE windows.n > 1 GROUP BY doc_id
), lines AS (
  SELECT DISTINCT doc_id, source, line, length(line) AS chars FROM (
    SELECT doc_id, source, unnest(list_transform(raw, lambda x: lower(trim(x, e' \t\n\x0b\x0c\r')))) AS line
    FROM words)
  WHERE line <> ''
), hosts AS (
  SELECT source, greatest(20, count(*) * 0.002) AS least FROM documents GROUP BY source
), frequent AS (
  SELECT lines.source, line FROM lines JOIN hosts ON lines.source IS NOT DISTINCT FROM hosts.source
  GROUP BY lines.source, line, least HAVING count(*) > least
), held AS (
  SELECT l.* FROM lines AS l JOIN frequent AS f ON l.line = f.line AND l.source IS NOT DISTINCT FROM f.source
), totals AS (
  SELECT doc_id, sum(chars) AS total FROM lines GROUP BY doc_id
), witnesses AS (
  SELECT doc_id FROM held JOIN totals USING (doc_id) GROUP BY doc_id, total HAVING total - sum(chars) >= total * 0.5
), common AS (
  SELECT h.source, line FROM held AS h JOIN hosts ON h.source IS NOT DISTINCT FROM hosts.source
  WHERE doc_id IN (SELECT doc_id FROM witnesses)
  GROUP BY h.source, line, least HAVING count(*) > least
), depleted AS (
  SELECT doc_id FROM held AS h JOIN common AS c ON h.line = c.line AND h.source IS NOT DISTINCT FROM c.source
  JOIN totals USING (doc_id)
  GROUP BY doc_id, total HAVING total - sum(chars) < 50 OR total - sum(chars) < total * 0.2
), measured AS (
  SELECT doc_id, len(w) AS n_words,
         list_sum(list_transform(w, lambda x: length(x))) AS word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols,
         len(list_filter(raw, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
           - len(list_distinct(list_filter(raw, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         doc_id IN (SELECT doc_id FROM depleted) AS depleted
  FROM words LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
"""

OP9 = f"""
WITH {QUALITY}
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, depleted,
       NOT base_failed AND NOT depleted AS kept
FROM judged
"""

#: Wording that a text must hold for a template's label; words joined by a space. Parts that may be
#: left out at either end of a template change no label, so they are not written here.
WORDING = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files (the software )?to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "isc": "permission to use copy modify and (or )?distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met",
    "mit-notice": "released under the mit license",
    "apache-2.0": "licensed under the apache license version 2 0",
    "gpl-3.0": "licensed under the gnu general public license version 3",
    "gpl-notice": "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
    "the free software foundation either version ([^ ]+ ){1,2}of the license or at your option any later version",
    "cc-by-4.0": "licensed under (a creative commons )?cc by 4 0",
    "cc-by-nc-4.0": "licensed under (a creative commons )?cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under (a creative commons )?cc by sa 4 0",
    "cc0-1.0": "to the extent possible under law ([^ ]+ ){1,12}waived all copyright and related or neighboring rights",
    "all-rights-reserved": "all rights reserved",
}
_PHRASES = {
    "gpl": ["gnu", "general", "public", "license"], "apache": ["apache", "license"], "cc-by": ["cc", "by"], "mit": ["mit", "license"],
}
_PLACES = ", ".join(
    f"list_filter(range(len(w)), lambda i: w[i + 1:i + {len(p)}] = {p}) AS \"{label}\"" for label, p in _PHRASES.items()
)
_FOUND = " || ".join(f"CASE WHEN len(\"{label}\") > 0 THEN ['{label}'] ELSE [] END" for label in _PHRASES)
_MATCHED = " || ".join(f"CASE WHEN regexp_matches(joined, ' {r} ') THEN ['{label}'] ELSE [] END" for label, r in WORDING.items())
_ALL = " || ".join(f'"{label}"' for label in _PHRASES)

OP10 = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), places AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS joined, {_PLACES} FROM words
), found AS (
  SELECT *, {_FOUND} AS base, {_MATCHED} AS matched, {_ALL} AS every FROM places
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(every)::BIGINT AS n_base, list_min(every)::BIGINT AS first_word,
       list_max(every)::BIGINT AS last_word, array_to_string(list_sort(base), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || matched)), ',') AS labels,
       CASE WHEN len(matched) > 0 THEN 1.0::DOUBLE WHEN len(base) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM found
"""

SQL = {"op10_licenses": OP10, "op1_mixing": OP1, "op2_topk": OP2, "op9_line_rules": OP9}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
