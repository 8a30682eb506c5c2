"""Independent SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_url_filter"] = r"""
WITH rules (r_host, r_path, verdict) AS (VALUES
    ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (
    SELECT page_id,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut),
fits AS (
    SELECT page_id, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(verdict, length(r_host || r_path)) AS verdict
    FROM parts JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    GROUP BY page_id)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)
"""

# The output's length: every run of a role has a start, a role, a separator and an
# end mark, every further turn of it one mark, and every control string in a role or
# text one backslash more.
ORACLE["op2_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES
        (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) AS p (conv_id, turn, role, text)),
marked AS (
    SELECT *, coalesce(role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), false) AS joined,
        length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:\|im_start\|>|\|im_sep\|>|\|im_next\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\])')) AS escaped
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(escaped + CASE WHEN joined THEN length('<|im_next|>') ELSE length('<|im_start|><|im_sep|><|im_end|>') + length(role) END)::BIGINT
        AS formatted_chars
FROM marked GROUP BY conv_id
"""

ORACLE["op9_source_mix"] = r"""
WITH sized AS (
    SELECT doc_id, source, md5('11:' || coalesce(doc_id::VARCHAR, 'null')) AS draw,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight
    FROM sized GROUP BY source),
-- Sources in the order in which a rising level clamps them: the level is the first
-- at which the next one is not clamped.
ranked AS (
    SELECT *, row_number() OVER w AS k, sum(source_size) OVER w - source_size AS clamped, sum(weight) OVER () - (sum(weight) OVER w - weight) AS free,
        sum(source_size) OVER () AS everything
    FROM sources WINDOW w AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
    SELECT arg_min((1.5 * everything - 2.0 * clamped) / free, k) AS level FROM ranked
    WHERE (1.5 * everything - 2.0 * clamped) / free * weight <= 2.0 * source_size),
targets AS (SELECT source, source_size, least(2.0 * source_size, weight * level) AS target FROM sources, level),
plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
places AS (SELECT source, draw, sum(size) AS size FROM sized GROUP BY source, draw),
middles AS (
    SELECT source, draw, sum(size) OVER (PARTITION BY source ORDER BY draw) - size / 2 AS middle FROM places),
extra AS (
    SELECT m.source, m.draw FROM middles m JOIN plan p ON m.source IS NOT DISTINCT FROM p.source
    WHERE middle <= target - whole * source_size)
SELECT s.doc_id, s.size, p.source_size, round(p.target, 6) AS target,
    (s.size * (p.whole + (e.draw IS NOT NULL)::INTEGER))::BIGINT AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN extra e ON s.source IS NOT DISTINCT FROM e.source AND s.draw = e.draw
"""

# Words are joined by single spaces, so that each template is a regular expression.
ORACLE["op4_license_scan"] = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
starts AS (
    SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line,
        list_filter(range(0, len(w)), lambda i: w[i + 1] = 'mit' AND w[i + 2] = 'license') AS mit,
        list_filter(range(0, len(w)), lambda i: w[i + 1] = 'apache' AND w[i + 2] = 'license') AS apache,
        list_filter(range(0, len(w)), lambda i: w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license') AS gpl
    FROM doc_words),
patterns (label, pattern) AS (VALUES
    ('apache-2.0', ' licensed under (the )?apache license (version )?2 0 '),
    ('bsd', ' redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met '),
    ('cc-by-4.0', ' licensed under (a )?(creative commons )?cc by 4 0 '),
    ('cc-by-nc-4.0', ' licensed under (a )?(creative commons )?cc by nc 4 0 '),
    ('gpl-2.0', ' licensed under the (gnu )?general public license (version )?2 '),
    ('gpl-3.0', ' licensed under the (gnu )?general public license (version )?3 '),
    ('gpl-later', ' under the terms of the (gnu )?general public license as published by the free software foundation either version ([^ ]+ ){1,2}of the license or at your option any later version '),
    ('isc', ' permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted '),
    ('mit-notice', ' released under (the terms of )?the mit license '),
    ('mit-text', ' permission is hereby granted free of charge to any person obtaining a copy of ([^ ]+ ){1,8}and associated documentation files '),
    ('mpl-2.0', ' subject to the terms of the mozilla public license (v )?(version )?2 0 ')),
more AS (
    SELECT doc_id, list(label) AS labels FROM starts JOIN patterns ON regexp_matches(line, pattern) GROUP BY doc_id),
based AS (
    SELECT *, list_concat(mit, apache, gpl) AS every,
        list_filter([CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END, CASE WHEN len(mit) > 0 THEN 'mit' END],
            lambda x: x IS NOT NULL) AS base
    FROM starts)
SELECT b.doc_id, len(w)::BIGINT AS n_words, len(every)::BIGINT AS n_base, list_min(every) AS first_word, list_max(every) AS last_word,
    array_to_string(base, ',') AS base_labels, array_to_string(list_sort(list_concat(base, coalesce(m.labels, []))), ',') AS labels,
    CASE WHEN m.labels IS NOT NULL THEN 1.0 WHEN len(every) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM based b LEFT JOIN more m USING (doc_id)
"""

ORACLE["op8_decontaminate"] = r"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS width, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS span
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item_words WHERE len(w) > 0)),
doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
widths AS (SELECT DISTINCT width FROM windows),
spans AS (
    SELECT doc_id, width, s, array_to_string(w[s:s + width - 1], ' ') AS span
    FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS s FROM doc_words, widths WHERE len(w) >= width)),
found AS (SELECT doc_id, s, width, item_id FROM spans JOIN windows USING (width, span)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + width)) AS p FROM found) GROUP BY doc_id),
owners AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

# The cheapest repair as a recursion over the rows of each conversation, with the least
# (cost, audit) of four output positions: nothing yet, after s, after u, after a.
ORACLE["op11_turn_repair"] = r"""
WITH RECURSIVE crc AS (
    SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r (i))),
hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
            lambda x: unicode(x)::BIGINT)), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 20 AS h
    FROM conversations, crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM (SELECT *, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS again FROM hashed WHERE h <> 0)),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS r,
        right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS tail
    FROM damaged),
faulty AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen, CASE WHEN tail = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        coalesce(lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r NOT IN ('su', 'ua', 'au'), false) AS illegal
    FROM ordered),
parsed AS (
    SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'a': ''} AS w0, {'c': 1000000, 'a': ''} AS ws, {'c': 5, 'a': 'I'} AS wu, {'c': 10, 'a': 'II'} AS wa
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, i, w0, ws, wu, CASE WHEN (wu.c + 5, wu.a || 'I') < (wa.c, wa.a) THEN {'c': wu.c + 5, 'a': wu.a || 'I'} ELSE wa END AS wa
    FROM (
        SELECT conv_id, i, w0, ws, list_min([wu, {'c': w0.c + 5, 'a': w0.a || 'I'}, {'c': ws.c + 5, 'a': ws.a || 'I'}, {'c': wa.c + 5, 'a': wa.a || 'I'}]) AS wu, wa
        FROM (
            SELECT p.conv_id, f.i,
                {'c': w0.c + 2, 'a': w0.a || 'D'} AS w0,
                list_min([{'c': ws.c + 2, 'a': ws.a || 'D'}, {'c': w0.c + keep_s, 'a': w0.a || 'K'}]) AS ws,
                list_min([{'c': wu.c + 2, 'a': wu.a || 'D'}, {'c': w0.c + keep_u, 'a': w0.a || 'K'}, {'c': ws.c + keep_u, 'a': ws.a || 'K'},
                    {'c': wa.c + keep_u, 'a': wa.a || 'K'}, {'c': w0.c + turned, 'a': w0.a || 'R'}, {'c': ws.c + turned, 'a': ws.a || 'R'},
                    {'c': wa.c + turned, 'a': wa.a || 'R'}]) AS wu,
                list_min([{'c': wa.c + 2, 'a': wa.a || 'D'}, {'c': wu.c + keep_a, 'a': wu.a || 'K'}, {'c': wu.c + turned, 'a': wu.a || 'R'}]) AS wa
            FROM parsed p JOIN (
                SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 WHEN fault = 'truncated' THEN 6 ELSE 1 END AS turned,
                    turned - 1 + CASE WHEN r = 's' THEN 0 ELSE 1000000 END AS keep_s, turned - 1 + CASE WHEN r = 'u' THEN 0 ELSE 1000000 END AS keep_u,
                    turned - 1 + CASE WHEN r = 'a' THEN 0 ELSE 1000000 END AS keep_a
                FROM faulty) f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1))),
ends AS (SELECT conv_id, arg_max(list_min([w0, wa]), i) AS w FROM parsed GROUP BY conv_id),
-- Edits one by one: which row each takes, and the role that the output needs there.
edits AS (
    SELECT conv_id, k, e, CASE WHEN e <> 'I' THEN count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY k) END AS i
    FROM (SELECT conv_id, unnest(range(1, len(w.a) + 1)) AS k, w.a[k] AS e FROM ends)),
kept AS (
    SELECT e.conv_id, e.k, e.e, f.role, f.text, f.r,
        row_number() OVER (PARTITION BY e.conv_id ORDER BY e.k) AS o,
        first_value(CASE WHEN e.e = 'K' AND f.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id ORDER BY e.k) AS system
    FROM edits e LEFT JOIN faulty f ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND e.i = f.i WHERE e.e <> 'D'),
texts AS (
    SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (o - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || coalesce(text, ''), chr(10) ORDER BY k)) AS digest FROM kept GROUP BY conv_id),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
    FROM faulty GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CASE WHEN c.gaps IS NULL THEN 0 ELSE e.w.c END::BIGINT AS cost,
    CASE WHEN c.gaps IS NULL THEN '' ELSE e.w.a END AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts t ON e.conv_id IS NOT DISTINCT FROM t.conv_id
"""

# Pieces, then words, then runs of one to three words of a piece, all by their place.
ORACLE["op13_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
    SELECT lang, len, array_to_string(w[s:s + len - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, len, unnest(range(1, len(w) - len + 2)) AS s FROM lists, (VALUES (1), (2), (3)) AS v (len) WHERE len(w) >= len)
    GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM runs WHERE len = 1 GROUP BY lang),
candidates AS (SELECT lang, len, phrase, f AS a, string_split(phrase, ' ') AS w FROM runs WHERE len > 1 AND f >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.len, c.w, c.a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, len)) AS k FROM candidates) c
    JOIN runs l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
    JOIN runs r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
scored AS (
    SELECT lang, phrase, len, w, a, l, r, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
absorbed AS (
    SELECT DISTINCT s.lang, s.phrase FROM scored s JOIN scored t ON t.lang = s.lang AND t.len = 3 AND s.len = 2
        AND (array_to_string(t.w[1:2], ' ') = s.phrase OR array_to_string(t.w[2:3], ' ') = s.phrase) AND 100 * t.a >= 50 * s.a)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score
FROM scored s JOIN totals USING (lang) LEFT JOIN absorbed b ON b.lang = s.lang AND b.phrase = s.phrase
WHERE b.phrase IS NULL QUALIFY rank <= 2000
"""
