"""SQL for DuckDB of the Merkle manifest, the repeated passages and the spelling variants, written from their definitions."""

# CRC-32 from its polynomial; `t` is the table of its 256 steps.
CRC_TABLE = """
        crc_table AS (
            SELECT list(v ORDER BY n) AS t
            FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                  FROM range(256) r(n)))"""

MERKLE = f"""
        WITH RECURSIVE {CRC_TABLE.strip()},
        crcs AS (
            SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                                           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc
            FROM (SELECT DISTINCT doc_id FROM documents) d, crc_table),
        both_texts AS (
            SELECT d.doc_id, source, lang, n_chars, text, CASE WHEN crc % 5 = 0
                   THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS tampered
            FROM documents d JOIN crcs USING (doc_id)),
        fields AS (
            SELECT doc_id, source, tampered, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
            FROM both_texts),
        hashed AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(strlen(tampered) || ':' || tampered, '-')) AS folded
            FROM fields),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM hashed),
        tree AS (
            SELECT source, 0 AS level, pos, n, leaf AS h FROM leaves
            UNION ALL
            SELECT source, level + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
            FROM tree WHERE n > 1 GROUP BY source, level, pos // 16),
        subroots AS (
            SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
        top AS (
            SELECT 0 AS level, pos, n, subroot AS h FROM subroots
            UNION ALL
            SELECT level + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 16),
        runs AS (SELECT source, level, pos // 16 AS run, list(h ORDER BY pos) AS kids FROM tree WHERE n > 1 GROUP BY ALL),
        top_runs AS (SELECT level, pos // 16 AS run, list(h ORDER BY pos) AS kids FROM top WHERE n > 1 GROUP BY ALL),
        climb AS (
            SELECT doc_id, leaf, source, 0 AS level, pos, n, folded AS h, '' AS proof FROM leaves
            UNION ALL
            SELECT doc_id, leaf, c.source, c.level + 1, pos // 16, (n + 15) // 16,
                   sha256(array_to_string(list_concat(kids[:pos % 16], [h], kids[pos % 16 + 2:]), '')),
                   proof || array_to_string(list_concat(kids[:pos % 16], kids[pos % 16 + 2:]), '')
            FROM climb c JOIN runs r ON c.source IS NOT DISTINCT FROM r.source AND c.level = r.level AND c.pos // 16 = r.run WHERE c.n > 1),
        climb_on AS (
            SELECT doc_id, leaf, subroot, 0 AS level, s.pos, s.n, h, proof
            FROM climb c JOIN subroots s ON c.source IS NOT DISTINCT FROM s.source WHERE c.n = 1
            UNION ALL
            SELECT doc_id, leaf, subroot, c.level + 1, pos // 16, (n + 15) // 16,
                   sha256(array_to_string(list_concat(kids[:pos % 16], [h], kids[pos % 16 + 2:]), '')),
                   proof || array_to_string(list_concat(kids[:pos % 16], kids[pos % 16 + 2:]), '')
            FROM climb_on c JOIN top_runs r ON c.level = r.level AND c.pos // 16 = r.run WHERE c.n > 1)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
        FROM climb_on, (SELECT h AS root FROM top WHERE n = 1) WHERE n = 1"""

REPEATED_PASSAGES = """
        WITH RECURSIVE docs AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
        blocks AS (
            SELECT doc_id, 1000 * j AS base, substr(x, 2000 * j + 1, 2198) AS block
            FROM (SELECT doc_id, x, unnest(range((length(x) // 2 + 900) // 1000)) AS j FROM docs)),
        windows AS (
            SELECT doc_id, base + i AS p, md5_number(substr(block, 2 * i + 1, 200)) AS k
            FROM (SELECT *, unnest(range(least(length(block) // 2 - 99, 1000))) AS i FROM blocks)),
        later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM windows) WHERE nth > 1),
        marked AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER w <= 100 THEN 0 ELSE 1 END AS new FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
        runs AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
        spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM runs GROUP BY doc_id, run),
        gaps AS (
            SELECT s.doc_id, a, b, substr(x, 2 * coalesce(lag(b) OVER w, 0) + 1, 2 * (a - coalesce(lag(b) OVER w, 0))) AS piece, x
            FROM spans s JOIN docs USING (doc_id) WINDOW w AS (PARTITION BY s.doc_id ORDER BY a)),
        kept AS (
            SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(piece, '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS rest
            FROM gaps GROUP BY doc_id)
        SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, x))) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)"""

SPELLING = f"""
        WITH RECURSIVE {CRC_TABLE.strip()},
        runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
            FROM documents),
        counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
        crcs AS (
            SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(hexed) // 2 + 1), lambda i: ('0x' || substr(hexed, 2 * i - 1, 2))::BIGINT)),
                                           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
            FROM (SELECT *, hex(encode(doc_id || ':' || run)) AS hexed FROM counted) d, crc_table),
        words AS (
            SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, sum(n)::BIGINT AS n
            FROM crcs GROUP BY 1 HAVING sum(n) >= 2 AND length(word) >= 7),
        cuts AS (SELECT word, n, unnest(list_distinct(list_transform(range(1, length(word) + 1), lambda i: substr(word, 1, i - 1) || substr(word, i + 1)))) AS cut FROM words),
        near AS (
            SELECT a.word, b.word AS other, b.n FROM cuts a JOIN words b ON a.cut = b.word
            UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word
            UNION SELECT a.word, b.word, b.n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.word <> b.word AND length(a.word) = length(b.word)
                  WHERE list_sum(list_transform(range(1, length(a.word) + 1), lambda i: (substr(a.word, i, 1) <> substr(b.word, i, 1))::INT)) = 1),
        best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
        named AS (SELECT b.word, n_near, most, min(other) AS other FROM best b JOIN near r ON b.word = r.word AND b.most = r.n GROUP BY ALL),
        found AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN other END AS form, CASE WHEN most >= 10 * w.n THEN most END AS form_n
            FROM words w LEFT JOIN named USING (word)),
        climb AS (
            SELECT word, word AS root FROM found
            UNION ALL SELECT c.word, f.form FROM climb c JOIN found f ON c.root = f.word WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
        FROM found f JOIN climb c ON f.word = c.word JOIN found e ON c.root = e.word WHERE e.form IS NULL"""
