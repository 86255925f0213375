"""Answers of the corpus operators in DuckDB's SQL, for those that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The template adds 12 characters of marks plus the role around a section and 7 between its texts.
# A control string inside a text grows by one character.
CHAT = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok'
    FROM range(2) t(i)
), seen AS (
    SELECT *, role IS DISTINCT FROM lag(role) OVER
        (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS opens,
        length(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '>', '%3E')) AS role_chars,
        length(text) + len(regexp_extract_all(text, '<\\*(turn:|/turn>|next/>)')) AS chars
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
        AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
        FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(chars + CASE WHEN opens THEN role_chars + 16 ELSE 7 END)::BIGINT AS formatted_chars
FROM seen GROUP BY conv_id
"""

# Ranks every document of a source by its Pareto key and takes a plain running sum.
MIXING = r"""
WITH docs AS (
    SELECT doc_id, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        (('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')))[1:13])::BIGINT + 0.5::DOUBLE)
            / 4503599627370496::DOUBLE AS u
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS weight
    FROM docs GROUP BY source
), levels AS (
    SELECT *, source_size * 2.0::DOUBLE AS most,
        ((SELECT sum(source_size) FROM sources)::DOUBLE * 1.5::DOUBLE
            - coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
), targets AS (
    SELECT source, source_size, least(most, max(level) OVER () * weight) AS target FROM levels
), plans AS (
    SELECT *, floor(target / greatest(source_size, 1)) AS whole,
        target / greatest(source_size, 1) - floor(target / greatest(source_size, 1)) AS p,
        target - floor(target / greatest(source_size, 1)) * source_size AS rest
    FROM targets
), ranked AS (
    SELECT doc_id, size, u, plans.*,
        sum(size) OVER (PARTITION BY docs.source
            ORDER BY (u / (1 - u)) / nullif(p / (1 - p), 0), u) AS upto
    FROM docs JOIN plans ON docs.source IS NOT DISTINCT FROM plans.source
)
SELECT doc_id, size, source_size, target,
    (size * (whole + CASE WHEN p > 0 AND upto - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked
"""

DECONTAMINATION = rf"""
WITH texts AS (
    SELECT 'd' AS kind, row_number() OVER () AS n, doc_id AS id, text FROM documents
    UNION ALL
    SELECT 'b', row_number() OVER (), item_id, text FROM benchmark
), worded AS (
    SELECT kind, n, id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM texts
), widths AS (
    SELECT DISTINCT least(len(words), 10) AS width FROM worded WHERE kind = 'b' AND len(words) > 0
), cut AS (
    SELECT kind, n, id, width, unnest(range(1, len(words) - width + 2)) AS pos, words
    FROM worded, widths
    WHERE len(words) >= width AND (kind = 'd' OR width = least(len(words), 10))
), windows AS (
    SELECT kind, n, id, width, pos, array_to_string(words[pos:pos + width - 1], ' ') AS span FROM cut
), hits AS (
    SELECT d.n, d.pos, d.width, b.id AS item, b.n AS item_n
    FROM windows d JOIN (SELECT DISTINCT id, n, width, span FROM windows WHERE kind = 'b') b
        ON d.span = b.span AND d.width = b.width
    WHERE d.kind = 'd'
), hit_words AS (
    SELECT n, count(DISTINCT word) AS n_hit
    FROM (SELECT n, unnest(range(pos, pos + width)) AS word FROM hits) GROUP BY n
), hit_items AS (
    SELECT n, count(DISTINCT item) AS n_items, string_agg(DISTINCT item::VARCHAR, ',' ORDER BY item::VARCHAR) AS items
    FROM hits GROUP BY n
)
SELECT id AS doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    n_hit IS NOT NULL AS contaminated
FROM worded LEFT JOIN hit_words USING (n) LEFT JOIN hit_items USING (n) WHERE kind = 'd'
"""

# Compares the runs as strings: the lines from each place up to the 50th word.
LINES = r"""
WITH cut AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS n, doc_id, string_split(text, chr(10)) AS lines
    FROM documents
), lines AS (
    SELECT n, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM cut
), worded AS (
    SELECT n, i, line, words, row_number() OVER (PARTITION BY n ORDER BY i) AS pos,
        sum(words) OVER (PARTITION BY n ORDER BY i) - words AS before
    FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines) WHERE words > 0
), runs AS (
    SELECT n, pos, before,
        count(*) OVER w AS length, max(before + words) OVER w AS upto,
        string_agg(line, chr(10)) OVER w AS run
    FROM worded
    WINDOW w AS (PARTITION BY n ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
), later AS (
    SELECT n, pos, length,
        row_number() OVER (PARTITION BY run ORDER BY n, pos) > 1 AS again
    FROM runs WHERE upto >= before + 50
), gone AS (
    SELECT DISTINCT n, unnest(range(pos, pos + length)) AS pos FROM later WHERE again
), flagged AS (
    SELECT lines.n, lines.i, line, words, gone.pos IS NOT NULL AS gone
    FROM lines LEFT JOIN (SELECT n, i, pos, words FROM worded) w USING (n, i)
        LEFT JOIN gone ON gone.n = lines.n AND gone.pos = w.pos
)
SELECT doc_id, coalesce(count(i), 0)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_deleted,
    coalesce(sum(words) FILTER (WHERE gone), 0)::BIGINT AS deleted_words,
    CASE WHEN any_value(lines) IS NOT NULL THEN
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) END AS text_sha256
FROM cut LEFT JOIN flagged USING (n) GROUP BY n, doc_id
"""

# Base32 by taking five bits at a time out of the bits of the digest.
WARC = r"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html,
        sha1(coalesce(html, '')) AS digest
    FROM pages
), bits AS (
    SELECT DISTINCT digest, array_to_string(list_transform(range(1, 41), lambda k:
        lpad(bin(('0x' || digest[k])::INT), 4, '0')), '') AS b
    FROM payloads
), coded AS (
    SELECT digest, array_to_string(list_transform(range(0, 32), lambda k:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
            list_sum(list_transform(range(1, 6), lambda j: b[5 * k + j]::INT * (1 << (5 - j)::INT)))::INT + 1]), '') AS code
    FROM bits
), keepers AS (
    SELECT *, max(page_id) OVER (PARTITION BY digest) AS keeper FROM payloads
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, code AS payload_digest,
    CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM keepers JOIN coded USING (digest)
"""

# CRC-32 by its definition: a table of what eight shifts make of a byte, then byte by byte.
_CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs
)"""


def _crc(text: str) -> str:
    """CRC-32 of a text of ASCII characters, where ``crcs`` is at hand."""
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), "
        "lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT)"
    )


def _add(value: str, cost: str, edit: str) -> str:
    """A value of the repair after one more edit."""
    return f"(lpad((({value})[1:9]::BIGINT + {cost})::VARCHAR, 9, '0') || ({value})[10:] || '{edit}')"


# The parser as four states of the role grammar: 0 nothing read, 1 an s, 2 a u to be answered, 3 a whole
# number of exchanges. A value is the cost in nine digits and the audit, so that the least text is it.
_USER, _ANSWER = "least(q0, q1, q3)", "q2"  # what a user's or an assistant's turn can follow
REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE}, damaged AS (
    SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
        CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
        FROM conversations, crc_table
    ), range(2) again(n)
    WHERE k <> 0 AND (n = 0 OR k = 3)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
    FROM damaged
), judged AS (
    SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial,
        CASE WHEN bare = '' THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
            WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), paired AS (
    SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM judged
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
        count(*) FILTER (WHERE fault = 'truncated') AS truncated,
        count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM paired GROUP BY conv_id
), steps AS (
    SELECT conv_id, pos, initial, fault IN ('blank', 'duplicate') AS gone,
        CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS cut
    FROM judged
), parsed AS (
    SELECT conv_id, 0::BIGINT AS pos, '000000000' AS q0, NULL::VARCHAR AS q1,
        '000000005I' AS q2, '000000010II' AS q3
    FROM counts
    UNION ALL
    SELECT conv_id, pos, q0, q1, q2, least(q3, {_add(_ANSWER, "5", "I")})
    FROM (
        SELECT conv_id, pos, q0, q1, least(q2, {_add(_USER, "5", "I")}) AS q2, q3
        FROM (
            SELECT p.conv_id, s.pos, {_add("q0", "2", "D")} AS q0,
                least({_add("q1", "2", "D")}, CASE WHEN NOT gone AND initial = 's' THEN {_add("q0", "cut", "K")} END) AS q1,
                least({_add("q2", "2", "D")}, CASE WHEN gone THEN NULL WHEN initial = 'u' THEN {_add(_USER, "cut", "K")}
                    ELSE {_add(_USER, "cut + 1", "R")} END) AS q2,
                least({_add("q3", "2", "D")}, CASE WHEN gone THEN NULL WHEN initial = 'a' THEN {_add(_ANSWER, "cut", "K")}
                    ELSE {_add(_ANSWER, "cut + 1", "R")} END) AS q3
            FROM parsed p JOIN steps s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.pos = p.pos + 1
        )
    )
), solved AS (
    SELECT c.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal,
        least(q0, q3)[1:9]::BIGINT AS cost, least(q0, q3)[10:] AS audit
    FROM counts c JOIN parsed p ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.pos
), letters AS (
    SELECT conv_id, i, audit[i] AS edit, length(replace(audit, 'D', '')) % 2 AS lead,
        i - length(replace(audit[1:i], 'I', '')) AS inserts
    FROM solved, LATERAL (SELECT unnest(range(1, length(audit) + 1)) AS i)
), kept AS (
    SELECT l.conv_id, l.i, l.edit, j.role, j.text, lead,
        row_number() OVER (PARTITION BY l.conv_id ORDER BY l.i) - 1 AS k
    FROM letters l LEFT JOIN judged j
        ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND l.edit <> 'I' AND j.pos = l.i - l.inserts
    WHERE l.edit <> 'D'
), lines AS (
    SELECT conv_id, string_agg(
        CASE edit WHEN 'K' THEN role WHEN 'R' THEN named ELSE named END || ':' ||
            CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS whole
    FROM (SELECT *, CASE (k + lead) % 2 WHEN 0 THEN 'user' ELSE 'assistant' END AS named FROM kept)
    GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN solved s ON a.conv_id IS NOT DISTINCT FROM s.conv_id
    LEFT JOIN lines l ON a.conv_id IS NOT DISTINCT FROM l.conv_id
"""

# Ranks the shingle hashes of both texts of each document in plain lists.
FINGERPRINTS = rf"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
        row_number() OVER (ORDER BY doc_id NULLS FIRST, coalesce(text, '')) AS pos, count(*) OVER () AS total
    FROM documents
), edited AS (
    SELECT a.pos, a.doc_id, a.n, a.text, a.text[1:a.n - a.n // 2] || left(b.text, a.n // 2) AS changed, a.pos % a.total + 1 AS after
    FROM docs a JOIN docs b ON b.pos = a.pos % a.total + 1
), worded AS (
    SELECT pos, kind, regexp_extract_all(translate(whole, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM (SELECT pos, 'own' AS kind, text AS whole FROM edited UNION ALL SELECT pos, 'edited', changed FROM edited)
), hashed AS (
    SELECT pos, kind, CASE WHEN len(words) > 0 THEN list_sort(list_distinct(list_transform(
        range(1, greatest(len(words) - 4, 1) + 1), lambda i: md5(array_to_string(words[i:i + 4], ' '))[1:16]))) ELSE [] END AS hashes
    FROM worded
), kept AS (
    SELECT pos, kind, CASE WHEN len(list_filter(hashes, lambda h: h < '2')) > 0
        THEN list_filter(hashes, lambda h: h < '2') ELSE hashes[1:1] END AS hashes
    FROM hashed
), joined AS (
    SELECT e.doc_id, e.n, e.changed, o.hashes AS own, c.hashes AS other, f.hashes AS ahead
    FROM edited e JOIN kept o ON o.pos = e.pos AND o.kind = 'own' JOIN kept c ON c.pos = e.pos AND c.kind = 'edited'
        JOIN kept f ON f.pos = e.after AND f.kind = 'own'
)
SELECT doc_id, n AS n_chars, sha256(changed) AS edited_sha256, array_to_string(own, '') AS fingerprint,
    array_to_string(other, '') AS edited_fingerprint,
    CASE WHEN len(own) = 0 THEN (len(other) = 0)::INT::DOUBLE ELSE len(list_intersect(own, other)) / len(own)::DOUBLE END AS near_edited,
    CASE WHEN len(own) = 0 THEN (len(ahead) = 0)::INT::DOUBLE ELSE len(list_intersect(own, ahead)) / len(own)::DOUBLE END AS near_next,
    len(own)::BIGINT AS n_hashes
FROM joined
"""

# Builds all nodes level by level, and walks each leaf up through them.
MERKLE = rf"""
WITH RECURSIVE {_CRC_TABLE}, leaves AS (
    SELECT *, sha256(list_aggregate(list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text],
            lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '')) AS leaf,
        sha256(list_aggregate(list_transform([doc_id::VARCHAR, source, lang,
            (n_chars + CASE WHEN {_crc("coalesce(doc_id::VARCHAR, '')")} % 7 = 0 THEN 1 ELSE 0 END)::VARCHAR, text],
            lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '')) AS shown
    FROM documents, crc_table
), placed AS (
    SELECT doc_id, leaf, shown, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS rank,
        count(*) OVER (PARTITION BY lang) AS n
    FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, rank AS pos, n, leaf AS digest FROM placed
    UNION ALL
    SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n
), subroots AS (
    SELECT tree, digest AS subroot FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, tree - 1 AS pos, (SELECT count(*) FROM subroots) AS n, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM tops WHERE n > 1 GROUP BY level, pos // 2, n
), whole AS (
    SELECT tree, level, pos, n, digest FROM nodes
    UNION ALL
    SELECT 0, level, pos, n, digest FROM tops
), paths AS (
    SELECT tree AS part, rank AS place, tree, 0 AS level, rank AS pos, n, '' AS proof, shown AS folded FROM placed
    UNION ALL
    SELECT part, place, CASE n WHEN 1 THEN 0 ELSE tree END, CASE n WHEN 1 THEN 0 ELSE level + 1 END,
        CASE n WHEN 1 THEN part - 1 ELSE pos // 2 END,
        CASE n WHEN 1 THEN (SELECT count(*) FROM subroots) ELSE (n + 1) // 2 END, proof || coalesce(other, ''),
        CASE WHEN n = 1 THEN folded
            ELSE sha256(CASE pos % 2 WHEN 1 THEN other || folded ELSE folded || coalesce(other, '') END) END
    FROM (
        SELECT p.*, w.digest AS other FROM paths p
            LEFT JOIN whole w ON w.tree = p.tree AND w.level = p.level AND w.pos = xor(p.pos, 1) AND p.n > 1
    )
    WHERE n > 1 OR tree > 0
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM paths JOIN placed ON placed.tree = part AND placed.rank = place JOIN subroots ON subroots.tree = part,
    (SELECT digest AS root FROM tops WHERE n = 1)
WHERE paths.tree = 0 AND paths.n = 1
"""

ORACLE: dict[str, str] = {
    "op4_chat_formatting": CHAT,
    "op5_source_mixing": MIXING,
    "op6_decontamination": DECONTAMINATION,
    "op7_line_dedup": LINES,
    "op9_warc_archive": WARC,
    "op11_conversation_repair": REPAIR,
    "op12_document_fingerprints": FINGERPRINTS,
    "op13_merkle_manifest": MERKLE,
}
