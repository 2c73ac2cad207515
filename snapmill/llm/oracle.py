"""SQL that computes the same rows as a query, where SQL can."""

#: Base32 of ``hex``, 160 bits: five hexadecimal digits are four base32 digits.
BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, {5 * group + 1}, 5))::INT >> {shift}) & 31), 1)"
    for group in range(8)
    for shift in (15, 10, 5, 0)
)

ORACLE: dict[str, str] = {
    "op4_substring_dedup": r"""
        WITH docs AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), windows AS (
            SELECT doc_id, s, array_to_string(words[s:s + 12], ' ') AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS s FROM docs WHERE len(words) >= 13)
        ), repeated AS (
            SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY w) AS first FROM windows)
            WHERE doc_id > first
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i FROM repeated
        ), words AS (
            SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs
        ), kept AS (
            SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS kept, count(*) AS n
            FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY words.doc_id
        )
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)
    """,
    "op5_warc": rf"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
        ), coded AS (
            SELECT page_id, strlen(payload) AS payload_bytes, hex,
                   {BASE32} AS payload_digest,
                   min(page_id) OVER (PARTITION BY hex) AS first
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM coded
    """,
    "op6_exact_dedup": r"""
        WITH normal AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), ranked AS (
            SELECT doc_id, text_sha256,
                   first_value(doc_id) OVER w AS keep_id,
                   row_number() OVER w = 1 AS kept,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM normal
            WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ranked
    """,
    "op11_fill_in_middle": r"""
        WITH numbers AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
            FROM documents
        ), drawn AS (
            SELECT *, len(units) AS n,
                   ('0x' || substr(hex, 1, 8))::BIGINT AS h1, ('0x' || substr(hex, 9, 8))::BIGINT AS h2,
                   ('0x' || substr(hex, 17, 8))::BIGINT AS h3, ('0x' || substr(hex, 25, 8))::BIGINT AS h4
            FROM numbers
        ), cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
                   CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), parts AS (
            SELECT doc_id, text, n, form, array_to_string(units[1:low], '') AS prefix,
                   array_to_string(units[low + 1:high], '') AS middle, array_to_string(units[high + 1:n], '') AS suffix
            FROM cut
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    "op12_line_dedup": r"""
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), lines AS (
            SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM split
        ), keyed AS (
            SELECT doc_id, line, i,
                   translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
            FROM lines
        ), judged AS (
            SELECT doc_id, line, i, length(line_key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY line_key) AS gone
            FROM keyed
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
}
