"""The same results as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

from ledgerloom.llm import secrets, warc


def _text(value: str) -> str:
    """A SQL string literal."""
    plain = value.replace("'", "''")
    for sign, code in (("\r", 13), ("\n", 10), ("\t", 9)):
        plain = plain.replace(sign, f"' || chr({code}) || '")
    return f"('{plain}')"


def _decoded(text: str) -> str:
    for name, character in warc.NAMED:
        text = f"replace({text}, {_text(name)}, {_text(character)})"
    return text


def _field(name: str, value: str) -> str:
    one_line = f"regexp_replace({value}, '[\\r\\n]+', ' ', 'g')"
    return f"coalesce({_text(name + ': ')} || {one_line} || {_text(warc.CRLF)}, '')"


def _identifier(parts: str) -> str:
    return (
        f"'<urn:uuid:' || regexp_replace(md5(concat_ws(chr(10), {parts})), "
        r"'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') || '>'"
    )


def warc_derivatives(date: str) -> str:
    plain = f"regexp_replace(payload, {_text(warc.HIDDEN)}, ' ', 'g')"
    plain = f"regexp_replace({plain}, {_text(warc.LINE_TAGS)}, chr(10), 'g')"
    plain = _decoded(f"regexp_replace({plain}, {_text(warc.OTHER_TAGS)}, '', 'g')")
    plain = f"regexp_replace({plain}, {_text(warc.BLANKS)}, ' ', 'g')"
    plain = f"trim(regexp_replace({plain}, {_text(warc.LINE_ENDS)}, chr(10), 'g'), ' ' || chr(10))"
    title = f"regexp_extract(payload, {_text(warc.TITLE)}, 1)"
    title = f"trim({_decoded(f'regexp_replace({title}, {_text(warc.BLANKS)}, chr(32), chr(103))')})"
    language = f"nullif(regexp_extract(payload, {_text(warc.LANGUAGE)}, 1), '')"
    links = (
        f"list_transform(regexp_extract_all(payload, {_text(warc.OUTLINK)}, 1), "
        f"lambda u: {_field('outlink', 'u')})"
    )
    fields = " || ".join(
        [
            _field("source-warc-block-digest", "source_digest"),
            _field("source-warc-payload-digest", "payload_digest"),
            _field("source-content-type", "'application/http; msgtype=response'"),
            _field("source-content-length", "CAST(strlen(source) AS VARCHAR)"),
            _field("http-status", "'200'"),
            _field("http-content-type", "'text/html; charset=utf-8'"),
            _field("language", language),
            _field("title", f"nullif({title}, '')"),
            f"array_to_string({links}, '')",
        ]
    )
    header = " || ".join(
        [
            _text("WARC/1.1" + warc.CRLF),
            _field("WARC-Type", "warc_type"),
            _field("WARC-Record-ID", "record_id"),
            _field("WARC-Refers-To", "refers_to"),
            _field("WARC-Target-URI", "target_uri"),
            _field("WARC-Date", f"'{date}'"),
            _field("WARC-Refers-To-Target-URI", "target_uri"),
            _field("WARC-Refers-To-Date", f"'{date}'"),
            _field("WARC-Block-Digest", "block_digest"),
            _field("Content-Type", "content_type"),
            _field("Content-Length", "CAST(content_length AS VARCHAR)"),
        ]
    )
    head = _text(
        f"HTTP/1.1 200 OK{warc.CRLF}Content-Type: text/html; charset=utf-8{warc.CRLF}"
        "Content-Length: "
    )
    return f"""
WITH stored AS (
  SELECT page_id, url, coalesce(html, '') AS payload,
    'sha256:' || sha256(coalesce(html, '')) AS payload_digest,
    {head} || CAST(strlen(coalesce(html, '')) AS VARCHAR) || {_text(warc.CRLF * 2)}
      || coalesce(html, '') AS source
  FROM pages
), responses AS (
  SELECT *, 'sha256:' || sha256(source) AS source_digest,
    {_identifier("page_id, url, payload_digest")} AS refers_to
  FROM stored
), blocks AS (
  SELECT page_id, url AS target_uri, refers_to, payload_digest, 'metadata' AS warc_type,
    'application/warc-fields' AS content_type, {fields} AS block
  FROM responses
  UNION ALL
  SELECT page_id, url, refers_to, payload_digest, 'conversion', 'text/plain; charset=utf-8', {plain}
  FROM responses
), records AS (
  SELECT *, {_identifier("refers_to, warc_type")} AS record_id,
    'sha256:' || sha256(block) AS block_digest,
    CAST(strlen(block) AS BIGINT) AS content_length
  FROM blocks
)
SELECT *, {header} AS header FROM records"""


TOP_K = """
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
  SELECT q.vec_id AS query_id, d.vec_id,
    CAST(list_inner_product(q.vector, d.vector) AS BIGINT) AS score,
    CAST(row_number() OVER (
      PARTITION BY q.row ORDER BY list_inner_product(q.vector, d.vector) DESC, d.vec_id
    ) AS INTEGER) AS rank
  FROM vectors q JOIN vectors d ON q.row <> d.row
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


def secret_scan() -> str:
    kinds = " UNION ALL ".join(
        f"""
  SELECT rid, '{rule.kind}' AS kind, {place} AS place, {rule.least} AS least,
    string_split_regex(text, {_text(rule.pattern)}) AS gaps,
    regexp_extract_all(text, {_text(rule.pattern)}, 0) AS matches,
    regexp_extract_all(text, {_text(rule.pattern)}, {rule.group}) AS judged
  FROM docs"""
        for place, rule in enumerate(secrets.RULES)
    )
    described = "kind || ':' || begin || ':' || finish"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), kinds AS ({kinds}
), pieces AS (
  SELECT rid, kind, place, least, i, length(gaps[i]) AS gap, length(matches[i]) AS own,
    length(judged[i]) AS size
  FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i FROM kinds)
), placed AS (
  SELECT *, CAST(sum(gap + own) OVER (PARTITION BY rid, kind ORDER BY i) AS BIGINT) AS finish
  FROM pieces
), spans AS (
  SELECT rid, kind, place, finish - own AS begin, finish FROM placed WHERE size >= least
), grouped AS (
  SELECT rid,
    count(*) FILTER (WHERE kind = 'assign') AS n_assign,
    count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg({described}, ',' ORDER BY begin, place)
      FILTER (WHERE place < {len(secrets.BASE)}) AS base,
    string_agg({described}, ',' ORDER BY begin, place) AS spans
  FROM spans GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM docs LEFT JOIN grouped USING (rid)"""


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS words FROM documents
), items AS (
  SELECT item_id, words, least(len(words), 13) AS n
  FROM (SELECT item_id, {_WORDS} AS words FROM benchmark) WHERE len(words) > 0
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[s : s + n - 1], ' ') AS text
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS s FROM items)
), doc_windows AS (
  SELECT rid, n, s, array_to_string(words[s : s + n - 1], ' ') AS text
  FROM (
    SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS s
    FROM docs CROSS JOIN (SELECT DISTINCT n FROM item_windows) WHERE len(words) >= n
  )
), found AS (
  SELECT d.rid, d.s, d.n, i.item_id FROM doc_windows d JOIN item_windows i USING (n, text)
), hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM found) GROUP BY rid
), named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (
    SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL
  ) GROUP BY rid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)"""


def collocations(least: int, longest: int, cover: int, top: int) -> str:
    """By definition: all phrases of all lengths, and every longer candidate looked through."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS piece, regexp_extract_all(part, '[^\x20\x09]+') AS w
    FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]'
        )) AS part
        FROM documents
    )
),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
    FROM starts, (SELECT unnest(range(1, {longest + 1})) AS k) AS sizes
    WHERE i + k - 1 <= len(w)
    GROUP BY ALL
),
sizes AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM grams WHERE k > 1 AND f >= {least}),
kept AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (
        FROM candidates g WHERE g.lang = c.lang AND g.k > c.k AND 100 * g.f >= {cover} * c.f
        AND contains(' ' || g.phrase || ' ', ' ' || c.phrase || ' ')
    )
),
cuts AS (
    SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut
    FROM kept
),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, n,
        (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c
    JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.cut], ' ')
    JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1 :], ' ')
    JOIN sizes s ON s.lang = c.lang
),
lowest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (
        PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)
    ) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
    CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM lowest QUALIFY rank <= {top}
"""
