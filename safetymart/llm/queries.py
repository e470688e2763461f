"""The queries ``opN_<name>``: each operator over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from safetymart.llm.common import crc_of_id, read_table, stored
from safetymart.llm.conversations import damaged, repair
from safetymart.llm.decontaminate import find_leaks
from safetymart.llm.exact_dedup import duplicate_groups
from safetymart.llm.html_extract import extract_text
from safetymart.llm.langid import fit, predict
from safetymart.llm.lexical_search import search
from safetymart.llm.minhash import near_duplicates
from safetymart.llm.packing import pack
from safetymart.llm.ppm import score_texts
from safetymart.llm.sharding import assign_shards
from safetymart.llm.suffix_dedup import remove_repeats
from safetymart.llm.vectors import near_vectors
from safetymart.llm.warc import audit, record_digests, warc_records

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text", *more)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that stand in 10-word windows of benchmark items."""
    found = find_leaks(
        _documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"), window=10
    )
    ids = F.array_sort(F.transform("leak.items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "leak.n_words",
        "leak.n_hit",
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equally many rows, equal texts together."""
    return assign_shards(_documents(spark, sf_dir), shards=40)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as sequences of at most 2,048 tokens."""
    return pack(_documents(spark, sf_dir), size=2048, with_ids=False).drop("ids")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without 400-byte strings that stand anywhere else too."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(_documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles agree in 85 of 100 or more."""
    return near_duplicates(_documents(spark, sf_dir), width=3, percent=85)


def op6_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences between archives of all pages and a replica with planted faults.

    The replica lost the records whose digest starts with ``00`` or ``01``, and
    those with ``02`` to ``05`` were altered.
    """
    records = record_digests(warc_records(read_table(spark, sf_dir, "pages")))
    records = stored(records, "records")
    first = F.left("digest", F.lit(2))
    altered = F.when(first <= "05", F.sha2("digest", 256)).otherwise(F.col("digest"))
    replica = records.filter(first > "01").withColumn("digest", altered)
    return audit(records, stored(replica, "replica"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from four of five folds."""
    docs = _documents(spark, sf_dir, "lang")
    held_out = crc_of_id(F.col("doc_id")) % 5 == 0
    model = fit(docs, F.when(~held_out, F.col("lang")))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score"
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all documents, learnt from nine of ten folds."""
    held_out = crc_of_id(F.col("doc_id")) % 10 == 0
    docs = _documents(spark, sf_dir).withColumn("held_out", held_out)
    return score_texts(docs, "held_out")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.col("main_text")
    return extract_text(pages).select(
        "page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars")
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document the row of equal text that stays."""
    return duplicate_groups(_documents(spark, sf_dir))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of embeddings with cosines of 0.95 or more."""
    return near_vectors(read_table(spark, sf_dir, "embeddings"), cosine=0.95)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for each benchmark item."""
    return search(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of all conversations after planted damage."""
    return repair(damaged(read_table(spark, sf_dir, "conversations")), copies="copies")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_sharding,
        op3_packing,
        op4_suffix_dedup,
        op5_minhash,
        op6_warc_audit,
        op7_language_id,
        op8_lm_scoring,
        op9_html_extraction,
        op10_exact_dedup,
        op11_embedding_dedup,
        op12_lexical_search,
        op13_conversation_repair,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (
    "regexp_extract_all(" + _LOWER.format("coalesce(text, '')")
    + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

_TERMS = (
    "regexp_extract_all(" + _LOWER.format("coalesce(text, '')")
    + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (
  SELECT item_id, w, least(10, len(w)) AS k
  FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS g
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM items)
),
places AS (
  SELECT doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') AS g
  FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
    FROM docs, (SELECT DISTINCT k FROM items) WHERE len(w) >= k
  )
),
found AS (SELECT doc_id, p, k, item_id FROM places JOIN windows USING (k, g)),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n FROM (
    SELECT doc_id, unnest(range(p, p + k)) AS word FROM (SELECT DISTINCT doc_id, p, k FROM found)
  ) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op6_warc_audit": """
WITH pages_ AS (
  SELECT page_id, page_id // 1000 AS archive,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
),
records AS (
  SELECT archive, strlen(record) AS length, sha256(record) AS digest,
    sum(strlen(record)) OVER (PARTITION BY archive ORDER BY page_id, record) - strlen(record) AS start
  FROM pages_
)
SELECT archive, CAST(start AS BIGINT) AS "offset", length AS left_length,
  CASE WHEN digest > '02' THEN length END AS right_length, digest AS left_digest,
  CASE WHEN digest > '02' THEN sha256(digest) END AS right_digest,
  CASE WHEN digest > '02' THEN 'changed' ELSE 'missing' END AS status
FROM records WHERE digest < '06'
""",
    "op10_exact_dedup": r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
),
best AS (
  SELECT doc_id, content,
    first_value(doc_id) OVER (PARTITION BY content ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size
  FROM rows
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
FROM best
""",
    "op11_embedding_dedup": """
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
valid AS (
  SELECT * FROM rows
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_max(list_transform(v, lambda x: abs(x))) > 0
),
pairs AS (
  SELECT a.r AS p, b.r AS q FROM valid a JOIN valid b ON a.r < b.r
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
),
links AS (SELECT p, q FROM pairs UNION ALL SELECT q, p FROM pairs),
reached AS (
  SELECT r, r AS other FROM rows
  UNION
  SELECT reached.r, q FROM reached JOIN links ON other = p
),
named AS (
  SELECT reached.r, min(o.vec_id) AS component_id
  FROM reached JOIN rows o ON o.r = other GROUP BY reached.r
),
counted AS (SELECT p AS r, count(*) AS n FROM links GROUP BY p)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id,
  vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows LEFT JOIN counted USING (r) JOIN named USING (r)
""",
    "op12_lexical_search": r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, TERMS AS t FROM documents),
items AS (
  SELECT i, item_id, unnest(t) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, TERMS AS t FROM benchmark)
),
asked AS (SELECT i, item_id, term, count(*) AS times FROM items GROUP BY ALL),
size AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM docs WHERE len(t) > 0),
counts AS (
  SELECT r, term, count(*)::BIGINT AS tf
  FROM (SELECT r, unnest(t) AS term FROM docs) SEMI JOIN asked USING (term) GROUP BY ALL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, size GROUP BY term, n_docs
),
parts AS (
  SELECT r, doc_id, 25 + (75 * len(t)::BIGINT * n_docs) // n_terms AS m FROM docs, size WHERE len(t) > 0
),
scores AS (
  SELECT i, item_id, r, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN parts USING (r)
  GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank,
  doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10
""".replace("TERMS", _TERMS),
    "op13_conversation_repair": r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
),
summed AS (  -- crc32, bit by bit
  SELECT *, xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS fault
  FROM keyed
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM summed, range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM damaged
),
seen AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
),
faulty AS (
  SELECT *, body = '' AS blank, body <> '' AND again AS duplicate,
    body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated
  FROM seen
),
inserts(p, n, mid, roles) AS (  -- p: 0 start, 1 after s, 2 after u, 3 after a
  VALUES (0, '', 0, ''), (0, 'I', 2, 'u'), (0, 'II', 3, 'ua'), (1, '', 1, ''), (1, 'I', 2, 'u'),
    (1, 'II', 3, 'ua'), (2, '', 2, ''), (2, 'I', 3, 'a'), (3, '', 3, ''), (3, 'I', 2, 'u')
),
edits(mid, e, w, initial, q) AS (
  VALUES (0, 'D', 3, NULL, 0), (1, 'D', 3, NULL, 1), (2, 'D', 3, NULL, 2), (3, 'D', 3, NULL, 3),
    (0, 'K', 0, 's', 1), (0, 'K', 0, 'u', 2), (1, 'K', 0, 'u', 2), (2, 'K', 0, 'a', 3),
    (3, 'K', 0, 'u', 2), (0, 'R', 2, NULL, 2), (1, 'R', 2, NULL, 2), (2, 'R', 2, NULL, 3),
    (3, 'R', 2, NULL, 2)
),
steps AS (
  SELECT p, q, n || e AS letters, 2 * length(n) + w AS w, e, initial,
    CASE roles WHEN 'u' THEN chr(10) || 'user:' WHEN 'a' THEN chr(10) || 'assistant:'
      WHEN 'ua' THEN chr(10) || 'user:' || chr(10) || 'assistant:' ELSE '' END AS lines
  FROM inserts JOIN edits USING (mid)
),
ways AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit, '' AS lines
  FROM damaged
  UNION ALL
  SELECT conv_id, i, q, min(cost) AS cost, min_by(audit, (cost, audit)) AS audit,
    min_by(lines, (cost, audit)) AS lines
  FROM (
    SELECT f.conv_id, f.i, s.q, cost + w + CASE WHEN e <> 'D' AND truncated THEN 1 ELSE 0 END AS cost,
      audit || letters AS audit,
      ways.lines || s.lines || CASE e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text
        ELSE chr(10) || CASE s.q WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || text END AS lines
    FROM ways JOIN steps s ON s.p = ways.q
      JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM ways.conv_id AND f.i = ways.i + 1
    WHERE (e = 'D' OR NOT blank AND NOT duplicate) AND (e <> 'K' OR f.initial = s.initial)
  ) GROUP BY conv_id, i, q
),
ends AS (
  SELECT ways.conv_id, i, cost + 2 * length(n) AS cost, audit || n AS audit,
    lines || CASE roles WHEN 'a' THEN chr(10) || 'assistant:'
      WHEN 'ua' THEN chr(10) || 'user:' || chr(10) || 'assistant:' ELSE '' END AS lines
  FROM ways JOIN inserts ON p = ways.q WHERE mid IN (0, 3)
),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
),
repaired AS (
  SELECT e.conv_id, min(cost) AS cost, min_by(audit, (cost, audit)) AS audit,
    min_by(lines, (cost, audit)) AS lines
  FROM ends e JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.i = c.n
  GROUP BY e.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(lines[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
  LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN repaired r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
""",
}
