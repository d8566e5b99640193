"""One query for each operator of this subpackage, over its whole table, and SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.llm import decontamination, embedding_links, filter_audit, main_text, near_duplicates, packing, phrases, quality, repeats, secret_scan, token_shards, toxicity, url_rules
from tallyforge.llm.common import table

URL_RULES = [
    url_rules.Rule("block", "net"),
    url_rules.Rule("allow", "example.net", "/en/"),
    url_rules.Rule("block", "example.com", "/de/"),
    url_rules.Rule("allow", "org", "/fr/"),
]


def op1_html_extraction(spark, folder):
    return main_text.extract_main_text(table(spark, folder, "pages"))


def op2_decontamination(spark, folder):
    return decontamination.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_embedding_near_dedup(spark, folder):
    return embedding_links.link_embeddings(table(spark, folder, "embeddings"))


PASSING = 0.3


def op4_quality(spark, folder):
    docs = table(spark, folder, "documents")
    model = quality.learn_quality(docs, table(spark, folder, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        quality.in_fold("doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= PASSING).cast("int").alias("predicted"),
    )


def op5_url_filter(spark, folder):
    return url_rules.judge_urls(table(spark, folder, "pages"), URL_RULES)


def op6_packing(spark, folder):
    pieces = packing.pack_documents(table(spark, folder, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_suffix_array_dedup(spark, folder):
    found = repeats.find_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        repeats.removed_bytes().alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    index = toxicity.learn_toxicity(docs, table(spark, folder, "labels"))
    return toxicity.score_toxicity(docs, index).select(
        "doc_id",
        quality.in_fold("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= PASSING).cast("int").alias("predicted"),
        "evidence",
    )


def op9_minhash_near_dedup(spark, folder):
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


def op10_token_shards(spark, folder):
    ordered = token_shards.in_training_order(table(spark, folder, "documents"))
    return ordered.select(
        "slot", "shard", "byte_offset", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.col("docs").alias("doc_ids")
    )


def op11_filter_audit(spark, folder):
    return filter_audit.audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_secret_scan(spark, folder):
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *(F.size(secret_scan.of_kinds((k,))).cast("long").alias(f"n_{k}") for k in secret_scan.BASE),
        F.sha2(secret_scan.listed(secret_scan.of_kinds(secret_scan.BASE)), 256).alias("base_sha256"),
        secret_scan.listed("spans").alias("spans"),
    )


def op13_phrase_mining(spark, folder):
    return phrases.mine_phrases(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_decontamination,
        op3_embedding_near_dedup,
        op4_quality,
        op5_url_filter,
        op6_packing,
        op7_suffix_array_dedup,
        op8_toxicity,
        op9_minhash_near_dedup,
        op10_token_shards,
        op11_filter_audit,
        op12_secret_scan,
        op13_phrase_mining,
    )
}

def _spans_sql(order: int, kind: str, pattern: str, kept: str = "true") -> str:
    """Spans of one kind: a match begins behind all matches before it and all text between them."""
    return f"""
        SELECT doc_id, {order} AS kind_no, '{kind}' AS kind, pos AS start, pos + length(m) AS stop
        FROM (SELECT doc_id, ms[i] AS m, (list_sum(list_transform(ps[1:i], lambda x: length(x)))
                     + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS pos
              FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i
                    FROM (SELECT doc_id, regexp_extract_all(t, $${pattern}$$) AS ms, regexp_split_to_array(t, $${pattern}$$) AS ps
                          FROM docs)))
        WHERE {kept}"""


def _folded(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join([*map(_folded, ("password", "passwd", "secret", "token")), f"{_folded('api')}_?{_folded('key')}"])
_ASSIGN = rf"""(?:{_KEYWORDS})["']?\x20*[:=]\x20*["']?"""
_SECRETS = " UNION ALL ".join([
    _spans_sql(0, "assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", f"regexp_full_match(m, $${_ASSIGN}[A-Za-z0-9+/_.=-]{{6,}}$$)"),
    _spans_sql(1, "access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    _spans_sql(2, "hex", "[0-9a-f]{24,}"),
    _spans_sql(3, "github", "gh[pousr]_[A-Za-z0-9]+", "length(m) >= 40"),
    _spans_sql(4, "slack", "xox[abprs]-[A-Za-z0-9-]+", "length(m) >= 15"),
    _spans_sql(5, "jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    _spans_sql(6, "private_key", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
])

_HOST = r"""translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
_PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"

SQL = {
    "op5_url_filter": f"""
        WITH split AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
        judged AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
            END AS rule FROM split)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM judged""",
    "op11_filter_audit": r"""
        WITH docs AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS txt,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
            FROM documents),
        firsts AS (SELECT txt, min(doc_id) AS least FROM docs GROUP BY txt),
        flags AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        failed AS (
            SELECT d.part, coalesce(g.good, 0) AS good, coalesce(g.toxic, 0) AS toxic,
                   CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END AS a,
                   CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 1 ELSE 0 END AS b,
                   CASE WHEN 100 * length(regexp_replace(d.txt, '[^A-Z]', '', 'g')) > 2 * length(d.txt) THEN 1 ELSE 0 END AS c,
                   CASE WHEN regexp_matches(d.txt, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
                   CASE WHEN f.least < d.doc_id THEN 1 ELSE 0 END AS e
            FROM docs d JOIN firsts f ON d.txt = f.txt LEFT JOIN flags g ON d.doc_id = g.doc_id),
        cells AS (
            SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS fails, a + b + c + d + e AS k,
                   count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
            FROM failed GROUP BY ALL),
        letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        orders AS (
            SELECT [p.f, q.f, r.f, s.f, t.f] AS fs, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
            FROM letters p, letters q, letters r, letters s, letters t
            WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND (p.bit | q.bit | r.bit | s.bit | t.bit) = 31),
        steps AS (
            SELECT array_to_string(fs, '') AS filter_order, i AS step, bits[i] AS own,
                   coalesce(list_sum(bits[1:i - 1]), 0) AS before
            FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS i))
        SELECT part, filter_order, step::INT AS step,
               sum(CASE WHEN fails & (before + own)::INT = 0 THEN n ELSE 0 END)::BIGINT AS kept,
               sum(CASE WHEN fails & before::INT = 0 AND fails & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
               sum(CASE WHEN fails & before::INT <> 0 AND fails & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
               sum(CASE WHEN fails = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
               sum(CASE WHEN fails & before::INT = 0 AND fails & own <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
               sum(CASE WHEN fails & before::INT = 0 AND fails & own <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
               sum(CASE WHEN fails & own <> 0 THEN n * 120 // k ELSE 0 END)::BIGINT AS shapley
        FROM cells, steps GROUP BY part, filter_order, step""",
    "op12_secret_scan": f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        spans AS ({_SECRETS}),
        told AS (
            SELECT doc_id, count(*) FILTER (kind_no = 0) AS n_assign, count(*) FILTER (kind_no = 1) AS n_access,
                   count(*) FILTER (kind_no = 2) AS n_hex,
                   string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) FILTER (kind_no < 3) AS base,
                   string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) AS spans
            FROM spans GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN told USING (doc_id)""",
    "op13_phrase_mining": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
        grams AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded), (SELECT unnest([1, 2, 3, 4, 5]) AS k)
            WHERE i + k - 1 <= len(w)),
        counts AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
        candidates AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
        cuts AS (
            SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS tail
            FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates)),
        scored AS (
            SELECT u.lang, u.phrase, u.a, c, x.f AS l, y.f AS r, n,
                   ((1000::HUGEINT * u.a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts u JOIN counts x ON u.lang = x.lang AND u.head = x.phrase
                        JOIN counts y ON u.lang = y.lang AND u.tail = y.phrase JOIN totals t ON u.lang = t.lang),
        lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS o FROM scored) WHERE o = 1),
        inner_ AS (
            SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
            FROM (SELECT *, unnest(range(1, k)) AS i FROM candidates), (SELECT unnest([2, 3, 4]) AS m)
            WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
        kept AS (
            SELECT s.* FROM lowest s LEFT JOIN inner_ i ON s.lang = i.lang AND s.phrase = i.phrase
            WHERE longer IS NULL OR longer < a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
}
