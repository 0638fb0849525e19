"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import conversations, decontaminate, extract, interaction, jaccard, licenses, packing, pieces, quality, suffixes, toxicity, urls
from tablewright.llm.fingerprint import fingerprints
from tablewright.workload.tables import Query, table


def _fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(table(spark, folder, "documents"))


# A parameter of the deployment; the file is read on the driver and never copied.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def _tokens(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode(documents, pieces.Vocabulary.load(TOKENIZER))


def _decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(table(spark, folder, "documents"))


def _suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.removals(table(spark, folder, "documents"))


def held_out(folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold; a row without an id does not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


RULES = [urls.Rule("net/", False), urls.Rule("example.net/en/", True), urls.Rule("example.com/de/", False), urls.Rule("org/fr/", True)]


def _urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), RULES)


# Host, path, rule and links as the library reads them, but for segments . and .. of relative targets and
# for character references other than &amp;; components by repeated joins from both ends.
_URLS_SQL = r"""
    WITH RECURSIVE parts AS (
        SELECT page_id, url, html,
            translate(coalesce(regexp_extract(url, '(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?', 2), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?', 3), '') AS path,
            coalesce(regexp_extract(url, '(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?', 4), '') AS query,
            regexp_extract(url, '(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?', 1) AS scheme
        FROM pages
    ), markup AS (
        SELECT host || path || query AS a, scheme, host, path, regexp_replace(html, '__NO_MARKUP__', '', 'g') AS html
        FROM parts WHERE host <> ''
    ), tags AS (
        SELECT * EXCLUDE html, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)[\s/][^<>=]*(?:=\s*(?:"[^"<]*"|''[^''<]*''|[^\s<>"''][^\s<>]*|)[^<>=]*){0,64}>')) AS tag
        FROM markup
    ), attributes AS (
        SELECT * EXCLUDE tag, lower(regexp_extract(tag, '^<([a-zA-Z]+)', 1)) AS kind, list_transform(
            regexp_extract_all(regexp_replace(tag, '^<[a-zA-Z]+|>$', '', 'g'), '__ATTRIBUTE__'),
            lambda x: {'name': lower(regexp_extract(x, '__ATTRIBUTE__', 1)), 'value': regexp_extract(x, '__ATTRIBUTE__', 2) || regexp_extract(x, '__ATTRIBUTE__', 3) || regexp_extract(x, '__ATTRIBUTE__', 4)}
        ) AS own
        FROM tags
    ), found AS (
        SELECT a, scheme, host, path, kind, list_filter(own, lambda x: x.name = 'rel')[1].value AS rel, list_filter(own, lambda x: x.name = 'href')[1].value AS href,
            list_filter(own, lambda x: x.name = 'http-equiv')[1].value AS equiv, list_filter(own, lambda x: x.name = 'content')[1].value AS content
        FROM attributes
    ), raw AS (
        SELECT a, scheme, host, path, replace(trim(translate(CASE WHEN kind = 'link' THEN href
            ELSE regexp_extract(content, '__REFRESH__', 1) || regexp_extract(content, '__REFRESH__', 2) || regexp_extract(content, '__REFRESH__', 3) END, chr(9) || chr(10) || chr(12) || chr(13), '')), '&amp;', '&') AS target
        FROM found
        WHERE CASE WHEN kind = 'link' THEN list_contains(regexp_split_to_array(lower(rel), '\s+'), 'canonical') ELSE lower(trim(equiv)) = 'refresh' END
    ), resolved AS (
        SELECT a, CASE WHEN regexp_matches(target, '^[a-zA-Z][a-zA-Z0-9+.\-]*:') THEN target
            WHEN starts_with(target, '//') THEN scheme || ':' || target
            WHEN starts_with(target, '/') THEN scheme || '://' || host || target
            WHEN starts_with(target, '?') THEN scheme || '://' || host || path || target
            WHEN NOT starts_with(target, '#') THEN scheme || '://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '(?s)^(.*/)', 1) END || target END AS target
        FROM raw WHERE target <> ''
    ), links AS (
        SELECT a, translate(regexp_extract(target, '(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?', 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            || regexp_extract(target, '(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?', 3) || regexp_extract(target, '(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?', 4) AS b
        FROM resolved WHERE regexp_extract(target, '(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?', 2) <> ''
    ), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (
        SELECT a, b FROM both_ways
        UNION
        SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
    ), nodes AS (
        SELECT node, regexp_extract('x://' || node, '(?s)^(.*?)://([^/?#]*)([^?#]*)', 2) AS host, regexp_extract('x://' || node, '(?s)^(.*?)://([^/?#]*)([^?#]*)', 3) AS path
        FROM (SELECT DISTINCT b AS node FROM reach)
    ), judged AS (
        SELECT node, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN true
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN false
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN true
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN false END AS own
        FROM nodes
    ), inherited AS (SELECT r.a AS node, bool_or(own) AS allowed FROM reach r JOIN judged j ON r.b = j.node WHERE own IS NOT NULL GROUP BY r.a),
    ruled AS (
        SELECT page_id, host, path, host || path || query AS node,
            CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
        FROM parts
    )
    SELECT page_id, host, path, rule,
        CASE WHEN coalesce(CASE rule WHEN 'example.net/en/' THEN true WHEN 'org/fr/' THEN true WHEN 'net/' THEN false WHEN 'example.com/de/' THEN false END, allowed, true)
            THEN 'allow' ELSE 'block' END AS verdict
    FROM ruled LEFT JOIN inherited USING (node)"""
for _name in ("NO_MARKUP", "ATTRIBUTE", "REFRESH"):
    _URLS_SQL = _URLS_SQL.replace(f"__{_name}__", getattr(urls, _name).replace("'", "''"))


def _licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Exact containment of every template in every document: what retrieval by bands must find.
_LICENSES_SQL = f"""
    WITH templates(template, t) AS (VALUES {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in licenses.TEMPLATES.items())}),
    cut AS (
        SELECT template, NULL AS doc_id, t FROM templates UNION ALL SELECT NULL, doc_id, text FROM documents
    ), words AS (
        SELECT template, doc_id, string_split(trim(regexp_replace(translate(coalesce(t, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM cut
    ), sets AS (
        SELECT template, doc_id, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS h FROM words
    ), matches AS (
        SELECT d.doc_id, m.template, len(m.h) AS n_shingles, len(list_intersect(m.h, d.h)) AS n_found
        FROM sets d, sets m WHERE d.template IS NULL AND m.template IS NOT NULL
    )
    SELECT doc_id, template, CAST(n_shingles AS INTEGER) AS n_shingles, CAST(max(n_found) AS INTEGER) AS n_found FROM matches WHERE n_found >= {licenses.CONTAINED} * n_shingles
    GROUP BY doc_id, template, n_shingles"""


def _main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(table(spark, folder, "pages").select("page_id", "url", "html"))


TOXIC_FOLDS, TOXIC_HELD, TOXIC_FROM = 3, 1, 0.7
QUALITY_FOLDS, QUALITY_HELD, QUALITY_FROM = 5, 0, 0.3


def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = held_out(TOXIC_FOLDS, TOXIC_HELD)
    model = toxicity.fit(documents, labels.where(~held))
    return toxicity.score(documents, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), F.size("spans").alias("n_spans"),
    )


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = held_out(QUALITY_FOLDS, QUALITY_HELD)
    model = quality.fit(documents, labels.where(~held))
    return quality.score(documents, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= QUALITY_FROM).cast("int").alias("predicted"),
    )


# A parameter of the deployment; the driver reads the file and sends its content along.
WORD_TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


def _packing(spark: SparkSession, folder: str) -> DataFrame:
    with open(WORD_TOKENIZER, encoding="utf-8") as file:
        tokenizer = file.read()
    return packing.pack(packing.pieces(table(spark, folder, "documents"), tokenizer, ids=False))


def _conversations(spark: SparkSession, folder: str) -> DataFrame:
    repairs = conversations.repair(conversations.damage(table(spark, folder, "conversations")))
    digests = repairs.digests().withColumnRenamed("conv_id", "c")
    return repairs.conversations.join(digests, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


FILTERS = "ABCDE"


def _interaction(spark: SparkSession, folder: str) -> DataFrame:
    return interaction.audit(interaction.document_masks(table(spark, folder, "documents"), table(spark, folder, "labels")), FILTERS)


# Every step of every order by itself: what a filter removes fails it and none of those before it.
_INTERACTION_SQL = r"""
    WITH texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
            list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ), marks AS (
        SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
    ), tested AS (
        SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
            100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
        FROM texts LEFT JOIN marks USING (doc_id)
    ), masks AS (
        SELECT part, CAST(a AS INT) + 2 * CAST(b AS INT) + 4 * CAST(c AS INT) + 8 * CAST(d AS INT) + 16 * CAST(e AS INT) AS mask,
            count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
        FROM tested GROUP BY ALL
    ), letters(c, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    orders AS (
        SELECT v.c || w.c || x.c || y.c || z.c AS filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
        FROM letters v, letters w, letters x, letters y, letters z WHERE v.bit + w.bit + x.bit + y.bit + z.bit = 31 AND (v.bit | w.bit | x.bit | y.bit | z.bit) = 31
    ), steps AS (
        SELECT filter_order, CAST(i AS INT) AS step, bits[i] AS bit, CAST(coalesce(list_sum(bits[1:i - 1]), 0) AS INT) AS before
        FROM orders, unnest(range(1, 6)) r(i)
    ), counted AS (
        SELECT part, filter_order, step, bit,
            sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
            sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
            sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM masks, steps GROUP BY ALL
    )
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
        CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
        CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
    FROM counted"""


QUERIES = {
    "op1_url_filter": Query(_urls, _URLS_SQL),
    "op2_toxicity": Query(_toxicity, None),
    "op3_suffix_dedup": Query(_suffixes, None),
    "op4_main_text": Query(_main_text, None),
    "op5_quality": Query(_quality, None),
    "op6_license_scan": Query(_licenses, _LICENSES_SQL),
    "op7_sentencepiece": Query(_tokens, None),
    "op8_jaccard_join": Query(_jaccard, None),
    "op9_decontamination": Query(_decontaminate, None),
    "op10_fingerprints": Query(_fingerprints, None),
    "op11_packing": Query(_packing, None),
    "op12_conversation_repair": Query(_conversations, None),
    "op13_filter_interaction": Query(_interaction, _INTERACTION_SQL),
}
