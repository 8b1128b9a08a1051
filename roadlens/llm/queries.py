"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadlens.llm import dedup, hnsw, language, masked_lm, merkle, mixing, packing, quality, secrets, tokens, toxicity, tries, urls

TOKEN_LIMIT = 512


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark, d):
    return _table(spark, d, "documents")


def op1_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language.identify(_docs(spark, d))


def op2_masked_lm(spark: SparkSession, d: str) -> DataFrame:
    return masked_lm.score_documents(_docs(spark, d))


def op3_source_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed_sizes(_docs(spark, d))


def op4_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return urls.filter_urls(_table(spark, d, "pages"))


def op5_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secrets.span_digests(secrets.scan_secrets(_docs(spark, d)))


def op6_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(_docs(spark, d), tokens.tokenizer_path("word_bpe_49k.json"))


def op7_hnsw_search(spark: SparkSession, d: str) -> DataFrame:
    return hnsw.search(_table(spark, d, "embeddings"))


def op8_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    return quality.judge(docs, quality.fit_rules(docs, _table(spark, d, "labels")))


def op9_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_duplicates(_docs(spark, d), words=4, percent=80)


def op10_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return tokens.count_tokens(_docs(spark, d), tokens.tokenizer_path("byte_bpe_50k.json"), TOKEN_LIMIT)


def op11_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return tries.prefix_trie(_table(spark, d, "conversations")).drop("k")


def op12_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.toxicity(_docs(spark, d), _table(spark, d, "labels"))


def op13_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle.checked(merkle.build(_docs(spark, d)))


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_masked_lm, op3_source_mix, op4_url_filter, op5_secret_scan,
                            op6_best_fit_packing, op7_hnsw_search, op8_quality_rules, op9_near_duplicates,
                            op10_token_counts, op11_prefix_trie, op12_toxicity, op13_merkle_manifest, pipeline)
}

# ---------------------------------------------------------------------------
# DuckDB SQL, where SQL can express the result
# ---------------------------------------------------------------------------
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANKS = r"[\x20\x09-\x0D]+"


def _hits(terms) -> str:
    """The number of the terms that stand in ``low`` with a boundary on both sides."""
    edge = "[^\\p{L}\\p{N}]"
    return " + ".join(f"CAST(regexp_matches(low, '(^|{edge}){t}({edge}|$)') AS INTEGER)" for t in terms)


_RULES = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in urls.RULES)

_OP4 = f"""WITH parts AS (
  SELECT page_id, url,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '://([^?#]*)', 1) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, lower(coalesce(url, '')) AS low,
         translate(coalesce(regexp_extract(rest, '^[^/]*'), ''), '{_UPPER}', '{_UPPER.lower()}') AS host,
         coalesce(regexp_extract(rest, '/.*$', 0, 's'), '') AS path FROM parts),
judged AS (
  SELECT *, {_hits(urls.STRICT_TERMS)} AS st, {_hits(urls.SOFT_TERMS)} AS so,
         (SELECT max_by(struct_pack(v := r.v, r := r.r), length(r.r)) FROM (VALUES {_RULES}) r(v, r, h, p)
          WHERE (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p)) AS rule
  FROM split)
SELECT page_id, host, path, rule.r AS rule,
       coalesce(rule.v, CASE WHEN {urls.STRICT_WEIGHT} * st + {urls.SOFT_WEIGHT} * so >= {urls.REJECT_AT}
                             THEN 'block' ELSE 'allow' END) AS verdict,
       CAST({urls.STRICT_WEIGHT} * st + {urls.SOFT_WEIGHT} * so AS INTEGER) AS weight,
       CAST(st + so AS INTEGER) AS n_terms
FROM judged"""

_OP9 = f"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_BLANKS}'),
                             lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.lo, s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(m.lo, s.doc_id)) AS kept
FROM s LEFT JOIN (SELECT a, min(b) AS lo FROM r GROUP BY a) m ON s.doc_id = m.a"""

#: The table of CRC-32, and the checksum of a column's decimal digits.
_CRC_TABLE = """crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))))"""


def _crc32(number: str) -> str:
    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), "
            f"lambda a, x: xor(a >> 8, crc.t[xor(a, x) % 256 + 1])), 4294967295)")


def _leaf(text: str) -> str:
    part = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(part.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_OP13 = f"""WITH RECURSIVE {_CRC_TABLE},
ids AS (SELECT doc_id, {_crc32("doc_id")} AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc),
hashed AS (
  SELECT d.doc_id, lang, {_leaf("text").replace("doc_id", "d.doc_id")} AS leaf,
         CASE WHEN c % 3 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')").replace("doc_id", "d.doc_id")} END AS other
  FROM documents d LEFT JOIN ids ON d.doc_id = ids.doc_id),
lf AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, leaf, coalesce(other, leaf) AS changed,
              row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
              count(*) OVER (PARTITION BY lang) AS n FROM hashed),
lv(tree, l, p, h, n) AS (
  SELECT tree, 0, place, leaf, n FROM lf
  UNION ALL
  SELECT tree, l + 1, p // 8, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 7) // 8 FROM lv WHERE n > 1 GROUP BY tree, l, p // 8),
subs AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM lv WHERE n = 1),
tp(l, p, h, n) AS (
  SELECT 0, place, h, n FROM subs
  UNION ALL
  SELECT l + 1, p // 8, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 7) // 8 FROM tp WHERE n > 1 GROUP BY l, p // 8),
lows AS (SELECT tree, l, p // 8 AS q, list(h ORDER BY p) AS run FROM lv WHERE n > 1 GROUP BY tree, l, p // 8),
highs AS (SELECT l, p // 8 AS q, list(h ORDER BY p) AS run FROM tp WHERE n > 1 GROUP BY l, p // 8),
met AS (
  SELECT lf.tree, lf.place, lows.l AS lvl, run, (lf.place // CAST(8 ** lows.l AS BIGINT)) % 8 AS slot
  FROM lf JOIN lows ON lf.tree = lows.tree AND lf.place // CAST(8 ** (lows.l + 1) AS BIGINT) = lows.q
  UNION ALL
  SELECT lf.tree, lf.place, 100 + highs.l, run, (subs.place // CAST(8 ** highs.l AS BIGINT)) % 8
  FROM lf JOIN subs ON lf.tree = subs.tree JOIN highs ON subs.place // CAST(8 ** (highs.l + 1) AS BIGINT) = highs.q),
sides AS (SELECT tree, place, lvl, coalesce(array_to_string(run[1:slot], ''), '') AS b,
                 coalesce(array_to_string(run[slot + 2:], ''), '') AS a FROM met),
paths AS (SELECT tree, place, list(b || '|' || a ORDER BY lvl) AS path, string_agg(b || a, '' ORDER BY lvl) AS proof
          FROM sides GROUP BY tree, place),
folds AS (
  SELECT lf.doc_id, leaf, subs.h AS subroot, (SELECT h FROM tp WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_prepend(changed, coalesce(path, [])),
                     lambda acc, x: sha256(split_part(x, '|', 1) || acc || split_part(x, '|', 2))) AS folded_root
  FROM lf JOIN subs ON lf.tree = subs.tree LEFT JOIN paths ON lf.tree = paths.tree AND lf.place = paths.place)
SELECT *, folded_root = root AS verified FROM folds"""

_OP11 = f"""WITH {_CRC_TABLE},
ids AS (SELECT c, {_crc32("c")} % 9 AS h, c - c % 5 AS base
        FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL), crc),
own AS (SELECT conv_id AS c, strlen(coalesce(text, '')) AS bytes, t,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS j
        FROM (SELECT *, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t FROM conversations)
        WHERE conv_id IS NOT NULL),
joined AS (
  SELECT ids.c, 0 AS part, j, t, bytes FROM ids JOIN own ON ids.base = own.c AND j <= h
  UNION ALL
  SELECT ids.c, 1, j, t, bytes FROM ids JOIN own ON ids.c = own.c AND j > h),
prefixes AS (
  SELECT c, list(t) OVER w AS pre, bytes, row_number() OVER w AS p FROM joined WINDOW w AS (PARTITION BY c ORDER BY part, j)
  UNION ALL SELECT c, [], 0, 0 FROM ids),
lengths AS (SELECT c, max(p) AS n FROM prefixes GROUP BY c),
nodes AS (
  SELECT pre, any_value(p) AS depth, min(x.c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
         sha256(coalesce(string_agg(CAST(x.c AS VARCHAR), ',' ORDER BY x.c) FILTER (WHERE p = n), '')) AS ends_sha256
  FROM prefixes x JOIN lengths ON x.c = lengths.c GROUP BY pre),
children AS (SELECT pre[1:depth - 1] AS pre, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
leaves AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children ON nodes.pre = children.pre),
totals AS (
  SELECT pre[1:d] AS pre, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT pre, n_children, saved, unnest(range(0, depth + 1)) AS d FROM leaves) GROUP BY 1)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
FROM leaves x JOIN totals ON x.pre = totals.pre LEFT JOIN nodes y ON x.depth > 0 AND y.pre = x.pre[1:x.depth - 1]"""

ORACLE_SQL: dict[str, str] = {"op11_prefix_trie": _OP11, "op4_url_filter": _OP4, "op9_near_duplicates": _OP9, "op13_merkle_manifest": _OP13}
