"""Queries op1_ to op13_ with their production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import extract, goodness, manifest, mixing, neardup, prefixes, quality, repeats, scoring, subwords, toxicity, urls, vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: host, path, verdict
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subwords.encode(_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(_table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_table(spark, sf_dir, "pages"))


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(_table(spark, sf_dir, "documents"))


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9's ledger, rule by rule: what each rule of the policy costs."""
    return quality.ablation(quality.ledger(_table(spark, sf_dir, "documents")), quality.PROSE)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return manifest.verify(manifest.manifest(docs, manifest.without_line_breaks(docs)))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(prefixes.rebuilt(prefixes.turns(_table(spark, sf_dir, "conversations"))))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return goodness.score(docs, goodness.fit(docs, _table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_lm_scoring, op2_html_extraction, op3_minhash_neardup, op4_sentencepiece, op5_url_filter, op6_embedding_neardup, op7_toxicity, op8_suffix_dedup, op9_quality_rules, op10_mixing, op11_merkle_manifest, op12_prefix_trie, op13_quality_classifier, quality_ablation)}

ORACLE: dict[str, str] = {
    "op5_url_filter": r"""
        WITH p AS (SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages),
        q AS (SELECT page_id, lower(regexp_extract(r, '^([^/?#]*)', 1)) AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
        rules(h, s, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        best AS (SELECT host, path, arg_max(h || s, length(h || s)) AS rule, arg_max(v, length(h || s)) AS v
                 FROM (SELECT DISTINCT host, path FROM q) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY host, path)
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM q LEFT JOIN best USING (host, path)""",
    "op9_quality_rules": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        l AS (SELECT doc_id, t, w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
                     list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g FROM t),
        d AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, x) AS n FROM (SELECT doc_id, unnest(g) AS x, generate_subscripts(g, 1) AS p FROM l)),
        r AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM (SELECT doc_id, p, unnest([0, 1, 2]) AS k FROM d WHERE n > 1) GROUP BY doc_id),
        m AS (SELECT l.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                     len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM l LEFT JOIN r USING (doc_id)),
        f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END) + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END)
                     + (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END) + (CASE WHEN 10 * word_chars < 15 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END) AS failed FROM m)
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
               CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed, 'prose-1' AS policy FROM f""",
}
ORACLE["quality_ablation"] = f"""
        WITH ledger AS ({ORACLE["op9_quality_rules"]}),
        rules(rule, b) AS (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('duplicate_lines', 8), ('short_words', 16), ('long_words', 32))
        SELECT 'prose-1' AS policy, rule, count(*) FILTER (failed & b <> 0) AS n_failed, count(*) FILTER (failed = b) AS n_only, count(*) FILTER (failed & (63 - b) = 0) AS n_kept_without
        FROM rules, ledger GROUP BY rule"""

#: CRC-32 of a decimal number: DuckDB has no function for it.
_CRC = """xor(4294967295, list_reduce(list_transform(range(1, length(CAST({x} AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST({x} AS VARCHAR)[i]) AS BIGINT)),
        lambda a, b: list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), xor(a, b)), CAST(4294967295 AS BIGINT)))"""
#: Levels of a tree that the SQL below climbs: 3 ** 11 leaves of a source.
_SQL_LEVELS = 11


def _manifest_sql() -> str:
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"  # noqa: E731
    leaf = lambda text: "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"  # noqa: E731
    out = [
        f"d AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf('found')} AS f FROM (SELECT *, CASE WHEN {_CRC.format(x='doc_id')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS found FROM documents))",
        "p0 AS (SELECT doc_id, source, leaf, f, '' AS sib, leaf AS h, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d)",
        "t0 AS (SELECT source, pos, n, h FROM p0)",
    ]

    def climb(p: str, t: str, carried: str) -> None:
        for k in range(_SQL_LEVELS):
            out.append(f"r{t}{k} AS (SELECT source, pos // 3 AS run, n, list(h ORDER BY pos) AS l FROM {t}{k} WHERE n > 1 GROUP BY ALL)")
            out.append(f"{t}{k + 1} AS (SELECT source, run AS pos, (n + 2) // 3 AS n, sha256(array_to_string(l, '')) AS h FROM r{t}{k} UNION ALL SELECT source, pos, n, h FROM {t}{k} WHERE n = 1)")
            left, right = "array_to_string(l[:pos % 3], '')", "array_to_string(l[pos % 3 + 2:], '')"
            out.append(f"{p}{k + 1} AS (SELECT {carried}, p.source, CASE WHEN l IS NULL THEN f ELSE sha256({left} || f || {right}) END AS f, CASE WHEN l IS NULL THEN sib ELSE sib || {left} || {right} END AS sib, pos // 3 AS pos, (p.n + 2) // 3 AS n FROM {p}{k} p LEFT JOIN r{t}{k} r ON p.source IS NOT DISTINCT FROM r.source AND pos // 3 = run)")

    climb("p", "t", "doc_id, leaf")
    last = _SQL_LEVELS
    out.append(f"s AS (SELECT source AS name, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t{last})")
    out.append("v0 AS (SELECT '' AS source, pos, n, subroot AS h FROM s)")
    out.append(f"q0 AS (SELECT doc_id, leaf, subroot, '' AS source, f, sib, s.pos, s.n FROM p{last} p JOIN s ON p.source IS NOT DISTINCT FROM s.name)")
    climb("q", "v", "doc_id, leaf, subroot")
    out.append("src AS (SELECT doc_id AS d, source AS source_ FROM documents)")
    return f"WITH {', '.join(out)} SELECT doc_id, leaf, subroot, (SELECT h FROM v{last}) AS root, sha256(sib) AS proof_sha256, f AS folded_root, f = (SELECT h FROM v{last}) AS verified, source_ AS source FROM q{last} JOIN src ON doc_id IS NOT DISTINCT FROM d"


ORACLE["op11_merkle_manifest"] = _manifest_sql()
ORACLE["op12_prefix_trie"] = f"""
        WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        h AS (SELECT DISTINCT c, {_CRC.format(x="c")} % 4 AS h FROM t),
        r AS (SELECT h.c, t.i, t.role, t.text FROM h JOIN t ON t.c = h.c - h.c % 20 AND t.i <= h UNION ALL SELECT t.c, t.i + 4, t.role, t.text FROM t JOIN h ON t.c = h.c AND t.i > h),
        k AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS depth, sha256(strlen(role) || ':' || role || text) AS turn, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM r),
        m AS (SELECT c, 0 AS depth, '' AS path, 0 AS words FROM h UNION ALL SELECT c, depth, string_agg(turn, '') OVER (PARTITION BY c ORDER BY depth), words FROM k),
        z AS (SELECT c, max(depth) AS size FROM m GROUP BY c),
        n AS (SELECT path, depth, min(c) AS least, count(*) AS n, any_value(words) AS words, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = depth), '')) AS ends FROM m JOIN z USING (c) GROUP BY path, depth),
        o AS (SELECT n.*, u.least AS over FROM n LEFT JOIN m w ON w.c = n.least AND w.depth = n.depth - 1 LEFT JOIN n u ON u.path = w.path AND u.depth = w.depth),
        kids AS (SELECT over AS least, depth - 1 AS depth, count(*) AS kids FROM o WHERE depth > 0 GROUP BY ALL),
        b AS (SELECT a.path, a.depth, sum((o.n - 1) * o.words) AS saved, count(*) FILTER (kids IS NULL) AS leaves FROM o LEFT JOIN kids ON kids.least = o.least AND kids.depth = o.depth JOIN m a ON a.c = o.least AND a.depth <= o.depth GROUP BY ALL)
        SELECT o.least AS conv_id, o.depth, over AS parent_conv_id, n AS n_convs, coalesce(kids, 0) AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
        FROM o JOIN b ON b.path = o.path AND b.depth = o.depth LEFT JOIN kids ON kids.least = o.least AND kids.depth = o.depth"""

#: Least number of each node's component over links (a, b) among nodes n (id).
_SQL_COMPONENTS = "ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links), reach AS (SELECT id AS a, id AS b FROM n UNION SELECT r.a, l.b FROM reach r JOIN ways l ON l.a = r.b), c AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)"
ORACLE["op3_minhash_neardup"] = rf"""
        WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') AS w FROM documents),
        s AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
        n AS (SELECT w.id, count(s.s) AS n FROM w LEFT JOIN s USING (id) GROUP BY w.id),
        p AS (SELECT a.id AS a, b.id AS b, count(*) AS both_have FROM s a JOIN s b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
        links AS (SELECT a, b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * both_have >= 75 * (x.n + y.n - both_have)), {_SQL_COMPONENTS}
        SELECT id AS doc_id, n AS n_shingles, component AS component_id, id = component AS kept FROM n JOIN c USING (id)"""
ORACLE["op6_embedding_neardup"] = f"""
        WITH RECURSIVE v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        u AS (SELECT id, v, sqrt(list_dot_product(v, v)) AS m FROM v WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
        links AS (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.id < b.id WHERE list_dot_product(a.v, b.v) / (a.m * b.m) >= 0.9), n AS (SELECT id FROM v), {_SQL_COMPONENTS},
        d AS (SELECT a AS id, count(*) AS n_links FROM ways GROUP BY a)
        SELECT id AS vec_id, coalesce(n_links, 0) AS n_links, component AS component_id, id = component AS kept FROM n JOIN c USING (id) LEFT JOIN d USING (id)"""
