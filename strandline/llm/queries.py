"""The thin queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard_join, language_id, line_dedup, lloyd, piece_codec, quality_fm, quality_rules, ranked_search, recompression, secret_scan, simhash, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.dedup(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and hash of the ids of each text, and whether they decode to it."""
    vocabulary = piece_codec.load()
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    tokens = piece_codec.encode(docs.withColumn("said", F.sha2("text", 256)), vocabulary, ["doc_id", "said"])
    back = piece_codec.decode(tokens.withColumns({"n_tokens": F.size("ids").cast("long"), "ids_hash": F.hash("ids")}), vocabulary, ["doc_id", "said", "n_tokens", "ids_hash"])
    return back.select("doc_id", "n_tokens", "ids_hash", (F.sha2("text", 256) == F.col("said")).alias("round_trip"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("rule")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster_report(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_quality_classifier, op3_substring_dedup, op4_language_id, op5_sentencepiece, op6_quality_rules, op7_ngram_jaccard_join,
        op8_secret_scan, op9_line_dedup, op10_toxicity, op11_centroid_clustering, op12_ranked_search, op13_simhash,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULE_ROWS = " UNION ALL ".join(
    f"SELECT doc_id, {i} AS rule, '{k}' AS kind, regexp_extract_all(t, '{p.replace("'", "''")}') AS m, string_split_regex(t, '{p.replace("'", "''")}') AS g FROM docs"
    for i, (k, p) in enumerate(secret_scan.RULES.items())
)
#: A Lloyd round in SQL: the assignment to the centroids c{i}, and the centroids after it.
_ASSIGNED = "SELECT vec_id, q, arg_min(c, d * 64 + c) AS c, min(d) AS d FROM (SELECT vec_id, q, c, list_sum(list_transform(list_zip(q, v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM q, c{i}) GROUP BY vec_id, q"
_ROUND = """a{i} AS MATERIALIZED ({assigned}),
        s{i} AS (SELECT c, j, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(q) AS x, unnest(range(1, 65)) AS j FROM a{i}) GROUP BY c, j),
        m{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM s{i} GROUP BY c),
        c{n} AS MATERIALIZED (SELECT c{i}.c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))"""
_ROUNDS = ", ".join(_ROUND.format(i=i, n=i + 1, assigned=_ASSIGNED.format(i=i)) for i in range(5))
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(_UPPER, _LOWER)
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"

ORACLES: dict[str, str] = {
    "op1_decontamination": f"""
        WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        q AS (SELECT DISTINCT item_id, least(5, len(w)) AS k, unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda j: array_to_string(w[j:j + least(5, len(w)) - 1], ' '))) AS s FROM i WHERE len(w) > 0),
        d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        x AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS s FROM d, (SELECT DISTINCT k FROM q)),
        n AS (SELECT item_id, count(*) AS n_shingles FROM q GROUP BY item_id),
        c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM q JOIN x USING (k, s) GROUP BY ALL)
        SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment FROM c JOIN n USING (item_id) WHERE 5 * n_shared >= 4 * n_shingles""",
    "op3_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        x AS (SELECT doc_id, s, array_to_string(w[s:s + 34], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d)),
        r AS (SELECT doc_id, s FROM x JOIN (SELECT win FROM x GROUP BY win HAVING count(*) > 1) USING (win)),
        c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM r),
        l AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY 1),
        o AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN l USING (doc_id)),
        k AS (SELECT o.doc_id, string_agg(o.w[i], ' ' ORDER BY i) AS kept FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM o) o ANTI JOIN c ON c.doc_id = o.doc_id AND c.p = o.i GROUP BY 1)
        SELECT o.doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM o LEFT JOIN k USING (doc_id)""",
    "op7_ngram_jaccard_join": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        x AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda j: array_to_string(w[j:j + 2], ' ')) END) AS s FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM x GROUP BY 1),
        c AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS i FROM x p JOIN x q USING (s) WHERE p.doc_id <> q.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 90 * (na.n + nb.n - i)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) m USING (doc_id)""",
    "op8_secret_scan": f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        found AS ({_RULE_ROWS}),
        each AS (SELECT doc_id, rule, kind, m, g, unnest(range(1, len(m) + 1)) AS i FROM found),
        span AS (SELECT doc_id, rule, kind, m[i] AS said, list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS s FROM each),
        kept AS (SELECT *, kind || ':' || s || ':' || (s + length(said)) AS txt FROM span WHERE kind <> 'assign' OR length(regexp_extract(said, '{secret_scan.ASSIGN.replace("'", "''")}', 2)) >= 6),
        by_doc AS (SELECT doc_id, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access, count(*) FILTER (rule = 2) AS n_hex,
            string_agg(txt, ',' ORDER BY s, rule) FILTER (rule < 3) AS base, string_agg(txt, ',' ORDER BY s, rule) AS spans FROM kept GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN by_doc USING (doc_id)""",
    "op11_centroid_clustering": f"""
        WITH q AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, q AS v FROM q ORDER BY sha256('2:' || vec_id) LIMIT 40),
        {_ROUNDS},
        f AS MATERIALIZED ({_ASSIGNED.format(i=5)})
        SELECT vec_id, f.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY f.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c5.v, ',')) AS centroid_sha256 FROM f JOIN c5 USING (c)""",
    "op12_ranked_search": f"""
        WITH t AS MATERIALIZED (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM t GROUP BY 1),
        z AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM n),
        q AS MATERIALIZED (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
        p AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM t SEMI JOIN q USING (term) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), z),
        s AS (SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // l))))::BIGINT AS score FROM q JOIN p USING (term) JOIN w USING (term) JOIN n USING (doc_id), z GROUP BY ALL)
        SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0) WHERE rank <= 20""",
}
