"""The registered queries of this subpackage: thin digests over its operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import bpe, centroids, fingerprint, html, jaccard, language, packing, pii, secrets, sharding, topk, toxicity, trie
from brindle.llm.common import fold, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside fold 2 of 4. Null, empty and letterless texts are und; repeated rows give a row each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(language.training_windows(docs.where(fold("doc_id", 4) != 2), "text", "lang", "doc_id"))
    out = language.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.WordConvNet | None:
    """Learned from the labels outside fold 1 of 3."""
    return toxicity.train(*toxicity.training_rows(docs, labels.where(fold("doc_id", 3) != 1), "text", "doc_id", "toxic", "lang"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside fold 1 of 3. Null and empty texts score below the cut; without labels all score 0."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 1024 tokens. Null texts are one end token; repeated rows are pieces each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text; the last document in falling order of doc_id is edited with the first, a single one with itself."""
    make = fingerprint.EditedNext()
    return fingerprint.with_next_text(table(spark, sf_dir, "documents").select("doc_id", "text"), make, make.fields)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in every document; documents without any give no row."""
    return secrets.findings(table(spark, sf_dir, "documents").select("doc_id", "text"), secrets.train(spark))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests. Null texts have no ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 8 shards under the law bytes; equal texts, nulls among them, share one."""
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, with the lines that differencing judged and deleted. Null pages are empty."""
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every fiftieth; vectors that are null or not finite take no part."""
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding")
    return topk.search(vectors, F.col("vec_id") % 50 == 0)


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op3 says of lengths and edited texts, which SQL can say too."""
    return op3_fingerprint(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document; null and wordless texts are alone."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations. Rows without conv_id take no part; an empty table has no nodes."""
    made = trie.build(table(spark, sf_dir, "conversations"))
    ends = trie.ids_sha256(made.members)
    return made.nodes.drop("turn", "ordinal").join(ends, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept vector's cluster after ten rounds of eight centroids. Other vectors give no row; repeated rows give a row each."""
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("n_exact")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, and the terms that give it away. Null texts have none; repeated rows give a row each."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_fingerprint": op3_fingerprint,
    "op4_secrets": op4_secrets,
    "op5_bpe": op5_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_sharding": op7_sharding,
    "op8_html": op8_html,
    "op9_topk": op9_topk,
    "op10_jaccard": op10_jaccard,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_centroids": op12_centroids,
    "op13_pii": op13_pii,
    "edited_texts": edited_texts,
}


def _rounds_sql(rounds: int = 10, k: int = 8) -> str:
    """Plain k-means in SQL: a pair of tables a round. Sums and products of these integers are exact in doubles."""
    nearest = "SELECT rid, k FROM (SELECT rid, k, row_number() OVER (PARTITION BY rid ORDER BY s - 2 * list_inner_product(q, c) + list_inner_product(c, c), k) AS place FROM v CROSS JOIN {c}) WHERE place = 1"
    parts = [
        """v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, q, list_inner_product(q, q) AS s FROM (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0))""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), q) - 1 AS k, q AS c FROM v ORDER BY sha256('3:' || vec_id), q LIMIT {k})",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({nearest.format(c=f'c{r}')})")
        parts.append(
            f"""m{r} AS MATERIALIZED (SELECT k, list(floor(s / n) ORDER BY i) AS c FROM (SELECT k, i, sum(x::HUGEINT)::DOUBLE AS s, count(*) AS n FROM (SELECT a.k, unnest(v.q) AS x, unnest(range(64)) AS i FROM a{r} a JOIN v USING (rid)) GROUP BY k, i) GROUP BY k),
        c{r + 1} AS MATERIALIZED (SELECT o.k, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m USING (k))"""
        )
    parts.append(f"z AS MATERIALIZED ({nearest.format(c=f'c{rounds}')})")
    parts.append(f"e AS (SELECT v.vec_id, z.k, (v.s - 2 * list_inner_product(v.q, c.c) + list_inner_product(c.c, c.c))::BIGINT AS distance, sha256(array_to_string(list_transform(c.c, lambda x: x::BIGINT), ',')) AS h FROM z JOIN v USING (rid) JOIN c{rounds} c ON c.k = z.k)")
    return "WITH " + ",\n".join(parts) + " SELECT vec_id, k::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, h AS centroid_sha256 FROM e"


ORACLES: dict[str, str] = {
    "op11_prefix_trie": """
        WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
        o AS (SELECT c, list({'r': r, 'x': x} ORDER BY n) AS o FROM t GROUP BY c),
        hashes AS (SELECT c, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(c::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
            lambda y, b: xor(xor(y, b) >> 1, 3988292384 * (xor(y, b) & 1))), 4294967295) % 9 AS h FROM (SELECT DISTINCT c FROM t)),
        h AS (SELECT o.c, o.o, CASE WHEN o.c % 5 = 0 THEN 0 ELSE h.h END AS h, coalesce(b.o, []) AS b FROM o JOIN hashes h USING (c) LEFT JOIN o b ON b.c = o.c - o.c % 5),
        s AS (SELECT c, list_concat(b[1:h], o[h + 1:]) AS s FROM h),
        p AS (SELECT c, len(s) AS length, unnest(range(0, len(s) + 1)) AS d, s FROM s),
        q AS (SELECT c, d, length, md5(s[1:d]::VARCHAR) AS k, CASE WHEN d > 0 THEN md5(s[1:d - 1]::VARCHAR) END AS up, CASE WHEN d > 0 THEN strlen(s[d].x) ELSE 0 END AS size FROM p),
        v AS (SELECT d, k, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size, coalesce(string_agg(CASE WHEN length = d THEN c END, ',' ORDER BY c), '') AS ends FROM q GROUP BY d, k),
        n AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM v WHERE d > 0 GROUP BY 1, 2),
        w AS (SELECT v.*, coalesce(n.n_children, 0) AS n_children, u.conv_id AS parent_conv_id FROM v LEFT JOIN n USING (d, k) LEFT JOIN v u ON u.d = v.d - 1 AND u.k = v.up),
        a AS (SELECT q.d, q.k, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.size) AS saved
            FROM w u JOIN q ON q.c = u.conv_id AND q.d <= u.d GROUP BY 1, 2)
        SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256 FROM w JOIN a USING (d, k)""",
    "op12_centroids": _rounds_sql(),
    "edited_texts": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
        e AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS following FROM d)
        SELECT doc_id, n AS n_chars, sha256(substr(t, 1, n - n // 3) || substr(following, 1, n // 3)) AS edited_sha256 FROM e""",
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, place::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s) WHERE place <= 5""",
    "op10_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS g FROM w)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g GROUP BY 1, 2),
        links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
        FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
}
