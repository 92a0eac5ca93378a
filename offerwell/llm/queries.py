"""Registered queries of this subpackage, each with its check in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwell.llm import bpe, context_tree, decontaminate, fixity, grid_join, manifest, max_sketch, near_dup, packing, quality, repeats, token_counts, token_store
from offerwell.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            CHECKS[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_elias_fano_tokens")
def _(spark, folder):
    path = work_dir(spark, "tokens")
    token_store.write_tokens(table(spark, folder, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=1)
    return token_store.documents(token_store.read_tokens(spark, path))


@query("op2_dart_minhash")
def _(spark, folder):
    return near_dup.near_duplicates(table(spark, folder, "documents"))


@query("op3_context_tree")
def _(spark, folder):
    train = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    rows = context_tree.score_texts(table(spark, folder, "documents"), train)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op4_longest_match_counts")
def _(spark, folder):
    rows = token_counts.count_pieces(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return rows.select("doc_id", "n_words", "n_pieces", "n_unknown")


@query("op5_co_training")
def _(spark, folder):
    rows = quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"), keep=["doc_id"])
    return rows.select("doc_id", "text_score", "page_score", "bad_score", "rejected")


# The check knows windows of ten words only: every stored item has more.
@query(
    "op6_suffix_array_matches",
    r"""
    WITH t AS (SELECT 'd' AS side, doc_id::VARCHAR AS id, text FROM documents UNION ALL SELECT 'b', item_id::VARCHAR, text FROM benchmark),
    w AS (SELECT side, id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM (SELECT side, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM t)),
    s AS (SELECT *, count(*) OVER ahead AS n, string_agg(word, ' ') OVER ahead AS span FROM w
        WINDOW ahead AS (PARTITION BY side, id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
    i AS (SELECT span, list(DISTINCT id) AS items FROM s WHERE side = 'b' AND n = 10 GROUP BY 1),
    r AS (SELECT s.*, items, max(CASE WHEN items IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY pos
        ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS hit FROM s LEFT JOIN i ON s.span = i.span AND s.n = 10 WHERE side = 'd'),
    g AS (SELECT id, count(*) AS n_words, sum(hit)::BIGINT AS n_hit, list_sort(list_distinct(flatten(list(items) FILTER (items IS NOT NULL)))) AS found
        FROM r GROUP BY 1)
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(found), 0)::BIGINT AS n_items,
           sha256(coalesce(array_to_string(found, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM documents LEFT JOIN g ON g.id = doc_id::VARCHAR
    """,
)
def _(spark, folder):
    found = decontaminate.match_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10)
    ids = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(
    "op7_epsilon_grid_order",
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e,
               sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
    link AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93),
    reach AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings
        UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
    least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
    SELECT l.a AS vec_id, coalesce(d.n, 0)::BIGINT AS n_links, l.component_id, l.a = l.component_id AS kept
    FROM least l LEFT JOIN degree d ON l.a = d.a
    """,
)
def _(spark, folder):
    return grid_join.similar_vectors(table(spark, folder, "embeddings"), 0.93)


#: The replica of the archive of ``pages`` that op8 audits: some records miss, some have another byte, some are cut short.
REPLICA = """
    CASE WHEN page_id % 97 = 3 THEN concat(substring(record, 1, length(record) - 5), '#', substring(record, length(record) - 3))
         WHEN page_id % 103 = 11 THEN substring(record, 1, length(record) - 9) ELSE record END
"""


@query(
    "op8_merkle_fixity",
    rf"""
    WITH a AS (
        SELECT page_id, concat('WARC/1.0', crlf, 'WARC-Type: response', crlf, 'WARC-Record-ID: <urn:page:', page_id::VARCHAR, '>', crlf,
            'WARC-Target-URI: ', coalesce(url, ''), crlf, 'Content-Length: ', strlen(coalesce(html, ''))::VARCHAR, crlf, crlf,
            coalesce(html, ''), crlf, crlf) AS record
        FROM pages, (SELECT chr(13) || chr(10) AS crlf) WHERE page_id IS NOT NULL),
    b AS (SELECT page_id, {REPLICA} AS record FROM a WHERE page_id % 101 <> 7),
    x AS (SELECT page_id, strlen(record) AS length, sha256(record) AS sha256,
                 coalesce(sum(strlen(record)) OVER (PARTITION BY page_id // 256 ORDER BY page_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM a),
    y AS (SELECT page_id, strlen(record) AS length, sha256(record) AS sha256,
                 coalesce(sum(strlen(record)) OVER (PARTITION BY page_id // 256 ORDER BY page_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM b)
    SELECT page_id, page_id // 256 AS file,
           CASE WHEN y.sha256 IS NULL THEN 'missing' WHEN x.sha256 <> y.sha256 THEN 'changed' ELSE 'moved' END AS status,
           x.first::BIGINT AS offset_a, x.length::BIGINT AS length_a, x.sha256 AS sha256_a,
           y.first::BIGINT AS offset_b, y.length::BIGINT AS length_b, y.sha256 AS sha256_b
    FROM x LEFT JOIN y USING (page_id)
    WHERE y.sha256 IS NULL OR x.sha256 <> y.sha256 OR x.first <> y.first
    """,
)
def _(spark, folder):
    pages = table(spark, folder, "pages")
    archive = pages.select("page_id", fixity.warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    replica = archive.where("page_id % 101 <> 7").select("page_id", F.expr(REPLICA).alias("record"))
    return fixity.audit(archive, replica)


@query("op9_segment_tree_bpe")
def _(spark, folder):
    rows = bpe.encode_decode(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query(
    "op10_seed_and_extend",
    r"""
    WITH w AS (SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM (
        SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents)),
    s AS (SELECT *, CASE WHEN count(*) OVER ahead = 50 THEN md5(string_agg(word, ' ') OVER ahead) END AS span FROM w
        WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
    f AS (SELECT span, min(doc_id) AS first FROM s WHERE span IS NOT NULL GROUP BY 1),
    r AS (SELECT s.*, coalesce(max(CASE WHEN first < doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos
        ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone FROM s LEFT JOIN f USING (span))
    SELECT doc_id, count(word) AS n_words, coalesce(sum(gone), 0)::BIGINT AS n_removed,
           sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0), '')) AS kept_sha256
    FROM documents LEFT JOIN r USING (doc_id) GROUP BY 1
    """,
)
def _(spark, folder):
    rows = repeats.remove_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op11_max_sketch_search",
    r"""
    WITH w AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
    t AS (SELECT side, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM w),
    f AS (SELECT id, term, count(*) AS tf, sum(count(*)) OVER (PARTITION BY id) AS n FROM t WHERE side = 'd' GROUP BY 1, 2),
    a AS (SELECT count(DISTINCT id) AS nd, sum(tf)::BIGINT AS l FROM f),
    v AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM f, a GROUP BY term, nd),
    s AS (SELECT q.id AS item_id, f.id AS doc_id,
              sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n::BIGINT * nd) // l))))::BIGINT AS score
          FROM (SELECT DISTINCT id, term FROM t WHERE side = 'b') q JOIN f USING (term) JOIN v USING (term), a GROUP BY 1, 2),
    r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
    """,
)
def _(spark, folder):
    path = work_dir(spark, "sketches")
    max_sketch.write_index(table(spark, folder, "documents"), path)
    return max_sketch.search(spark, path, table(spark, folder, "benchmark"), k=50)


@query("op12_vector_best_fit")
def _(spark, folder):
    placed = packing.pack_documents(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), tokens=4096)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query(
    "op13_butterfly_manifest",
    """
    WITH RECURSIVE f AS (
        SELECT doc_id, coalesce('=' || source, '') AS s, text, list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
                   lambda v: coalesce(strlen(v)::VARCHAR || ':' || v, '-')) AS head,
               list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                   lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                       lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) & 1 = 1 AS even
        FROM documents),
    d AS (SELECT doc_id, s, sha256(array_to_string(head, '') || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
                 CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS now, head FROM f),
    l AS (SELECT doc_id, s, leaf, sha256(array_to_string(head, '') || coalesce(strlen(now)::VARCHAR || ':' || now, '-')) AS found,
                 row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY s) AS n FROM d),
    t AS (SELECT s, 0 AS level, place, leaf AS digest, n FROM l
        UNION ALL SELECT s, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3 FROM t WHERE n > 1 GROUP BY s, level, place // 3, n),
    top AS (SELECT s, level AS height, digest AS subroot, row_number() OVER (ORDER BY s) - 1 AS place, count(*) OVER () AS n FROM t WHERE n = 1),
    u AS (SELECT 0 AS level, place, subroot AS digest, n FROM top
        UNION ALL SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY level, place // 3, n),
    step AS (
        SELECT a.s, a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
               coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after
        FROM t a JOIN t b ON a.s = b.s AND a.level = b.level AND a.place // 3 = b.place // 3 WHERE a.n > 1 GROUP BY 1, 2, 3
        UNION ALL
        SELECT top.s, height + a.level, 0, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), ''),
               coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '')
        FROM u a JOIN u b ON a.level = b.level AND a.place // 3 = b.place // 3 JOIN top ON a.place = top.place // (3 ** a.level)::BIGINT
        WHERE a.n > 1 GROUP BY top.s, height, a.level, a.place),
    up AS (SELECT doc_id, s, place, leaf, 0 AS level, found AS folded, '' AS proof FROM l
        UNION ALL SELECT doc_id, up.s, up.place // 3, leaf, up.level + 1, sha256(before || folded || after), proof || before || after
        FROM up JOIN step ON up.s = step.s AND up.level = step.level AND up.place = step.place)
    SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
    FROM up JOIN top USING (s), (SELECT digest, level AS above FROM u WHERE n = 1) WHERE up.level = height + above
    """,
)
def _(spark, folder):
    docs = table(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text", manifest.row_digest(*fields, F.col("text")).alias("leaf"))
    found = F.when(tampered, manifest.row_digest(*fields, F.replace("text", F.lit("\n"), F.lit(""))))
    rows = rows.select("doc_id", "source", "leaf", found.alias("found"))
    proved = manifest.manifest(rows, group="source", key="doc_id", check="found")
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
