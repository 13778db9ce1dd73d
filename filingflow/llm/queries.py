"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.llm import bpe, embedding_dedup, fingerprints, language_id, lexical, line_dedup, merkle, mixing, rank_bpe, sharding, simhash, suffix_dedup, warc
from filingflow.session import new_work_dir


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint")
    rows = docs.select("doc_id", "source", size.alias("size"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))
    placed = sharding.interleave_shards(rows, shards=16, seed=17)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.93)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document at least once, the rarest source at most twice."""
    units = _read(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_tokens(F.col("text")).alias("tokens"))
    return mixing.mix(units, repetition_limit=2.0)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = 32
    found = fingerprints.fingerprint_documents(_read(spark, sf_dir, "documents"), samples=samples)
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprints.to_string(F.col("signature"), samples).alias("fingerprint"),
        fingerprints.to_string(F.col("edited_signature"), samples).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        fingerprints.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents"), window=200, texts=False)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"), words_per_shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    fold = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.where(~fold))
    found = language_id.predict(docs, model)
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_read(spark, sf_dir, "documents"), min_words=25)
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(_read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, ids=False)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "warc")
    warc.write_archives(_read(spark, sf_dir, "pages"), path, min_payload=100)
    return warc.resolve_read(warc.read_archives(spark, path))


def op11_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_bpe.encode_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified rows: those with an even CRC-32 of the key claim the leaf of a text without line feeds."""
    docs = _read(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    rows = docs.select(*fields, merkle.leaf_digest(*fields).alias("leaf"))
    rows = rows.withColumn("text", F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    rows = rows.select("doc_id", "source", "leaf", merkle.leaf_digest(*fields).alias("claimed_leaf"))
    found = merkle.verify(merkle.manifest(rows, "source", "doc_id", "leaf", keep=["claimed_leaf"]), claimed="claimed_leaf")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), top=20)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_mixing": op3_mixing,
    "op4_fingerprints": op4_fingerprints,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_simhash": op6_simhash,
    "op7_language_id": op7_language_id,
    "op8_line_dedup": op8_line_dedup,
    "op9_bpe": op9_bpe,
    "op10_warc": op10_warc,
    "op11_rank_bpe": op11_rank_bpe,
    "op12_merkle": op12_merkle,
    "op13_lexical": op13_lexical,
}

ORACLE = {
    "op2_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93
        ),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ),
        comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
        FROM embeddings e JOIN comp c ON c.a = e.vec_id
    """,
    "op8_line_dedup": """
        WITH l AS (
            SELECT doc_id, i AS pos, trim(s[i + 1], ' ') AS line, greatest(1, len(regexp_extract_all(s[i + 1], '[^\\s]+'))) AS words
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents) t, unnest(range(len(s))) u(i)
        ),
        often AS (SELECT line FROM l GROUP BY line HAVING count(*) > 1),
        r AS (SELECT l.*, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM l JOIN often USING (line)),
        c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, island ORDER BY pos) AS ends FROM r),
        ahead AS (
            SELECT a.doc_id, a.pos AS start, max(b.pos) AS stop FROM c a JOIN c b
            ON a.doc_id = b.doc_id AND a.island = b.island AND b.pos >= a.pos AND b.ends - b.words < a.ends - a.words + 25
            GROUP BY a.doc_id, a.pos, a.ends, a.words HAVING max(b.ends) - (a.ends - a.words) >= 25
        ),
        behind AS (
            SELECT a.doc_id, min(b.pos) AS start, a.pos AS stop FROM c a JOIN c b
            ON a.doc_id = b.doc_id AND a.island = b.island AND b.pos <= a.pos AND b.ends > a.ends - 25
            GROUP BY a.doc_id, a.pos, a.ends HAVING a.ends - min(b.ends - b.words) >= 25
        ),
        w AS (SELECT * FROM ahead UNION SELECT * FROM behind),
        named AS (
            SELECT w.doc_id, w.start, w.stop, string_agg(c.line, chr(10) ORDER BY c.pos) AS run
            FROM w JOIN c ON c.doc_id = w.doc_id AND c.pos BETWEEN w.start AND w.stop GROUP BY ALL
        ),
        firsts AS (SELECT run, min((doc_id, start)) AS f FROM named GROUP BY run),
        gone AS (
            SELECT DISTINCT n.doc_id, unnest(range(n.start, n.stop + 1)) AS pos FROM named n JOIN firsts USING (run)
            WHERE n.doc_id <> f[1] OR n.start - f[2] > n.stop - n.start
        ),
        opened AS (SELECT *, coalesce(pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) > 1, true) AS opens FROM gone),
        runs AS (SELECT doc_id, count(*) AS n, count(*) FILTER (opens) AS r FROM opened GROUP BY doc_id),
        kept AS (
            SELECT t.doc_id, string_agg(s[i + 1], chr(10) ORDER BY i) FILTER (g.pos IS NULL) AS text
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents) t, unnest(range(len(s))) u(i)
            LEFT JOIN gone g ON g.doc_id = t.doc_id AND g.pos = u.i GROUP BY t.doc_id
        )
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
               coalesce(n, 0) AS n_removed, coalesce(r, 0) AS n_runs, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM documents d LEFT JOIN runs USING (doc_id) JOIN kept ON kept.doc_id = d.doc_id
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ),
        firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT p.page_id, payload_bytes, p.payload_digest,
               CASE WHEN first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> p.page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN firsts ON firsts.payload_digest = p.payload_digest AND p.payload_bytes >= 100
    """,
    "op12_merkle": """
        WITH RECURSIVE field AS (
            SELECT row_number() OVER () AS r, doc_id, source, text,
                   xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                       lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, step: xor(x >> 1, 3988292384 * (x & 1))))) AS crc,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
            FROM documents
        ),
        leaf AS (
            SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   replace(text, chr(10), '') AS cut, head, crc % 2 = 0 AS tampered
            FROM field
        ),
        leaves AS (
            SELECT r, doc_id, source, leaf,
                   CASE WHEN tampered THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) ELSE leaf END AS claimed,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY source) AS n
            FROM leaf
        ),
        nodes AS (
            SELECT 0 AS level, source, pos, leaf AS h, n FROM leaves
            UNION ALL
            SELECT level + 1, source, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY level, source, pos // 3, n
        ),
        subroots AS (SELECT source, level AS top, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
        tops AS (
            SELECT 0 AS level, pos, subroot AS h, n FROM subroots
            UNION ALL
            SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, pos // 3, n
        ),
        every AS (
            SELECT source, level, pos, h, n FROM nodes
            UNION ALL
            SELECT s.source, s.top + t.level + 1, t.pos, t.h, t.n FROM tops t, (SELECT DISTINCT source, top FROM subroots) s
        ),
        runs AS (SELECT source, level, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM every WHERE n > 1 GROUP BY ALL),
        path AS (
            SELECT l.r, l.source, 0 AS level, l.pos, l.claimed AS h, '' AS proof, s.top, s.pos AS top_pos,
                   s.top + (SELECT max(level) FROM tops) + 1 AS last
            FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
            UNION ALL
            SELECT p.r, p.source, p.level + 1, CASE WHEN p.level = p.top THEN p.top_pos ELSE p.pos // 3 END,
                   CASE WHEN p.level = p.top THEN p.h
                        ELSE sha256(array_to_string(u.hs[1 : p.pos % 3], '') || p.h || array_to_string(u.hs[p.pos % 3 + 2 :], '')) END,
                   CASE WHEN p.level = p.top THEN p.proof
                        ELSE p.proof || array_to_string(u.hs[1 : p.pos % 3], '') || array_to_string(u.hs[p.pos % 3 + 2 :], '') END,
                   p.top, p.top_pos, p.last
            FROM path p LEFT JOIN runs u ON u.source IS NOT DISTINCT FROM p.source AND u.level = p.level AND u.run = p.pos // 3
            WHERE p.level < p.last
        )
        SELECT l.doc_id, l.leaf, s.subroot, t.h AS root, sha256(p.proof) AS proof_sha256, p.h AS folded_root, p.h = t.h AS verified
        FROM path p JOIN leaves l USING (r) JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source, (SELECT h FROM tops WHERE n = 1) t
        WHERE p.level = p.last
    """,
    "op13_lexical": """
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {terms}) AS t FROM documents
        ),
        b AS (
            SELECT row_number() OVER () AS b, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {terms})) AS w
            FROM benchmark
        ),
        facts AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(t)) AS BIGINT) AS ll FROM d WHERE len(t) > 0),
        tf AS (SELECT r, doc_id, w, len(t) AS n, count(*) AS tf FROM (SELECT r, doc_id, t, unnest(t) AS w FROM d) SEMI JOIN b USING (w) GROUP BY ALL),
        df AS (SELECT w, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, facts GROUP BY w, nn),
        s AS (
            SELECT b, item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
            FROM b JOIN tf USING (w) JOIN df USING (w), facts GROUP BY b, item_id, r, doc_id
        ),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
    """.replace("{terms}", r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"),
}
