"""The operators with production parameters over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storesales.llm.chat import END, START, maximal_conversations
from storesales.llm.collocations import collocations
from storesales.llm.common import read
from storesales.llm.embedding_links import embedding_links
from storesales.llm.exact_dedup import exact_dedup
from storesales.llm.html_text import extract
from storesales.llm.jaccard_join import jaccard_components
from storesales.llm.language import identify
from storesales.llm.lexical_search import search
from storesales.llm.packing import pack
from storesales.llm.quality import score_quality
from storesales.llm.sentence_pieces import decode, encode
from storesales.llm.simhash import fingerprint_report
from storesales.llm.token_counts import count_tokens

Query = Callable[[SparkSession, str], DataFrame]


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def sentence_piece_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the text that comes back from them."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return decode(encode(read(spark, sf_dir, "documents"), path), path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def embedding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(read(spark, sf_dir, "embeddings"))


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maximal_conversations(read(spark, sf_dir, "conversations"))


def search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def collocation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


def fingerprint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document; those near to it are counted for ids divisible by 20."""
    docs = read(spark, sf_dir, "documents")
    return fingerprint_report(docs, docs.where("doc_id % 20 = 0"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality": quality_query,
        "op2_token_counts": token_counts_query,
        "op3_sentence_pieces": sentence_piece_query,
        "op4_jaccard_join": jaccard_query,
        "op5_html_text": html_query,
        "op6_packing": packing_query,
        "op7_exact_dedup": exact_dedup_query,
        "op8_embedding_links": embedding_query,
        "op9_chat_format": chat_query,
        "op10_language": language_query,
        "op11_lexical_search": search_query,
        "op12_collocations": collocation_query,
        "op13_fingerprints": fingerprint_query,
    }


EXACT_DEDUP_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

CHAT_SQL = f"""
WITH lines AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), convs AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn, role, text) AS turns FROM lines GROUP BY conv_id
), kept AS (
    SELECT min(conv_id) AS conv_id, count(*) AS n_copies, turns
    FROM convs AS a
    WHERE NOT EXISTS (
        SELECT 1 FROM convs AS b
        WHERE b.turns[1] = a.turns[1] AND len(b.turns) > len(a.turns) AND b.turns[1:len(a.turns)] = a.turns
    )
    GROUP BY turns
)
SELECT conv_id, CAST(len(turns) AS BIGINT) AS n_turns, n_copies,
       list_aggregate(list_transform(turns, lambda t: '{START}'
           || regexp_replace(regexp_replace(t.role, '<\\|im_(start|end)\\|>', '< |im_\\1|>', 'g'), '[\\r\\n]+', ' ', 'g') || chr(10)
           || regexp_replace(t.text, '<\\|im_(start|end)\\|>', '< |im_\\1|>', 'g') || '{END}' || chr(10)),
           'string_agg', '') AS text
FROM kept
"""


def _component_sql(vertices: str, key: str) -> str:
    """Smallest key reachable over ``links(a, b)`` as ``component_id``."""
    return f"""
    reached AS (
        SELECT {key} AS a, {key} AS b FROM {vertices}
        UNION
        SELECT r.a, e.b FROM reached AS r
        JOIN (SELECT a, b FROM links UNION SELECT b, a FROM links) AS e ON r.b = e.a
    ), smallest AS (SELECT a AS {key}, min(b) AS component_id FROM reached GROUP BY a)"""


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD_SQL = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    END AS grams
    FROM words
), items AS (
    SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM items AS a JOIN items AS b ON a.gram = b.gram AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), {_component_sql("sets", "doc_id")}
SELECT doc_id, len(grams) AS n_shingles, component_id FROM sets JOIN smallest USING (doc_id)
"""

EMBEDDING_SQL = f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM usable AS a JOIN usable AS b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), {_component_sql("embeddings", "vec_id")}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id OR b = vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM smallest
"""


SEARCH_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS w
    FROM documents
), sized AS (
    SELECT row, doc_id, len(w) AS n FROM docs WHERE len(w) > 0
), totals AS (
    SELECT count(*) AS all_n, CAST(sum(n) AS BIGINT) AS all_l FROM sized
), items AS (
    SELECT row_number() OVER () AS item, item_id, text
    FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)
), asked AS (
    SELECT DISTINCT item, item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
    FROM items
), held AS (
    SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY row, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * all_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
    FROM held, totals GROUP BY term, all_n
), scores AS (
    SELECT a.item, a.item_id, s.doc_id, s.row,
           CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * all_n) // all_l)))) AS BIGINT) AS score
    FROM asked AS a JOIN held AS h USING (term) JOIN weights USING (term) JOIN sized AS s ON s.row = h.row, totals
    GROUP BY a.item, a.item_id, s.doc_id, s.row
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""


COLLOCATION_SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), lines AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), spelled AS (
    SELECT lang, 1 AS words, unnest(w) AS phrase FROM lines
    UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM lines WHERE len(w) > 1
    UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    FROM lines WHERE len(w) > 2
), counted AS (
    SELECT lang, words, phrase, count(*) AS n FROM spelled GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counted WHERE words = 1 GROUP BY lang
), candidates AS (
    SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS w FROM counted WHERE words > 1 AND n >= 10
), cuts AS (
    SELECT lang, words, phrase, a, 1 AS k, w[1] AS head, array_to_string(w[2:], ' ') AS tail FROM candidates
    UNION ALL
    SELECT lang, words, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE words = 3
), scored AS (
    SELECT c.*, x.n AS l, y.n AS r,
           CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
    FROM cuts AS c
    JOIN counted AS x ON x.lang = c.lang AND x.phrase = c.head
    JOIN counted AS y ON y.lang = c.lang AND y.phrase = c.tail
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, part, max(a) AS longer
    FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM candidates WHERE words = 3)
    GROUP BY lang, part
), kept AS (
    SELECT s.* FROM lowest AS s LEFT JOIN inside AS i ON i.lang = s.lang AND i.part = s.phrase
    WHERE s.words = 3 OR i.longer IS NULL OR 100 * i.longer < 50 * s.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score
FROM kept AS k JOIN totals AS t ON t.lang = k.lang
QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op12_collocations": COLLOCATION_SQL,
        "op11_lexical_search": SEARCH_SQL,
        "op4_jaccard_join": JACCARD_SQL,
        "op8_embedding_links": EMBEDDING_SQL,
        "op7_exact_dedup": EXACT_DEDUP_SQL,
        "op9_chat_format": CHAT_SQL,
    }
