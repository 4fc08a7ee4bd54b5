"""The dealt operators as queries over the whole ``documents`` table, with SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmarts.llm import (
    collocations, common, exact_dedup, fingerprints, language, licenses, mixing, near_dedup, pieces, quality, spelling, token_counts,
    token_files, toxicity,
)
from salesmarts.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(common.table(spark, sf_dir, "documents"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of each document's pieces, and whether they decode to its text."""
    docs = common.table(spark, sf_dir, "documents")
    found = pieces.encoded(docs, _path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_pieces", F.xxhash64("pieces").alias("pieces_hash"), "round_trip")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    return toxicity.toxicity_scores(docs, labels)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(common.table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(common.table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(common.table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages_of(common.table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    return quality.quality_scores(docs, labels)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, _path("byte_bpe_50k.json"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(common.table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(common.table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as files; place, number and digest are read from them."""
    path = scratch_path(spark, "token-files")
    docs = common.table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, path, _path("word_bpe_49k.json"), end_id=1)
    return token_files.checked(spark, path)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(common.table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM normal
"""


# The CRC-32 goes bit by bit over the hexadecimal bytes. Two words of one length are near if they
# agree but for one place; of two others the shorter one is the longer one without a code point.
OP11_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(
             range(8 * strlen(coalesce(doc_id::VARCHAR, '') || ':' || run)),
             lambda i: (('0x' || substr(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), (2 * (i // 8) + 1)::BIGINT, 2))::BIGINT
                        >> (i % 8)) & 1)),
           lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) AS h
  FROM counted
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                   ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL
  SELECT DISTINCT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION ALL
  SELECT DISTINCT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, min(other) FILTER (other_n = most) AS other, any_value(most) AS other_n
  FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), walk AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL
  SELECT walk.word, formed.word, formed.form FROM walk JOIN formed ON walk.next = formed.word
)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk ON f.word = walk.word AND walk.next IS NULL
"""


OP13_SQL = r"""
WITH pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang,
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
), worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM placed, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)
), counts AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, k AS size, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE k >= 2 AND f >= 100),
covered AS (
  SELECT DISTINCT c.lang, c.phrase
  FROM (SELECT lang, w, size, a, unnest(range(1, size)) AS inner_size FROM candidates WHERE size > 2) AS long,
       (SELECT unnest(range(1, 5)) AS start) AS s, candidates c
  WHERE inner_size >= 2 AND start + inner_size - 1 <= long.size AND c.lang = long.lang
    AND c.phrase = array_to_string(long.w[start : start + inner_size - 1], ' ') AND 100 * long.a >= 100 * c.a
), cuts AS (
  SELECT lang, phrase, a, size, w, unnest(range(1, size)) AS k FROM candidates
  WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM covered)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ') AND x.k = c.k
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 :], ' ') AND y.k = c.size - c.k
), lowest AS (
  SELECT * EXCLUDE (k) FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000
"""


def llm_queries() -> dict[str, Query]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_pieces": op2_pieces,
        "op3_toxicity": op3_toxicity,
        "op4_near_dedup": op4_near_dedup,
        "op5_licenses": op5_licenses,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_language": op7_language,
        "op8_quality": op8_quality,
        "op9_token_counts": op9_token_counts,
        "op10_mixing": op10_mixing,
        "op11_spelling": op11_spelling,
        "op12_token_files": op12_token_files,
        "op13_collocations": op13_collocations,
    }


def llm_oracles() -> dict[str, str]:
    return {"op6_exact_dedup": OP6_SQL, "op11_spelling": OP11_SQL, "op13_collocations": OP13_SQL}
