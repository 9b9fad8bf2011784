"""Registered queries of the subpackage; ``ORACLES`` has those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crease.llm.common import read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


#: CRC-32 in SQL: its table, and the value of a text by it.
_CRC_TABLE = ("crc AS (SELECT list(v ORDER BY k) AS tab FROM (SELECT k, list_reduce(list_prepend(k, range(8)), lambda c, i: "
              "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) AS t(k)))")


def _crc32(text: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), "
            "lambda x: ('0x' || x)::BIGINT)), lambda c, b: xor(c // 256, tab[(xor(c, b) % 256 + 1)::INT])), 4294967295)")


#: Words, and distinct 5-word shingles, of a text in SQL.
_WORDS_SQL = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')"


def _grams_sql(words: str, n: str = "5") -> str:
    return f"list_distinct(list_transform(range(1, len({words}) - {n} + 2), lambda i: array_to_string({words}[i:i + {n} - 1], ' ')))"


@_query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crease.llm.decontaminate import contained_items
    return contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLES["op1_decontaminate"] = f"""
WITH items AS (SELECT item_id, w, CASE WHEN len(w) < 5 THEN len(w) ELSE 5 END AS n FROM (
    SELECT item_id, {_WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL) WHERE len(w) > 0),
wanted AS (SELECT item_id, n, {_grams_sql("w", "n")} AS grams FROM items),
sizes AS (SELECT DISTINCT n FROM wanted),
held AS (SELECT row, doc_id, n, UNNEST({_grams_sql("w", "n")}) AS gram
  FROM (SELECT row_number() OVER () AS row, doc_id, {_WORDS_SQL} AS w FROM documents), sizes),
parts AS (SELECT item_id, n, len(grams) AS size, UNNEST(grams) AS gram FROM wanted)
SELECT doc_id, item_id, COUNT(*) / ANY_VALUE(size) AS containment
FROM held JOIN parts USING (n, gram) GROUP BY row, doc_id, item_id HAVING COUNT(*) / ANY_VALUE(size) >= 0.8"""


@_query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crease.llm.bpe import digests
    return digests(read(spark, sf_dir, "documents"))


@_query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crease.llm.license import report, scan
    return report(scan(read(spark, sf_dir, "documents")))


@_query
def license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of ``op3_license_scan``, which SQL can express."""
    return op3_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


ORACLES["license_base"] = """
WITH words AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
phrases AS (SELECT * FROM (VALUES (['mit', 'license'], 'mit'), (['apache', 'license'], 'apache'),
  (['general', 'public', 'license'], 'gpl')) AS t(p, label)),
places AS (SELECT row, label, UNNEST(list_filter(range(len(w)), lambda i: w[i + 1:i + len(p)] = p)) AS place FROM words, phrases)
SELECT doc_id, len(w)::BIGINT AS n_words, COUNT(place) AS n_base, MIN(place) AS first_word, MAX(place) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM words LEFT JOIN places USING (row) GROUP BY row, doc_id, len(w)"""


@_query
def op4_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from crease.llm.htmlmain import extract, train_on
    pages = read(spark, sf_dir, "pages")
    return extract(pages, train_on(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crease.llm.jaccard import jaccard_classes
    return jaccard_classes(read(spark, sf_dir, "documents"))


ORACLES["op5_jaccard_join"] = f"""
WITH RECURSIVE docs AS (SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort({_grams_sql("w")}) END AS grams FROM (SELECT row_number() OVER () AS row, doc_id, {_WORDS_SQL} AS w FROM documents)),
texts AS (SELECT grams, MIN(row) AS node, COUNT(*) AS copies, MIN(doc_id) AS text_id FROM docs WHERE len(grams) > 0 GROUP BY grams),
parts AS (SELECT node, len(grams) AS size, UNNEST(grams) AS gram FROM texts),
links AS (SELECT a.node AS a, b.node AS b FROM parts a JOIN parts b ON a.gram = b.gram AND a.node <> b.node
  GROUP BY a.node, b.node, a.size, b.size HAVING COUNT(*) / (a.size + b.size - COUNT(*)) >= 0.8),
reach AS (SELECT node AS a, node AS b FROM texts UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
classes AS (SELECT reach.a AS node, MIN(text_id) AS class_id FROM reach JOIN texts ON texts.node = reach.b GROUP BY reach.a),
numbers AS (SELECT links.a AS node, SUM(copies) AS n FROM links JOIN texts ON texts.node = links.b GROUP BY links.a)
SELECT doc_id, CASE WHEN len(docs.grams) = 0 THEN doc_id ELSE class_id END AS class_id,
  CASE WHEN len(docs.grams) = 0 THEN doc_id ELSE text_id END AS text_id,
  CASE WHEN len(docs.grams) = 0 THEN 0 ELSE coalesce(n, 0) + copies - 1 END::BIGINT AS n_links
FROM docs LEFT JOIN texts ON texts.grams = docs.grams LEFT JOIN classes ON classes.node = texts.node LEFT JOIN numbers ON numbers.node = texts.node"""


@_query
def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid
    from pyspark.sql import functions as F
    from crease.llm.common import checkpoint_dir
    from crease.llm.shards import read_shards, write_shards
    folder = f"{checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}"
    if not write_shards(read(spark, sf_dir, "documents"), folder):
        return spark.createDataFrame([], "slot long, shard long, offset long, doc_id long, at long, n_tokens long, "
                                         "ids_sha256 string")
    return read_shards(spark, folder).withColumn("ids_sha256", F.sha2("ids", 256)).drop("ids")


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from crease.llm.quality import held_out, score, train_on
    docs = read(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", "text"), train_on(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crease.llm.pii import surrogates
    docs = read(spark, sf_dir, "documents")
    return surrogates(docs.select("doc_id", "text"), count_col="n_replaced")


@_query
def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crease.llm.ann import search
    return search(read(spark, sf_dir, "embeddings"))


@_query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crease.llm.tokencount import token_counts
    return token_counts(read(spark, sf_dir, "documents"))


@_query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from crease.llm.toxicity import TOXIC, held_out, score, train_on
    docs = read(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", "text"), train_on(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


@_query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crease.llm.spelling import variants
    return variants(read(spark, sf_dir, "documents"))


ORACLES["op12_spelling_variants"] = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT w, k, CASE WHEN doc_id IS NULL THEN 1 ELSE {_crc32("doc_id::VARCHAR || ':' || w")} END AS h FROM runs, crc),
words AS (SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word
    FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
less AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word AS w, b.word AS v FROM less a JOIN less b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT a.word, b.word FROM words a JOIN less b ON a.word = b.d
  UNION SELECT b.word, a.word FROM words a JOIN less b ON a.word = b.d),
best AS (SELECT w, count(*) AS n_near, arg_min(v, (-n, v)) AS near, max(n) AS near_n FROM pairs JOIN words ON word = v GROUP BY w),
known AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
    CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM words LEFT JOIN best ON w = word),
chain AS (SELECT word, word AS at FROM known UNION ALL SELECT c.word, k.form FROM chain c JOIN known k ON k.word = c.at WHERE k.form IS NOT NULL)
SELECT k.word, k.form, c.at AS root, k.n, k.n_near, k.form_n
FROM known k JOIN chain c ON c.word = k.word JOIN known l ON l.word = c.at WHERE l.form IS NULL"""


@_query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crease.llm.convtrie import prefix_trie
    return prefix_trie(read(spark, sf_dir, "conversations"))


ORACLES["op13_conversation_trie"] = f"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, n, c - c % 100 AS b, {_crc32("c::VARCHAR")} % 6 AS h FROM (SELECT c, count(*) AS n FROM t GROUP BY c), crc),
rebuilt AS (SELECT v.c, t.place AS d, t.r, t.x FROM convs v JOIN t ON t.c = v.b AND t.place <= v.h
  UNION ALL SELECT v.c, t.place - v.h + least(v.h, coalesce(f.n, 0)), t.r, t.x
  FROM convs v JOIN t ON t.c = v.c AND t.place > v.h LEFT JOIN convs f ON f.c = v.b),
path AS (SELECT c, d, length(x) AS size, list(sha256(length(r) || '|' || r || x)) OVER (PARTITION BY c ORDER BY d) AS p FROM rebuilt
  UNION ALL SELECT c, 0, 0, [] FROM convs),
node AS (SELECT path.d, p, min(path.c) AS c, count(*) AS n, max(size) AS size,
    sha256(coalesce(string_agg(path.c::VARCHAR, ',' ORDER BY path.c) FILTER (WHERE path.d = l.d), '')) AS ends
  FROM path JOIN (SELECT c, max(d) AS d FROM path GROUP BY c) l ON l.c = path.c GROUP BY path.d, p),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
above AS (SELECT unnest(range(k.d + 1)) AS ad, k.p, kids.n IS NULL AS leaf, (k.n - 1) * k.size AS saved
  FROM node k LEFT JOIN kids ON kids.d = k.d AND kids.p = k.p),
below AS (SELECT ad AS d, p[1:ad] AS p, count(*) FILTER (WHERE leaf) AS leaves, sum(saved) AS saved FROM above GROUP BY ALL)
SELECT k.c AS conv_id, k.d AS depth, q.c AS parent_conv_id, k.n AS n_convs, coalesce(kids.n, 0) AS n_children,
  below.leaves AS n_leaves, below.saved::BIGINT AS saved_tokens, k.ends AS ends_sha256
FROM node k JOIN below ON below.d = k.d AND below.p = k.p LEFT JOIN kids ON kids.d = k.d AND kids.p = k.p
LEFT JOIN node q ON q.d = k.d - 1 AND q.p = k.p[1:k.d - 1]"""
