"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import alignment, ann, decontamination, licences, links, minhash, packing, pages, pii, quality, repeats, spelling, subwords
from sparkloom.session import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole document, as digests."""
    docs = table(spark, sf_dir, "documents")
    return subwords.digests(subwords.encode_decode(docs, vocabulary_path("piece_bpe_32k.model")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens that each hold the sources' proportions."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json")).withColumnRenamed("queue", "source")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on runs of four words from a similarity of 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


OP4_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3])) END AS s
  FROM worded),
sized AS (SELECT doc_id, len(s) AS n FROM shingled),
flat AS (SELECT doc_id, unnest(s) AS sh FROM shingled),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM flat a JOIN flat b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT r.doc_id, n AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reach r JOIN sized USING (doc_id) GROUP BY r.doc_id, n
"""


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of strings of 400 bytes that occur twice or more, as digests; words in repeated strings of 51 words."""
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_repeated_words")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.digests(pii.find_spans(table(spark, sf_dir, "documents")))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of each row whose vec_id is divisible by 100, by Euclidean distance."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 100 = 0"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors linked by a cosine of 0.9 or more."""
    return links.near_duplicates(table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE n AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS len FROM embeddings),
linked AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND a.len > 0 AND b.len > 0
           AND list_dot_product(a.v, b.v) / (a.len * b.len) >= 0.9),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN linked l ON r.other = l.a),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
many AS (SELECT a AS vec_id, count(*) AS c FROM linked GROUP BY a)
SELECT low.vec_id, coalesce(c, 0) AS n_links, component_id, low.vec_id = component_id AS kept FROM low LEFT JOIN many USING (vec_id)
"""


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned token groups of two vocabularies for every document, as digests, with corpus-wide link counts."""
    docs = table(spark, sf_dir, "documents")
    aligned = alignment.align(docs, vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"), as_text=False)
    return aligned.withColumnRenamed("groups", "groups_sha256")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie inside windows of benchmark items."""
    found = decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), digest.alias("items_sha256"), "contaminated")


OP12_SQL = r"""
WITH worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT *, least(10, len(w)) AS k FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS win FROM sized),
sizes AS (SELECT DISTINCT k FROM windows),
numbered AS (SELECT row_number() OVER () AS r, * FROM worded),
places AS (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM numbered, sizes WHERE len(w) >= k),
runs AS (SELECT r, k, i, array_to_string(w[i:i+k-1], ' ') AS win FROM places),
found AS (SELECT r, i, runs.k, item_id FROM runs JOIN windows ON runs.k = windows.k AND runs.win = windows.win),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM found) GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM numbered LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every long word of the documents with its more frequent spelling."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(0, 8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(0, 256) AS r(i))),
lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s FROM documents),
runs AS (SELECT doc_id, run, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(s, '[A-Za-zÀ-ÿ]+')) AS run FROM lowered) WHERE length(run) >= 7 GROUP BY ALL),
keyed AS (SELECT doc_id, run, c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2*i+1 : 2*i+2])::BIGINT),
    lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]), 4294967295::BIGINT)) AS h FROM keyed, crc),
made AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
shorter AS (SELECT word, n, i, left(word, i::INT - 1) || substr(word, i::INT + 1) AS d FROM places),
inserted AS (SELECT DISTINCT w.word AS a, w.n AS n_a, s.word AS b, s.n AS n_b FROM words w JOIN shorter s ON w.word = s.d),
near AS (
  SELECT a.word AS a, b.word AS b, b.n AS n FROM shorter a JOIN shorter b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION ALL SELECT a, b, n_b FROM inserted UNION ALL SELECT b, a, n_a FROM inserted),
best AS (SELECT a AS word, count(*) AS n_near, min_by(b, (-n, b)) AS b, max(n) AS most FROM near GROUP BY a),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN b END AS form, CASE WHEN most >= 10 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain(word, last) AS (SELECT word, word FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.last AS root FROM chain c JOIN formed f ON f.word = c.last WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, tuple[Query, str | None]] = {
    "op8_sentencepiece": (op8_sentencepiece, None),
    "op3_packing": (op3_packing, None),
    "op1_quality": (op1_quality, None),
    "op4_minhash": (op4_minhash, OP4_SQL),
    "op7_suffix_array": (op7_suffix_array, None),
    "op10_pii": (op10_pii, None),
    "op2_ann": (op2_ann, None),
    "op9_embedding_dedup": (op9_embedding_dedup, OP9_SQL),
    "op5_licences": (op5_licences, None),
    "op6_html": (op6_html, None),
    "op11_alignment": (op11_alignment, None),
    "op12_decontamination": (op12_decontamination, OP12_SQL),
    "op13_spelling": (op13_spelling, OP13_SQL),
    "pipeline": (pipeline, None),
}


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
