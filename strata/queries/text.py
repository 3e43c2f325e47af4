"""Documents, text and vectors over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.cleaning import join_elements
from strata.operators import documents as Doc
from strata.operators import vectors as V
from strata.plans.documents import corpus_chunks, index_chunks, parsed_receipts, receipt_fields, search_chunks
from strata.queries.registry import query
from strata.session import materialise, scratch_path
from strata.sinks.tables import pack_batches
from strata.sources import tables

# ------------------------------------------------------------------ documents


# The same blocks by text replacement: block starts and ends become control
# characters, other tags go, entities are resolved. It relies on the shape of
# these pages (one leading list, no nested blocks); the parser does not.
BLOCKS = r"""
    clean AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script.*?</script>', '', 'g'), '(?s)<style.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS h FROM pages),
    marked AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(h, '<(h1|h2|h3|p|li|code)( [^>]*)?>', chr(1) || '\1' || chr(2), 'g'),
                      '</(h1|h2|h3|p|li|code|ul|article)>', chr(3), 'g'), '<[^>]*>', '', 'g') AS h FROM clean),
    pieces AS (SELECT page_id, unnest(string_split(h, chr(1))[2:]) AS piece, generate_subscripts(string_split(h, chr(1))[2:], 1) AS idx FROM marked),
    texts AS (SELECT page_id, idx, split_part(piece, chr(2), 1) AS html_tag, regexp_replace(replace(replace(
                     regexp_replace(split_part(split_part(piece, chr(2), 2), chr(3), 1), '^\s+|\s+$', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&amp;?', '&', 'g') AS content FROM pieces),
    blocks AS (SELECT page_id, 'ul' AS html_tag, string_agg(content, '' ORDER BY idx) AS content, 0 AS idx FROM texts WHERE html_tag = 'li' GROUP BY 1
               UNION ALL SELECT page_id, html_tag, content, idx FROM texts WHERE content <> ''),
    placed AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY idx) - 1 AS position, html_tag, content FROM blocks)"""


@query("TXT-02 UDF-02", f"WITH {BLOCKS} SELECT page_id, position, html_tag, content FROM placed")
def doc_blocks(spark, d):
    (pages,) = tables(spark, d, "pages")
    return Doc.doc_blocks(pages, "page_id", "html")


@query("TXT-02 TXT-03 UDF-03", f"""
    WITH {BLOCKS} SELECT html_tag, count(*) AS rows, count(*) AS row_ids, count(DISTINCT page_id) AS pages FROM placed GROUP BY 1""")
def doc_block_counts(spark, d):
    (pages,) = tables(spark, d, "pages")
    rows = Doc.chunk_rows(Doc.doc_blocks(pages, "page_id", "html"), "page_id")
    return rows.groupBy("html_tag").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("row_id").alias("row_ids"),
                                        F.countDistinct("page_id").alias("pages"))


MATTER = r"""'---' || chr(10) || 'title: "Doc ' || doc_id || '"' || chr(10) || 'date: 2024-01-' || lpad(CAST(1 + doc_id % 28 AS {text}), 2, '0') || ' 10:00:00' || chr(10)
    || 'categories: [' || lang || ', all]' || chr(10) || 'tags:' || chr(10) || '  - ' || source || chr(10) || '  - t' || (doc_id % 3) || chr(10) || '---' || chr(10)"""


def _markdown(spark, d) -> DataFrame:
    """Documents as Markdown files: front matter, then the text as it is."""
    (documents,) = tables(spark, d, "documents")
    head = MATTER.format(text="STRING")
    return documents.select("doc_id", "lang", "source", F.expr(f"{head} || text").alias("md"))


@query("TXT-01 UDF-01", """
    SELECT doc_id, 'Doc ' || doc_id AS title, '2024-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') || ' 10:00' AS date,
           lang || '|all' AS categories, source || '|t' || (doc_id % 3) AS tags, length(text) AS body_length FROM documents""")
def front_matter(spark, d):
    rows = _markdown(spark, d).select("doc_id", Doc.front_matter("md").alias("m"), F.length(Doc.body("md")).alias("body_length"))
    return rows.select("doc_id", "m.title", F.date_format("m.date", "yyyy-MM-dd HH:mm").alias("date"), F.array_join("m.categories", "|").alias("categories"),
                       F.array_join("m.tags", "|").alias("tags"), F.col("body_length").cast("long").alias("body_length"))


@query("TXT-01 TXT-02 TXT-03 JOB-08", r"""
    SELECT 'p' AS html_tag, lang AS category, sum(n)::BIGINT AS rows, count(*) FILTER (WHERE n > 0) AS files FROM (
      SELECT lang, len(list_filter(string_split_regex(text, '\n\s*\n'), lambda x: trim(x) <> '')) AS n FROM documents) GROUP BY 2""")
def corpus_block_counts(spark, d):
    """Markdown corpus to block rows with the metadata of their documents."""
    docs = _markdown(spark, d).select(
        F.concat(F.lit("/docs/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_path"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("file_name"), F.col("md").alias("content"))
    return corpus_chunks(docs).groupBy("html_tag", F.element_at("categories", 1).alias("category")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("file_path").alias("files"))


PARSED = """CASE WHEN conv_id % 10 = 3 THEN '{"error_status":"unreadable"}' ELSE to_json(named_struct('document', named_struct('elements',
    transform(split(text, '\\n'), x -> named_struct('content', x, 'type', 'text'))))) END"""


@query("TXT-04 JOB-09", """
    SELECT conv_id, turn, CASE WHEN conv_id % 10 = 3 THEN 'unreadable' END AS parse_error,
           CASE WHEN conv_id % 10 <> 3 THEN replace(text, chr(10), chr(10) || chr(10)) END AS parse_text FROM conversations""")
def parsed_text(spark, d):
    (conversations,) = tables(spark, d, "conversations")
    rows = conversations.select("conv_id", "turn", F.expr(PARSED).alias("parse_output"))
    return parsed_receipts(rows).select("conv_id", "turn", "parse_error", "parse_text")


@query("TXT-04", "SELECT count(*) AS rows, count(*) FILTER (WHERE conv_id % 10 <> 3) AS with_text FROM conversations")
def joined_elements(spark, d):
    (conversations,) = tables(spark, d, "conversations")
    return conversations.select(join_elements(F.expr(PARSED)).alias("t")).agg(F.count(F.lit(1)).alias("rows"), F.count("t").alias("with_text"))


@query("PRJ-18 JOB-09", """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS merchant_name, CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS total,
           CASE WHEN o_orderkey % 5 <> 0 THEN floor(o_totalprice) END AS tax FROM orders""")
def receipt_fields_typed(spark, d):
    (orders,) = tables(spark, d, "orders")
    result = F.to_json(F.struct(
        F.col("o_custkey").cast("string").alias("merchant_name"), F.col("o_totalprice").alias("total"),
        F.when(F.col("o_orderkey") % 5 != 0, F.floor("o_totalprice").cast("string")).otherwise("n/a").alias("tax")))
    rows = receipt_fields(orders.select("o_orderkey", result.alias("extract_result")))
    return rows.select("o_orderkey", "merchant_name", F.col("total").cast("double").alias("total"), F.col("tax").cast("double").alias("tax"))


MD_BLOCKS = r"""
    WITH c AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment, n_name AS nation FROM customer JOIN nation ON n_nationkey = c_nationkey),
    b AS (
      SELECT k, 0 AS position, 'h1' AS html_tag, name AS content FROM c
      UNION ALL SELECT k, 1, 'p', 'In ' || nation || ' since 1995, see the list' || chr(10) || 'and a*b with x_y_z' FROM c
      UNION ALL SELECT k, 2, 'code', 'a*b' FROM c
      UNION ALL SELECT k, 3, 'h2', segment FROM c
      UNION ALL SELECT k, 4, 'li', 'first' FROM c
      UNION ALL SELECT k, 5, 'li', 'second' || chr(10) || chr(10) || segment || chr(10) || 'strong inside' FROM c
      UNION ALL SELECT k, 6, 'ul', segment || chr(10) || 'strong inside' FROM c
      UNION ALL SELECT k, 7, 'li', segment FROM c
      UNION ALL SELECT k, 8, 'li', 'strong inside' FROM c
      UNION ALL SELECT k, 10, 'p', 'quoted ' || nation || ' & lazy' FROM c
      UNION ALL SELECT k, 9, 'code', 'if a < ' || k || ':' || chr(10) || chr(10) || '    # no heading' FROM c
      UNION ALL SELECT k, 11, 'code', 'indented *' || k || '*' FROM c
      UNION ALL SELECT k, 12, 'h3', 'End of ' || name FROM c)
    SELECT k, position, html_tag, content FROM b"""


@query("TXT-02 UDF-02 UDF-03", MD_BLOCKS)
def markdown_blocks(spark, d):
    """Documents rendered with headings, ordered and nested lists, quotes, fences, indented code, links and emphasis."""
    customer, nation = tables(spark, d, "customer", "nation")
    # Short rows become long documents: dealt out before that, or the few splits of a small file hold all the parsing.
    customer = customer.repartition(4 * spark.sparkContext.defaultParallelism)
    rows = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    name, segment, place, key = F.col("c_name"), F.col("c_mktsegment"), F.col("n_name"), F.col("c_custkey").cast("string")
    md = F.concat(
        F.lit("---\ntitle: x\n---\n"), name, F.lit("\n=====\n\nIn **"), place, F.lit("** since *1995*, see [the list](http://x.y/l \"t\")\nand `a*b` with x_y_z\n\n## "), segment,
        F.lit(" ##\n\n#### left out\n\n1. first\n2. second\n   - "), segment, F.lit("\n   - __strong__ inside\n\n```sql\nif a < "), key,
        F.lit(":\n\n    # no heading\n```\n\n> quoted "), place, F.lit(" &\nlazy\n\n    indented *"), key, F.lit("*\n\n***\n\n### End of "), name)
    docs = rows.select(F.col("c_custkey").alias("k"), md.alias("md"))
    return Doc.markdown_blocks(docs, "k", "md").withColumn("content", F.regexp_replace("content", "&\\s", "& "))


# -------------------------------------------------------------------- vectors

COSINE = "round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 9)"


def _first_vector(embeddings: DataFrame) -> list[float]:
    return list(embeddings.orderBy("vec_id").select("embedding").first()[0])


@query("VEC-02", f"""
    SELECT vec_id, score FROM (SELECT e.vec_id, {COSINE} AS score FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q)
    ORDER BY score DESC, vec_id LIMIT 20""")
def similar_topk(spark, d):
    (embeddings,) = tables(spark, d, "embeddings")
    return V.similar(embeddings, _first_vector(embeddings), 20, "vec_id", "embedding")


@query("VEC-03", f"""
    SELECT vec_id, score FROM (SELECT e.vec_id, {COSINE} AS score FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q
      WHERE NOT list_contains([e.label, e.label + 1], 4)) ORDER BY score DESC, vec_id LIMIT 20""")
def similar_filtered(spark, d):
    (embeddings,) = tables(spark, d, "embeddings")
    tagged = embeddings.withColumn("tags", F.array(F.col("label"), F.col("label") + 1))
    return V.similar(tagged, _first_vector(embeddings), 20, "vec_id", "embedding", where=~F.array_contains("tags", 4))


@query("VEC-04", f"""
    WITH q AS (SELECT vec_id AS qid, embedding FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1)
    SELECT query_id, vec_id, score, rank FROM (
      SELECT CAST(qid AS VARCHAR) AS query_id, e.vec_id, {COSINE} AS score, row_number() OVER (PARTITION BY qid ORDER BY {COSINE} DESC, e.vec_id) AS rank FROM embeddings e, q)
    WHERE rank <= 10""")
def similar_batch(spark, d):
    """Ten nearest vectors for the first vector of every label."""
    from strata.operators.windows import latest_per_key

    (embeddings,) = tables(spark, d, "embeddings")
    heads = latest_per_key(embeddings, ["label"], [F.asc("vec_id")])
    found = V.similar_join(heads, embeddings, 10, query_id="vec_id", query_vec="embedding", id_col="vec_id", vec_col="embedding")
    return found.withColumn("rank", F.col("rank").cast("long"))


@query("VEC-01", """
    SELECT doc_id, CASE WHEN trim(text) = '' THEN 'empty text' END AS error, CASE WHEN trim(text) <> '' THEN len(string_split_regex(lower(text), '\\s')) END AS words
    FROM (SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN '  ' ELSE trim(text) END AS text FROM documents)""")
def embed_docs(spark, d):
    """Hashed term counts of every document; their sum is its number of words."""
    (documents,) = tables(spark, d, "documents")
    rows = documents.select("doc_id", F.when(F.col("doc_id") % 50 == 7, "  ").otherwise(F.trim("text")).alias("text"))
    counts = V.embed(rows, "text", fn=lambda df, t, o: V.hashing_tf(df, t, o, normalize=False))
    words = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).cast("long")
    return counts.select("doc_id", F.col("embedding_error").alias("error"), words.alias("words"))


@query("VEC-05", r"""
    WITH w AS (SELECT list_distinct(string_split_regex(trim(lower(text)), '\s+')) AS words FROM benchmark ORDER BY item_id LIMIT 1)
    SELECT doc_id, text_score FROM (
      SELECT doc_id, len(list_intersect(list_distinct(string_split_regex(lower(trim(text)), '\s+')), (SELECT words FROM w))) AS text_score FROM documents)
    WHERE text_score > 0 ORDER BY text_score DESC, doc_id LIMIT 20""")
def text_search(spark, d):
    """The text half of the hybrid search: distinct query words per document."""
    documents, benchmark = tables(spark, d, "documents", "benchmark")
    wanted = benchmark.orderBy("item_id").select("text").first()[0]
    return V.text_overlap(documents, wanted, 20, "doc_id", "text").withColumn("text_score", F.col("text_score").cast("long"))


@query("VEC-05")
def hybrid_search(spark, d):
    """Documents for the text of the first benchmark item."""
    documents, benchmark = tables(spark, d, "documents", "benchmark")
    wanted = benchmark.orderBy("item_id").limit(1)
    vector = V.embed(wanted, "text").select("text", "embedding").first()
    rows = V.embed(documents, "text")
    return V.hybrid(rows, vector["text"], list(vector["embedding"]), 20, id_col="doc_id", text_col="text", vec_col="embedding")


FUSED = r"""
    WITH w AS (SELECT list_distinct(string_split_regex(lower(trim(text)), '\s+')) AS words FROM benchmark ORDER BY item_id LIMIT 1),
    q AS (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1),
    t AS (SELECT doc_id, len(list_intersect(list_distinct(string_split_regex(lower(trim(text)), '\s+')), words)) AS s FROM documents, w),
    v AS (SELECT e.vec_id AS doc_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 9) AS s FROM embeddings e, q WHERE e.vec_id IN (SELECT doc_id FROM documents)),
    r AS (SELECT doc_id, row_number() OVER (ORDER BY s DESC, doc_id) AS rank FROM t WHERE s > 0 UNION ALL SELECT doc_id, row_number() OVER (ORDER BY s DESC, doc_id) FROM v)
    SELECT doc_id, sum(1.0::DOUBLE / (60 + rank)) AS fused_score FROM r GROUP BY 1 ORDER BY fused_score DESC, doc_id LIMIT 20"""


@query("VEC-05", FUSED)
def hybrid_fusion(spark, d):
    """Whole texts with the stored vectors of the same ids: the fused top 20 without ranking either list."""
    documents, embeddings, benchmark = tables(spark, d, "documents", "embeddings", "benchmark")
    wanted = benchmark.orderBy("item_id").select("text").first()[0]
    rows = documents.join(embeddings, documents["doc_id"] == embeddings["vec_id"], "left").select("doc_id", "text", "embedding")
    return V.hybrid(rows, wanted, _first_vector(embeddings), 20, id_col="doc_id", text_col="text", vec_col="embedding")


@query("VEC-05 JOB-08", FUSED)
def hybrid_postings(spark, d):
    """The same from stored posting lists and stored vectors."""
    documents, embeddings, benchmark = tables(spark, d, "documents", "embeddings", "benchmark")
    wanted = benchmark.orderBy("item_id").select("text").first()[0]
    path = scratch_path(spark, "postings")
    V.write_postings(documents, path, id_col="doc_id", text_col="text")
    vectors = embeddings.withColumnRenamed("vec_id", "doc_id").join(documents.select("doc_id"), "doc_id", "left_semi")
    return V.hybrid_indexed(spark.read.parquet(path), vectors, wanted, _first_vector(embeddings), 20, id_col="doc_id", vec_col="embedding")


@query("JOB-08 VEC-03", f"""
    SELECT e.vec_id AS row_id, score, text AS content FROM (SELECT e.vec_id, {COSINE} AS score FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q) e
    JOIN documents ON doc_id = e.vec_id WHERE NOT (lang = 'en') ORDER BY score DESC, row_id LIMIT 15""")
def search_chunk_index(spark, d):
    """The search step of the corpus job: best chunks without a tag, with their whole texts."""
    documents, embeddings = tables(spark, d, "documents", "embeddings")
    chunks = documents.select(F.col("doc_id").alias("row_id"), F.col("text").alias("content"), F.array("lang").alias("tags"))
    found = search_chunks(embeddings.withColumnRenamed("vec_id", "row_id"), chunks, _first_vector(embeddings), 15, without_tag="en")
    return found.select("row_id", "score", "content")


@query("VEC-04", f"""
    SELECT query_id, vec_id, score, rank FROM (
      SELECT CAST(q.vec_id AS VARCHAR) AS query_id, e.vec_id, {COSINE} AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY {COSINE} DESC, e.vec_id) AS rank FROM embeddings e, embeddings q)
    WHERE rank <= 3""")
def similar_all(spark, d):
    """Three nearest vectors of every vector: as many queries as rows, block against block."""
    (embeddings,) = tables(spark, d, "embeddings")
    found = V.similar_join(embeddings, embeddings, 3, query_id="vec_id", query_vec="embedding", id_col="vec_id", vec_col="embedding")
    return found.withColumn("rank", F.col("rank").cast("long"))


@query("VEC-06", f"""
    SELECT vec_id, score FROM (SELECT e.vec_id, {COSINE} AS score FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q)
    ORDER BY score DESC, vec_id LIMIT 10""")
def ann_neighbours(spark, d):
    """Ten nearest from stored inverted lists, read until no other list can hold a nearer row."""
    (embeddings,) = tables(spark, d, "embeddings")
    index = V.VectorIndex.build(embeddings, scratch_path(spark, "index"), id_col="vec_id", vec_col="embedding")
    return index.search(_first_vector(embeddings), 10, exact=True).withColumnRenamed("id", "vec_id")


@query("VEC-06", "SELECT count(*) AS queries, 10 * count(*) AS rows, true AS recalled FROM embeddings WHERE vec_id % 20 = 0")
def ann_recall(spark, d):
    """One stored index answers two batches of queries, together every twentieth
    vector; at least 0.95 of the exact ten nearest of each are found."""
    (embeddings,) = tables(spark, d, "embeddings")
    path = scratch_path(spark, "index")
    V.VectorIndex.build(embeddings, path, id_col="vec_id", vec_col="embedding")
    index = V.VectorIndex(spark, path)  # read again from storage
    asked = embeddings.filter("vec_id % 20 = 0")
    near = [index.search_many(asked.filter(F.col("vec_id") % 40 == r), 10, query_id="vec_id", query_vec="embedding", id_col="vec_id") for r in (0, 20)]
    found = near[0].unionByName(near[1])
    exact = V.similar_join(asked, embeddings, 10, query_id="vec_id", query_vec="embedding", id_col="vec_id", vec_col="embedding")
    # A row as near as the tenth counts, whichever of equal ones the exact list shows.
    tenth = exact.groupBy("query_id").agg(F.min("score").alias("tenth"))
    hits = found.join(tenth, "query_id").agg(F.countDistinct("query_id").alias("queries"), F.count(F.lit(1)).alias("rows"), F.avg((F.col("score") >= F.col("tenth")).cast("int")).alias("recall"))
    return hits.select("queries", "rows", (F.col("recall") >= 0.95).alias("recalled"))


@query("VEC-07 STR-09", """
    SELECT 'insert' AS change, count(*) AS rows FROM documents WHERE doc_id % 4 = 0
    UNION ALL SELECT 'update', count(*) FROM documents WHERE doc_id % 4 = 1 UNION ALL SELECT 'kept', count(*) FROM documents WHERE doc_id % 4 > 1""")
def sync_embeddings(spark, d):
    """An index over three quarters of the documents meets an extract in which
    one quarter has changed and one is new."""
    (documents,) = tables(spark, d, "documents")
    empty = spark.createDataFrame([], "doc_id long, content_hash string, embedding array<float>, embedding_error string")
    first = V.sync_embeddings(empty, documents.filter("doc_id % 4 <> 0"), id_col="doc_id", text_col="text")
    index = materialise(first, "index")
    changed = documents.withColumn("text", F.when(F.col("doc_id") % 4 == 1, F.concat("text", F.lit(" changed"))).otherwise(F.col("text")))
    synced = V.sync_embeddings(index, changed, id_col="doc_id", text_col="text", mark_changes=True)
    return synced.groupBy(F.coalesce("_change_type", F.lit("kept")).alias("change")).agg(F.count(F.lit(1)).alias("rows"))


@query("VEC-07 JOB-08", "SELECT count(*) AS rows, count(*) AS vectors, 0::BIGINT AS errors FROM conversations WHERE trim(text) <> ''")
def index_conversation_texts(spark, d):
    (conversations,) = tables(spark, d, "conversations")
    chunks = conversations.filter(F.trim("text") != "").select(F.xxhash64("conv_id", "turn", "role", "text").alias("row_id"), F.col("text").alias("content"))
    chunks = chunks.groupBy("row_id").agg(F.min("content").alias("content"), F.count(F.lit(1)).alias("n"))
    index = index_chunks(None, chunks).join(chunks.select("row_id", "n"), "row_id")
    return index.agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("embedding").isNotNull(), F.col("n"))).alias("vectors"),
                     F.count("embedding_error").alias("errors"))


@query("SNK-12 UDF-03", """
    SELECT count(*) AS documents, 250::BIGINT AS largest_batch, true AS all_sent FROM lineitem""")
def pack_upload_batches(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    status = pack_batches(lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "l_extendedprice"), "id")
    return status.agg(F.sum("documents").alias("documents"), F.max("documents").alias("largest_batch"),
                      F.every(F.col("upload_status") == "Success").alias("all_sent"))
