"""Bronze-, silver- and corpus-shaped inputs from the driver tables, in Spark and in SQL.

`documents` with `events` (author, score, source) stand for posts, `conversations` for
articles. The url is a digest of the text, so repeated texts give repeated urls.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tertulia.functions.sentiment import with_sentiment
from tertulia.functions.text import WHITESPACE, clean_text
from tertulia.functions.wordlists import STOPWORDS
from tertulia.operators.corpus import COLUMNS, dedup_url, union_sources

# Words that do occur in the driver documents; the default lists do not.
POSITIVE = ("that", "with", "pour", "avec")
NEGATIVE = ("this", "from", "dans", "nicht")
KEYWORDS = ("that", "pour", "nicht", "ción")
CORPUS_ORDER = ("source", "day", "author", "score", "title")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    docs = table(spark, sf, "documents")
    return docs.join(events, docs.doc_id == events.event_id, "left")


def api_posts(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).selectExpr(
        "doc_id div 100 AS page", "doc_id % 100 AS pos",
        "substring_index(text, '\\n', 1) AS title", "text AS selftext",
        "concat('u', user_id) AS author",
        "cast(1704067200 + (doc_id % 30) * 86400 + doc_id AS double) AS created_utc",
        "cast(floor(value) AS bigint) AS score",
        "concat('/r/', doc_id) AS permalink",
        "CASE WHEN doc_id % 13 = 0 THEN true WHEN doc_id % 13 = 1 THEN NULL ELSE false END AS pinned",
    )


def api_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Raw API pages of at most 100 posts."""
    post = F.struct("title", "selftext", "author", "created_utc", "score", "permalink", "pinned")
    children = F.transform(
        F.array_sort(F.collect_list(F.struct("pos", post.alias("data")))), lambda c: F.struct(c["data"].alias("data")))
    return api_posts(spark, sf).groupBy("page").agg(children.alias("children")).select(
        "page", F.to_json(F.struct(F.struct("children").alias("data"))).alias("value"))


def raw_posts(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).selectExpr(
        "substring_index(text, '\\n', 1) AS title", "text",
        "CASE WHEN user_id % 10 = 3 THEN NULL WHEN user_id % 10 = 4 THEN '' ELSE concat('u', user_id) END AS author",
        "cast(1704067200 + (doc_id % 30) * 86400 + doc_id AS string) AS date",
        "CASE WHEN event_type = 'error' THEN 'n/a' ELSE cast(value AS string) END AS score",
        "concat('https://posts.example/', md5(text)) AS url",
        "event_type AS source",
        "concat('posts_', doc_id * 7 % 11, '.json') AS source_file", "doc_id AS pos",
    )


ESCAPED = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
#: What the listing says of a document. A link is a digest of the text, so that copies repeat it.
NEWS = {
    "link": "CASE WHEN doc_id % 19 = 3 THEN '' ELSE concat('https://news.example/', md5(text)) END",
    "name": "CASE WHEN doc_id % 4 IN (0, 3) THEN concat('Autor ', lang, ' ', source) ELSE '' END",
    "stamp": "CASE WHEN doc_id % 3 = 0 THEN concat('2026-04-', lpad({day}, 2, '0'), 'T21:47:13-05:00') WHEN doc_id % 3 = 1 THEN 'ayer' ELSE '' END",
}


def _news(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("heading", F.expr("CASE WHEN doc_id % 23 = 4 THEN ' ' ELSE substring_index(text, '\n', 1) END"))
    news = {k: v.format(day="cast(doc_id % 28 + 1 AS string)") for k, v in NEWS.items()}
    return docs.selectExpr("doc_id", "doc_id div 10 + 1 AS page", "lang", "source", "text", f"{ESCAPED.format('heading')} AS heading",
                           f"{ESCAPED.format('text')} AS body", *(f"{v} AS {k}" for k, v in news.items()))


def listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Listings of ten documents in the page template: items without the post mark, without link or
    title, authors under another class, dates as attribute, as text or missing, and three kinds of
    next links."""
    item = """concat('<article class="post tag-', lang, ' x tag-', source, '-y"', CASE WHEN doc_id % 17 = 5 THEN '' ELSE concat(' data-post-id="', doc_id, '"') END,
        '><h2 class="entry-title"><a href=" ', link, ' "> ', heading, '</a></h2>',
        CASE doc_id % 4 WHEN 1 THEN '' WHEN 2 THEN '<span class="vcard author"><a>Otro</a></span>'
          ELSE concat('<span class="author vcard"><a href="/x"> ', name, '</a></span>') END,
        CASE doc_id % 3 WHEN 0 THEN concat('<time class="entry-date" datetime="', stamp, '">abril</time>')
          WHEN 1 THEN concat('<time class="entry-date"> ', stamp, ' </time>') ELSE '' END,
        CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat('<div class="entry-wrapper"><p> ', body, '</p><p>otro</p></div>') END, '</article>')"""
    pages = _news(spark, sf).selectExpr("page", "doc_id", f"{item} AS item").groupBy("page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "item"))), lambda x: x["item"]), "\n").alias("items"))
    more = """CASE page % 3 WHEN 0 THEN '<div class="nav-links"><a class="next page-numbers" href="/x">&raquo;</a></div>'
        WHEN 1 THEN '<nav class="pagination"><a class="prev">1</a></nav>' ELSE '<a class="page-numbers next" href="/x">mas</a>' END"""
    rel = "CASE WHEN page % 4 = 1 THEN concat('<a rel=\"next\" href=\"/siguiente/', page, '\">x</a>') ELSE '' END"
    return pages.selectExpr("page", f"concat('<html><body>', items, {more}, {rel}, '</body></html>') AS html")


def article_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The page of every link of the listing, one a link: a paragraph for each line, and tags, some
    of them twice or blank."""
    lines = "transform(split(body, '\n'), x -> concat('<p>', x, '</p>'))"
    tags = """CASE WHEN length(text) % 3 = 0 THEN '' ELSE concat('<a rel="tag">', lang, '</a><a rel="nofollow tag"> de ', lang, ' </a><a rel="tag">',
        lang, '</a><a rel="tag"> </a>') END"""
    pages = _news(spark, sf).where("link <> ''").dropDuplicates(["link"])
    return pages.selectExpr("link AS url", f"concat('<article><div class=\"post entry-content\">', array_join({lines}, ''), '</div>', {tags}, '</article>') AS html")


def card_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A card for each document, in a template of its own kind."""
    return _news(spark, sf).selectExpr("doc_id", """concat('<article><h3>', heading, '</h3>',
        CASE WHEN link = '' THEN '' ELSE concat('<a href="', CASE WHEN doc_id % 2 = 0 THEN link ELSE concat('/n/', doc_id) END, '">mas</a>') END,
        '<div class="byline">', name, '</div>', CASE doc_id % 3 WHEN 0 THEN concat('<time datetime="', stamp, '">abril</time>')
          WHEN 1 THEN concat('<time datetime=""> ', stamp, ' </time>') ELSE '' END, '<p>', body, '</p></article>') AS html""")


def raw_articles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").selectExpr(
        "substring_index(text, '\\n', 1) AS titulo",
        "CASE WHEN role = 'system' THEN NULL ELSE role END AS autor",
        "CASE WHEN conv_id % 17 = 0 THEN 'sin fecha' ELSE concat('2024-01-', lpad(conv_id % 28 + 1, 2, '0'), "
        "'T', lpad(turn * 5 % 24, 2, '0'), ':30:00-05:00') END AS fecha",
        "concat('https://articles.example/', md5(text)) AS url",
        "substring(text, 1, 300) AS extracto", "cast(NULL AS string) AS etiquetas", "text AS contenido",
        "'chat' AS fuente",
        "concat('articles_', conv_id % 5, '.json') AS source_file", "conv_id * 1000 + turn AS pos",
    )


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """Typed and cleaned posts with nulls left in, for the quality figures."""
    return raw_posts(spark, sf).select(
        "title", clean_text("title").alias("title_clean"), "text", clean_text("text").alias("text_clean"), "author",
        F.timestamp_seconds(F.col("date").cast("double")).alias("date"),
        F.expr("coalesce(cast(try_cast(score AS double) AS bigint), 0)").alias("score"), "url", "source")


def articles(spark: SparkSession, sf: str) -> DataFrame:
    return raw_articles(spark, sf).select(
        "titulo", "autor", F.try_to_timestamp("fecha").alias("fecha"), "contenido",
        clean_text("contenido").alias("contenido_clean"), "url")


def corpus_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every source with its whole raw text, before the dedupe."""
    from_posts = raw_posts(spark, sf).select(
        "url", "title", "text", "author",
        F.to_date(F.timestamp_seconds(F.col("date").cast("double"))).alias("day"),
        F.expr("coalesce(cast(try_cast(score AS double) AS bigint), 0)").alias("score"), "source")
    from_articles = raw_articles(spark, sf).select(
        "url", F.col("titulo").alias("title"), F.col("contenido").alias("text"), F.col("autor").alias("author"),
        F.to_date(F.try_to_timestamp("fecha")).alias("day"), F.lit(0).cast("bigint").alias("score"),
        F.lit("chat").alias("source"))
    return union_sources([from_posts, from_articles])


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated, cleaned and scored. Only the surviving rows are cleaned; the title of
    a post counts as text."""
    first = dedup_url(corpus_rows(spark, sf), CORPUS_ORDER).select(*COLUMNS)
    title = F.when(F.col("source").eqNullSafe("chat"), None).otherwise(clean_text("title"))
    cleaned = first.withColumn("text", F.concat_ws(" ", title, clean_text("text")))
    return with_sentiment(cleaned, "text", POSITIVE, NEGATIVE, separator=" ")


def corpus_facts(spark: SparkSession, sf: str) -> DataFrame:
    """The deduplicated corpus without its text, for marts that read none."""
    return dedup_url(corpus_rows(spark, sf).drop("text"), CORPUS_ORDER)


# The same in SQL.

WS = "'" + WHITESPACE + "'"
WORD_SPLIT = r"[^\p{L}\p{N}_]+"


def in_list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in sorted(words)) + ")"


def clean_sql(c: str) -> str:
    return (
        "array_to_string(list_filter(regexp_split_to_array("
        rf"regexp_replace(lower({c}), 'http\S+|www\S+', '', 'g'), '{WORD_SPLIT}'), "
        f"lambda w: length(w) > 2 AND w NOT IN {in_list(STOPWORDS)}), ' ')"
    )


def hits_sql(c: str, words) -> str:
    return f"len(list_filter(string_split(lower({c}), ' '), lambda w: w IN {in_list(words)}))"


CTES = {
    "doc_events": "SELECT d.*, e.user_id, e.event_type, e.value FROM documents d LEFT JOIN events e ON d.doc_id = e.event_id",
    "api_posts": """SELECT doc_id // 100 AS page, doc_id % 100 AS pos,
        split_part(text, chr(10), 1) AS title, text AS selftext, 'u' || user_id AS author,
        CAST(1704067200 + (doc_id % 30) * 86400 + doc_id AS DOUBLE) AS created_utc,
        CAST(floor(value) AS BIGINT) AS score, '/r/' || doc_id AS permalink,
        CASE WHEN doc_id % 13 = 0 THEN true WHEN doc_id % 13 = 1 THEN NULL ELSE false END AS pinned
        FROM doc_events""",
    "raw_posts": """SELECT split_part(text, chr(10), 1) AS title, text,
        CASE WHEN user_id % 10 = 3 THEN NULL WHEN user_id % 10 = 4 THEN '' ELSE 'u' || user_id END AS author,
        CAST(1704067200 + (doc_id % 30) * 86400 + doc_id AS VARCHAR) AS date,
        CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS score,
        'https://posts.example/' || md5(text) AS url, event_type AS source,
        'posts_' || (doc_id * 7 % 11) || '.json' AS source_file, doc_id AS pos FROM doc_events""",
    "raw_articles": """SELECT split_part(text, chr(10), 1) AS titulo,
        CASE WHEN role = 'system' THEN NULL ELSE role END AS autor,
        CASE WHEN conv_id % 17 = 0 THEN 'sin fecha' ELSE '2024-01-' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0')
          || 'T' || lpad(CAST(turn * 5 % 24 AS VARCHAR), 2, '0') || ':30:00-05:00' END AS fecha,
        'https://articles.example/' || md5(text) AS url,
        substr(text, 1, 300) AS extracto, CAST(NULL AS VARCHAR) AS etiquetas, text AS contenido, 'chat' AS fuente,
        'articles_' || (conv_id % 5) || '.json' AS source_file, conv_id * 1000 + turn AS pos FROM conversations""",
    "news": f"""SELECT doc_id, doc_id // 10 + 1 AS page, doc_id % 10 AS item, lang, source, text,
        CASE WHEN doc_id % 23 = 4 THEN '' ELSE trim(split_part(text, chr(10), 1), {WS}) END AS heading,
        {", ".join(f"{v.format(day='CAST(doc_id % 28 + 1 AS VARCHAR)')} AS {k}" for k, v in NEWS.items())} FROM documents""",
    "listed": f"""SELECT page, row_number() OVER (PARTITION BY page ORDER BY item) - 1 AS item_pos, link, heading, name, stamp, lang, source, text,
        CASE WHEN doc_id % 5 = 0 THEN '' ELSE substr(trim(text, {WS}), 1, 300) END AS excerpt FROM news WHERE doc_id % 17 <> 5""",
    "linked": """SELECT * FROM (SELECT * FROM listed WHERE link <> '' QUALIFY row_number() OVER (PARTITION BY link ORDER BY page, item_pos) = 1)
        WHERE heading <> ''""",
    "details": f"""SELECT DISTINCT link AS url, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, {WS})),
        lambda x: x <> ''), ' ') AS contenido, length(text) % 3 = 0 AS untagged FROM news WHERE link <> ''""",
    # The instant in UTC: local time plus five hours.
    "dated_articles": """SELECT * REPLACE (TRY_CAST(replace(fecha, '-05:00', '') AS TIMESTAMP) + INTERVAL 5 HOUR AS fecha)
        FROM raw_articles""",
    "first_posts": """SELECT * FROM raw_posts
        QUALIFY row_number() OVER (PARTITION BY url, title ORDER BY source_file, pos) = 1""",
    "typed_posts": f"""SELECT trim(coalesce(title, ''), {WS}) AS title, coalesce(text, '') AS text,
        coalesce(author, 'unknown') AS author, make_timestamp(CAST(CAST(date AS DOUBLE) * 1000000 AS BIGINT)) AS date,
        coalesce(CAST(trunc(TRY_CAST(score AS DOUBLE)) AS BIGINT), 0) AS score, url, source, source_file, pos
        FROM first_posts""",
    "valid_posts": "SELECT * FROM typed_posts WHERE length(title) > 3 AND length(url) > 5 AND length(text) > 10",
    "fence": """SELECT quantile_cont(score, 0.75) + 1.5 * (quantile_cont(score, 0.75) - quantile_cont(score, 0.25)) AS fence
        FROM valid_posts""",
    "kept_posts": "SELECT * FROM valid_posts WHERE score <= (SELECT fence FROM fence)",
    "silver_posts": f"""SELECT title, {clean_sql('title')} AS title_clean, text, {clean_sql('text')} AS text_clean,
        author, date, score, url, source_file FROM kept_posts""",
    "first_articles": "SELECT * FROM dated_articles QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_file, pos) = 1",
    "valid_articles": f"""SELECT * REPLACE (trim(coalesce(titulo, ''), {WS}) AS titulo,
        coalesce(autor, 'Desconocido') AS autor, coalesce(etiquetas, '') AS etiquetas) FROM first_articles
        WHERE length(trim(coalesce(titulo, ''), {WS})) > 3 AND length(url) > 5 AND length(contenido) > 50""",
    "silver_articles": f"""SELECT titulo, {clean_sql('titulo')} AS titulo_clean, autor, fecha, extracto,
        {clean_sql('extracto')} AS extracto_clean, contenido, {clean_sql('contenido')} AS contenido_clean,
        etiquetas, url, fuente, source_file FROM valid_articles""",
    "posts": f"""SELECT title, {clean_sql('title')} AS title_clean, text, {clean_sql('text')} AS text_clean, author,
        make_timestamp(CAST(date AS BIGINT) * 1000000) AS date,
        coalesce(CAST(trunc(TRY_CAST(score AS DOUBLE)) AS BIGINT), 0) AS score, url, source FROM raw_posts""",
    "articles": f"""SELECT titulo, autor, fecha, contenido, {clean_sql('contenido')} AS contenido_clean, url
        FROM dated_articles""",
    "corpus_rows": """SELECT url, title, text, author, CAST(make_timestamp(CAST(date AS BIGINT) * 1000000) AS DATE) AS day,
        coalesce(CAST(trunc(TRY_CAST(score AS DOUBLE)) AS BIGINT), 0) AS score, source FROM raw_posts UNION ALL
        SELECT url, titulo, contenido, autor, CAST(fecha AS DATE), 0, 'chat' FROM dated_articles""",
    "corpus_first": """SELECT * FROM corpus_rows QUALIFY row_number() OVER (PARTITION BY url ORDER BY
        source NULLS FIRST, day NULLS FIRST, author NULLS FIRST, score NULLS FIRST, title NULLS FIRST) = 1""",
    "corpus_text": f"""SELECT * REPLACE (CASE WHEN source = 'chat' THEN '' ELSE {clean_sql('title')} || ' ' END
        || {clean_sql('text')} AS text) FROM corpus_first""",
    "corpus_hits": f"SELECT *, {hits_sql('text', POSITIVE)} AS p, {hits_sql('text', NEGATIVE)} AS n FROM corpus_text",
    "corpus": """SELECT url, title, text, author, day, score, source,
        CASE WHEN p + n = 0 THEN 'neutral' WHEN (p - n) / (p + n) > 0.1 THEN 'positive'
             WHEN (p - n) / (p + n) < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment,
        CAST(CASE WHEN p + n = 0 THEN 0 ELSE round_even((p - n) / (p + n), 4) END AS FLOAT) AS polarity
        FROM corpus_hits""",
    "corpus_words": """SELECT word, sentiment, source FROM
        (SELECT unnest(string_split(text, ' ')) AS word, sentiment, source FROM corpus) WHERE length(word) > 3""",
    # The gold run: silver tables, one row per url, scored.
    "run_rows": """SELECT url, title, title_clean || ' ' || text_clean AS text, author, CAST(date AS DATE) AS day, score,
        'posts' AS source FROM silver_posts UNION ALL
        SELECT url, titulo, contenido_clean, autor, CAST(fecha AS DATE), 0, 'articles' FROM silver_articles""",
    "run_first": """SELECT * FROM run_rows QUALIFY row_number() OVER (PARTITION BY url ORDER BY source, day NULLS FIRST,
        title NULLS FIRST, author NULLS FIRST, score NULLS FIRST, text NULLS FIRST) = 1""",
    "run_hits": f"SELECT *, {hits_sql('text', POSITIVE)} AS p, {hits_sql('text', NEGATIVE)} AS n FROM run_first",
    "run": """SELECT *, CASE WHEN p + n = 0 THEN 'neutral' WHEN (p - n) / (p + n) > 0.1 THEN 'positive'
        WHEN (p - n) / (p + n) < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment,
        CAST(CASE WHEN p + n = 0 THEN 0 ELSE round_even((p - n) / (p + n), 4) END AS FLOAT) AS polarity FROM run_hits""",
    "run_words": """SELECT word, sentiment, source FROM
        (SELECT unnest(string_split(text, ' ')) AS word, sentiment, source FROM run) WHERE length(word) > 3""",
    "sentiment_dist": "SELECT source, sentiment, count(*) AS count FROM corpus GROUP BY ALL",
    "sentiment_trend": """SELECT day, source, avg(polarity) AS avg_polarity, count(*) AS record_count
        FROM corpus GROUP BY day, source""",
    "score_trend": """SELECT day, avg(score) AS avg_score, count(*) AS post_count FROM corpus
        WHERE source = 'click' GROUP BY day""",
    "volume_trend": "SELECT source, day, count(*) AS record_count FROM corpus GROUP BY source, day",
    "top_keywords": """SELECT word, source, count(*) AS frequency FROM corpus_words GROUP BY word, source
        ORDER BY frequency DESC, word, source LIMIT 50""",
    "keywords_sentiment": """SELECT word, sentiment, source, count(*) AS frequency FROM corpus_words
        GROUP BY word, sentiment, source ORDER BY frequency DESC, word, sentiment, source LIMIT 300""",
    "governance": """SELECT 'posts' AS source, count(*) AS total_records,
        round_even(100.0 * count(*) FILTER (title IS NULL OR title = '') / count(*), 2) AS null_rate_title,
        round_even(100.0 * count(*) FILTER (author IS NULL OR author = '') / count(*), 2) AS null_rate_author,
        round_even(100.0 * count(*) FILTER (text IS NULL OR text = '') / count(*), 2) AS null_rate_text,
        round_even(100.0 * count(*) FILTER (url IS NULL OR url = '') / count(*), 2) AS null_rate_url,
        round_even(100.0 * (count(*) - count(DISTINCT url)) / count(*), 2) AS duplicate_rate,
        avg(score) AS score_mean, quantile_cont(score, 0.5) AS score_median,
        min(score) AS score_min, max(score) AS score_max, avg(length(title)) AS title_len_mean,
        min(length(title)) AS title_len_min, max(length(title)) AS title_len_max, '20240201_000000' AS computed_at
        FROM posts UNION ALL
        SELECT 'articles', count(*),
        round_even(100.0 * count(*) FILTER (titulo IS NULL OR titulo = '') / count(*), 2) AS null_rate_title,
        round_even(100.0 * count(*) FILTER (autor IS NULL OR autor = '') / count(*), 2) AS null_rate_author,
        round_even(100.0 * count(*) FILTER (contenido IS NULL OR contenido = '') / count(*), 2) AS null_rate_text,
        round_even(100.0 * count(*) FILTER (url IS NULL OR url = '') / count(*), 2) AS null_rate_url,
        round_even(100.0 * (count(*) - count(DISTINCT url)) / count(*), 2), 0, 0, 0, 0,
        avg(length(contenido)), min(length(contenido)), max(length(contenido)), '20240201_000000'
        FROM articles""",
}


def sql(body: str) -> str:
    """The body with every named table above that it needs, directly or not."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, definition in CTES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(definition)

    visit(body)
    parts = [f"{name} AS MATERIALIZED ({CTES[name]})" for name in CTES if name in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body
