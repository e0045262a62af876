"""Line dedup by site-relative frequency, in built-in functions alone.

A line that stands on more than `ratio` of a host's pages, and on `least_pages` of them at
least, is boilerplate of that host and is dropped from its pages. Lines are compared without
the blanks around them; a page counts once for a line however often it holds it, and lines
without a word are neither counted nor dropped.

Counting is an aggregate over (host, line) with a map-side combine, so neither a host with a
third of all pages nor a line on all of them gathers anywhere. Of a page only the digests of
its boilerplate lines come back to it, by its doc_id.

A null host is a host of its own. A null or empty text has no lines and stays as it is. Rows
that repeat a doc_id each count as a page and lose what is boilerplate of their own host. Rows of
a null doc_id are counted and left as they are. A text may become empty; no row is dropped.
Lines of
equal words are one line, so there are no ties. A very long text is one row and one array of
lines. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.llm.rows import spare

BLANKS = " \t\x0b\f\r"
#: One page in twenty; below 100 pages of a host, `LEAST_PAGES` is the higher bar.
RATIO = 0.05
LEAST_PAGES = 5


def _digest(line: Column) -> Column:
    """Of a line without the blanks around it; empty for a line without a word."""
    cut = F.trim(line, F.lit(BLANKS))
    return F.when(cut == "", F.lit("")).otherwise(F.md5(cut))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """doc_id, host and the digests of the lines there that are boilerplate of the host."""
    pages = docs.select("doc_id", F.col(host).alias("host"), F.col("text").alias("text"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    on = pages.select(
        "doc_id", "host", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _digest))).alias("line")).where("line <> ''")
    counts = on.groupBy("host", "line").agg(F.count("*").alias("with_line")).where(F.col("with_line") >= least_pages)
    h = counts.join(totals.withColumnRenamed("host", "of"), counts["host"].eqNullSafe(F.col("of")))
    drop = h.where(F.col("with_line") > ratio * F.col("pages")).select(F.col("host").alias("of"), F.col("line").alias("key"))
    return (
        on.where("doc_id IS NOT NULL").join(drop, on["host"].eqNullSafe(drop["of"]) & (on["line"] == drop["key"]), "left_semi")
        .groupBy("doc_id", "host").agg(F.collect_set("line").alias("drop")))


def _marked(docs: DataFrame, host: str, ratio: float, least_pages: int) -> tuple[DataFrame, str]:
    """The documents with the digests to drop, and the name of that column."""
    of, at, drop = (spare(docs.columns, c) for c in ("of", "at", "drop"))
    found = boilerplate(docs, host, ratio, least_pages).select(
        F.col("doc_id").alias(of), F.col("host").alias(at), F.col("drop").alias(drop))
    same = (docs["doc_id"] == found[of]) & docs[host].eqNullSafe(found[at])
    return docs.join(found, same, "left").drop(of, at), drop


def _kept(text: Column, drop: Column) -> Column:
    return F.filter(_lines(text), lambda x: ~F.array_contains(drop, _digest(x)))


def without_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """The documents, with all their columns, without boilerplate lines; n_chars, where there
    is one, follows the text of those that changed."""
    out, drop = _marked(docs, host, ratio, least_pages)
    out = out.withColumn("text", F.when(
        F.col(drop).isNull(), F.col("text")).otherwise(F.array_join(_kept(F.col("text"), F.col(drop)), "\n")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(drop).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)


def op4(docs: DataFrame) -> DataFrame:
    """Per document: lines with a word, dropped lines, and the SHA-256 of what is kept."""
    marked, name = _marked(docs.select("doc_id", "source", "text"), "source", RATIO, LEAST_PAGES)
    lines = _lines(F.col("text"))
    drop = F.coalesce(name, F.array().cast("array<string>"))
    kept = F.when(F.col(name).isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(_kept(F.col("text"), drop), "\n"))
    return marked.select(
        "doc_id", F.size(F.filter(lines, lambda x: F.trim(x, F.lit(BLANKS)) != "")).cast("long").alias("n_lines"),
        F.when(F.col(name).isNull(), F.lit(0)).otherwise(F.size(F.filter(
            lines, lambda x: F.array_contains(drop, _digest(x))))).cast("long").alias("n_dropped"),
        F.sha2(kept, 256).alias("kept_sha256"))


def oracle(ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> str:
    blanks = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
    return f"""WITH pages AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
    on_page AS (SELECT doc_id, source, unnest(list_distinct(list_transform(lines, lambda x: trim(x, {blanks})))) AS line FROM pages),
    counts AS (SELECT source, line, count(*) AS n FROM on_page WHERE line <> '' GROUP BY source, line),
    gone AS (SELECT c.source, list(c.line) AS gone FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
      WHERE c.n >= {least_pages} AND c.n > {ratio}::DOUBLE * t.pages GROUP BY c.source),
    kept AS (SELECT doc_id, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(g.gone, []), trim(x, {blanks}))) AS kept
      FROM pages p LEFT JOIN gone g ON p.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, len(list_filter(lines, lambda x: trim(x, {blanks}) <> ''))::BIGINT AS n_lines,
      (len(lines) - len(kept))::BIGINT AS n_dropped, sha256(array_to_string(kept, chr(10))) AS kept_sha256 FROM kept"""
