"""Quality rules by distribution divergence, in built-in functions alone.

Each text gives two histograms, one of character classes and one of common words. They are
compared by Jensen-Shannon distance (base 2, so 0 to 1) with the references of the known
languages, which are summed over all documents of that language that pass the base rule; the
nearest reference counts, so a wrong language label rejects nothing. Short texts have noisy
histograms: below `min_chars` or `min_words` a distance says nothing and doesn't count.

Words are runs of anything but blank and the controls 0x09 to 0x0D. A null text counts as
empty: no words, so it fails the base rule (fewer than ten words). Rows are judged one by
one, so repeated rows and repeated or null doc_ids are judged each by itself. Rows of
another or null language are judged like all others. Without any reference (an empty table,
or no document that passes) the base rule alone decides. Columns named `_q_...` are taken;
all others are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.sources.shared import written

BLANKS = " \t\n\x0b\f\r"

# Frequent function words of the four languages.
COMMON_WORDS = {
    "en": "the of and to in a is that for was on with as by at from".split(),
    "fr": "de la le et les des en un une du est que dans pour qui au".split(),
    "de": "der die und in den von zu das mit dem des ist im für auf ein".split(),
    "es": "de la que el en y los se del las un por con para una su".split(),
}
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})

#: Character classes that are counted; blanks and all that remains are two more.
CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "mark": "[.,;:!?'\"()-]", "beyond": r"[^\x00-\x7F]", "symbol": "[#*$%&|<>]"}


@dataclass(frozen=True)
class Rules:
    """Limits. A text fails the base rule below `least_words` words or with more than
    `most_repeated` percent of its words in repeated windows of `window` words."""

    least_words: int = 10
    most_repeated: int = 20
    window: int = 5
    class_distance: float = 0.25
    min_chars: int = 600
    word_distance: float = 0.29
    min_words: int = 100
    languages: tuple[str, ...] = tuple(COMMON_WORDS)


RULES = Rules()


def split_words(text: Column) -> Column:
    """Words of a text that is not null, as an array."""
    cut = F.trim(text, F.lit(BLANKS))
    return F.when(cut == "", F.array().cast("array<string>")).otherwise(F.split(cut, r"[\x20\x09-\x0D]+"))


def measured(rows: DataFrame, text: str = "text", rules: Rules = RULES) -> DataFrame:
    """The rows with the measures of a text column, all named `_q_...`; nothing is shuffled.

    The steps are apart so that each array is built once and then read by the next step.
    """
    width = rules.window
    w, h, x = F.col("_q_words"), F.col("_q_hashes"), F.col("_q_sorted")
    known = [F.col(f"_q_{k}") for k in CLASSES]
    return (
        rows.withColumn("_q_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
        .withColumns({
            "_q_words": split_words(F.col("_q_text")),
            "_q_lines": F.filter(F.split("_q_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            "_q_length": F.length("_q_text").cast("long"),
            # Most characters are of no class; what is left is counted.
            "_q_rare": F.regexp_replace("_q_text", r"[a-z\x20\x09-\x0D]+", ""),
        })
        .withColumns({
            **{f"_q_{k}": F.regexp_count("_q_rare", F.lit(p)).cast("long") for k, p in CLASSES.items()},
            "_q_n_words": F.size(w).cast("long"),
            "_q_word_chars": F.length(F.array_join(w, "")).cast("long"),
            "_q_n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
            # The common words with two blanks between them, so that each can be cut out with one on either side.
            "_q_common": F.concat(F.lit(" "), F.lower(F.array_join(F.filter(w, lambda v: F.lower(v).isin(VOCABULARY)), "  ")), F.lit(" ")),
            "_q_hashes": F.transform(w, lambda v: F.xxhash64(v)),
        })
        .withColumn("_q_runs", F.when(F.size(h) >= width, F.transform(
            F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(width)))))
            .otherwise(F.array().cast("array<bigint>")))
        # Most texts repeat no window; only the others are sorted.
        .withColumn("_q_sorted", F.when(
            F.size(F.array_distinct("_q_runs")) < F.size("_q_runs"),
            F.array_sort(F.transform("_q_runs", lambda r, i: F.struct(r.alias("h"), i.alias("i")))))
            .otherwise(F.array().cast("array<struct<h: bigint, i: int>>")))
        .withColumn("_q_starts", F.array_sort(F.transform(F.filter(F.transform(
            x, lambda r, k: F.struct(r["i"].alias("i"), (
                r["h"].eqNullSafe(F.get(x, k - 1)["h"]) | r["h"].eqNullSafe(F.get(x, k + 1)["h"])).alias("again"))),
            lambda r: r["again"]), lambda r: r["i"])))
        .withColumn("_q_n_repeat_words", F.aggregate(
            "_q_starts", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct((a["n"] + i + width - F.greatest(a["end"], i)).alias("n"), (i + width).alias("end")),
            lambda a: a["n"]))
        .withColumn("_q_base_failed", (F.col("_q_n_words") < rules.least_words)
                    | (100 * F.col("_q_n_repeat_words") > rules.most_repeated * F.col("_q_n_words")))
        .withColumn("_q_classes", F.array(
            *known, F.col("_q_length") - F.col("_q_word_chars"), F.col("_q_word_chars") - reduce(Column.__add__, known)))
        .withColumn("_q_each", F.array(*(
            F.expr(f"(octet_length(_q_common) - octet_length(replace(_q_common, ' {v} ', ''))) div {len(v.encode()) + 2}") for v in VOCABULARY)))
        .withColumn("_q_counts", F.concat("_q_each", F.array(
            F.col("_q_n_words") - F.aggregate("_q_each", F.lit(0).cast("long"), lambda a, n: a + n))))
    )


def references(measures: DataFrame, language: str = "lang", rules: Rules = RULES) -> list[tuple[list[int], list[int]]]:
    """Class and word totals of each known language, over all its rows that pass the base rule.
    The driver gets one row for each language of the rules."""
    def totals(column: str, n: int) -> Column:
        return F.array(*(F.sum(F.get(column, F.lit(k))) for k in range(n)))

    found = (
        measures.where(F.col(language).isin(*rules.languages) & ~F.col("_q_base_failed")).groupBy(language)
        .agg(totals("_q_classes", len(CLASSES) + 2).alias("c"), totals("_q_counts", len(VOCABULARY) + 1).alias("w")).collect())
    return [(list(r["c"]), list(r["w"])) for r in sorted(found, key=lambda r: r[language])]


def js_distance(counts: str, total: Column, reference: list[int]) -> Column:
    """Jensen-Shannon distance of an array of counts, of known sum, from fixed counts."""
    whole = max(sum(reference), 1)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def term(count: Column, q: Column) -> Column:
        p = count / total
        return part(p, (p + q) / 2) + part(q, (p + q) / 2)

    terms = F.zip_with(counts, F.lit([r / whole for r in reference]), term)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def judged(measures: DataFrame, known: list[tuple[list[int], list[int]]], rules: Rules = RULES) -> DataFrame:
    """The measures with `_q_class_distance`, `_q_word_distance` and `_q_kept`."""
    chars, words = F.col("_q_length"), F.col("_q_n_words")

    def nearest(column: str, total: Column, which: int, enough: Column) -> Column:
        away = [js_distance(column, total.cast("double"), r[which]) for r in known]
        return F.when(enough, away[0] if len(away) == 1 else F.least(*away)) if away else F.lit(None).cast("double")

    out = measures.withColumns({
        "_q_class_distance": nearest("_q_classes", chars, 0, chars >= max(rules.min_chars, 1)),
        "_q_word_distance": nearest("_q_counts", words, 1, words >= max(rules.min_words, 1)),
    })
    far = (F.coalesce(F.col("_q_class_distance") > rules.class_distance, F.lit(False))
           | F.coalesce(F.col("_q_word_distance") > rules.word_distance, F.lit(False)))
    return out.withColumn("_q_kept", ~F.col("_q_base_failed") & ~far)


MEASURES = ["_q_n_words", "_q_word_chars", "_q_symbol", "_q_n_dup_lines", "_q_n_repeat_words", "_q_length",
            "_q_base_failed", "_q_classes", "_q_counts"]


def _written_measures(docs: DataFrame, rules: Rules) -> DataFrame:
    return written(measured(docs.select("doc_id", "lang", "text"), "text", rules).select("doc_id", "lang", *MEASURES), "measures")


def with_verdict(docs: DataFrame, rules: Rules = RULES) -> DataFrame:
    """doc_id, lang and all measures and verdicts; texts are read once."""
    measures = _written_measures(docs, rules)
    return judged(measures, references(measures, "lang", rules), rules)


def passing(docs: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The documents, with all their columns, that pass. The measures are taken twice, once for
    the references and once for the verdict, so that no text is shuffled."""
    known = references(_written_measures(docs, rules), "lang", rules)
    out = judged(measured(docs.withColumn("_q_own", F.col("text")), "_q_own", rules), known, rules)
    # A filter on plain columns would be pushed below the steps, where every array it names is
    # built anew for each use; one on a column that may differ by row position stays above.
    kept = out.withColumn("_q_kept", F.col("_q_kept") & (F.monotonically_increasing_id() >= 0)).where("_q_kept")
    return kept.select(*docs.columns)


def op6(docs: DataFrame) -> DataFrame:
    return with_verdict(docs).select(
        "doc_id", F.col("_q_n_words").alias("n_words"), F.col("_q_word_chars").alias("word_chars"),
        F.col("_q_symbol").alias("n_symbols"), F.col("_q_n_dup_lines").alias("n_dup_lines"),
        F.col("_q_n_repeat_words").alias("n_repeat_words"), F.col("_q_base_failed").alias("base_failed"),
        F.col("_q_kept").alias("kept"))


def _sql_distance(counts: str, total: str, reference: str) -> str:
    term = "CASE WHEN {0} > 0 THEN {0} * log2({0} / ((x.p + x.q) / 2)) ELSE 0 END"
    return (f"sqrt(greatest(list_sum(list_transform(list_zip({counts}, {reference}), lambda z: list_transform("
            f"[{{'p': z[1] / {total}::DOUBLE, 'q': z[2] / list_sum({reference})::DOUBLE}}], lambda x: "
            f"{term.format('x.p')} + {term.format('x.q')})[1])) / 2, 0))")


def oracle(rules: Rules = RULES, table: str = "documents") -> str:
    """The same verdict in SQL."""
    space = r"[^\x20\x09-\x0D]"
    q = lambda s: s.replace("'", "''")
    n = rules.window
    vocabulary = ", ".join(f"'{v}'" for v in VOCABULARY)
    counted = ", ".join(f"len(regexp_extract_all(t, '{q(p)}'))" for p in CLASSES.values())
    sums = ", ".join(f"sum(classes[{k + 1}])" for k in range(len(CLASSES) + 2))
    totals = ", ".join(f"sum(counts[{k + 1}])" for k in range(len(VOCABULARY) + 1))
    return f"""WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM {table}),
    split AS (SELECT *, regexp_extract_all(t, '{space}+') AS w,
      list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{space}')) AS lines FROM texts),
    runs AS (SELECT *, list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' ')) AS r FROM split),
    again AS (SELECT *, map_from_entries(list_filter(map_entries(list_histogram(r)), lambda e: e.value > 1)) AS twice FROM runs),
    starts AS (SELECT *, list_filter(range(1, len(w) - {n - 2}), lambda i: len(map_extract(twice, r[i])) > 0) AS s FROM again),
    base AS (SELECT doc_id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
      length(t) AS chars, len(regexp_extract_all(t, '{CLASSES["symbol"]}')) AS n_symbols,
      (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
      len(list_distinct(flatten(list_transform(s, lambda i: range(i, i + {n}))))) AS n_repeat_words,
      [{counted}] AS known, list_filter(list_transform(w, lambda x: lower(x)), lambda x: x IN ({vocabulary})) AS common FROM starts),
    measures AS (SELECT *, n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.most_repeated} * n_words AS base_failed,
      list_concat(known, [chars - word_chars, word_chars - list_sum(known)::BIGINT]) AS classes,
      list_concat(list_transform([{vocabulary}], lambda v: len(list_filter(common, lambda x: x = v))), [n_words - len(common)]) AS counts
      FROM base),
    known AS (SELECT lang AS of, [{sums}] AS c, [{totals}] AS v FROM measures
      WHERE NOT base_failed AND lang IN ({', '.join(f"'{x}'" for x in rules.languages)}) GROUP BY lang),
    away AS (SELECT m.doc_id, m.n_words, m.n_repeat_words, any_value(m.base_failed) AS base_failed, any_value(m.word_chars) AS word_chars,
      any_value(m.n_symbols) AS n_symbols, any_value(m.n_dup_lines) AS n_dup_lines, any_value(m.chars) AS chars,
      min(CASE WHEN m.chars >= {rules.min_chars} THEN {_sql_distance('m.classes', 'm.chars', 'k.c')} END) AS by_class,
      min(CASE WHEN m.n_words >= {rules.min_words} THEN {_sql_distance('m.counts', 'm.n_words', 'k.v')} END) AS by_word
      FROM measures m LEFT JOIN known k ON true GROUP BY m.doc_id, m.n_words, m.n_repeat_words)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND NOT coalesce(by_class > {rules.class_distance}, false) AND NOT coalesce(by_word > {rules.word_distance}, false) AS kept
    FROM away"""
