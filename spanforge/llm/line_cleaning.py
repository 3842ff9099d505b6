"""Quality rules, lines first: judge every line, drop the lines that fail, then reject documents that lost too much.

Only built-in expressions. Arrays are bound as columns, or by `let`, so that none is computed once per element.

Defined cases: a null text has no lines and no words and is rejected, as is an empty one; rows repeat as they came;
columns beyond ``text`` pass through, and the columns added replace input columns of the same name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.llm.shared import let

WHITE_RUN = r"[ \t\n\x0B\f\r]+"
SYMBOLS = "#*$%&|<>"
#: A line fails if it holds one of these phrases (lower case) and is shorter than BOILERPLATE_WORDS.
BOILERPLATE = ("all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy", "accept cookies", "click here", "sign up", "log in to", "subscribe", "read more", "share this", "powered by", "skip to content", "enable javascript", "lorem ipsum")
BOILERPLATE_WORDS = 40
#: Navigation: separators per word. Punctuation: a line this short needs an end mark; runs of ! per word; symbols per word.
SEPARATORS_PER_WORD, FRAGMENT_WORDS, SHOUTS_PER_WORD, SYMBOLS_PER_WORD = 0.2, 5, 0.5, 0.5
#: A line of REPEAT_WORDS or more fails if fewer than this share of its words differ.
REPEAT_WORDS, DISTINCT_SHARE = 10, 0.3
#: Share of word characters that failing lines may take from a document.
MAX_LOSS = 0.3


def holds(text: Column, characters: str) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(x) for x in characters])


def count_of(text: Column, characters: str) -> Column:
    """Occurrences of any of the characters; plain searches pass over the many texts that have none."""
    return F.when(holds(text, characters), F.length(text) - F.length(F.translate(text, characters, ""))).otherwise(0)


def words_of(text: Column) -> Column:
    """Words of a text without line feeds; the plain split serves where a space is the only white space."""
    return F.array_remove(F.when(holds(text, "\t\x0b\f\r"), F.split(text, WHITE_RUN)).otherwise(F.split(text, " ")), "")


def characters(words: Column) -> Column:
    return F.length(F.array_join(words, ""))


def line_verdict(line: Column, words: Column, suspect: Column) -> Column:
    """The first rule that a line with words fails: navigation, punctuation, boilerplate, repetition; null if it passes.
    suspect: whether the whole text holds a boilerplate phrase at all."""
    n = F.size(words)
    phrase = F.exists(F.array(*map(F.lit, BOILERPLATE)), lambda x: F.lower(line).contains(x))
    return (
        F.when(count_of(line, "|»›•·") >= F.greatest(F.lit(2), n * SEPARATORS_PER_WORD), "navigation")
        .when((n < FRAGMENT_WORDS) & ~line.rlike(r"[.!?…:;\"'”’»)\]][ \t\x0B\f\r]*$"), "punctuation")
        .when(line.contains("!") & (count_of(line, "!") > n * SHOUTS_PER_WORD), "punctuation")
        .when(count_of(line, SYMBOLS) > n * SYMBOLS_PER_WORD, "punctuation")
        .when((n < BOILERPLATE_WORDS) & suspect & phrase, "boilerplate")
        .when((n >= REPEAT_WORDS) & (F.size(F.array_distinct(words)) < n * DISTINCT_SHARE), "repetition")
    )


def repeated_words(words: str) -> Column:
    """Words covered by 3-word windows that occur twice or more in the array column named."""

    def hashed(w: Column) -> Column:
        n = F.size(w)
        window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<bigint>"))

    # Bound here too: a filter pushed below the array's projection would compute the array once a window.
    windows = let(F.col(words), hashed)

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)

    def starts(ordered: Column) -> Column:
        same = lambda e, k: F.coalesce(F.get(ordered, k)["h"] == e["h"], F.lit(False))
        return F.transform(F.filter(ordered, lambda e, k: same(e, k - 1) | same(e, k + 1)), lambda e: e["i"])

    def counted(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) < F.size(found), let(F.sort_array(let(placed, starts)), covered)).otherwise(0)

    return let(windows, counted)


def clean_lines(docs: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """docs with cleaned_text, lines_removed (array of line and rule), the document figures, base_failed and kept.

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words describe the whole text. base_failed: fewer than 50
    words, or over half of them in repeated 3-word windows. kept: not base_failed, and lines that fail hold at most
    ``max_loss`` of the word characters. Lines without a word neither fail nor count.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    suspect = let(F.lower(text), lambda low: F.exists(F.array(*map(F.lit, BOILERPLATE)), lambda x: low.contains(x)))
    out = docs.withColumn("_lines", F.transform(F.split(text, "\n"), lambda x: F.struct(x.alias("line"), words_of(x).alias("words"))))

    def judged(flag: Column) -> Column:
        rule = lambda x: F.when(F.size(x["words"]) > 0, line_verdict(x["line"], x["words"], flag))
        return F.transform("_lines", lambda x: F.struct(x["line"].alias("line"), characters(x["words"]).alias("chars"), rule(x).alias("rule")))

    out = out.withColumns({"_words": F.flatten(F.transform("_lines", lambda x: x["words"])), "_judged": let(suspect, judged)})
    worded = F.transform(F.filter("_judged", lambda x: x["chars"] > 0), lambda x: x["line"])
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.aggregate("_judged", F.lit(0), lambda total, x: total + x["chars"]).cast("long"),
            "n_symbols": count_of(text, SYMBOLS).cast("long"),
            "n_dup_lines": let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words("_words").cast("long"),
            "lines_removed": F.filter("_judged", lambda x: x["rule"].isNotNull()),
            "cleaned_text": F.array_join(F.transform(F.filter("_judged", lambda x: x["rule"].isNull()), lambda x: x["line"]), "\n"),
        }
    )
    lost = F.aggregate("lines_removed", F.lit(0), lambda total, x: total + x["chars"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumns({"base_failed": failed, "kept": ~failed & (lost <= max_loss * F.col("word_chars"))}).drop("_words", "_lines", "_judged")


def op8_line_cleaning(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.size("lines_removed").cast("long").alias("n_lines_removed"))


_VERDICT = rf"""
  CASE WHEN seps >= greatest(2, n * {SEPARATORS_PER_WORD}) THEN 'navigation'
       WHEN NOT regexp_matches(line, '[.!?…:;"''”’»)\]][ \t\x0B\f\r]*$') AND n < {FRAGMENT_WORDS} THEN 'punctuation'
       WHEN shouts > n * {SHOUTS_PER_WORD} OR syms > n * {SYMBOLS_PER_WORD} THEN 'punctuation'
       WHEN n < {BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{'|'.join(BOILERPLATE)}') THEN 'boilerplate'
       WHEN n >= {REPEAT_WORDS} AND len(list_distinct(w)) < n * {DISTINCT_SHARE} THEN 'repetition' END"""

#: Rows of `clean_lines` over a table named by the first field, as DuckDB sees them; the CTEs end in `judged`.
LINE_SQL = rf"""
texts AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, coalesce(text, '') AS t FROM {{table}}),
tokens AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
lines AS (SELECT r, p, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM
  (SELECT r, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS p FROM texts)),
measured AS (SELECT r, p, line, w, len(w) AS n, length(line) - length(regexp_replace(line, '[|»›•·]', '', 'g')) AS seps,
  length(line) - length(replace(line, '!', '')) AS shouts, length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS syms,
  length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars FROM lines),
verdicts AS (SELECT *, CASE WHEN n > 0 THEN {_VERDICT} END AS rule FROM measured),
by_lines AS (SELECT r, coalesce(sum(chars) FILTER (rule IS NOT NULL), 0) AS lost, count(rule) AS n_removed,
  count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS dups,
  coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (rule IS NULL), '') AS cleaned FROM verdicts GROUP BY r),
windows AS (SELECT r, i, w[i] AS a, w[i+1] AS b, w[i+2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM tokens)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM windows),
repeats AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest([i, i+1, i+2]) AS i FROM twice WHERE k > 1) GROUP BY r),
figures AS (SELECT doc_id, r, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, dups AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
  lost, n_removed, cleaned FROM tokens JOIN by_lines USING (r) LEFT JOIN repeats USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= {MAX_LOSS} * word_chars AS kept FROM figures)"""

ORACLE = f"""WITH {LINE_SQL.format(table="documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed AS n_lines_removed FROM judged"""
