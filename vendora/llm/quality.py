"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the whole text and every rule compares two integer
measures, so a verdict costs one scan: no shuffle, no user function.

Defined cases: a null text counts as empty; a text without words fails ``words_few``; repeated rows
and null ids are judged row by row; an empty table gives an empty table; columns that share a name
with a measure keep their value, because measures travel in one struct until the last projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that separates words.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four supported languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "with", "as", "be", "by", "this", "are", "or", "an", "from",
    "der", "die", "und", "das", "von", "zu", "den", "mit", "ist", "ein", "eine", "im", "nicht", "sich", "auf", "als", "für", "des",
    "le", "la", "les", "de", "et", "un", "une", "du", "que", "est", "pour", "dans", "qui", "sur", "au", "par", "avec", "en",
    "el", "los", "las", "y", "del", "se", "con", "una", "su", "por", "para", "al", "lo", "como",
)


@dataclass(frozen=True)
class Rule:
    """A text is rejected if ``100 * measure`` is over (or under) ``limit * per``; ``per`` '' means 1 and no factor of 100."""

    name: str
    measure: str
    side: str
    limit: int
    per: str = ""


#: The two rules that hold whatever else is configured.
BASE_RULES = (Rule("words_few", "n_words", "under", 50), Rule("words_repeat", "n_repeat_words", "over", 50, "n_words"))
#: Ratios in percent.
RULES = (
    Rule("words_short", "word_chars", "under", 200, "n_words"),
    Rule("words_long", "word_chars", "over", 1500, "n_words"),
    Rule("symbols", "n_symbols", "over", 30, "n_words"),
    Rule("lines_repeat", "n_dup_lines", "over", 40, "n_lines"),
    Rule("lines_bullet", "n_bullet_lines", "over", 90, "n_lines"),
    Rule("lines_ellipsis", "n_ellipsis_lines", "over", 30, "n_lines"),
    Rule("stop_words", "n_stop_words", "under", 3, "n_words"),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with value computed once: a lambda's variable is held, an inlined expression is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more, each counted once."""

    def covered(w: Column) -> Column:
        def at(i: Column) -> Column:
            return F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

        places = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))

        def marked(hashes: Column) -> Column:
            def spots(s: Column) -> Column:
                rep = F.filter(s, lambda x, i: ((i > 0) & F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
                return F.size(F.array_distinct(F.flatten(F.transform(rep, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))))

            pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
            # most texts repeat no window: two cheap set sizes spare them the sort
            return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(F.sort_array(pairs), spots))

        return _let(F.transform(places, at), marked)

    return _let(words, covered)


def measures(text: Column) -> dict[str, Column]:
    """Integer measures of a whole text, by name; see :data:`RULES`."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\f\r", "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words),
        "n_lines": F.size(lines),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
    }


def _broken(rule: Rule, m: Column) -> Column:
    left = m[rule.measure] * (100 if rule.per else 1)
    right = m[rule.per] * rule.limit if rule.per else F.lit(rule.limit)
    return left > right if rule.side == "over" else left < right


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with one struct ``__quality``: the measures, ``base_failed``, ``kept`` and ``reasons`` (names of broken rules)."""
    out = df.withColumn("__m", F.struct(*(c.cast("long").alias(k) for k, c in measures(F.col(text)).items())))
    m = F.col("__m")
    base = F.array_compact(F.array(*(F.when(_broken(r, m), F.lit(r.name)) for r in BASE_RULES)))
    more = F.array_compact(F.array(*(F.when(_broken(r, m), F.lit(r.name)) for r in rules)))
    kept = F.struct("__m.*", (F.size(base) > 0).alias("base_failed"), (F.size(F.concat(base, more)) == 0).alias("kept"), F.concat(base, more).alias("reasons"))
    return out.withColumn("__quality", kept).drop("__m")


def quality_filter(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows whose text breaks no rule, with the columns they had."""
    return judge(df, text, rules).filter("__quality.kept").drop("__quality")


def verdict_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same rules as a boolean SQL expression over columns named as the measures."""
    def ok(r: Rule) -> str:
        left, right = (f"100 * {r.measure}", f"{r.limit} * {r.per}") if r.per else (r.measure, str(r.limit))
        return f"{left} {'<=' if r.side == 'over' else '>='} {right}"

    return " AND ".join(ok(r) for r in (*BASE_RULES, *rules))


def measures_sql(table: str = "documents") -> str:
    """DuckDB SQL: doc_id, text and the measures of each row of ``table``, which must have unique ids."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
    SELECT d.*, len(ws)::BIGINT AS n_words,
      length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
      (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
      (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
      coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
      len(list_filter(ls, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•]')))::BIGINT AS n_bullet_lines,
      len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')))::BIGINT AS n_ellipsis_lines,
      len(list_filter(ws, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words
    FROM (SELECT *, coalesce(text, '') AS t,
            list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
          FROM {table}) d
    LEFT JOIN (SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
          SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (
            SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (
              SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM (
                SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM {table}))))
        WHERE c > 1) GROUP BY doc_id) r USING (doc_id)"""


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the measures and the verdict of every row of ``documents``."""
    out = judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    q = F.col("__quality")
    return out.select("doc_id", *(q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


SQL = f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, ({verdict_sql()}) AS kept
FROM ({measures_sql()})"""
