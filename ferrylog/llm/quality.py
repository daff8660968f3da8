"""Quality rules as a short-circuit cascade, in Spark SQL functions only.

A rule is a condition that rejects. Each rule's cost and the share of documents
it rejects are measured on a bounded sample; the rules then run in descending
order of rejections per cost, and a document that one rule rejects is not shown
to the later ones. The order changes the time taken, never the verdict: a
document is kept when no rule rejects it.

Null texts count as texts without words; texts without words are rejected by
the length rule. Rows, repeated ones included, and other columns stay as they are.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import SPACE, text_of, words_of

#: Rows of the sample on which rules are measured; it decides their order only.
SAMPLE_ROWS = 500

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
_SPACE_SQL = SPACE.encode("unicode_escape").decode().replace("\\x0b", "\\u000b").replace("\\x0c", "\\u000c")
TEXT_SQL = "coalesce(text, '')"
WORDS_SQL = f"array_remove(split(translate({TEXT_SQL}, '{_SPACE_SQL}', '{' ' * len(SPACE)}'), ' '), '')"


def _removed(text: str, which: str) -> str:
    """SQL for the characters of ``text`` that are in ``which``."""
    return f"cast(length({text}) - length(translate({text}, '{which}', '')) as bigint)"


def word_chars_sql(text: str) -> str:
    return f"cast(length(translate({text}, '{_SPACE_SQL}', '')) as bigint)"


def dup_lines_sql(text: str) -> str:
    """(all, repeats): lines with a word, and those of them that equal an earlier one."""
    return f"""element_at(transform(array(
        filter(split({text}, '\\n'), x -> translate(x, '{_SPACE_SQL}', '') != '')
    ), l -> named_struct('every', cast(size(l) as bigint),
                         'repeats', cast(size(l) - size(array_distinct(l)) as bigint))), 1)"""


def repeat_words_sql(words: str) -> str:
    """Words inside a window of three words that occurs twice or more.

    Windows are compared by a 64-bit hash; where all differ nothing is sorted, else
    the sorted windows show the repeated ones. One-element arrays bind values to
    names, so that nothing is computed per element, wherever the optimizer moves this.
    """
    return f"""element_at(transform(array({words}), w -> CASE WHEN size(w) < 4 THEN 0L ELSE
      element_at(transform(array(
        transform(slice(w, 1, size(w) - 2), (x, i) -> xxhash64(x, w[i + 1], w[i + 2]))
      ), h -> CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE element_at(transform(array(
        sort_array(transform(h, (v, i) -> named_struct('v', v, 'i', i)))
      ), s -> aggregate(
        sort_array(transform(filter(s, (e, i) ->
          coalesce(e.v = get(s, i - 1).v, false) OR coalesce(e.v = get(s, i + 1).v, false)), e -> e.i)),
        named_struct('n', 0L, 'last', -3),
        (a, p) -> named_struct('n', a.n + least(3, p - a.last), 'last', p),
        a -> a.n)), 1) END), 1) END), 1)"""


@dataclass(frozen=True)
class Rule:
    """``rejects`` is an SQL condition on the text ``d.t`` and its words ``d.w``."""

    name: str
    rejects: str


#: Too short, or too many of the words repeat.
BASE_RULES = [
    Rule("few_words", "size(d.w) < 50"),
    Rule("repetition", f"100 * {repeat_words_sql('d.w')} > 50 * size(d.w)"),
]

EXTRA_RULES = [
    Rule("symbols", f"10 * {_removed('d.t', SYMBOLS)} > size(d.w)"),
    Rule(
        "word_length",
        f"{word_chars_sql('d.t')} NOT BETWEEN 2 * size(d.w) AND 15 * size(d.w)",
    ),
    Rule("exclamations", f"2 * {_removed('d.t', '!')} > size(d.w)"),
    Rule("capitals", f"2 * {_removed('d.t', CAPITALS)} > {word_chars_sql('d.t')}"),
    Rule("digits", f"2 * {_removed('d.t', DIGITS)} > {word_chars_sql('d.t')}"),
    Rule(
        "dup_lines",
        f"element_at(transform(array({dup_lines_sql('d.t')}), n -> 2 * n.repeats > n.every), 1)",
    ),
]


def verdict_sql(rules: list[Rule], text: str, words: str) -> str:
    """False at the first rule that rejects; later rules are not evaluated."""
    cases = " ".join(f"WHEN {r.rejects} THEN false" for r in rules)
    chain = f"CASE {cases} ELSE true END" if rules else "true"
    return f"element_at(transform(array(named_struct('t', {text}, 'w', {words})), d -> {chain}), 1)"


def measured_order(sample: DataFrame, rules: list[Rule], text: str, words: str) -> list[Rule]:
    """``rules`` by rejections per second on ``sample``, highest first."""
    sample.agg(F.sum(F.size(words))).first()
    scores = {}
    for rule in rules:
        begin = time.perf_counter()
        kept = F.expr(verdict_sql([rule], text, words))
        rejected = sample.agg(F.count_if(~kept)).first()[0]
        scores[rule.name] = (rejected + 1e-3) / (time.perf_counter() - begin)
    return sorted(rules, key=lambda r: -scores[r.name])


def ordered_rules(
    docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules in the order measured on up to ``sample_rows`` of ``docs``.

    The rows come from as few partitions as hold them and are measured as a local table.
    """
    rows = docs.select(text_of().alias("t")).take(sample_rows)
    sample = docs.sparkSession.createDataFrame(rows, "t string")
    return measured_order(sample.select("t", words_of(F.col("t")).alias("w")), rules, "t", "w")


def keep_good(
    docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The documents that no rule rejects, all columns as they were."""
    rules = ordered_rules(docs, [*BASE_RULES, *EXTRA_RULES] if rules is None else rules, sample_rows)
    return docs.filter(F.expr(verdict_sql(rules, TEXT_SQL, WORDS_SQL)))


def judged(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document the base counts, whether the base rules reject it, and the verdict."""
    rules = ordered_rules(docs, EXTRA_RULES, sample_rows)
    rows = docs.select("doc_id", text_of().alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    counted = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.expr(word_chars_sql("text")).alias("word_chars"),
        F.expr(_removed("text", SYMBOLS)).alias("n_symbols"),
        F.expr(dup_lines_sql("text")).alias("lines"),
        F.expr(repeat_words_sql("words")).alias("n_repeat_words"),
        F.expr(verdict_sql(rules, "text", "words")).alias("passes"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        F.col("lines.repeats").alias("n_dup_lines"),
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("passes")).alias("kept"),
    )


#: DuckDB's form of ``judged`` over the table documents.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i,
         unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS g
  FROM d WHERE len(w) >= 3
), c AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g
), v AS (
  SELECT r, count(DISTINCT i + k) AS n FROM c, range(3) AS x(k) WHERE c.n > 1 GROUP BY r
), l AS (
  SELECT r, len(s) AS n_lines, len(s) - len(list_distinct(s)) AS n_dup FROM (
    SELECT r, list_filter(string_split(t, chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS s FROM d)
), f AS (
  SELECT doc_id, len(w) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         n_dup AS n_dup_lines, n_lines, coalesce(v.n, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^!]+', '', 'g')) AS n_excl,
         length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_caps,
         length(regexp_replace(t, '[^0-9]+', '', 'g')) AS n_digits
  FROM d JOIN l USING (r) LEFT JOIN v USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_excl > n_words
            OR 2 * n_caps > word_chars OR 2 * n_digits > word_chars
            OR 2 * n_dup_lines > n_lines) AS kept
FROM f
"""
