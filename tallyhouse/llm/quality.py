"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Measures per text: words and their code points, symbols, repeated lines, words in repeated
five-word windows, stop words, words in capitals (two or more of A-Z and none of a-z), exclamation marks. A rule compares ``scale * measure`` with
``bound * per``; all arithmetic is on whole numbers. A text is kept when no rule rejects it.

Empty cases: a null or empty text has no words and fails the word count. A null ``doc_id``
stays null, repeated rows are judged each, an empty table gives an empty result. Very long texts are judged whole.
Rows travel as one struct, so that no column name of theirs can clash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import SPACE, split_words

WINDOW = 5

# Frequent short words of the four languages, in lower case.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not he or at this are from but have an they you "
    "de la le et les des en un une du que est pour dans qui par sur au pas plus ne se ce il "
    "der die und das von den ist mit dem zu sich des auf für ein eine nicht auch es als im "
    "el los las y del se por con no su para al lo como más una o pero sus"
).split()


class Rule(NamedTuple):
    """Rejects when ``100 * measure`` is over (or under) ``percent * per``, for texts of at least ``words`` words."""

    name: str
    measure: str
    over: bool
    percent: int
    per: str
    words: int = 0


# The threshold table. The first two are the contract's base rules.
BASE_RULES = (
    Rule("too_short", "n_words", False, 1000, "one"),
    Rule("repeated_windows", "n_repeat_words", True, 20, "n_words"),
)
METHOD_RULES = (
    Rule("long_words", "word_chars", True, 1500, "n_words", 20),
    Rule("short_words", "word_chars", False, 200, "n_words", 20),
    Rule("symbols", "n_symbols", True, 20, "n_words", 20),
    Rule("repeated_lines", "n_dup_lines", True, 50, "n_lines", 20),
    Rule("no_stop_words", "n_stop_words", False, 1, "n_words", 100),
    Rule("shouting", "n_shouted", True, 50, "n_words", 20),
    Rule("exclaiming", "n_exclaimed", True, 5, "word_chars", 20),
)

# A word in capitals; no part of it can be read in two ways, so long words take one pass.
SHOUTED = r"(?<![^\x20\x09-\x0D])(?:[^a-zA-Z\x20\x09-\x0D]*+[A-Z]){2}[^a-z\x20\x09-\x0D]*+(?![^\x20\x09-\x0D])"


def _verdict(rule: Rule) -> Column:
    left, right = F.col(rule.measure) * 100, F.lit(rule.percent) * (1 if rule.per == "one" else F.col(rule.per))
    return (left > right if rule.over else left < right) & (F.col("n_words") >= rule.words)


def _window_hash(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)])


def _covered(starts: Column) -> Column:
    """Words under windows at these ascending starts."""
    begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        starts,
        begin,
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )


def with_measures(frame: DataFrame) -> DataFrame:
    """Add the measures to a frame that has the text in ``text``.

    Two windows are the same when their words are: hashes only tell the texts in which none
    repeats, and the others are sorted by the words themselves.
    """
    words, hashes, ranked = F.col("words"), F.col("hashes"), F.col("ranked")
    any_word, no_starts = r"[^\x20\x09-\x0D]", F.array().cast("array<int>")
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(no_starts)
    frame = frame.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("words", split_words(F.col("text"), SPACE))
    frame = frame.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.regexp_replace("text", SPACE, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long"),
            "n_stop_words": F.size(F.filter(words, lambda w: w.isin(STOP_WORDS))).cast("long"),
            "n_shouted": F.regexp_count("text", F.lit(SHOUTED)).cast("long"),
            "n_exclaimed": (F.length("text") - F.length(F.translate("text", "!", ""))).cast("long"),
            "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(any_word)),
            "hashes": F.transform(starts, lambda i: _window_hash(words, i)),
        }
    )
    window = lambda i: F.array_join(F.slice(words, i + 1, WINDOW), " ")
    frame = frame.withColumns(
        {
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "ranked": F.when(
                F.size(hashes) > F.size(F.array_distinct(hashes)),
                F.array_sort(F.transform(hashes, lambda _, i: F.struct(window(i).alias("w"), i.alias("i")))),
            ),
        }
    )
    same = lambda x, i: F.coalesce(F.get(ranked, i)["w"] == x["w"], F.lit(False))
    repeated = F.filter(ranked, lambda x, i: same(x, i - 1) | same(x, i + 1))
    covered = _covered(F.array_sort(F.transform(repeated, lambda x: x["i"])))
    frame = frame.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return frame.drop("words", "hashes", "ranked", "lines")


def judge(docs: DataFrame, text_col: str = "text", base=BASE_RULES, method=METHOD_RULES) -> DataFrame:
    """``(doc, measures..., base_failed, failed_rules, kept)``; ``doc`` is the whole input row as a struct."""
    frame = with_measures(docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text")))
    names = [F.when(_verdict(r), F.lit(r.name)) for r in (*base, *method)]
    frame = frame.withColumns(
        {
            "base_failed": F.lit(False) if not base else _any([_verdict(r) for r in base]),
            "failed_rules": F.array_compact(F.array(*names)),
        }
    )
    return frame.withColumn("kept", F.size("failed_rules") == 0).drop("text")


def _any(tests: list[Column]) -> Column:
    found = tests[0]
    for t in tests[1:]:
        found = found | t
    return found


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns.

    A filter on ``kept`` would be moved below the projection and repeat all of it inside itself;
    exploding an array of one row or none keeps the measures computed once.
    """
    judged = judge(docs, text_col)
    return judged.select(F.explode(F.when(F.col("kept"), F.array("doc"))).alias("doc")).select("doc.*")


SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
again AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM again, (SELECT unnest(range(0, 5)) AS j) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: x IN (STOP_WORDS))) AS n_stop, len(list_filter(words, lambda x: regexp_matches(x, '^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*$'))) AS n_shout,
    length(regexp_replace(text, '[^!]+', '', 'g')) AS n_exclaim
  FROM w JOIN lines USING (doc_id) LEFT JOIN covered c USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR (n_words >= 20 AND (100 * word_chars > 1500 * n_words OR 100 * word_chars < 200 * n_words
    OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 50 * n_lines OR 100 * n_shout > 50 * n_words
    OR 100 * n_exclaim > 5 * word_chars))
    OR (n_words >= 100 AND 100 * n_stop < n_words)) AS kept
FROM f
""".replace("STOP_WORDS", ", ".join(f"'{w}'" for w in STOP_WORDS))
