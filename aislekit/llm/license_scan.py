"""License scan: ordered signature rules behind a keyword prefilter.

Every rule names one literal word.  A text is cut into words once; only the
places of such words leave the row, with the words around them, and meet just
the rules of their word.  A rule's regular expression runs over the words
around its literal, so its match tells the first and the last word.

Where matches overlap, one that lies inside another of the same or a higher
priority is suppressed (equal spans: the higher priority, then the earlier
rule stays).  Base rules (priority 0) neither suppress nor are suppressed.
Matches of a text are sorted by their start, so the farthest end seen so far
at each priority tells what is covered; matches are never paired.

DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aislekit.llm._common import Scratch
from aislekit.llm.license_rules import REACH, RULES, Rule

# Fixed by the task: what stands between words, after A-Z have been lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The place of the literal in the words around it; no word holds this character.
MARK = "@"
#: How much a match of each priority says; a text's score is that of its strongest.
STRENGTH = {0: 0.5, 1: 0.25, 2: 0.5, 3: 0.75, 4: 1.0}


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, BETWEEN), "")


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Rules as rows, as many as were written by hand: rule, priority, label, key, regex."""
    rows = [(r.rule, r.priority, r.label, r.key, f"(?:^| )({r.left}{MARK}{r.right})(?: |$)") for r in rules]
    return spark.createDataFrame(rows, "rule int, priority int, label string, key string, regex string")


def places(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text: str = "text",
           reach: int = REACH) -> DataFrame:
    """Per row of ``docs``: id, n_words, places (at, key, around) of the rules' literals."""
    keys = sorted({r.key for r in rules})
    cut = docs.select(F.col(id_col).alias("id"), words(F.col(text)).alias("words"))
    at = F.when(F.size("words") > 0, F.filter(F.sequence(F.lit(0), F.size("words") - 1),
                                              lambda i: F.get("words", i).isin(keys)))
    joined = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    around = lambda i: F.concat_ws(" ", joined(F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach))),
                                   F.lit(MARK), joined(i + 2, F.lit(reach)))
    return (cut.withColumn("at", F.coalesce(at, F.array().cast("array<int>")))
            .select("id", F.size("words").cast("long").alias("n_words"),
                    F.transform("at", lambda i: F.struct(i.alias("at"), F.get("words", i).alias("key"),
                                                         around(i).alias("around"))).alias("places")))


def matches(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Matches of the rules at the places of ``rows`` (row, places): row, rule, priority, label, start, end, words."""
    here = rows.select("row", F.inline("places"))
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    return (here.join(F.broadcast(rules), "key")
            .withColumn("match", F.expr("regexp_extract(around, regex, 1)")).where("match != ''")
            .select("row", "rule", "priority", "label",
                    (F.col("at") - spaces(F.substring_index("match", MARK, 1))).alias("start"),
                    (F.col("at") + spaces(F.substring_index("match", MARK, -1))).alias("end"),
                    F.replace("match", F.lit(MARK), F.col("key")).alias("words")))


def keep_outermost(found: DataFrame) -> DataFrame:
    """Matches that lie in no other one of the same or a higher priority; base matches all stay."""
    before = (Window.partitionBy("row").orderBy("start", F.desc("end"), F.desc("priority"), "rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    levels = sorted(set(STRENGTH) - {0})
    far = [F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before).alias(f"far_{p}") for p in levels]
    inside = F.lit(False)
    for p in levels:
        inside = F.when(F.col("priority") == p, F.coalesce(F.col(f"far_{p}") >= F.col("end"), F.lit(False))) \
            .otherwise(inside)
    return (found.select("*", *far).where(~inside).drop(*[f"far_{p}" for p in levels]))


def scan(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text: str = "text",
         reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """Rows (row, id, n_words) of all texts and their kept matches (row, rule, priority, label, start, end, words).

    ``row`` tells rows of ``docs`` apart, also where ids repeat or are null.
    A null text has no words.
    """
    scratch = Scratch(docs.sparkSession, "license-scan")
    rows = scratch.table(places(docs, rules, id_col, text, reach)
                         .select(F.monotonically_increasing_id().alias("row"), "*"), "places")
    return rows.drop("places"), keep_outermost(matches(rows, rule_table(docs.sparkSession, rules)))


def op11_license_scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Documents without a match have no places, empty labels and score 0; null
    and empty texts have no words.  Repeated rows stay apart.
    """
    rows, kept = scan(docs)
    base, start = F.col("priority") == 0, F.col("start").cast("long")
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731 - at most as many as rules
    strength = F.create_map(*[F.lit(x) for kv in STRENGTH.items() for x in kv])
    by_row = kept.groupBy("row").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, start)).alias("first_word"),
        F.max(F.when(base, start)).alias("last_word"), listed(F.when(base, F.col("label"))).alias("base_labels"),
        listed("label").alias("labels"), F.max(strength[F.col("priority")]).alias("score"))
    return rows.join(by_row, "row", "left").select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word",
        "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle_sql(rules: list[Rule] = RULES) -> str:
    """The same in SQL: every word is set beside every rule's literal, with the whole text around it."""
    values = ",\n".join(f"({r.rule}, {r.priority}, {_quoted(r.label)}, {_quoted(r.key)}, "
                        f"{_quoted(f'(?:^| )({r.left}{MARK}{r.right})(?: |$)')})" for r in rules)
    strength = " ".join(f"WHEN {p} THEN {s}" for p, s in STRENGTH.items())
    return f"""
WITH rules(rule, priority, label, key, regex) AS (VALUES
{values}),
docs AS (SELECT row_number() OVER () AS r, doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''),
    '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{BETWEEN}') IF x <> ''] AS w FROM documents),
word AS (SELECT r, w, unnest(w) AS word, unnest(range(len(w))) AS pos FROM docs),
found AS (SELECT r, rule, priority, label, pos, regexp_extract(concat_ws(' ',
      nullif(array_to_string(w[greatest(pos - 39, 1):pos], ' '), ''), '{MARK}', nullif(array_to_string(w[pos + 2:pos + 40], ' '), '')), regex, 1) AS m
    FROM word JOIN rules ON rules.key = word.word),
span AS (SELECT r, rule, priority, label, pos - len(split_part(m, '{MARK}', 1)) + len(replace(split_part(m, '{MARK}', 1), ' ', '')) AS a,
      pos + len(split_part(m, '{MARK}', 2)) - len(replace(split_part(m, '{MARK}', 2), ' ', '')) AS b FROM found WHERE m <> ''),
kept AS (SELECT * FROM span s WHERE priority = 0 OR NOT EXISTS (SELECT 1 FROM span o WHERE o.r = s.r AND o.a <= s.a AND o.b >= s.b
      AND o.priority >= s.priority AND ((o.a < s.a OR o.b > s.b) OR o.priority > s.priority OR o.rule < s.rule))),
agg AS (SELECT r, count(*) FILTER (priority = 0) AS n_base, min(a) FILTER (priority = 0) AS first_word,
      max(a) FILTER (priority = 0) AS last_word,
      coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (priority = 0)), ','), '') AS base_labels,
      array_to_string(list_sort(list(DISTINCT label)), ',') AS labels,
      max(CASE priority {strength} END)::DOUBLE AS score FROM kept GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN agg USING (r)"""
