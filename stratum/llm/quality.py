"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every text is measured once, in its own row.  For each language and source, sketches of its texts' shares
give the quartiles: a sketch counts texts by share in whole steps of a fixed size, so sketches
of tasks, of sources and of languages merge by adding counts, in any order with the same result, and a quantile
is right to one step.  A share's threshold is ``SPREAD`` interquartile ranges beyond the median.  A source
with fewer than ``GROUP_TEXTS`` texts takes its language's sketch, a language with fewer that of all texts.  What a
text has beyond its threshold must exceed what chance gives: ``SPREAD`` deviations of a count as large as the threshold allows the text
(one at least).  No cutoff is fixed; all of them come from the texts.

Tasks add their counts up before they are shuffled, so a source with a third of all rows costs no more than
any other.  Thresholds (a row for each language and source) join the measured rows; measures, without their texts, are
written once in between.

Null counts as a text without words, which fails the base rules, as an empty
text does.  A null language or source is a group of its own.  Repeated rows are
each judged.  Empty tables give empty results.  A very long text is one row's value.  Other columns may have any name;
verdicts don't depend on how rows are dealt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import written

#: Characters between words, as a set and as a pattern.
SPACES = " \t\n\x0b\f\r"
SPACE = r"[ \t-\r]"
#: Words in a window that must not come twice.
WINDOW = 5
#: Base limits: fewest words, and the largest percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Interquartile ranges beyond the median, and deviations of a count, that are still in line.
SPREAD = 4
#: Texts from which on a group has thresholds of its own.
GROUP_TEXTS = 30
#: What is judged: a count, what it is a share of, and the sketch's steps for a share of one.
SHARES = {"symbols": ("n_symbols", "word_chars", 10_000), "capitals": ("n_upper", "word_chars", 10_000),
          "repeated_lines": ("n_dup_lines", "n_lines", 10_000), "word_length": ("word_chars", "n_words", 100)}


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash comes twice or more; a window's position is its first word's."""
    def adjacent(ranked):
        def equal(entry, i):
            before = (i > 0) & (F.get(ranked, i - 1)["hash"] == entry["hash"])
            return before | (F.coalesce(F.get(ranked, i + 1)["hash"] == entry["hash"], F.lit(False)))
        return F.sort_array(F.transform(F.filter(ranked, equal), lambda e: e["at"]))

    def length(places):
        new = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(new, F.lit(0), lambda a, b: a + b)

    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    return _let(_let(ranked, adjacent), length)


def _repeated(words: Column) -> Column:
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1),
                         lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    counted = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(0))
    return F.when(F.size(words) > WINDOW, counted).otherwise(0)


def _duplicate_lines(lines: Column) -> Column:
    return F.size(lines) - F.size(F.array_distinct(lines))


def measures(text: Column) -> Column:
    """Of a text ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``n_lines`` (with a word) and ``n_upper`` (capital letters)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    with_words = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")

    def of(words):
        def and_lines(lines):
            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
                F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                _duplicate_lines(lines).cast("long").alias("n_dup_lines"),
                _repeated(words).cast("long").alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"))
        return _let(with_words, and_lines)

    return _let(_words(text), of)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def sketches(rows: DataFrame, groups: list[str]) -> DataFrame:
    """``groups``, ``share``, ``step`` and ``n``: texts of each group by the share's step, from the measures ``m``; texts that
    fail the base rules don't count."""
    m = F.col("m")
    steps = [F.struct(F.lit(name).alias("share"), F.floor(m[count] * resolution / m[of]).cast("long").alias("step"))
             for name, (count, of, resolution) in SHARES.items()]
    cells = rows.where(~base_failed(m)).select(*groups, F.explode(F.array(*steps)).alias("c"))
    return cells.groupBy(*groups, "c.share", "c.step").agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Of each group and share ``texts``, ``middle`` (the median) and ``spread`` (between the quartiles), in steps.

    A quantile is the first step at or below which that part of the texts lies.  Windows are over the steps of a sketch.
    """
    merged = sketch.groupBy(*groups, "share", "step").agg(F.sum("n").alias("n"))
    below = F.sum("n").over(Window.partitionBy(*groups, "share").orderBy("step"))
    texts = F.sum("n").over(Window.partitionBy(*groups, "share"))
    placed = merged.withColumns({"below": below, "texts": texts})
    first, middle, third = (F.min(F.when(4 * F.col("below") >= k * F.col("texts"), F.col("step"))) for k in (1, 2, 3))
    return placed.groupBy(*groups, "share").agg(
        F.first("texts").alias("texts"), middle.alias("middle"), (third - first).alias("spread"))


def thresholds(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Of each group (``of_`` columns) the largest share in line, in steps, for each share.

    ``groups`` go from the widest to the narrowest; each narrower sketch is merged into the wider ones.
    """
    sketch = written(sketches(rows, groups), "quality-sketches")
    levels = [quartiles(sketch, groups[:i]) for i in range(len(groups), -1, -1)]
    found = levels[0].withColumnsRenamed({c: f"{c}_0" for c in ("texts", "middle", "spread")})
    for k, level in enumerate(levels[1:], 1):
        wider = level.select(*(F.col(g).alias(f"w_{g}") for g in groups[:len(groups) - k]), F.col("share").alias("w_share"),
                             *(F.col(c).alias(f"{c}_{k}") for c in ("texts", "middle", "spread")))
        same = F.col("share") == F.col("w_share")
        for g in groups[:len(groups) - k]:
            same = same & F.col(g).eqNullSafe(F.col(f"w_{g}"))
        found = found.join(wider, same).drop("w_share", *(f"w_{g}" for g in groups[:len(groups) - k]))
    last = len(levels) - 1
    # the narrowest level with texts enough
    most = F.col(f"middle_{last}") + SPREAD * F.col(f"spread_{last}")
    for k in range(last - 1, -1, -1):
        most = F.when(F.col(f"texts_{k}") >= GROUP_TEXTS, F.col(f"middle_{k}") + SPREAD * F.col(f"spread_{k}")).otherwise(most)
    limits = found.withColumn("most", most)
    return limits.groupBy(*(F.col(g).alias(f"of_{g}") for g in groups)).pivot("share", list(SHARES)).agg(F.max("most")) \
        .withColumnsRenamed({name: f"most_{name}" for name in SHARES})


def in_line(m: Column) -> Column:
    """Whether no count lies further beyond its group's threshold than chance takes it."""
    verdict = F.lit(True)
    for name, (count, of, resolution) in SHARES.items():
        # the step's upper end, as the sketch doesn't tell shares within a step apart
        allowed = (F.col(f"most_{name}") + 1) * m[of] / F.lit(resolution)
        verdict = verdict & (m[count] <= allowed + SPREAD * F.sqrt(F.greatest(allowed, F.lit(1.0))))
    return F.coalesce(verdict, F.lit(False))


def _limits(docs: DataFrame, text_col: str, group_cols: tuple[str, ...], keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """The written rows (``keep`` columns as struct ``row``, groups, measures ``m``) and their groups' thresholds."""
    groups = [f"group_{i}" for i in range(len(group_cols))]
    rows = written(docs.select(
        F.struct(*(docs[c] for c in keep)).alias("row"),
        *(docs[c].alias(g) for c, g in zip(group_cols, groups)), measures(docs[text_col]).alias("m")), "quality-measures")
    return rows, written(thresholds(rows, groups), "quality-thresholds")


def _verdicts(rows: DataFrame, limits: DataFrame, n_groups: int) -> DataFrame:
    same = F.lit(True)
    for g in (f"group_{i}" for i in range(n_groups)):
        same = same & F.col(g).eqNullSafe(F.col(f"of_{g}"))
    m = F.col("m")
    return rows.join(limits, same, "left").select(
        "row", "m", base_failed(m).alias("base_failed"), (~base_failed(m) & in_line(m)).alias("kept"))


def judged(docs: DataFrame, text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source"),
           keep_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (the ``keep_cols`` as a struct), its measures ``m``, ``base_failed`` and ``kept``."""
    rows, limits = _limits(docs, text_col, group_cols, list(keep_cols))
    return _verdicts(rows, limits, len(group_cols))


def keep(docs: DataFrame, text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``docs`` with its columns, without the texts that fail the base rules or lie out of line.

    Texts are measured again where they are filtered, so that no second copy of them is written.
    """
    _, limits = _limits(docs, text_col, group_cols, list(group_cols))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"),
                       *(docs[c].alias(f"group_{i}") for i, c in enumerate(group_cols)),
                       measures(docs[text_col]).alias("m"))
    return _verdicts(rows, limits, len(group_cols)).where("kept").select("row.*")
