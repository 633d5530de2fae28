"""Quality rules: a threshold table compiled into one Spark projection.

Every figure and every verdict is a built-in expression over the text column, so the whole rule set is a single narrow projection
without shuffle, user function or state. Rules are data: (name, figure, comparison, threshold).

Edge cases: a null or empty text has no words, so all its figures are 0 and base_failed holds. Rows are judged one by one, so ties
and repeated rows get equal verdicts; an empty table gives an empty result. With keep_columns the input's columns pass through, and
where one has the name of a figure, the figure replaces it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flankspark.functions.expressions import let

SPACES = "[ \\x09-\\x0D]+"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it with was on as by at be this from are or an "
    "der die und das den von zu mit ist ein im nicht auf des eine "
    "le la les et de des un une dans est que pour qui sur pas par "
    "el los las en y del se con una por no su al"
).split()

#: (rule, figure, comparison, threshold): a document for which one holds is rejected. Ratios are parts of the document's words, lines or characters.
RULES: list[tuple[str, str, str, float]] = [
    ("too_short", "n_words", "<", 10),
    ("repeats", "repeat_ratio", ">", 0.20),
    ("short_words", "mean_word_chars", "<", 2.0),
    ("long_words", "mean_word_chars", ">", 25.0),
    ("symbols", "symbol_ratio", ">", 0.25),
    ("marks", "mark_ratio", ">", 0.75),
    ("digits", "digit_ratio", ">", 0.50),
    ("no_stop_words", "stop_ratio", "<", 0.004),
    ("copied_lines", "dup_line_ratio", ">", 0.60),
]
#: The rules that the contract of the base fixes.
BASE = ("too_short", "repeats")
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COMPARE = {"<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b}


def repeated_words(words: Column, width: int = 5) -> Column:
    """How many words lie in windows of width words that occur at least twice.

    The windows' hashes are sorted with their positions; equal neighbours are the repeats, and the union of their spans is summed
    from the gaps between the sorted positions. All of it is n log n in the words of one text.
    """
    last = F.size(words) - width

    def spans(places: Column) -> Column:
        gaps = F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))), lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)

    def repeats(windows: Column) -> Column:
        at = F.filter(
            windows,
            lambda x, i: ((i > 0) & (F.get(windows, i - 1)["h"] == x["h"])) | (F.get(windows, i + 1)["h"] == x["h"]),
        )
        return let(F.array_sort(F.transform(at, lambda x: x["i"])), spans)

    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(width)]).alias("h"), i.alias("i")))
    # A text whose windows are all different, as most are, needs no sort.
    return F.when(last < 1, F.lit(0).cast("long")).otherwise(let(windows, lambda w: F.when(F.size(F.array_distinct(F.transform(w, lambda x: x["h"]))) == F.size(w), F.lit(0).cast("long")).otherwise(let(F.sort_array(w), repeats))))


def figures(text: Column) -> Column:
    """A struct of all figures of a text."""
    text = F.coalesce(text, F.lit(""))

    def of(t: Column) -> Column:
        words = F.filter(F.split(t, SPACES), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]"))

        def rest(w: Column) -> Column:
            return let(
                lines,
                lambda line: F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
                    F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                    (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
                    repeated_words(w).alias("n_repeat_words"),
                    F.size(line).cast("long").alias("n_lines"),
                    F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop"),
                    F.regexp_count(t, F.lit("[0-9]")).cast("long").alias("n_digits"),
                    F.regexp_count(t, F.lit("[!?#*$%&|<>]")).cast("long").alias("n_marks"),
                ),
            )

        return let(words, rest)

    return let(text, of)


def measures(f: Column) -> dict[str, Column]:
    def part(a: str, b: str) -> Column:
        return F.when(f[b] > 0, f[a] / f[b]).otherwise(F.lit(0.0))

    return {
        "n_words": f["n_words"],
        "repeat_ratio": part("n_repeat_words", "n_words"),
        "mean_word_chars": part("word_chars", "n_words"),
        "symbol_ratio": part("n_symbols", "n_words"),
        "mark_ratio": part("n_marks", "n_words"),
        "digit_ratio": part("n_digits", "word_chars"),
        # A few words without a function word prove nothing.
        "stop_ratio": F.when(f["n_words"] >= 40, part("n_stop", "n_words")).otherwise(F.lit(1.0)),
        "dup_line_ratio": part("n_dup_lines", "n_lines"),
    }


def judge(docs: DataFrame, text: str = "text", rules: list[tuple[str, str, str, float]] | None = None, keep_columns: bool = True) -> DataFrame:
    """docs with the figures, base_failed, failed_rules (names) and kept."""
    rules = RULES if rules is None else rules

    def verdict(f: Column) -> Column:
        named = measures(f)
        broken = [F.when(COMPARE[sign](named[figure], F.lit(limit)), F.lit(name)) for name, figure, sign, limit in rules]
        base = (f["n_words"] < 10) | (100 * f["n_repeat_words"] > 20 * f["n_words"])
        failed = F.filter(F.array(*broken), lambda x: x.isNotNull())
        return F.struct(*[f[k].alias(k) for k in FIGURES], base.alias("base_failed"), failed.alias("failed_rules"), (~base & (F.size(failed) == 0)).alias("kept"))

    # One expression for all, so that a filter on the verdict, which Spark pushes below the projection, measures each text once.
    own = "__judged"
    out = docs.withColumn(own, let(figures(F.col(text)), verdict))
    new = {k: F.col(own)[k] for k in (*FIGURES, "base_failed", "failed_rules", "kept")}
    if keep_columns:
        return out.withColumns(new).drop(own)
    return out.select(*[c.alias(k) for k, c in new.items()])
