"""Quality rules: a threshold table compiled into one projection, in built-in functions only.

Measures of a text (null counts as empty): words, their length, symbols, upper case, stop words, repeated lines and
repeated runs of eight words. A rule names a measure and the range it must lie in; ``rejects`` turns the table into
one column, so the optimizer sees a plain projection over the scan and no row leaves the JVM. Every text is read
whole. Rows are judged alone: repeated rows, ties and other columns do not matter, an empty table gives an empty
result, and a text without words has every ratio 0 (it fails the least number of words).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"\x20\x09-\x0D"
SYMBOLS = r"#*$%&|<>"
RUN = 8                                          # words of a repeated run

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = """
the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which
le la les de des du et un une en dans que qui est pour pas par sur au avec il elle
der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an
el la los las de que y en un una por con no se su para es al lo como más del
""".split()

#: (name, measure, least, most); None leaves a side open. Ratios are per word, per word character or per line.
RULES = (
    ("word length", "mean_word_length", 2.0, 14.0),
    ("symbols", "symbol_ratio", None, 0.1),
    ("upper case", "upper_ratio", None, 0.3),
    ("stop words", "stop_ratio", 0.01, None),
    ("repeated lines", "dup_line_ratio", None, 0.4),
)


def _left(text: Column, pattern: str) -> Column:
    """Characters that stay when the pattern is taken out."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def measures(docs: DataFrame, text_col: str = "text", keep=()) -> DataFrame:
    """Columns ``keep`` and the measures of each text: counts (long) and ratios (double)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(*keep, text.alias("__text"))
    base = base.withColumn("__words", F.regexp_extract_all("__text", F.lit(f"[^{SPACE}]+"), F.lit(0)))
    base = base.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    # one hash for each window of RUN words
    base = base.withColumn("__runs", F.when(
        F.size("__words") >= RUN, F.transform(F.sequence(F.lit(0), F.size("__words") - RUN),
                                              lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(RUN)]))
    ).otherwise(F.array().cast("array<bigint>")))
    # starts of windows that occur more than once, found by sorting (hash, start); only texts that have any do this
    base = base.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__runs")) < F.size("__runs"),
        F.sort_array(F.transform("__runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    base = base.withColumn("__starts", F.expr(
        "array_sort(transform(filter(transform(__sorted, (e, j) -> struct(e.i AS i, "
        "coalesce(e.h = get(__sorted, j - 1).h, false) OR coalesce(e.h = get(__sorted, j + 1).h, false) AS twice)), "
        "e -> e.twice), e -> e.i))"))
    covered = F.expr(f"coalesce(aggregate(zip_with(slice(__starts, 2, greatest(size(__starts), 1)), __starts, "
                     f"(b, a) -> cast(least(b - a, {RUN}) AS bigint)), 0L, (t, x) -> t + x), 0L)")
    stop = F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS)))
    n = F.size("__words").cast("long")
    counts = (
        n.alias("n_words"), _left(F.col("__text"), f"[{SPACE}]+").alias("word_chars"),
        _left(F.col("__text"), f"[^{SYMBOLS}]+").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), F.size("__lines").cast("long").alias("n_lines"),
        stop.cast("long").alias("n_stop"), _left(F.col("__text"), r"[^\p{Lu}]+").alias("n_upper"))
    # a generator of one row: filters on the measures stay above it, else every reference would repeat the work of all
    counts = base.select(*keep, F.inline(F.array(F.struct(*counts))))
    per = lambda part, whole: F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))
    return counts.select("*", per("word_chars", "n_words").alias("mean_word_length"), per("n_symbols", "n_words").alias("symbol_ratio"),
                         per("n_upper", "word_chars").alias("upper_ratio"), per("n_stop", "n_words").alias("stop_ratio"),
                         per("n_dup_lines", "n_lines").alias("dup_line_ratio"))


def rejects(rules=RULES) -> Column:
    """The table of rules as one column: the first rule that fails, null if none does."""
    verdict = F.lit(None).cast("string")
    for name, measure, least, most in reversed(rules):
        bad = F.lit(False)
        if least is not None:
            bad = bad | (F.col(measure) < least)
        if most is not None:
            bad = bad | (F.col(measure) > most)
        verdict = F.when(bad, F.lit(name)).otherwise(verdict)
    return verdict


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def judged(docs: DataFrame, text_col: str = "text", keep=("doc_id",), rules=RULES) -> DataFrame:
    """Columns ``keep``, the measures, base_failed, failed_rule and kept for every row."""
    out = measures(docs, text_col, keep).withColumn("base_failed", base_failed()).withColumn("failed_rule", rejects(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull())


def good(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows that pass, with their own columns; a struct carries them so that names cannot clash."""
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__row"), F.col(text_col).alias("__body"))
    return judged(packed, "__body", ("__row",), rules).where("kept").select("__row.*")
