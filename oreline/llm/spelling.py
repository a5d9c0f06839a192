"""Spelling variants: words one edit apart, found among sorted rotations (permuterm).

A word is closed by a terminator and rotated: ``word$`` has one rotation for each of its code points and the terminator.
Cut the edited code point out of a word, a|c|b, and turn the rest so that the gap is at its end: ``b$a``. Every word that
differs by another code point in that place has a rotation ``b$a?``, and the word without it has the rotation ``b$a``
itself. So replacements, insertions and deletions are all neighbours in one prefix range of the sorted rotations: those
that agree but for the last code point. The rotations are sorted by range partitions, and a scan over each prefix range
gives every word the number of its neighbours there and the most frequent of them. A range holds at most one word for
each letter of the alphabet and one more, however many rows the table has.

Two words that differ by one of several equal neighbouring letters meet once for each of these; only the first counts.

Null text has no words. Repeated rows count each. A null id counts as an empty one in the misspelling rule. Texts are read
whole. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize, shuffle_width

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "$"                                        # the terminator; no letter


def misspelled(word: Column, key: Column, every: int) -> Column:
    """``word`` without its code point h % length if ``every`` divides h = crc32(key)."""
    h = F.crc32(key)
    at = F.pmod(h, F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(F.pmod(h, F.lit(every)) == 0, cut).otherwise(word)


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199, least: int = 6, times: int = 5) -> DataFrame:
    """(word, n): runs of letters, lower-cased, of ``least`` code points and ``times`` occurrences or more."""
    runs = F.regexp_extract_all(F.translate(F.coalesce(text_col, F.lit("")), UPPER, LOWER), F.lit(RUN), F.lit(0))
    found = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.where(F.length("run") >= least)        # a deletion only shortens
    found = found.select(misspelled(F.col("run"), F.concat_ws(":", "id", "run"), every).alias("word")).where(F.length("word") >= least)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def rotations(vocabulary: DataFrame) -> DataFrame:
    """(prefix, gap, once, word, n) for each rotation of each word.

    ``gap``: the rotation's last code point is cut out of the prefix; without gap the prefix is the whole rotation. ``once``
    marks the gaps that are the first of equal neighbouring letters.
    """
    turned = vocabulary.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    tail = F.substring("word", F.col("i") + 1, F.length("word"))
    char = lambda at: F.substring("word", at, F.lit(1))
    whole = F.struct(F.concat(tail, F.lit(END), F.substring("word", F.lit(1), F.col("i"))).alias("prefix"), F.lit(False).alias("gap"), F.lit(False).alias("once"))
    cut = F.struct(F.concat(tail, F.lit(END), F.substring("word", F.lit(1), F.col("i") - 1)).alias("prefix"), F.lit(True).alias("gap"),
                   ((F.col("i") == 1) | (char(F.col("i")) != char(F.col("i") - 1))).alias("once"))
    # the rotation that ends with the terminator has no edited letter
    return turned.select("word", "n", F.explode(F.when(F.col("i") > 0, F.array(whole, cut)).otherwise(F.array(whole))).alias("r")).select("r.*", "word", "n")


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): how many words are one edit away, and the most frequent (first in order of ties)."""
    turned = rotations(vocabulary)
    ordered = turned.repartitionByRange(shuffle_width(vocabulary.sparkSession), "prefix").sortWithinPartitions("prefix")
    member = F.struct((-F.col("n")).alias("less"), "word", "once")
    groups = ordered.groupBy("prefix").agg(
        F.sort_array(F.collect_list(F.when(F.col("gap"), member))).alias("gaps"),
        F.max(F.when(~F.col("gap"), F.struct((-F.col("n")).alias("less"), "word"))).alias("whole"),
    ).where((F.size("gaps") > 1) | ((F.size("gaps") > 0) & F.col("whole").isNotNull()))
    name = lambda m: F.struct(m["less"].alias("less"), m["word"].alias("word"))
    whole, first, second = F.col("whole"), F.get("gaps", F.lit(0)), F.get("gaps", F.lit(1))

    def of_gap(m):
        other = F.when(first["word"] != m["word"], name(first)).when(second.isNotNull(), name(second))
        near = F.size("gaps") - 1 + F.when(m["once"] & whole.isNotNull(), 1).otherwise(0)
        return F.struct(m["word"].alias("word"), near.cast("long").alias("near"), F.least(other, F.when(m["once"], whole)).alias("best"))
    firsts = F.filter("gaps", lambda m: m["once"])
    of_whole = F.struct(whole["word"].alias("word"), F.size(firsts).cast("long").alias("near"),
                        F.when(F.size(firsts) > 0, name(F.get(firsts, F.lit(0)))).alias("best"))
    told = groups.select(F.explode(F.concat(F.transform("gaps", of_gap), F.when(whole.isNotNull(), F.array(of_whole)).otherwise(F.array()))).alias("e")).select("e.*")
    best = told.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return best.select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by doubling; a form is more frequent, so there are no cycles."""
    paths = materialize(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        step = paths.where("word <> root")
        if not step.join(step.select(F.col("word").alias("root")), "root", "left_semi").take(1):
            return paths
        further = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        paths = materialize(paths.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199, least: int = 6, times: int = 5,
             factor: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every frequent word.

    ``form`` is the most frequent word one edit away if it occurs ``factor`` times as often or more, else null; ``root`` is
    where the chain of forms ends.
    """
    vocabulary = materialize(words(docs, id_col, text_col, every, least, times))
    near = vocabulary.join(neighbours(vocabulary), "word", "left")
    is_form = F.col("best_n") >= factor * F.col("n")
    near = materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    return near.join(roots(near), "word")
