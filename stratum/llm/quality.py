"""Quality rules: a threshold table compiled into one Spark projection.

``measures`` turns a text into counts with built-in functions only; a rule names
a ratio of two measures, a bound and the side that fails. ``compile_rules``
turns the table into one boolean column, so every verdict comes from a single
projection over the scan, without a shuffle or a user function.

Words are runs of characters other than ``\\x20 \\x09-\\x0D``, lines are split at
``\\n``. Defined cases: null text has no words; empty text fails the base rule; a
ratio over zero is zero; rows are judged one by one, so repeated rows give
repeated results; an empty table gives no rows; further columns of the input are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is for on that with as it was by are this be from at or "
    "der die das und ist von den zu mit im nicht ein eine auf des dem sich "
    "le la les de un une et en du que qui pour dans est par sur au avec pas "
    "el los las y del se por con para una al no su lo"
).split()


@dataclass(frozen=True)
class Rule:
    """Fails where ``numerator / denominator`` lies beyond ``bound``; judged only
    from ``min_words`` words on."""

    name: str
    numerator: str
    denominator: str
    fails: str  # "above" or "below"
    bound: float
    min_words: int = 0


RULES = (
    Rule("symbols", "n_symbols", "n_words", "above", 0.1),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", "above", 0.5),
    Rule("long_words", "word_chars", "n_words", "above", 12.0),
    Rule("short_words", "word_chars", "n_words", "below", 2.0),
    Rule("stop_words", "n_stop_words", "n_words", "below", 0.06, min_words=50),
    Rule("letters", "n_letters", "word_chars", "below", 0.6),
)


def _let(value: Column, body) -> Column:
    """Binds ``value`` to a lambda variable, so that it is evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words lying in a window of WINDOW words that occurs twice or more."""
    n = F.size(words)

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
                           lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)]))

    def covered(h: Column) -> Column:
        """h: window hashes. Starts of repeated windows, then what they cover."""
        def starts(s: Column) -> Column:
            last = F.size(s)
            hit = F.filter(s, lambda x, j: (
                ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | ((j + 1 < last) & (F.get(s, j + 1)["h"] == x["h"]))))
            return F.array_sort(F.transform(hit, lambda x: x["i"]))

        return _let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
                    lambda s: _let(starts(s), lambda p: F.aggregate(
                        F.transform(p, lambda x, j: F.when(
                            j + 1 < F.size(p), F.least(F.lit(WINDOW), F.get(p, j + 1) - x)).otherwise(F.lit(WINDOW))),
                        F.lit(0), lambda a, x: a + x)))

    counted = _let(hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(n < WINDOW, F.lit(0)).otherwise(counted)


def measures(documents: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and one long column per measure."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = documents.select("doc_id", t.alias("t"))
    spaced = F.translate("t", "\x09\x0a\x0b\x0c\x0d", "     ")
    split = base.select(
        "doc_id", "t",
        F.filter(F.split(spaced, " +"), lambda w: w != "").alias("words"),
        F.filter(F.split("t", "\n"), lambda s: F.trim(F.translate(s, "\x09\x0b\x0c\x0d", "    ")) != "").alias("lines"),
    )

    def row(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(F.rtrim(x, F.lit(".,!?;:"))).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        )

    counted = split.select(
        "doc_id", "t",
        _let(F.col("words"), row).alias("w"),
        _let(F.col("lines"), lambda s: F.struct(
            F.size(s).cast("long").alias("n_lines"),
            (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"))).alias("l"),
    )
    return counted.select(
        "doc_id",
        "w.n_words",
        F.length(F.translate("t", "\x20\x09\x0a\x0b\x0c\x0d", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("t", r"\P{L}+", "")).cast("long").alias("n_letters"),
        "l.n_lines", "l.n_dup_lines", "w.n_repeat_words", "w.n_stop_words",
    )


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean column: whether any rule of the table fails."""
    failed = F.lit(False)
    for r in rules:
        num, den = F.col(r.numerator).cast("double"), F.col(r.denominator).cast("double")
        beyond = (num > r.bound * den) if r.fails == "above" else (num < r.bound * den)
        failed = failed | (beyond & (F.col("n_words") >= r.min_words))
    return failed


def judge(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures with ``base_failed`` and ``kept``."""
    m = measures(documents)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return m.select("*", base.alias("base_failed"), (~base & ~compile_rules(rules)).alias("kept"))
