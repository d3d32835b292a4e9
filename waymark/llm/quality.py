"""Quality rules with thresholds taken from the corpus, in DataFrame operations only.

Three measures of a text (symbols a word, share of repeated lines, mean word
length) are summarised for every language and source by mergeable quantile
sketches (KLL: a sketch for each partition, merged in the shuffle; the sketches of
a language's sources are merged again for the language). A group's fences follow
from its own quantiles alone. The upper one is

    q90 + SPREAD * (q90 - q50) + TAIL * (q99 - q90)

and the lower one its mirror image: as far beyond the typical texts as these are
spread, and a part of the way into the group's tail, because for measures that are
zero in most texts (symbols, repeated lines) only the tail has a scale. In a
group without a tail, no more than its last hundredth is beyond the fence. A group
of fewer than ``LEAST`` usable texts takes its language's fences. The fences are
joined back and decide which rows stay.

Every text is read once: its counts are written, sketches and judgement read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import tables as shared

WINDOW, MIN_WORDS, REPEAT_PERCENT = 8, 20, 30
SPREAD, LEAST = 2.0, 100
#: How far into the tail a fence lies, for symbols a word, repeated lines a line, code points a word.
TAIL = {"symbols": 0.1, "dup_lines": 0.75, "word_length": 0.25}
#: Values that a sketch keeps before it thins them out: groups up to this size are exact, ranks of larger ones off by about 0.001.
SKETCH = 4096
QUANTILES = (0.01, 0.1, 0.5, 0.9, 0.99)
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _counts(df: DataFrame, text: Column) -> DataFrame:
    """The cheap counts: words, code points in words, symbols, repeated lines."""
    df = df.withColumns(
        {
            "__text": F.coalesce(text, F.lit("")),
        }
    ).withColumns(
        {
            "__words": F.array_remove(F.split("__text", SPACE), ""),
            "__lines": F.filter(F.split("__text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    return df.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.char_length(F.array_join("__words", "")).cast("long"),
            "n_symbols": (F.char_length("__text") - F.char_length(F.translate("__text", SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        }
    )


def _repeats(df: DataFrame) -> DataFrame:
    """n_repeat_words: words in windows met twice or more.

    Windows are compared by 64-bit hashes inside one text. Only texts with two
    equal hashes sort them; equal neighbours in that order give the windows'
    places, and gaps between sorted places give the words that they cover.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size("__words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("__words", i, WINDOW))
    )
    df = df.withColumn("__h", F.when(F.size("__words") > WINDOW, windows))
    pairs = F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), pairs))
    s = F.col("__s")
    twice = F.filter(
        s,
        lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)),
    )
    df = df.withColumn("__at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    gaps = F.zip_with(
        F.slice("__at", F.lit(2), F.size("__at") - 1),
        F.slice("__at", F.lit(1), F.size("__at") - 1),
        lambda b, a: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda acc, x: acc + x)
    return df.withColumn("n_repeat_words", F.when(F.col("__at").isNull(), F.lit(0)).otherwise(covered).cast("long"))


def counted(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep_text: bool = True) -> DataFrame:
    """A written table of (row, lang, source, counts, n_lines); ``row`` has the columns of ``docs``, without the text if not ``keep_text``."""
    row = F.struct(*(c for c in docs.columns if keep_text or c != text)) if keep_text or len(docs.columns) > 1 else F.struct(F.lit(None).cast("int").alias("none"))
    named = docs.select(row.alias("row"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), F.col(text).alias("__t"))
    df = _repeats(_counts(named, F.col("__t"))).withColumn("n_lines", F.size("__lines").cast("long"))
    return shared.table(df.select("row", "lang", "source", *COUNTS, "n_lines"), "counts")


def measures() -> dict[str, Column]:
    """The measures of counted rows; null where there are no words or lines."""
    n = F.nullif("n_words", F.lit(0))
    return {"symbols": F.try_divide("n_symbols", n), "dup_lines": F.try_divide("n_dup_lines", F.nullif("n_lines", F.lit(0))), "word_length": F.try_divide("word_chars", n)}


def thresholds(counts: DataFrame) -> DataFrame:
    """(lang, source, symbols_hi, dup_lines_hi, word_length_lo, word_length_hi) for every group of a counted table."""
    usable = F.col("n_words") >= MIN_WORDS
    df = counts.select("lang", "source", usable.alias("usable"), *(F.when(usable, m).alias(k) for k, m in measures().items()))
    own = df.groupBy("lang", "source").agg(F.count_if("usable").alias("n"), *(F.expr(f"kll_sketch_agg_double({m}, {SKETCH})").alias(m) for m in TAIL))
    own = shared.table(own, "sketches").alias("o")
    wide = own.groupBy("lang").agg(F.sum("n").alias("n"), *(F.expr(f"kll_merge_agg_double({m}, {SKETCH})").alias(m) for m in TAIL)).alias("w")
    joined = own.join(wide, F.col("o.lang").eqNullSafe(F.col("w.lang")))
    chosen = [F.when(F.col("o.n") >= LEAST, F.col(f"o.{m}")).otherwise(F.col(f"w.{m}")).alias(m) for m in TAIL]
    # Without usable texts there is nothing to ask a sketch for.
    joined = joined.select(F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), (F.col("w.n") > 0).alias("some"), *chosen)
    at = ", ".join(map(str, QUANTILES))
    asked = [F.when(F.col("some"), F.expr(f"kll_sketch_get_quantile_double({m}, array({at}))")).alias(m) for m in TAIL]
    joined = joined.select("lang", "source", *asked)

    def fence(m: str, tail: int, end: int) -> Column:
        q = F.col(m)
        return q[end] + SPREAD * (q[end] - q[2]) + TAIL[m] * (q[tail] - q[end])

    hi = [fence(m, 4, 3).alias(f"{m}_hi") for m in TAIL]
    return joined.select("lang", "source", *hi, fence("word_length", 0, 1).alias("word_length_lo"))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep_text: bool = True) -> DataFrame:
    """All columns of ``docs`` (the text only if ``keep_text``) with the counts, ``base_failed`` and ``kept``.

    Null text counts as empty. Null language or source is a group of its own.
    A measure or fence that is undefined (no words, no usable text in the
    language) rejects nothing; a value on a fence (ties) stays. Texts are judged
    whole, however long; repeated rows are judged alike and come out as often as
    they went in. An empty table gives no rows. Columns of ``docs`` named like the
    counts give way to them, any others pass.
    """
    counts = counted(docs, text, lang, source, keep_text)
    limits = shared.table(thresholds(counts), "fences").withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    df = counts.withColumns(measures()).join(limits, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    inside = F.col("word_length") >= F.col("word_length_lo")
    for m in TAIL:
        inside &= F.col(m) <= F.col(f"{m}_hi")
    new = [*COUNTS, "base_failed", "kept"]
    row = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in new and (keep_text or c != text)]
    return df.select(*row, *COUNTS, failed.alias("base_failed"), (~failed & F.coalesce(inside, F.lit(True))).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    named = docs.select(F.struct("*").alias("own"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    return judge(named, keep_text=False).where("kept").select("own.*")
